"""Mixing sources to target weights by subset-sum budget fitting.

Sources get shares of a budget of words by their weights.  Whole copies of a
source fill most of its target; for the rest, documents are counted by exact
length, an even share of every length is taken, and a bounded-knapsack table
over the few words left chooses how many more of each length.  A seeded hash
picks the documents of a length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.operators.ordering import global_rank
from plumbwright.sources.scratch import write_table

WEIGHTS = (1.0, 2.0, 3.0)
REPEATS = 3
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"
# Words that the knapsack table spans, or the longest document if that is longer; larger rests are
# first filled with whole documents.
TABLE_WORDS = 1 << 16
# Documents of one length whose seeded order one task may sort.
SORTED_TOGETHER = 1 << 15


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget``, from below.

    Takes an even share of every length but for a reserve, fills what is left
    with whole documents in a seeded order of lengths while it exceeds the table,
    and solves the last part exactly by dynamic programming: the largest sum of
    the documents left that doesn't exceed the words left.
    """
    taken = np.zeros(len(lengths), np.int64)
    real = lengths > 0
    total = int((lengths * counts)[real].sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return np.where(real, counts, 0)
    # The table spans any one document.
    span = max(TABLE_WORDS, int(lengths.max()))
    # Python integers: the products may exceed 64 bits.
    even = max(0, budget - span // 2)
    taken[real] = [int(c) * even // total for c in counts[real]]
    rest = budget - int((lengths * taken).sum())
    order = np.random.default_rng([seed, total]).permutation(np.flatnonzero(real))
    for i in order:
        if rest <= span:
            break
        n = min(int(counts[i] - taken[i]), -(-(rest - span) // int(lengths[i])))
        taken[i] += n
        rest -= n * int(lengths[i])
    # reach[w]: the length class whose documents completed a sum of w words first.
    reach = np.full(rest + 1, -1, np.int64)
    reach[0] = len(lengths)
    for i in order:
        size, left = int(lengths[i]), int(counts[i] - taken[i])
        if size > rest or not left:
            continue
        # Sums known before this class; each start can be extended by 1..left documents.
        frontier, n = np.flatnonzero(reach >= 0), 0
        while len(frontier) and n < left:
            frontier = frontier + size
            frontier = frontier[frontier <= rest]
            frontier = frontier[reach[frontier] < 0]
            reach[frontier] = i
            n += 1
        if reach[rest] >= 0:
            break
    best = int(np.flatnonzero(reach >= 0)[-1])
    while best:
        i = int(reach[best])
        taken[i] += 1
        best -= int(lengths[i])
    return taken


def _source_key() -> Column:
    """The source as a string that is never NULL; NULL becomes the empty key."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Add each source's target: shares by weight, none above ``repeats`` times its size.

    ``sources`` has one row per source with ``source_key`` and ``source_size``;
    weights repeat over the sources in the order of their names (code points,
    NULL last).  The excess of limited sources goes to the others by weight until
    none is above.
    """
    named = sources.withColumn("_last", F.col("source_key") == "")
    ranked = global_rank(named, ["_last", "source_key"], "_rank").drop("_last")
    position = (F.col("_rank") % len(weights) + 1).cast("int")
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), position)).drop("_rank")
    cap = F.col("source_size") * F.lit(repeats)
    level = 0.0
    while True:
        # Three sums per round; limited sources stay limited as the level rises.
        limited = cap <= F.lit(level) * F.col("weight")
        row = weighed.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(limited, cap).otherwise(0)).alias("fixed"),
            F.sum(F.when(limited, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        raised = (row["words"] - row["fixed"]) / row["weight"] if row["weight"] else level
        if raised <= level:
            break
        level = raised
    return weighed.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _plan(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _source_plan(pdf, seed)

    return run


def _source_plan(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Whole copies and additional documents by length, for one source."""
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    pdf = pdf.sort_values("size")
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    copies = int(target // size) if size else 1
    more = fit_counts(lengths, counts, round(target) - copies * size, seed)
    return pdf.assign(copies=copies, more=more)[["source_key", "size", "source_size", "target", "n", "copies", "more"]]


def _last_lots(sized: DataFrame, partial: DataFrame) -> DataFrame:
    """Per source and length: the last lot that is taken, how many rows have it (tied) and how many of them are taken (take).

    Large lengths are cut into ranges of lots; counts tell which range holds the
    last one, and only that range is sorted.
    """
    same = ["source_key", "size"]
    ranges = F.ceil(F.col("n") / SORTED_TOGETHER)
    place = F.shiftright(F.shiftrightunsigned("lot", 44) * ranges, 20)
    dealt = sized.join(partial.select(*same, "n", "more"), same).withColumn("range", place)
    counts = dealt.groupBy(*same, "range").agg(F.count(F.lit(1)).alias("here"), F.first("more").alias("more"))
    order = Window.partitionBy(*same).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("here").over(order), F.lit(0)))
    holds = counts.filter("before < more and more <= before + here")
    wanted = holds.select(*same, "range", (F.col("more") - F.col("before")).alias("k"))
    line = Window.partitionBy(*same, "range").orderBy(_lot_order())
    # Equal rows have equal lots; they count before they are ordered.
    lots = dealt.join(wanted, [*same, "range"]).groupBy(*same, "range", "lot").agg(F.count(F.lit(1)).alias("tied"), F.first("k").alias("k"))
    upto = lots.withColumn("upto", F.sum("tied").over(line))
    last = upto.filter("upto - tied < k and k <= upto")
    return last.select(*same, F.col("lot").alias("last_lot"), "tied", (F.col("k") - F.col("upto") + F.col("tied")).alias("take"))


def _lot_order() -> Column:
    # As unsigned numbers, in line with the ranges.
    return F.col("lot").bitwiseXOR(F.lit(-(1 << 63)))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    # Only rows of one id and text share a lot.
    lot = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumns({"source_key": _source_key(), "size": words, "lot": lot})


def mixing_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The sized documents without their texts, and per source and length what the mix takes of them.

    Of a length, all documents are taken ``copies`` times, and once more: all of
    them (``every``), or those with lots before ``last_lot`` and ``take`` of the
    ``tied`` rows that have it.
    """
    sized = _sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), seed).drop("text")
    sized = write_table(sized, "sized")
    histogram = write_table(sized.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sources = histogram.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    both = histogram.join(targets(sources, weights, repeats).drop("weight"), "source_key")
    kind = "source_key string, size long, source_size long, target double, n long, copies long, more long"
    plan = write_table(both.groupBy("source_key").applyInPandas(_plan(seed), kind), "plan")
    cuts = _last_lots(sized.select("source_key", "size", "lot"), plan.filter("0 < more and more < n"))
    out = plan.join(cuts, ["source_key", "size"], "left").withColumn("every", F.col("more") == F.col("n"))
    kept = ["source_key", "size", "source_size", "target", "copies", "every", "last_lot", "tied", "take"]
    return sized, write_table(out.select(*kept), "mix")


def _with_times(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Sized rows with how often each is taken (times)."""
    same = ["source_key", "size"]
    rows = sized.join(plan, same)
    flip = F.lit(-(1 << 63))
    within = F.col("lot").bitwiseXOR(flip) <= F.col("last_lot").bitwiseXOR(flip)
    more = F.col("every") | F.coalesce(within, F.lit(False))
    if plan.filter("take < tied").isEmpty():
        return rows.withColumn("times", F.col("copies") + more.cast("long"))
    # Some lengths end among equal rows: these are numbered part by part of a stored table.
    split = F.coalesce((F.col("lot") == F.col("last_lot")) & (F.col("take") < F.col("tied")), F.lit(False))
    clear = rows.filter(~split).withColumn("times", F.col("copies") + more.cast("long"))
    equal = write_table(rows.filter(split).withColumn("_at", F.monotonically_increasing_id()), "equal-rows")
    equal = equal.withColumn("_part", F.shiftright("_at", 33))
    sizes = equal.groupBy(*same, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*same, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*same, "_part").orderBy("_at"))
    placed = equal.join(before, [*same, "_part"]).withColumn("_place", place)
    times = F.col("copies") + (F.col("_place") <= F.col("take")).cast("long")
    return clear.unionByName(placed.withColumn("times", times).select(*clear.columns))


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED
) -> DataFrame:
    """How often the mix takes every document.

    Returns doc_id, source, size (words), source_size, target, times and taken
    (size x times).

    Defined cases: NULL and empty texts have size 0 and are taken as often as
    whole copies of their source are (once in a source without words, whose
    target is 0); documents with a NULL source form the last source; of equal
    rows (id, source and text) any may be the ones that are taken once more; an
    empty table gives no rows; other columns are ignored.
    """
    sized, plan = mixing_plan(docs, weights, repeats, seed)
    return _with_times(sized, plan).select(
        "doc_id", "source", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED
) -> DataFrame:
    """The documents of the mix with the columns of ``docs``; a document taken twice is two rows.

    Defined cases are those of :func:`mix`; columns of any name are kept as they are.
    """
    plan = mixing_plan(docs, weights, repeats, seed)[1]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", "text")
    sized = _sized(whole, seed).drop("text", "doc_id", "source")
    taken = _with_times(sized, plan).select("row", F.col("times").cast("int").alias("times"))
    copies = taken.filter("times > 0").select("row", F.explode(F.sequence(F.lit(1), "times")))
    return copies.select("row.*")
