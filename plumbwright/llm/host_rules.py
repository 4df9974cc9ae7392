"""Quality rules with verdicts by host.

Rules are measured per document with column expressions only.  Failures are
summed per host; a host's rate of each rule is shrunk toward the rate of all
hosts by a beta prior that is fitted to how much hosts differ.  The verdict on
the host is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.sources.scratch import write_table

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# A host whose shrunk rate of a rule exceeds this loses all its documents.
HOST_LIMIT = 0.5
# Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (2.0, 1e6)


def _once(name: str, value: Column) -> Column:
    """Compute a column once: a generator is not merged into the expressions above it."""
    return F.inline(F.array(F.struct(value.alias(name))))


def measure(docs: DataFrame, *keys: str | Column, text: str = "text") -> DataFrame:
    """Counts over whole texts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Windows of three words are compared by 64-bit hashes within a document.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(*keys, body.alias("text"))
    out = out.select("*", _once("words", F.filter(F.split("text", WHITE), lambda w: w != "")))
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select("*", _once("lines", lines))
    hashes = F.when(
        F.size("words") >= 3,
        F.expr(
            "transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))"
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    out = out.select(
        *[c for c in out.columns if c not in ("text", "words", "lines")],
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _once("hashes", hashes),
    )
    # Only documents with a repeated window sort theirs, with each window's place.
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.when(repeated, F.expr("array_sort(transform(hashes, (h, i) -> struct(h, i)))"))
    out = out.select("*", _once("placed", placed)).drop("hashes")
    # Equal hashes are neighbours: compare the list with itself moved by one.
    same = F.expr("zip_with(slice(placed, 1, size(placed) - 1), slice(placed, 2, size(placed) - 1), (a, b) -> if(a.h = b.h, array(a.i, b.i), array()))")
    out = out.select("*", _once("places", F.array_distinct(F.flatten(same)))).drop("placed")
    covered = F.array_distinct(F.flatten(F.expr("transform(places, i -> array(i, i + 1, i + 2))")))
    return out.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")).withColumn(
        "n_repeat_words", F.when(F.col("places").isNull(), 0).otherwise(F.col("n_repeat_words")).cast("long")
    ).drop("places")


def base_failed() -> Column:
    """Too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Rules that a document fails, over the measured columns."""
    n = F.col("n_words")
    return {
        "base": base_failed(),
        "symbols": F.lit(10) * F.col("n_symbols") > n,
        "lines": F.lit(20) * F.col("n_dup_lines") > n,
        "word_length": (n > 0) & ((F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n)),
    }


def _prior(hosts: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Beta parameters by rule, from the spread of the hosts' rates (method of moments)."""
    n = F.col("n")
    total = F.sum("n")
    aggs = [total.alias("n"), F.count(F.lit(1)).alias("hosts")]
    for r in names:
        aggs += [F.sum(r).alias(r), F.sum(F.col(r) * F.col(r) / n).alias(f"{r}_square")]
    row = hosts.agg(*aggs).first()
    out = {}
    for r in names:
        docs = row["n"] or 0
        if not docs:
            out[r] = (1.0, 1.0)
            continue
        mean = row[r] / docs
        within = mean * (1 - mean)
        # Spread between hosts: all that exceeds what chance gives hosts of these sizes.
        between = row[f"{r}_square"] / docs - mean * mean - within * row["hosts"] / docs
        weight = within / between - 1 if between > 0 else PRIOR_WEIGHT[1]
        weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
        out[r] = (weight * mean, weight * (1 - mean))
    return out


def host_rates(measured: DataFrame, host: str = "host") -> DataFrame:
    """Per host: documents and the shrunk failure rate of every rule."""
    failed = [F.sum(rule.cast("long")).alias(name) for name, rule in rules().items()]
    hosts = write_table(measured.groupBy(host).agg(F.count(F.lit(1)).alias("n"), *failed), "hosts")
    prior = _prior(hosts, list(rules()))
    rates = [((F.col(r) + a) / (F.col("n") + (a + b))).alias(f"{r}_rate") for r, (a, b) in prior.items()]
    return hosts.select(host, "n", *rates)


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Measures and verdicts for every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, host_failed (a shrunk rate of the host is above ``limit``) and
    kept (neither failed).

    Defined cases: NULL and empty texts have no words and fail the base rule;
    documents with a NULL host form one host; a NULL doc_id stays NULL; repeated
    rows count and are returned once per row; an empty table gives no rows;
    other columns are ignored.
    """
    keys = F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host")
    measured = write_table(measure(docs, *keys), "measures")
    rates = host_rates(measured)
    worst = F.greatest(*[F.col(f"{r}_rate") for r in rules()])
    verdicts = rates.select(F.col("host").alias("_host"), (worst > limit).alias("host_failed"))
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("_host")))
    return joined.withColumn("base_failed", base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )
