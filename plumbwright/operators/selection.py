"""Choosing among parity-rule candidates on a validation split.

Rows are first counted per (run, split, feature bits, label).  That table holds
everything a candidate's score depends on, so candidates are evaluated on the
counts and never against the rows one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field, ratio
from plumbwright.functions.vectors import subset_mask
from plumbwright.operators.split import assign_splits

SPLITS = ("train", "valid", "test")


def label_counts(df: DataFrame, bits: str, label: str, splits: str = "splits") -> DataFrame:
    """Rows per (run, split, bits, label); one shuffle of partial counts."""
    # Outer, although no array is empty: the plain form would filter on the size
    # of the array first and hash every row twice.
    exploded = df.select(
        field(bits).alias("bits"), field(label).cast("bigint").alias("label"), F.inline_outer(field(splits))
    )
    return exploded.groupBy("run", "split", "bits", "label").agg(F.count(F.lit(1)).alias("n"))


def _parity(mask: Sequence[int]) -> str:
    """Parity of the masked bits of the words w0, w1, ..."""
    counts = [f"bit_count(w{i} & {m}L)" for i, m in enumerate(mask) if m]
    return f"({' + '.join(counts) or '0'}) % 2"


def candidate_scores(counts: DataFrame, candidates: Sequence[Sequence[int]]) -> DataFrame:
    """Flip and accuracies of every candidate per run.

    A candidate predicts the parity of its features, flipped when the unflipped
    rule is right on less than half of the training rows.
    """
    # Hits are summed per (run, split) side by side, so rows are not multiplied by candidates.
    masks = [subset_mask(idx) for idx in candidates]
    words = max(map(len, masks), default=0)
    # Words that are not there hold no bits.
    spread = counts.selectExpr("run", "split", "label", "n", *[f"coalesce(get(bits, {w}), 0L) AS w{w}" for w in range(words)])
    # Texts, because hundreds of candidates are slow to build call by call.
    hits = [F.expr(f"sum(IF({_parity(m)} = label, n, 0L))").alias(f"h{i}") for i, m in enumerate(masks)]
    summed = spread.groupBy("run", "split").agg(F.sum("n").alias("n"), *hits)
    listed = F.array(*[F.col(f"h{i}") for i in range(len(masks))])
    long = summed.select("run", "split", "n", F.posexplode(listed).alias("cand_id", "hits"))

    def part(split: str, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("split") == split, F.col(value))), F.lit(0)).alias(f"{split}_{value}")

    per_candidate = long.groupBy("run", "cand_id").agg(*[part(s, v) for s in SPLITS for v in ("n", "hits")])
    flip = F.when(ratio(F.col("train_hits"), F.col("train_n")) >= 0.5, 0).otherwise(1)
    flipped = per_candidate.withColumn("flip", flip)

    def accuracy(split: str) -> Column:
        n, h = F.col(f"{split}_n"), F.col(f"{split}_hits")
        return ratio(F.when(F.col("flip") == 0, h).otherwise(n - h), n).alias(split)

    return flipped.select("run", "cand_id", "flip", *[accuracy(s) for s in SPLITS])


def winners(scores: DataFrame) -> DataFrame:
    """Per run: the best candidate on validation (first on ties) and all its accuracies."""
    best = F.max_by(
        F.struct("cand_id", "flip", *SPLITS), F.struct(F.col("valid"), -F.col("cand_id"))
    )
    picked = scores.groupBy("run").agg(best.alias("w"), F.avg("valid").alias("mean_candidate_valid"))
    return picked.select("run", "w.*", "mean_candidate_valid")


def split_sizes(counts: DataFrame) -> DataFrame:
    """Rows of every split per run, from :func:`label_counts`."""
    sizes = [F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n"))), F.lit(0)).alias(f"{s}_n") for s in SPLITS]
    return counts.groupBy("run").agg(*sizes)


def selection_gap(best: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How much the winners' validation accuracy flatters them, over all runs or per group of runs.

    ``by`` names columns of ``best``, such as whether a run's labels carry a signal.
    """
    return (best.groupBy(*by) if by else best.groupBy()).agg(
        F.avg("valid").alias("mean_valid"),
        F.avg("test").alias("mean_test"),
        F.count_if(F.col("valid") > F.col("test")).alias("optimistic"),
        F.count(F.lit(1)).alias("n_runs"),
    )


def bakeoff(
    df: DataFrame,
    key: str,
    bits: str,
    label: str,
    candidates: Sequence[Sequence[int]],
    seeds: Sequence[int] = (0,),
    valid_frac: float = 0.1,
    test_frac: float = 0.4,
) -> DataFrame:
    """Split, fit, score and return ``candidate_scores`` for every seed."""
    labelled, _ = assign_splits(df, key, seeds, valid_frac, test_frac)
    return candidate_scores(label_counts(labelled, bits, label), candidates)
