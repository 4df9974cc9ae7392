"""Min-max and robust (median / IQR) scaling of a numeric column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field
from plumbwright.operators.ordering import order_statistics


def min_max_scale(df: DataFrame, column: str, out: str = "scaled") -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0.5."""
    v = field(column)
    # Scalar subqueries over the same frame; Catalyst merges them into one scan.
    lo, hi = df.agg(F.min(v)).scalar(), df.agg(F.max(v)).scalar()
    scaled = F.when(v.isNotNull(), F.when(hi == lo, F.lit(0.5)).otherwise((v - lo) / (hi - lo)))
    return df.select(*[field(c) for c in df.columns], scaled.alias(out))


def crushed_count(scaled: DataFrame, column: str = "scaled", threshold: float = 0.01) -> DataFrame:
    """How many scaled values lie below the threshold, with the row count."""
    return scaled.agg(F.count_if(field(column) < threshold).alias("crushed"), F.count(F.lit(1)).alias("n_rows"))


@dataclass(frozen=True)
class RobustStats:
    """Order statistics at n//4, n//2 and 3n//4; no interpolation."""

    q1: float | None
    median: float | None
    q3: float | None

    def apply(self, v: Column) -> Column:
        if self.median is None:
            return F.lit(None).cast("double")
        spread = self.q3 - self.q1
        if spread == 0:
            return F.when(v.isNotNull(), F.lit(0.0))
        return (v - F.lit(float(self.median))) / F.lit(float(spread))


def fit_robust(df: DataFrame, column: str) -> RobustStats:
    v = field(column)
    n = df.agg(F.count(v)).first()[0]
    if n == 0:
        return RobustStats(None, None, None)
    return RobustStats(*order_statistics(df, [(v, n // 4), (v, n // 2), (v, (3 * n) // 4)], n))


def robust_scale(df: DataFrame, column: str, out: str = "scaled", stats: RobustStats | None = None) -> DataFrame:
    """Centre on the upper median and divide by the IQR; a zero IQR gives 0.0."""
    stats = stats or fit_robust(df, column)
    return df.withColumn(out, stats.apply(field(column)))
