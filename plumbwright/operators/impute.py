"""Mode imputation of a categorical column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field, is_missing_literal


def fit_mode(df: DataFrame, column: str) -> DataFrame:
    """One row: ``fill`` (most frequent value, smallest on ties), ``filled``, ``n_rows``.

    Values are counted in two phases and the winner is picked by an aggregate
    over the counts; no task holds the value set.  ``fill`` is NULL when every
    cell is missing, and ``filled`` counts the missing cells either way.
    """
    c = field(column)
    counts = df.groupBy(F.when(~is_missing_literal(c), c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    present = F.col("v").isNotNull()
    return counts.agg(
        F.min_by(F.col("v"), F.when(present, F.struct(-F.col("n"), F.col("v")))).alias("fill"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("filled"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )


def impute_mode(df: DataFrame, column: str, fitted: DataFrame | None = None) -> DataFrame:
    """Replace missing cells by the mode; ``fitted`` reuses a mode learned elsewhere."""
    fill = (fitted if fitted is not None else fit_mode(df, column)).select("fill").scalar()
    c = field(column)
    filled = F.when(is_missing_literal(c), fill).otherwise(c).alias(column)
    return df.select(*[filled if name == column else field(name) for name in df.columns])
