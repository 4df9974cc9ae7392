"""One-hot encoding of a categorical column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field

MAX_CATEGORIES = 1_000


def categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(field(column)).distinct().orderBy(field(column))


def fit_categories(df: DataFrame, column: str, max_categories: int = MAX_CATEGORIES) -> list:
    """The sorted category list.  Refuses NULLs and more than ``max_categories``.

    At most one value beyond the limit reaches the driver.
    """
    found = [r[0] for r in df.select(field(column)).distinct().limit(max_categories + 1).collect()]
    if len(found) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories")
    if any(v is None for v in found):
        raise ValueError(f"{column} has NULLs; impute it before encoding")
    return sorted(found)


def one_hot(df: DataFrame, column: str, known: Sequence | None = None) -> tuple[DataFrame, list[str]]:
    """Replace a column by one 0/1 column per category, appended last.

    Values outside ``known`` encode as all zeros.  Only ``None`` refits on the
    frame itself; an empty list means no categories.
    """
    known = fit_categories(df, column) if known is None else known
    names = [f"{column}={value}" for value in known]
    kept = [field(c) for c in df.columns if c != column]
    flags = [field(column).eqNullSafe(F.lit(v)).cast("int").alias(n) for v, n in zip(known, names)]
    return df.select(*kept, *flags), names
