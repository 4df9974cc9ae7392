"""Column quality checks: blanks, duplicate keys, ranges and formats.

All per-row counters of a report share one scan and one aggregate.  Duplicate
detection is the only shuffle: a two-phase count per key, so a key that holds a
large share of the rows is already one partial row per task before it moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import cell, field, full_match, is_blank, melt, normalise, to_float

REPORT_COLUMNS = ("metric", "item", "value")


def out_of_range(c: Column, lo: float, hi: float) -> Column:
    """True for text that is blank, not a number, or outside [lo, hi].

    NaN compares false with both bounds and is therefore in range; Spark sorts
    NaN above every number, so it is excluded explicitly.
    """
    v = to_float(c)
    return v.isNull() | (~F.isnan(v) & ((v < lo) | (v > hi)))


def bad_format(c: Column, pattern: str) -> Column:
    """True when the trimmed cell is not wholly matched; a missing cell is ''."""
    return ~full_match(normalise(c), pattern)


def _one_row(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    aggs = [F.count_if(flag).alias(f"v{i}") for i, (_, _, flag) in enumerate(checks)]
    rows = [(metric, item, F.col(f"v{i}")) for i, (metric, item, _) in enumerate(checks)]
    return melt(df.agg(*aggs), REPORT_COLUMNS, rows)


def _null_checks(df, columns):
    return [("nulls", c, is_blank(cell(df, c))) for c in columns]


def _range_checks(df, ranges):
    return [("range_violations", c, out_of_range(cell(df, c), lo, hi)) for c, (lo, hi) in ranges.items()]


def _format_checks(df, formats):
    return [("format_violations", c, bad_format(cell(df, c), p)) for c, p in formats.items()]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _one_row(df, _null_checks(df, columns))


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return _one_row(df, _range_checks(df, ranges))


def format_violations(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    return _one_row(df, _format_checks(df, formats))


def repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once and their row count ``n``.

    A column that is called ``n`` itself makes the count ``n_``, and so on.
    """
    name = "n"
    while name in columns:
        name += "_"
    counts = df.groupBy(*[field(c) for c in columns]).agg(F.count(F.lit(1)).alias(name))
    return counts.filter(F.col(name) > 1)


def key_counts(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Rows per normalised key that occurs more than once, counted as in :func:`repeated`."""
    return repeated(df.select(*[normalise(cell(df, c)).alias(c) for c in key_columns]), key_columns)


def duplicate_rows(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """How many rows share their key with another row (all of them, not the surplus)."""
    counts = key_counts(df, key_columns)
    total = counts.agg(F.coalesce(F.sum(F.col(counts.columns[-1])), F.lit(0)).alias("v"))
    return melt(total, REPORT_COLUMNS, [("duplicate_rows", ",".join(key_columns), F.col("v"))])


def quality_report(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique_key: Sequence[str] = (),
    ranges: Mapping[str, tuple[float, float]] | None = None,
    formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """All configured checks as long rows (metric, item, value)."""
    checks = [("row_count", "", F.lit(True))]
    checks += _null_checks(df, not_null)
    checks += _range_checks(df, ranges or {})
    checks += _format_checks(df, formats or {})
    report = _one_row(df, checks)
    if unique_key:
        report = report.unionByName(duplicate_rows(df, unique_key))
    return report
