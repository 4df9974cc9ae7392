"""Batch profiles, drift rules and alarm scoring.

A profile is one two-phase aggregate per batch over all columns at once.  The
tables after it hold one row per (batch, column) or per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import cell, field, normalise, number, ratio
from plumbwright.functions.fixed import DRIFT_MESSAGES

STATS = ("n", "completeness", "integral", "mean", "min")


def profile(
    df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = (), keep: Sequence[Column] = (),
    counted: Column | None = None,
) -> DataFrame:
    """Statistics per column, and per batch when ``by`` lists grouping columns.

    ``completeness`` is the filled share of all cells, ``integral`` the share of
    filled cells that are whole numbers; ``mean`` and ``min`` cover the numeric
    cells and are NULL without any.  Without ``by`` an empty frame still yields
    a row per column.  ``keep`` adds batch-level aggregates to the grouping.  Rows
    for which ``counted`` is false keep their batch alive but are none of its rows;
    their profiled cells must be NULL.
    """
    staged = df.select(
        *[field(c) for c in df.columns if c not in columns],
        *[normalise(cell(df, c)).alias(f"_t{i}") for i, c in enumerate(columns)],
    ).withColumns({f"_v{i}": number(F.col(f"_t{i}")) for i in range(len(columns))})
    rows = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    aggs = [rows.alias("_n"), *keep]
    for i in range(len(columns)):
        text, v = F.col(f"_t{i}"), F.col(f"_v{i}")
        # NaN and infinities leave a NaN remainder, so they are not whole numbers.
        aggs += [
            F.count_if(text != "").alias(f"_filled{i}"),
            F.count_if(v % 1 == 0).alias(f"_whole{i}"),
            F.avg(v).alias(f"_mean{i}"),
            F.min(v).alias(f"_min{i}"),
        ]
    wide = (staged.groupBy(*by) if by else staged.groupBy()).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("column_no"),
                F.lit(c).alias("column"),
                F.col("_n").alias("n"),
                ratio(F.col(f"_filled{i}"), F.col("_n")).alias("completeness"),
                ratio(F.col(f"_whole{i}"), F.col(f"_filled{i}")).alias("integral"),
                F.col(f"_mean{i}").alias("mean"),
                F.col(f"_min{i}").alias("min"),
            )
            for i, c in enumerate(columns)
        ]
    )
    kept = [c for c in wide.columns if not c.startswith("_")]
    return wide.select(*kept, F.inline(rows))


def _rule(seq: int, name: str, broken: Column, message: Column) -> Column:
    return F.when(
        broken, F.struct(F.lit(seq).alias("rule_no"), F.lit(name).alias("rule"), message.alias("message"))
    )


def _percent(template: str, share: Column) -> Column:
    return F.format_string(DRIFT_MESSAGES[template], 100.0 * share)


def strict_rules() -> list[Column]:
    """Complete, integral where the baseline was, and non-negative where it was."""
    return [
        _rule(0, "completeness", F.col("completeness") < 1.0, _percent("strict_completeness", F.col("completeness"))),
        _rule(
            1, "integral",
            (F.col("base_integral") == 1.0) & (F.col("integral") < 1.0),
            _percent("strict_integral", F.col("integral")),
        ),
        _negative(),
    ]


def tuned_rules(tol: float = 0.99, mean_shift: float = 0.40) -> list[Column]:
    """The same with a tolerance, and a bound on the relative move of the mean."""
    shift = F.when(
        F.col("base_mean") != 0, F.abs(F.col("mean") - F.col("base_mean")) / F.abs(F.col("base_mean"))
    )
    moved = F.format_string(DRIFT_MESSAGES["mean_shift"], 100.0 * shift, F.col("base_mean"), F.col("mean"))
    return [
        _rule(0, "completeness", F.col("completeness") < tol, _percent("tuned_completeness", F.col("completeness"))),
        _rule(
            1, "integral",
            (F.col("base_integral") == 1.0) & (F.col("integral") < tol),
            _percent("tuned_integral", F.col("integral")),
        ),
        _negative(),
        _rule(3, "mean_shift", shift > mean_shift, moved),
    ]


def _negative() -> Column:
    broken = (F.col("base_min") >= 0) & (F.coalesce(F.col("min"), F.lit(0.0)) < 0)
    return _rule(2, "non_negative", broken, F.lit(DRIFT_MESSAGES["non_negative"]))


def absent(profiles: DataFrame, expected: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Profiles of expected batches that have no rows: nothing is filled, so completeness is 0.

    ``expected`` lists the batches under the names ``by``.  Union the result with
    a finished profile table, so that a feed that has stopped is judged as well;
    other batch columns of the profile are NULL.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("column_no"), F.lit(c).alias("column"), F.lit(0).cast("bigint").alias("n"),
                F.lit(0.0).alias("completeness"), F.lit(0.0).alias("integral"),
                F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("min"),
            )
            for i, c in enumerate(columns)
        ]
    )
    missing = expected.select(*by).distinct().join(profiles.select(*by).distinct(), list(by), "left_anti")
    filled = missing.select(*by, F.inline(rows))
    others = {c: F.lit(None).cast(t) for c, t in profiles.dtypes if c not in filled.columns}
    return filled.withColumns(others).select(*profiles.columns) if others else filled.select(*profiles.columns)


def _vanished(current: DataFrame, baseline: DataFrame, batch: list[str]) -> DataFrame:
    """Columns of the baseline that a batch's profile does not have, with nothing filled."""
    # One row per profiled column, a list fixed by the caller.
    known = baseline.agg(F.collect_list(F.struct("column_no", "column"))).scalar()
    seen = current.groupBy(*batch).agg(F.collect_set("column").alias("_seen")).withColumn("_known", known)
    gone = F.filter("_known", lambda k: ~F.array_contains(F.col("_seen"), k["column"]))
    empty = {"n": F.lit(0).cast("bigint"), "completeness": F.lit(0.0), "integral": F.lit(0.0)}
    empty |= {s: F.lit(None).cast("double") for s in ("mean", "min")}
    return seen.select(*batch, F.inline(gone)).withColumns(empty).select(*current.columns)


def violations(current: DataFrame, baseline: DataFrame, rules: list[Column]) -> DataFrame:
    """One row per broken rule: the profile's batch columns, column, rule and message.

    The baseline must have one row per column.  In a finished table, columns of
    the baseline that a batch lacks are judged as empty, and so are those that a
    profile without batches lacks; a stream's profile has the columns it was
    given, so profile the baseline's there.
    """
    batch = [c for c in current.columns if c not in ("column_no", "column", *STATS)]
    if not current.isStreaming:
        current = current.unionByName(_vanished(current, baseline, batch))
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("the baseline has several rows for a column")).cast("double"))
    base = baseline.groupBy("column").agg(
        F.coalesce(once, F.first("integral")).alias("base_integral"),
        F.first("mean").alias("base_mean"),
        F.first("min").alias("base_min"),
    )
    # The baseline has one row per profiled column, a list fixed by the caller.
    joined = current.join(F.broadcast(base), "column")
    broken = F.inline(F.array_compact(F.array(*rules)))
    return joined.select(*batch, "column_no", "column", broken)


def batch_table(batches: DataFrame, by: Sequence[str], strict: DataFrame, tuned: DataFrame) -> DataFrame:
    """One row per batch: whether each rule set fired and the first strict violation."""
    first = strict.groupBy(*by).agg(
        F.min_by(F.struct("column", "message"), F.struct("column_no", "rule_no")).alias("_f")
    )
    strict_fired = first.select(
        *by, F.lit(True).alias("strict"), F.concat_ws(": ", "_f.column", "_f.message").alias("first_strict")
    )
    tuned_fired = tuned.groupBy(*by).agg(F.lit(True).alias("tuned"))
    table = batches.join(strict_fired, list(by), "left").join(tuned_fired, list(by), "left")
    no = F.lit(False)
    return table.withColumns(
        {"strict": F.coalesce("strict", no), "tuned": F.coalesce("tuned", no)}
    )


def force_choice(batches: DataFrame, ambiguous: Column, fired: str, choice: bool) -> DataFrame:
    """What-if: overwrite the verdict on the batches selected by ``ambiguous``."""
    return batches.withColumn(fired, F.when(ambiguous, F.lit(choice)).otherwise(F.col(fired)))


def score(batches: DataFrame, fired: str, truth: str) -> DataFrame:
    """Alarms, precision and recall of one verdict column."""
    f, t = field(fired), field(truth)
    hits, alarms, real = F.count_if(f & t), F.count_if(f), F.count_if(t)
    return batches.agg(
        alarms.alias("alarms"), ratio(hits, alarms).alias("precision"), ratio(hits, real).alias("recall")
    )


def profile_differences(a: DataFrame, b: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Columns and statistics in which two single-batch profiles differ.

    Sums of doubles depend on the order of the rows, so means count as equal
    within a relative tolerance.
    """
    stats = F.array(
        *[
            F.struct(
                F.lit(s).alias("stat"),
                F.col(f"a.{s}").cast("double").alias("left_value"),
                F.col(f"b.{s}").cast("double").alias("right_value"),
            )
            for s in STATS
        ]
    )
    joined = a.alias("a").join(b.alias("b"), F.col("a.column") == F.col("b.column"), "full_outer")
    long = joined.select(F.coalesce("a.column", "b.column").alias("column"), F.inline(stats))
    x, y = F.col("left_value"), F.col("right_value")
    close = F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y))
    return long.filter(~(x.eqNullSafe(y) | F.coalesce(close, F.lit(False))))
