"""Source-to-target reconciliation on a composite key.

Each side is reduced to one row per key before anything is joined: the row
count of the key and the compared cells of its last row.  The reduction is a
two-phase aggregate, so a key holding a large share of the rows (typically the
blank key) shrinks to one row per task before the shuffle, and the full outer
join that follows sees unique keys on both sides and reuses the aggregates'
partitioning.  Every output below is a projection of that one join; columns an
output does not need are pruned out of the aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import cell, field, normalise
from plumbwright.operators.quality import key_counts
from plumbwright.sources.scratch import write_table


def _key_names(key_columns: Sequence[str]) -> list[str]:
    return [f"_key{i}" for i in range(len(key_columns))]


def last_row_per_key(
    df: DataFrame, key_columns: Sequence[str], compare_columns: Sequence[str], position: Sequence[str]
) -> DataFrame:
    """One row per key: ``n`` rows seen and ``cells`` of the row with the greatest position.

    Key cells are ``_key0``, ``_key1``, ..., so that keys may have any name.
    """
    staged = df.select(
        *[normalise(cell(df, c)).alias(f"_key{i}") for i, c in enumerate(key_columns)],
        F.struct(
            F.lit(True).alias("seen"),
            *[normalise(cell(df, c)).alias(f"c{i}") for i, c in enumerate(compare_columns)],
        ).alias("cells"),
        F.struct(*[field(c).alias(f"p{i}") for i, c in enumerate(position)]).alias("at"),
    )
    return staged.groupBy(*_key_names(key_columns)).agg(
        F.count(F.lit(1)).alias("n"), F.max_by("cells", "at").alias("cells")
    )


@dataclass(frozen=True)
class Reconciliation:
    """The joined keys of two tables and the reports derived from them."""

    pairs: DataFrame
    key_columns: tuple[str, ...]
    compare_columns: tuple[str, ...]

    def materialise(self) -> Reconciliation:
        """Write the join once so that several reports can read it."""
        return Reconciliation(write_table(self.pairs, "reconcile"), self.key_columns, self.compare_columns)

    def _keys(self):
        return [F.col(k).alias(c) for k, c in zip(_key_names(self.key_columns), self.key_columns)]

    def _differences(self):
        candidates = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"source_cells.c{i}").alias("source_value"),
                    F.col(f"target_cells.c{i}").alias("target_value"),
                )
                for i, c in enumerate(self.compare_columns)
            ]
        )
        typed = candidates.cast("array<struct<column:string,source_value:string,target_value:string>>")
        return F.filter(typed, lambda d: d["source_value"] != d["target_value"])

    def _differs(self):
        """True when any compared cell differs."""
        flags = [
            F.col(f"source_cells.c{i}") != F.col(f"target_cells.c{i}") for i in range(len(self.compare_columns))
        ]
        out = F.lit(False)
        for flag in flags:
            out = out | flag
        return out

    def missing_in_target(self) -> DataFrame:
        return self.pairs.filter("n_source is not null and n_target is null").select(*self._keys())

    def missing_in_source(self) -> DataFrame:
        return self.pairs.filter("n_target is not null and n_source is null").select(*self._keys())

    def mismatches(self) -> DataFrame:
        """One row per key and differing column, compared as trimmed text."""
        both = self.pairs.filter("n_source is not null and n_target is not null")
        return both.select(*self._keys(), F.inline(self._differences()))

    def summary(self) -> DataFrame:
        in_both = F.col("n_source").isNotNull() & F.col("n_target").isNotNull()
        totals = self.pairs.agg(
            F.coalesce(F.sum("n_source"), F.lit(0)).alias("source_rows"),
            F.coalesce(F.sum("n_target"), F.lit(0)).alias("target_rows"),
            F.count("n_source").alias("source_keys"),
            F.count_if(in_both).alias("matched_keys"),
            F.count_if(in_both & self._differs()).alias("mismatched_keys"),
            F.count_if(F.col("n_target").isNull()).alias("missing_in_target"),
            F.count_if(F.col("n_source").isNull()).alias("missing_in_source"),
            F.count_if(F.col("n_source") > 1).alias("duplicate_keys_source"),
            F.count_if(F.col("n_target") > 1).alias("duplicate_keys_target"),
        )
        clean = F.lit(100.0) * (F.col("matched_keys") - F.col("mismatched_keys"))
        rate = F.coalesce(F.bround(F.try_divide(clean, F.col("source_keys")), 1), F.lit(0.0))
        return totals.withColumn("match_rate", rate)

    def findings(self) -> DataFrame:
        """Every finding of every kind as tagged rows, from one pass over the join."""
        text, count = F.lit(None).cast("string"), F.lit(None).cast("bigint")

        def tag(kind, n=count, column=text, source=text, target=text):
            return F.struct(
                F.lit(kind).alias("finding"), n.alias("n"), column.alias("column"),
                source.alias("source_value"), target.alias("target_value"),
            )

        in_source, in_target = F.col("n_source").isNotNull(), F.col("n_target").isNotNull()
        single = F.array_compact(
            F.array(
                F.when(in_source & ~in_target, tag("missing_in_target")),
                F.when(in_target & ~in_source, tag("missing_in_source")),
                F.when(F.col("n_source") > 1, tag("duplicate_in_source", n=F.col("n_source"))),
                F.when(F.col("n_target") > 1, tag("duplicate_in_target", n=F.col("n_target"))),
            )
        )
        cells = F.when(in_source & in_target, self._differences()).otherwise(F.array())
        compared = F.transform(
            cells,
            lambda d: tag("mismatch", column=d["column"], source=d["source_value"], target=d["target_value"]),
        )
        return self.pairs.select(*self._keys(), F.inline(F.concat(single, compared)))


def duplicate_keys(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Each key that occurs more than once, with its row count ``n``."""
    return key_counts(df, key_columns)


def reconcile(
    source: DataFrame,
    target: DataFrame,
    key_columns: Sequence[str],
    compare_columns: Sequence[str],
    position: Sequence[str],
) -> Reconciliation:
    """Compare two tables; ``position`` orders rows so the last one per key wins."""

    def side(df, tag):
        reduced = last_row_per_key(df, key_columns, compare_columns, position)
        return reduced.withColumnsRenamed({"n": f"n_{tag}", "cells": f"{tag}_cells"})

    pairs = side(source, "source").join(side(target, "target"), _key_names(key_columns), "full_outer")
    return Reconciliation(pairs, tuple(key_columns), tuple(compare_columns))
