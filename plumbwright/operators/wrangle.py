"""Messy CSV rows to typed rows and rejects.

Both outputs are filters over one narrow projection, so neither needs a
shuffle.  Row ordinals come from the reader (see ``sources.files``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import cell, cell_class, coerce_class, field, is_blank, strip_ws
from plumbwright.functions.fixed import REJECT_MESSAGE


def trim_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def missing_fields(df: DataFrame, required: Sequence[str]) -> Column:
    """Names of required fields that are blank or absent, in the given order."""
    return F.array_compact(F.array(*[F.when(is_blank(cell(df, c)), F.lit(c)) for c in required]))


def wrangle(
    df: DataFrame, required: Sequence[str], line: str = "lineno", irregular: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split raw rows into (clean rows of VARIANT cells, rejects with a message).

    ``irregular`` names a boolean column that marks records wider than the
    header; they are rejected with a reason instead of failing the batch.
    """
    control = [c for c in (line, irregular) if c]
    flagged = df.withColumn("_missing", missing_fields(df, required))
    wide = field(irregular) if irregular else F.lit(False)
    good = (F.size("_missing") == 0) & ~wide
    data = [c for c in df.columns if c not in control]
    trimmed = [strip_ws(field(c).cast("string")).alias(f"_s{i}") for i, c in enumerate(data)]
    kept = flagged.filter(good).select(field(line), *trimmed)
    # A generator keeps the classes from being computed again for every use.
    classes = [cell_class(F.col(f"_s{i}")).alias(f"_k{i}") for i in range(len(data))]
    kept = kept.select("*", F.inline(F.array(F.struct(*classes)))) if data else kept
    clean = kept.select(field(line), *[coerce_class(F.col(f"_s{i}"), F.col(f"_k{i}")).alias(c) for i, c in enumerate(data)])
    number = field(line).cast("bigint")
    message = F.when(
        F.size("_missing") > 0,
        F.format_string(REJECT_MESSAGE, number, F.array_join("_missing", ", ")),
    ).otherwise(F.format_string("line %d: more cells than header -> skipped", number))
    rejects = flagged.filter(~good).select(field(line), message.alias("message"))
    return clean, rejects
