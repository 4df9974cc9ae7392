"""UTF-8 byte cost of text across markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.functions.cells import field
from plumbwright.functions.text import byte_length

PRICE_PER_MILLION = 3.00


def byte_costs(df: DataFrame, text: str = "text") -> DataFrame:
    """Add bytes, characters and whether every character costs one byte."""
    t = field(text)
    return df.withColumns({"bytes": byte_length(t), "chars": F.char_length(t)}).withColumn(
        "one_byte", F.col("bytes") == F.col("chars")
    )


def market_costs(
    df: DataFrame, entity: str, market: str, base_market: str, text: str = "text", position: str | None = None
) -> DataFrame:
    """Bytes per (entity, market) and their ratio to the entity's base market.

    Several texts per entity and market are averaged.  Rows are combined per
    (entity, market) first, so the window per entity sees one row per market.
    """
    pos = field(position) if position else F.lit(0)
    forms = df.groupBy(field(entity).alias("entity"), field(market).alias("market")).agg(
        F.avg(byte_length(field(text))).alias("bytes"), F.min(pos).alias("first_pos")
    )
    base = F.max(F.when(F.col("market") == base_market, F.col("bytes"))).over(Window.partitionBy("entity"))
    return forms.withColumn("base_bytes", base).withColumn("ratio", F.try_divide("bytes", "base_bytes"))


def worst_markets(costs: DataFrame, price: float = PRICE_PER_MILLION) -> DataFrame:
    """Dearest market per entity (first on ties) and USD extra per million mentions."""
    worst = F.max_by(
        F.struct("market", "bytes", "base_bytes", "ratio"), F.struct(F.col("bytes"), -F.col("first_pos"))
    )
    picked = costs.groupBy("entity").agg(worst.alias("w"))
    extra: Column = (F.col("w.bytes") - F.col("w.base_bytes")) * price
    return picked.select("entity", "w.market", "w.bytes", "w.ratio", extra.alias("extra_usd"))


def byte_summary(df: DataFrame, text: str = "text") -> DataFrame:
    """Texts measured, how many cost one byte per character, how many cost more."""
    one = byte_length(field(text)) == F.char_length(field(text))
    return df.agg(
        F.count(field(text)).alias("measured"), F.count_if(one).alias("one_byte"), F.count_if(~one).alias("more")
    )
