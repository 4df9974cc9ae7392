"""Forecast grid lines ('City hi/lo/sky hi/lo/sky') to typed rows and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions import text as T
from plumbwright.functions.cells import field, melt, strip_ws
from plumbwright.functions.fixed import FORECAST_CELL, SKY


def sky_text(code: Column) -> Column:
    """The legend text of a sky code, NULL for an unknown code."""
    legend = F.create_map(*[F.lit(x) for pair in SKY.items() for x in pair])
    return F.try_element_at(legend, code)


def _cell_parts(token: Column) -> Column:
    """The three texts of a well-shaped cell, NULL for any other token."""
    t = F.lower(strip_ws(token))
    return F.when(t.rlike(rf"\A{FORECAST_CELL}\z"), F.split(t, "/"))


def _forecast(parts: Column) -> Column:
    """Struct (hi, lo, sky), NULL for an unknown sky code or lo > hi."""
    hi, lo, sky = parts[0].cast("int"), parts[1].cast("int"), parts[2]
    valid = sky.isin(*SKY) & (lo <= hi)
    return F.when(valid, F.struct(hi.alias("hi"), lo.alias("lo"), sky.alias("sky")))


def parse_cell(df: DataFrame, token: str, out: str) -> DataFrame:
    """Add the forecast struct of one cell token, NULL when it is malformed."""
    staged = df.withColumn("_parts", _cell_parts(field(token)))
    return staged.withColumn(out, _forecast(F.col("_parts"))).drop("_parts")


def parse_table(df: DataFrame, line: str = "line") -> DataFrame:
    """Replace the line by ``ok``, ``raw``, ``city``, ``today`` and ``next_day``.

    The last two tokens are cells and the rest is the city; blank lines are
    dropped and every other bad line stays with ``ok`` false.  Each step is its
    own projection and a generator emits the rows, so tokens are cut and cells
    matched once per line whatever is filtered later.
    """
    kept = [field(c) for c in df.columns if c != line]
    staged = df.select(*kept, strip_ws(field(line)).alias("raw")).withColumn("_t", T.words(F.col("raw")))
    enough = F.size("_t") >= 3
    staged = staged.withColumns(
        {
            "_city": F.when(enough, F.array_join(F.slice("_t", 1, F.size("_t") - 2), " ")),
            "_a": F.when(enough, _cell_parts(F.try_element_at("_t", F.lit(-2)))),
            "_b": F.when(enough, _cell_parts(F.try_element_at("_t", F.lit(-1)))),
        }
    ).withColumns({"_today": _forecast(F.col("_a")), "_next": _forecast(F.col("_b"))})
    ok = F.col("_today").isNotNull() & F.col("_next").isNotNull()
    row = F.struct(
        ok.alias("ok"),
        F.col("raw"),
        F.col("_city").alias("city"),
        F.col("_today").alias("today"),
        F.col("_next").alias("next_day"),
    )
    return staged.select(*kept, F.inline(F.when(F.col("raw") != "", F.array(row))))


def forecast_rows(parsed: DataFrame) -> DataFrame:
    """Good rows with the derived ``spread`` of today and ``hi_change``."""
    return (
        parsed.filter("ok")
        .withColumn("spread", F.col("today.hi") - F.col("today.lo"))
        .withColumn("hi_change", F.col("next_day.hi") - F.col("today.hi"))
        .drop("ok", "raw")
    )


def forecast_rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter("not ok").select("raw")


def forecast_summary(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count_if("ok").alias("parsed"),
        F.count_if(~F.col("ok")).alias("rejected"),
        F.avg(F.when(F.col("ok"), F.col("today.hi"))).alias("avg_hi"),
    )


def forecast_extremes(rows: DataFrame, position: str) -> DataFrame:
    """Hottest, coolest, widest, most warming and most cooling city in one pass.

    Equal values keep the row that comes first by ``position``.
    """
    pos = field(position)
    value = {
        "hottest": F.col("today.hi"),
        "coolest": F.col("today.hi"),
        "widest": F.col("spread"),
        "warming": F.col("hi_change"),
        "cooling": F.col("hi_change"),
    }
    lowest = {"coolest", "cooling"}
    picks = []
    for name, v in value.items():
        pick = F.struct(F.col("city").alias("city"), v.alias("value"))
        if name in lowest:
            picks.append(F.min_by(pick, F.struct(v, pos)).alias(name))
        else:
            picks.append(F.max_by(pick, F.struct(v, -pos)).alias(name))
    long = [(name, F.col(f"{name}.city"), F.col(f"{name}.value")) for name in value]
    return melt(rows.agg(*picks), ("metric", "city", "value"), long)


def sky_distribution(rows: DataFrame, position: str) -> DataFrame:
    """Cities per sky text today, most common first, ties by first appearance."""
    counts = rows.groupBy(sky_text(F.col("today.sky")).alias("sky")).agg(
        F.count(F.lit(1)).alias("n"), F.min(position).alias("_first")
    )
    return counts.orderBy(F.desc("n"), "_first").drop("_first")
