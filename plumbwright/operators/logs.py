"""Access-log parsing and traffic roll-ups.

A line costs one regex evaluation however many fields are read: a rewrite that
lays the groups out in a separable order and marks the lines it matched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.functions.cells import field, ratio, strip_ws
from plumbwright.functions.fixed import LOG_LINE, LOG_TIME_FORMAT, WHITESPACE_CLASS

_REWRITE = r"(?sU)\A" + LOG_LINE.replace("{ws}", WHITESPACE_CLASS) + r".*\z"
# Slices of the items of a ranking, each cut to its own top k before the last ranking.
SLICES = 64
# A leading line break marks a rewritten line: trimmed input never starts with
# one.  All groups but the timestamp are free of blanks, so it goes last.
_LAYOUT = "\n$1 $3 $4 $5 $6 $7 $2"


def parse_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Replace the line by ``ok`` and its fields; blank lines are dropped, not counted.

    Malformed lines stay in the frame with ``ok`` false, NULL fields and the
    trimmed line in ``raw``.  A generator emits the rows, so that later filters
    apply to its output: a filter over a plain projection would be pushed below
    it and run the parse a second time.
    """
    kept = [field(c) for c in df.columns if c != line]
    staged = df.select(*kept, strip_ws(field(line)).alias("_text"))
    staged = staged.withColumn("_r", F.regexp_replace("_text", _REWRITE, _LAYOUT))
    ok = F.startswith("_r", F.lit("\n"))
    staged = staged.withColumn("_f", F.when(ok, F.split(F.substring("_r", 2, 2**31 - 1), " ", 7)))
    part = [F.col("_f")[i] for i in range(7)]
    size = F.when(part[4] == "-", F.lit("0")).otherwise(part[4])
    fields = F.struct(
        F.col("_f").isNotNull().alias("ok"),
        part[0].alias("ip"),
        part[6].alias("ts"),
        part[1].alias("method"),
        part[2].alias("path"),
        part[3].cast("int").alias("status"),
        _capped(size).alias("bytes"),
        _capped(part[5]).alias("ms"),
        F.when(F.col("_f").isNull(), F.col("_text")).alias("raw"),
    )
    return staged.select(*kept, F.inline(F.when(F.col("_text") != "", F.array(fields))))


def _capped(digits: Column) -> Column:
    """A run of digits as bigint; more than fit count as the largest."""
    return F.coalesce(digits.try_cast("bigint"), F.when(digits.isNotNull(), F.lit((1 << 63) - 1)))


def event_time(ts: Column) -> Column:
    """The textual log time as a timestamp, NULL when it does not parse.

    A zone offset after the time is optional; without one the session's zone holds.
    """
    plain, zoned = (F.try_to_timestamp(ts, F.lit(LOG_TIME_FORMAT + z)) for z in ("", " Z"))
    return F.coalesce(plain, zoned)


def records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("ok").drop("ok", "raw")


def malformed(parsed: DataFrame) -> DataFrame:
    fields = ("ok", "ip", "ts", "method", "path", "status", "bytes", "ms")
    return parsed.filter("not ok").drop(*fields)


def _error() -> Column:
    return F.col("ok") & (F.col("status") >= 400)


def traffic_summary(parsed: DataFrame, slow_ms: int = 500) -> DataFrame:
    """One row: totals, malformed lines, error rate and slow requests."""
    return parsed.agg(
        F.count_if("ok").alias("total_requests"),
        F.count_if(~F.col("ok")).alias("malformed_lines"),
        F.bround(ratio(F.lit(100.0) * F.count_if(_error()), F.count_if("ok")), 1).alias("error_rate_pct"),
        F.count_if(F.col("ok") & (F.col("ms") >= slow_ms)).alias("slow_requests"),
    )


def status_counts(parsed: DataFrame) -> DataFrame:
    return records(parsed).groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy("status")


def slowest_endpoints(parsed: DataFrame, position: str, k: int = 3) -> DataFrame:
    """Paths by mean latency; equal means keep the order of first appearance."""
    means = records(parsed).groupBy("path").agg(F.avg("ms").alias("avg_ms"), F.min(position).alias("_first"))
    return means.orderBy(F.desc("avg_ms"), "_first").limit(k).drop("_first")


def top_talkers(parsed: DataFrame, position: str, k: int = 3) -> DataFrame:
    counts = records(parsed).groupBy("ip").agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def log_report(parsed: DataFrame, position: str, slow_ms: int = 500, k: int = 3) -> DataFrame:
    """The whole traffic report as rows (section, item, rank, value) from one scan.

    Lines are parsed once and fan out into grouping sets that are combined
    before the shuffle.  The per-section top k is a window that drops losing
    groups on the map side.
    """
    flagged = parsed.withColumn("_err", _error())
    total, bad, pos = F.count_if("ok"), F.count_if(~F.col("ok")), F.col(position)
    grouped = flagged.groupingSets(
        [[], [F.col("ok"), F.col("status")], [F.col("ok"), F.col("path")], [F.col("ok"), F.col("ip")]],
        F.col("ok"), F.col("status"), F.col("path"), F.col("ip"),
    ).agg(
        F.grouping_id().alias("_gid"),
        total.alias("_n"),
        bad.alias("_bad"),
        F.count_if("_err").alias("_errors"),
        F.count_if(F.col("ok") & (F.col("ms") >= slow_ms)).alias("_slow"),
        F.avg("ms").alias("_avg"),
        F.min(pos).alias("_first"),
    )
    # grouping_id bits, high to low: ok, status, path, ip (1 = rolled up).
    overall, by_status, by_path, by_ip = 0b1111, 0b0011, 0b0101, 0b0110
    n = F.col("_n").cast("double")

    def entry(section, item, value):
        return F.struct(F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value"))

    gid = F.col("_gid")
    rows = (
        F.when(
            gid == overall,
            F.array(
                entry("total_requests", F.lit(""), n),
                entry("malformed_lines", F.lit(""), F.col("_bad")),
                entry("error_rate_pct", F.lit(""), F.bround(ratio(100.0 * F.col("_errors"), n), 1)),
                entry("slow_requests", F.lit(""), F.col("_slow")),
            ),
        )
        .when(gid == by_status, F.array(entry("status_counts", F.col("status").cast("string"), n)))
        .when(gid == by_path, F.array(entry("slowest_endpoints", F.col("path"), F.col("_avg"))))
        .when(gid == by_ip, F.array(entry("top_talkers", F.col("ip"), n)))
    )
    listed = grouped.filter((gid == overall) | F.col("ok")).select("_first", F.inline(rows))
    # Rows of unranked sections are partitions of their own and always rank first,
    # so one condition keeps them and cuts the ranked sections.  A first round within
    # slices of the items leaves at most k rows a slice for the last one, for any k.
    ranked = F.col("section").isin("slowest_endpoints", "top_talkers")
    slices = F.pmod(F.xxhash64("item"), F.lit(SLICES))
    within = Window.partitionBy("section", F.when(~ranked, F.col("item")), slices).orderBy(F.desc("value"), "_first")
    listed = listed.withColumn("_at", F.row_number().over(within)).filter(F.col("_at") <= k)
    order = Window.partitionBy("section", F.when(~ranked, F.col("item"))).orderBy(F.desc("value"), "_first")
    top = listed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("section", "item", F.when(ranked, F.col("rank")).alias("rank"), "value")
