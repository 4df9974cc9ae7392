"""Queries: drift monitoring, signal filters and their streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbwright.operators import drift, smooth
from plumbwright.plans.base import LOG_REGEX, Tables, plan, s_float, s_norm, s_strip, sql
from plumbwright.sources.scratch import write_table
from plumbwright.streaming import drift as drift_stream
from plumbwright.streaming import logs as log_stream
from plumbwright.streaming.sinks import drain_appends, drain_updates

# -- drift ------------------------------------------------------------------

# The columns of the monitored table.
COLUMNS = ("account_length", "temp_f", "sales", "churn")
BASELINE = 0
# Two batches that leave the same trace; only one of them is an incident.
AMBIGUOUS = (5, 6)
_DRIFT = ("v_drift",)


def _profile_sql(key: str, table: str, extra: str = "", n: str = "count(*)") -> str:
    return " UNION ALL ".join(
        f"""SELECT {key}, {i} AS column_no, '{c}' AS "column", {n} AS n, coalesce(count(*) FILTER (WHERE t <> '') / nullif({n}, 0)::double, 0.0) AS completeness,
CASE WHEN count(*) FILTER (WHERE t <> '') = 0 THEN 0.0 ELSE count(*) FILTER (WHERE isfinite(v) AND v = trunc(v)) / (count(*) FILTER (WHERE t <> ''))::double END AS integral,
avg(v) AS mean, min(v) AS min {extra}
FROM (SELECT *, {s_norm(c)} AS t, {s_float(s_norm(c))} AS v FROM {table}) GROUP BY {key}"""
        for i, c in enumerate(COLUMNS)
    )


def _rules_sql(batch: str, current: str) -> dict[str, str]:
    """Violations of both rule sets with their messages."""
    joined = f"""SELECT c.*, b.integral AS bi, b.mean AS bm, b.min AS bmin FROM {current} c JOIN base b ON b."column" = c."column" """
    negative = """SELECT {b}, column_no, "column", 2 AS rule_no, 'non_negative' AS rule, 'is_non_negative violated' AS message
FROM j WHERE bmin >= 0 AND coalesce(min, 0) < 0"""
    share = """SELECT {b}, column_no, "column", {no} AS rule_no, '{stat}' AS rule, {fmt} AS message FROM j WHERE {cond}"""

    def pct(template: str, value: str) -> str:
        return f"printf('{template}', 100.0::double * {value})"

    strict = " UNION ALL ".join(
        [
            share.format(b=batch, no=0, stat="completeness", fmt=pct("completeness %.3f%% < 100%%", "completeness"), cond="completeness < 1"),
            share.format(b=batch, no=1, stat="integral", fmt=pct("only %.3f%% of data is Integral", "integral"), cond="bi = 1 AND integral < 1"),
            negative.format(b=batch),
        ]
    )
    tuned = " UNION ALL ".join(
        [
            share.format(b=batch, no=0, stat="completeness", fmt=pct("completeness %.1f%%", "completeness"), cond="completeness < 0.99"),
            share.format(b=batch, no=1, stat="integral", fmt=pct("only %.1f%% of data is Integral", "integral"), cond="bi = 1 AND integral < 0.99"),
            negative.format(b=batch),
            share.format(
                b=batch, no=3, stat="mean_shift",
                fmt="printf('mean moved %.0f%% (%.1f -> %.1f)', 100.0::double * abs(mean - bm) / abs(bm), bm, mean)",
                cond="bm <> 0 AND mean IS NOT NULL AND abs(mean - bm) / abs(bm) > 0.40",
            ),
        ]
    )
    return {"j": joined, "strict": strict, "tuned": tuned}


_RULES = {
    "prof": _profile_sql("batch", "v_drift", ", bool_or(is_incident) AS is_incident"),
    "base": f"SELECT * FROM prof WHERE batch = {BASELINE}",
    "cur": f"SELECT * FROM prof WHERE batch <> {BASELINE}",
    **_rules_sql("batch", "cur"),
    "batches": """SELECT batch, bool_or(is_incident) AS is_incident,
EXISTS (SELECT 1 FROM strict s WHERE s.batch = cur.batch) AS strict, EXISTS (SELECT 1 FROM tuned s WHERE s.batch = cur.batch) AS tuned,
(SELECT s."column" || ': ' || s.message FROM strict s WHERE s.batch = cur.batch ORDER BY column_no, rule_no LIMIT 1) AS first_strict
FROM cur GROUP BY batch""",
}


def _profile(t: Tables):
    keep = [F.bool_or("is_incident").alias("is_incident")]
    return drift.profile(t["v_drift"].drop("ts"), COLUMNS, by=["batch"], keep=keep)


def _split_profile(t: Tables):
    """Current and baseline profiles; stored, so that the raw rows are scanned once for both."""
    stored = write_table(_profile(t), "profile")
    return stored.filter(F.col("batch") != BASELINE), stored.filter(F.col("batch") == BASELINE)


def _violations(t: Tables, rules):
    current, baseline = _split_profile(t)
    return drift.violations(current, baseline, rules).drop("is_incident")


def _batches(t: Tables):
    current, baseline = _split_profile(t)
    strict = drift.violations(current, baseline, drift.strict_rules())
    tuned = drift.violations(current, baseline, drift.tuned_rules())
    batches = current.select("batch", "is_incident").distinct()
    return drift.batch_table(batches, ["batch"], strict, tuned)


@plan(
    "dr_profile",
    sql(
        """SELECT batch, column_no, "column", n, round(completeness, 9) AS completeness, round(integral, 9) AS integral,
round(mean, 6) AS mean, min FROM prof""",
        _DRIFT,
        **_RULES,
    ),
)
def dr_profile(t: Tables):
    rounded = {"completeness": F.round("completeness", 9), "integral": F.round("integral", 9), "mean": F.round("mean", 6)}
    return _profile(t).drop("is_incident").withColumns(rounded)


@plan("dr_strict", sql("SELECT * FROM strict", _DRIFT, **_RULES))
def dr_strict(t: Tables):
    return _violations(t, drift.strict_rules())


@plan("dr_tuned", sql("SELECT * FROM tuned", _DRIFT, **_RULES))
def dr_tuned(t: Tables):
    return _violations(t, drift.tuned_rules())


@plan("dr_batches", sql("SELECT * FROM batches", _DRIFT, **_RULES))
def dr_batches(t: Tables):
    return _batches(t)


@plan(
    "dr_empty_batch",
    sql(
        f"""SELECT batch, strict, tuned, first_strict FROM batches
UNION ALL SELECT max(batch) + 1, true, true, '{COLUMNS[0]}: completeness 0.000% < 100%' FROM v_drift""",
        _DRIFT,
        **_RULES,
    ),
)
def dr_empty_batch(t: Tables):
    """A listed batch without rows fires both rule sets."""
    current, baseline = _split_profile(t)
    expected = current.select("batch").union(t["v_drift"].agg((F.max("batch") + 1).alias("batch"))).distinct()
    judged = current.unionByName(drift.absent(current, expected, ["batch"], COLUMNS))
    strict = drift.violations(judged, baseline, drift.strict_rules())
    tuned = drift.violations(judged, baseline, drift.tuned_rules())
    return drift.batch_table(expected, ["batch"], strict, tuned)


def _score_sql(name: str, fired: str) -> str:
    return f"""SELECT '{name}' AS detector, count(*) FILTER (WHERE {fired}) AS alarms,
round(coalesce(count(*) FILTER (WHERE {fired} AND is_incident) / nullif(count(*) FILTER (WHERE {fired}), 0)::double, 0.0), 9) AS "precision",
round(coalesce(count(*) FILTER (WHERE {fired} AND is_incident) / nullif(count(*) FILTER (WHERE is_incident), 0)::double, 0.0), 9) AS recall
FROM batches"""


def _scored(batches, name: str, fired: str):
    row = drift.score(batches, fired, "is_incident")
    return row.select(F.lit(name).alias("detector"), "alarms", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@plan("dr_score", sql(f"{_score_sql('strict', 'strict')} UNION ALL {_score_sql('tuned', 'tuned')}", _DRIFT, **_RULES))
def dr_score(t: Tables):
    batches = _batches(t)
    return _scored(batches, "strict", "strict").unionByName(_scored(batches, "tuned", "tuned"))


_FORCED = f"(CASE WHEN batch IN {AMBIGUOUS} THEN {{}} ELSE tuned END)"


@plan(
    "dr_whatif",
    sql(
        f"{_score_sql('fire on both', _FORCED.format('true'))} UNION ALL {_score_sql('quiet on both', _FORCED.format('false'))}",
        _DRIFT,
        **_RULES,
    ),
)
def dr_whatif(t: Tables):
    batches, ambiguous = _batches(t), F.col("batch").isin(*AMBIGUOUS)
    fire = drift.force_choice(batches, ambiguous, "tuned", True)
    quiet = drift.force_choice(batches, ambiguous, "tuned", False)
    return _scored(fire, "fire on both", "tuned").unionByName(_scored(quiet, "quiet on both", "tuned"))


def _stat_sql(s: str) -> str:
    return f"""SELECT a."column", '{s}' AS stat, round(a.{s}::double, 6) AS left_value, round(b.{s}::double, 6) AS right_value
FROM prof a JOIN prof b ON a."column" = b."column" AND a.batch = {AMBIGUOUS[0]} AND b.batch = {AMBIGUOUS[1]}
WHERE a.{s}::double IS DISTINCT FROM b.{s}::double"""


@plan("dr_profile_diff", sql(" UNION ALL ".join(_stat_sql(s) for s in drift.STATS), _DRIFT, **_RULES))
def dr_profile_diff(t: Tables):
    stored = write_table(_profile(t), "profile")
    a, b = (stored.filter(F.col("batch") == i) for i in AMBIGUOUS)
    return drift.profile_differences(a, b).withColumns(
        {"left_value": F.round("left_value", 6), "right_value": F.round("right_value", 6)}
    )


# -- signal filters ---------------------------------------------------------

_SIG = ("v_signal",)
_FRAME = "OVER (PARTITION BY series ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"
_FILTERS = {
    "a": f"SELECT *, avg(noisy) {_FRAME} AS smoothed, median(noisy) {_FRAME} AS filtered FROM v_signal",
    "d": f"SELECT *, median(smoothed) {_FRAME} AS despiked FROM a",
}


@plan("sg_mavg", sql("SELECT series, i, round(smoothed, 9) AS smoothed FROM a", _SIG, **_FILTERS))
def sg_mavg(t: Tables):
    rows = smooth.moving_average(t["v_signal"], "series", "i", "noisy", 5)
    return rows.select("series", "i", F.round("smoothed", 9).alias("smoothed"))


@plan("sg_median", sql("SELECT series, i, round(filtered, 9) AS filtered FROM a", _SIG, **_FILTERS))
def sg_median(t: Tables):
    rows = smooth.median_filter(t["v_signal"], "series", "i", "noisy", 5)
    return rows.select("series", "i", F.round("filtered", 9).alias("filtered"))


@plan("sg_denoise", sql("SELECT series, i, round(smoothed, 9) AS smoothed, round(despiked, 9) AS despiked FROM d", _SIG, **_FILTERS))
def sg_denoise(t: Tables):
    rows = smooth.denoise(t["v_signal"], "series", "i", "noisy")
    return rows.select("series", "i", F.round("smoothed", 9).alias("smoothed"), F.round("despiked", 9).alias("despiked"))


_LONG = "OVER (ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"


@plan(
    "sg_long_series",
    sql(
        f"SELECT i, round(smoothed, 9) AS smoothed, round(median(smoothed) {_LONG}, 9) AS despiked FROM a",
        _SIG,
        a=f"SELECT i, avg(noisy) {_LONG} AS smoothed FROM v_signal",
    ),
)
def sg_long_series(t: Tables):
    """All events as one series, laid out in blocks whatever its length."""
    whole = t["v_signal"].select(F.lit(0).alias("series"), "i", "noisy")
    rows = smooth.denoise(whole, "series", "i", "noisy", layout="blocks", block_rows=4096)
    return rows.select("i", F.round("smoothed", 9).alias("smoothed"), F.round("despiked", 9).alias("despiked"))


_WIDE = "OVER (PARTITION BY series ORDER BY i ROWS BETWEEN 500 PRECEDING AND 500 FOLLOWING)"


@plan("sg_wide", sql(f"SELECT series, i, round(avg(v) {_WIDE}, 9) AS smoothed FROM v_spikes", ("v_spikes",)))
def sg_wide(t: Tables):
    """Means of a long window over values that are missing, infinite or not numbers."""
    rows = smooth.moving_average(t["v_spikes"], "series", "i", "v", 1_001)
    return rows.select("series", "i", F.round("smoothed", 9).alias("smoothed"))


@plan("sg_wide_blocks", sql(f"SELECT series, i, round(avg(v) {_WIDE}, 9) AS smoothed FROM v_spikes", ("v_spikes",)))
def sg_wide_blocks(t: Tables):
    """The same in blocks of the order of all series."""
    rows = smooth.moving_average(t["v_spikes"], "series", "i", "v", 1_001, layout="blocks", block_rows=2_048)
    return rows.select("series", "i", F.round("smoothed", 9).alias("smoothed"))


@plan("sg_wide_median", sql(f"SELECT series, i, median(v) {_WIDE} AS filtered FROM v_spikes", ("v_spikes",)))
def sg_wide_median(t: Tables):
    """Medians of a long window in pieces that are shorter than a series."""
    steps = [("filtered", smooth.median_of(1_001, rows=2_048))]
    return smooth.filter_series(t["v_spikes"], "series", "i", "v", steps).select("series", "i", "filtered")


def _db(estimate: str) -> str:
    return f"10 * log10(sum(clean * clean) / sum((clean - {estimate}) * (clean - {estimate})))"


@plan(
    "sg_snr",
    sql(
        f"""SELECT round(n, 6) AS noisy_db, round(s, 6) AS smoothed_db, round(x, 6) AS despiked_db, round(x - n, 6) AS gain_db
FROM (SELECT {_db('noisy')} AS n, {_db('smoothed')} AS s, {_db('despiked')} AS x FROM d)""",
        _SIG,
        **_FILTERS,
    ),
)
def sg_snr(t: Tables):
    gain = smooth.denoise_gain(smooth.denoise(t["v_signal"], "series", "i", "noisy"), "clean", "noisy")
    return gain.select(*[F.round(c, 6).alias(c) for c in gain.columns])


# -- streams ----------------------------------------------------------------

_HOUR = "yyyy-MM-dd HH"
_TIMED = {
    "g": f"""SELECT regexp_extract({s_strip('line')}, '{LOG_REGEX}', ['ip', 'ts', 'method', 'path', 'status', 'bytes', 'ms']) AS g
FROM v_log_lines WHERE regexp_matches({s_strip('line')}, '{LOG_REGEX}')""",
    "r": """SELECT strftime(strptime(g.ts, '%d/%b/%Y:%H:%M:%S'), '%Y-%m-%d %H') AS hour,
g.path AS path, g.status::int AS status, g.ms::bigint AS ms FROM g""",
}


def _hour():
    return F.date_format("window.start", _HOUR).alias("hour")


def _timed(t: Tables):
    return log_stream.timed_records(t.stream_view("v_log_lines"), "28 days")


@plan(
    "st_log_windows",
    sql(
        """SELECT hour, count(*) AS total_requests,
round_even(100.0::double * count(*) FILTER (WHERE status >= 400) / count(*), 1)::double AS error_rate_pct,
count(*) FILTER (WHERE ms >= 500) AS slow_requests FROM r GROUP BY hour""",
        ("v_log_lines",),
        **_TIMED,
    ),
)
def st_log_windows(t: Tables):
    table = drain_updates(log_stream.traffic_windows(_timed(t)), ["window"], "log-windows")
    return table.select(_hour(), "total_requests", "error_rate_pct", "slow_requests")


@plan("st_log_status", sql("SELECT hour, status, count(*) AS n FROM r GROUP BY hour, status", ("v_log_lines",), **_TIMED))
def st_log_status(t: Tables):
    table = drain_updates(log_stream.status_windows(_timed(t)), ["window", "status"], "log-status")
    return table.select(_hour(), "status", "n")


@plan(
    "st_log_paths",
    sql(
        """SELECT hour, path, round(avg_ms, 6) AS avg_ms, n, rank::int AS rank FROM
(SELECT *, row_number() OVER (PARTITION BY hour ORDER BY avg_ms DESC, path) AS rank
 FROM (SELECT hour, path, avg(ms) AS avg_ms, count(*) AS n FROM r GROUP BY hour, path)) WHERE rank <= 3""",
        ("v_log_lines",),
        **_TIMED,
    ),
)
def st_log_paths(t: Tables):
    table = drain_updates(log_stream.path_windows(_timed(t)), ["window", "path"], "log-paths")
    return log_stream.top_paths(table).select(_hour(), "path", F.round("avg_ms", 6).alias("avg_ms"), "n", "rank")


_WINDOWED = {
    "h": "SELECT *, strftime(ts, '%Y-%m-%d %H') AS hour FROM v_drift",
    "base": f"""SELECT * FROM ({_profile_sql('batch', 'v_drift')}) WHERE batch = {BASELINE}""",
    "cur": _profile_sql("hour", "h"),
    **_rules_sql("hour", "cur"),
}


@plan(
    "st_drift_profile",
    sql(
        """SELECT hour, column_no, "column", n, round(completeness, 9) AS completeness, round(integral, 9) AS integral,
round(mean, 6) AS mean, min FROM cur""",
        _DRIFT,
        **_WINDOWED,
    ),
)
def st_drift_profile(t: Tables):
    profiles = drift_stream.windowed_profile(t.stream_view("v_drift").select("ts", *COLUMNS), COLUMNS, "ts")
    table = drain_updates(profiles, ["window", "column_no", "column"], "drift-profile")
    return table.select(
        _hour(), "column_no", "column", "n", F.round("completeness", 9).alias("completeness"),
        F.round("integral", 9).alias("integral"), F.round("mean", 6).alias("mean"), "min",
    )


@plan("st_drift_monitor", sql("SELECT hour, column_no, \"column\", rule_no, rule FROM tuned", _DRIFT, **_WINDOWED))
def st_drift_monitor(t: Tables):
    profiled = drift.profile(t["v_drift"].drop("ts", "is_incident"), COLUMNS, by=["batch"])
    baseline = write_table(profiled.filter(F.col("batch") == BASELINE), "baseline")
    profiles = drift_stream.windowed_profile(t.stream_view("v_drift").select("ts", *COLUMNS), COLUMNS, "ts")
    latest = drain_updates(profiles, ["window", "column_no", "column"], "drift-profile")
    alarms = drift_stream.drift_monitor(latest, baseline, drift.tuned_rules())
    return alarms.select(_hour(), "column_no", "column", "rule_no", "rule")


# A window is judged when it closes: its end is a watermark's delay behind the last event.
_CLOSED = "(SELECT max(strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H')) FROM v_drift)"


@plan(
    "st_drift_live",
    sql(f'SELECT hour, column_no, "column", rule_no, rule FROM tuned WHERE hour <= {_CLOSED}', _DRIFT, **_WINDOWED),
)
def st_drift_live(t: Tables):
    """The stream itself joined with the stored baseline, in append mode."""
    profiled = drift.profile(t["v_drift"].drop("ts", "is_incident"), COLUMNS, by=["batch"])
    baseline = write_table(profiled.filter(F.col("batch") == BASELINE), "baseline")
    profiles = drift_stream.windowed_profile(t.stream_view("v_drift").select("ts", *COLUMNS), COLUMNS, "ts")
    alarms = drift_stream.drift_monitor(profiles, baseline, drift.tuned_rules())
    return drain_appends(alarms, "drift-live").select(_hour(), "column_no", "column", "rule_no", "rule")


# Every fifth hour the feed is silent, and one of its columns is gone throughout.
_SILENT = "CAST(date_part('hour', ts) AS int) % 5 = 2"
_GONE = "sales"
_SILENCED = {
    "h": f"""SELECT *, {_SILENT} AS silent, strftime(ts, '%Y-%m-%d %H') AS hour FROM v_drift""",
    "fed": f"""SELECT hour, silent, {', '.join(f"CASE WHEN NOT silent THEN {c} END AS {c}" if c != _GONE else f"NULL::varchar AS {c}" for c in COLUMNS)} FROM h""",
    "base": f"""SELECT * FROM ({_profile_sql('batch', 'v_drift')}) WHERE batch = {BASELINE}""",
    "cur": _profile_sql("hour", "fed", n="count(*) FILTER (WHERE NOT silent)"),
    **_rules_sql("hour", "cur"),
}


@plan(
    "st_drift_silent",
    sql(f'SELECT hour, column_no, "column", rule_no, rule FROM tuned WHERE hour <= {_CLOSED}', _DRIFT, **_SILENCED),
)
def st_drift_silent(t: Tables):
    """A feed that falls silent and lacks a column, beside one that goes on."""
    profiled = drift.profile(t["v_drift"].drop("ts", "is_incident"), COLUMNS, by=["batch"])
    baseline = write_table(profiled.filter(F.col("batch") == BASELINE), "baseline")
    feed = t.stream_view("v_drift").filter(f"NOT ({_SILENT})").select("ts", *[c for c in COLUMNS if c != _GONE])
    alarms = drift_stream.live_alarms(feed, baseline, drift.tuned_rules(), "ts", t.stream("events").select("ts"))
    return drain_appends(alarms, "drift-silent").select(_hour(), "column_no", "column", "rule_no", "rule")


@plan(
    "dr_single",
    sql(
        "SELECT column_no, \"column\", rule_no, rule FROM strict",
        _DRIFT,
        base=f"SELECT * FROM ({_profile_sql('batch', 'v_drift')}) WHERE batch = {BASELINE}",
        one=f"SELECT * REPLACE (NULL::varchar AS {_GONE}) FROM v_drift WHERE batch = {BASELINE + 1}",
        cur=f"SELECT * REPLACE (CASE WHEN \"column\" = '{_GONE}' THEN 0 ELSE n END AS n) FROM ({_profile_sql('batch', 'one')})",
        **_rules_sql("batch", "cur"),
    ),
)
def dr_single(t: Tables):
    """One batch profiled alone, without a column of the baseline."""
    rows = t["v_drift"].drop("ts", "is_incident")
    baseline = drift.profile(rows.filter(F.col("batch") == BASELINE), COLUMNS)
    some = [c for c in COLUMNS if c != _GONE]
    current = drift.profile(rows.filter(F.col("batch") == BASELINE + 1).select(*some), some)
    # The columns that are left keep their places in the baseline.
    places = F.create_map(*[F.lit(x) for i, c in enumerate(COLUMNS) for x in (c, i)])
    current = current.withColumn("column_no", places[F.col("column")])
    return drift.violations(current, baseline, drift.strict_rules()).select("column_no", "column", "rule_no", "rule")
