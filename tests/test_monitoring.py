import math
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plumbwright.operators import drift, smooth
from plumbwright.streaming import drift as drift_stream
from plumbwright.streaming import logs as log_stream
from plumbwright.streaming.sinks import drain_appends, drain_updates

# -- drift ------------------------------------------------------------------

COLUMNS = ["account_length", "temp_f", "sales", "churn"]
SCHEMA = "batch int, account_length string, temp_f string, sales string, churn string"


def batch(number, n=200, junk=0, celsius=False, text=False, zero=False):
    rng = random.Random(number)
    out = []
    for i in range(n):
        t = rng.gauss(72, 4)
        out.append((
            number,
            "N/A" if i < junk else str(rng.randint(1, 240)),
            f"{(t - 32) * 5 / 9 if celsius else t:.2f}",
            "0" if zero else str(rng.randint(0, 40)),
            rng.choice(["true", "false"]) if text else str(rng.randint(0, 1)),
        ))
    return out


BATCHES = [
    *batch(0), *batch(1), *batch(2, n=1000, junk=3), *batch(3, celsius=True), *batch(4, text=True),
    *batch(5, zero=True), *[(6, *r[1:]) for r in batch(5, zero=True)],
]
INCIDENTS = (3, 4, 6)


def monitored(spark):
    df = spark.createDataFrame(BATCHES, SCHEMA)
    prof = drift.profile(df, COLUMNS, by=["batch"]).cache()
    current, base = prof.filter("batch > 0"), prof.filter("batch = 0")
    strict = drift.violations(current, base, drift.strict_rules())
    tuned = drift.violations(current, base, drift.tuned_rules())
    batches = current.select("batch").distinct().withColumn("real", F.col("batch").isin(*INCIDENTS))
    return prof, strict, tuned, drift.batch_table(batches, ["batch"], strict, tuned)


def test_alarms_and_scores(spark, rows):
    prof, strict, tuned, table = monitored(spark)
    fired = {r.batch: (r.strict, r.tuned) for r in table.collect()}
    assert fired == {1: (False, False), 2: (True, False), 3: (False, True), 4: (True, True), 5: (False, True), 6: (False, True)}
    score = lambda t, c: tuple(round(v, 2) for v in drift.score(t, c, "real").first())
    assert score(table, "strict") == (2, 0.5, 0.33) and score(table, "tuned") == (4, 0.75, 1.0)
    ambiguous = F.col("batch").isin(5, 6)
    assert score(drift.force_choice(table, ambiguous, "tuned", True), "tuned") == (4, 0.75, 1.0)
    assert score(drift.force_choice(table, ambiguous, "tuned", False), "tuned") == (2, 1.0, 0.67)
    first = {r.batch: r.first_strict for r in table.collect()}
    assert first[2] == "account_length: only 99.700% of data is Integral" and first[1] is None
    assert first[4] == "churn: only 0.000% of data is Integral"
    moved = {(r.batch, r["column"]): r.message for r in tuned.collect() if r.rule == "mean_shift"}
    assert moved[5, "sales"].startswith("mean moved 100% (") and moved[5, "sales"].endswith("-> 0.0)")
    a, b = (prof.filter(F.col("batch") == i) for i in (5, 6))
    assert drift.profile_differences(a, b).count() == 0
    assert drift.profile_differences(a, prof.filter("batch = 1")).count() > 0


def test_score_without_alarms_or_incidents(spark):
    t = spark.createDataFrame([(False, False)], "fired boolean, real boolean")
    assert tuple(drift.score(t, "fired", "real").first()) == (0, 0.0, 0.0)


def test_profile_edges(spark, rows):
    cells = spark.createDataFrame([("", "inf"), (" ", "nan"), (None, "1e300"), ("", "x"), ("", "2")], "a string, b string")
    got = {r["column"]: r for r in drift.profile(cells, ["a", "b", "gone"]).collect()}
    assert (got["a"].n, got["a"].completeness, got["a"].integral, got["a"]["mean"], got["a"]["min"]) == (5, 0.0, 0.0, None, None)
    assert got["b"].completeness == 1.0 and got["b"].integral == 0.4 and math.isnan(got["b"]["mean"])
    assert got["gone"].completeness == 0.0
    empty = drift.profile(spark.createDataFrame([], "a string"), ["a"]).first()
    assert (empty.n, empty.completeness, empty["mean"]) == (0, 0.0, None)


def test_negative_rule_ignores_columns_without_numbers(spark, rows):
    base = drift.profile(spark.createDataFrame([("1",)], "a string"), ["a"])
    text = drift.profile(spark.createDataFrame([("x",)], "a string"), ["a"])
    below = drift.profile(spark.createDataFrame([("-1",)], "a string"), ["a"])
    assert [r.rule for r in drift.violations(text, base, drift.strict_rules()).collect()] == ["integral"]
    assert [r.rule for r in drift.violations(below, base, drift.strict_rules()).collect()] == ["non_negative"]


# -- signal filters ---------------------------------------------------------


def centred(values, window, f):
    half = window // 2
    return [f(values[max(0, i - half): i + half + 1]) for i in range(len(values))]


def signal(spark, lengths):
    rng = random.Random(2)
    data = [(s, i * 3, rng.gauss(0, 1)) for s, n in lengths.items() for i in range(n)]
    return data, spark.createDataFrame(data, "s string, i int, v double").repartition(5)


@pytest.mark.parametrize("layout", [{}, {"layout": "blocks", "block_rows": 17}, {"layout": "blocks", "block_rows": 4}])
@pytest.mark.parametrize("window", [5, 4])
def test_filters_agree_in_both_layouts(spark, layout, window):
    data, df = signal(spark, {"a": 60, "b": 1, "c": 33, "d": 2})
    got = {(r.s, r.i): (r.smoothed, r.despiked) for r in smooth.denoise(df, "s", "i", "v", window, **layout).collect()}
    assert len(got) == len(data)
    for s in "abcd":
        points = [(i, v) for t, i, v in data if t == s]
        mean = centred([v for _, v in points], window, statistics.fmean)
        despiked = centred(mean, window, statistics.median)
        for (i, _), m, d in zip(points, mean, despiked):
            assert got[s, i] == pytest.approx((m, d))


def test_median_alone_and_window_limits(spark):
    data, df = signal(spark, {"a": 20})
    got = {r.i: r.filtered for r in smooth.median_filter(df, "s", "i", "v", 3).collect()}
    want = centred([v for _, _, v in data], 3, statistics.median)
    assert [got[i] for _, i, _ in data] == pytest.approx(want)
    with pytest.raises(ValueError):
        smooth.moving_average(df, "s", "i", "v", 0)
    with pytest.raises(ValueError):
        smooth.median_filter(df, "s", "i", "v", -1)
    with pytest.raises(ValueError):
        smooth.denoise(df, "s", "i", "v", 5, layout="blocks", block_rows=3)


def test_snr(spark):
    df = spark.createDataFrame([(3.0, 3.5, 3.0), (4.0, 4.0, 4.0)], "c double, e double, same double")
    row = df.agg(smooth.snr_db(F.col("c"), F.col("e")).alias("a"), smooth.snr_db(F.col("c"), F.col("same")).alias("b")).first()
    assert row.a == pytest.approx(10 * math.log10(25 / 0.25)) and row.b == math.inf


def test_denoising_improves_the_signal(spark):
    rng = random.Random(10)
    data = []
    for i in range(60):
        clean = math.sin(i / 6) * 3
        data.append(("s", i, clean, clean + rng.gauss(0, 0.6) + (6.0 if i % 17 == 0 and i else 0.0)))
    df = spark.createDataFrame(data, "s string, i int, clean double, noisy double")
    gain = smooth.denoise_gain(smooth.denoise(df, "s", "i", "noisy"), "clean", "noisy").first()
    assert gain.gain_db > 3


# -- streams ----------------------------------------------------------------


def line(day, hour, path, status, ms):
    return f'1.1.1.1 - - [{day:02d}/Jul/2026:{hour:02d}:10:00] "GET {path} HTTP/1.1" {status} 5 {ms}'


def feed(spark, tmp_path, parts):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, part in enumerate(parts):
        (folder / f"{i}.txt").write_text("\n".join(part) + "\n")
        # The file source orders files by modification time.
        os.utime(folder / f"{i}.txt", (1_000_000 + i, 1_000_000 + i))
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))
    return lines.withColumnRenamed("value", "line")


def test_log_stream_equals_batch_over_several_batches(spark, tmp_path, rows):
    parts = [
        [line(1, 1, "/a", 200, 10), line(1, 1, "/b", 500, 900), "junk", ""],
        [line(1, 1, "/a", 404, 30), line(1, 2, "/a", 200, 10)],
        [line(1, 2, "/c", 200, 700)],
    ]
    timed = log_stream.timed_records(feed(spark, tmp_path, parts))
    table = drain_updates(log_stream.traffic_windows(timed), ["window"])
    got = sorted((r.window.start.hour, r.total_requests, r.error_rate_pct, r.slow_requests) for r in table.collect())
    assert got == [(1, 3, 66.7, 1), (2, 2, 0.0, 1)]
    paths = drain_updates(log_stream.path_windows(timed), ["window", "path"])
    top = {(r.window.start.hour, r.rank): (r.path, r.avg_ms) for r in log_stream.top_paths(paths, 1).collect()}
    assert top == {(1, 1): ("/b", 900.0), (2, 1): ("/c", 700.0)}


def test_late_lines_are_dropped(spark, tmp_path):
    # A row is judged late against the watermark that the batch before last left.
    on_time = [[line(2, 5, "/a", 200, 1)], [line(2, 9, "/a", 200, 1)], [line(2, 9, "/a", 200, 1)]]
    parts = [*on_time, [line(2, 5, "/late", 200, 1)]]
    timed = log_stream.timed_records(feed(spark, tmp_path, parts), watermark="1 hour")
    table = drain_updates(log_stream.traffic_windows(timed), ["window"])
    assert {r.window.start.hour: r.total_requests for r in table.collect()} == {5: 1, 9: 2}


def test_progress_counts_malformed_and_late_lines(spark, tmp_path):
    parts = [[line(2, 9, "/a", 200, 1), "junk", ""], [line(2, 9, "/a", 200, 1), "more junk"], [line(2, 5, "/late", 200, 1), "x"]]
    timed = log_stream.timed_records(feed(spark, tmp_path, parts), observe="log_lines")
    query = (
        log_stream.status_windows(timed).writeStream.outputMode("update").format("noop")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = [p["observedMetrics"]["log_lines"].asDict() for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["records"] for m in seen) == 3 and sum(m["malformed"] for m in seen) == 3
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_drain_of_nothing_and_resume(spark, tmp_path):
    stream = feed(spark, tmp_path, [["junk"]])
    folder = str(tmp_path / "state")
    timed = log_stream.timed_records(stream)
    assert drain_updates(log_stream.traffic_windows(timed), ["window"], folder=folder).count() == 0
    (tmp_path / "in" / "9.txt").write_text(line(3, 3, "/a", 200, 1) + "\n")
    assert drain_updates(log_stream.traffic_windows(timed), ["window"], folder=folder).count() == 1


def test_drift_stream_equals_batch_and_append_holds_open_windows(spark, tmp_path):
    data = [(f"2026-07-01 {h:02d}:{m:02d}:00", str(m if h != 2 else -m - 1)) for h in range(4) for m in range(0, 60, 10)]
    df = spark.createDataFrame(data, "ts string, v string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    folder = str(tmp_path / "rows")
    df.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(df.schema).parquet(folder)
    base = drift.profile(df.filter("v >= 0"), ["v"])
    profiles = drift_stream.windowed_profile(stream, ["v"], "ts", watermark="0 seconds")
    table = drain_updates(profiles, ["window", "column"])
    zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))
    batch = drift.profile(zoned, ["v"], by=[F.window("ts", "1 hour").alias("window")])
    key = lambda t: sorted((r.window.start, r.n, r["mean"], r["min"]) for r in t.collect())
    assert key(table) == key(batch)
    alarms = drift_stream.drift_monitor(table, base, drift.strict_rules())
    assert {(r.window.start.hour, r.rule) for r in alarms.collect()} == {(2, "non_negative")}

    live = drift_stream.drift_monitor(profiles, base, drift.strict_rules())
    query = (
        live.writeStream.outputMode("append").format("memory").queryName("drift_alarms")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [r.rule for r in spark.table("drift_alarms").collect()] == ["non_negative"]


def test_silent_hours_and_lost_columns_fire_in_the_live_stream(spark, tmp_path):
    """Hours 1 and 2 have no rows; column w is in the baseline only; the clock goes on to hour 5."""
    rows = [(f"2026-07-01 {h:02d}:{m:02d}:00", "1") for h in (0, 3, 4) for m in (5, 35)]
    df = spark.createDataFrame(rows, "ts string, v string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    clock = spark.createDataFrame([(f"2026-07-01 {h:02d}:20:00",) for h in range(6)], "tick string")
    clock = clock.withColumn("tick", F.col("tick").cast("timestamp_ntz"))
    for name, frame in (("rows", df), ("clock", clock)):
        frame.coalesce(1).write.parquet(str(tmp_path / name))
    base = drift.profile(spark.createDataFrame([("1", "2"), ("1", "3")], "v string, w string"), ["v", "w"])
    stream = lambda f, name: spark.readStream.schema(f.schema).parquet(str(tmp_path / name))
    alarms = drift_stream.live_alarms(
        stream(df, "rows"), base, drift.strict_rules(), "ts", stream(clock, "clock"), watermark="0 seconds", beat_time="tick"
    )
    found = {(r.window.start.hour, r["column"], r.rule) for r in drain_appends(alarms).collect()}
    # The last window is still open.
    lost = {(h, "w", rule) for h in range(5) for rule in ("completeness", "integral")}
    silent = {(h, "v", rule) for h in (1, 2) for rule in ("completeness", "integral")}
    assert found == lost | silent
    profiles = drift_stream.windowed_profile(stream(df, "rows"), ["v"], "ts", beats=stream(clock, "clock"), beat_time="tick")
    table = drain_updates(profiles, ["window", "column"])
    assert {r.window.start.hour: r.n for r in table.collect()} == {0: 2, 1: 0, 2: 0, 3: 2, 4: 2, 5: 0}


def test_single_profiles_lose_columns_too(spark):
    df = spark.createDataFrame([("1", "2"), ("3", "4")], "x string, y string")
    base = drift.profile(df, ["x", "y"])
    for current in (drift.profile(df, ["x"]), drift.profile(df.limit(0), ["x"])):
        found = {(r["column"], r["rule"]) for r in drift.violations(current, base, drift.tuned_rules()).collect()}
        assert ("y", "completeness") in found
    assert drift.violations(drift.profile(df, ["x", "y"]), base, drift.tuned_rules()).count() == 0
