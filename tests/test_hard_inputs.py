"""Inputs that are long, skewed, empty or oddly named."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from plumbwright.functions import cells, text, vectors
from plumbwright.operators import chunk, drift, logs, ordering, quality, reconcile, regress, relational, selection, smooth, wrangle
from plumbwright.sources import files, scratch
from plumbwright.sources.headers import placed_lines, settings
from plumbwright.streaming import logs as log_stream


@pytest.mark.parametrize("digits", [10, 2_000, 1_000_000])
def test_long_number_cells(spark, digits):
    df = spark.createDataFrame([("7" * digits, "id"), ("7_" * (digits // 2) + "7", "id"), ("7" * digits + "_", "id")], "v string, k string")
    assert quality.range_violations(df, {"v": (0, float("inf"))}).first()["value"] == 1
    stats = drift.profile(df, ["v"]).first()
    assert stats["completeness"] == 1.0
    clean, _ = wrangle.wrangle(df.withColumn("lineno", F.lit(1)), ["v"])
    assert clean.filter(F.col("v").cast("string").rlike("[0-9]")).count() == 3


@pytest.mark.parametrize("raw", ["1__0", "_1", "1_", "1_.5", "1._5", "1e_5", "1_e5", "+_1", "._1", "1e5_"])
def test_stray_underscores_are_no_numbers(spark, raw):
    row = spark.createDataFrame([(raw,)], "v string").select(cells.to_float(F.col("v")), cells.to_int(F.col("v"))).first()
    assert tuple(row) == (None, None)


@pytest.mark.parametrize(
    ("raw", "kind", "value"),
    [
        ("9223372036854775807", "int", "9223372036854775807"),
        ("9223372036854775809", "int", "9223372036854775809"),
        ("-" + "9" * 38, "int", "-" + "9" * 38),
        ("1_" + "0" * 20, "int", "1" + "0" * 20),
        ("9" * 40, "string", "9" * 40),
        ("1e3", "float", "1000.0"),
    ],
)
def test_whole_numbers_keep_their_digits(spark, raw, kind, value):
    row = spark.createDataFrame([(raw,)], "v string").select(cells.coerce_kind(F.col("v")), cells.coerce(F.col("v")).cast("string")).first()
    assert tuple(row) == (kind, value)


def test_quoted_cell_of_a_megabyte_in_wide_and_short_records(spark, tmp_path):
    big = 'x,""' * 250_000
    (tmp_path / "a.csv").write_text(f'id,name\n1,"{big}",more\n2,"{big}"\n3\n')
    got = {r["id"]: r for r in files.read_csv_records(spark, str(tmp_path)).collect()}
    assert [got[k]["irregular"] for k in "123"] == [True, False, False]
    assert got["2"]["name"] == big.replace('""', '"') and got["3"]["name"] is None
    assert [got[k]["lineno"] for k in "123"] == [2, 3, 4]


@pytest.mark.parametrize("read", [files.read_csv_cells, files.read_csv_records])
def test_files_with_another_header_are_refused_where_columns_are_given(spark, tmp_path, read):
    (tmp_path / "a.csv").write_text("id,name\n1,ann\n")
    assert read(spark, str(tmp_path), ["id", "name"]).select("id", "name").first() == ("1", "ann")
    (tmp_path / "b.csv").write_text("name,id\nbob,2\n")
    with pytest.raises(Exception, match="CSV header"):
        read(spark, str(tmp_path), ["id", "name"]).collect()


@pytest.mark.parametrize("in_splits", [False, True])
def test_files_keep_their_own_headers(spark, tmp_path, in_splits):
    """Other orders, missing and further columns, odd file names, an empty file and a quoted header."""
    texts = {
        "a b+c%20.csv": "id,name\n1,ann\n2,\"b, o\"\n", "b.csv": "name,id\ncat,3\n", "c.csv": "id,age\n4,40,more\n\n5\n",
        "d.csv": "", "e.csv": '"name","id"\n"dan ""d""",6\n', "f.csv": "id,name\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    cells = files.read_csv_cells(spark, str(tmp_path), in_splits=in_splits)
    want = {("1", "ann", None), ("2", "b, o", None), ("3", "cat", None), ("4", None, "40"), ("5", None, None), ("6", 'dan "d"', None)}
    assert cells.columns == ["id", "name", "age"] and {tuple(r) for r in cells.collect()} == want
    records = files.read_csv_records(spark, str(tmp_path), in_splits=in_splits)
    got = {r["id"]: (r["lineno"], r["irregular"], r["name"], r["age"]) for r in records.collect()}
    assert got == {
        "1": (2, False, "ann", None), "2": (3, False, "b, o", None), "3": (2, False, "cat", None),
        "4": (2, True, None, "40"), "5": (3, False, None, None), "6": (2, False, 'dan "d"', None),
    }


def test_partition_columns_stay_with_files_of_several_headers(spark, tmp_path):
    for part, text in ((1, "id,v\n1,a\n"), (2, "v,id\nb,2\n")):
        (tmp_path / f"part={part}").mkdir()
        (tmp_path / f"part={part}" / "x.csv").write_text(text)
    got = files.read_csv_cells(spark, str(tmp_path))
    assert {(r["id"], r["v"], r["part"]) for r in got.collect()} == {("1", "a", 1), ("2", "b", 2)}


def test_repeated_names_are_refused_among_several_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,id\n1,2\n")
    (tmp_path / "b.csv").write_text("id,v\n1,2\n")
    with pytest.raises(ValueError, match="repeats"):
        files.read_csv_cells(spark, str(tmp_path))


def cells_with_breaks(rng, break_):
    kinds = ["plain", "", '"quoted"', '"a ""b"" c"', f'"two{break_}lines"', f'"{break_}{break_}"', '"x,y"', 'st"ray', '"' + f"long{break_}" * 20 + '"']
    return rng.choice(kinds)


@pytest.mark.parametrize("break_", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", ["61", "500", "1m"])
def test_quoted_line_breaks_in_splits_equal_multi_line(spark, tmp_path, split_bytes, break_):
    rng = random.Random(split_bytes + break_)
    for f in range(2):
        lines = [f'id,"the{break_}name",note'] + [f"{f}-{i},{cells_with_breaks(rng, break_)},{cells_with_breaks(rng, break_)}" for i in range(20)]
        if f == 1:
            lines = [lines[0], *[x for line in lines[1:] for x in (line, "")]]
        (tmp_path / f"{f}.csv").write_bytes((break_.join(lines) + (break_ if f else "")).encode())
    want = files.read_csv_records(spark, str(tmp_path), multi_line=True)
    names = want.columns
    with settings(spark, {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.openCostInBytes": "0"}):
        got = files.read_csv_records(spark, str(tmp_path), in_splits=True)
        many = len({(r["file"], r["block"]) for r in placed_lines(spark, str(tmp_path)).collect()})
        rows = sorted(tuple(r) for r in got.fillna("").collect())
        alone = sorted(map(tuple, files.read_csv_cells(spark, str(tmp_path), in_splits=True).fillna("").collect()))
    assert got.columns == names and len(rows) == 40
    assert rows == sorted(tuple(r) for r in want.fillna("").collect())
    assert alone == sorted(r[2:] for r in rows)
    assert split_bytes == "1m" or many > 6


def test_a_large_file_with_quoted_breaks_uses_many_tasks(spark, tmp_path):
    n = 40_000
    body = "".join(f'{i},"first {i}\nsecond {"x" * (i % 97)}",end\n' for i in range(n))
    (tmp_path / "big.csv").write_text("id,text,last\n" + body)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "0"}):
        got = files.read_csv_records(spark, str(tmp_path), in_splits=True)
        tasks = placed_lines(spark, str(tmp_path), "\n").rdd.getNumPartitions()
    assert tasks > 30
    wrong = got.filter("NOT (lineno = CAST(id AS bigint) + 2 AND last = 'end' AND text LIKE concat('first ', id, '\\nsecond %'))")
    assert got.count() == n and wrong.count() == 0


def test_keys_may_be_called_n(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "n int, cells string, at int")
    assert quality.key_counts(df, ["n"]).collect() == [("1", 2)]
    assert quality.duplicate_rows(df, ["n"]).first()["value"] == 2
    assert relational.duplicate_rows_by(df, ["n"]).collect() == [(1, 2)]
    assert relational.constraint_violations(df, ["n"], "n").filter("n = 1").count() == 1
    rec = reconcile.reconcile(df, df.filter("n = 1"), ["n", "cells"], ["at"], ["at"])
    assert rec.missing_in_target().collect() == [("2", "c")]
    assert rec.missing_in_target().columns == ["n", "cells"] and rec.summary().first()["matched_keys"] == 2


def test_constant_feature_has_no_weight(spark):
    df = spark.createDataFrame([(float(i), 5.0, 2.0 * i + 1) for i in range(50)], "a double, b double, y double")
    fit = regress.fit_linear(df, ["a", "b"], "y", lr=0.1).first()
    assert fit["weights"][0] == pytest.approx(2) and fit["weights"][1] == 0
    weights, bias = regress.least_squares(df, ["a", "b"], "y")
    assert weights[0] == pytest.approx(2) and bias + 5 * weights[1] == pytest.approx(1)


LINE = '1.2.3.4 - - [{}] "GET /p{} HTTP/1" 200 5 {}'


def test_zone_offsets_huge_numbers_and_unreadable_times(spark, tmp_path):
    lines = [
        LINE.format("01/Jan/2024:10:00:00", 1, 9), LINE.format("01/Jan/2024:10:00:00 +0000", 1, 9),
        LINE.format("01/Jan/2024:12:00:00 +0200", 2, "9" * 30), LINE.format("yesterday", 3, 1), "junk",
    ]
    parsed = logs.parse_lines(spark.createDataFrame([(s,) for s in lines], "line string"))
    assert parsed.agg(F.max("ms")).first()[0] == (1 << 63) - 1
    times = [r[0] for r in logs.records(parsed).select(logs.event_time(F.col("ts"))).collect()]
    assert times[0] == times[1] == times[2] and times[3] is None
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(lines))
    timed = log_stream.timed_records(files.stream_lines(spark, str(tmp_path / "in")), observe="seen")
    query = log_stream.traffic_windows(timed).writeStream.outputMode("update").format("memory").queryName("zones").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("zones").agg(F.sum("total_requests")).first()[0] == 3
    seen = [p["observedMetrics"]["seen"] for p in map(dict, query.recentProgress) if p.get("observedMetrics")]
    totals = {k: sum(s[k] for s in seen) for k in ("records", "unreadable_times", "malformed")}
    assert totals == {"records": 3, "unreadable_times": 1, "malformed": 1}


def test_vanished_column_and_doubtful_baseline(spark):
    df = spark.createDataFrame([("a", "1", "2"), ("b", "3", "4")], "batch string, x string, y string")
    base = drift.profile(df, ["x", "y"])
    found = drift.violations(drift.profile(df, ["x"], by=["batch"]), base, drift.tuned_rules())
    assert {(r["batch"], r["column"], r["rule"]) for r in found.collect()} >= {("a", "y", "completeness"), ("b", "y", "completeness")}
    twice = drift.profile(df, ["x", "y"], by=["batch"])
    with pytest.raises(Exception, match="several rows"):
        drift.violations(drift.profile(df, ["x"], by=["batch"]), twice, drift.strict_rules()).collect()


@pytest.mark.parametrize("layout", [{}, {"layout": "blocks", "block_rows": 3_000}])
def test_mean_of_a_very_long_window(spark, layout):
    rng = random.Random(4)
    values = [None if rng.random() < 0.1 else rng.uniform(-5, 5) for _ in range(7_000)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "s int, i int, v double")
    got = {r["i"]: r["smoothed"] for r in smooth.moving_average(df, "s", "i", "v", 5_001, **layout).collect()}
    for i in (0, 1, 2_499, 2_500, 2_501, 4_000, 6_998, 6_999):
        inside = [v for v in values[max(0, i - 2_500) : i + 2_501] if v is not None]
        assert got[i] == pytest.approx(sum(inside) / len(inside), abs=1e-9)
    alone = spark.createDataFrame([(1, 1, None)], "s int, i int, v double")
    assert smooth.moving_average(alone, "s", "i", "v", 5_001).first()["smoothed"] is None


INF, NAN = float("inf"), float("nan")


def wild(n=800):
    """Ones with values that a running sum never recovers from, and gaps."""
    values = [1.0] * n
    for i, v in {10: INF, 300: NAN, 450: -INF, 460: INF, 600: None, 601: None, 602: None, n - 1: 1e17}.items():
        values[i] = v
    return values


def windows(values, window):
    half = window // 2
    for i in range(len(values)):
        yield [v for v in values[max(0, i - half) : i + half + 1] if v is not None]


def mean(values):
    return sum(values) / len(values) if values else None


def middle(values):
    v = sorted(values, key=lambda x: (math.isnan(x), 0.0 if math.isnan(x) else x))
    return None if not v else v[len(v) // 2] if len(v) % 2 else (v[len(v) // 2 - 1] + v[len(v) // 2]) / 2


def agree(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b or abs(a - b) <= 1e-12 * abs(b)


LAYOUTS = [{}, {"layout": "blocks", "block_rows": 2_600}, {"layout": "blocks", "block_rows": 80_000}]


@pytest.mark.parametrize("window", [1, 2, 3, 17, 101, 103, 129, 5_001])
def test_means_of_wild_values_in_both_layouts(spark, window):
    values = wild()
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)] + [(2, 5, None)], "s int, i int, v double").repartition(3)
    want = [mean(w) for w in windows(values, window)]
    for layout in LAYOUTS:
        got = {(r["s"], r["i"]): r["smoothed"] for r in smooth.moving_average(df, "s", "i", "v", window, **layout).collect()}
        assert got[2, 5] is None
        assert all(agree(got[1, i], w) for i, w in enumerate(want)), layout


@pytest.mark.parametrize("window", [3, 6, 101, 501])
def test_medians_of_wild_values_by_either_way(spark, window):
    """Sorting each window and moving it over small pieces give the same values."""
    values = wild()
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)] + [(2, 5, None)], "s int, i int, v double").repartition(3)
    want = [middle(w) for w in windows(values, window)]
    for layout in LAYOUTS:
        for kind in ({"sorted_window": 10_000}, {"sorted_window": 0}, {"sorted_window": 0, "rows": 50}):
            steps = [("m", smooth.median_of(window, **kind))]
            found = smooth.filter_series(df, "s", "i", "v", steps, **layout)
            assert found.columns == ["s", "i", "v", "m"]
            got = {(r["s"], r["i"]): r["m"] for r in found.collect()}
            assert len(got) == 801 and got[2, 5] is None
            assert all(agree(got[1, i], w) for i, w in enumerate(want)), (layout, kind)


def test_median_of_a_window_longer_than_a_task_may_sort(spark):
    n, window = 120_000, 50_001
    df = spark.range(n).selectExpr("1 AS s", "id AS i", "CAST(id AS double) AS v", "array(id) AS other")
    steps = [("m", smooth.median_of(window, rows=20_000))]
    got = smooth.filter_series(df, "s", "i", "v", steps)
    # In an ascending series the median lies in the middle of what the edges leave of the window.
    half = window // 2
    middle_of = (F.greatest(F.col("i") - half, F.lit(0)) + F.least(F.col("i") + half, F.lit(n - 1))) / 2
    assert got.count() == n and got.filter(F.col("m") != middle_of).count() == 0
    assert got.filter("other[0] != i").count() == 0


def test_selection_among_a_hundred_features(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randint(0, 1) for _ in range(100)]) for i in range(300)]
    rows = [(i, f, f[3] ^ f[64] ^ f[99]) for i, f in rows]
    df = spark.createDataFrame(rows, "id int, f array<int>, label int").withColumn("bits", vectors.pack_parities(F.col("f")))
    scores = selection.bakeoff(df, "id", "bits", "label", [(1,), (3, 64), (3, 64, 99), (0, 99)])
    best = selection.winners(scores).first()
    assert best["cand_id"] == 2 and best["test"] == 1.0
    by_signal = selection.selection_gap(selection.winners(scores).withColumn("signal", F.lit(True)), ["signal"]).first()
    assert by_signal["signal"] and by_signal["n_runs"] == 1


def test_split_sizes(spark):
    from plumbwright.operators.split import assign_splits

    df = spark.range(200).selectExpr("id", "array(1L) AS bits", "1 AS label")
    labelled, _ = assign_splits(df, "id", (0,), 0.1, 0.4)
    sizes = selection.split_sizes(selection.label_counts(labelled, "bits", "label")).first()
    assert (sizes["train_n"], sizes["valid_n"], sizes["test_n"]) == (100, 20, 80)


def test_blank_run_of_a_megabyte_is_linear(spark):
    raw = "a\n\nb" + " " * 1_000_000 + "c"
    df = spark.createDataFrame([(raw,)], "t string")
    df.select(F.size(text.marked_words(text.plain_text(F.col("t"))))).first()
    started = time.time()
    words = df.select(text.marked_words(text.plain_text(F.col("t")))).first()[0]
    assert [w.rstrip(text.PARAGRAPH_MARK) for w in words] == ["a", "b", "c"] and time.time() - started < 10


def test_report_with_a_large_k_cuts_before_the_last_ranking(spark):
    n = 30_000
    lines = spark.range(n).select(F.format_string(LINE.replace("{}", "%s"), F.lit("01/Jan/2024:10:00:00"), "id", F.col("id") % 997).alias("line"), "id")
    report = logs.log_report(logs.parse_lines(lines), "id", k=5_000)
    ranks = [r["rank"] for r in report.filter("section = 'slowest_endpoints'").orderBy("rank").collect()]
    assert ranks == list(range(1, 5_001))
    plan = report._jdf.queryExecution().executedPlan().toString()
    # The first ranking works within slices of the items.
    assert plan.count("pmod(xxhash64(item") >= 1


@pytest.mark.parametrize("partitions", [None, 1, 20])
def test_rank_with_a_skewed_leading_key(spark, partitions):
    df = spark.range(3_000).selectExpr("CASE WHEN id < 2500 THEN 0 ELSE id END AS k", "id AS u").repartition(7)
    got = ordering.global_rank(df, ["k", "u"], partitions=partitions).orderBy("rank").collect()
    assert [r["u"] for r in got] == list(range(3_000)) and [r["rank"] for r in got] == list(range(3_000))


def test_stored_tables_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: str(tmp_path / "shared"))
    kept = scratch.write_table(spark.range(3), "kept")
    with scratch.scratch_tables(spark):
        assert ordering.global_rank(spark.range(5).toDF("u"), ["u"]).count() == 5
        assert len(list((tmp_path / "shared").iterdir())) > 1
    assert len(list((tmp_path / "shared").iterdir())) == 1 and kept.count() == 3


@pytest.mark.parametrize("size, overlap, prefer", [(60, 10, True), (300, 299, True), (700, 0, False), (5, 2, True), (256, 0, True)])
def test_chunks_of_long_documents_equal_the_array_way(spark, size, overlap, prefer):
    rng = random.Random(size)
    marks = ["", "", "", ".", "!", "?", ". ", ".\n\n", " \n \n "]
    texts = [None, "", "  ", "one", " \n\n a. \n\n"]
    texts += [" ".join(f"w{i}{rng.choice(marks)}" for i in range(n)) for n in (1, 59, 255, 256, 257, 512, 513, 2_000)]
    rows = [(i % 4 or None, f"k{i % 2}", t) for i, t in enumerate(texts)] + [(1, "k", texts[-1])] * 2
    df = spark.createDataFrame(rows, "id int, kind string, text string").repartition(4)
    options = {"chunk_size": size, "overlap": overlap, "prefer_boundary": prefer}
    want = chunk.chunk_documents(df, ["id", "kind"], **options)
    got = chunk.chunk_long_documents(df, ["id", "kind"], **options)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    key = lambda frame: sorted(map(str, frame.collect()))
    assert key(got) == key(want)


def test_a_document_of_a_million_words(spark):
    n = 1_200_000
    df = spark.range(1).select("id", F.expr(f"array_join(transform(sequence(1, {n}), i -> concat('w', i % 97, if(i % 31 = 0, '.', ''))), ' ')").alias("text"))
    got = chunk.chunk_long_documents(df, ["id"], chunk_size=100, overlap=20, prefer_boundary=False)
    row = got.agg(F.count("*"), F.sum("word_count"), F.max("end_word"), F.sum("gap_words")).first()
    chunks = 1 + -(-(n - 100) // 80)
    assert tuple(row) == (chunks, n + 20 * (chunks - 1), n, 0)
