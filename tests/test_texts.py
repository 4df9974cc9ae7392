import json
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from samples import (
    FIRST_PARAGRAPH_END,
    FORECAST_LINES,
    LOG_LINES,
    MESSY_HEADER,
    MESSY_RECORDS,
    NAMES,
    prose,
)

from plumbwright.operators import bytecost, chunk, forecast, logs, wrangle
from plumbwright.sources import files
from plumbwright.sources.headers import settings

# -- logs -------------------------------------------------------------------


def parsed(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, line string")
    return logs.parse_lines(df)


def test_traffic_report(spark, rows):
    p = parsed(spark, LOG_LINES + ["", "   "])
    assert p.select("ok").count() == 7
    assert logs.traffic_summary(p).first().asDict() == {
        "total_requests": 6, "malformed_lines": 1, "error_rate_pct": 50.0, "slow_requests": 2,
    }
    assert rows(logs.status_counts(p)) == [(200, 3), (401, 1), (404, 1), (500, 1)]
    assert rows(logs.slowest_endpoints(p, "pos")) == [("/api/orders", 760.0), ("/api/login", 25.0), ("/api/users", 15.0)]
    assert rows(logs.top_talkers(p, "pos")) == [("1.1.1.1", 3), ("2.2.2.2", 2), ("3.3.3.3", 1)]
    assert rows(logs.malformed(p)) == [(5, "not a log line")]


def test_log_report_agrees_with_its_parts(spark, rows):
    p = parsed(spark, LOG_LINES)
    got = sorted(rows(logs.log_report(p, "pos")), key=repr)
    want = [
        ("total_requests", "", None, 6.0), ("malformed_lines", "", None, 1.0),
        ("error_rate_pct", "", None, 50.0), ("slow_requests", "", None, 2.0),
        *[("status_counts", s, None, n) for s, n in (("200", 3.0), ("401", 1.0), ("404", 1.0), ("500", 1.0))],
        *[("slowest_endpoints", p, i + 1, v) for i, (p, v) in enumerate([("/api/orders", 760.0), ("/api/login", 25.0), ("/api/users", 15.0)])],
        *[("top_talkers", ip, i + 1, v) for i, (ip, v) in enumerate([("1.1.1.1", 3.0), ("2.2.2.2", 2.0), ("3.3.3.3", 1.0)])],
    ]
    assert got == sorted(want, key=repr)


def test_log_ties_keep_first_appearance(spark, rows):
    p = parsed(spark, [f'9.9.9.{i} - - [01/Feb/2026:00:00:10] "GET /p{i} HTTP/1.1" 200 1 7' for i in (4, 2, 3, 1)])
    assert rows(logs.top_talkers(p, "pos", 2)) == [("9.9.9.4", 1), ("9.9.9.2", 1)]
    assert rows(logs.slowest_endpoints(p, "pos", 2)) == [("/p4", 7.0), ("/p2", 7.0)]


def test_log_line_edges(spark):
    good = LOG_LINES[0]
    lines = [
        f"\t{good}\xa0", good + "ms trailing", "x " + good, good.replace("1.1.1.1", "999.1.1.1"),
        good.replace("/api/users", "/api/\xa0users"), good.replace(" 342 ", " 99999999999 "), "\ngarbage",
    ]
    got = {r.pos: r for r in parsed(spark, lines).collect()}
    assert [got[i].ok for i in range(7)] == [True, True, False, True, False, True, False]
    assert got[1].ms == 18 and got[5].bytes == 99999999999 and got[0].ts == "10/Jul/2026:13:55:36"


def test_empty_log(spark):
    assert logs.traffic_summary(parsed(spark, [" "])).first().error_rate_pct == 0.0


# -- chunks -----------------------------------------------------------------


def walk(text, size, overlap, prefer=True):
    """Sequential statement of the chunk rule, for comparison."""
    words, ends = [], set()
    for para in re.split(r"\n\s*\n", text.strip()):
        for w in para.split():
            words.append(w)
            if w[-1] in ".!?":
                ends.add(len(words) - 1)
        if para.split():
            ends.add(len(words) - 1)
    out, start, n = [], 0, len(words)
    while start < n:
        hard = min(start + size, n)
        inside = [i for i in ends if start + max(1, int(size * 0.67)) <= i < hard]
        end = max(inside) + 1 if inside and prefer else hard
        out.append((len(out), " ".join(words[start:end]), end - start, start, end))
        if end >= n:
            return out
        start += size - overlap
    return out


def test_chunks_of_a_known_text(spark, rows):
    df = spark.createDataFrame([(1, prose())], "id int, text string")
    got = rows(chunk.chunk_documents(df, ["id"], chunk_size=30, overlap=6).drop("text").orderBy("index"))
    assert got == [(1, 0, 30, 0, 30, 0), (1, 1, 30, 24, 54, 0), (1, 2, 30, 48, 78, 0), (1, 3, 22, 72, 94, 0)]
    assert FIRST_PARAGRAPH_END == 43


def random_text(rng):
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\n \t\n", "\t", "\xa0", "\x1e", "\n\n\n", " \n\n "]
    parts = []
    for _ in range(rng.randrange(0, 90)):
        parts.append(rng.choice("abcde") + rng.choice(["", "", "", ".", "!", "?", ",", ".)"]))
        parts.append(rng.choice(gaps))
    return rng.choice(["", "\n\n", "  "]) + "".join(parts)


@pytest.mark.parametrize("size,overlap,prefer", [(7, 2, True), (10, 9, True), (1, 0, True), (12, 0, False), (60, 10, True)])
def test_chunks_agree_with_a_sequential_walk(spark, size, overlap, prefer):
    rng = random.Random(size)
    docs = [(i, random_text(rng)) for i in range(150)]
    df = spark.createDataFrame(docs, "id int, text string")
    got = {}
    for r in chunk.chunk_documents(df, ["id"], chunk_size=size, overlap=overlap, prefer_boundary=prefer).collect():
        got.setdefault(r.id, []).append((r["index"], r.text, r.word_count, r.start_word, r.end_word))
        assert r.gap_words >= 0
    for i, doc in docs:
        assert sorted(got.get(i, [])) == walk(doc, size, overlap, prefer), repr(doc)


def test_gaps_are_visible_and_avoidable(spark):
    text = " ".join(["a"] * 8 + ["b."] + ["c"] * 40)
    df = spark.createDataFrame([(1, text)], "id int, text string")
    lost = chunk.chunk_documents(df, ["id"], chunk_size=12, overlap=0).agg(F.sum("gap_words"), F.sum("word_count")).first()
    assert tuple(lost) == (3, 46)
    kept = chunk.chunk_documents(df, ["id"], chunk_size=12, overlap=0, prefer_boundary=False)
    assert tuple(kept.agg(F.sum("gap_words"), F.sum("word_count")).first()) == (0, 49)


def test_custom_tokens(spark, rows):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<array<string>>")
    def letters(paragraphs):
        return paragraphs.map(lambda ps: [list(p.replace(" ", "")) for p in ps])

    df = spark.createDataFrame([(1, "ab c\n\nde")], "id int, text string")
    out = chunk.chunk_documents(df, ["id"], chunk_size=4, overlap=1, tokenise=letters)
    assert rows(out.select("text").orderBy("index")) == [("a b c",), ("d e",)]


def test_chunk_arguments(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    for size, overlap in ((5, 5), (5, 6), (5, -1)):
        with pytest.raises(ValueError):
            chunk.chunk_documents(df, ["id"], chunk_size=size, overlap=overlap)


# -- CSV --------------------------------------------------------------------


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


REQUIRED = ["member_id", "age", "monthly_premium"]


def test_wrangle_file(spark, rows, tmp_path):
    path = write(tmp_path, "messy.csv", "\n".join([MESSY_HEADER, *MESSY_RECORDS]) + "\n")
    raw = files.read_csv_records(spark, path)
    clean, rejects = wrangle.wrangle(raw, REQUIRED, irregular="irregular")
    assert [r[0] for r in rows(clean.select(files.json_text(clean, ["lineno"])).orderBy("lineno"))] == [
        '{"age":34,"member_id":101,"monthly_premium":220.5,"name":"Asha Rao"}',
        '{"age":52,"member_id":105,"monthly_premium":240.0,"name":"Elena Cruz"}',
    ]
    assert sorted(m for _, m in rows(rejects)) == [
        "line 3: missing age -> skipped",
        "line 4: missing member_id -> skipped",
        "line 5: missing monthly_premium -> skipped",
    ]
    values = rows(clean.orderBy("lineno").select(*[F.col(c).cast("string") for c in ("member_id", "name", "age", "monthly_premium")]))
    assert values[0][:3] == ("101", "Asha Rao", "34") and float(values[0][3]) == 220.5
    assert values[1][:3] == ("105", "Elena Cruz", "52") and float(values[1][3]) == 240.0


def test_json_round_trip(spark, tmp_path):
    path = write(tmp_path, "messy.csv", "\n".join([MESSY_HEADER, *MESSY_RECORDS]) + "\n")
    clean, _ = wrangle.wrangle(files.read_csv_records(spark, path), [], irregular="irregular")
    clean = clean.drop("lineno")
    out = str(tmp_path / "out.json")
    files.write_json_lines(clean, out)
    assert files.round_trip_differences(clean, out).count() == 0
    assert files.round_trip_differences(clean.limit(4), out).count() == 1


def test_json_array_is_one_array_in_several_parts(spark, tmp_path):
    """The parts in the order of their names load as one array, in the order of the rows."""
    rows = [(i, None if i % 7 == 0 else f'say "{i}"],\n[,') for i in range(500)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(5)
    many, none, one = (str(tmp_path / n) for n in ("many", "none", "one"))
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        files.write_json_array(df, many)
    parts = sorted(p for p in os.listdir(many) if p.startswith("part-"))
    loaded = json.loads("".join(open(f"{many}/{p}", encoding="utf-8").read() for p in parts))
    assert len(parts) > 1 and sorted((r["i"], r["v"]) for r in loaded) == rows
    assert [r["i"] for r in loaded] == [r["i"] for r in df.collect()]
    assert files.round_trip_differences(df, many, array=True).count() == 0
    assert files.round_trip_differences(df.filter("i < 499"), many, array=True).count() == 1
    files.write_json_array(df.limit(0), none)
    files.write_json_array(df.filter("i = 3"), one)
    assert files.read_json_array(spark, none).count() == 0
    assert [json.loads(r["value"])["i"] for r in files.read_json_array(spark, one).collect()] == [3]


def test_required_field_may_be_absent_and_zero_is_present(spark, rows):
    df = spark.createDataFrame([(2, "0", " ")], "lineno long, a string, b string")
    _, rejects = wrangle.wrangle(df, ["c", "b", "a"])
    assert rows(rejects) == [(2, "line 2: missing c, b -> skipped")]


def test_ragged_and_quoted_records(spark, rows, tmp_path):
    body = 'a, b \n1,"x, ""y"""\n2\n3,z,extra\n4,"p,q",r\n5,\n'
    raw = files.read_csv_records(spark, write(tmp_path, "r.csv", body))
    assert rows(raw.orderBy("lineno")) == [
        (2, False, "1", 'x, "y"'), (3, False, "2", None), (4, True, "3", "z"), (5, True, "4", "p,q"), (6, False, "5", None),
    ]
    assert raw.columns == ["lineno", "irregular", "a", "b"]
    clean, rejects = wrangle.wrangle(raw, ["a"], irregular="irregular")
    assert clean.count() == 3
    assert rows(rejects.orderBy("lineno"))[0][1] == "line 4: more cells than header -> skipped"


def test_quoted_line_breaks_need_multi_line(spark, rows, tmp_path):
    path = write(tmp_path, "q.csv", 'a,b\n1,"x\ny"\n2,z\n')
    assert rows(files.read_csv_cells(spark, path, multi_line=True)) == [("1", "x\ny"), ("2", "z")]
    assert [r[0] for r in rows(files.read_csv_records(spark, path, multi_line=True).orderBy("lineno"))] == [2, 3]


def test_ordinals_across_splits_and_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for f in range(3):
        lines = ["id,v"] + [f"{f}-{i},{'x' * (i % 50)}" for i in range(2000)]
        (folder / f"part{f}.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = files.read_csv_records(spark, str(folder)).select("lineno", "id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 6000
    for r in got:
        assert r.lineno == int(r.id.split("-")[1]) + 2


def test_text_lines(spark, rows, tmp_path):
    assert rows(files.read_lines(spark, write(tmp_path, "t.txt", "a\nb\n"))) == [("a",), ("b",)]
    df = spark.createDataFrame([("a\r\nb\x0bc\x85d\n",)], "text string")
    assert [r[1] for r in rows(files.table_lines(df))] == ["a", "b", "c", "d", ""]


# -- forecast ---------------------------------------------------------------


def test_forecast_report(spark, rows):
    df = spark.createDataFrame(list(enumerate([*FORECAST_LINES, "", "  "])), "pos long, line string")
    grid = forecast.parse_table(df)
    good = forecast.forecast_rows(grid)
    s = forecast.forecast_summary(grid).first()
    assert (s.parsed, s.rejected, round(s.avg_hi, 2)) == (17, 1, 90.06)
    assert rows(forecast.forecast_rejects(grid)) == [("Bad Row 999/xx/z 12/9/q",)]
    assert rows(forecast.forecast_extremes(good, "pos")) == [
        ("hottest", "Phoenix", 116), ("coolest", "Anchorage", 67), ("widest", "Seattle", 25),
        ("warming", "Minneapolis", 15), ("cooling", "Seattle", -13),
    ]
    assert rows(forecast.sky_distribution(good, "pos")) == [
        ("sunny", 7), ("t-storms", 6), ("partly cloudy", 3), ("showers", 1),
    ]
    assert good.filter("city = 'New York City'").first().spread == 16


def test_forecast_from_one_text(spark):
    df = spark.createDataFrame([("\n" + "\n".join(FORECAST_LINES) + "\n",)], "text string")
    assert forecast.forecast_summary(forecast.parse_table(files.table_lines(df))).first().parsed == 17


@pytest.mark.parametrize(
    "cell,want",
    [("98/74/T", (98, 74, "t")), (" -5/-9/sn ", (-5, -9, "sn")), ("74/98/t", None), ("98/74/zz", None),
     ("1000/9/s", None), ("98/74", None), ("98/74/t/x", None), ("", None), ("70/70/rs", (70, 70, "rs"))],
)
def test_forecast_cell(spark, cell, want):
    df = spark.createDataFrame([(cell,)], "c string")
    got = forecast.parse_cell(df, "c", "f").first().f
    assert (tuple(got) if got else None) == want


def test_forecast_ties_keep_the_first_city(spark, rows):
    lines = ["A 80/70/s 80/70/s", "B 80/70/s 80/70/s", "x 80/70/s", "80/70/s 80/70/s"]
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, line string")
    good = forecast.forecast_rows(forecast.parse_table(df))
    assert {r[1] for r in rows(forecast.forecast_extremes(good, "pos"))} == {"A"}
    assert good.count() == 2


# -- byte costs -------------------------------------------------------------


def test_byte_costs(spark, rows):
    data = [(*row, i) for i, row in enumerate(NAMES)]
    df = spark.createDataFrame(data, "entity string, market string, text string, pos int")
    costs = bytecost.market_costs(df, "entity", "market", "English", position="pos")
    tesla = {r.market: r.bytes for r in costs.filter("entity = 'Tesla'").collect()}
    assert [tesla[m] for _, m, _ in NAMES[:6]] == [5, 9, 9, 18, 18, 10]
    worst = {r.entity: r for r in bytecost.worst_markets(costs).collect()}
    assert worst["Tesla"].market == "Hindi" and worst["Tesla"].ratio == 3.6
    assert {e: round(w.extra_usd) for e, w in worst.items()} == {"Tesla": 39, "SpaceX": 90, "Neuralink": 72, "xAI": 0}
    assert math.isclose(worst["SpaceX"].ratio, 6.0) and round(worst["Neuralink"].ratio, 2) == 3.67
    assert worst["xAI"].ratio == 1.0
    assert rows(bytecost.byte_summary(df)) == [(24, 9, 15)]
