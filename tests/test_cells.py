import math

import pytest
from pyspark.sql import functions as F

from plumbwright.functions import cells, text, vectors


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "c string").select(build(F.col("c")).alias("r")).first()[0]


def python_float(s):
    try:
        return float(s.strip())
    except ValueError:
        return None


FLOATS = [
    "12", "12.0", " 12.5 ", "1e3", "-.5", "5.", "+7", "1_000", "1__0", "_1", "1_", "1d", "1f", "0x1p3", "0x10",
    "nan", "NaN", "-nan", "inf", "-Infinity", "infin", "1e400", "", " ", "abc", "1 2", "12\n", "\xa012\xa0",
    "\x1c3\x1f", "1e", "e5", ".", "1.5e-3", "1_0.2_5e1_0", "--1",
]


def test_to_float_agrees_with_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(FLOATS)], "i int, c string")
    got = {r.i: r.v for r in df.select("i", cells.to_float(F.col("c")).alias("v")).collect()}
    for i, s in enumerate(FLOATS):
        want = python_float(s)
        if want is not None and math.isnan(want):
            assert math.isnan(got[i]), s
        else:
            assert got[i] == want, repr(s)


@pytest.mark.parametrize("s", ["12", "+5", " 1_000 ", "007", "12.0", "1e3", "", "abc", "_1", "-3", "1__0"])
def test_to_int_agrees_with_python(spark, s):
    try:
        want = int(s)
    except ValueError:
        want = None
    assert one(spark, s, cells.to_int) == want


def test_int_beyond_bigint_keeps_its_digits(spark):
    big = "9" * 25
    assert one(spark, big, cells.to_int) is None
    assert one(spark, big, cells.coerce_kind) == "int"


def test_strip_matches_python_for_every_whitespace_character(spark):
    blanks = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    others = ["​", "﻿", "᠎", "\x00"]
    data = [(f"{w}a b{w}", "a b") for w in blanks] + [(f"{w}a{w}", f"{w}a{w}") for w in others]
    df = spark.createDataFrame(data, "c string, want string")
    assert df.filter(cells.strip_ws(F.col("c")) != F.col("want")).count() == 0


def test_word_split_matches_python_for_every_whitespace_character(spark):
    blanks = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    df = spark.createDataFrame([(f"a{w}{w}b​c",) for w in blanks], "c string")
    got = {tuple(r[0]) for r in df.select(text.words(F.col("c"))).collect()}
    assert got == {("a", "b​c")}


def test_three_notions_of_missing_differ(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("NA",), (" NA ",), ("?",)], "c string")
    c = F.col("c")
    got = df.select(cells.is_blank(c), cells.is_missing_literal(c), cells.coerce(c).isNull()).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True), (True, True, True), (True, False, True),
        (False, True, False), (False, False, False), (False, True, False),
    ]


def test_coerce_renders_types_in_json(spark):
    values = ["12", " 1.50 ", "x", "", None, "nan", "1e3", "1d"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(F.to_json(F.struct(cells.coerce(F.col("c")).alias("v")), {"ignoreNullFields": "false"})).collect()]
    assert got == [
        '{"v":12}', '{"v":1.5}', '{"v":"x"}', '{"v":null}', '{"v":null}', '{"v":"nan"}', '{"v":1000.0}', '{"v":"1d"}',
    ]


def test_full_match_refuses_a_trailing_newline(spark):
    assert one(spark, "abc\n", lambda c: cells.full_match(c, "[a-z]+")) is False
    assert one(spark, "abc", lambda c: cells.full_match(c, "ab|abc")) is True


def test_sentences_and_units(spark):
    doc = " One two. Three!  Four?\nFive.six \n \n\nSeven eight\n\nNine. "
    assert one(spark, doc, text.sentences) == ["One two.", "Three!", "Four?", "Five.six \n \n\nSeven eight\n\nNine."]
    assert one(spark, doc, text.units) == ["One two.", "Three!", "Four?", "Five.six", "Seven eight", "Nine."]
    assert one(spark, "  ", text.sentences) == []


def test_vectors(spark):
    df = spark.createDataFrame([(6, [1, 0, 1]), (1023, [2, 3, -1])], "n int, f array<int>")
    row = df.select(
        vectors.bit_features(F.col("n")), vectors.pack_parities(F.col("f")),
        vectors.parity_predict(vectors.pack_parities(F.col("f")), [0, 2], 1),
        vectors.vector_add(F.col("f"), F.col("f")), vectors.vector_set(F.col("f"), 0, 5),
    ).collect()
    assert tuple(row[0]) == ([0, 1, 1, 0, 0, 0, 0, 0, 0, 0], [0b101], 1, [2, 0, 2], [5, 0, 1])
    assert tuple(row[1]) == ([1] * 10, [0b110], 0, [4, 6, -2], [5, 3, -1])


def test_number_labels(spark):
    df = spark.range(1, 16).select(vectors.decode_class(F.col("id"), vectors.number_class(F.col("id"))).alias("v"))
    want = ["FizzBuzz" if n % 15 == 0 else "Buzz" if n % 5 == 0 else "Fizz" if n % 3 == 0 else str(n) for n in range(1, 16)]
    assert [r.v for r in df.collect()] == want


def test_describe(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0],), ([4.0],)], "v array<float>")
    got = {tuple(r) for r in vectors.describe(df, "v").collect()}
    assert got == {(2, 1, "array<float>", 1), (1, 1, "array<float>", 2)}
