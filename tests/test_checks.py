import pytest
from pyspark.sql import functions as F
from samples import CLAIMS, EMAIL_PATTERN, PATIENTS, QUALITY_ROWS, SOURCE_ROWS, TARGET_ROWS

from plumbwright.operators import quality, relational
from plumbwright.operators.reconcile import duplicate_keys, reconcile
from plumbwright.sources.tables import build_claims_tables


def test_quality_report(spark, rows):
    df = spark.createDataFrame(QUALITY_ROWS, "id string, email string, age string")
    got = rows(
        quality.quality_report(df, ["id", "email", "age"], ["id"], {"age": (0, 120)}, {"email": EMAIL_PATTERN})
    )
    assert got == [
        ("row_count", "", 3), ("nulls", "id", 0), ("nulls", "email", 0), ("nulls", "age", 1),
        ("range_violations", "age", 2), ("format_violations", "email", 1), ("duplicate_rows", "id", 2),
    ]


def test_quality_without_a_key_has_no_duplicate_row(spark, rows):
    df = spark.createDataFrame(QUALITY_ROWS, "id string, email string, age string")
    assert rows(quality.quality_report(df)) == [("row_count", "", 3)]


def test_quality_edges(spark, rows):
    cells = ["nan", "inf", "-inf", "1_0", "1d", "0x10", " 5\n", "\xa07\xa0", "121", None, ""]
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    # inf, -inf, 1d, 0x10, 121, NULL and blank violate; nan compares false both ways
    assert rows(quality.range_violations(df, {"v": (0, 120)})) == [("range_violations", "v", 7)]
    assert rows(quality.null_counts(df, ["v", "absent"])) == [("nulls", "v", 2), ("nulls", "absent", 11)]


def test_quality_of_an_empty_table(spark, rows):
    df = spark.createDataFrame([], "id string")
    assert rows(quality.quality_report(df, ["id"], ["id"])) == [
        ("row_count", "", 0), ("nulls", "id", 0), ("duplicate_rows", "id", 0),
    ]


def test_duplicate_keys_fold_blank_and_null(spark, rows):
    df = spark.createDataFrame([("a ", 1), (" a", 1), (None, 2), ("  ", 2), ("b", 3)], "k string, n int")
    assert sorted(rows(duplicate_keys(df, ["k"]))) == [("", 2), ("a", 2)]


def _reconciled(spark):
    columns = "claim_id string, member_id string, amount string, status string, pos long"
    source = spark.createDataFrame([(*r, i) for i, r in enumerate(SOURCE_ROWS)], columns)
    target = spark.createDataFrame([(*r, i) for i, r in enumerate(TARGET_ROWS)], columns)
    return source, target, reconcile(source, target, ["claim_id"], ["member_id", "amount", "status"], ["pos"])


@pytest.mark.parametrize("stored", [False, True])
def test_reconcile(spark, rows, stored):
    source, target, rec = _reconciled(spark)
    rec = rec.materialise() if stored else rec
    assert rows(rec.missing_in_target()) == [("C3",)]
    assert rows(rec.missing_in_source()) == [("C4",)]
    assert rows(rec.mismatches()) == [("C2", "status", "PAID", "PENDING")]
    assert rows(duplicate_keys(source, ["claim_id"])) == [("C3", 2)]
    assert rows(duplicate_keys(target, ["claim_id"])) == []
    assert rec.summary().first().asDict() == {
        "source_rows": 4, "target_rows": 3, "source_keys": 3, "matched_keys": 2, "mismatched_keys": 1,
        "missing_in_target": 1, "missing_in_source": 1, "duplicate_keys_source": 1, "duplicate_keys_target": 0,
        "match_rate": 33.3,
    }
    assert sorted(r[1] for r in rows(rec.findings())) == [
        "duplicate_in_source", "mismatch", "missing_in_source", "missing_in_target",
    ]


def test_reconcile_last_row_wins_and_compares_text(spark, rows):
    s = spark.createDataFrame([("k", "1", 0), ("k", "2.0", 1), (None, "x", 2)], "k string, v string, pos long")
    t = spark.createDataFrame([("k ", "2.00", 0), ("", "x", 1)], "k string, v string, pos long")
    rec = reconcile(s, t, ["k"], ["v"], ["pos"])
    assert rows(rec.mismatches()) == [("k", "v", "2.0", "2.00")]
    assert rec.summary().first().match_rate == 50.0


def test_reconcile_of_empty_source(spark):
    s = spark.createDataFrame([], "k string, v string, pos long")
    t = spark.createDataFrame([("k", "1", 0)], "k string, v string, pos long")
    assert reconcile(s, t, ["k"], ["v"], ["pos"]).summary().first().match_rate == 0.0


def test_relational(spark, rows):
    p, c = build_claims_tables(spark, PATIENTS, CLAIMS)
    assert rows(relational.spend_per_patient(p, c)) == [
        ("Chen Wei", "GA", 2, 1859.99), ("Asha Rao", "GA", 2, 660.5), ("Ben Ortiz", "TX", 2, 250.0),
    ]
    assert rows(relational.patients_without_claims(p, c)) == [(4, "Dana Smith")]
    assert rows(relational.orphan_claims(p, c)) == [(105, 99, "Office Visit", 130.0)]
    assert rows(relational.duplicate_claims(c)) == [(2, "Office Visit", 125.0, "2026-07-03", 2)]
    assert rows(relational.invalid_amounts(c)) == [(107, "Lab Panel", -40.0)]
    assert rows(relational.high_spend_states(p, c, 300)) == [("GA", 2560.49)]
    assert rows(relational.constraint_violations(c, ["amount"], "claim_id")) == [
        ("not_null", "amount", 0), ("primary_key", "claim_id", 0),
    ]
    assert spark.sql("select count(*) from claims join patients using (patient_id)").first()[0] == 6


def test_orphans_ignore_null_patients_on_either_side(spark, rows):
    p = spark.createDataFrame([(1, "a", "X"), (None, "b", "Y")], "patient_id long, name string, state string")
    c = spark.createDataFrame(
        [(1, None, "s", 1.0), (2, 1, "s", 1.0), (3, 7, "s", 1.0)],
        "claim_id long, patient_id long, service string, amount double",
    )
    assert rows(relational.orphan_claims(p, c)) == [(3, 7, "s", 1.0)]


def test_high_spend_compares_the_unrounded_sum(spark, rows):
    p = spark.createDataFrame([(1, "a", "X")], "patient_id long, name string, state string")
    c = spark.createDataFrame([(1, 1, "s", 300.001)], "claim_id long, patient_id long, service string, amount double")
    assert rows(relational.high_spend_states(p, c, 300)) == [("X", 300.0)]
    assert rows(relational.high_spend_states(p, c, 300.001)) == []


def test_column_names_with_dots(spark, rows):
    df = spark.createDataFrame([("x", "")], "`a.b` string, c string").withColumn("c", F.lit(" "))
    assert rows(quality.null_counts(df, ["a.b", "c"])) == [("nulls", "a.b", 0), ("nulls", "c", 1)]


def test_reconcile_without_compared_columns(spark, rows):
    s = spark.createDataFrame([("a", 0), ("b", 1)], "k string, pos long")
    rec = reconcile(s, s.filter("k = 'a'"), ["k"], [], ["pos"])
    assert rows(rec.mismatches()) == [] and rec.summary().first().match_rate == 50.0
    assert [r[1] for r in rows(rec.findings())] == ["missing_in_target"]


def test_a_key_that_holds_a_third_of_all_rows(spark, rows):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "  ").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
        F.col("id").alias("pos"),
    )
    rec = reconcile(df, df.filter("pos < 29997"), ["k"], ["v"], ["pos"])
    # The blank key keeps its last row on each side: 29997 and 29994.
    assert rows(rec.mismatches()) == [("", "v", "29997", "29994")]
    s = rec.summary().first()
    assert (s.source_rows, s.source_keys, s.missing_in_target, s.duplicate_keys_source) == (n, 20001, 2, 1)
    assert rows(quality.duplicate_rows(df, ["k"])) == [("duplicate_rows", "k", 10000)]
