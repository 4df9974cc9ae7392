"""Whole-registry checks: results against SQL, plan shapes, and invariance."""

import re

import pytest
from check_queries import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from plumbwright.plans import PLANS
from plumbwright.plans.base import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_shape(df):
    """No Python evaluation, no join without keys, no window over all rows in one partition."""
    text = plan_text(df)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        # Partition offsets of a global rank are one row per shuffle partition.
        if re.search(r"\bWindow(GroupLimit)? \[", line) and "windowspecdefinition(_part#" not in line:
            below = " ".join(lines[i + 1 : i + 3])
            assert "SinglePartition" not in below, below


@pytest.mark.parametrize("name", list(PLANS))
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, SMALL, name, inspect=check_shape)
    assert ok, note


def test_every_query_has_sql():
    assert set(PLANS) <= set(entry_module.queries())
    assert set(PLANS) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 7


def explain(df):
    return plan_text(df)


def test_scans_read_only_needed_columns(spark):
    t = Tables(spark, SMALL)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", explain(PLANS["rec_missing_in_target"].build(t)))
    assert schemas and all("o_orderstatus" not in s and "o_totalprice" not in s for s in schemas)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in explain(PLANS["dq_duplicates_composite"].build(t))


def test_amount_filter_reaches_the_scan(spark):
    from plumbwright.operators import relational

    claims = Tables(spark, SMALL)["orders"].withColumnRenamed("o_totalprice", "amount")
    claims = claims.withColumnRenamed("o_orderkey", "claim_id").withColumnRenamed("o_orderpriority", "service")
    assert "LessThanOrEqual(o_totalprice,0.0)" in explain(relational.invalid_amounts(claims))


def test_reconcile_join_reuses_the_aggregates_partitioning(spark):
    text = explain(PLANS["rec_mismatches"].build(Tables(spark, SMALL)))
    assert text.count("Exchange hashpartitioning") == 2


INVARIANT = ["dq_report", "rec_summary", "log_report", "ev_summary", "fx_mode", "fx_robust_part", "sel_split", "dr_tuned", "sg_denoise", "fc_extremes"]


@pytest.mark.parametrize("name", INVARIANT)
def test_result_does_not_depend_on_partitioning(spark, duck, name, monkeypatch):
    """Shuffled input, and 1 or 50 shuffle partitions."""
    from plumbwright.plans import base

    original = base.read_table
    monkeypatch.setattr(base, "read_table", lambda s, f, n: original(s, f, n).orderBy(F.rand(3)).repartition(6))
    for partitions in ("1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            ok, note = compare(spark, duck, SMALL, name)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert ok, (partitions, note)
