"""Claims reporting and validation queries over patients and claims.

Claims are the large side and may be skewed on ``patient_id``.  They are
aggregated or de-duplicated per patient before a join, so the join sees one row
per patient; only the orphan check joins raw claims, as the left side of an
anti join, which adaptive execution can split when one key dominates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field, melt
from plumbwright.operators.quality import repeated


def spend_per_patient(patients: DataFrame, claims: DataFrame) -> DataFrame:
    """Claim count and rounded total of every patient with claims, largest first."""
    per_patient = claims.groupBy("patient_id").agg(
        F.count("claim_id").alias("n_claims"), F.round(F.sum("amount"), 2).alias("total_amount")
    )
    return (
        per_patient.join(patients, "patient_id")
        .select("name", "state", "n_claims", "total_amount")
        .orderBy(F.desc("total_amount"))
    )


def patients_without_claims(patients: DataFrame, claims: DataFrame) -> DataFrame:
    claimed = claims.select("patient_id").distinct()
    return patients.join(claimed, "patient_id", "left_anti").select("patient_id", "name")


def orphan_claims(patients: DataFrame, claims: DataFrame) -> DataFrame:
    """Claims whose patient does not exist; a claim without a patient is not one."""
    known = claims.filter(F.col("patient_id").isNotNull())
    orphans = known.join(patients.select("patient_id"), "patient_id", "left_anti")
    return orphans.select("claim_id", "patient_id", "service", "amount")


def duplicate_rows_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once; NULLs compare equal."""
    return repeated(df, columns)


def duplicate_claims(claims: DataFrame) -> DataFrame:
    return duplicate_rows_by(claims, ["patient_id", "service", "amount", "claim_date"])


def invalid_amounts(claims: DataFrame) -> DataFrame:
    return claims.filter(F.col("amount") <= 0).select("claim_id", "service", "amount")


def high_spend_states(patients: DataFrame, claims: DataFrame, threshold: float) -> DataFrame:
    """States whose positive claims sum to more than ``threshold``, largest first."""
    per_patient = (
        claims.filter((F.col("amount") > 0) & F.col("patient_id").isNotNull())
        .groupBy("patient_id")
        .agg(F.sum("amount").alias("spend"))
    )
    totals = per_patient.join(patients, "patient_id").groupBy("state").agg(F.sum("spend").alias("total"))
    return (
        totals.filter(F.col("total") > threshold)
        .select("state", F.round("total", 2).alias("state_total"))
        .orderBy(F.desc("state_total"))
    )


def constraint_violations(df: DataFrame, not_null: Sequence[str], primary_key: str) -> DataFrame:
    """NOT NULL and primary-key breaches as rows (constraint, column, n)."""
    nulls = df.agg(*[F.count_if(field(c).isNull()).alias(f"v{i}") for i, c in enumerate(not_null)])
    null_rows = [("not_null", c, F.col(f"v{i}")) for i, c in enumerate(not_null)]
    again = duplicate_rows_by(df.filter(field(primary_key).isNotNull()), [primary_key])
    surplus = again.agg(F.coalesce(F.sum(F.col(again.columns[-1]) - 1), F.lit(0)).alias("v"))
    names = ("constraint", "column", "n")
    return melt(nulls, names, null_rows).unionByName(
        melt(surplus, names, [("primary_key", primary_key, F.col("v"))])
    )
