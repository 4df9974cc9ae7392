"""Parquet tables by name, and the fixed schemas of the claims tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PATIENTS_SCHEMA = "patient_id bigint not null, name string not null, state string not null"
CLAIMS_SCHEMA = (
    "claim_id bigint not null, patient_id bigint, service string not null, "
    "amount double not null, claim_date string not null"
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def build_claims_tables(spark: SparkSession, patients, claims) -> tuple[DataFrame, DataFrame]:
    """Typed patients and claims from rows, registered as temporary views."""
    p = spark.createDataFrame(patients, PATIENTS_SCHEMA)
    c = spark.createDataFrame(claims, CLAIMS_SCHEMA)
    p.createOrReplaceTempView("patients")
    c.createOrReplaceTempView("claims")
    return p, c
