"""The header of every file below a path.

One job reads the first record of each file: a file is one partition, and its
task stops after that record.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# No file is split, and no two share a task, up to this size.
_WHOLE = str(1 << 40)
_FIRST = {
    "spark.sql.files.maxPartitionBytes": _WHOLE,
    "spark.sql.files.openCostInBytes": _WHOLE,
    # Lines that travel to the task before it can stop.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def placed_lines(spark: SparkSession, path: str | list[str], separator: str | None = None) -> DataFrame:
    """Lines (value) with their file and the place in it where their split begins (block)."""
    reader = spark.read.option("lineSep", separator) if separator else spark.read
    where = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return reader.text(path).select("value", *where)


def _first_record(batches):
    import pyarrow as pa

    record, file = None, None
    for batch in batches:
        for line, file, block in zip(*(c.to_pylist() for c in batch.columns)):
            if block:
                return
            record = line if record is None else f"{record}\n{line}"
            # A quoted name may hold line breaks.
            if record.count('"') % 2 == 0:
                yield pa.RecordBatch.from_pydict({"file": [file], "header": [record]})
                return
    if record is not None:
        yield pa.RecordBatch.from_pydict({"file": [file], "header": [record]})


def first_records(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, first record) of every file that is not empty, by file: as many as Spark lists for a scan."""
    found = placed_lines(spark, path).mapInArrow(_first_record, "file string, header string")
    with settings(spark, _FIRST):
        rows = found.collect()
    return sorted((unquote(r["file"]), r["header"]) for r in rows)


def header_groups(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for every different header, in the order of their first files."""
    groups: dict[str, list[str]] = {}
    for file, header in first_records(spark, path):
        groups.setdefault(header.removesuffix("\r").replace("\r\n", "\n"), []).append(file)
    return [(next(csv.reader([h])), files) for h, files in groups.items()]


def below(path: str) -> dict[str, str]:
    """Reader options that keep the partition columns of a folder when its files are named one by one."""
    return {} if any(c in path for c in "*?[{") else {"basePath": path}
