"""Intermediate tables in the shared folder the cluster names.

Jobs that read the same expensive frame more than once write it here first.
The files live on shared storage, so a lost executor costs a re-read, never a
recomputation of the lineage.  Tables stay until ``drop_tables`` removes those
of the session, or the block of ``scratch_tables`` that made them ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
# Folders made, by application.
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; in local mode alone, one below the warehouse if none is named."""
    context = spark.sparkContext
    folder = spark.conf.get(_KEY, None) or context.getConf().get(_KEY) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {_KEY} to a folder that every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_plumbwright"


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Store a frame as Parquet in the shared folder and return a scan of it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, keep: int = 0) -> None:
    """Remove what the session has stored here, but for the first ``keep`` folders."""
    made = _made.get(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in made[keep:]:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    del made[keep:]


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are stored inside the block; read results before it ends."""
    before = len(_made.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        drop_tables(spark, before)
