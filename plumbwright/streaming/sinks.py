"""Running a bounded stream into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plumbwright.functions.cells import field
from plumbwright.sources.scratch import new_folder


def _drain(stream: DataFrame, mode: str, name: str, folder: str | None) -> str:
    """Process everything available; returns the folder with one part per micro-batch."""
    spark = stream.sparkSession
    folder = folder or new_folder(spark, name)
    out, progress = f"{folder}/rows", f"{folder}/progress"
    # An empty first part gives the result a readable folder when no data arrives.
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{out}/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return out


def drain_appends(stream: DataFrame, name: str = "stream", folder: str | None = None) -> DataFrame:
    """Process everything available in append mode: rows that are final.

    Micro-batches and ``folder`` are as in :func:`drain_updates`.
    """
    out = _drain(stream, "append", name, folder)
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    return stream.sparkSession.read.schema(schema).parquet(out).drop("batch")


def drain_updates(
    stream: DataFrame, keys: Sequence[str], name: str = "stream", folder: str | None = None
) -> DataFrame:
    """Process everything available in update mode; the last value per key wins.

    Each micro-batch goes to its own folder, which is overwritten when the batch
    is replayed after a failure, so a retry leaves one copy of its rows.  Pass
    the same ``folder`` again to resume where an earlier run stopped.
    """
    out = _drain(stream, "update", name, folder)
    values = [c for c in stream.columns if c not in keys]
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    updates = stream.sparkSession.read.schema(schema).parquet(out)
    latest = updates.groupBy(*[field(k) for k in keys]).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(*[field(k) for k in keys], "v.*")
