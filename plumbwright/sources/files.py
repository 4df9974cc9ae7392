"""Text file sources and the JSON sink.

Raw CSV stays all-text; typing happens in expressions.  Files are read in
splits.  Quoted line breaks need ``multi_line``, which makes each file one task,
or ``in_splits``, which keeps the splits and reads the lines twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plumbwright.functions import text as T
from plumbwright.functions.cells import field
from plumbwright.sources.headers import below, header_groups
from plumbwright.sources.quoted import quoted_records
from plumbwright.sources.scratch import write_table

_CORRUPT = "_corrupt_record"
# Split tables up to this many rows (some 100 bytes each) are broadcast.
BROADCAST_SPLITS = 200_000
FIRST_RECORD_LINE = 2  # the header is line 1


def _csv(spark: SparkSession, multi_line: bool):
    # With enforceSchema off, a file whose header differs from the expected columns fails
    # the read instead of putting its cells under other names.
    return spark.read.options(
        header=True, quote='"', escape='"', multiLine=multi_line, encoding="UTF-8", enforceSchema=False
    )


def _by_header(spark: SparkSession, path: str, columns: Sequence[str] | None, in_splits: bool, read) -> DataFrame | None:
    """Files read by groups of one header and united by the names, or None where one plain read will do.

    ``read`` takes names, files and further reader options.
    """
    if columns is not None and not in_splits:
        return None
    groups = header_groups(spark, path)
    if len(groups) < 2 and not (in_splits and groups):
        return None
    for names, _ in groups:
        if columns is not None and list(columns) != names:
            raise ValueError(f"CSV header {names} is not {list(columns)}")
        if len({n.strip() for n in names}) < len(names):
            raise ValueError(f"CSV header {names} repeats a name")
    frames = [read(names, some, below(path)) for names, some in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _parsed(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records of :func:`quoted_records` without the header, as ordinal, cells and the text of odd records."""
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*columns, _CORRUPT))
    row = F.from_csv("record", schema, {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": _CORRUPT})
    return records.filter("ordinal > 0").select("ordinal", F.inline(F.array(row)))


def _wide(columns: Sequence[str]) -> Column:
    """Whether a record has more cells than columns."""
    # Only records whose cell count is off carry their text; quoted parts hold no separators.
    bare = F.regexp_replace(F.col(_CORRUPT), '"[^"]*"', "")
    cells = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.coalesce(cells > len(columns), F.lit(False)).alias("irregular")


def read_csv_cells(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = False, in_splits: bool = False
) -> DataFrame:
    """All cells as text under the header's names; short rows end in NULLs.

    A small job reads the header of every file; files whose header has other
    names, or the same in another order, are read by their own one and united by
    the names.  Passing ``columns`` saves that job; then every file must have
    exactly this header, and another one is an error when the file is read.

    ``multi_line`` and ``in_splits`` read quoted line breaks (see above); the
    latter leaves partition columns of the folder out.
    """

    def plain(names: Sequence[str], place: str | list[str], options: dict[str, str]) -> DataFrame:
        schema = StructType([StructField(c, StringType()) for c in names])
        return _csv(spark, multi_line).options(**options).schema(schema).csv(place)

    def split(names: Sequence[str], place: list[str], options: dict[str, str]) -> DataFrame:
        return _parsed(quoted_records(spark, place), names).select(*[field(c) for c in names])

    united = _by_header(spark, path, columns, in_splits, split if in_splits else plain)
    if united is not None:
        return united
    return plain(_csv(spark, multi_line).csv(path).columns if columns is None else columns, path, {})


def read_csv_records(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = False, in_splits: bool = False
) -> DataFrame:
    """Text cells plus ``lineno`` (record ordinal, header = 1) and ``irregular``.

    ``irregular`` marks records with more cells than their file's header.  The
    ordinal counts records per file, so a quoted line break does not advance it.
    Headers and options are as in :func:`read_csv_cells`, which also is the reader
    for callers that need no ordinals.
    """

    def finished(numbered: DataFrame, names: Sequence[str]) -> DataFrame:
        return numbered.select("lineno", _wide(names), *[field(c).alias(c.strip()) for c in names])

    def plain(names: Sequence[str], place: str | list[str], options: dict[str, str]) -> DataFrame:
        schema = StructType([StructField(c, StringType()) for c in (*names, _CORRUPT)])
        # Records can only be checked for their cell count when all cells are parsed.
        reader = _csv(spark, multi_line).schema(schema).options(columnNameOfCorruptRecord=_CORRUPT, columnPruning=False)
        return finished(with_record_ordinal(reader.options(**options).csv(place), "lineno", FIRST_RECORD_LINE), names)

    def split(names: Sequence[str], place: list[str], options: dict[str, str]) -> DataFrame:
        numbered = _parsed(quoted_records(spark, place), names)
        return finished(numbered.withColumn("lineno", F.col("ordinal") + 1), names)

    united = _by_header(spark, path, columns, in_splits, split if in_splits else plain)
    if united is not None:
        return united
    return plain(_csv(spark, multi_line).csv(path).columns if columns is None else columns, path, {})


def with_record_ordinal(df: DataFrame, name: str, first: int = 0) -> DataFrame:
    """Number the records of each file in file order.

    ``df`` must be a plain file scan.  A file's splits are each read in order by
    one task, so a record's ordinal is its index inside its split plus the sizes
    of the earlier splits.  The parsed records are stored first: the text is
    parsed once, and split sizes and records describe the same cut of the files
    even when the cluster grows in between.
    """
    placed = df.select(
        *[field(c) for c in df.columns],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    frozen = write_table(placed, "records")
    splits = frozen.groupBy("_file", "_block").agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_table(
        splits.select(
            "_file", "_block", "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
        ),
        "splits",
    )
    if offsets.count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    ordinal = F.col("_before") + F.col("_at") - F.col("_start") + first
    joined = frozen.join(offsets, ["_file", "_block"])
    return joined.select(*[field(c) for c in df.columns], ordinal.alias(name))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in a column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as an unbounded source that picks up new files."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).withColumnRenamed("value", "line")


def table_lines(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Explode texts that hold whole tables into (pos, line)."""
    return df.select(*[field(c) for c in keep], F.posexplode(T.lines(field(text))).alias("pos", "line"))


def json_text(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """One JSON object per row: keys sorted, NULLs kept."""
    names = sorted(c for c in df.columns if c not in exclude)
    return F.to_json(F.struct(*[field(c) for c in names]), {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str) -> None:
    """Write one object per line (see :func:`write_json_array` for a single array)."""
    df.select(json_text(df).alias("value")).write.text(path)


def write_json_array(df: DataFrame, path: str, exclude: Sequence[str] = ()) -> None:
    """Write the rows as one JSON array, in their order, by as many tasks as there are parts.

    The part files, one after another in the order of their names, are the array:
    each line is one object with the bracket or comma that belongs before it, and
    the last one closes the array.  An empty frame is written as ``[]``.  The rows
    are stored once, so that the first and the last are known when they are written.
    """
    numbered = df.select(json_text(df, exclude).alias("value"), F.monotonically_increasing_id().alias("at"))
    stored = write_table(numbered, "array")
    first, last = stored.agg(F.min("at"), F.max("at")).first()
    if first is None:
        df.sparkSession.range(1).select(F.lit("[]").alias("value")).write.text(path)
        return
    opening = F.when(F.col("at") == first, "[").otherwise(",")
    closing = F.when(F.col("at") == last, "]").otherwise("")
    ordered = stored.repartitionByRange("at").sortWithinPartitions("at")
    ordered.select(F.concat(opening, "value", closing).alias("value")).write.text(path)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Objects (``value``) of an array with one object a line, as :func:`write_json_array` writes it."""
    inner = F.regexp_extract("value", r"\A[\[,]?\s*(.*?)\s*[\],]?\s*\z", 1)
    return spark.read.text(path).select(inner.alias("value")).filter("value != ''")


def round_trip_differences(df: DataFrame, path: str, array: bool = False) -> DataFrame:
    """Rows that differ between the frame and the JSON written from it, lines or an ``array``.

    Empty when the file reloads to the same values.  Both sides are compared as
    parsed JSON, re-rendered.
    """

    def parsed(c: Column) -> Column:
        return F.to_json(F.parse_json(c)).alias("value")

    wrote = df.select(parsed(json_text(df)))
    lines = read_json_array(df.sparkSession, path) if array else df.sparkSession.read.text(path)
    read = lines.select(parsed(F.col("value")))
    counts = wrote.withColumn("d", F.lit(1)).unionAll(read.withColumn("d", F.lit(-1)))
    return counts.groupBy("value").agg(F.sum("d").alias("surplus")).filter("surplus <> 0")
