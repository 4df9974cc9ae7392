"""CSV records with quoted line breaks, cut in the splits of their files.

Whether a split begins inside a quoted cell depends on everything before it.  A
first pass finds for every split where it ends if it begins outside and if it
begins inside of quotes; the states of a file's splits follow from these in
order.  A second pass cuts each split into records from its known state.  Only
the pieces of records that reach over a border of splits meet afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbwright.sources.headers import placed_lines
from plumbwright.sources.scratch import write_table

# Pieces of a split: a record of its own, one that does not end in it, the rest of an earlier one.
WHOLE, OPEN, REST = 0, 1, 2


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of a line lies inside a quoted cell, given its begin.

    A quote opens a cell only as its first character, and is doubled inside.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _ends(batches):
    """The states at the end of each split, for both begins; lines without quotes are NULL."""
    import pyarrow as pa

    ends: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for line, *split in zip(*(c.to_pylist() for c in batch.columns)):
            state = ends.setdefault(tuple(split), [False, True])
            if line is None:
                continue
            first = inside_after(line, state[0])
            state[1] = first if state[0] == state[1] else inside_after(line, state[1])
            state[0] = first
    keys = list(ends)
    yield pa.RecordBatch.from_pydict(
        {
            "file": pa.array([k[0] for k in keys], pa.string()),
            "block": pa.array([k[1] for k in keys], pa.int64()),
            "outside": pa.array([ends[k][0] for k in keys], pa.bool_()),
            "inside": pa.array([ends[k][1] for k in keys], pa.bool_()),
        }
    )


def _cut(begin_inside: frozenset):
    """Cut splits into pieces; ``begin_inside`` lists those that begin inside of quotes."""

    def run(batches):
        import pyarrow as pa

        columns: list[list] = [[] for _ in range(5)]
        split, lines, seq, inside, rest = None, [], -1, False, False

        def close(kind: int) -> None:
            nonlocal lines, seq
            text = "\n".join(lines)
            lines = []
            if kind == WHOLE and not text.strip():
                return
            seq += kind != REST
            for c, v in zip(columns, (*split, seq, kind, text)):
                c.append(v)

        def batch_of():
            names, types = ("file", "block", "seq", "kind", "record"), ("string", "int64", "int64", "int32", "large_string")
            out = [pa.array(c, getattr(pa, t)()) for c, t in zip(columns, types)]
            for c in columns:
                c.clear()
            return pa.RecordBatch.from_arrays(out, list(names))

        for batch in batches:
            for line, *place in zip(*(c.to_pylist() for c in batch.columns)):
                if tuple(place) != split:
                    if lines:
                        close(REST if rest else OPEN)
                    split = tuple(place)
                    seq, rest = -1, split in begin_inside
                    inside = rest
                lines.append(line)
                if '"' in line:
                    inside = inside_after(line, inside)
                if not inside:
                    close(REST if rest else WHOLE)
                    rest = False
            yield batch_of()
        if lines:
            close(REST if rest else OPEN)
            yield batch_of()

    return run


def split_begins(ends: DataFrame) -> DataFrame:
    """file, block and whether the split begins inside of quotes, from the ends of all splits."""
    ordered = F.sort_array(F.collect_list(F.struct("block", "outside", "inside")))
    # One short row for each split of a file.
    walk = """aggregate(splits, named_struct('now', false, 'all', CAST(array() AS array<struct<block: bigint, begins: boolean>>)),
        (s, x) -> named_struct('now', IF(s.now, x.inside, x.outside), 'all', concat(s.all, array(named_struct('block', x.block, 'begins', s.now)))))"""
    return ends.groupBy("file").agg(ordered.alias("splits")).select("file", F.inline(F.expr(walk)["all"]))


def _joined(border: DataFrame) -> DataFrame:
    """Records put together from their pieces, at the place of the piece that begins them."""
    # In a split, the rest of an earlier record comes before the one that goes on.
    line = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    begun = F.sum((F.col("kind") == OPEN).cast("int")).over(line)
    parts = F.sort_array(F.collect_list(F.struct("block", -F.col("kind"), "record")))
    opener = F.col("kind") == OPEN
    return border.withColumn("begun", begun).groupBy("file", "begun").agg(
        F.max(F.when(opener, F.col("block"))).alias("block"), F.max(F.when(opener, F.col("seq"))).alias("seq"),
        F.array_join(parts["record"], "\n").alias("record"),
    ).drop("begun")


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of CSV files: file, ordinal (from 0, the header's) and record, without blank ones.

    Lines end in a line feed, with or without a carriage return before it.  An
    unclosed quote runs to the end of its file, as one record.
    """
    lines = placed_lines(spark, path, "\n")
    quoted = lines.select(F.when(F.contains("value", F.lit('"')), F.col("value")).alias("value"), "file", "block")
    begins = split_begins(quoted.mapInArrow(_ends, "file string, block long, outside boolean, inside boolean"))
    begins = write_table(begins, "quote-states")
    # At most one entry for each split of the scan, which the driver plans in any case.
    inside = frozenset((r["file"], r["block"]) for r in begins.filter("begins").collect())
    pieces = lines.mapInArrow(_cut(inside), "file string, block long, seq long, kind int, record string")
    stored = write_table(pieces, "quoted-pieces")
    counts = stored.groupBy("file", "block").agg(F.count_if(F.col("kind") != REST).alias("n"))
    if counts.join(begins, ["file", "block"], "left_anti").count():
        raise RuntimeError("the files were cut into other splits while they were read; read them again")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    columns = ["file", "block", "seq", "record"]
    whole = stored.filter(F.col("kind") == WHOLE).select(*columns)
    records = whole.unionByName(_joined(stored.filter(F.col("kind") != WHOLE)).select(*columns))
    # As in a read by whole files, line breaks inside of cells become line feeds.
    text = F.replace(F.regexp_replace("record", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    placed = records.join(offsets, ["file", "block"])
    return placed.select("file", (F.col("before") + F.col("seq")).alias("ordinal"), text.alias("record"))
