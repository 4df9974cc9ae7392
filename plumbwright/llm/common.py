"""Helpers shared by the operators on training text.

Python work runs inside Arrow-batched tasks that Spark partitions; helpers here
only move columns in and out of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of payload after which a task hands a batch back to Spark.
FLUSH_BYTES = 8 << 20

# The lower-casing that several contracts name: A-Z only.
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def texts(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The named columns and the text (NULL becomes empty), nothing else."""
    return docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text"))


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a string column without NULLs, one value at a time."""
    for cell in batch.column(name).cast(pa.large_binary()):
        yield cell.as_py()


def arrow_schema(fields: dict[str, pa.DataType]) -> pa.Schema:
    return pa.schema([pa.field(k, t) for k, t in fields.items()])


class Rows:
    """Collects output rows by column and releases them in bounded batches."""

    def __init__(self, schema: pa.Schema, flush: int = FLUSH_BYTES):
        self.schema, self.flush = schema, flush
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, *values, size: int = 0) -> None:
        for column, v in zip(self.columns, values):
            column.append(v)
        self.bytes += size + 16 * len(values)

    def take(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """The collected rows as one batch, when there are enough or at the end."""
        if self.columns[0] and (last or self.bytes >= self.flush):
            arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema)]
            self._clear()
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _trim() -> None:
    """Hand freed memory of the C library back to the system, where the library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """The same mapInArrow function; at its end the worker, which may wait for other stages, returns unused memory."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        _trim()

    return whole


def per_row(
    schema: pa.Schema, handle: Callable[[Rows, dict], None], columns: Iterable[str], setup: Callable | None = None
):
    """A mapInArrow function that calls ``handle(rows, values)`` for every input row."""
    names = list(columns)

    def run(batches):
        state = setup() if setup else None
        rows = Rows(schema)
        for batch in batches:
            cells = [batch.column(n) for n in names]
            for i in range(batch.num_rows):
                handle(rows, [c[i].as_py() for c in cells], *([state] if setup else []))
                yield from rows.take()
        yield from rows.take(last=True)

    return run


def _assign(edges: list[int]):
    """Groups of documents by ranges of doc_id, texts of a batch and group in one compressed cell."""
    import numpy as np
    import zstandard

    bounds = np.array(edges, np.int64)
    schema = arrow_schema(
        {"sender": pa.int64(), "doc_ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "packed": pa.binary()}
    )

    def run(batches):
        rows, packer = Rows(schema), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            sender = np.searchsorted(bounds, ids.fill_null(0).to_numpy(), side="left")
            sender = np.where(known, sender, len(bounds))
            cells, keys = list(raw_texts(batch)), ids.to_pylist()
            order = np.argsort(sender, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(sender[order])) + 1):
                some = group.tolist()
                if some:
                    whole = packer.compress(b"".join(cells[i] for i in some))
                    sizes = [len(cells[i]) for i in some]
                    rows.add(int(sender[some[0]]), [keys[i] for i in some], sizes, whole, size=len(whole))
                    yield from rows.take()
        yield from rows.take(last=True)

    return run


def deal(docs: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    """Whole documents in groups by ranges of doc_id, about ``group_bytes`` of text each, and all bytes of text.

    Groups keep the order of doc_id: a smaller group has smaller ids, NULL comes
    last, and equal ids share a group.  Read a group's rows with ``dealt_rows``.
    """
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    size = named.agg(F.sum(F.octet_length("text")), F.max("doc_id")).first()
    total, groups = size[0] or 0, max(1, -(-(size[0] or 0) // group_bytes))
    edges: list[int] = []
    if groups > 1 and size[1] is not None:
        cuts = [i / groups for i in range(1, groups)]
        edges = sorted(set(named.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * groups))).first()[0]))
    kind = "sender long, doc_ids array<long>, sizes array<long>, packed binary"
    return named.mapInArrow(_assign(edges), kind), total


def dealt_rows(table: pa.Table) -> list[tuple[int | None, bytes]]:
    """doc_id and text of a group, in the order of doc_id (NULL last), then of the text."""
    import zstandard

    unpacker, out = zstandard.ZstdDecompressor(), []
    for ids, sizes, packed in zip(*(table.column(c).to_pylist() for c in ("doc_ids", "sizes", "packed"))):
        whole, at = unpacker.decompress(packed, max_output_size=max(1, sum(sizes))), 0
        for doc_id, size in zip(ids, sizes):
            out.append((doc_id, whole[at : at + size]))
            at += size
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
