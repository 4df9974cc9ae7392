"""Packing by power-of-two decomposition.

Every document is cut into pieces whose lengths are powers of two (as many of
the longest as fit, then the binary digits of the rest).  A piece is a training
sequence of its own: no sequence crosses documents and none is padded.  Pieces
of one length form a bucket; a bucket's sequences are numbered without gaps.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.llm.common import Rows, arrow_schema, giving_back, raw_texts, texts
from plumbwright.llm.word_ids import WORD_FILE, id_bytes32, word_ids
from plumbwright.sources.scratch import write_table

LONGEST = 2048
END_ID = 1

_PIECES = arrow_schema(
    {
        "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
        "doc_tokens": pa.int64(), "part": pa.int64(), "at": pa.int64(),
    }
)


def power_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of a document with ``n`` ids, longest first."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def _cutter(path: str, longest: int, end_id: int, with_ids: bool):
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, rows, seen = word_ids(path), Rows(schema), {}
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            keys, raws = batch.column("doc_id").to_pylist(), raw_texts(batch)
            for key, ids in zip(keys, encoder.each(raws)):
                wide = id_bytes32(ids + end, encoder.dtype)
                n, start = len(wide) // 4, 0
                for length in power_lengths(n, longest):
                    piece = wide[4 * start : 4 * (start + length)]
                    index = seen[length] = seen.get(length, -1) + 1
                    row = (key, start, length, zlib.crc32(piece), n, part, index)
                    rows.add(*row, *([piece] if with_ids else []), size=4 * length * with_ids)
                    start += length
                yield from rows.take()
        yield from rows.take(last=True)

    return run


def pack(
    docs: DataFrame, path: str = WORD_FILE, longest: int = LONGEST, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents, each a full sequence of its power-of-two length.

    Returns doc_id, start (ids of the document before the piece), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers), doc_tokens,
    sequence_id, offset (0: a sequence holds one piece), bucket_index (position
    among the sequences of this length) and, unless ``with_ids`` is false, ids.

    Defined cases: a NULL or empty text is one piece with the end id alone; a
    NULL doc_id stays NULL; repeated rows are packed once per row; an empty
    table gives no rows; other columns are ignored.

    Sequence numbers follow the splits of the scan: pieces are stored once with
    their number inside the task, and only counts per task and length are summed.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"longest must be a power of two, not {longest}")
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, at long"
    kind += ", ids binary" if with_ids else ""
    cut = texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        giving_back(_cutter(path, longest, end_id, with_ids)), kind
    )
    stored = write_table(cut, "pieces")
    sizes = stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    buckets = longest.bit_length()
    index = F.col("base") + F.col("at")
    # Bucket b owns the numbers that leave the remainder b.
    number = index * buckets + F.log2("length").cast("long")
    return stored.join(bases, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", number.alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), index.alias("bucket_index"), *(["ids"] if with_ids else []),
    )
