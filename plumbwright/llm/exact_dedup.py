"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every scan split is a sender.  It stores 64-bit fingerprints of its
   normalised texts, sorts them, and sends each owner of a hash range the
   Rice-coded gaps (Golomb codes with a power-of-two divisor).
2. Owners merge the lists and return one bit for each hash sent: does another
   sender have it too.  With repeats of its own, a sender now knows its suspects.
3. Only texts of suspects are shuffled, grouped by their whole bytes, so a
   collision of fingerprints can't join different texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbwright.llm.common import Rows, arrow_schema, raw_texts, texts
from plumbwright.sources.scratch import write_table

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"

# Hashes that one owner merges, about; more documents mean more owners.
OWNED = 1 << 19
# Bits of the table that tells a later scan which texts may be suspects.  The
# size is fixed: with more suspects, more texts pass and are grouped as well.
SUSPECT_BITS = 1 << 25
_SEGMENT_BITS = 1 << 16


def rice_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Divisor bits, unary quotients and remainders of the gaps of sorted distinct values."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    mean = int(values[-1]) // len(values)
    k = max(mean.bit_length() - 1, 0)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    low = (gaps & np.uint64((1 << k) - 1)).astype(">u8")
    bits = np.unpackbits(low.view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - k :]
    return k, np.packbits(unary).tobytes(), np.packbits(bits).tobytes()


def rice_decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The sorted values that ``rice_encode`` was given."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * k).reshape(n, k)
    wide = np.zeros((n, 64), np.uint8)
    wide[:, 64 - k :] = bits
    low = np.packbits(wide, axis=1).view(">u8").reshape(n).astype(np.uint64)
    return np.cumsum((quotients << np.uint64(k)) | low, dtype=np.uint64)


def normalise(raw: bytes) -> bytes:
    """UTF-8 text without ASCII white space."""
    return raw.translate(None, WHITE)


def fingerprint(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _fingerprints(batches):
    for batch in batches:
        found = np.array([fingerprint(normalise(r)) for r in raw_texts(batch)], np.uint64)
        yield pa.RecordBatch.from_arrays([_signed(found)], names=["print"])


def _sorted_prints(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of one sender in order, and which it has twice."""
    values = table.column("print").to_numpy().view(np.uint64)
    distinct, counts = np.unique(values, return_counts=True)
    return distinct, counts > 1


def _by_owner(distinct: np.ndarray, owner_bits: int):
    """(owner, slice) for each owner that gets something."""
    owners = (distinct >> np.uint64(64 - owner_bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(owners, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(owners)]):
        yield int(owners[a]), slice(int(a), int(b))


_MESSAGE = arrow_schema(
    {"owner": pa.int64(), "sender": pa.int64(), "n": pa.int64(), "k": pa.int32(), "unary": pa.binary(), "rest": pa.binary()}
)
_REPLY = arrow_schema({"sender": pa.int64(), "owner": pa.int64(), "bits": pa.binary()})


def _sender(owner_bits: int):
    low = np.uint64((1 << (64 - owner_bits)) - 1)

    def send(key, table):
        distinct, _ = _sorted_prints(table)
        rows = Rows(_MESSAGE)
        for owner, part in _by_owner(distinct, owner_bits):
            k, unary, rest = rice_encode(distinct[part] & low)
            rows.add(owner, key[0].as_py(), part.stop - part.start, k, unary, rest)
        return pa.Table.from_batches(list(rows.take(last=True)), schema=_MESSAGE)

    return send


def _own(key, table):
    """Which hashes of each sender another sender has as well."""
    cells = [table.column(c).to_pylist() for c in ("sender", "n", "k", "unary", "rest")]
    lists = [rice_decode(*c[1:]) for c in zip(*cells)]
    distinct, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared, rows, at = (counts > 1)[inverse], Rows(_REPLY), 0
    for sender, values in zip(cells[0], lists):
        rows.add(sender, key[0].as_py(), np.packbits(shared[at : at + len(values)]).tobytes())
        at += len(values)
    return pa.Table.from_batches(list(rows.take(last=True)), schema=_REPLY)


def _suspects(owner_bits: int):
    def receive(prints, replies):
        distinct, twice = _sorted_prints(prints)
        bits = dict(zip(replies.column("owner").to_pylist(), replies.column("bits").to_pylist()))
        for owner, part in _by_owner(distinct, owner_bits):
            twice[part] |= np.unpackbits(np.frombuffer(bits[owner], np.uint8), count=part.stop - part.start).astype(bool)
        return pa.table({"print": _signed(distinct[twice])})

    return receive


def suspect_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints that two or more rows have, each once or once per sender."""
    prints = texts(docs).mapInArrow(_fingerprints, "print long").withColumn("sender", F.spark_partition_id().cast("long"))
    prints = write_table(prints, "prints")
    owner_bits = max(4, (prints.count() // OWNED).bit_length())
    kind = "owner long, sender long, n long, k int, unary binary, rest binary"
    messages = prints.groupBy("sender").applyInArrow(_sender(owner_bits), kind)
    replies = messages.groupBy("owner").applyInArrow(_own, "sender long, owner long, bits binary")
    both = prints.groupBy("sender").cogroup(replies.groupBy("sender"))
    return both.applyInArrow(_suspects(owner_bits), "print long")


def _segments(key, table):
    at = table.column("at").to_numpy() % _SEGMENT_BITS
    bits = np.zeros(_SEGMENT_BITS, np.uint8)
    bits[at] = 1
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()])})


def suspect_table(prints: DataFrame, size: int) -> np.ndarray:
    """A bit for each value of the fingerprints' leading bits; ``size`` / 8 bytes at most."""
    shift = 65 - size.bit_length()
    at = F.shiftrightunsigned("print", shift).alias("at")
    placed = prints.select(at).distinct().withColumn("segment", F.shiftright("at", 16))
    table = np.zeros(size // 8, np.uint8)
    for row in placed.groupBy("segment").applyInArrow(_segments, "segment long, bits binary").toLocalIterator():
        start = row["segment"] * (_SEGMENT_BITS // 8)
        table[start : start + _SEGMENT_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def _digests(table, size: int):
    shift = 65 - size.bit_length()
    kind = arrow_schema({"print": pa.int64(), "points": pa.int64(), "text_sha256": pa.string(), "norm": pa.binary()})

    def run(batches):
        bits = table.value
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for raw in raw_texts(batch):
                norm = normalise(raw)
                value = fingerprint(norm)
                at = value >> shift
                suspect = bits[at >> 3] >> (7 - (at & 7)) & 1
                row = (
                    value - (value >> 63 << 64), len(raw.decode()), hashlib.sha256(norm).hexdigest(),
                    norm if suspect else None,
                )
                for c, v in zip(columns, row):
                    c.append(v)
            keep = [batch.column(n) for n in batch.schema.names if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, *(pa.array(c, f.type) for c, f in zip(columns, kind))], names=[*names, *kind.names]
            )

    return run


def exact_groups(docs: DataFrame, suspect_bits: int = SUSPECT_BITS) -> DataFrame:
    """One row per document with the group of texts that equal its own without white space.

    Returns doc_id, keep_id (the member with the most code points, then the
    smallest doc_id), group_size, kept and text_sha256.

    Defined cases: NULL texts count as empty, and all texts without a word are
    equal; a NULL doc_id counts as the largest; of repeated rows (same doc_id,
    same text) each counts in group_size and exactly one is kept; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(suspect_table(suspect_prints(docs), suspect_bits))
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    kind = "doc_id long, print long, points long, text_sha256 string, norm binary"
    read = write_table(
        named.mapInArrow(_digests(bits, suspect_bits), kind).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    # Grouping by the text compares whole texts; copies meet in each task first.
    order = F.struct(
        (-F.col("points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row").alias("d")
    )
    members = read.filter("norm is not null").withColumn("order", order)
    classes = members.groupBy("norm", "text_sha256").agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = write_table(classes.filter("n > 1").select("text_sha256", "first", "n"), "classes")
    return read.drop("norm").join(classes, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.c")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("first.d") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def unique_documents(docs: DataFrame, suspect_bits: int = SUSPECT_BITS) -> DataFrame:
    """The row that stays of every group of equal texts, with the columns of ``docs``.

    Texts that can't have a copy pass through; only suspects are shuffled, each
    text once per task.

    Defined cases: NULL, empty and blank texts are equal; the longest original
    text stays, then the smallest doc_id (NULL last), then the smallest hash of
    the text, so reruns agree but for the other columns of repeated rows; an empty
    table gives no rows; columns of any name are kept as they are.
    """
    bits = docs.sparkSession.sparkContext.broadcast(suspect_table(suspect_prints(docs), suspect_bits))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(row.alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = StructType([named.schema["row"]])
    for name, of in (("print", "long"), ("points", "long"), ("text_sha256", "string"), ("norm", "binary")):
        kind = kind.add(name, of)
    read = named.mapInArrow(_digests(bits, suspect_bits), kind)
    doc_id = F.col("row.doc_id")
    spelled = F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")))
    order = F.struct((-F.col("points")).alias("a"), doc_id.isNull().alias("b"), doc_id.alias("c"), spelled.alias("d"))
    suspects = read.filter("norm is not null").groupBy("norm").agg(F.min_by("row", order).alias("row"))
    return read.filter("norm is null").select("row.*").union(suspects.select("row.*"))
