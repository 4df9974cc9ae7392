"""Token ids as length-delimited binary records with a separate offset index.

A record file is a run of frames: the payload's length (8 bytes), the masked
CRC-32C of these bytes, the payload, and its masked CRC-32C, all little-endian.
A payload holds the document's id, the number of ids, the bytes an id has, and
the ids.  Files follow the order of doc_id.  The index is a Parquet table with
the place of every frame, so any order of documents can be read without
reading whole files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.llm.common import Rows, arrow_schema, raw_texts, texts
from plumbwright.llm.word_ids import WORD_FILE, id_bytes32, word_ids
from plumbwright.sources.scratch import new_folder, write_table

END_ID = 1
# Documents of one file, about; their ids pass through one task in order.
DOCUMENTS_PER_FILE = 8192
TOGETHER = 256

# Fixed values of the frame format: reflected Castagnoli polynomial, mask offset.
_POLYNOMIAL = 0x82F63B78
_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_PAYLOAD = struct.Struct("<?qQB")
_LANE = 64


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> 1) ^ np.where(t & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    return t


_TABLE = _byte_table()
# Two bytes at once.
_PAIRS = _TABLE[np.arange(1 << 16) & 255]
_PAIRS = _TABLE[(_PAIRS ^ (np.arange(1 << 16, dtype=np.uint32) >> 8)) & 255] ^ (_PAIRS >> 8)


def _apply(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map on checksums, given as one table for each of their bytes."""
    return (
        operator[0][crc & 255] ^ operator[1][crc >> 8 & 255] ^ operator[2][crc >> 16 & 255] ^ operator[3][crc >> 24]
    )


def _lane_shifts(count: int) -> list[np.ndarray]:
    """The maps that append 1, 2, 4, ... lanes of zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    operator = np.stack([values << np.uint32(8 * i) for i in range(4)])
    for _ in range(_LANE):
        operator = _TABLE[operator & 255] ^ (operator >> 8)
    out = [operator]
    while len(out) < count:
        out.append(_apply(out[-1], out[-1]))
    return out


_SHIFTS = _lane_shifts(32)


def crc32c_many(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string of at least 4 bytes.

    Strings are cut into lanes that advance side by side; the lanes' checksums
    are then shifted to their places and summed (the code is linear).
    """
    lanes = np.array([-(-len(p) // _LANE) for p in parts])
    padded = [b"\0" * (n * _LANE - len(p)) + p for n, p in zip(lanes, parts)]
    data = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, _LANE).T.copy()
    first = np.concatenate([[0], np.cumsum(lanes)[:-1]])
    # The initial value of all ones inverts the first four bytes, which may lie in two lanes.
    pad = np.array([n * _LANE - len(p) for n, p in zip(lanes, parts)])
    for i in range(4):
        at = pad + i
        data[at % _LANE, first + at // _LANE] ^= 255
    crc = np.zeros(data.shape[1], np.uint32)
    for low, high in zip(data[::2], data[1::2]):
        crc = _PAIRS[(crc ^ low ^ high.astype(np.uint32) * 256) & 0xFFFF] ^ (crc >> 16)
    behind = np.repeat(first + lanes - 1, lanes) - np.arange(data.shape[1])
    for bit in range(int(behind.max()).bit_length()):
        move = behind >> bit & 1 == 1
        crc[move] = _apply(_SHIFTS[bit], crc[move])
    return np.bitwise_xor.reduceat(crc, first) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Checksums rotated and offset, so that data which holds checksums is safe to check."""
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(_MASK_DELTA)


def frames(payloads: list[bytes]) -> list[bytes]:
    sizes = [struct.pack("<Q", len(p)) for p in payloads]
    heads, tails = masked(crc32c_many(sizes)).tolist(), masked(crc32c_many(payloads)).tolist()
    return [s + _TAIL.pack(h) + p + _TAIL.pack(t) for s, h, p, t in zip(sizes, heads, payloads, tails)]


class DamagedRecord(ValueError):
    """A frame whose lengths or checksums don't hold."""


def _checked(heads: list[bytes], payloads: list[bytes], tails: list[bytes], where: str) -> None:
    found = masked(crc32c_many([h[:8] for h in heads])), masked(crc32c_many(payloads))
    told = [h[8:] for h in heads], tails
    for crcs, cells in zip(found, told):
        if crcs.astype("<u4").tobytes() != b"".join(cells):
            raise DamagedRecord(where)


def _read_frames(stream, whole: int, where: str, together: int = TOGETHER):
    """Payloads of a stream of ``whole`` bytes of frames, some at a time."""
    heads, payloads, tails = [], [], []
    while head := stream.read(_HEAD.size):
        if len(head) < _HEAD.size:
            raise DamagedRecord(where)
        size = _HEAD.unpack(head)[0]
        if size > whole:
            raise DamagedRecord(where)
        payload, tail = stream.read(size), stream.read(_TAIL.size)
        if len(payload) < size or len(tail) < _TAIL.size:
            raise DamagedRecord(where)
        heads.append(head), payloads.append(payload), tails.append(tail)
        if len(heads) == together:
            _checked(heads, payloads, tails, where)
            yield from payloads
            heads, payloads, tails = [], [], []
    if heads:
        _checked(heads, payloads, tails, where)
        yield from payloads


def _opened(frame: bytes, size: int, where: str) -> bytes:
    """The payload of a single frame."""
    head, payload, tail = frame[: _HEAD.size], frame[_HEAD.size : -_TAIL.size], frame[-_TAIL.size :]
    if len(frame) != size or _HEAD.unpack(head)[0] != len(payload):
        raise DamagedRecord(where)
    _checked([head], [payload], [tail], where)
    return payload


def _payload(key: int | None, ids: bytes, width: int) -> bytes:
    return _PAYLOAD.pack(key is not None, key or 0, len(ids) // width, width) + ids


def _unpack(payload: bytes) -> tuple[int | None, bytes]:
    known, key, n, width = _PAYLOAD.unpack_from(payload)
    ids = payload[_PAYLOAD.size :]
    if len(ids) != n * width:
        raise DamagedRecord("a payload's length")
    return key if known else None, id_bytes32(ids, np.dtype(f"<u{width}"))


@dataclass(frozen=True)
class Written:
    """Where record files are, and their index: one row per document."""

    folder: str
    index: DataFrame


_ENCODED = arrow_schema({"doc_id": pa.int64(), "file_no": pa.int32(), "ids": pa.binary()})
_INDEX = arrow_schema(
    {
        "doc_id": pa.int64(), "file_no": pa.int32(), "path": pa.string(), "offset": pa.int64(),
        "size": pa.int64(), "n_tokens": pa.int64(),
    }
)
_INDEX_KIND = "doc_id long, file_no int, path string, offset long, size long, n_tokens long"


def _encode(path: str, end_id: int, bounds: list[int]):
    def run(batches):
        encoder, rows, edges = word_ids(path), Rows(_ENCODED), np.array(bounds, np.int64)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            keys, raws = batch.column("doc_id").to_pylist(), raw_texts(batch)
            for key, ids in zip(keys, encoder.each(raws)):
                file_no = 0 if key is None else int(np.searchsorted(edges, key, side="left"))
                rows.add(key, file_no, ids + end, size=len(ids))
                yield from rows.take()
        yield from rows.take(last=True)

    return run


def _write(folder: str, width: int):
    def run(batches):
        where, base = fs.FileSystem.from_uri(folder)
        rows, out, name, at = Rows(_INDEX), None, "", 0
        for batch in batches:
            cells = zip(*(batch.column(c).to_pylist() for c in ("file_no", "doc_id", "ids")))
            for file_no, some in groupby(cells, key=lambda c: c[0]):
                path = f"part-{file_no:07d}.rec"
                if path != name:
                    if out:
                        out.close()
                        where.move(f"{base}/{name}.{own}", f"{base}/{name}")
                    # An attempt writes under a name of its own; a finished file takes the place of another attempt's.
                    own, name, at = uuid.uuid4().hex, path, 0
                    out = where.open_output_stream(f"{base}/{name}.{own}")
                group = list(some)
                for first in range(0, len(group), TOGETHER):
                    part = group[first : first + TOGETHER]
                    for (_, key, ids), frame in zip(part, frames([_payload(k, ids, width) for _, k, ids in part])):
                        out.write(frame)
                        rows.add(key, file_no, path, at, len(frame), len(ids) // width)
                        at += len(frame)
                yield from rows.take()
        if out:
            out.close()
            where.move(f"{base}/{name}.{own}", f"{base}/{name}")
        yield from rows.take(last=True)

    return run


def write_records(
    docs: DataFrame, folder: str | None = None, path: str = WORD_FILE, end_id: int = END_ID,
    per_file: int = DOCUMENTS_PER_FILE,
) -> Written:
    """Encode whole texts and write them as record files in ascending doc_id order.

    ``folder`` is one that every executor can reach; a new one in the session's
    shared folder if not given.  Documents go to files by ranges of doc_id with
    about ``per_file`` documents each; only ids move between tasks, not texts.

    Defined cases: NULL and empty texts have the end id alone; NULL doc_ids come
    first; repeated rows are written once per row, in the order of their ids; an
    empty table gives no files; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    where, base = fs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    files = max(1, -(-named.count() // per_file))
    bounds = []
    if files > 1:
        cuts = [i / files for i in range(1, files)]
        bounds = named.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * files))).first()[0] or []
    encoded = named.mapInArrow(_encode(path, end_id, bounds), "doc_id long, file_no int, ids binary")
    # File numbers are partition numbers: one task writes one file.
    placed = encoded.repartitionById(files, "file_no")
    placed = placed.sortWithinPartitions(F.col("file_no"), F.col("doc_id").asc_nulls_first(), F.col("ids"))
    width = word_ids(path).dtype.itemsize
    return Written(folder, write_table(placed.mapInArrow(_write(folder, width), _INDEX_KIND), "record-index"))


_READ = arrow_schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()})
_READ_KIND = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read_files(folder: str, with_ids: bool):
    schema = _READ.append(pa.field("ids", pa.binary())) if with_ids else _READ

    def run(batches):
        where, base = fs.FileSystem.from_uri(folder)
        rows = Rows(schema)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                whole = where.get_file_info(f"{base}/{path}").size
                with where.open_input_stream(f"{base}/{path}", buffer_size=1 << 20) as stream:
                    for payload in _read_frames(stream, whole, path):
                        key, ids = _unpack(payload)
                        more = [ids] if with_ids else []
                        rows.add(key, start, len(ids) // 4, zlib.crc32(ids), *more, size=len(ids) * with_ids)
                        start += len(ids) // 4
                        yield from rows.take()
        yield from rows.take(last=True)

    return run


def read_records(written: Written, with_ids: bool = True) -> DataFrame:
    """All records, read from the files from front to back with every checksum verified.

    Returns doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    and, unless ``with_ids`` is false, ids (little-endian unsigned 32-bit).
    """
    sizes = written.index.groupBy("file_no", "path").agg(F.sum("n_tokens").alias("n"))
    # One row per file.
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.select("path", "file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    count = max(1, (written.index.agg(F.max("file_no")).first()[0] or 0) + 1)
    return files.repartitionById(count, "file_no").mapInArrow(
        _read_files(written.folder, with_ids), _READ_KIND + (", ids binary" if with_ids else "")
    )


def _read_places(folder: str):
    schema = arrow_schema({"doc_id": pa.int64(), "ids": pa.binary()})

    def run(batches):
        where, base = fs.FileSystem.from_uri(folder)
        rows, name, file = Rows(schema), None, None
        for batch in batches:
            cells = zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "size")))
            for path, offset, size in cells:
                if path != name:
                    name, file = path, where.open_input_file(f"{base}/{path}")
                file.seek(offset)
                payload = _opened(file.read(size), size, path)
                rows.add(*_unpack(payload), size=size)
                yield from rows.take()
        yield from rows.take(last=True)

    return run


def read_places(written: Written, places: DataFrame) -> DataFrame:
    """doc_id and ids of the frames that rows of the index name, in the order of these rows."""
    chosen = places.select("path", "offset", "size")
    return chosen.mapInArrow(_read_places(written.folder), "doc_id long, ids binary")
