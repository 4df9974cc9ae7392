"""Removal of repeated 100-byte strings by difference-cover suffix sorting.

Prefixes of suffixes are ordered only as far as the match length needs.  Of the
positions of a document, those that leave 1 or 2 modulo 3 are the sample: any two
positions can be moved by 0, 1 or 2 bytes so that both are in it.

1. Sampled triples: three overlapping blocks of a sampled suffix get names
   (fingerprints, so that equal blocks have equal names everywhere without an
   exchange); the triple of these names is named again and stands for 98 bytes.
2. Remaining suffixes are merged in by the names of the sampled ones next to
   them: a 100-byte string has the keys (98-byte name, 2 bytes), (byte, name,
   byte) or (2 bytes, name), and any two positions share one of these forms.
3. Keys are sorted across the cluster; of equal neighbours all but the earliest
   are repeats, and the bytes they cover are removed.

Text without repeats is left out before: in every 100 bytes the least of the
fingerprints of its 50-byte strings is an anchor.  Equal strings have equal
anchors, so only surroundings of anchors that occur twice matter.  Of equal
surroundings (150 bytes) only the earliest is sorted; the strings of the others
are repeats.  This also reduces a group of thousands of copies to one.

Keys travel as sorted, Rice-coded lists from senders (ranges of doc_id) to owners
of key ranges, which answer with two bits for each key: does another sender have
it, and is this the first sender that has it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.llm.common import Rows, arrow_schema, deal, dealt_rows
from plumbwright.llm.exact_dedup import rice_decode, rice_encode
from plumbwright.sources.scratch import write_table

LENGTH = 100
_HALF = LENGTH // 2
# Blocks of a triple: 35 bytes at 0, 33 and 63 cover 98 bytes and stay in their class modulo 3.
_BLOCK, _OFFSETS = 35, (0, 33, 63)
_NAMED = _OFFSETS[-1] + _BLOCK
# Text of one sender, about.
SENDER_BYTES = 4 << 20
# Keys of one owner, about.
OWNED = 1 << 21

_rng = np.random.Generator(np.random.PCG64(20))
_LETTER = _rng.integers(0, 1 << 64, 256, np.uint64)
_BASE = int(_rng.integers(0, 1 << 63)) * 8 + 5 & (1 << 64) - 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Text:
    """Fingerprints of any substring of one document."""

    def __init__(self, raw: bytes):
        self.bytes = np.frombuffer(raw, np.uint8)
        self.n = n = len(raw)
        up, self.down = _power_tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[self.bytes] * up[:n], out=self.sums[1:])

    def prints(self, start, end) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        """Of the strings of one length at every position."""
        n = self.n - length + 1
        return _mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


def _least(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least of each run of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


class Anchored:
    """A document's 100-byte strings by their anchors."""

    def __init__(self, raw: bytes):
        self.text = Text(raw)
        self.windows = max(0, self.text.n - LENGTH + 1)
        if not self.windows:
            self.at = np.zeros(0, np.int64)
            self.anchors = np.zeros(0, np.uint64)
            return
        prints = self.text.all(_HALF)
        width = LENGTH - _HALF + 1
        self.least = _least(prints, width)
        # An anchor is the least of some string around it.
        padded = np.concatenate([np.zeros(width - 1, np.uint64), self.least, np.zeros(width - 1, np.uint64)])
        self.at = np.flatnonzero(_least(padded, width, np.maximum) == prints)
        self.anchors = prints[self.at]

    def names(self, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Keys of the chosen anchors, one to one: the least of many fingerprints are small, names are spread evenly."""
        return _mix(self.anchors[chosen])

    def contexts(self, chosen: np.ndarray) -> np.ndarray:
        """Fingerprints of what surrounds the chosen anchors: every string they are the anchor of lies in it."""
        at = self.at[chosen]
        start, end = np.maximum(at - _HALF, 0), np.minimum(at + LENGTH, self.text.n)
        return _mix(self.text.prints(start, end) ^ (at - start).astype(np.uint64) << np.uint64(56))

    def strings(self, chosen: np.ndarray) -> np.ndarray:
        """Start positions of the strings whose anchor is one of the chosen."""
        out = np.zeros(self.windows, bool)
        for some in np.array_split(chosen, len(chosen) // 8192 + 1):
            starts = self.at[some][:, None] - np.arange(LENGTH - _HALF + 1)
            inside = (starts >= 0) & (starts < self.windows)
            starts = np.where(inside, starts, 0)
            out[starts[inside & (self.least[starts] == self.anchors[some][:, None])]] = True
        return np.flatnonzero(out)

    def keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two keys of each string, such that any two equal strings have one in common."""
        text = self.text
        letters = text.bytes.astype(np.uint64)

        def name(at: np.ndarray) -> np.ndarray:
            first, second, third = (text.prints(at + o, at + o + _BLOCK) for o in _OFFSETS)
            return _mix(_mix(_mix(first) + second) + third)

        def key(form: int) -> np.ndarray:
            # The name of the sampled suffix ``form`` bytes on, and the two bytes it leaves out.
            out = [o for o in range(LENGTH) if not form <= o < form + _NAMED]
            rest = letters[starts + out[0]] << np.uint64(8) | letters[starts + out[1]]
            return _mix(name(starts + form) + _mix(rest | np.uint64(form + 1) << np.uint64(32)))

        left = starts % 3
        # Moved by the form, a position must leave 1 or 2: residue 0 has forms 1 and 2, 1 has 0 and 1, 2 has 0 and 2.
        by_form = [key(form) for form in range(3)]
        return (
            np.where(left == 0, by_form[1], by_form[0]),
            np.where(left == 1, by_form[1], by_form[2]),
        )


def _covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Which bytes the strings at these positions cover."""
    edges = np.zeros(n + 1, np.int32)
    edges[starts] += 1
    np.subtract.at(edges, np.minimum(starts + LENGTH, n), 1)
    return np.cumsum(edges[:n]) > 0


_MESSAGE = arrow_schema(
    {"owner": pa.int64(), "sender": pa.int64(), "n": pa.int64(), "k": pa.int32(), "unary": pa.binary(), "rest": pa.binary()}
)
_MESSAGE_KIND = "owner long, sender long, n long, k int, unary binary, rest binary"
_REPLY = arrow_schema(
    {"sender": pa.int64(), "round": pa.int32(), "owner": pa.int64(), "shared": pa.binary(), "first": pa.binary()}
)
_REPLY_KIND = "sender long, round int, owner long, shared binary, first binary"


def _by_owner(distinct: np.ndarray, bits: int):
    owners = (distinct >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(owners, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(owners)]):
        yield int(owners[a]), slice(a, b)


def _messages(sender: int, keys: np.ndarray, bits: int) -> pa.Table:
    rows, low, distinct = Rows(_MESSAGE), np.uint64((1 << (64 - bits)) - 1), np.unique(keys)
    for owner, part in _by_owner(distinct, bits):
        rows.add(owner, sender, part.stop - part.start, *rice_encode(distinct[part] & low))
    return pa.Table.from_batches(list(rows.take(last=True)), schema=_MESSAGE)


def _owner(number: int):
    def answer(key, table):
        cells = sorted(zip(*(table.column(c).to_pylist() for c in ("sender", "n", "k", "unary", "rest"))))
        lists = [rice_decode(*c[1:]) for c in cells]
        keys = np.concatenate(lists)
        # Stable: of equal keys, the one of the lowest sender comes first.
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        shared, first = np.zeros(len(keys), bool), np.ones(len(keys), bool)
        shared[order[1:]] |= same
        shared[order[:-1]] |= same
        first[order[1:]] = ~same
        rows, at = Rows(_REPLY), 0
        for (sender, *_), values in zip(cells, lists):
            part = slice(at, at + len(values))
            rows.add(sender, number, key[0].as_py(), np.packbits(shared[part]).tobytes(), np.packbits(first[part]).tobytes())
            at += len(values)
        return pa.Table.from_batches(list(rows.take(last=True)), schema=_REPLY)

    return answer


def _answers(distinct: np.ndarray, replies: pa.Table, number: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each distinct key, in order."""
    own = {
        r["owner"]: r for r in replies.to_pylist() if r["round"] == number
    }
    shared, first = np.zeros(len(distinct), bool), np.ones(len(distinct), bool)
    for owner, part in _by_owner(distinct, bits):
        for out, name in ((shared, "shared"), (first, "first")):
            raw = np.frombuffer(own[owner][name], np.uint8)
            out[part] = np.unpackbits(raw, count=part.stop - part.start)
    return shared, first


class _Keys:
    """All keys of a sender, in the order of its documents, and what the owners say about them."""

    def __init__(self, keys: list[np.ndarray], replies: pa.Table, number: int, bits: int):
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        distinct, at, inverse, counts = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
        shared, first = _answers(distinct, replies, number, bits)
        self.repeated = (shared | (counts > 1))[inverse]
        self.earliest = first[inverse] & (at[inverse] == np.arange(len(flat)))
        self.cuts = np.cumsum([0, *map(len, keys)])

    def of(self, values: np.ndarray, i: int) -> np.ndarray:
        return values[self.cuts[i] : self.cuts[i + 1]]


def _rows(table: pa.Table, *names: str) -> list[tuple]:
    """Documents of a sender in their order: doc_id (NULL last), then text."""
    cells = list(zip(*(table.column(n).to_pylist() for n in ("doc_id", "text", *names))))
    return sorted(cells, key=lambda c: (c[0] is None, c[0] or 0, c[1]))


def _ints(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


def _positions(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4").astype(np.int64)


def _send_anchors(bits: int):
    def run(key, table):
        found = [Anchored(t).names() for _, t in dealt_rows(table)]
        return _messages(key[0].as_py(), np.concatenate(found), bits)

    return run


_OPEN = arrow_schema(
    {"sender": pa.int64(), "doc_id": pa.int64(), "n_bytes": pa.int64(), "kept_sha256": pa.string(), "text": pa.binary(), "anchors": pa.binary()}
)
_OPEN_KIND = "sender long, doc_id long, n_bytes long, kept_sha256 string, text binary, anchors binary"


def _open(bits: int):
    """Documents with anchors that occur twice go on with these; of others the result is known."""

    def run(key, table, replies):
        docs = dealt_rows(table)
        keys, rows = _Keys([Anchored(t).names() for _, t in docs], replies, 1, bits), Rows(_OPEN)
        for i, (doc_id, raw) in enumerate(docs):
            again = np.flatnonzero(keys.of(keys.repeated, i))
            more = (raw, _ints(again)) if len(again) else (None, None)
            rows.add(key[0].as_py(), doc_id, len(raw), hashlib.sha256(raw).hexdigest(), *more)
        return pa.Table.from_batches(list(rows.take(last=True)), schema=_OPEN)

    return run


def _send_contexts(bits: int):
    def run(key, table):
        found = [Anchored(t).contexts(_positions(a)) for _, t, a in _rows(table, "anchors")]
        return _messages(key[0].as_py(), np.concatenate(found), bits)

    return run


_FRESH = arrow_schema(
    {"sender": pa.int64(), "doc_id": pa.int64(), "text": pa.binary(), "repeats": pa.binary(), "fresh": pa.binary()}
)
_FRESH_KIND = "sender long, doc_id long, text binary, repeats binary, fresh binary"


def _runs(mask: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of true values, alternating."""
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))


def _split_contexts(bits: int):
    """Strings in surroundings that were met before are repeats; the others are fresh."""

    def run(key, table, replies):
        docs = _rows(table, "anchors")
        found = [Anchored(t) for _, t, _ in docs]
        chosen = [_positions(a) for _, _, a in docs]
        keys, rows = _Keys([a.contexts(c) for a, c in zip(found, chosen)], replies, 2, bits), Rows(_FRESH)
        for i, ((doc_id, raw, _), a, c) in enumerate(zip(docs, found, chosen)):
            earliest = keys.of(keys.earliest, i)
            covered = _covered(a.strings(c[~earliest]), len(raw))
            rows.add(key[0].as_py(), doc_id, raw, _ints(_runs(covered)), _ints(c[earliest]))
        return pa.Table.from_batches(list(rows.take(last=True)), schema=_FRESH)

    return run


def _send_fresh(bits: int):
    def run(key, table):
        found = [Anchored(t).names(_positions(f)) for _, t, f in _rows(table, "fresh")]
        return _messages(key[0].as_py(), np.concatenate(found), bits)

    return run


def _contested(table: pa.Table, replies: pa.Table, bits: int):
    """Per document: its parts and the strings whose anchor has several surroundings."""
    docs = _rows(table, "repeats", "fresh")
    found = [Anchored(t) for _, t, _, _ in docs]
    chosen = [_positions(f) for *_, f in docs]
    keys = _Keys([a.names(c) for a, c in zip(found, chosen)], replies, 3, bits)
    return docs, found, [a.strings(c[keys.of(keys.repeated, i)]) for i, (a, c) in enumerate(zip(found, chosen))]


def _send_strings(bits: int, bits_before: int):
    def run(key, table, replies):
        _, found, starts = _contested(table, replies, bits_before)
        keys = [k for a, s in zip(found, starts) if len(s) for k in a.keys(s)]
        return _messages(key[0].as_py(), np.concatenate(keys or [np.zeros(0, np.uint64)]), bits)

    return run


_CUT = arrow_schema(
    {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.int32()), "kept": pa.binary()}
)
_CUT_KIND = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<int>, kept binary"


def _cut(bits: int, bits_before: int):
    def run(key, table, replies):
        docs, found, starts = _contested(table, replies, bits_before)
        pairs = [a.keys(s) if len(s) else (np.zeros(0, np.uint64),) * 2 for a, s in zip(found, starts)]
        # Each document's keys alternate by string, so that positions keep their order.
        keys = _Keys([np.stack(p, axis=1).reshape(-1) for p in pairs], replies, 4, bits)
        rows = Rows(_CUT)
        for i, ((doc_id, raw, repeats, _), s) in enumerate(zip(docs, starts)):
            covered = np.zeros(len(raw), bool)
            edges = _positions(repeats)
            for a, b in zip(edges[::2], edges[1::2]):
                covered[a:b] = True
            earliest = keys.of(keys.earliest, i).reshape(-1, 2).all(axis=1)
            covered |= _covered(s[~earliest], len(raw))
            kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
            runs = _runs(covered)
            rows.add(
                doc_id, len(raw), len(raw) - len(kept), len(runs) // 2, hashlib.sha256(kept).hexdigest(), runs.tolist(), kept
            )
        return pa.Table.from_batches(list(rows.take(last=True)), schema=_CUT)

    return run


def _exchange(messages: DataFrame, number: int) -> DataFrame:
    return messages.groupBy("owner").applyInArrow(_owner(number), _REPLY_KIND)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove every byte covered by a 100-byte string that also starts earlier.

    Earlier is a smaller doc_id, or an earlier start in the same document;
    strings are judged on the input and never cross documents.  Returns doc_id,
    n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, spans
    (starts and ends of the runs) and kept (the remaining bytes; NULL where
    nothing was removed because no part of the text occurs twice).

    Defined cases: NULL texts are empty; texts under 100 bytes are kept; rows
    with a NULL doc_id come last; rows with the same doc_id come in the order of
    their texts, so of repeated rows one is kept whole; an empty table gives no
    rows; other columns are ignored.  Strings are compared by 64-bit names.
    """
    dealt, total = deal(docs, SENDER_BYTES)
    # About one anchor in 25 bytes; owners for the other rounds get fewer keys.
    bits = max(4, (total // 25 // OWNED).bit_length())
    by = dealt.groupBy("sender")
    replies = _exchange(by.applyInArrow(_send_anchors(bits), _MESSAGE_KIND), 1)
    opened = write_table(by.cogroup(replies.groupBy("sender")).applyInArrow(_open(bits), _OPEN_KIND), "open")

    rest = opened.filter("text is not null").select("sender", "doc_id", "text", "anchors")
    by = rest.groupBy("sender")
    replies = _exchange(by.applyInArrow(_send_contexts(bits), _MESSAGE_KIND), 2)
    fresh = write_table(by.cogroup(replies.groupBy("sender")).applyInArrow(_split_contexts(bits), _FRESH_KIND), "fresh")

    by = fresh.groupBy("sender")
    replies = write_table(_exchange(by.applyInArrow(_send_fresh(bits), _MESSAGE_KIND), 3), "replies")
    sent = by.cogroup(replies.groupBy("sender")).applyInArrow(_send_strings(bits, bits), _MESSAGE_KIND)
    both = replies.union(_exchange(sent, 4))
    cut = by.cogroup(both.groupBy("sender")).applyInArrow(_cut(bits, bits), _CUT_KIND)

    whole = opened.filter("text is null").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "kept_sha256",
        F.array().cast("array<int>").alias("spans"), F.lit(None).cast("binary").alias("kept"),
    )
    return whole.union(cut)
