"""Bigram language model in sharded Elias-Fano tries.

A shard holds contexts and their successors: sorted context ids, a monotone list
of pointers into the successor level, and successor ids made monotone by the
place of their context, so that one search finds a successor within its context.
All three are Elias-Fano lists.  Values are counts quantised to one byte
downwards, which keeps smoothed probabilities summing to at most one:

    P(w | v) = (count(v, w) + MU * P(w)) / (count(v) + MU),
    P(w) = (count(w) + 0.5) / (N + 0.5 * (V + 1)).

Counts cover every training text.  Senders (ranges of doc_id) exchange lists of
their distinct words, then of their distinct pairs, with the owners of words and
of contexts; a list both adds the sender's training counts and asks for totals.
Successors of very frequent contexts are spread over all owners.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.llm.common import LOWER_ASCII, Rows, arrow_schema, deal, dealt_rows
from plumbwright.sources.scratch import write_table

# Words of weight that the unigram distribution has in every context.
MU = 20.0
# Text of one sender, about; its tokens are in memory at once.
SENDER_BYTES = 16 << 20
# Text bytes for each owner; owners merge what all senders list.
OWNER_BYTES = 24 << 20
# A context of more training tokens is spread over all owners.
SPREAD = 100_000
_WORD_SEED = 8


def ef_encode(values: np.ndarray) -> list:
    """Elias-Fano parts of a monotone list: number, low bits, high bits in unary, packed low bits."""
    n = len(values)
    if not n:
        return [0, 0, b"", b""]
    low = max(int(values[-1]) // n, 1).bit_length() - 1
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(high[-1]) + 1, np.uint8)
    unary[high] = 1
    lows = (values & np.uint64((1 << low) - 1)).astype(">u8")
    bits = np.unpackbits(lows.view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - low :]
    return [n, low, np.packbits(unary).tobytes(), np.packbits(bits).tobytes()]


def ef_decode(n: int, low: int, unary: bytes, lows: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n] - np.arange(n)
    wide = np.zeros((n, 64), np.uint8)
    wide[:, 64 - low :] = np.unpackbits(np.frombuffer(lows, np.uint8), count=n * low).reshape(n, low)
    return high.astype(np.uint64) << np.uint64(low) | np.packbits(wide, axis=1).view(">u8").reshape(n).astype(np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """One byte for small counts, eight more for others."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<u8").tobytes()


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<u8", offset=n).astype(np.int64)
    return out


def _codebook() -> np.ndarray:
    """Counts that one byte stands for: exact ones, then steps of a sixth, rising."""
    book = list(range(97))
    while len(book) < 256:
        book.append(max(book[-1] + 1, book[-1] * 7 // 6))
    return np.array(book, np.int64)


CODEBOOK = _codebook()


def quantise(counts: np.ndarray) -> np.ndarray:
    return (np.searchsorted(CODEBOOK, counts, side="right") - 1).astype(np.uint8)


class Trie:
    """One shard: contexts, pointers, successors and quantised counts, in compact form."""

    def __init__(self, parts: dict):
        self.parts = parts

    @classmethod
    def build(cls, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray) -> Trie:
        """From pairs sorted by context and successor, each once."""
        heads = np.flatnonzero(np.diff(contexts, prepend=~contexts[:1])) if len(contexts) else np.zeros(0, np.int64)
        span = int(successors.max()) + 1 if len(successors) else 1
        place = np.repeat(np.arange(len(heads)), np.diff([*heads, len(contexts)]))
        return cls(
            {
                "contexts": ef_encode(contexts[heads]),
                "pointers": ef_encode(np.append(heads, len(contexts)).astype(np.uint64)),
                "successors": ef_encode(place.astype(np.uint64) * np.uint64(span) + successors),
                "span": span,
                "values": quantise(counts).tobytes(),
            }
        )

    def size(self) -> int:
        lists = ("contexts", "pointers", "successors")
        return len(self.parts["values"]) + sum(len(p) for k in lists for p in self.parts[k][2:])

    def values(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Quantised counts of pairs; 0 for pairs that the shard has not."""
        known, pointers, level = (ef_decode(*self.parts[k]) for k in ("contexts", "pointers", "successors"))
        out = np.zeros(len(contexts), np.uint8)
        if not len(known):
            return out
        span = np.uint64(self.parts["span"])
        place = np.searchsorted(known, contexts)
        asked = np.flatnonzero((successors < span) & (known[np.minimum(place, len(known) - 1)] == contexts))
        place = place[asked]
        wanted = place.astype(np.uint64) * span + successors[asked]
        # The successor level is monotone: this lands in the context's own range or at its end.
        at = np.searchsorted(level, wanted)
        inside = at < pointers[place + 1].astype(np.int64)
        hit = inside & (level[np.minimum(at, len(level) - 1)] == wanted)
        out[asked[hit]] = np.frombuffer(self.parts["values"], np.uint8)[at[hit]]
        return out


def held_out(doc_id: int | None) -> bool:
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % 5 == 1


class _Sender:
    """Tokens of a sender's documents: each text's words and an end, which is word 0."""

    def __init__(self, table: pa.Table):
        self.docs, words, lengths = [], [], []
        for doc_id, raw in dealt_rows(table):
            own = raw.translate(LOWER_ASCII).split()
            self.docs.append(doc_id)
            lengths.append(len(own) + 1)
            words += own
            words.append(b"")
        number = dict.fromkeys([b"", *words])
        for i, w in enumerate(number):
            number[w] = i
        self.codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.lengths = np.array(lengths, np.int64)
        self.held = np.array([held_out(d) for d in self.docs], bool)
        self.training = np.repeat(~self.held, self.lengths)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(w, _WORD_SEED) for w in number], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.counts = np.bincount(self.codes[self.training], minlength=len(number))

    def contexts(self) -> np.ndarray:
        """The word before each token; before a text's first one, the end."""
        return np.concatenate([np.zeros(1, np.int64), self.codes[:-1]])

    def learn(self, replies: pa.Table, owners: int) -> None:
        """Ids and training counts of the words, from the owners of words."""
        ids, counts = np.zeros(len(self.hashes), np.uint64), np.zeros(len(self.hashes), np.int64)
        self.tokens = self.vocabulary = 0
        rows = {r["owner"]: r for r in replies.to_pylist() if r["level"] == 1}
        for owner, part in _word_parts(self.hashes, owners):
            r = rows[owner]
            self.tokens += r["tokens"]
            self.vocabulary += r["words"]
            if part.stop > part.start:
                ids[part] = ef_decode(r["n"], r["low"], r["unary"], r["lows"]) * np.uint64(owners) + np.uint64(owner)
                counts[part] = unpack_counts(r["counts"], r["n"])
        self.ids, self.totals = np.empty_like(ids), np.empty_like(counts)
        self.ids[self.order], self.totals[self.order] = ids, counts
        # Words in the order of their ids, so that sorted pairs of places are sorted pairs of ids.
        self.by_id = np.argsort(self.ids)
        self.place = np.empty(len(self.ids), np.int64)
        self.place[self.by_id] = np.arange(len(self.ids))

    def pairs(self, owners: int):
        """Distinct pairs in the order of owner, context and successor, and each token's pair."""
        flat = self.place[self.contexts()] * len(self.ids) + self.place[self.codes]
        distinct, inverse = np.unique(flat, return_inverse=True)
        v, w = self.by_id[distinct // len(self.ids)], self.by_id[distinct % len(self.ids)]
        counts = np.bincount(inverse[self.training], minlength=len(distinct))
        spread = np.where(self.totals[v] > SPREAD, self.ids[w], np.uint64(0))
        # A stable sort of small numbers keeps the order of ids within an owner.
        owner = ((self.ids[v] + spread) % np.uint64(owners)).astype(np.int16 if owners < 1 << 15 else np.int64)
        order = np.argsort(owner, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return owner[order], self.ids[v][order], self.ids[w][order], counts[order], place[inverse]


def _word_parts(hashes: np.ndarray, owners: int):
    """Every owner's part of sorted hashes, empty ones too."""
    edges = [(o << 64) // owners for o in range(1, owners)]
    cuts = [0, *np.searchsorted(hashes, np.array(edges, np.uint64)).tolist(), len(hashes)]
    for owner, (a, b) in enumerate(zip(cuts, cuts[1:])):
        yield owner, slice(a, b)


_LIST = {"n": pa.int64(), "low": pa.int32(), "unary": pa.binary(), "lows": pa.binary()}
_LIST_KIND = "n long, low int, unary binary, lows binary"
_WORDS = arrow_schema({"owner": pa.int64(), "sender": pa.int64(), **_LIST, "counts": pa.binary()})
_WORDS_KIND = f"owner long, sender long, {_LIST_KIND}, counts binary"
_REPLY = arrow_schema(
    {"sender": pa.int64(), "level": pa.int32(), "owner": pa.int64(), **_LIST, "counts": pa.binary(), "tokens": pa.int64(), "words": pa.int64()}
)
_REPLY_KIND = f"sender long, level int, owner long, {_LIST_KIND}, counts binary, tokens long, words long"
_PAIRS = arrow_schema(
    {"owner": pa.int64(), "sender": pa.int64(), **_LIST, "context_unary": pa.binary(), "context_lows": pa.binary(),
     "context_low": pa.int32(), "contexts": pa.int64(), "span": pa.int64(), "fan": pa.binary(), "counts": pa.binary()}
)
_PAIRS_KIND = (
    f"owner long, sender long, {_LIST_KIND}, context_unary binary, context_lows binary, context_low int, "
    "contexts long, span long, fan binary, counts binary"
)


def _table(rows: Rows) -> pa.Table:
    return pa.Table.from_batches(list(rows.take(last=True)), schema=rows.schema)


def _send_words(owners: int):
    def run(key, table):
        me, rows = _Sender(table), Rows(_WORDS)
        counts = me.counts[me.order]
        for owner, part in _word_parts(me.hashes, owners):
            start = np.uint64((owner << 64) // owners)
            rows.add(owner, key[0].as_py(), *ef_encode(me.hashes[part] - start), pack_counts(counts[part]))
        return _table(rows)

    return run


def _own_words(key, table):
    cells = list(zip(*(table.column(c).to_pylist() for c in ("sender", "n", "low", "unary", "lows", "counts"))))
    lists = [ef_decode(*c[1:5]) for c in cells]
    counts = np.concatenate([unpack_counts(c[5], c[1]) for c in cells])
    distinct, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    totals = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
    rows, at = Rows(_REPLY), 0
    for c, own in zip(cells, lists):
        ranks = inverse[at : at + len(own)]
        at += len(own)
        rows.add(
            c[0], 1, key[0].as_py(), *ef_encode(ranks.astype(np.uint64)), pack_counts(totals[ranks]),
            int(totals.sum()), int((totals > 0).sum()),
        )
    return _table(rows)


def _send_pairs(owners: int):
    def run(key, table, replies):
        me, rows = _Sender(table), Rows(_PAIRS)
        me.learn(replies, owners)
        owner, v, w, counts, _ = me.pairs(owners)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)]):
            heads = np.flatnonzero(np.diff(v[a:b], prepend=~v[a : a + 1]))
            fan = np.diff([*heads, b - a])
            span = int(w[a:b].max()) + 1
            place = np.repeat(np.arange(len(heads)), fan).astype(np.uint64)
            n, low, unary, lows = ef_encode(v[a:b][heads])
            rows.add(
                int(owner[a]), key[0].as_py(), *ef_encode(place * np.uint64(span) + w[a:b]), unary, lows, low, n, span,
                pack_counts(fan), pack_counts(counts[a:b]),
            )
        return _table(rows)

    return run


def _own_pairs(key, table):
    """Merge all senders' pairs into a shard and answer each sender from it."""
    asked, counts = [], []
    for r in table.to_pylist():
        contexts = ef_decode(r["contexts"], r["context_low"], r["context_unary"], r["context_lows"])
        place = np.repeat(np.arange(len(contexts)), unpack_counts(r["fan"], len(contexts)))
        level = ef_decode(r["n"], r["low"], r["unary"], r["lows"])
        asked.append((r["sender"], contexts[place], level - place.astype(np.uint64) * np.uint64(r["span"])))
        counts.append(unpack_counts(r["counts"], r["n"]))
    v, w = (np.concatenate([a[i] for a in asked]) for i in (1, 2))
    counts = np.concatenate(counts)
    trained = counts > 0
    v, w, counts = v[trained], w[trained], counts[trained]
    order = np.lexsort((w, v))
    v, w, counts = v[order], w[order], counts[order]
    heads = np.flatnonzero((np.diff(v, prepend=~v[:1]) != 0) | (np.diff(w, prepend=~w[:1]) != 0))
    totals = np.add.reduceat(counts, heads) if len(heads) else counts
    trie, rows = Trie.build(v[heads], w[heads], totals), Rows(_REPLY)
    for sender, contexts, successors in asked:
        values = trie.values(contexts, successors)
        rows.add(sender, 2, key[0].as_py(), len(values), 0, None, None, values.tobytes(), 0, 0)
    return _table(rows)


_SCORED = arrow_schema(
    {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
     "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
)
_SCORED_KIND = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score(owners: int, mu: float):
    def run(key, table, replies):
        me = _Sender(table)
        me.learn(replies, owners)
        owner, v, w, _, pair = me.pairs(owners)
        rows = {r["owner"]: r["counts"] for r in replies.to_pylist() if r["level"] == 2}
        found = b"".join(rows[o] for o in np.unique(owner).tolist())
        counts = CODEBOOK[np.frombuffer(found, np.uint8)][pair]
        unigram = (me.totals + 0.5) / (me.tokens + 0.5 * (me.vocabulary + 1))
        base = unigram[me.codes]
        before = me.totals[me.contexts()]
        smooth = (counts + mu * base) / (before + mu)
        starts = np.concatenate([[0], np.cumsum(me.lengths)[:-1]])
        known = (me.totals[me.codes] > 0).astype(np.int64)
        return pa.table(
            {
                "doc_id": pa.array(me.docs, pa.int64()),
                "held_out": pa.array(me.held),
                "n_tokens": pa.array(me.lengths),
                "n_known": pa.array(np.add.reduceat(known, starts)),
                "train_tokens": pa.array(np.full(len(starts), me.tokens)),
                "base_score": pa.array(np.add.reduceat(np.log10(base), starts)),
                "score": pa.array(np.add.reduceat(np.log10(smooth), starts)),
            },
            schema=_SCORED,
        )

    return run


def score(docs: DataFrame, mu: float = MU) -> DataFrame:
    """Train on the documents that are not held out, and score all of them.

    A document is held out if the CRC-32 of its doc_id as text leaves 1 modulo 5
    (NULL as the empty text).  Returns doc_id, held_out, n_tokens (words and one
    end), n_known (tokens seen in training), train_tokens, base_score (unigram
    log10 probability) and score (the model's).

    Defined cases: NULL, empty and blank texts are one end token; repeated rows
    are texts of their own in training and give a row each; without training
    documents every token has the probability of an unknown word; an empty table
    gives no rows; other columns are ignored.
    """
    dealt, total = deal(docs, SENDER_BYTES)
    owners = max(6, total // OWNER_BYTES)
    by = dealt.groupBy("sender")
    words = by.applyInArrow(_send_words(owners), _WORDS_KIND)
    replies = write_table(words.groupBy("owner").applyInArrow(_own_words, _REPLY_KIND), "words")
    pairs = by.cogroup(replies.groupBy("sender")).applyInArrow(_send_pairs(owners), _PAIRS_KIND)
    both = replies.union(pairs.groupBy("owner").applyInArrow(_own_pairs, _REPLY_KIND))
    return by.cogroup(both.groupBy("sender")).applyInArrow(_score(owners, mu), _SCORED_KIND)
