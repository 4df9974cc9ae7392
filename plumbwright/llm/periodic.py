"""Periodic runs of words inside a document: seed-and-extend on diagonals.

A run with period q and at least ``max(12, 2q)`` words matches itself at lag q
over at least ``max(12 - q, q)`` consecutive words.  Lags are taken in classes
[2^c, 2^(c+1)); within a class that guaranteed overlap is 2^c words (6 for lags
below 8), so it holds one whole gram of half that length that starts at a
multiple of its length.  Only these grams are seeds.  An index of all grams of
that length gives each seed its other occurrences in the same document at the
lags of the class.

The pairs of a class are at most about twice its words, however often a gram
recurs: a seed sees one window of lags, and seeds lie half a window apart.  The
table of how far a lag is covered is the sorted list of pairs: a seed that
starts where the one before it at the same lag has ended is covered and is not
extended again, so each stretch of matches is extended once at either end, by
less than one gram, in halving steps over the names of shorter grams.

Grams are named exactly, by doubling: the name of 2w words is the name of a pair
of names.  A gram that occurs once in its document has no name and ends there,
so ordinary text leaves little after the first levels.  Documents are worked on
together, in chunks, with names of their own; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.llm.common import raw_texts, texts

# Words that a task works on together; a longer document is a chunk of its own.
CHUNK_WORDS = 1 << 18
# A run's least length in words.
LEAST = 12
WHITE = r"[\x20\x09-\x0D]+"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.large_string())])


class _Grams:
    """Names of all grams of 1, 2, 4 ... words; -1 where a gram does not recur in its document."""

    def __init__(self, words: np.ndarray):
        self.n, self.levels = len(words), []
        self.keys = self.places = np.empty(0, np.int64)
        self._name(words, np.arange(self.n))

    def _name(self, key: np.ndarray, places: np.ndarray) -> None:
        """Add a level whose grams start at ``places`` and are equal where ``key`` is."""
        order = np.argsort(key, kind="stable")
        key, places = key[order], places[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        lone = first & np.append(first[1:], True)
        name = np.cumsum(first & ~lone) - 1
        # Sorted by name, then place: the index in which a gram's occurrences are looked up.
        self.places = places[~lone]
        self.keys = name[~lone] * (self.n + 1) + self.places
        # One more cell stands for every place beyond the text.
        level = np.full(self.n + 1, -1, np.int64 if self.n > 1 << 30 else np.int32)
        level[self.places] = name[~lone]
        self.levels.append(level)

    def double(self) -> None:
        step, level = 1 << (len(self.levels) - 1), self.levels[-1]
        at = np.sort(self.places)
        at = at[at + step < self.n]
        at = at[level[at + step] >= 0]
        self._name(level[at].astype(np.int64) * (self.n + 1) + level[at + step], at)

    def pairs(self, every: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of grams at multiples of ``every`` and their recurrences at lags low to high - 1."""
        seeds = self.places[self.places % every == 0]
        base = self.levels[-1][seeds].astype(np.int64) * (self.n + 1)
        a = np.searchsorted(self.keys, base + np.minimum(seeds + low, self.n))
        b = np.searchsorted(self.keys, base + np.minimum(seeds + high, self.n))
        found = b - a
        left = np.repeat(seeds, found)
        at = np.arange(len(left)) - np.repeat(np.cumsum(found) - found, found) + np.repeat(a, found)
        return left, self.places[at] - left

    def grown(self, low: np.ndarray, high: np.ndarray, lag: np.ndarray, below: int):
        """The matches [low, high) at each lag, grown at both ends by less than 2^below words."""
        for level in reversed(range(below)):
            step, names = 1 << level, self.levels[level]
            one, other = names[high], names[np.minimum(high + lag, self.n)]
            high = high + step * ((one == other) & (one >= 0))
            before = np.where(low >= step, low - step, self.n)
            one, other = names[before], names[np.minimum(before + lag, self.n)]
            low = low - step * ((one == other) & (one >= 0))
        return low, high


def find_runs(words: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs, by start, then period.

    Equal numbers in ``words`` are equal words; documents that follow each other
    must share no number.  ``least`` is at least 12.
    """
    if least < LEAST:
        raise ValueError(f"runs are found from {LEAST} words on")
    grams, found = _Grams(words), []
    while len(grams.places):
        level = len(grams.levels) - 1
        size = 1 << level
        classes = []
        if level == 2:
            classes.append((3, 1, 8))
        if level >= 2:
            classes.append((size, 2 * size, 4 * size))
        for every, low, high in classes:
            left, lag = grams.pairs(every, low, high)
            order = np.lexsort((left, lag))
            left, lag = left[order], lag[order]
            fresh = np.ones(len(left), bool)
            fresh[1:] = (lag[1:] != lag[:-1]) | (left[1:] - left[:-1] != every)
            last = left[np.append(fresh[1:], True)] if len(left) else left
            lag = lag[fresh]
            start, end = grams.grown(left[fresh], last + size, lag, level)
            good = end - start >= np.maximum(least - lag, lag)
            found.append(np.stack([start[good], (end - start + lag)[good], lag[good]]))
        grams.double()
    start, length, period = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    # A stretch found at several lags has the smallest as its period; the others are multiples.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.lexsort((period[new], start[new]))
    return start[new][order], length[new][order], period[new][order]


def _chunk(ids: list, docs: list[list[bytes]], least: int) -> pa.RecordBatch:
    """Runs and collapsed texts of some documents."""
    ends = np.cumsum([len(d) for d in docs])
    numbers = np.empty(ends[-1], np.int64)
    for d, end in zip(docs, ends):
        # A word's number is where it first stands in its document.
        first, base = {}, end - len(d)
        numbers[base:end] = [first.setdefault(w, i) for i, w in enumerate(d, base)]
    start, length, period = find_runs(numbers, least)
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change)[:-1] > 0
    home = np.searchsorted(ends, start, side="right")
    offsets = np.searchsorted(home, np.arange(len(docs) + 1))
    begins = ends - [len(d) for d in docs]
    collapsed = []
    for i, d in enumerate(docs):
        if offsets[i] < offsets[i + 1]:
            gone = dropped[begins[i] : ends[i]].tolist()
            d = [w for w, g in zip(d, gone) if not g]
        collapsed.append(b" ".join(d))
    cells = pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in (start - begins[home], length, period)], fields=list(_RUN)
    )
    runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)
    texts = pa.array(collapsed, pa.large_binary()).cast(pa.large_string())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), runs, texts], schema=_OUT)


def _search(least: int, chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, docs, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                words = text.split()
                if docs and size + len(words) > chunk_words:
                    yield _chunk(ids, docs, least)
                    ids, docs, size = [], [], 0
                ids.append(doc_id)
                docs.append(words)
                size += len(words)
        if docs:
            yield _chunk(ids, docs, least)

    return run


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """All periodic runs of every document, and its text without their repetitions.

    Words are separated by white space (space, tab to carriage return) and
    numbered from 0.  A run is a maximal stretch of words with smallest period q
    and at least ``max(least, 2q)`` words.  Returns doc_id, runs (start, length,
    period; by start, then period) and collapsed: the words outside all runs and
    the first q words of each run, joined by single spaces.  A word that any run
    repeats is dropped even if it is among the first words of another.

    Defined cases: NULL and empty texts have no words, no runs and an empty
    collapsed text; a NULL doc_id stays NULL; repeated rows are returned once
    each; an empty table gives no rows; other columns are ignored.  A document
    is one cell, so one task holds it: about 4 bytes a word for each doubling of
    the longest gram that recurs in it.
    """
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), text=text)
    kind = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return named.mapInArrow(_search(least, chunk_words), kind)


def digest(found: DataFrame) -> DataFrame:
    """Of :func:`periodic_runs`: the longest run (ties: smallest start, then period) and hashes of the rest.

    Columns: doc_id, n_runs, start, length, period, exponent_milli (NULL without
    runs), runs_sha256 (a line ``start,length,period`` for each run) and
    collapsed_sha256.
    """
    order = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("*", F.inline(F.array(F.struct(F.array_max(order)["run"].alias("best")))))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def plant_runs(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) of which every tenth, by the CRC-32 of its id, repeats itself from some word on.

    With g a tenth of that number and n words, word a + i (a = g mod n) becomes word a + i mod p,
    where p = 1 + (n - a) / (3 + g mod 8), rounded down.  Other texts, NULL ids and texts without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", WHITE), lambda w: w != ""))
    # A generator keeps the words from being split again for every use.
    out = docs.select("doc_id", "text", F.expr("crc32(CAST(doc_id AS string)) div 10").alias("g"), F.inline(F.array(F.struct(words.alias("w")))))
    out = out.withColumn("a", F.when(F.size("w") > 0, F.col("g") % F.size("w")).cast("int"))
    out = out.withColumn("p", F.expr("CAST(1 + (size(w) - a) div (3 + g % 8) AS int)"))
    repeated = F.expr("transform(w, (x, i) -> IF(i < a, x, get(w, a + (i - a) % p)))")
    planted = F.when(F.size("w") > 0, F.array_join(repeated, " "))
    return out.select("doc_id", F.coalesce(planted, "text").alias("text"))
