"""Ordinal quality model: cumulative-link regression on graded ratings.

One weight per hashed text feature is shared by all grades; ordered thresholds
turn the score s of a text into P(grade > k) = sigmoid(s - threshold_k).  The
expected grade and the tail probability of the best grade follow from these.
The model is fitted on a bounded sample of rated documents; every document is
scored over its whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbwright.llm.common import Rows, arrow_schema, giving_back, raw_texts, texts

# Rated documents that a fit uses at most, chosen by a seeded hash of doc_id.
RATED_SAMPLE = 12_000
FEATURE_BITS = 18
# Features of fewer sampled documents get no weight.
LEAST_DOCUMENTS = 3
# Standard errors that the mean grade with a feature is off the mean of all.
CLEARLY = 4.0
EPOCHS, RATE, SHRINK = 120, 0.3, 1e-4
SEED = 11
# Distinct words that a task remembers before it starts afresh; bounds its memory.
REMEMBERED_WORDS = 250_000

_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#*$%&|<>"
_EDGE = b"#*$%&|<>!?.,;:()[]{}\"'-_=+/\\~`^@"
# Borders of the ranges that a share falls into, each range being one feature.
_RANGES = (0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9, 1.5)


def _slot(name: bytes) -> int:
    return xxhash.xxh3_64_intdigest(name, SEED) & ((1 << FEATURE_BITS) - 1)


def _range(share: float) -> int:
    return sum(share > r for r in _RANGES)


class Features:
    """Hashed features of a text: the words it has, and ranges of its shape."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.shapes: dict[tuple[str, int], int] = {}

    def _word(self, word: bytes) -> int:
        slot = _slot(word.strip(_EDGE) or word[:3])
        if len(word) <= 64:
            if len(self.known) >= REMEMBERED_WORDS:
                self.known.clear()
            self.known[word] = slot
        return slot

    def _shape(self, name: str, share: float) -> int:
        key = name, _range(share)
        if key not in self.shapes:
            self.shapes[key] = _slot(f" {name} {key[1]}".encode())
        return self.shapes[key]

    def __call__(self, raw: bytes) -> set[int]:
        words = raw.lower().split()
        slots = list(map(self.known.get, words))
        if None in slots:
            slots = [self._word(w) if s is None else s for w, s in zip(words, slots)]
        found, n = set(slots), max(1, len(words))
        lines = raw.split(b"\n")
        shape = self._shape
        return found | {
            shape("symbols", (len(raw) - len(raw.translate(None, _SYMBOLS))) / n),
            shape("exclaim", raw.count(b"!") / n),
            shape("upper", (len(raw) - len(raw.translate(None, _UPPER))) / max(1, len(raw))),
            shape("repeat", sum(map(eq, words, words[1:])) / n),
            shape("few", 1 - len(set(words)) / n),
            shape("lines", 1 - len(set(lines)) / len(lines)),
            shape("long", math.log2(n) / 20),
        }


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature slot and ascending thresholds; grades are 0 .. len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: float) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))


def _telling(slots: np.ndarray, lengths: np.ndarray, grades: np.ndarray, size: int) -> np.ndarray:
    """Features of enough documents whose mean grade is clearly off the mean of all."""
    spread = grades.std()
    counts = np.bincount(slots, minlength=size)
    off = np.bincount(slots, weights=np.repeat(grades - grades.mean(), lengths), minlength=size)
    return (counts >= LEAST_DOCUMENTS) & (np.abs(off) > CLEARLY * spread * np.sqrt(np.maximum(counts, 1)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, top: int) -> OrdinalModel:
    """Maximum likelihood with a small L2 penalty, by diagonal-scaled gradient steps.

    Without two different grades there is nothing to learn: all weights are 0 and
    every text is expected to have the only grade seen (the top one if none).
    """
    size = 1 << FEATURE_BITS
    weights = np.zeros(size)
    present = set(grades.tolist())
    if len(present) < 2:
        only = present.pop() if present else top
        return OrdinalModel(weights, np.where(np.arange(top) < only, -30.0, 30.0))
    lengths = np.array([len(r) for r in rows])
    slots = np.concatenate(rows)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    value = _telling(slots, lengths, grades, size)[slots].astype(float)
    above = (grades[:, None] > np.arange(top)).astype(float)
    shares = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    first = -np.log(shares[0] / (1 - shares[0]))
    # Thresholds are a first one and positive gaps, so they stay in order.
    gaps = np.log(np.maximum(np.diff(-np.log(shares / (1 - shares))), 0.1))
    seen_w, seen_first, seen_gaps = np.zeros(size), 0.0, np.zeros(top - 1)
    for epoch in range(EPOCHS):
        thresholds = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.add.reduceat(weights[slots] * value, starts)
        tail = 1 / (1 + np.exp(np.clip(thresholds - score[:, None], -50, 50)))
        # P(grade = k) is a difference of neighbouring tails.
        full = np.concatenate([np.ones((len(score), 1)), tail, np.zeros((len(score), 1))], axis=1)
        at = np.arange(len(score))
        chance = np.maximum(full[at, grades] - full[at, grades + 1], 1e-9)
        slope = full * (1 - full)
        by_tail = np.zeros_like(full)
        by_tail[at, grades] += slope[at, grades] / chance
        by_tail[at, grades + 1] -= slope[at, grades + 1] / chance
        by_tail = by_tail[:, 1:-1]
        g_score = by_tail.sum(axis=1)
        g_w = np.bincount(slots, weights=np.repeat(g_score, lengths) * value, minlength=size) / len(score) - SHRINK * weights
        g_t = -by_tail.mean(axis=0)
        g_first = g_t.sum()
        g_gaps = np.exp(gaps) * np.cumsum(g_t[::-1])[::-1][1:]
        seen_w += g_w * g_w
        seen_first += g_first * g_first
        seen_gaps += g_gaps * g_gaps
        weights = weights + RATE * g_w / (np.sqrt(seen_w) + 1e-6)
        first += RATE * g_first / (math.sqrt(seen_first) + 1e-6)
        gaps = gaps + RATE * g_gaps / (np.sqrt(seen_gaps) + 1e-6)
    return OrdinalModel(weights.astype(np.float32), first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def harm_and_quality() -> Column:
    """Grades of the labels table: 0 toxic, 1 of low quality, 2 good; NULL without a rating."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def _sampled(batches):
    # Of the task: a worker's next tasks may be of other stages, which need its memory.
    features, rows = Features(), Rows(arrow_schema({"grade": pa.int32(), "slots": pa.list_(pa.int32())}))
    for batch in batches:
        for grade, raw in zip(batch.column("grade").to_pylist(), raw_texts(batch)):
            slots = sorted(features(raw))
            rows.add(grade, slots, size=4 * len(slots))
            yield from rows.take()
    yield from rows.take(last=True)


def fit(
    docs: DataFrame, labels: DataFrame, grade: Column | None = None, top: int = 2, sample: int = RATED_SAMPLE
) -> OrdinalModel:
    """Fit on at most ``sample`` rated documents; ``grade`` gives 0 .. ``top`` from a row of labels.

    Defined cases: labels without a grade or a doc_id are left out; of several
    grades of a document the lowest counts; NULL texts are empty.
    """
    grade = harm_and_quality() if grade is None else grade
    rated = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade")).dropna()
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    # At most ``sample`` rows of two numbers.
    found = named.join(F.broadcast(chosen), "doc_id").select("grade", "text")
    features = found.mapInArrow(giving_back(_sampled), "grade int, slots array<int>")
    rows, grades = [], []
    for r in features.toLocalIterator():
        rows.append(np.array(r["slots"], np.int32))
        grades.append(r["grade"])
    # A fixed order makes reruns agree.
    order = sorted(range(len(rows)), key=lambda i: (grades[i], rows[i].tobytes()))
    return fit_ordinal([rows[i] for i in order], np.array([grades[i] for i in order], np.int64), top)


def _marks(raw: bytes, features: Features, weights: list, model: OrdinalModel) -> tuple[float, float]:
    """Expected grade and the probability of the best grade."""
    tails = model.tails(sum(map(weights.__getitem__, features(raw))))
    return float(tails.sum()), float(tails[-1])


def _scorer(shared, least: float):
    schema = arrow_schema(
        {"doc_id": pa.int64(), "expected_grade": pa.float64(), "p_best": pa.float64(), "kept": pa.bool_()}
    )

    def run(batches):
        model, features, rows = shared.value, Features(), Rows(schema)
        weights = model.weights.tolist()
        for batch in batches:
            for key, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                expected, best = _marks(raw, features, weights, model)
                rows.add(key, expected, best, best >= least)
            yield from rows.take()
        yield from rows.take(last=True)

    return run


def score(docs: DataFrame, model: OrdinalModel, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_best (probability of the best grade) and kept (p_best is ``least`` or more).

    Defined cases: NULL and empty texts are scored on their shape alone; a NULL
    doc_id stays NULL; repeated rows give a row each; an empty table gives no
    rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    kind = "doc_id long, expected_grade double, p_best double, kept boolean"
    return named.mapInArrow(giving_back(_scorer(shared, least)), kind)


def _keeper(shared, least: float):
    def run(batches):
        model, features = shared.value, Features()
        weights = model.weights.tolist()
        for batch in batches:
            keep = [_marks(raw, features, weights, model)[1] >= least for raw in raw_texts(batch)]
            yield batch.select(["row"]).filter(pa.array(keep, pa.bool_()))

    return run


def select(docs: DataFrame, model: OrdinalModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score`` keeps.

    Defined cases: NULL and empty texts are judged on their shape alone; rows with
    a NULL doc_id and repeated rows are judged one by one; an empty table gives no
    rows; columns of any name are kept as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = texts(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = whole.mapInArrow(giving_back(_keeper(shared, least)), StructType([whole.schema["row"]]))
    return kept.select("row.*")
