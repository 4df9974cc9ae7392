import hashlib
import random
import zlib

import numpy as np
import pytest

from plumbwright.llm import periodic


def brute(words, least=12):
    """All runs, by comparing the words at every lag."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            elif not s and start is not None:
                if i - start + q >= max(least, 2 * q):
                    found.setdefault((start, i - start + q), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def cases(seed, count):
    rng = random.Random(seed)
    for i in range(count):
        n = rng.randint(0, 120)
        if i % 5 == 0:
            yield [str(rng.randint(0, 1)) for _ in range(n)]
        elif i % 5 == 1:
            yield [str(rng.randint(0, 3)) for _ in range(n)]
        elif i % 5 == 2:
            blocks = [[str(rng.randint(0, 2)) for _ in range(rng.randint(1, 20))] * rng.randint(1, 6) for _ in range(4)]
            yield sum(blocks, [])
        elif i % 5 == 3:
            # Every short gram recurs at short lags; the long period shows only in long grams.
            yield list(fibonacci(rng.randint(5, 90)) * rng.randint(1, 3))
        else:
            yield ["0"] * n + [str(rng.randint(0, 1))] * rng.randint(0, 9) + ["0"] * rng.randint(0, 60)


def numbered(words):
    first = {}
    return np.array([first.setdefault(w, i) for i, w in enumerate(words)], np.int64)


@pytest.mark.parametrize("least", [12, 20])
def test_runs_equal_brute_force(least):
    for words in cases(least, 600):
        got = list(zip(*(c.tolist() for c in periodic.find_runs(numbered(words), least))))
        assert got == brute(words, least), words


def test_one_repeated_word_is_one_run_in_bounded_work():
    grams = periodic._Grams(np.zeros(20_000, np.int64))
    while len(grams.levels) < 5:
        grams.double()
    left, lag = grams.pairs(16, 32, 64)
    assert len(left) <= 2 * 20_000 and len(set(zip(left.tolist(), lag.tolist()))) == len(left)
    assert [c.tolist() for c in periodic.find_runs(np.zeros(20_000, np.int64))] == [[0], [20_000], [1]]


@pytest.mark.parametrize("chunk", [40, periodic.CHUNK_WORDS])
def test_documents_share_chunks_but_no_runs(make, chunk):
    rows = [(i, "\t".join(w)) for i, w in enumerate(cases(7, 200))]
    found = {r["doc_id"]: r for r in periodic.periodic_runs(make(rows), chunk_words=chunk).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        runs = brute(text.split())
        assert [tuple(r) for r in found[i]["runs"]] == runs
        assert found[i]["collapsed"] == collapse(text.split(), runs)


def test_digest_equals_planted_brute_force(sample):
    docs, rows = sample
    got = {r["doc_id"]: r for r in periodic.digest(periodic.periodic_runs(periodic.plant_runs(docs))).collect()}
    assert len(got) == len(rows)
    for doc_id, text, _ in rows:
        words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        words = [w.decode() for w in words]
        if len(words) > 4000:
            words_runs = [tuple(r) for r in zip(*(c.tolist() for c in periodic.find_runs(numbered(words))))]
        else:
            words_runs = brute(words)
        row = got[doc_id]
        assert row["n_runs"] == len(words_runs)
        best = min(words_runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        told = (row["start"], row["length"], row["period"], row["exponent_milli"])
        assert told == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in words_runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapse(words, words_runs).encode()).hexdigest()
    assert sum(r["n_runs"] > 0 for r in got.values()) > len(rows) // 20


def test_odd_and_empty_inputs(odd, empty):
    rows = periodic.periodic_runs(periodic.plant_runs(odd)).collect()
    assert len(rows) == 11 and sum(r["doc_id"] is None for r in rows) == 1
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["runs"] == [] and by[1]["collapsed"] == "" and by[2]["collapsed"] == ""
    assert [tuple(r) for r in by[6]["runs"]] == [(0, 30_000, 1)] and by[6]["collapsed"] == "word"
    assert periodic.digest(periodic.periodic_runs(periodic.plant_runs(empty))).collect() == []
    nulls = periodic.digest(periodic.periodic_runs(odd.filter("doc_id = 1"))).first()
    assert nulls["n_runs"] == 0 and nulls["length"] is None and nulls["runs_sha256"] == nulls["collapsed_sha256"]


def test_too_short_runs_are_refused():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(5, np.int64), 11)
