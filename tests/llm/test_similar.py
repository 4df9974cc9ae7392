"""The pipeline's near-duplicates against brute-force Jaccard similarity."""

import math
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from plumbwright.llm import similar


def words_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else {()}


def kept_brute(rows):
    sets = {i: words_of(t) for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = root[b], root[a]
                root = {i: new if r == old else r for i, r in root.items()}
    smallest = {}
    for i, r in root.items():
        smallest[r] = min(i, smallest.get(r, i))
    return sorted(smallest.values())


def variants():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common = [word() for _ in range(60)]
    texts = [" ".join(word() for _ in range(n)) for n in range(12)] + ["", "  "]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(5, 300))] + common * rng.randint(0, 1)
        for _ in range(12):
            new = list(base)
            for _ in range(rng.randint(0, 1 + len(new) // 25)):
                new[rng.randrange(len(new))] = word()
            texts.append(" ".join(new[: rng.randint(len(new) * 7 // 8, len(new))]))
    return list(enumerate(texts))


@pytest.mark.parametrize("limit", [2048, 4])
def test_stage_links_all_pairs_of_similarity_080(spark, make, monkeypatch, limit):
    monkeypatch.setattr(similar, "GROUP_LIMIT", limit)
    rows = variants()
    got = corpus_pipeline.drop_near_copies(spark, make(rows), "")
    assert sorted(r["doc_id"] for r in got.collect()) == kept_brute(rows)


def barely_similar(rng, larger, smaller):
    """Two sets with as few values in common as a similarity of 0.8 allows."""
    both = math.ceil(4 * (larger + smaller) / 9)
    values = rng.integers(0, 1 << 63, larger + smaller - both, dtype=np.uint64) * np.uint64(2)
    return values[:larger], values[larger - both :]


def apart(a, b):
    return int(np.bitwise_count(similar.wide_print(a) ^ similar.wide_print(b)).sum())


@pytest.mark.parametrize("larger", [9, 10, 13, 14, 16, 24, 32, 65, 300, 2000])
def test_fingerprints_of_similar_sets_are_within_the_radius(larger):
    rng = np.random.default_rng(larger)
    for smaller in {larger, -(-larger * 9 // 10), -(-larger * 4 // 5)}:
        found = [apart(*barely_similar(rng, larger, smaller)) for _ in range(60)]
        assert max(found) <= similar.RADIUS
        assert np.mean(found) + 4 * np.std(found) <= similar.RADIUS


def test_fingerprint_counts_every_bit():
    values = np.random.default_rng(3).integers(0, 1 << 63, 700, dtype=np.uint64)
    for part in (values[:1], values[:255], values[:256], values):
        bits = np.array([[int(v) >> k & 1 for k in range(64)] for v in part])
        assert similar._ones(part).tolist() == bits.sum(axis=0).tolist()


def test_index_proposes_every_close_pair_of_different_components():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, (12, similar.WORDS), dtype=np.uint64)
    prints = base[rng.integers(0, 12, 400)]
    for row in prints:
        for bit in rng.integers(0, 64 * similar.WORDS, rng.integers(0, 140)).tolist():
            row[bit // 64] ^= np.uint64(1 << bit % 64)
    buckets = np.sort(rng.integers(0, 4, 400))
    judged, roots = rng.random(400) < 0.95, rng.integers(0, 60, 400)
    index = similar.WideIndex(buckets, prints, judged, roots)
    got = sorted((int(a), int(b)) for pair in index.close_pairs(similar.RADIUS) for a, b in zip(*pair))
    want = []
    for a in range(400):
        for b in range(a + 1, 400):
            differ = int(np.bitwise_count(prints[a] ^ prints[b]).sum()) if judged[a] and judged[b] else 0
            if buckets[a] == buckets[b] and roots[a] != roots[b] and differ <= similar.RADIUS:
                want.append((a, b))
    assert got == want


def family(rng, n):
    """Prints close to each other."""
    prints = np.tile(rng.integers(0, 1 << 63, similar.WORDS, dtype=np.uint64), (n, 1))
    for row in prints:
        for bit in rng.integers(0, 64 * similar.WORDS, 20).tolist():
            row[bit // 64] ^= np.uint64(1 << bit % 64)
    return prints


def bucket_rows(key, side, nodes, prints, keys):
    early = [sorted(keys[i])[: similar.EARLY] for i in nodes]
    size = len(nodes)
    cells = {"node": nodes, "root": nodes, "n": [50] * size, "print": [prints[i].tobytes() for i in nodes]}
    kinds = {"early": pa.list_(pa.int64())}
    cells |= {"early": early, "key": [key] * size, "side": side, "bucket": [key] * size}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k)) for k, v in cells.items()], names=list(cells))


def proposed(batches):
    return sorted((a, b) for out in similar._pairs(batches) for a, b in zip(*(c.to_pylist() for c in out.columns)))


def test_pair_of_many_keys_is_proposed_once_and_of_any_key_at_all():
    rng = np.random.default_rng(8)
    prints = family(rng, 30)
    keys = {i: set(rng.choice(40, rng.integers(1, 25), replace=False).tolist()) for i in range(30)}
    batches = []
    for key in range(40):
        nodes = [i for i in keys if key in keys[i]]
        batches += [bucket_rows(key, [-1] * len(nodes), nodes, prints, keys)] * bool(nodes)
    got = proposed(batches)
    want = {(a, b) for a in keys for b in keys if a < b and keys[a] & keys[b]}
    assert set(got) == want
    repeated = sum(len(keys[a] & keys[b]) for a, b in want)
    least = {i: set(sorted(k)[: similar.EARLY]) for i, k in keys.items()}
    assert all(got.count((a, b)) == 1 for a, b in want if least[a] & least[b])
    assert len(got) < repeated / 3


def test_parts_of_a_key_propose_each_pair_in_one_bucket():
    prints, keys = family(np.random.default_rng(4), 6), {i: {7} for i in range(6)}
    parts = [[0, 1, 2], [3, 4, 5]]
    batches = [bucket_rows(7, [-1] * 3, part, prints, keys) for part in parts]
    batches.append(bucket_rows(7, [0] * 3 + [1] * 3, parts[0] + parts[1], prints, keys))
    got = [pair for batch in batches for pair in proposed([batch])]
    assert sorted(got) == [(a, b) for a in range(6) for b in range(a + 1, 6)]


def roots_of(nodes, links):
    root = {i: i for i in nodes}
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()}
    return root


def crowd(rng, size, n=50):
    """Sets of ``n`` values that share most of them, of a similarity around 0.8."""
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    sets = {}
    for i in range(size):
        sets[i] = base.copy()
        other = rng.choice(n, rng.integers(0, 9), replace=False)
        sets[i][other] = rng.integers(0, 1 << 63, len(other), dtype=np.uint64)
    return {i: np.sort(values) for i, values in sets.items()}


@pytest.mark.parametrize("shingles", [1 << 19, 1500])
@pytest.mark.parametrize("at_once", [10_000, 37])
def test_crowds_are_linked_as_by_all_pairs(monkeypatch, shingles, at_once):
    monkeypatch.setattr(similar, "RUN_SHINGLES", shingles)
    rng = np.random.default_rng(11)
    sets = dict(enumerate([*crowd(rng, 110).values(), *crowd(rng, 12).values()]))
    prints = {i: similar.wide_print(values) for i, values in sets.items()}
    keys = {i: set(values[:11].tolist()) for i, values in sets.items()}
    batches = []
    for key in sorted(set().union(*keys.values())):
        nodes = [i for i in sets if key in keys[i]]
        # The commonest keys come in two parts, as if they had too many documents.
        parts = [[i for i in nodes if i % 2 == k] for k in (0, 1)]
        if len(nodes) > 70:
            batches += [bucket_rows(key, [-1] * len(part), part, prints, keys) for part in parts]
            batches.append(bucket_rows(key, [i % 2 for i in nodes], nodes, prints, keys))
        elif len(nodes) > 1:
            batches.append(bucket_rows(key, [-1] * len(nodes), nodes, prints, keys))
    # Each of them is a bucket.
    batches = [b.set_column(7, "bucket", pa.array([at] * len(b))) for at, b in enumerate(batches)]
    rows = pa.Table.from_batches(batches).to_batches(max_chunksize=at_once)
    found = pa.Table.from_batches(similar._proposed(rows)).to_pylist()
    pairs = [(r["a"], r["b"]) for r in found if r["b"] is not None]
    members = [{"node": r["a"], "hashes": sets[r["a"]].tobytes()} | r for r in found if r["b"] is None]
    members.sort(key=lambda r: (r["bucket"], r["low"], r["high"]))
    assert members
    held = pa.Table.from_pylist(members, similar._PROPOSED.append(pa.field("node", pa.int64())).append(pa.field("hashes", pa.binary())))
    links = [(r["a"], r["b"]) for out in similar._crowd_links(held.to_batches(max_chunksize=at_once)) for r in out.to_pylist()]
    assert len(links) < len(members)
    alike = lambda a, b: 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))
    want = roots_of(sets, [(a, b) for a in sets for b in sets if a < b and alike(a, b)])
    assert 1 < len(set(want.values())) < len(sets)
    assert roots_of(sets, links + [pair for pair in pairs if alike(*pair)]) == want


def test_rows_of_a_crowd_follow_its_documents(spark, make, monkeypatch):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    counts = {}
    write = similar.write_table

    def counted(df, name):
        out = write(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(similar, "write_table", counted)
    got = similar.one_of_similar(make(rows))
    want = kept_brute(rows)
    assert 1 < len(want) and sorted(r["doc_id"] for r in got.collect()) == want
    # All pairs are 12,720.
    assert sum(counts.get(name, 0) for name in ("stars", "proposed", "candidates")) < 4_000


def test_index_opens_few_pairs_at_once():
    prints = family(np.random.default_rng(6), similar.GROUP_LIMIT)
    index = similar.WideIndex(np.zeros(len(prints), np.int64), prints, np.ones(len(prints), bool), np.arange(len(prints)))
    tracemalloc.start()
    found = sum(len(a) for a, _ in index.close_pairs(similar.RADIUS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == len(prints) * (len(prints) - 1) // 2
    assert peak < 32 << 20


def test_only_wanted_texts_leave_the_scan(spark):
    texts = [f"text {i}" for i in range(400)]
    nodes = [similar._node(t.encode()) for t in texts]
    wanted = spark.createDataFrame([(n,) for n in nodes[:40]], "print long")
    bits = similar.suspect_table(wanted, similar.SUSPECT_BITS)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    out = list(similar._with_nodes(SimpleNamespace(value=bits), similar.SUSPECT_BITS)([batch]))
    got = {n: t for part in out for n, t in zip(*(c.to_pylist() for c in part.columns))}
    assert {n: got.get(n) for n in nodes[:40]} == dict(zip(nodes, texts[:40]))
    assert len(got) < 60


def test_odd_rows(spark, odd, empty):
    kept = similar.one_of_similar(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {1, 7, None} <= set(ids) and not {2, 3, 8} & set(ids) and ids.count(4) == 2
    assert similar.one_of_similar(empty).count() == 0
