"""Exact, near and substring duplicates against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from plumbwright.llm import common, components, exact_dedup, simhash_index, suffix_dedup

WHITE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def exact_brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault((text or "").translate(WHITE), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            sha = hashlib.sha256(norm.encode()).hexdigest()
            out.append((rows[m[3]][0], rows[best[3]][0], len(members), m[:3] == best[:3], sha))
    return sorted(out, key=repr)


def test_exact_groups_equal_brute_force(make):
    random.seed(3)
    rows = [(i, "".join(random.choice("ab \n") for _ in range(random.randint(0, 4)))) for i in range(400)]
    got = exact_dedup.exact_groups(make(rows, 7))
    assert sorted(map(tuple, got.collect()), key=repr) == exact_brute(rows)
    # A table of one bit segment makes nearly every text a suspect: the result is the same.
    crowded = exact_dedup.exact_groups(make(rows, 7), suspect_bits=1 << 16)
    assert sorted(map(tuple, crowded.collect()), key=repr) == exact_brute(rows)


def test_exact_groups_of_odd_rows(odd, empty):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == 11 and sum(r["kept"] for r in rows) == 7
    blank = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {r["keep_id"] for r in blank} == {3} and {r["group_size"] for r in blank} == {3}
    assert sorted(r["kept"] for r in rows if r["doc_id"] == 4) == [False, True]
    assert exact_dedup.exact_groups(empty).collect() == []
    kept = exact_dedup.unique_documents(odd)
    assert kept.columns == odd.columns and kept.count() == 7
    assert exact_dedup.unique_documents(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 1000])
def test_rice_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 60, n, np.uint64))
    assert np.array_equal(exact_dedup.rice_decode(len(values), *exact_dedup.rice_encode(values)), values)
    zero = np.zeros(1, np.uint64)
    assert np.array_equal(exact_dedup.rice_decode(1, *exact_dedup.rice_encode(zero)), zero)


def print_brute(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_brute(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def test_near_groups_equal_brute_force(make, sample):
    texts = [(i, t) for i, t, _ in sample[1]] + [(1000, "one two"), (1001, "one two"), (1002, "")]
    prints = {i: print_brute(t) for i, t in texts}
    roots = component_brute(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = {r[0]: (int(r[1], 16), r[2]) for r in simhash_index.near_groups(make(texts)).collect()}
    assert got == {i: (prints[i], roots[i]) for i in prints}


def test_near_groups_of_odd_rows(odd, empty):
    got = [tuple(r) for r in simhash_index.near_groups(odd).collect()]
    assert len(got) == 11
    assert {r[2] for r in got if r[0] in (1, 2, 3)} == {1} and {r[1] for r in got if r[0] == 1} == {"0" * 16}
    assert {r[2] for r in got if r[0] in (7, 8)} == {7}
    assert [r[2] for r in got if r[0] is None] == [None]
    assert simhash_index.near_groups(empty).collect() == []
    kept = simhash_index.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {1, 7, None} <= set(ids) and not {2, 3, 8} & set(ids) and ids.count(4) == 2
    assert simhash_index.one_of_each(empty).count() == 0


def crowd(seed, n=600):
    rng = random.Random(seed)
    out = set()
    for _ in range(n // 20):
        base = rng.getrandbits(64)
        for _ in range(20):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    return np.array(sorted(out), np.uint64)


def test_index_finds_all_close_pairs():
    values = crowd(1)
    buckets = (values % np.uint64(3)).astype(np.int64)
    order = np.lexsort((simhash_index.gray_rank(values), buckets))
    index = simhash_index.Index(buckets[order], values[order])
    found = {frozenset((int(order[i]), int(order[j]))) for a, b in index.close_pairs(4) for i, j in zip(a, b)}
    want = {
        frozenset((i, j))
        for i in range(len(values))
        for j in range(i)
        if buckets[i] == buckets[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 4
    }
    assert found == want


@pytest.mark.parametrize("limit", [4096, 3])
def test_dealing_crowded_buckets_again_loses_no_link(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash_index, "BUCKET_LIMIT", limit)
    values = crowd(2, 300).view(np.int64).tolist()
    links = simhash_index.close_links(spark.createDataFrame([(v,) for v in values], "print long"))
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = component_brute(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {v: roots.get(v, v) for v in values} == want


def test_no_bucket_exceeds_the_limit_in_any_round(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(simhash_index, "BUCKET_LIMIT", 16)
    seen = str(tmp_path)
    inner = simhash_index._bucket_links

    def spy(buckets, prints, radius):
        pairs = set(zip(buckets.tolist(), prints.tolist()))
        assert len(pairs) == len(prints), "copies of a print in a bucket"
        sizes = np.unique(buckets, return_counts=True)[1]
        with open(f"{seen}/{random.getrandbits(64)}", "w") as f:
            f.write(str(max(sizes, default=0)))
        return inner(buckets, prints, radius)

    def search(radius):
        def run(batches):
            for batch in batches:
                table = [batch.column(c).to_numpy() for c in ("bucket", "print")]
                a, b = spy(table[0], table[1].view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        return run

    monkeypatch.setattr(simhash_index, "_search", search)
    # One tight family: no layout of blocks thins its buckets below the limit.
    values = sorted({sum(1 << b for b in pair) for pair in itertools.combinations(range(0, 64, 2), 2)})
    links = simhash_index.close_links(spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "print long"))
    roots = {r["root"] for r in components.components(links).collect()}
    assert len(roots) == 1
    assert max(int(p.read_text()) for p in tmp_path.iterdir()) <= 40


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def cut_brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        out.setdefault(doc_id, []).append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def cut(docs):
    out = {}
    for r in suffix_dedup.remove_repeats(docs).collect():
        out.setdefault(r[0], []).append(tuple(r[1:5]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("sender", [4 << 20, 20_000])
def test_repeats_equal_brute_force(make, small, monkeypatch, sender):
    monkeypatch.setattr(suffix_dedup, "SENDER_BYTES", sender)
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert cut(make(rows)) == cut_brute(rows)


def test_repeats_at_every_offset_and_in_periodic_texts(make, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SENDER_BYTES", 3_000)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(130)
    rows = [(i, word(rng.randint(0, 40)) + passage[i % 31 : 100 + rng.randint(0, 30)] + word(20)) for i in range(80)]
    rows += [(100 + i, "For " * (30 + i)) for i in range(12)] + [(200, "z" * 400), (201, "z" * 99), (202, "z" * 100)]
    assert cut(make(rows)) == cut_brute(rows)


def test_owners_of_anchors_get_even_shares(make):
    """Anchors are the least of many fingerprints; their plain values would give one owner most of them."""
    rng = random.Random(6)
    rows = [(i, "".join(rng.choices("abcdefghijklmnop ", k=3_000))) for i in range(100)]
    dealt, _ = common.deal(make(rows), 50_000)
    sent = dealt.groupBy("sender").applyInArrow(suffix_dedup._send_anchors(4), suffix_dedup._MESSAGE_KIND)
    owned = {r["owner"]: r["sum(n)"] for r in sent.groupBy("owner").sum("n").collect()}
    assert len(owned) == 16 and max(owned.values()) < 1.5 * sum(owned.values()) / 16


def test_repeats_of_odd_rows(odd, empty):
    got = cut(odd)
    assert got[1] == got[2] == [(0, 0, 0, hashlib.sha256(b"").hexdigest())]
    # A string of one period starts again after one period.
    assert got[6][0][:3] == (150_000, 149_995, 1) and got[9][0][:3] == (5_000, 4_999, 1)
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_repeated_rows_keep_one_whole_text(make):
    text = "abcdefghij" * 3 + "".join(map(str, range(60)))
    got = cut(make([(1, text), (1, text), (None, text)]))
    assert sorted(r[1] for r in got[1]) == [0, len(text)] and got[None][0][1] == len(text)
