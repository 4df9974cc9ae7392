"""Quality model, host rules, source mix and language model against brute force or held-out cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from plumbwright.llm import host_rules, mixing, ngram_trie, quality_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels


def test_quality_on_documents_that_were_not_fitted(rated):
    docs, labels = rated
    model = quality_model.fit(docs, labels.filter("doc_id % 4 != 0"))
    assert list(model.thresholds) == sorted(model.thresholds)
    scored = quality_model.score(docs, model).join(labels.filter("doc_id % 4 = 0"), "doc_id")
    rows = scored.withColumn("grade", quality_model.harm_and_quality()).collect()
    kept = collections.Counter((r["grade"], r["kept"]) for r in rows)
    for grade in (0, 1):
        assert kept[grade, False] > 0.9 * (kept[grade, False] + kept[grade, True])
    assert kept[2, True] > 0.99 * (kept[2, False] + kept[2, True])
    mean = [np.mean([r["expected_grade"] for r in rows if r["grade"] == g]) for g in range(3)]
    assert mean[0] < mean[2] and mean[1] < mean[2]
    # Fitting again gives the same model.
    again = quality_model.fit(docs, labels.filter("doc_id % 4 != 0").repartition(5))
    assert np.array_equal(again.weights, model.weights)


def test_ordinal_gradient_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 600)
    rows = [np.unique(np.append(rng.integers(100, 200, 5), g if rng.random() < 0.9 else 9)) for g in grades]
    model = quality_model.fit_ordinal(rows, grades, 2)
    expected = [model.tails(float(model.weights[r].sum())).sum() for r in ([0], [1], [2])]
    assert expected[0] < 0.6 < expected[1] < 1.4 < expected[2]


def test_quality_of_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = quality_model.fit(odd, labels)
    scored = quality_model.score(odd, model)
    assert scored.count() == 11 and scored.filter("p_best between 0 and 1").count() == 11
    kept = quality_model.select(odd, model)
    assert kept.columns == odd.columns and kept.count() == scored.filter("kept").count()
    unrated = quality_model.fit(odd, labels.limit(0))
    assert quality_model.score(odd, unrated).filter("kept").count() == 11
    assert quality_model.score(empty, model).collect() == [] and quality_model.select(empty, model).count() == 0


def rules_brute(text):
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(windows)
    places = {i + k for i, t in enumerate(windows) if often[t] > 1 for k in range(3)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places),
        len(w) < 50 or 100 * len(places) > 50 * len(w),
    )


def rules(docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return {r["doc_id"]: tuple(r[n] for n in names) for r in host_rules.judge(docs).collect()}


def test_measures_equal_brute_force(make, sample):
    rng = random.Random(1)
    rows = [(i, t) for i, t, _ in sample[1]]
    rows += [(1000 + i, "".join(rng.choice("ab#|\n  é") for _ in range(rng.randint(0, 60)))) for i in range(200)]
    assert rules(make(rows)) == {i: rules_brute(t) for i, t in rows}


def test_a_bad_host_loses_all_its_documents(make):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "short", "bad.example") for i in range(40)] + [(99, good, "bad.example")]
    rows += [(100 + i, good + f" {i}", f"host{i % 4}") for i in range(80)] + [(300, good, None), (301, "x", None)]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in host_rules.judge(make(rows)).collect()}
    assert got[99] == (False, False) and got[0] == (True, False)
    assert all(got[100 + i] == (False, True) for i in range(80))
    # One failure of two documents is shrunk toward the rate of all hosts.
    assert got[300] == (False, True) and got[301] == (True, False)


def test_rules_of_odd_rows(odd, empty):
    got = host_rules.judge(odd).collect()
    assert len(got) == 11 and not any(r["kept"] for r in got)
    long = next(r for r in got if r["doc_id"] == 6)
    assert (long["n_words"], long["n_repeat_words"]) == (30_000, 30_000)
    assert host_rules.judge(empty).collect() == []


def test_main_path_is_native(sample):
    plan = host_rules.judge(sample[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def level_brute(sizes, weights, repeats=3):
    target, limited = {}, set()
    while True:
        free = [s for s in sizes if s not in limited]
        rest = sum(sizes.values()) - sum(repeats * sizes[s] for s in limited)
        target = {s: repeats * sizes[s] if s in limited else rest * weights[s] / sum(weights[f] for f in free) for s in sizes}
        over = {s for s in free if target[s] > repeats * sizes[s]}
        if not over:
            return target
        limited |= over


def check_mix(rows, got):
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = level_brute(dict(sizes), {s: 1 + i % 3 for i, s in enumerate(order)})
    taken = collections.Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(dict((i, t) for i, t, _ in rows)[r["doc_id"]] or ""))
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
        taken[r["source"]] += r["taken"]
    return {s: taken[s] - target[s] for s in sizes}


def test_mix_meets_its_targets(sample):
    docs, rows = sample
    got = mixing.mix(docs).collect()
    off = check_mix(rows, got)
    # A few words off at most, less than the shortest document.
    assert all(abs(d) <= 40 for d in off.values()), off
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)
    other = mixing.mix(docs, seed=8).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in other) != sorted((r["doc_id"], r["taken"]) for r in got)


def test_limited_sources_and_ranges_of_lots(make, monkeypatch):
    monkeypatch.setattr(mixing, "SORTED_TOGETHER", 16)
    rows = [(i, "w " * 5, "big") for i in range(1000)] + [(2000 + i, "w w w", f"tiny{i}") for i in range(6)]
    rows += [(3000, "v " * 7, None), (3001, None, None), (3002, "", "blank")]
    off = check_mix(rows, mixing.mix(make(rows)).collect())
    assert all(abs(d) < 5 for d in off.values()), off


def test_mixed_repeats_rows(odd, empty):
    times = {(r["doc_id"], r["times"]) for r in mixing.mix(odd).collect()}
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(t for _, t in times) + (dict(times)[4])
    assert mixing.mix(empty).collect() == [] and mixing.mixed(empty).count() == 0


def test_mixed_takes_as_often_as_told_from_repeated_and_null_ids(make):
    """A third of NULL ids, equal ids, equal texts: every source ends near its target, and reruns agree."""
    rows = []
    for s in "abc":
        rows += [(None, "five words in every text", s)] * 300 + [(7, "five words in every text", s)] * 300
        rows += [(None, f"six words in the text {i}", s) for i in range(200)]
        rows += [(1000 + i, "one two three " * (i % 5 + 1), s) for i in range(100)]
    docs = make(rows)
    first, again = (sorted(map(tuple, mixing.mix(d).collect()), key=str) for d in (docs, make(rows[::-1], 7)))
    assert first == again
    for s in "abc":
        mine = [r for r in first if r[1] == s]
        target, longest = mine[0][4], max(r[2] for r in mine)
        assert len(mine) == 900 and abs(sum(r[6] for r in mine) - target) <= longest, s
        assert all(r[6] <= 3 * r[2] for r in mine)
    assert mixing.mixed(docs).count() == sum(r[5] for r in first)


@pytest.mark.parametrize("table", [1 << 16, 50])
def test_fitting_counts_comes_near_any_budget(monkeypatch, table):
    monkeypatch.setattr(mixing, "TABLE_WORDS", table)
    rng = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(0, 60), rng.randint(1, 8))))
        counts = np.array([rng.randint(1, 6) for _ in lengths])
        budget = rng.randint(0, int((lengths * counts).sum()) + 5)
        taken = mixing.fit_counts(lengths, counts, budget)
        words = int((lengths * taken).sum())
        assert (taken >= 0).all() and (taken <= counts).all() and words <= budget
        assert budget - words <= lengths.max() or words == (lengths * counts).sum()


def test_ones_fill_every_budget():
    lengths, counts = np.array([1, 1000]), np.array([9000, 500])
    for budget in (0, 1, 999, 123_457, 400_001):
        assert int((lengths * mixing.fit_counts(lengths, counts, budget)).sum()) == budget


def score_brute(rows):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    texts = [(i, (t or "").encode().translate(lower).split() + [b""]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    one, two = collections.Counter(), collections.Counter()
    for i, w in texts:
        if not held(i):
            one.update(w)
            two.update(zip([b"", *w], w))
    n, v, mu = sum(one.values()), len(one), ngram_trie.MU
    base = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    seen = lambda a, w: int(ngram_trie.CODEBOOK[ngram_trie.quantise(np.array([two[a, w]]))[0]])
    out = []
    for i, w in texts:
        model = sum(math.log10((seen(a, x) + mu * base(x)) / (one[a] + mu)) for a, x in zip([b"", *w], w))
        out.append((i, held(i), len(w), sum(one[x] > 0 for x in w), n, sum(math.log10(base(x)) for x in w), model))
    return sorted(out, key=repr)


def same_scores(docs, rows):
    got = sorted(map(tuple, ngram_trie.score(docs).collect()), key=repr)
    want = score_brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    return got


@pytest.mark.parametrize("spread", [100_000, 100])
def test_scores_equal_brute_force(make, sample, monkeypatch, spread):
    monkeypatch.setattr(ngram_trie, "SENDER_BYTES", 60_000)
    monkeypatch.setattr(ngram_trie, "SPREAD", spread)
    rows = [(i, t) for i, t, _ in sample[1]]
    got = same_scores(make(rows), rows)
    unseen = [g for g in got if g[1]]
    assert sum(g[6] for g in unseen) > sum(g[5] for g in unseen)


def test_scores_of_odd_rows(odd, empty, make):
    same_scores(odd, [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert ngram_trie.score(empty).collect() == []
    alone = next(i for i in range(100) if ngram_trie.held_out(i))
    same_scores(make([(alone, "only held out")]), [(alone, "only held out")])


def test_trie_finds_only_its_pairs():
    rng = np.random.default_rng(3)
    pairs = np.unique(rng.integers(0, 40, (300, 2)), axis=0).astype(np.uint64)
    counts = rng.integers(1, 500, len(pairs))
    trie = ngram_trie.Trie.build(pairs[:, 0], pairs[:, 1], counts)
    v, w = (g.ravel().astype(np.uint64) for g in np.meshgrid(np.arange(50), np.arange(50), indexing="ij"))
    known = {tuple(p): c for p, c in zip(pairs.tolist(), counts.tolist())}
    got = ngram_trie.CODEBOOK[trie.values(v, w)]
    for a, b, g in zip(v.tolist(), w.tolist(), got.tolist()):
        c = known.get((a, b), 0)
        assert g <= c and (g == c if c < 97 else 7 * g > 6 * c - 7)
    assert trie.size() < 6 * len(pairs)


@pytest.mark.parametrize("values", [[0], [5], [0, 0, 3, 3, 9], list(range(0, 5000, 7))])
def test_elias_fano_round_trip(values):
    given = np.array(values, np.uint64)
    assert np.array_equal(ngram_trie.ef_decode(*ngram_trie.ef_encode(given)), given)
    assert len(ngram_trie.ef_decode(*ngram_trie.ef_encode(given[:0]))) == 0


def plain_ordinal(rows, grades, top, epochs):
    """The same ascent by loops: likelihoods of single documents, slopes by finite differences."""
    mean = sum(grades) / len(grades)
    spread = math.sqrt(sum((g - mean) ** 2 for g in grades) / len(grades))
    telling = []
    for slot in sorted({s for r in rows for s in r}):
        having = [g for r, g in zip(rows, grades) if slot in r]
        clear = abs(sum(g - mean for g in having)) > quality_model.CLEARLY * spread * math.sqrt(len(having))
        if len(having) >= quality_model.LEAST_DOCUMENTS and clear:
            telling.append(slot)

    def thresholds(values):
        out = [values[len(telling)]]
        for gap in values[len(telling) + 1 :]:
            out.append(out[-1] + math.exp(gap))
        return out

    def gain(values):
        weights, total = dict(zip(telling, values)), 0.0
        for r, g in zip(rows, grades):
            score = sum(weights.get(s, 0.0) for s in r)
            tails = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds(values)), 0.0]
            total += math.log(tails[g] - tails[g + 1])
        return total / len(rows) - quality_model.SHRINK / 2 * sum(w * w for w in weights.values())

    shares = [sum(g > k for g in grades) / len(grades) for k in range(top)]
    starts = [-math.log(s / (1 - s)) for s in shares]
    values = [0.0] * len(telling) + [starts[0]] + [math.log(max(b - a, 0.1)) for a, b in zip(starts, starts[1:])]
    seen = [0.0] * len(values)
    for _ in range(epochs):
        slopes = []
        for k in range(len(values)):
            up, down = ([v + d * (i == k) for i, v in enumerate(values)] for d in (1e-5, -1e-5))
            slopes.append((gain(up) - gain(down)) / 2e-5)
        seen = [s + g * g for s, g in zip(seen, slopes)]
        values = [v + quality_model.RATE * g / (math.sqrt(s) + 1e-6) for v, g, s in zip(values, slopes, seen)]
    return dict(zip(telling, values)), thresholds(values)


def test_fit_agrees_with_plain_likelihood(monkeypatch):
    monkeypatch.setattr(quality_model, "EPOCHS", 25)
    rng = random.Random(4)
    grades = [rng.choice((0, 1, 2, 2)) for _ in range(120)]
    rows = [sorted({g if rng.random() < 0.9 else rng.randrange(3), 5 + (g == 2), 10 + rng.randrange(4)}) for g in grades]
    model = quality_model.fit_ordinal([np.array(r) for r in rows], np.array(grades), 2)
    weights, thresholds = plain_ordinal(rows, grades, 2, 25)
    assert {5, 6} <= set(weights) and set(np.flatnonzero(model.weights).tolist()) == set(weights)
    assert [model.weights[s] for s in weights] == pytest.approx(list(weights.values()), abs=2e-4)
    assert model.thresholds.tolist() == pytest.approx(thresholds, abs=2e-4)


def plain_features(text):
    """Feature slots of a text, by their definition."""
    slot = lambda name: xxhash.xxh3_64_intdigest(name.encode(), quality_model.SEED) % 2**quality_model.FEATURE_BITS
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split()
    n, size, lines = max(1, len(words)), len(text), text.split("\n")
    shape = {
        "symbols": sum(c in "#*$%&|<>" for c in text) / n,
        "exclaim": text.count("!") / n,
        "upper": sum("A" <= c <= "Z" for c in text) / max(1, size),
        "repeat": sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / n,
        "few": 1 - len(set(words)) / n,
        "lines": 1 - len(set(lines)) / len(lines),
        "long": math.log2(n) / 20,
    }
    borders = (0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9, 1.5)
    edge = "#*$%&|<>!?.,;:()[]{}\"'-_=+/\\~`^@"
    return {slot(w.strip(edge) or w[:3]) for w in words} | {slot(f" {k} {sum(v > b for b in borders)}") for k, v in shape.items()}


def test_scores_agree_with_plain_scorer(spark):
    rng = np.random.default_rng(8)
    weights = rng.normal(0, 0.2, 1 << quality_model.FEATURE_BITS).astype(np.float32)
    model = quality_model.OrdinalModel(weights, np.array([-0.5, 0.7]))
    texts = ["", " \n\t", "Good words. Good WORDS, (again)!", "$$$ *** buy buy buy!!!", "a\na\nb", "x" * 90, "word " * 30_000]
    texts += [" ".join(rng.choice(["Alpha", "beta,", "beta", "#1", "--", "!!"], 40)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_model.score(docs, model).collect()}
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        total = sum(float(weights[s]) for s in plain_features(text))
        tails = [1 / (1 + math.exp(t - total)) for t in (-0.5, 0.7)]
        assert got[i]["expected_grade"] == pytest.approx(sum(tails), abs=1e-9)
        assert got[i]["p_best"] == pytest.approx(tails[1], abs=1e-9)
        assert got[i]["kept"] == (tails[1] >= 0.5)
    assert {r["doc_id"] for r in quality_model.select(docs, model).collect()} == {i for i in got if got[i]["kept"]}
