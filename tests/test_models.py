import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from samples import CITIES

from plumbwright.functions import vectors
from plumbwright.operators import encode, evaluate, impute, ordering, regress, scale, selection, split

# -- evaluation -------------------------------------------------------------


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "y_true string, y_pred string")


TRUTH = ["ham"] * 12 + ["spam"] * 4
PREDICTED = ["ham"] * 11 + ["spam"] * 4 + ["ham"]


def test_classification_report(spark, rows):
    df = labels(spark, list(zip(TRUTH, PREDICTED)))
    m = evaluate.confusion_matrix(df)
    assert sorted(rows(m)) == [("ham", "ham", 11), ("ham", "spam", 1), ("spam", "ham", 1), ("spam", "spam", 3)]
    got = {r.label: (round(r.precision, 3), round(r.recall, 3), round(r.f1, 3), r.support) for r in evaluate.per_class(m).collect()}
    assert got == {"ham": (0.917, 0.917, 0.917, 12), "spam": (0.75, 0.75, 0.75, 4)}
    s = evaluate.evaluation_summary(m).first()
    assert (s.n, s.accuracy, round(s.macro_f1, 3)) == (16, 0.875, 0.833)
    assert evaluate.accuracy(df).first()[0] == 0.875
    assert rows(evaluate.confusion_counts(df, "spam")) == [(3, 1, 1, 11)]
    assert evaluate.classification_report(m).count() == 10


def test_lazy_classifier(spark):
    m = evaluate.confusion_matrix(labels(spark, [(t, "ham") for t in TRUTH]))
    s = evaluate.evaluation_summary(m).first()
    assert (s.accuracy, round(s.macro_f1, 3)) == (0.75, 0.429)


def test_class_that_is_only_predicted_is_not_averaged(spark, rows):
    m = evaluate.confusion_matrix(labels(spark, [("a", "a"), ("a", "b"), (None, None)]))
    got = {r.label: (r.tp, r.fp, r.fn, r.support) for r in evaluate.class_counts(m).collect()}
    assert got == {"a": (1, 0, 1, 2), None: (1, 0, 0, 1)}


def test_empty_labels(spark):
    df = labels(spark, [])
    assert tuple(evaluate.evaluation_summary(evaluate.confusion_matrix(df)).first()) == (0, 0.0, 0.0)
    assert evaluate.accuracy(df).first()[0] == 0.0


def test_pairing_truncates_to_the_shorter(spark):
    t = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "i int, y_true string")
    p = spark.createDataFrame([(0, "a"), (1, "x")], "i int, y_pred string")
    assert evaluate.pair_labels(t, p, ["i"]).count() == 2


# -- one-hot, imputation, scaling -------------------------------------------


def test_one_hot(spark, rows):
    train = spark.createDataFrame([("red", 21000), ("blue", 23500), ("silver", 22750)], "colour string, price long")
    known = encode.fit_categories(train, "colour")
    out, names = encode.one_hot(train, "colour", known)
    assert names == ["colour=blue", "colour=red", "colour=silver"] and out.columns == ["price", *names]
    assert rows(out) == [(21000, 0, 1, 0), (23500, 1, 0, 0), (22750, 0, 0, 1)]
    serve = spark.createDataFrame([("green", 19000), (None, 1)], "colour string, price long")
    assert rows(encode.one_hot(serve, "colour", known)[0]) == [(19000, 0, 0, 0), (1, 0, 0, 0)]
    assert encode.one_hot(train, "colour", [])[0].columns == ["price"]
    assert encode.one_hot(train, "colour")[1] == names


def test_one_hot_guards(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 5"):
        encode.fit_categories(df, "c", max_categories=5)
    with pytest.raises(ValueError, match="NULL"):
        encode.fit_categories(spark.createDataFrame([(None,), ("a",)], "c string"), "c")


def test_impute(spark, rows):
    df = spark.createDataFrame([(c,) for c in CITIES], "city string")
    assert rows(impute.fit_mode(df, "city")) == [("Hyderabad", 4, 9)]
    counts = dict(rows(impute.impute_mode(df, "city").groupBy("city").count()))
    assert counts == {"Hyderabad": 7, "Chennai": 2}


def test_impute_ties_and_all_missing(spark, rows):
    tied = spark.createDataFrame([(c,) for c in ["b", "a", "b", "a", "c", " NA "]], "v string")
    assert rows(impute.fit_mode(tied, "v")) == [("a", 0, 6)]
    empty = spark.createDataFrame([("",), ("NA",)], "v string")
    assert rows(impute.fit_mode(empty, "v")) == [(None, 2, 2)]
    assert rows(impute.impute_mode(empty, "v")) == [(None,), (None,)]
    fitted = impute.fit_mode(tied, "v")
    assert rows(impute.impute_mode(empty, "v", fitted)) == [("a",), ("a",)]


def values(spark, vs):
    return spark.createDataFrame([(float(v),) for v in vs], "v double")


def test_scaling(spark, rows):
    outlier = [12, 15, 14, 13, 16, 900]
    got = [round(r.scaled, 9) for r in scale.robust_scale(values(spark, outlier), "v").collect()]
    assert got == [-1.0, 0.0, round(-1 / 3, 9), round(-2 / 3, 9), round(1 / 3, 9), 295.0]
    minmax = scale.min_max_scale(values(spark, outlier), "v")
    assert rows(scale.crushed_count(minmax)) == [(5, 6)]
    assert [r.scaled for r in scale.min_max_scale(values(spark, [12, 15, 14, 13, 16]), "v").collect()] == [0, 0.75, 0.5, 0.25, 1]


def test_scaling_edges(spark):
    constant, empty = values(spark, [7] * 4), values(spark, [])
    assert [r.scaled for r in scale.min_max_scale(constant, "v").collect()] == [0.5] * 4
    assert [r.scaled for r in scale.robust_scale(constant, "v").collect()] == [0.0] * 4
    assert scale.min_max_scale(empty, "v").count() == 0 and scale.robust_scale(empty, "v").count() == 0


# -- order statistics and ranks ---------------------------------------------


@pytest.mark.parametrize("kind", ["uniform", "ties", "skewed", "sorted", "two"])
@pytest.mark.parametrize("direct", [1, 40])
def test_order_statistics(spark, kind, direct):
    rng = random.Random(kind)
    draw = {
        "uniform": lambda i: rng.random(), "ties": lambda i: float(rng.randrange(5)),
        "skewed": lambda i: 7.0 if i % 3 == 0 else rng.expovariate(1) ** 9, "sorted": lambda i: float(i),
        "two": lambda i: float(i % 2),
    }[kind]
    data = [draw(i) for i in range(3000)]
    df = values(spark, data).repartition(7)
    wanted = [0, 1, 749, 750, 1500, 2250, 2998, 2999]
    v = F.col("v")
    shared = [v, v, v, F.col("v"), F.col("v"), v, v, v]
    got = ordering.order_statistics(df, list(zip(shared, wanted)), len(data), direct_rows=direct)
    assert got == [sorted(data)[k] for k in wanted]


def test_order_statistics_of_large_integers(spark):
    data = [2**62 + i for i in range(50)] * 3
    df = spark.createDataFrame([(v,) for v in data], "v long")
    wanted = [0, 70, 149]
    got = ordering.order_statistics(df, [(F.col("v"), k) for k in wanted], len(data), direct_rows=1)
    assert got == [sorted(data)[k] for k in wanted]
    with pytest.raises(ValueError):
        ordering.order_statistics(df, [(F.col("v"), 150)], 150)


@pytest.mark.parametrize("ends", [(0.2, 0.3), (0.0, 0.01), (0.9, 1.0), (0.5, 0.5), (-1.0, 2.0)])
def test_wrong_proposals_do_not_matter(spark, ends):
    rng = random.Random(5)
    data = [rng.random() for _ in range(2000)]
    got = ordering.order_statistics(values(spark, data), [(F.col("v"), 500)], 2000, direct_rows=20, proposals=[ends])
    assert got == [sorted(data)[500]]


def test_global_rank(spark):
    rng = random.Random(1)
    data = [(rng.randrange(4), i, str(i)) for i in range(5000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "a int, b int, s string")
    got = ordering.global_rank(df, ["a", "b"]).collect()
    assert [(r.a, r.b, r.s) for r in sorted(got, key=lambda r: r["rank"])] == sorted(data)
    assert sorted(r["rank"] for r in got) == list(range(5000))


# -- splits and selection ---------------------------------------------------


def order_of(keys, seed):
    return sorted(keys, key=lambda k: hashlib.md5(f"{k}#{seed}".encode()).hexdigest())


@pytest.mark.parametrize("n", [10, 11, 999, 1000])
def test_split_sizes_are_exact_and_repeatable(spark, n):
    got = split.split_three_ways(spark.range(n).repartition(5), "id", seed=3).collect()
    order = order_of(range(n), 3)
    n_valid, n_test = int(n * 0.1), int(n * 0.4)
    n_train = n - n_valid - n_test
    want = {k: "train" if i < n_train else "valid" if i < n_train + n_valid else "test" for i, k in enumerate(order)}
    assert {r.id: r.split for r in got} == want


def test_split_of_many_rows_narrows_by_hash_range(spark, monkeypatch):
    monkeypatch.setattr(ordering.order_statistics, "__defaults__", (50, None))
    got = split.split_three_ways(spark.range(20_000), "id", seed=9)
    assert dict((r.split, r["count"]) for r in got.groupBy("split").count().collect()) == {
        "train": 10_000, "valid": 2_000, "test": 8_000,
    }


def test_split_refuses_empty_parts_and_repeated_keys(spark):
    with pytest.raises(ValueError, match="3/0/1"):
        split.split_three_ways(spark.range(4), "id")
    with pytest.raises(ValueError, match="no id"):
        split.split_three_ways(spark.createDataFrame([(1,)] * 20 + [(None,)], "id int"), "id")
    with pytest.raises(ValueError, match="unique"):
        split.split_three_ways(spark.range(100).select(F.lit(1).alias("id")), "id")


def test_split_heads_that_tie_use_the_tail(spark, monkeypatch):
    original = split._hash_part
    monkeypatch.setattr(split, "_hash_part", lambda k, s, part: original(k, s, part) % 3 if part == 0 else original(k, s, part))
    got = split.split_three_ways(spark.range(200), "id", seed=5)
    assert dict((r.split, r["count"]) for r in got.groupBy("split").count().collect()) == {"train": 100, "valid": 20, "test": 80}


def test_selection_agrees_with_brute_force(spark):
    rng = random.Random(4)
    n, seeds = 300, (1, 2)
    data = [(i, [rng.randrange(2) for _ in range(8)], rng.randrange(2)) for i in range(n)]
    candidates = [c for k in (1, 2) for c in combinations(range(8), k)][:20]
    df = spark.createDataFrame(data, "id long, f array<int>, label int")
    df = df.withColumn("bits", vectors.pack_parities(F.col("f")))
    scores = selection.bakeoff(df, "id", "bits", "label", candidates, seeds)
    got = {(r.run, r.cand_id): (r.flip, r.train, r.valid, r.test) for r in scores.collect()}
    table = {i: (f, y) for i, f, y in data}

    def accuracy(ids, idx, flip):
        return sum(((sum(table[i][0][j] for j in idx) % 2) ^ flip) == table[i][1] for i in ids) / len(ids)

    best = {}
    for seed in seeds:
        order = order_of(range(n), seed)
        parts = order[:150], order[150:180], order[180:]
        for c, idx in enumerate(candidates):
            flip = 0 if accuracy(parts[0], idx, 0) >= 0.5 else 1
            want = (flip, *[accuracy(p, idx, flip) for p in parts])
            assert got[seed, c] == pytest.approx(want)
            if seed not in best or want[2] > best[seed][1] + 1e-12:
                best[seed] = (c, want[2], want[3])
    winners = {r.run: r for r in selection.winners(scores).collect()}
    assert {s: winners[s].cand_id for s in seeds} == {s: best[s][0] for s in seeds}
    gap = selection.selection_gap(selection.winners(scores)).first()
    assert gap.n_runs == 2 and gap.mean_valid == pytest.approx(sum(b[1] for b in best.values()) / 2)


# -- regression -------------------------------------------------------------


def regression_rows():
    rng = random.Random(7)
    return [(x1, x2, 3.5 * x1 - 2.0 * x2 + 0.75 + rng.gauss(0, 0.3)) for x1, x2 in ((rng.random() * 10, rng.random() * 10) for _ in range(200))]


def test_gradient_descent_agrees_with_a_direct_loop(spark):
    np = pytest.importorskip("numpy")
    data = np.array(regression_rows())
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "x1 double, x2 double, y double")
    x, y = data[:, :2], data[:, 2]
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    w, b, history = np.zeros(2), 0.0, []
    for epoch in range(1, 401):
        err = z @ w + b - y
        if epoch == 1 or epoch % 50 == 0:
            history.append((epoch, (err**2).mean()))
        w, b = w - 0.02 * (z.T @ err) / len(y), b - 0.02 * err.mean()
    fit = regress.fit_linear(df, ["x1", "x2"], "y")
    row = fit.first()
    assert row.weights == pytest.approx((w / x.std(0, ddof=1)).tolist(), abs=1e-9)
    assert row.bias == pytest.approx(b - (w * x.mean(0) / x.std(0, ddof=1)).sum(), abs=1e-9)
    got = [(h.epoch, h.mse) for h in regress.history_rows(fit).collect()]
    assert [e for e, _ in got] == [e for e, _ in history]
    assert [m for _, m in got] == pytest.approx([m for _, m in history], abs=1e-8)
    exact, bias = regress.least_squares(df, ["x1", "x2"], "y")
    assert exact == pytest.approx([3.5, -2.0], abs=0.05) and bias == pytest.approx(0.75, abs=0.2)
    terms = {r.term: r.value for r in regress.coefficient_rows(fit, ["x1", "x2"]).collect()}
    assert terms["x1"] == pytest.approx(exact[0], abs=0.02)
