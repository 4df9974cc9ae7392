"""Queries: evaluation, feature preparation, selection, regression and vectors."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbwright.functions import vectors
from plumbwright.functions.cells import field
from plumbwright.operators import encode, evaluate, impute, ordering, regress, scale, selection, split
from plumbwright.plans.base import Tables, plan, sql
from plumbwright.sources.scratch import write_table

# -- evaluation -------------------------------------------------------------

_PRED = ("v_pred",)
_EV = {
    "m": "SELECT y_true, y_pred, count(*) AS n FROM v_pred GROUP BY y_true, y_pred",
    "c": """SELECT t.y_true AS label, coalesce((SELECT sum(n) FROM m WHERE m.y_true = t.y_true AND m.y_pred = t.y_true), 0)::bigint AS tp,
coalesce((SELECT sum(n) FROM m WHERE m.y_pred = t.y_true), 0)::bigint AS predicted,
(SELECT sum(n) FROM m WHERE m.y_true = t.y_true)::bigint AS support
FROM (SELECT DISTINCT y_true FROM v_pred) t""",
    "q": """SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted::double END AS pr,
CASE WHEN support = 0 THEN 0.0 ELSE tp / support::double END AS re FROM c""",
    "s": """SELECT label, tp, predicted, support, round(pr, 9) AS "precision", round(re, 9) AS recall,
CASE WHEN pr + re = 0 THEN 0.0 ELSE 2 * pr * re / (pr + re) END AS f1 FROM q""",
}


def _matrix(t: Tables):
    return evaluate.confusion_matrix(t["v_pred"])


@plan(
    "ev_pairs",
    """SELECT a.doc_id, a.quality AS y_true, b.quality AS y_pred FROM labels a
JOIN (SELECT doc_id, (n_chars > 1000)::int AS quality FROM documents) b USING (doc_id)""",
)
def ev_pairs(t: Tables):
    """Labels matched by key with a rule's predictions; documents without a label drop out."""
    truth = t["labels"].select("doc_id", F.col("quality").alias("y_true"))
    predicted = t["documents"].select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("y_pred"))
    return evaluate.pair_labels(truth, predicted, ["doc_id"])


@plan("ev_confusion", sql("SELECT * FROM m", _PRED, **_EV))
def ev_confusion(t: Tables):
    return _matrix(t)


@plan(
    "ev_counts",
    sql("SELECT label, tp, predicted - tp AS fp, support - tp AS fn, support FROM s", _PRED, **_EV),
)
def ev_counts(t: Tables):
    return evaluate.class_counts(_matrix(t))


@plan(
    "ev_binary",
    sql(
        """SELECT count(*) FILTER (WHERE y_pred = 'fr' AND y_true = 'fr') AS tp, count(*) FILTER (WHERE y_pred = 'fr' AND y_true <> 'fr') AS fp,
count(*) FILTER (WHERE y_pred <> 'fr' AND y_true = 'fr') AS fn, count(*) FILTER (WHERE y_pred <> 'fr' AND y_true <> 'fr') AS tn FROM v_pred""",
        _PRED,
    ),
)
def ev_binary(t: Tables):
    return evaluate.confusion_counts(t["v_pred"], "fr")


@plan(
    "ev_per_class",
    sql('SELECT label, "precision", recall, round(f1, 9) AS f1, support FROM s', _PRED, **_EV),
)
def ev_per_class(t: Tables):
    return evaluate.per_class(_matrix(t)).withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


_EV_SUMMARY = """SELECT (SELECT count(*) FROM v_pred) AS n,
(SELECT round(avg((y_true = y_pred)::int), 9) FROM v_pred) AS accuracy, round(avg(f1), 9) AS macro_f1 FROM s"""


@plan("ev_summary", sql(_EV_SUMMARY, _PRED, **_EV))
def ev_summary(t: Tables):
    return evaluate.evaluation_summary(_matrix(t)).withColumns({c: F.round(c, 9) for c in ("accuracy", "macro_f1")})


@plan(
    "ev_report",
    sql(
        """SELECT 'class' AS section, label, 'precision' AS metric, "precision" AS value FROM s
UNION ALL SELECT 'class', label, 'recall', recall FROM s UNION ALL SELECT 'class', label, 'f1', round(f1, 9) FROM s
UNION ALL SELECT 'class', label, 'support', support FROM s
UNION ALL SELECT 'overall', '', 'accuracy', accuracy FROM o UNION ALL SELECT 'overall', '', 'macro_f1', macro_f1 FROM o""",
        _PRED,
        **_EV,
        o=_EV_SUMMARY,
    ),
)
def ev_report(t: Tables):
    return evaluate.classification_report(_matrix(t)).withColumn("value", F.round("value", 9))


# -- one-hot ----------------------------------------------------------------

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _flags(column: str, values) -> str:
    return ", ".join(f"(coalesce({column} = '{v}', false))::int AS \"{column}={v}\"" for v in values)


@plan("fx_categories", "SELECT DISTINCT o_orderpriority FROM orders")
def fx_categories(t: Tables):
    return encode.categories(t["orders"], "o_orderpriority")


@plan(
    "fx_onehot",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_flags('o_orderpriority', PRIORITIES)} FROM orders",
)
def fx_onehot(t: Tables):
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return encode.one_hot(rows, "o_orderpriority")[0]


@plan("fx_onehot_unseen", sql(f"SELECT pos, {_flags('segment', SEGMENTS)} FROM v_segment", ("v_segment",)))
def fx_onehot_unseen(t: Tables):
    known = encode.fit_categories(t["customer"], "c_mktsegment")
    return encode.one_hot(t["v_segment"], "segment", known)[0]


# -- imputation -------------------------------------------------------------

_MISSING = "(segment IS NULL OR segment IN ('', 'NA', 'N/A', 'null', 'NULL', '-', '?'))"
_FILL = f"""SELECT segment AS fill FROM v_segment WHERE NOT {_MISSING}
GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1"""
_SEG = ("v_segment",)


@plan(
    "fx_mode",
    sql(
        f"SELECT (SELECT fill FROM f) AS fill, count(*) FILTER (WHERE {_MISSING}) AS filled, count(*) AS n_rows FROM v_segment",
        _SEG,
        f=_FILL,
    ),
)
def fx_mode(t: Tables):
    return impute.fit_mode(t["v_segment"], "segment")


@plan(
    "fx_impute",
    sql(f"SELECT pos, CASE WHEN {_MISSING} THEN (SELECT fill FROM f) ELSE segment END AS segment FROM v_segment", _SEG, f=_FILL),
)
def fx_impute(t: Tables):
    return impute.impute_mode(t["v_segment"], "segment")


# -- scaling ----------------------------------------------------------------

_MINMAX = """SELECT {key}, CASE WHEN hi = lo THEN 0.5 ELSE ({v} - lo) / (hi - lo) END AS scaled
FROM {table}, (SELECT min({v}) AS lo, max({v}) AS hi FROM {table})"""


@plan(
    "fx_minmax",
    sql(
        "SELECT p_partkey, round(scaled, 9) AS scaled FROM x",
        x=_MINMAX.format(key="p_partkey", v="p_retailprice", table="part"),
    ),
)
def fx_minmax(t: Tables):
    rows = t["part"].select("p_partkey", "p_retailprice")
    return scale.min_max_scale(rows, "p_retailprice").select("p_partkey", F.round("scaled", 9).alias("scaled"))


@plan(
    "fx_crushed",
    sql(
        "SELECT count(*) FILTER (WHERE scaled < 0.01) AS crushed, count(*) AS n_rows FROM x",
        x=_MINMAX.format(key="l_orderkey", v="l_extendedprice", table="lineitem"),
    ),
)
def fx_crushed(t: Tables):
    rows = t["lineitem"].select("l_extendedprice")
    return scale.crushed_count(scale.min_max_scale(rows, "l_extendedprice"))


def _robust(key: str, v: str, table: str) -> str:
    return sql(
        f"SELECT {key}, round(CASE WHEN q3 = q1 THEN 0.0 ELSE ({v} - med) / (q3 - q1) END, 9) AS scaled FROM {table}, q",
        o=f"SELECT {v} AS v, row_number() OVER (ORDER BY {v}) - 1 AS i, count(*) OVER () AS n FROM {table}",
        q="""SELECT max(v) FILTER (WHERE i = n // 4) AS q1, max(v) FILTER (WHERE i = n // 2) AS med,
max(v) FILTER (WHERE i = (3 * n) // 4) AS q3 FROM o""",
    )


@plan("fx_robust", _robust("l_orderkey, l_linenumber", "l_extendedprice", "lineitem"))
def fx_robust(t: Tables):
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice")
    scaled = scale.robust_scale(rows, "l_extendedprice")
    return scaled.select("l_orderkey", "l_linenumber", F.round("scaled", 9).alias("scaled"))


_QUARTILES = """SELECT max(v) FILTER (WHERE i = n // 4) AS q1, max(v) FILTER (WHERE i = n // 2) AS median,
max(v) FILTER (WHERE i = (3 * n) // 4) AS q3
FROM (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS i, count(*) OVER () AS n FROM lineitem)"""


@plan("fx_quartiles", _QUARTILES)
def fx_quartiles(t: Tables):
    stats = scale.fit_robust(t["lineitem"], "l_extendedprice")
    return t.spark.createDataFrame([(stats.q1, stats.median, stats.q3)], "q1 double, median double, q3 double")


@plan("fx_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS rank FROM orders")
def fx_rank(t: Tables):
    ranked = ordering.global_rank(t["orders"].select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"])
    return ranked.select("o_orderkey", "rank")


@plan("fx_robust_part", _robust("p_partkey", "p_retailprice", "part"))
def fx_robust_part(t: Tables):
    scaled = scale.robust_scale(t["part"].select("p_partkey", "p_retailprice"), "p_retailprice")
    return scaled.select("p_partkey", F.round("scaled", 9).alias("scaled"))


# -- splits and candidate selection -----------------------------------------

SEEDS = (16, 17, 18, 19, 20)
N_FEATURES = 8
# Every rule over one to three of the features.
CANDIDATES = [c for k in (1, 2, 3) for c in combinations(range(N_FEATURES), k)]


def _ranked(table: str, key: str) -> str:
    return f"""SELECT *, CASE WHEN i < n - nv - nt THEN 'train' WHEN i < n - nt THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, floor(n * 0.1::double)::bigint AS nv, floor(n * 0.4::double)::bigint AS nt
FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY md5({key} || '#' || run)) - 1 AS i,
      count(*) OVER (PARTITION BY run) AS n FROM {table}))"""


_SEED_ROWS = ", ".join(f"({s})" for s in SEEDS)
_CANDIDATE_ROWS = ", ".join(
    f"({i}, {'+'.join(f'2**{f}' for f in c)})" for i, c in enumerate(CANDIDATES)
)
_SEL = {
    "seeds": f"SELECT run::int AS run FROM (VALUES {_SEED_ROWS}) x(run)",
    "b": """SELECT run, id, label, f0 + 2 * f1 + 4 * f2 + 8 * f3 + 16 * f4 + 32 * f5 + 64 * f6 + 128 * f7 AS bits
FROM v_bits, seeds""",
    "parts": _ranked("b", "id"),
    "cand": f"SELECT cand_id::int AS cand_id, mask::bigint AS mask FROM (VALUES {_CANDIDATE_ROWS}) x(cand_id, mask)",
    "hit": """SELECT run, split, cand_id, avg((bit_count(bits & mask) % 2 = label)::int) AS acc
FROM parts, cand GROUP BY run, split, cand_id""",
    "wide": """SELECT run, cand_id, max(acc) FILTER (WHERE split = 'train') AS tr, max(acc) FILTER (WHERE split = 'valid') AS va,
max(acc) FILTER (WHERE split = 'test') AS te FROM hit GROUP BY run, cand_id""",
    "scores": """SELECT run, cand_id, (CASE WHEN tr >= 0.5 THEN 0 ELSE 1 END)::int AS flip,
CASE WHEN tr >= 0.5 THEN tr ELSE 1 - tr END AS train, CASE WHEN tr >= 0.5 THEN va ELSE 1 - va END AS valid,
CASE WHEN tr >= 0.5 THEN te ELSE 1 - te END AS test FROM wide""",
    "best": """SELECT *, avg(valid) OVER (PARTITION BY run) AS mean_candidate_valid,
row_number() OVER (PARTITION BY run ORDER BY round(valid, 12) DESC, cand_id) AS rn FROM scores""",
}
_BITS = ("v_bits",)


def _features(t: Tables):
    """Row id, label and packed feature bits, stored once because the split reads them several times."""
    bits = vectors.pack_parities(F.array(*[F.col(f"f{i}") for i in range(N_FEATURES)]))
    return write_table(t["v_bits"].select("id", "label", bits.alias("bits")), "features")


def _scores(t: Tables):
    return selection.bakeoff(_features(t), "id", "bits", "label", CANDIDATES, SEEDS)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@plan(
    "sel_split_sizes",
    sql(
        "SELECT split, count(*) AS n FROM p GROUP BY split",
        d="SELECT doc_id, 16 AS run FROM documents",
        p=_ranked("d", "doc_id"),
    ),
)
def sel_split_sizes(t: Tables):
    parts = split.split_three_ways(t["documents"].select("doc_id"), "doc_id", seed=16)
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@plan("sel_split", sql("SELECT doc_id, split FROM p", d="SELECT doc_id, 16 AS run FROM documents", p=_ranked("d", "doc_id")))
def sel_split(t: Tables):
    return split.split_three_ways(t["documents"].select("doc_id"), "doc_id", seed=16)


@plan(
    "sel_scores",
    sql(
        "SELECT run, cand_id, flip, round(train, 9) AS train, round(valid, 9) AS valid, round(test, 9) AS test FROM scores",
        _BITS,
        **_SEL,
    ),
)
def sel_scores(t: Tables):
    return _rounded(_scores(t), *selection.SPLITS)


@plan(
    "sel_winner",
    sql(
        """SELECT run, cand_id, flip, round(train, 9) AS train, round(valid, 9) AS valid, round(test, 9) AS test,
round(mean_candidate_valid, 9) AS mean_candidate_valid FROM best WHERE rn = 1""",
        _BITS,
        **_SEL,
    ),
)
def sel_winner(t: Tables):
    return _rounded(selection.winners(_scores(t)), *selection.SPLITS, "mean_candidate_valid")


@plan(
    "sel_gap",
    sql(
        """SELECT round(avg(valid), 9) AS mean_valid, round(avg(test), 9) AS mean_test,
count(*) FILTER (WHERE valid > test) AS optimistic, count(*) AS n_runs FROM best WHERE rn = 1""",
        _BITS,
        **_SEL,
    ),
)
def sel_gap(t: Tables):
    return _rounded(selection.selection_gap(selection.winners(_scores(t))), "mean_valid", "mean_test")


@plan(
    "sel_sizes",
    sql(
        """SELECT run, cand_id, count(*) FILTER (WHERE split = 'train') AS train_n, count(*) FILTER (WHERE split = 'valid') AS valid_n,
count(*) FILTER (WHERE split = 'test') AS test_n FROM parts JOIN (SELECT run, cand_id FROM best WHERE rn = 1) USING (run) GROUP BY run, cand_id""",
        _BITS,
        **_SEL,
    ),
)
def sel_sizes(t: Tables):
    """The winner of every run with the sizes of its splits."""
    labelled, _ = split.assign_splits(_features(t), "id", SEEDS, 0.1, 0.4)
    counts = write_table(selection.label_counts(labelled, "bits", "label"), "counts")
    best = selection.winners(selection.candidate_scores(counts, CANDIDATES)).select("run", "cand_id")
    return best.join(selection.split_sizes(counts), "run")


# Runs whose labels have nothing to do with the features.
NOISE_SEEDS = tuple(100 + s for s in SEEDS)
_NOISE = "(id * 7919) % 104729 % 2"
_BOTH = {
    **_SEL,
    "seeds": "SELECT run::int AS run FROM (VALUES {}) x(run)".format(", ".join(f"({s})" for s in SEEDS + NOISE_SEEDS)),
    "b": _SEL["b"].replace("label,", f"CASE WHEN run > 100 THEN {_NOISE} ELSE label END AS label,"),
}


@plan(
    "sel_gap_signal",
    sql(
        """SELECT run < 100 AS signal, round(avg(valid), 9) AS mean_valid, round(avg(test), 9) AS mean_test,
count(*) FILTER (WHERE valid > test) AS optimistic, count(*) AS n_runs FROM best WHERE rn = 1 GROUP BY run < 100""",
        _BITS,
        **_BOTH,
    ),
)
def sel_gap_signal(t: Tables):
    """The gap of runs with and without a signal in the labels."""
    rows = _features(t)
    noise = rows.withColumn("label", F.expr(_NOISE).cast("int"))
    scores = selection.bakeoff(rows, "id", "bits", "label", CANDIDATES, SEEDS).union(
        selection.bakeoff(noise, "id", "bits", "label", CANDIDATES, NOISE_SEEDS)
    )
    best = selection.winners(scores).withColumn("signal", F.col("run") < 100)
    return _rounded(selection.selection_gap(best, ["signal"]), "mean_valid", "mean_test")


# -- regression -------------------------------------------------------------

FEATURES, TARGET = ("l_quantity", "l_discount"), "l_extendedprice"
_LR = {
    "m": """SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, stddev_samp(l_quantity) AS s1,
stddev_samp(l_discount) AS s2, covar_pop(l_quantity, l_quantity) AS c11, covar_pop(l_quantity, l_discount) AS c12,
covar_pop(l_discount, l_discount) AS c22, covar_pop(l_quantity, l_extendedprice) AS g1,
covar_pop(l_discount, l_extendedprice) AS g2, avg(l_extendedprice) AS my, var_pop(l_extendedprice) AS vy FROM lineitem""",
    "z": """SELECT m1, m2, s1, s2, my, vy, c11 / (s1 * s1) AS c11, c12 / (s1 * s2) AS c12, c22 / (s2 * s2) AS c22,
g1 / s1 AS g1, g2 / s2 AS g2 FROM m""",
    "run": """SELECT 0 AS epoch, 0.0::double AS w1, 0.0::double AS w2, 0.0::double AS b, NULL::double AS mse
UNION ALL
SELECT epoch + 1, w1 - 0.02 * (c11 * w1 + c12 * w2 - g1), w2 - 0.02 * (c12 * w1 + c22 * w2 - g2), b - 0.02 * (b - my),
  w1 * (c11 * w1 + c12 * w2) + w2 * (c12 * w1 + c22 * w2) - 2 * (w1 * g1 + w2 * g2) + vy + (b - my) * (b - my)
FROM run, z WHERE epoch < 400""",
}


def _lr_sql(select: str) -> str:
    return sql(select, **_LR).replace("WITH m AS", "WITH RECURSIVE m AS", 1)


def _fit(t: Tables):
    return regress.fit_linear(t["lineitem"], FEATURES, TARGET)


_Q, _D, _P = FEATURES[0], FEATURES[1], TARGET
_MOMENTS = " UNION ALL ".join(
    f"SELECT '{stat}' AS stat, '{a}' AS \"left\", '{b}' AS \"right\", round({v}, 6)::double AS value FROM m"
    for stat, a, b, v in (
        ("n", "", "", "n"), ("mean", _P, "", "my"), ("mean", _Q, "", "m1"), ("mean", _D, "", "m2"),
        ("stddev_samp", _Q, "", "s1"), ("stddev_samp", _D, "", "s2"),
        ("covar_pop", _Q, _Q, "c11"), ("covar_pop", _Q, _D, "c12"), ("covar_pop", _D, _Q, "c12"),
        ("covar_pop", _D, _D, "c22"), ("covar_pop", _D, _P, "g2"),
    )
) + f""" UNION ALL SELECT 'covar_pop', '{_Q}', '{_P}', round(g1, 3) FROM m
UNION ALL SELECT 'var_pop', '{_P}', '', round(vy, 0) FROM m"""


@plan("lr_moments", _lr_sql(_MOMENTS))
def lr_moments(t: Tables):
    rows = regress.moment_rows(regress.moments(t["lineitem"], FEATURES, TARGET), FEATURES, TARGET)
    large = (F.col("stat") == "covar_pop") & (F.col("left") == _Q) & (F.col("right") == _P)
    value = (
        F.when(F.col("stat") == "var_pop", F.round("value", 0))
        .when(large, F.round("value", 3))
        .otherwise(F.round("value", 6))
    )
    return rows.withColumn("value", value)


@plan(
    "lr_fit",
    _lr_sql(
        f"""SELECT '{_Q}' AS term, round(w1 / s1, 5) AS value FROM run, z WHERE epoch = 400
UNION ALL SELECT '{_D}', round(w2 / s2, 5) FROM run, z WHERE epoch = 400
UNION ALL SELECT 'bias', round(b - w1 * m1 / s1 - w2 * m2 / s2, 5) FROM run, z WHERE epoch = 400"""
    ),
)
def lr_fit(t: Tables):
    return regress.coefficient_rows(_fit(t), FEATURES).withColumn("value", F.round("value", 5))


@plan(
    "lr_history",
    _lr_sql("SELECT epoch, round(mse, 0) AS mse FROM run WHERE epoch = 1 OR (epoch > 0 AND epoch % 50 = 0)"),
)
def lr_history(t: Tables):
    return regress.history_rows(_fit(t)).withColumn("mse", F.round("mse", 0))


# -- vectors and bits -------------------------------------------------------


@plan(
    "vx_add",
    """SELECT vec_id, (unnest(range(len(embedding))))::int AS pos, round((unnest(embedding) + unnest(list_reverse(embedding)))::double, 6) AS value
FROM embeddings""",
)
def vx_add(t: Tables):
    added = vectors.vector_add(F.col("embedding"), F.reverse("embedding"))
    rows = t["embeddings"].select("vec_id", F.posexplode(added).alias("pos", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


@plan(
    "vx_set",
    """SELECT vec_id, pos, CASE WHEN pos = 0 THEN 5.0 ELSE v END::double AS value
FROM (SELECT vec_id, (unnest(range(len(embedding))))::int AS pos, round((unnest(embedding))::double, 6) AS v FROM embeddings)""",
)
def vx_set(t: Tables):
    changed = vectors.vector_set(F.col("embedding"), 0, 5.0)
    rows = t["embeddings"].select("vec_id", F.posexplode(changed).alias("pos", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


@plan("vx_shape", "SELECT len(embedding)::int AS width, 1::int AS rank, 'array<float>' AS dtype, count(*) AS n FROM embeddings GROUP BY 1")
def vx_shape(t: Tables):
    return vectors.describe(t["embeddings"], "embedding")


@plan(
    "vx_bits",
    "SELECT o_orderkey, "
    + " || ".join(f"((o_orderkey >> {i}) & 1)::varchar" for i in range(10))
    + " AS bits FROM orders",
)
def vx_bits(t: Tables):
    bits = vectors.bit_features(F.col("o_orderkey"))
    return t["orders"].select("o_orderkey", F.array_join(bits.cast("array<string>"), "").alias("bits"))


@plan(
    "vx_label",
    """SELECT o_orderkey, cls, CASE cls WHEN 3 THEN 'FizzBuzz' WHEN 2 THEN 'Buzz' WHEN 1 THEN 'Fizz' ELSE o_orderkey::varchar END AS label
FROM (SELECT o_orderkey, (CASE WHEN o_orderkey % 15 = 0 THEN 3 WHEN o_orderkey % 5 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END)::int AS cls
FROM orders)""",
)
def vx_label(t: Tables):
    rows = t["orders"].select("o_orderkey", vectors.number_class(F.col("o_orderkey")).alias("cls"))
    return rows.withColumn("label", vectors.decode_class(field("o_orderkey"), F.col("cls")))
