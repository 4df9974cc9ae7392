"""Linear regression from one pass of moments.

Full-batch gradient descent on squared error touches the rows only through
their means and covariances.  Those come from one aggregate; the epochs then
run on d x d numbers inside a single-row expression, without another scan and
without a driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field

HISTORY_EVERY = 50


def moments(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One row: n, means, sample deviations and population covariances.

    Rows with a NULL feature or target are left out of every moment alike.
    """
    complete = df.select(*[field(c).cast("double").alias(c) for c in (*features, target)]).dropna()
    x, y = [field(c) for c in features], field(target)
    d = range(len(features))
    row = complete.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(a) for a in x]).alias("mean_x"),
        F.array(*[F.stddev_samp(a) for a in x]).alias("std_x"),
        *[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in d for j in d if i <= j],
        F.array(*[F.covar_pop(a, y) for a in x]).alias("cov_xy"),
        F.avg(y).alias("mean_y"),
        F.var_pop(y).alias("var_y"),
    )
    matrix = F.array(*[F.array(*[F.col(f"c{min(i, j)}_{max(i, j)}") for j in d]) for i in d])
    return row.select("n", "mean_x", "std_x", matrix.alias("cov_xx"), "cov_xy", "mean_y", "var_y")


def moment_rows(m: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The moments as long rows (stat, left, right, value)."""
    rows = [("n", "", "", F.col("n")), ("mean", target, "", F.col("mean_y")), ("var_pop", target, "", F.col("var_y"))]
    for i, a in enumerate(features):
        rows += [("mean", a, "", F.col("mean_x")[i]), ("stddev_samp", a, "", F.col("std_x")[i])]
        rows += [("covar_pop", a, b, F.col("cov_xx")[i][j]) for j, b in enumerate(features)]
        rows += [("covar_pop", a, target, F.col("cov_xy")[i])]
    structs = [
        F.struct(F.lit(s).alias("stat"), F.lit(a).alias("left"), F.lit(b).alias("right"), v.cast("double").alias("value"))
        for s, a, b, v in rows
    ]
    return m.select(F.inline(F.array(*structs)))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)


def _share(v: Column, spread: Column) -> Column:
    return F.coalesce(F.try_divide(v, spread), F.lit(0.0))


def descend(m: DataFrame, lr: float = 0.01, epochs: int = 400) -> DataFrame:
    """Gradient descent from zero on standardised features.

    A feature with a single value has no spread to standardise by; its weight is 0.

    One row: ``weights`` and ``bias`` in original units and ``history``, the
    loss before the step at epoch 1 and every 50th epoch.
    """
    std, mean_y = F.col("std_x"), F.col("mean_y")
    scaled = m.select(
        "*",
        F.transform("cov_xx", lambda row, i: F.transform(row, lambda v, j: _share(v, std[i] * std[j]))).alias("_c"),
        F.transform("cov_xy", lambda v, i: _share(v, std[i])).alias("_g"),
    )
    c, g = F.col("_c"), F.col("_g")

    def state(w: Column, b: Column, history: Column) -> Column:
        return F.struct(w.alias("w"), b.alias("b"), history.alias("history"))

    def step(s: Column, epoch: Column) -> Column:
        w, off = s["w"], s["b"] - mean_y
        cw = F.transform(c, lambda row: _dot(row, w))
        loss = _dot(w, cw) - 2 * _dot(w, g) + F.col("var_y") + off * off
        moved = F.transform(w, lambda wi, i: wi - lr * 2 * (cw[i] - g[i]))
        noted = F.when((epoch == 1) | (epoch % HISTORY_EVERY == 0), F.array(_point(epoch, loss)))
        return state(moved, s["b"] - lr * 2 * off, F.concat(s["history"], F.coalesce(noted, _no_history())))

    start = state(F.transform(g, lambda v: F.lit(0.0)), F.lit(0.0), _no_history())
    run = scaled.select(
        "mean_x", "std_x", F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), start, step).alias("s")
    )
    weights = F.transform("s.w", lambda w, i: _share(w, F.col("std_x")[i]))
    return run.select(
        weights.alias("weights"),
        (F.col("s.b") - _dot(weights, F.col("mean_x"))).alias("bias"),
        F.col("s.history").alias("history"),
    )


def _point(epoch: Column, loss: Column) -> Column:
    return F.struct(epoch.cast("int").alias("epoch"), loss.alias("mse"))


def _no_history() -> Column:
    return F.array().cast("array<struct<epoch:int,mse:double>>")


def fit_linear(df: DataFrame, features: Sequence[str], target: str, lr: float = 0.01, epochs: int = 400) -> DataFrame:
    return descend(moments(df, features, target), lr, epochs)


def coefficient_rows(fit: DataFrame, features: Sequence[str]) -> DataFrame:
    """A fit as long rows (term, value): one per feature, then the bias."""
    structs = [
        F.struct(F.lit(name).alias("term"), F.col("weights")[i].alias("value")) for i, name in enumerate(features)
    ] + [F.struct(F.lit("bias").alias("term"), F.col("bias").alias("value"))]
    return fit.select(F.inline(F.array(*structs)))


def history_rows(fit: DataFrame) -> DataFrame:
    return fit.select(F.inline("history"))


def least_squares(df: DataFrame, features: Sequence[str], target: str) -> tuple[list[float], float]:
    """The exact solution (of several, the shortest), from the same moments (d x d numbers reach the driver)."""
    import numpy as np

    m = moments(df, features, target).first()
    weights = np.linalg.lstsq(np.array(m["cov_xx"]), np.array(m["cov_xy"]), rcond=None)[0]
    return weights.tolist(), float(m["mean_y"] - weights @ np.array(m["mean_x"]))
