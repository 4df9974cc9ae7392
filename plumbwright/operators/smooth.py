"""Centred window filters over ordered series and their signal-to-noise ratio.

With the layout ``series``, series share tasks and need one shuffle by series.
With ``blocks``, for series too long for one task, the rows are laid out in
fixed-size blocks of the global (series, position) order instead, each block
carrying copies of the rows its frames reach across the border.  Both give the
same rows.

A mean adds sums of blocks of 8, 64, 512 ... rows that lie inside its window, so
a value reaches only the windows that hold it, whether it is finite or not, and
the work for a row grows with the logarithm of the window.  A median of a long
window keeps the sorted values of one window while it moves over a block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from plumbwright.functions.cells import field
from plumbwright.operators.ordering import global_rank

BLOCK_ROWS = 1_000_000
# Medians of windows up to this length sort each row's window in an expression; both ways give the same values.
SORTED_WINDOW = 101
# Rows of a series that one median task holds, if its window is not longer.
MEDIAN_ROWS = 262_144
# Rows or blocks that make up a block of the next size.
RADIX = 8


@dataclass(frozen=True)
class Line:
    """Rows in order: within ``by``, by ``order``."""

    by: tuple[str, ...]
    order: str

    @property
    def spec(self) -> WindowSpec:
        return Window.partitionBy(*[field(c) for c in self.by]).orderBy(field(self.order))


# Adds a filtered column: (frame, source column, new column, line) to frame.
Filter = Callable[[DataFrame, str, str, Line], DataFrame]


def _half(window: int) -> int:
    if window < 1:
        raise ValueError("window must be at least 1")
    return window // 2


def _digits(rows: int) -> list[int]:
    """How many blocks of 1, RADIX, RADIX^2 ... rows make up ``rows``."""
    out = []
    while rows:
        rows, digit = divmod(rows, RADIX)
        out.append(digit)
    return out


def _total(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def mean_of(window: int) -> tuple[int, Filter]:
    """Centred mean of the values that are not NULL, shrinking at the edges.

    An even window acts like the next odd one.  A window without values is NULL;
    NaN and infinities give what they give in a plain sum.
    """
    half = _half(window)
    after, before = _digits(half + 1), _digits(half)

    def build(df: DataFrame, value: str, name: str, line: Line) -> DataFrame:
        w = line.spec
        v = field(value).cast("double")
        # Rows that the series does not have count as zero; so do NULLs, which the count leaves out.
        levels = max(len(after), len(before))
        staged = df.withColumns({"_f0": F.coalesce(v, F.lit(0.0)), "_b0": F.coalesce(v, F.lit(0.0))})
        for k in range(1, levels):
            step = RADIX ** (k - 1)
            f = [F.col(f"_f{k - 1}")] + [F.lead(f"_f{k - 1}", i * step, 0.0).over(w) for i in range(1, RADIX)]
            b = [F.col(f"_b{k - 1}")] + [F.lag(f"_b{k - 1}", i * step, 0.0).over(w) for i in range(1, RADIX)]
            staged = staged.withColumns({f"_f{k}": _total(f), f"_b{k}": _total(b)})
        # From the row on, and from the row before it back, in whole blocks from the largest to single rows.
        parts, ahead, back = [], 0, 1
        for k in reversed(range(len(after))):
            for _ in range(after[k]):
                parts.append(F.lead(f"_f{k}", ahead, 0.0).over(w) if ahead else F.col(f"_f{k}"))
                ahead += RADIX**k
        for k in reversed(range(len(before))):
            for _ in range(before[k]):
                parts.append(F.lag(f"_b{k}", back, 0.0).over(w))
                back += RADIX**k
        # Counts are whole numbers, so the difference of two running counts is exact.
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        counts = {"_upto": F.count(v).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_all": F.count(v).over(whole)}
        staged = staged.withColumns({"_sum": _total(parts), **counts})
        last = F.coalesce(F.lead("_upto", half).over(w), F.col("_all")) if half else F.col("_upto")
        n = last - F.coalesce(F.lag("_upto", half + 1).over(w), F.lit(0))
        out = staged.withColumn(name, F.when(n > 0, F.col("_sum") / n))
        return out.drop("_sum", "_upto", "_all", *[f"_{c}{k}" for c in "fb" for k in range(levels)])

    return half, build


def _window_medians(values, half: int):
    """Centred medians of a float array with NaN as a value and NULLs masked, and where there is none."""
    import numpy as np
    import pandas as pd

    known = ~np.ma.getmaskarray(values)
    # Windows are sorted by rank: ranks are finite, and NaN is the largest.
    distinct, rank = np.unique(np.ma.getdata(values)[known], return_inverse=True)
    ranks = np.full(len(values), np.nan)
    ranks[known] = rank
    rolling = pd.Series(ranks).rolling(2 * half + 1, center=True, min_periods=1)
    lower, upper = (rolling.quantile(0.5, interpolation=i).to_numpy() for i in ("lower", "higher"))
    none = np.isnan(lower)
    if not len(distinct):
        return np.zeros(len(values)), none
    with np.errstate(all="ignore"):
        return (distinct[np.where(none, 0, lower).astype(int)] + distinct[np.where(none, 0, upper).astype(int)]) / 2, none


def _long_median(half: int, rows: int) -> Filter:
    """Medians by moving a sorted window over pieces of a series, each with half a window of its neighbours."""

    def build(df: DataFrame, value: str, name: str, line: Line) -> DataFrame:
        size = max(rows, 2 * half + 1)
        at = (F.row_number().over(line.spec) - 1).cast("long")
        home = F.expr(f"_at div {size}")
        offset = F.col("_at") % size
        homes = F.array_compact(F.array(home, F.when(offset < half, home - 1), F.when(offset >= size - half, home + 1)))
        pieces = df.withColumns({"_at": at, "_value": field(value).cast("double")}).select("*", F.explode(homes).alias("_home"))
        schema = StructType([*df.schema.fields, StructField(name, DoubleType())])
        columns = df.columns

        def medians(piece):
            import numpy as np
            import pyarrow as pa

            piece = piece.take(np.argsort(piece.column("_at").to_numpy()))
            v = piece.column("_value").combine_chunks()
            cells = np.ma.array(v.fill_null(0.0).to_numpy(zero_copy_only=False), mask=v.is_null().to_numpy(zero_copy_only=False))
            found, none = _window_medians(cells, half)
            own = piece.column("_at").to_numpy() // size == piece.column("_home")[0].as_py()
            out = piece.select(columns).append_column(name, pa.array(found, mask=none))
            return out.filter(pa.array(own))

        return pieces.groupBy(*[field(c) for c in line.by], "_home").applyInArrow(medians, schema)

    return build


def median_of(window: int, sorted_window: int = SORTED_WINDOW, rows: int = MEDIAN_ROWS) -> tuple[int, Filter]:
    """Centred median, shrinking at the edges; an even count averages the middle two.

    NULLs are left out, NaN is the largest value.  A short window is sorted for
    every row; one longer than ``sorted_window`` moves over pieces of ``rows``
    rows, where each row enters and leaves it once.
    """
    half = _half(window)

    def build(df: DataFrame, value: str, name: str, line: Line) -> DataFrame:
        return df.withColumn(name, middle(field(value).cast("double"), line.spec))

    def middle(v: Column, w: WindowSpec) -> Column:
        frame = F.array_sort(F.collect_list(v).over(w.rowsBetween(-half, half)))
        n = F.size(frame)
        upper = F.element_at(frame, F.floor(n / F.lit(2)).cast("int") + 1)
        lower = F.element_at(frame, F.ceil(n / F.lit(2)).cast("int"))
        return F.when(n > 0, (lower + upper) / 2)

    return half, build if window <= sorted_window else _long_median(half, rows)


def filter_series(
    df: DataFrame,
    series: str,
    order: str,
    value: str,
    steps: Sequence[tuple[str, tuple[int, Filter]]],
    layout: str = "series",
    block_rows: int = BLOCK_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Apply filters in sequence, each to the output of the one before.

    ``steps`` lists (output column, filter) with filters from :func:`mean_of`
    and :func:`median_of`.  (series, order) must be unique.  ``layout`` is
    ``series`` or ``blocks`` (see above), ``partitions`` that of the global order.
    """
    if layout not in ("series", "blocks"):
        raise ValueError("layout must be 'series' or 'blocks'")
    if layout == "series":
        return _apply(df, value, steps, Line((series,), order))

    halo = sum(half for _, (half, _) in steps)
    if block_rows < halo:
        raise ValueError("block_rows must cover the frames of all steps")
    ranked = global_rank(df, [series, order], "_rank", partitions)
    block = F.floor(F.col("_rank") / block_rows)
    offset = F.col("_rank") % block_rows
    homes = F.array_compact(
        F.array(
            block,
            F.when(offset < halo, block - 1),
            F.when(offset >= block_rows - halo, block + 1),
        )
    )
    copies = ranked.select("*", F.explode(homes).alias("_block"))
    filtered = _apply(copies, value, steps, Line(("_block", series), "_rank"))
    return filtered.filter(F.col("_block") == block).drop("_block", "_rank")


def _apply(df: DataFrame, value: str, steps, line: Line) -> DataFrame:
    source = value
    for name, (_, build) in steps:
        df = build(df, source, name, line)
        source = name
    return df


def moving_average(df: DataFrame, series: str, order: str, value: str, window: int = 3, **layout) -> DataFrame:
    return filter_series(df, series, order, value, [("smoothed", mean_of(window))], **layout)


def median_filter(df: DataFrame, series: str, order: str, value: str, window: int = 3, **layout) -> DataFrame:
    return filter_series(df, series, order, value, [("filtered", median_of(window))], **layout)


def denoise(df: DataFrame, series: str, order: str, value: str, window: int = 5, **layout) -> DataFrame:
    """Smooth, then remove spikes from the smoothed signal."""
    steps = [("smoothed", mean_of(window)), ("despiked", median_of(window))]
    return filter_series(df, series, order, value, steps, **layout)


def snr_db(clean: Column, estimate: Column) -> Column:
    """Aggregate: signal-to-noise ratio in decibels, infinite without any error."""
    signal, error = F.sum(clean * clean), F.sum((clean - estimate) * (clean - estimate))
    return F.when(error == 0, F.lit(float("inf"))).otherwise(10 * F.log10(signal / error))


def denoise_gain(filtered: DataFrame, clean: str, noisy: str) -> DataFrame:
    """SNR of the noisy, smoothed and despiked signals and the total improvement."""
    c = field(clean)
    row = filtered.agg(
        snr_db(c, field(noisy)).alias("noisy_db"),
        snr_db(c, F.col("smoothed")).alias("smoothed_db"),
        snr_db(c, F.col("despiked")).alias("despiked_db"),
    )
    return row.withColumn("gain_db", F.col("despiked_db") - F.col("noisy_db"))
