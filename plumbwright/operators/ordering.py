"""Exact order statistics and exact ranks without a global sort in one task.

``order_statistics`` finds single positions of a sorted column by narrowing
value brackets: a sketch proposes a bracket, an exact count verifies it, and
only the verified bracket is looked at again.  Each pass is a scan of one
column with partial aggregates; no rows are shuffled.

``global_rank`` gives every row its rank: one range shuffle, a sort inside each
partition, and offsets added from the partition sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.sources.scratch import write_table

# Rows left in a bracket before its order statistic is read off directly.
DIRECT_ROWS = 100_000
# Sketches are merged per stripe of tasks first, so that no single task has to
# merge one sketch per task of the scan.
STRIPES = 64
ACCURACY = 1_000
# Half-width of a proposed bracket; above the rank error of the sketch (1/ACCURACY).
MARGIN = 0.004


@dataclass
class _Target:
    """Search state: the answer has rank ``k`` among values in the open interval (lo, hi)."""

    value: Column
    k: int
    inside: int
    lo: Any = None
    hi: Any = None
    answer: Any = None
    done: bool = False

    def bracket(self) -> Column:
        cond = self.value.isNotNull()
        if self.lo is not None:
            cond = cond & (self.value > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (self.value < F.lit(self.hi))
        return cond

    def settle(self, answer) -> None:
        self.answer, self.done = answer, True

    def raise_lo(self, v) -> None:
        self.lo = v if self.lo is None else max(self.lo, v)

    def drop_hi(self, v) -> None:
        self.hi = v if self.hi is None else min(self.hi, v)

    def narrow(self, a, b, below: int, at_a: int, between: int, at_b: int) -> None:
        """Use exact counts around proposed values a <= b to shrink the interval.

        The counts cover the present interval only; proposals outside of it
        (sketches round large integers) leave it as it is.
        """
        if self.k < below:
            self.drop_hi(a)
            self.inside = below
        elif self.k < below + at_a:
            self.settle(a)
        elif self.k < below + at_a + between:
            self.k -= below + at_a
            self.raise_lo(a)
            self.drop_hi(b)
            self.inside = between
        elif self.k < below + at_a + between + at_b:
            self.settle(b)
        else:
            passed = below + at_a + between + at_b
            self.k -= passed
            self.inside -= passed
            self.raise_lo(b)


def order_statistics(
    df: DataFrame,
    targets: Sequence[tuple[Column, int]],
    rows: int,
    direct_rows: int = DIRECT_ROWS,
    proposals: Sequence[tuple] | None = None,
) -> list:
    """Values at 0-based positions of sorted numeric columns.

    ``targets`` pairs a numeric expression with a position; ``rows`` is the
    number of non-NULL values.  Returns one value per target, exactly.  The
    frame is scanned a few times: store it first when it is not a plain scan.

    ``proposals`` are first brackets (low, high), one per target, for values of
    a known distribution; they save the first sketch and need not be right.
    """
    state = []
    for value, k in targets:
        if not 0 <= k < rows:
            raise ValueError(f"position {k} outside 0..{rows - 1}")
        state.append(_Target(value, k, rows))

    if proposals and rows > direct_rows:
        _count_around(df, state, list(proposals))
    while open_targets := [t for t in state if not t.done and t.inside > direct_rows]:
        _narrow_all(df, open_targets)
    if rest := [t for t in state if not t.done]:
        _read_off(df, rest)
    return [t.answer for t in state]


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _narrow_all(df: DataFrame, targets: list[_Target]) -> None:
    # Targets in the same interval of the same expression share one sketch.
    shared: dict[tuple, list[int]] = {}
    for i, t in enumerate(targets):
        shared.setdefault((id(t.value), t.lo, t.hi), []).append(i)
    sketches, ends_of = [], {}
    for s, members in enumerate(shared.values()):
        probs = []
        for i in members:
            p = (targets[i].k + 0.5) / targets[i].inside
            ends_of[i] = (F.col(f"s{s}")[len(probs)], F.col(f"s{s}")[len(probs) + 1])
            probs += [max(0.0, p - MARGIN), min(1.0, p + MARGIN)]
        first = targets[members[0]]
        inside = F.when(first.bracket(), first.value)
        sketches.append(F.percentile_approx(inside, probs, ACCURACY).alias(f"s{s}"))
    lows = [F.min(ends_of[i][0]).alias(f"a{i}") for i in range(len(targets))]
    highs = [F.max(ends_of[i][1]).alias(f"b{i}") for i in range(len(targets))]
    candidates = df.filter(_any([t.bracket() for t in targets]))
    striped = candidates.withColumn("_stripe", F.spark_partition_id() % STRIPES)
    proposed = striped.groupBy("_stripe").agg(*sketches).agg(*lows, *highs).first()
    ends = [(proposed[f"a{i}"], proposed[f"b{i}"]) for i in range(len(targets))]

    sizes = [t.inside for t in targets]
    _count_around(df, targets, ends)
    stuck = [t for t, size in zip(targets, sizes) if not t.done and t.inside == size]
    if stuck:
        # The sketch rounds integers beyond double precision; the true extremes
        # always remove at least themselves.
        extremes = df.agg(
            *[F.min(F.when(t.bracket(), t.value)).alias(f"a{i}") for i, t in enumerate(stuck)],
            *[F.max(F.when(t.bracket(), t.value)).alias(f"b{i}") for i, t in enumerate(stuck)],
        ).first()
        _count_around(df, stuck, [(extremes[f"a{i}"], extremes[f"b{i}"]) for i in range(len(stuck))])


def _count_around(df: DataFrame, targets: list[_Target], ends: list[tuple]) -> None:
    aggs = []
    for i, (t, (a, b)) in enumerate(zip(targets, ends)):
        inside, v, lo, hi = t.bracket(), t.value, F.lit(a), F.lit(b)
        aggs += [
            F.count_if(inside & (v < lo)).alias(f"below{i}"),
            F.count_if(inside & (v == lo)).alias(f"at_a{i}"),
            F.count_if(inside & (v > lo) & (v < hi)).alias(f"between{i}"),
            F.count_if(inside & (v == hi) & (hi > lo)).alias(f"at_b{i}"),
        ]
    counts = df.filter(_any([t.bracket() for t in targets])).agg(*aggs).first()
    for i, (t, (a, b)) in enumerate(zip(targets, ends)):
        t.narrow(a, b, counts[f"below{i}"], counts[f"at_a{i}"], counts[f"between{i}"], counts[f"at_b{i}"])


def _read_off(df: DataFrame, targets: list[_Target]) -> None:
    """Read positions inside brackets whose verified size is at most DIRECT_ROWS."""
    staged = df.filter(_any([t.bracket() for t in targets])).select(
        *[F.when(t.bracket(), t.value).alias(f"v{i}") for i, t in enumerate(targets)]
    )
    picks = [
        F.expr(f"percentile_disc({(t.k + 0.5) / t.inside!r}D) WITHIN GROUP (ORDER BY v{i})").alias(f"r{i}")
        for i, t in enumerate(targets)
    ]
    row = staged.agg(*picks).first()
    for i, t in enumerate(targets):
        t.settle(row[f"r{i}"])


def global_rank(
    df: DataFrame, order: Sequence[str], rank: str = "rank", partitions: int | None = None
) -> DataFrame:
    """Add the exact 0-based rank of every row in the order of ``order``.

    The order columns together must be unique: ties would have to share a
    partition.  The sorted partitions are stored before their sizes are read,
    so sizes and rows always describe the same partitioning.  Give ``partitions``
    for large inputs (about their size over 128 MB): adaptive execution does not
    split a range partition that is too large.
    """
    keys = [F.col(c) for c in order]
    ranged = (df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)).sortWithinPartitions(*order)
    frozen = write_table(ranged.withColumn("_at", F.monotonically_increasing_id()), "rank")
    # The id is partition number * 2^33 + index within the partition.
    part, index = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = frozen.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per shuffle partition, hence the unpartitioned window and broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        frozen.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + index).alias(rank))
    )
