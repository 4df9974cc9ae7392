"""Exact-size three-way splits by hashed row order.

Rows are ordered by a hash of their key and a seed, which is a shuffle that
repeats.  A split only needs the two rows where that order is cut, so the cut
values are found as order statistics and every row is then labelled by
comparing its own hash: no sort and no shuffle of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field
from plumbwright.operators.ordering import order_statistics

# Hex digits per hash part: 52 bits, exact as a double and as a bigint.
_DIGITS = 13


@dataclass(frozen=True)
class SplitSizes:
    train: int
    valid: int
    test: int


def split_sizes(n: int, valid_frac: float = 0.1, test_frac: float = 0.4) -> SplitSizes:
    """Row counts of the three parts; train takes the remainder.  No part may be empty."""
    valid, test = int(n * valid_frac), int(n * test_frac)
    sizes = SplitSizes(n - valid - test, valid, test)
    if min(sizes.train, sizes.valid, sizes.test) < 1:
        raise ValueError(
            f"{n} rows cut into {sizes.train}/{sizes.valid}/{sizes.test} (train/valid/test): a part is empty"
        )
    return sizes


def _hash_part(key: Column, seed: int, part: int) -> Column:
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1 + part * _DIGITS, _DIGITS), 16, 10).cast("bigint")


@dataclass(frozen=True)
class Cut:
    """The first row, in hash order, that belongs to the next part."""

    head: int
    tail: int

    def after(self, key: Column, seed: int) -> Column:
        """True for rows strictly before the cut."""
        head, tail = _hash_part(key, seed, 0), _hash_part(key, seed, 1)
        return (head < self.head) | ((head == self.head) & (tail < self.tail))


def _cuts(df: DataFrame, key: Column, wanted: list[tuple[int, int]], n: int) -> list[Cut]:
    """The rows at the wanted (seed, position) pairs."""
    seeds = sorted({seed for seed, _ in wanted})
    hashed = df.select(*[_hash_part(key, seed, 0).alias(f"h{seed}") for seed in seeds])
    heads_of = {seed: F.col(f"h{seed}") for seed in seeds}
    targets = [(heads_of[seed], k) for seed, k in wanted]
    heads = order_statistics(hashed, targets, n, proposals=[_likely_range(k, n) for _, k in wanted])
    counted = []
    for i, ((column, _), head) in enumerate(zip(targets, heads)):
        counted += [F.count_if(column < head).alias(f"before{i}"), F.count_if(column == head).alias(f"same{i}")]
    found = hashed.agg(*counted).first()
    cuts = []
    for i, ((seed, k), head) in enumerate(zip(wanted, heads)):
        same = found[f"same{i}"]
        # With one row at this head (the usual case) every tail compares as not before.
        tail = -1
        if same > 1:
            tail = _tail(df.filter(_hash_part(key, seed, 0) == head), key, seed, k - found[f"before{i}"], same)
        cuts.append(Cut(head, tail))
    return cuts


def _likely_range(k: int, n: int) -> tuple[int, int]:
    """Where the k-th of n uniform hashes lies, but for one case in many millions."""
    top = 16**_DIGITS
    slack = 3.0 / math.sqrt(n)  # six standard deviations of the middle rank
    return int(max(0.0, k / n - slack) * top), int(min(1.0, k / n + slack) * top)


def _tail(same_head: DataFrame, key: Column, seed: int, k: int, n: int) -> int:
    part = _hash_part(key, seed, 1)
    tail = order_statistics(same_head, [(part, k)], n)[0]
    if same_head.filter(part == tail).limit(2).count() > 1:
        raise ValueError("the split key repeats at a cut; use a key that is unique per row")
    return tail


def assign_splits(
    df: DataFrame,
    key: str,
    seeds: Sequence[int] = (0,),
    valid_frac: float = 0.1,
    test_frac: float = 0.4,
) -> tuple[DataFrame, SplitSizes]:
    """Add ``splits``: array of (run, split), one entry per seed.

    All runs share the same passes over the key column.
    """
    k = field(key)
    n, keyed = df.agg(F.count(F.lit(1)), F.count(k)).first()
    if keyed < n:
        raise ValueError(f"{n - keyed} rows have no {key}; every row needs a split key")
    sizes = split_sizes(n, valid_frac, test_frac)
    positions = (sizes.train, sizes.train + sizes.valid)
    wanted = [(seed, p) for seed in seeds for p in positions]
    cuts = _cuts(df, k, wanted, n)
    entries = []
    for i, seed in enumerate(seeds):
        first, second = cuts[2 * i], cuts[2 * i + 1]
        split = (
            F.when(first.after(k, seed), "train").when(second.after(k, seed), "valid").otherwise("test")
        )
        entries.append(F.struct(F.lit(seed).alias("run"), split.alias("split")))
    return df.withColumn("splits", F.array(*entries)), sizes


def split_three_ways(
    df: DataFrame, key: str, seed: int = 0, valid_frac: float = 0.1, test_frac: float = 0.4
) -> DataFrame:
    """Add ``split`` ('train', 'valid' or 'test') with exact part sizes."""
    labelled, _ = assign_splits(df, key, (seed,), valid_frac, test_frac)
    return labelled.withColumn("split", F.col("splits")[0]["split"]).drop("splits")
