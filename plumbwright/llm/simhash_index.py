"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Distinct fingerprints are dealt to buckets: of six bit blocks, two fingerprints
with at most four differing bits agree in at least two, so every pair of blocks
is a bucket key.  Within buckets, fingerprints are sorted by Gray rank, so
neighbours share many bits.  Runs of neighbours form nodes that hold the bits
all of them share; differences are added up from the top and a pair of nodes
whose shared bits already differ too often is dropped with everything below.
Links become components by star joins.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.llm.common import LOWER_ASCII, raw_texts, texts
from plumbwright.llm.components import components
from plumbwright.sources.scratch import write_table

SHINGLE = 4
HASH_SEED = 42
RADIUS = 4
# Children of an index node.
FAN = 8
# Pairs of nodes that are compared at once; bounds a task's memory.
FRONTIER = 1 << 18
# Distinct fingerprints of a bucket beyond which it is dealt again by other blocks.
BUCKET_LIMIT = 4096
# Rounds of dealing: an odd stride over the bits, and the blocks that a bucket agrees in.
ROUNDS = ((1, 2), (5, 4), (23, 6))
_HASHED_TOGETHER = 1 << 15


def shingle_hashes(raw: bytes, size: int = SHINGLE):
    """XXH64 of every shingle of a text, in parts of bounded size."""
    words = raw.translate(LOWER_ASCII).split()
    if not words:
        return
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    last = ends[size - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(last), _HASHED_TOGETHER):
        part = last[at : at + _HASHED_TOGETHER]
        yield np.array([digest(line[s:e], HASH_SEED) for s, e in zip(starts[at:], part)], "<u8")


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(raw, size):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _prints(size: int):
    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(r, size) for r in raw_texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "print"]
            )

    return run


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray sequence."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class Index:
    """Hierarchical index over sorted fingerprints of several buckets.

    Level 0 are the fingerprints.  A node above covers up to ``FAN`` neighbours of
    one bucket: ``mask`` has the bits they share, ``pattern`` the shared values.
    """

    def __init__(self, buckets: np.ndarray, values: np.ndarray):
        ids = np.cumsum(np.diff(buckets, prepend=buckets[:1]) != 0)
        ones, zeros = values, ~values
        self.levels = [(ones, ones | zeros)]
        # first[l][i]: the first child of node i of level l + 1, with an end mark.
        self.first: list[np.ndarray] = []
        while len(ids) > ids[-1] + 1:
            starts = np.flatnonzero(np.diff(ids, prepend=-1))
            within = np.arange(len(ids)) - np.repeat(starts, np.diff([*starts, len(ids)]))
            heads = np.flatnonzero(within % FAN == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, heads), np.bitwise_and.reduceat(zeros, heads)
            ids = ids[heads]
            self.levels.append((ones, ones | zeros))
            self.first.append(np.append(heads, len(within)))

    def close_pairs(self, radius: int):
        """Positions of pairs with at most ``radius`` differing bits, some at a time."""
        roots = np.arange(len(self.levels[-1][0]))
        own = np.zeros(len(roots), np.uint64)
        # Pairs of nodes of one level, the bits compared so far, and the differences in them.
        stack = [(len(self.levels) - 1, roots, roots, own, np.zeros(len(roots), np.int64))]
        while stack:
            level, a, b, seen, differ = stack.pop()
            if len(a) > FRONTIER:
                cut = len(a) // 2
                for part in (slice(cut, None), slice(None, cut)):
                    stack.append((level, a[part], b[part], seen[part], differ[part]))
                continue
            pattern, mask = self.levels[level]
            shared = mask[a] & mask[b]
            differ = differ + np.bitwise_count((pattern[a] ^ pattern[b]) & shared & ~seen)
            near = differ <= radius
            a, b, shared, differ = a[near], b[near], shared[near], differ[near]
            if not level:
                apart = a < b
                if apart.any():
                    yield a[apart], b[apart]
                continue
            first = self.first[level - 1]
            many_a, many_b = first[a + 1] - first[a], first[b + 1] - first[b]
            sizes = many_a * many_b
            at = np.repeat(np.arange(len(a)), sizes)
            place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            left, right = first[a][at] + place // many_b[at], first[b][at] + place % many_b[at]
            # Within one node each pair of children is met once.
            once = left <= right
            at = at[once]
            stack.append((level - 1, left[once], right[once], shared[at], differ[at]))


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while True:
        higher = parent[found]
        if np.array_equal(higher, found):
            return found
        found = higher


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        a, b = _roots(parent, a), _roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _bucket_links(buckets: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same prints as all close pairs within buckets do, fewer than there are prints."""
    _, inverse, counts = np.unique(buckets, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    buckets, prints = buckets[shared], prints[shared]
    if not len(prints):
        return prints, prints
    order = np.lexsort((gray_rank(prints), buckets))
    buckets, prints = buckets[order], prints[order]
    parent = np.arange(len(prints))
    for a, b in Index(buckets, prints).close_pairs(radius):
        _unite(parent, a, b)
    roots = _roots(parent, np.arange(len(prints)))
    linked = roots != np.arange(len(prints))
    return prints[linked], prints[roots[linked]]


def _search(radius: int):
    def links(buckets, prints):
        a, b = _bucket_links(buckets, prints, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches):
        # Rows come sorted by bucket; the last bucket of a batch waits for the next one.
        buckets, prints = np.array([], np.int64), np.array([], np.uint64)
        for batch in batches:
            buckets = np.concatenate([buckets, batch.column("bucket").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
            done = int(np.searchsorted(buckets, buckets[-1])) if len(buckets) else 0
            if done:
                yield links(buckets[:done], prints[:done])
                buckets, prints = buckets[done:], prints[done:]
        if len(buckets):
            yield links(buckets, prints)

    return run


def _masks(stride: int, blocks: int) -> list[int]:
    """Disjoint sets of bits, about equally large, that cover a fingerprint."""
    out = [0] * blocks
    for i in range(64):
        out[i * blocks // 64] |= 1 << (i * stride % 64)
    return out


def _dealt(rows: DataFrame, stride: int, blocks: int, agree: int) -> DataFrame:
    """Each print once for every choice of ``agree`` blocks, in the bucket of its bits there."""
    keys = []
    for i, some in enumerate(combinations(_masks(stride, blocks), agree)):
        mask = sum(some)
        mask -= mask >> 63 << 64
        # Equal buckets of different bits by chance only add comparisons.
        keys.append(F.xxhash64("bucket", F.lit(i), F.col("print").bitwiseAND(F.lit(mask).cast("long"))))
    return rows.select("print", F.explode(F.array(*keys)).alias("bucket"))


def _squares(rows: DataFrame) -> DataFrame:
    """Buckets cut into parts of half the limit, and each two parts of a bucket in a bucket of their own."""
    parts = F.ceil(F.col("n") * 2 / BUCKET_LIMIT)
    own = F.pmod(F.xxhash64("print", F.lit(1)), parts)
    rows = rows.select("bucket", "print", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    return rows.select("print", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"))


def close_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links a, b that connect all distinct values of ``print`` with at most ``radius`` differing bits.

    Of ``radius + k`` blocks such a pair agrees in at least ``k``.  Distinct prints
    of buckets over the limit are dealt again by other blocks and more agreeing
    bits, so a crowd of similar fingerprints is spread without losing a pair.  A
    bucket that is still over the limit after the last round is compared part by
    part, each two parts in one bucket: its pairs are many, but no task holds it.
    """
    found = []
    for i, (stride, agree) in enumerate(ROUNDS):
        rows = prints.select("print", F.lit(i).cast("long").alias("bucket")).distinct()
        rows = _dealt(rows, stride, radius + agree, agree)
        if i:
            rows = write_table(rows, f"dealt-{i}")
        counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        counts = write_table(counts, "buckets")
        crowded = F.col("n") > BUCKET_LIMIT
        found.append(rows.join(counts.filter(~crowded).select("bucket"), "bucket").select("print", "bucket"))
        if counts.filter(crowded).isEmpty():
            break
        rows = rows.join(counts.filter(crowded), "bucket")
        if i + 1 < len(ROUNDS):
            prints = write_table(rows.select("print").distinct(), f"crowded-{i}")
        else:
            found.append(_squares(rows))
    links = None
    for rows in found:
        rows = rows.repartition("bucket").sortWithinPartitions("bucket")
        more = rows.mapInArrow(_search(radius), "a long, b long")
        links = links.union(more) if links is not None else more
    return links


def near_groups(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """Fingerprint and component of every document.

    Returns doc_id, fingerprint (16 hexadecimal digits) and component_id, the
    smallest doc_id reachable over links of at most ``radius`` differing bits.

    Defined cases: NULL, empty and blank texts have the fingerprint 0 and are
    linked like any other; a text of fewer words than a shingle is one shingle;
    a component without any doc_id has a NULL component_id; repeated rows give a
    row each; an empty table gives no rows; other columns are ignored.
    """
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    prints = write_table(named.mapInArrow(_prints(size), "doc_id long, print long"), "prints")
    distinct = write_table(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    roots = components(close_links(distinct, radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left")
    rooted = write_table(rooted.select("print", "first", F.coalesce("root", "print").alias("root")), "roots")
    # Stored before the join, which can then split the rows of a large component.
    heads = write_table(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "heads")
    heads = write_table(rooted.join(heads, "root").select("print", "component_id"), "component-ids")
    text = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return prints.join(heads, "print").select("doc_id", text.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """The documents whose doc_id is the smallest of their component, with the columns of ``docs``.

    Rows without a doc_id can't be the smallest unless their whole component has
    none, which keeps them; rows with the same doc_id stay or go together.
    """
    groups = near_groups(docs, radius, size)
    others = groups.filter("component_id is not null and not (doc_id <=> component_id)").select("doc_id").distinct()
    others = write_table(others, "near-copies").withColumnRenamed("doc_id", "_other")
    return docs.join(others, F.col("doc_id").eqNullSafe(F.col("_other")), "left_anti")
