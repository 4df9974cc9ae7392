"""Near-duplicates by wide SimHash fingerprints in a Gray-order hierarchical index.

Two texts are linked if the Jaccard similarity of their five-word shingles is 0.8
or more.  Of two such sets, the first fifth of each (and one more) in any common
order share an element; common shingles come last in the order, which keeps the
documents of one key few.  Keys deal the documents to buckets, and an index over
the fingerprints of a bucket proposes pairs: neighbours in Gray order form nodes
that hold the bits all of them share, and two nodes whose shared bits already
differ too often are dropped with everything below.  Proposed pairs are settled
by their whole sets: one by one where they are few, and where a bucket proposes
many for each of its documents, that crowd's sets meet in one task, which gives
back no more links than it has documents.

A fingerprint has 512 bits.  Sets of similarity 0.8 differ in each with a chance
of 0.152, so in 78 bits with a standard deviation of about 8.5; the radius is five
of them away and stops most sets below 0.58.  Sets of up to ``SMALL`` shingles,
for which these chances are rough, are not judged by their bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.llm.common import Rows, arrow_schema, giving_back, raw_texts, texts
from plumbwright.llm.components import components
from plumbwright.llm.exact_dedup import SUSPECT_BITS, suspect_table
from plumbwright.llm.simhash_index import FAN, FRONTIER, _roots, _unite, gray_rank, shingle_hashes
from plumbwright.sources.scratch import write_table

SHINGLE = 5
# Similar are sets of a and b elements with 9 * common >= 4 * (a + b): Jaccard 0.8.
# Fingerprints in 64-bit words, and the bits in which those of similar sets may differ.
WORDS = 8
RADIUS = 122
SMALL = 8
# Documents whose shingles are counted for the order; it changes no result.
SAMPLED = 5_000
COMMON = 200_000
# Documents that one task compares with each other, and those held against one copy of a set.
GROUP_LIMIT = 2048
STAR_LIMIT = 4096
# Pairs for each of some documents beyond which they are settled together, and the
# shingles of a run of documents; at most two runs are settled at once.
CROWDED = 8
RUN_SHINGLES = 1 << 19
# Keys that a document names in each of its buckets; more of them repeat fewer pairs.
EARLY = 16
# Pairs of nodes that are compared at once; each may open ``FAN`` times ``FAN`` pairs below.
OPEN = FRONTIER // FAN**2
_NO_KEY = np.iinfo(np.int64).max
_EACH_BYTE = np.uint64(0x0101010101010101)

_SETS = arrow_schema(
    {"node": pa.int64(), "n": pa.int64(), "print": pa.binary(), "keys": pa.list_(pa.int64())}
)
_WHOLE = arrow_schema({"node": pa.int64(), "hashes": pa.binary()})
# A pair a, b; or in a, without b, a document of the crowd of the runs low and high of a bucket.
_CROWD = ("bucket", "low", "high")
_MEMBER = ("bucket", "key", "side", "root", "n", "print", "early")
_PROPOSED = arrow_schema(
    dict.fromkeys(("a", "b", "low", "high", "run", "bucket", "key", "side", "root", "n"), pa.int64())
    | {"print": pa.binary(), "early": pa.list_(pa.int64())}
)
_PROPOSED_SQL = ", ".join(f"{f.name} long" for f in list(_PROPOSED)[:-2]) + ", print binary, early array<long>"


def shingle_set(raw: bytes) -> np.ndarray:
    """Distinct shingles in order; texts without words have one in common."""
    found = list(shingle_hashes(raw, SHINGLE))
    return np.unique(np.concatenate(found)) if found else np.zeros(1, np.uint64)


def _node(raw: bytes) -> int:
    return int(np.array([xxhash.xxh3_64_intdigest(raw)], np.uint64).view(np.int64)[0])


def _shingles(batches):
    for batch in batches:
        for raw in raw_texts(batch):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_set(raw).view(np.int64))], names=["key"])


def _common(docs: DataFrame) -> np.ndarray:
    """Shingles that several sampled documents have, sorted."""
    named = texts(docs)
    parts = max(1, named.count() // SAMPLED)
    some = named.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == 0).mapInArrow(giving_back(_shingles), "key long")
    counts = some.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 2")
    top = counts.orderBy(F.desc("n"), "key").limit(COMMON).collect()
    return np.sort(np.array([r["key"] for r in top], np.int64).view(np.uint64))


def _mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of every value."""
    out = values ^ np.uint64((salt * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return out ^ (out >> np.uint64(31))


def _ones(values: np.ndarray) -> np.ndarray:
    """How many values have each of the 64 bits set."""
    # A byte of a sum counts up to 255 values, so eight bits are counted by one addition.
    padded = np.zeros(-(-len(values) // 255) * 255, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(-1, 255)
    ones = np.empty((8, 8), np.int64)
    for bit in range(8):
        sums = ((padded >> np.uint64(bit)) & _EACH_BYTE).sum(axis=1, dtype=np.uint64)
        ones[:, bit] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return ones.reshape(-1)


def wide_print(values: np.ndarray) -> np.ndarray:
    """The SimHash of a set of shingles: ``WORDS`` words of bits set in over half of the hashes."""
    ones = np.concatenate([_ones(_mixed(values, salt)) for salt in range(1, WORDS + 1)])
    return np.packbits(2 * ones > len(values), bitorder="little").view("<u8")


def _sets(common: np.ndarray):
    def run(batches):
        rows = Rows(_SETS)
        for batch in batches:
            for raw in raw_texts(batch):
                values = shingle_set(raw)
                n = len(values)
                at = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
                late = common[at] == values if len(common) else np.zeros(n, bool)
                ordered = np.concatenate([values[~late], values[late]])
                keys = ordered[: n - -(-4 * n // 5) + 1].view(np.int64).tolist()
                # Small sets aren't judged by bits, so theirs stay away.
                bits = wide_print(values).tobytes() if n > SMALL else bytes(8 * WORDS)
                rows.add(_node(raw), n, bits, keys, size=8 * len(keys) + len(bits))
                yield from rows.take()
        yield from rows.take(last=True)

    return run


class WideIndex:
    """Hierarchical index over wide fingerprints, sorted by bucket.

    Level 0 are the fingerprints.  A node above covers up to ``FAN`` neighbours of
    one bucket and holds the bits they share, their values, and the range of the
    components that its documents are in.
    """

    def __init__(self, buckets: np.ndarray, prints: np.ndarray, judged: np.ndarray, roots: np.ndarray):
        ids = np.cumsum(np.diff(buckets, prepend=buckets[:1]) != 0)
        used = np.where(judged, ~np.uint64(0), np.uint64(0))[:, None]
        ones, zeros, low, high = prints & used, ~prints & used, roots, roots
        self.levels = [(ones, ones | zeros, low, high)]
        self.first: list[np.ndarray] = []
        while len(ids) > ids[-1] + 1:
            starts = np.flatnonzero(np.diff(ids, prepend=-1))
            within = np.arange(len(ids)) - np.repeat(starts, np.diff([*starts, len(ids)]))
            heads = np.flatnonzero(within % FAN == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, heads), np.bitwise_and.reduceat(zeros, heads)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            ids = ids[heads]
            self.levels.append((ones, ones | zeros, low, high))
            self.first.append(np.append(heads, len(within)))

    def close_pairs(self, radius: int):
        """Positions of pairs of different components with at most ``radius`` differing bits, some at a time."""
        tops = np.arange(len(self.levels[-1][0]))
        stack = [(len(self.levels) - 1, tops, tops)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > OPEN:
                cut = len(a) // 2
                stack += [(level, a[cut:], b[cut:]), (level, a[:cut], b[:cut])]
                continue
            pattern, mask, low, high = self.levels[level]
            apart = (np.minimum(low[a], low[b]) != np.maximum(high[a], high[b])) & ((a < b) if not level else True)
            a, b = a[apart], b[apart]
            differ = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]).sum(axis=1, dtype=np.int64)
            a, b = a[differ <= radius], b[differ <= radius]
            if not level:
                yield a, b
                continue
            first = self.first[level - 1]
            many_a, many_b = first[a + 1] - first[a], first[b + 1] - first[b]
            sizes = many_a * many_b
            at = np.repeat(np.arange(len(a)), sizes)
            place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            left, right = first[a][at] + place // many_b[at], first[b][at] + place % many_b[at]
            once = left <= right
            stack.append((level - 1, left[once], right[once]))


def _prints(cells: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), "<u8").reshape(-1, WORDS)


def _close(na, nb, differ) -> np.ndarray:
    """Which pairs of sets of na and nb shingles may be similar."""
    near = 9 * np.minimum(na, nb) >= 4 * (na + nb)
    return near & ((differ <= RADIUS) | (np.minimum(na, nb) <= SMALL))


def _close_stars(batches):
    for batch in batches:
        differ = np.bitwise_count(_prints(batch.column("pa")) ^ _prints(batch.column("pb"))).sum(axis=1, dtype=np.int64)
        keep = _close(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), differ)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _early(cells: pa.Array) -> np.ndarray:
    """Lists of up to ``EARLY`` keys as rows of a matrix."""
    out = np.full((len(cells), EARLY), _NO_KEY)
    out[np.arange(EARLY) < pc.list_value_length(cells).to_numpy()[:, None]] = cells.flatten().to_numpy()
    return out


def _met_before(key: np.ndarray, early_a: np.ndarray, early_b: np.ndarray) -> np.ndarray:
    """Which pairs both name a key below that of their bucket; the least of such keys proposes them."""
    below = early_a < key[:, None]
    return ((early_a[:, :, None] == early_b[:, None, :]).any(axis=2) & below).any(axis=1)


def _columns(rows: pa.Table, *names: str) -> list[np.ndarray]:
    return [rows.column(name).to_numpy() for name in names]


def _in_index_order(rows: pa.Table) -> pa.Table:
    bucket, root = _columns(rows, "bucket", "root")
    rank = gray_rank(_prints(rows.column("print"))[:, 0].astype(np.uint64))
    # Documents of one component stay together, at the place of the first of them.
    order = np.lexsort((rank, root, bucket))
    heads = np.flatnonzero((np.diff(bucket[order], prepend=bucket[order][:1] - 1) != 0) | (np.diff(root[order], prepend=root[order][:1] - 1) != 0))
    place = np.repeat(np.minimum.reduceat(rank[order], heads), np.diff([*heads, len(order)]))
    return rows.take(pa.array(order[np.lexsort((rank[order], root[order], place, bucket[order]))]))


def _near(rows: pa.Table):
    """Positions of pairs of a bucket that may be similar, of different components, some at a time."""
    bucket, key, side, root, n = _columns(rows, "bucket", "key", "side", "root", "n")
    prints, early = _prints(rows.column("print")), _early(rows.column("early").combine_chunks())
    for a, b in WideIndex(bucket, prints, n > SMALL, root).close_pairs(RADIUS):
        # Where two parts of a key meet, the pairs within a part are left to its own bucket.
        near = _close(n[a], n[b], 0) & ((side[a] < 0) | (side[a] != side[b]))
        a, b = a[near], b[near]
        once = ~_met_before(key[a], early[a], early[b])
        yield a[once], b[once]


def _runs(bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Numbers, over all buckets, of runs of neighbours with about ``RUN_SHINGLES`` shingles each."""
    starts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1))
    before = np.cumsum(n) - n
    within = (before - np.repeat(before[starts], np.diff([*starts, len(n)]))) // RUN_SHINGLES
    return np.cumsum((np.diff(bucket, prepend=bucket[:1]) != 0) | (np.diff(within, prepend=within[:1]) != 0))


class _Cells:
    """Pairs of positions by the runs they are in; two runs, or one with itself, are a cell.

    A cell is a crowd once it has over ``crowded`` pairs for each of its documents
    that are in any pair; the pairs of crowds are not kept.
    """

    def __init__(self, run: np.ndarray, crowded: float):
        self.crowded = crowded
        self.run, self.paired = run, np.zeros(len(run), bool)
        self.a = self.b = self.crowds = np.zeros(0, np.int64)
        self.limit = FRONTIER

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.paired[a] = self.paired[b] = True
        self.a, self.b = np.concatenate([self.a, a]), np.concatenate([self.b, b])
        if len(self.a) >= self.limit:
            self.sift()
            self.limit = max(FRONTIER, 2 * len(self.a))

    def sift(self) -> None:
        cell = self.run[self.a] * len(self.run) + self.run[self.b]
        cells, pairs = np.unique(cell, return_counts=True)
        low, high = np.divmod(cells, len(self.run))
        size = np.bincount(self.run, weights=self.paired)
        new = cells[pairs > self.crowded * (size[low] + np.where(low < high, size[high], 0))]
        self.crowds = np.union1d(self.crowds, new)
        few = ~np.isin(cell, self.crowds)
        self.a, self.b = self.a[few], self.b[few]

    def members(self):
        """Of every crowd its two runs and the positions of its documents."""
        for low, high in zip(*(x.tolist() for x in np.divmod(self.crowds, len(self.run)))):
            yield low, high, np.flatnonzero(((self.run == low) | (self.run == high)) & self.paired)


def _larger_first(rows: pa.Table, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs of documents at the positions, the larger set first."""
    node, n = _columns(rows, "node", "n")
    swap = (n[a] < n[b]) | ((n[a] == n[b]) & (node[a] > node[b]))
    pairs = np.unique(np.stack([node[np.where(swap, b, a)], node[np.where(swap, a, b)]], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], names=["a", "b"])


def _starts(rows: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    """Where the groups of sorted rows begin."""
    new = np.arange(len(rows)) == 0
    for column in _columns(rows, *names):
        new |= np.diff(column, prepend=column[:1]) != 0
    return np.flatnonzero(new)


def _whole_groups(batches, *names: str):
    """Rows of whole groups; they come sorted, the last group of a batch waits for the next one."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([waiting, table]) if waiting is not None else table
        done = int(_starts(table, names)[-1]) if len(table) else 0
        if done:
            yield table.slice(0, done)
        waiting = table.slice(done)
    if waiting is not None and len(waiting):
        yield waiting


def _pairs(batches, crowds: list[pa.Table] | None = None):
    """Pairs of every bucket that may be similar; with a list ``crowds``, those of crowds go there by their documents."""
    for rows in _whole_groups(batches, "bucket"):
        rows = _in_index_order(rows)
        cells = _Cells(_runs(*_columns(rows, "bucket", "n")), np.inf if crowds is None else CROWDED)
        for a, b in _near(rows):
            cells.add(a, b)
        cells.sift()
        if len(cells.a):
            yield _larger_first(rows, cells.a, cells.b)
        for low, high, some in cells.members():
            of = {"a": rows.column("node"), "run": pa.array(cells.run)} | {name: rows.column(name) for name in _MEMBER}
            members = pa.table(of).take(pa.array(some))
            for name, run in (("low", low), ("high", high)):
                members = members.append_column(name, pa.array(np.full(len(some), run)))
            crowds.append(members)


def _proposed(batches):
    """Rows of ``_PROPOSED`` for every bucket."""
    crowds: list[pa.Table] = []
    for pairs in _pairs(batches, crowds):
        yield _padded(pairs)
        while crowds:
            yield _padded(crowds.pop())
    while crowds:
        yield _padded(crowds.pop())


def _padded(some: pa.Table | pa.RecordBatch) -> pa.RecordBatch:
    """Rows with NULL in the columns that they lack."""
    cells = []
    for f in _PROPOSED:
        cell = some.column(f.name) if f.name in some.schema.names else pa.nulls(len(some), f.type)
        cells.append((cell.combine_chunks() if isinstance(cell, pa.ChunkedArray) else cell).cast(f.type))
    return pa.RecordBatch.from_arrays(cells, schema=_PROPOSED)


def _settle(rows: pa.Table) -> pa.RecordBatch:
    """Links, fewer than documents, that connect those of a crowd whose sets are similar."""
    rows = _in_index_order(rows)
    node, root, run, low, high = _columns(rows, "node", "root", "run", "low", "high")
    sets = [np.frombuffer(cell.as_py(), np.uint64) for cell in rows.column("hashes")]
    n = np.array([len(s) for s in sets])
    starts = np.cumsum(n) - n
    # Shingles by numbers within the crowd.
    values = np.unique(np.concatenate(sets), return_inverse=True)[1]
    del sets
    held = np.zeros(values.max() + 1, np.int8)
    parent = np.unique(root, return_index=True, return_inverse=True)
    parent = parent[1][parent[2]]
    for a, b in _near(rows):
        # Pairs within one of two runs are left to that run's own cell.
        here = (run[a] != run[b]) == (low[a] != high[a])
        a, b = a[here], b[here]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        heads = np.flatnonzero(np.diff(a, prepend=-1))
        for one, others in zip(a[heads].tolist(), np.split(b, heads[1:])):
            others = others[_roots(parent, others) != _roots(parent, np.array([one]))]
            if not len(others):
                continue
            own = values[starts[one] : starts[one] + n[one]]
            held[own] = 1
            ends = np.cumsum(n[others])
            at = np.repeat(starts[others] - ends + n[others], n[others]) + np.arange(ends[-1])
            common = np.add.reduceat(held[values[at]], ends - n[others], dtype=np.int64)
            held[own] = 0
            alike = others[9 * common >= 4 * (n[one] + n[others])]
            _unite(parent, np.full(len(alike), one), alike)
        parent = _roots(parent, np.arange(len(parent)))
    linked = parent != np.arange(len(parent))
    return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[parent[linked]])], names=["a", "b"])


def _crowd_links(batches):
    for rows in _whole_groups(batches, *_CROWD):
        starts = _starts(rows, _CROWD)
        for start, end in zip(starts, [*starts[1:], len(rows)]):
            yield _settle(rows.slice(start, end - start))


def _check_stars(batches):
    """Pairs with similar sets; a star's own set comes before those that are held against it."""
    star = None
    for batch in batches:
        keep = []
        for own, cell in zip(batch.column("own").to_pylist(), batch.column("hashes")):
            values = np.frombuffer(cell.as_py(), np.uint64)
            if own:
                star = values
            common = 0 if own else len(np.intersect1d(star, values, assume_unique=True))
            keep.append(not own and 9 * common >= 4 * (len(star) + len(values)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _whole(batches):
    rows = Rows(_WHOLE)
    for batch in batches:
        for node, raw in zip(batch.column("node").to_pylist(), raw_texts(batch)):
            values = shingle_set(raw).tobytes()
            rows.add(node, values, size=len(values))
            yield from rows.take()
    yield from rows.take(last=True)


def _with_nodes(table, size: int):
    """Texts whose bit in the table of wanted ones is set."""
    shift = 65 - size.bit_length()

    def run(batches):
        bits = table.value
        for batch in batches:
            found = np.array([_node(r) for r in raw_texts(batch)], np.int64)
            at = (found.view(np.uint64) >> np.uint64(shift)).astype(np.int64)
            wanted = pa.array((bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column("text")], names=["node", "text"]).filter(wanted)

    return run


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _whole_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The sets of the texts in ``nodes``.

    Only these texts are moved: a table of fixed size tells the scan which texts
    are not wanted, with more of them more texts pass, and a join drops those.
    """
    wanted = write_table(nodes.distinct(), "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(suspect_table(wanted.withColumnRenamed("node", "print"), SUSPECT_BITS))
    some = texts(docs).mapInArrow(giving_back(_with_nodes(bits, SUSPECT_BITS)), "node long, text string")
    some = some.join(wanted, "node").dropDuplicates(["node"])
    return write_table(some.mapInArrow(giving_back(_whole), "node long, hashes binary"), "whole-sets")


def _similar(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The stored pairs whose whole sets are similar.

    The set of ``a`` is sent once for all its pairs, or once for each ``STAR_LIMIT`` of them.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR_LIMIT).alias("parts"))
    parts = write_table(parts, "star-parts")
    others = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    copies = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    rows = others.withColumn("node", F.col("b")).union(copies.select("a", F.col("a").alias("b"), "part", F.col("a").alias("node")))
    rows = rows.join(whole, "node").select("a", "b", "part", (F.col("a") == F.col("b")).alias("own"), "hashes")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("own"))
    return write_table(rows.select("a", "b", "own", "hashes").mapInArrow(giving_back(_check_stars), "a long, b long"), "similar")


def similar_links(docs: DataFrame) -> DataFrame:
    """Links a, b between text hashes that connect all texts with a similarity of 0.8 or more."""
    sets = texts(docs).mapInArrow(giving_back(_sets(_common(docs))), "node long, n long, print binary, keys array<long>")
    sets = write_table(sets.dropDuplicates(["node"]), "shingle-sets")
    keyed = sets.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("node").alias("center")).filter("docs > 1")
    keyed = write_table(keyed.join(write_table(shared, "shared-keys"), "key"), "keyed")
    # First each document with the first of its keys: this connects large families by few pairs.
    stars = keyed.filter("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    sizes = [sets.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("print").alias(f"p{k}")) for k in "ab"]
    stars = stars.join(sizes[0], "a").join(sizes[1], "b")
    stars = write_table(stars.mapInArrow(giving_back(_close_stars), "a long, b long"), "stars")
    links = _similar(stars, _whole_sets(_ends(stars), docs))
    roots = write_table(components(links), "star-roots")
    keyed = keyed.join(roots, "node", "left").select("key", "node", "docs", F.coalesce("root", "node").alias("root"))
    keyed = write_table(keyed, "rooted-keys")
    # Then what keys share over the borders of components.
    mixed = keyed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    rows = keyed.join(write_table(mixed.select("key"), "mixed-keys"), "key")
    # Each document's keys in order: a pair is proposed where the first key that both name has its bucket.
    places = F.sort_array(F.collect_list(F.struct("key", "docs"))).alias("places")
    rows = rows.groupBy("node").agg(F.min("root").alias("root"), places).join(sets.select("node", "n", "print"), "node")
    early = F.transform(F.slice("places", 1, EARLY), lambda place: place["key"]).alias("early")
    rows = rows.select("node", "root", "n", "print", early, F.explode("places").alias("place"))
    rows = rows.select("node", "root", "n", "print", "early", "place.key", "place.docs")
    parts = F.when(F.col("docs") > GROUP_LIMIT, F.ceil(F.col("docs") * 2 / GROUP_LIMIT)).otherwise(1).cast("long")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), parts))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    bucket = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("bucket")
    side = F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side")
    rows = rows.select("node", "root", "n", "print", "early", "key", side, bucket)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    found = write_table(rows.mapInArrow(giving_back(_proposed), _PROPOSED_SQL), "proposed")
    pairs = write_table(found.filter("b is not null").select("a", "b").distinct(), "candidates")
    # A crowd's pairs aren't rows: its documents meet in one task.
    crowds = found.filter("b is null").drop("b").withColumnRenamed("a", "node")
    whole = _whole_sets(_ends(pairs).union(crowds.select("node")), docs)
    rows = crowds.join(whole, "node").repartition(*_CROWD).sortWithinPartitions(*_CROWD)
    settled = write_table(rows.mapInArrow(giving_back(_crowd_links), "a long, b long"), "crowd-links")
    return links.union(_similar(pairs, whole)).union(settled)


def _nodes(batches):
    for batch in batches:
        found = pa.array([_node(r) for r in raw_texts(batch)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "node"])


def one_of_similar(docs: DataFrame) -> DataFrame:
    """The documents whose doc_id is the smallest of their component, with the columns of ``docs``.

    Links are pairs with a five-word Jaccard similarity of 0.8 or more; equal
    texts (by a 64-bit hash) are linked.  A pair of exactly 0.8 is missed with a
    chance of about one in a million, more similar ones less often.

    Defined cases: NULL, empty and blank texts are equal; a text of fewer than five
    words is one shingle; rows without a doc_id can't be the smallest unless their
    whole component has none, which keeps them; rows with the same doc_id stay or
    go together; an empty table gives no rows; columns of any name are kept.
    """
    named = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    nodes = write_table(named.mapInArrow(giving_back(_nodes), "doc_id long, node long"), "nodes")
    first = nodes.groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = first.join(components(similar_links(docs)), "node", "left")
    rooted = write_table(rooted.select("node", "first", F.coalesce("root", "node").alias("root")), "roots")
    heads = write_table(rooted.groupBy("root").agg(F.min("first").alias("head")), "heads")
    heads = write_table(rooted.join(heads, "root").select("node", "head"), "node-heads")
    others = nodes.join(heads, "node").filter("head is not null and not (doc_id <=> head)").select("doc_id").distinct()
    others = write_table(others, "near-copies").withColumnRenamed("doc_id", "_other")
    return docs.join(others, F.col("doc_id").eqNullSafe(F.col("_other")), "left_anti")
