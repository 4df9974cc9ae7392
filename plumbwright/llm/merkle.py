"""A Merkle manifest of a table: trees of digests by group, their roots in one tree above.

Rows are leaves, in order of a key within their group.  Levels are built by
grouping nodes into blocks of 2^``SPAN`` neighbours, so no row holds more than a
block, however large a group is.  Of every ``SPAN``-th level the nodes are stored
as rows that link to their parent, the node ``SPAN`` levels up (or the group's
leaf of the upper tree), with the siblings on the way there.

Proofs come from a recursive query that starts with the row of each leaf and its
siblings.  A step joins it with its parent's row, appends the siblings and folds
the digest that is to be verified with them, until a node without a parent is
reached.  Many
leaves meet in one upper node, so a node's row is laid out in several copies, one
for about 64 leaves below it but at most ``COPIES``, and each leaf uses one of
them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field
from plumbwright.operators.ordering import global_rank
from plumbwright.sources.scratch import write_table

# Levels from one stored node row to the next.
SPAN = 10
# Most copies of one node's row.
COPIES = 4096
SHARE = 64
# Number of the tree of roots; groups count from 0.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    """``leaves`` and ``nodes``: linked rows; ``subroots``: tree, subroot; ``root``.  Digests of rows are binary, roots hex."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _once(**columns: Column) -> Column:
    """Compute columns once: a generator is not merged into the expressions above it."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def row_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of a row: for every value its length in bytes, a colon and the value, or ``-`` for NULL."""

    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, values)), 256)


def _height(n: Column) -> Column:
    """Levels above n nodes until one is left."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _copies(below: str) -> Column:
    return F.expr(f"CAST(greatest(1, least({COPIES}, {below} div {SHARE})) AS bigint)")


def _blocks(nodes: DataFrame, step: int, name: str, payload: Sequence[str]) -> DataFrame:
    """Blocks of neighbouring nodes (tree, n, idx, digest, below): the node above each and the way there.

    Stored: tree, n, idx, digest and below of the node above, whether its tree
    ends there (last), and kids (idx, below, the columns of ``payload``, steps).  A
    step is the side and the digest of a sibling; the digest is NULL where a node
    is alone.
    """
    own = F.sort_array(F.collect_list(F.struct("idx", "digest", "below", *payload)))
    out = nodes.groupBy("tree", "n", F.shiftright("idx", SPAN).alias("up")).agg(own.alias("own"), F.sum("below").alias("below"))
    todo = F.least(F.lit(SPAN), _height(F.col("n")) - SPAN * step)
    out = out.select("*", todo.alias("todo"), _once(l0=F.transform("own", lambda o: F.lower(F.hex(o["digest"])))))
    for i in range(SPAN):
        above = F.expr(
            f"transform(sequence(0, (size(l{i}) - 1) div 2), i -> sha2(concat(l{i}[2 * i], coalesce(get(l{i}, 2 * i + 1), '')), 256))"
        )
        out = out.select("*", _once(**{f"l{i + 1}": F.when(F.col("todo") > i, above)}))
    # At level i, place j lies below place j >> i, whose sibling is its neighbour in the pair.
    steps = ", ".join(
        f"IF(todo > {i}, named_struct('left', (shiftright(j, {i}) & 1) = 1, 'digest', unhex(get(l{i}, shiftright(j, {i}) ^ 1))), NULL)"
        for i in range(SPAN)
    )
    kept = "".join(f"'{c}', o.{c}, " for c in ("idx", "below", *payload))
    kids = F.expr(f"transform(own, (o, j) -> named_struct({kept}'steps', array_compact(array({steps}))))")
    digest = F.unhex(F.coalesce(*[F.col(f"l{i}") for i in reversed(range(SPAN + 1))])[0])
    last = _height(F.col("n")) <= SPAN * (step + 1)
    table = out.select("tree", "n", F.col("up").alias("idx"), digest.alias("digest"), "below", last.alias("last"), kids.alias("kids"))
    return write_table(table, name)


def _trees(nodes: DataFrame, largest: int, name: str, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Linked rows over nodes (tree, n, idx, digest, below), a frame for each stored level, and each tree's last node."""
    rows, ends, step = [], [], 0
    while step == 0 or largest > 1 << (SPAN * step):
        blocks = _blocks(nodes, step, f"{name}-{step}", payload if step == 0 else ())
        top, here = F.col("tree") == TOP, F.col("last")
        links = blocks.select(
            "tree", F.lit(step).alias("level"), _copies("below").alias("up_copies"),
            F.when(~here, F.col("tree")).when(~top, F.lit(TOP)).cast("long").alias("up_tree"),
            F.when(here, 0).otherwise(step + 1).alias("up_level"),
            F.when(here, F.col("tree")).otherwise(F.col("idx")).alias("up_idx"),
            F.inline("kids"),
        )
        rows.append(links)
        ends.append(blocks.filter("last").select("tree", "digest", "below"))
        nodes, step = blocks.filter("NOT last").select("tree", "n", "idx", "digest", "below"), step + 1
    return rows, reduce(DataFrame.unionByName, ends)


def _copied(links: DataFrame) -> DataFrame:
    """Linked rows in as many copies as leaves below them need."""
    copy = F.explode(F.sequence(F.lit(0).cast("long"), _copies("below") - 1)).alias("copy")
    return links.select("tree", "level", "idx", copy, "steps", "up_tree", "up_level", "up_idx", "up_copies")


def build(
    docs: DataFrame, group: str = "lang", order: str = "doc_id", columns: Sequence[str] = COLUMNS,
    shown: Mapping[str, Column] | None = None,
) -> Manifest:
    """Digest every row of ``columns`` and build the trees of its groups and the tree of their roots.

    ``shown`` replaces columns in the rows that are to be verified; ``given`` is
    their digest.  Groups are in byte order of their name, NULL first.

    Defined cases: NULL values are framed as ``-``; rows with a NULL key come
    first in their group; rows with equal keys are in order of their digests, so
    repeated rows are leaves of their own; an empty table has no root; other
    columns are ignored.
    """
    shown = dict(shown or {})
    leaf = row_digest([field(c) for c in columns])
    given = row_digest([shown.get(c, field(c)) for c in columns]) if shown else leaf
    keyed = docs.select(
        field(order).cast("long").alias("doc_id"), field(group).cast("string").alias("_group"), F.unhex(leaf).alias("digest"),
        F.unhex(given).alias("given"), F.monotonically_increasing_id().alias("_row"),
    )
    # Stored on the way, so the two uses below read the same ranks.
    ranked = global_rank(write_table(keyed, "leaves"), ["_group", "doc_id", "digest", "_row"], "_rank")
    sizes = ranked.groupBy("_group").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("n"))
    groups = write_table(global_rank(sizes, ["_group"], "tree"), "groups")
    count, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    named = groups.withColumnRenamed("_group", "_name")
    placed = ranked.join(named, F.col("_group").eqNullSafe(F.col("_name"))).select(
        "tree", "n", (F.col("_rank") - F.col("_first")).alias("idx"), "digest", F.lit(1).cast("long").alias("below"), "doc_id", "given"
    )
    low, ends = _trees(placed.withColumn("leaf", F.col("digest")), largest or 0, "blocks", ("doc_id", "leaf", "given"))
    tops = ends.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("idx"), "digest", "below"
    )
    high, top = _trees(tops, count, "top")
    root = top.first()
    nodes = write_table(reduce(DataFrame.unionByName, map(_copied, low[1:] + high)), "nodes")
    subroots = ends.select("tree", F.lower(F.hex("digest")).alias("subroot"))
    return Manifest(low[0], nodes, subroots, root and root["digest"].hex())


_FOLD = """aggregate({steps}, {digest}, (h, s) -> unhex(sha2(CASE WHEN s.digest IS NULL THEN lower(hex(h))
            WHEN s.left THEN lower(concat(hex(s.digest), hex(h))) ELSE lower(concat(hex(h), hex(s.digest))) END, 256)))"""
_APPEND = "aggregate({steps}, {proof}, (p, s) -> concat(p, coalesce(s.digest, X'')))"
_CLIMB = f"""
WITH RECURSIVE climb AS (
    SELECT doc_id, leaf, tree AS home, idx AS place, up_tree AS tree, up_level AS level, up_idx AS idx, idx % up_copies AS copy,
        {_FOLD.format(steps="steps", digest="given")} AS folded, {_APPEND.format(steps="steps", proof="X''")} AS proof
    FROM {{leaves}}
    UNION ALL
    SELECT c.doc_id, c.leaf, c.home, c.place, n.up_tree, n.up_level, n.up_idx, c.place % n.up_copies,
        {_FOLD.format(steps="n.steps", digest="c.folded")}, {_APPEND.format(steps="n.steps", proof="c.proof")}
    FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx AND c.copy = n.copy)
SELECT doc_id, leaf, home, folded, unhex(sha2(lower(hex(proof)), 256)) AS proof FROM climb WHERE tree IS NULL
"""
_ROWS = "spark.sql.cteRecursionRowLimit"


def prove(manifest: Manifest) -> DataFrame:
    """Verify every leaf's given digest against the root.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the siblings from the
    leaf up), folded_root and verified.  The rows of a recursive query are limited
    by a setting that does not grow with the input, so it is lifted for this query.
    """
    spark = manifest.leaves.sparkSession
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, "-1")
    try:
        climbed = write_table(spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes), "climbed")
    finally:
        spark.conf.set(_ROWS, before)
    root = F.lit(manifest.root).cast("string")
    out = climbed.join(manifest.subroots.withColumnRenamed("tree", "home"), "home")
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "folded", "proof")}
    return out.select(
        "doc_id", text["leaf"].alias("leaf"), "subroot", root.alias("root"), text["proof"].alias("proof_sha256"),
        text["folded"].alias("folded_root"), (text["folded"] == root).alias("verified"),
    )


def tampered() -> dict[str, Column]:
    """One more in n_chars where 7 divides the CRC-32 of the document's id."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    return {"n_chars": F.when(chosen, F.try_add(F.col("n_chars"), F.lit(1))).otherwise(F.col("n_chars"))}
