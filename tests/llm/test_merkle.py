import hashlib
import zlib

import pytest

from plumbwright.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(nodes, at):
    """The last node above ``nodes`` and what stands beside the one at place ``at`` on the way: (left, digest or None)."""
    way = []
    while len(nodes) > 1:
        beside = at ^ 1
        way.append((bool(at & 1), nodes[beside] if beside < len(nodes) else None))
        nodes, at = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], at // 2
    return nodes[0], way


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars) to the contract's columns."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        one = leaf(doc_id, source, lang, n_chars, text)
        changed = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        given = leaf(doc_id, source, lang, n_chars + 1, text) if changed else one
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, one, given))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for members in groups.values():
        members.sort()
    subs = [climb([m[2] for m in groups[g]], 0)[0] for g in names]
    out = []
    for i, g in enumerate(names):
        for at, (known, doc_id, one, given) in enumerate(groups[g]):
            _, low = climb([m[2] for m in groups[g]], at)
            root, high = climb(subs, i)
            folded, proof = given, []
            for left, beside in low + high:
                folded = digest(folded) if beside is None else digest(beside, folded) if left else digest(folded, beside)
                proof += [beside] if beside else []
            out.append((doc_id if known else None, one, subs[i], root, digest(*proof), folded, folded == root))
    return sorted(out, key=str)


KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def proved(docs):
    rows = merkle.prove(merkle.build(docs, shown=merkle.tampered())).collect()
    return sorted((tuple(r) for r in rows), key=str)


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, KIND).repartition(partitions)


def rows_of(count, langs):
    return [(i, f"text {i} é" if i % 9 else None, langs[i % len(langs)], f"s{i % 4}" if i % 11 else None, i if i % 5 else None) for i in range(count)]


@pytest.mark.parametrize("span", [2, 10])
def test_equals_brute_force(spark, monkeypatch, span):
    """Few levels between stored rows make many steps, and many copies of the upper ones."""
    monkeypatch.setattr(merkle, "SPAN", span)
    monkeypatch.setattr(merkle, "SHARE", 2)
    rows = rows_of(77, ["en", "en", "en", "en", "de", None, "fr", "Zz"]) + [(500, "alone", "it", None, 3)]
    got = proved(frame(spark, rows))
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_sizes_around_powers_of_two(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 2)
    for count in (1, 3, 4, 9):
        rows = rows_of(count, ["en"])
        assert proved(frame(spark, rows)) == brute(rows), count


def test_sample_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert proved(docs) == brute(rows)


def test_odd_and_empty_inputs(spark, odd, empty):
    """NULL and repeated ids, repeated rows, clashing columns."""
    rows = [tuple(r)[:5] for r in odd.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert proved(odd) == brute(rows)
    many = [(None, "same", None, None, None)] * 20 + [(7, "same", "en", "s", 1)] * 20 + [(None, f"t{i}", "en", "s", 1) for i in range(9)]
    assert proved(frame(spark, many)) == brute(many)
    built = merkle.build(empty, shown=merkle.tampered())
    assert built.root is None and merkle.prove(built).collect() == []


def test_other_columns_and_untouched_rows(spark):
    docs = frame(spark, rows_of(30, ["en", "de"])).withColumnsRenamed({"lang": "shard"})
    built = merkle.build(docs, group="shard", columns=("doc_id", "text"))
    assert {r["verified"] for r in merkle.prove(built).collect()} == {True}
    changed = merkle.build(docs.replace("text 5 é", "text 5"), group="shard", columns=("doc_id", "text"))
    assert changed.root != built.root


def test_upper_nodes_have_copies_and_the_query_is_recursive(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 3)
    built = merkle.build(frame(spark, rows_of(600, ["en", "en", "de"])))
    counts = {r[:3]: r[3] for r in map(tuple, built.nodes.groupBy("tree", "level", "idx").count().collect())}
    # Above 8 leaves one row, above 64 one; the tree of 400 has one for each 64 in its place in the upper tree.
    assert counts[(1, 1, 0)] == 1 and counts[(1, 2, 0)] == 1 and counts[(merkle.TOP, 0, 1)] == 400 // 64
    used = built.leaves.sparkSession.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.prove(built)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == used
    plan = spark.sql(merkle._CLIMB, leaves=built.leaves, nodes=built.nodes)._jdf.queryExecution().toString()
    assert "UnionLoop" in plan
