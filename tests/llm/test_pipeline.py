"""The stages of the pipeline, and the registered queries against their SQL."""

import collections
import zlib
from itertools import combinations

import numpy as np
import pytest
from check_queries import compare, connect
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from plumbwright.llm import mixing, quality_model, word_ids
from plumbwright.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def five_words(text):
    words = text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = docs.collect()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    all_docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scored = quality_model.score(all_docs, quality_model.fit(all_docs, labels))
    good = {r["doc_id"] for r in scored.collect() if r["kept"]}
    assert {r["doc_id"] for r in kept["quality classifier"]} == good
    # One of each text, the longest, then the smallest id.
    best = {}
    for r in sorted(kept["quality classifier"], key=lambda r: (-len(r["text"]), r["doc_id"])):
        best.setdefault("".join(r["text"].split(" ")).translate(dict.fromkeys(range(9, 14))), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept["exact dedup"]) == sorted(best.values())
    # One of each component of texts with a five-word Jaccard similarity of 0.8 or more, compared pair by pair.
    sets = {r["doc_id"]: five_words(r["text"]) for r in kept["exact dedup"]}
    roots = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((roots[a], roots[b]))
            roots = {i: low if r == high else r for i, r in roots.items()}
    assert {r["doc_id"] for r in kept["simhash near-dedup"]} == set(roots.values())
    near = spark.createDataFrame(kept["simhash near-dedup"], docs.schema)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(near).collect() if r["times"]}
    assert dict(collections.Counter(r["doc_id"] for r in kept["mixing sources"])) == times


def test_pipeline_packs_every_document_it_keeps(spark):
    library = Tokenizer.from_file(word_ids.WORD_FILE)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    starts = collections.Counter(r["doc_id"] for r in rows if r["start"] == 0)
    assert rows and set(starts) <= set(texts) and max(starts.values()) <= 3
    ids = {i: np.array([*library.encode(texts[i], add_special_tokens=False).ids, 1], "<u4") for i in starts}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    for i, n in starts.items():
        assert sum(r["length"] for r in rows if r["doc_id"] == i) == n * len(ids[i])


@pytest.mark.parametrize("name", list(QUERIES))
def test_registered_query(spark, name):
    df = entry_module.queries()[name](spark, SMALL)
    assert df.select("doc_id").distinct().count() == 200
    if name in SQL:
        assert entry_module.oracle_sql()[name]
        ok, note = compare(spark, connect(SMALL), SMALL, name)
        assert ok, note
