"""Registered queries of the training-data operators, and their SQL texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbwright.llm import (
    exact_dedup,
    host_rules,
    licenses,
    merkle,
    mixing,
    ngram_trie,
    packing,
    periodic,
    quality_model,
    records,
    simhash_index,
    suffix_dedup,
    token_counts,
)
from plumbwright.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


@query(
    "op5_exact_dedup",
    r"""
    WITH t AS (
        SELECT doc_id, coalesce(text, '') AS body,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
        FROM documents),
    r AS (
        SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS n,
               first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(body) DESC, doc_id) AS keep_id
        FROM t)
    SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
    """,
)
def op5_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(read_table(spark, folder, "documents"))


@query("op9_pack_powers")
def op9_pack_powers(spark, folder):
    return packing.pack(read_table(spark, folder, "documents"), with_ids=False)


@query("op7_prefix_token_counts")
def op7_prefix_token_counts(spark, folder):
    return token_counts.token_counts(read_table(spark, folder, "documents"), with_prefixes=False)


@query("op10_token_records")
def op10_token_records(spark, folder):
    written = records.write_records(read_table(spark, folder, "documents"))
    return records.read_records(written, with_ids=False)


@query("op2_mix_sources")
def op2_mix_sources(spark, folder):
    return mixing.mix(read_table(spark, folder, "documents"))


@query("op3_quality_grades")
def op3_quality_grades(spark, folder):
    docs = read_table(spark, folder, "documents")
    return quality_model.score(docs, quality_model.fit(docs, read_table(spark, folder, "labels")))


# The windows of three words are compared as texts here, not by hashes.
_HOST_RULES = r"""
    WITH t AS (
        SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    win AS (
        SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t3
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
    rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t3) AS c FROM win),
    cov AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE c > 1)
        GROUP BY doc_id),
    line AS (
        SELECT doc_id, count(*) - count(DISTINCT l) AS n
        FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS l FROM t)
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m AS (
        SELECT doc_id, host, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint AS word_chars,
               length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(line.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
        FROM t LEFT JOIN cov USING (doc_id) LEFT JOIN line USING (doc_id)),
    f AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 10 * n_symbols > n_words AS symbols,
               20 * n_dup_lines > n_words AS lines,
               n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words) AS word_length
        FROM m),
    h AS (
        SELECT host, rule, count(*) AS n, sum(bad::int) AS x
        FROM (SELECT host, unnest(['b', 's', 'l', 'w']) AS rule, unnest([base_failed, symbols, lines, word_length]) AS bad FROM f)
        GROUP BY host, rule),
    a AS (
        SELECT rule, sum(x) / sum(n) AS p, sum(x * x / n) / sum(n) AS square, count(*) / sum(n) AS per FROM h GROUP BY rule),
    b AS (SELECT rule, p, p * (1 - p) AS within, square - p * p - p * (1 - p) * per AS between FROM a),
    pr AS (
        SELECT rule, p, least(greatest(CASE WHEN between > 0 THEN within / between - 1 ELSE 1e6 END, 2), 1e6) AS weight FROM b),
    v AS (SELECT host, max((x + weight * p) / (n + weight)) > 0.5 AS host_failed FROM h JOIN pr USING (rule) GROUP BY host)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
           NOT base_failed AND NOT host_failed AS kept
    FROM f JOIN v USING (host)
    """


@query("op6_host_rules", _HOST_RULES)
def op6_host_rules(spark, folder):
    return host_rules.judge(read_table(spark, folder, "documents"))


@query("op4_simhash_groups")
def op4_simhash_groups(spark, folder):
    return simhash_index.near_groups(read_table(spark, folder, "documents"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, folder):
    return suffix_dedup.remove_repeats(read_table(spark, folder, "documents")).drop("spans", "kept")


@query("op8_ngram_trie")
def op8_ngram_trie(spark, folder):
    return ngram_trie.score(read_table(spark, folder, "documents"))


# CRC-32 of ASCII text, bit by bit: DuckDB has no such function.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda k: ascii(k)::bigint)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

# Equal words of a document, paired at every lag; neighbouring pairs of one lag form a stretch.
_PERIODIC = rf"""
    WITH t AS (
        SELECT doc_id, {_CRC32.format(text="doc_id::varchar")} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    p AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
    q AS (SELECT *, 1 + (len(w) - a) // (3 + g % 8) AS p FROM p),
    word AS (
        SELECT doc_id, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS x
        FROM (SELECT doc_id, w, a, p, unnest(range(len(w))) AS i FROM q)),
    pair AS (SELECT l.doc_id, r.i - l.i AS q, l.i AS i FROM word l JOIN word r ON l.doc_id = r.doc_id AND l.x = r.x AND l.i < r.i),
    stretch AS (
        SELECT doc_id, q, min(i) AS start, count(*) AS m
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pair)
        GROUP BY doc_id, q, part HAVING count(*) >= greatest(12 - q, q)),
    run AS (SELECT doc_id, start, m + q AS length, min(q) AS period FROM stretch GROUP BY doc_id, start, m + q),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS body FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    best AS (
        SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
        FROM run GROUP BY doc_id),
    top AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)
    """


@query("op11_periodic_runs", _PERIODIC)
def op11_periodic_runs(spark, folder):
    planted = periodic.plant_runs(read_table(spark, folder, "documents"))
    return periodic.digest(periodic.periodic_runs(planted))


# The same rules on the same spaced words; places are running sums over the pieces between matches.
_LICENSES = rf"""
    WITH rules(number, keyword, licence, pattern, priority, label, score, base) AS (VALUES {licenses.rule_values()}),
    t AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    kw AS (SELECT doc_id, keyword FROM (SELECT DISTINCT doc_id, unnest(w) AS keyword FROM t) SEMI JOIN rules USING (keyword)),
    body AS (
        SELECT doc_id, ' ' || array_to_string(w, '  ') || ' ' AS b, list_contains(w, 'license') OR list_contains(w, 'licence') AS said
        FROM t WHERE doc_id IN (SELECT doc_id FROM kw)),
    met AS (
        SELECT doc_id, b, r.* FROM body JOIN kw USING (doc_id) JOIN rules r USING (keyword)
        WHERE (said OR NOT r.licence) AND regexp_matches(b, r.pattern)),
    piece AS (
        SELECT doc_id, number, unnest(range(len(hits))) AS k, unnest(pieces[1:len(hits)]) AS before, unnest(hits) AS hit
        FROM (SELECT *, string_split_regex(b, pattern) AS pieces, regexp_extract_all(b, pattern) AS hits FROM met)),
    sized AS (
        SELECT doc_id, number, k, (length(before) - length(replace(before, ' ', ''))) // 2 AS x,
               (length(hit) - length(replace(hit, ' ', ''))) // 2 AS y
        FROM piece),
    place AS (
        SELECT doc_id, e - y AS s, e, priority, number, label, score::double AS score, base
        FROM (SELECT *, sum(x + y) OVER (PARTITION BY doc_id, number ORDER BY k)::bigint AS e FROM sized) JOIN rules USING (number)),
    outermost AS (
        SELECT * FROM (
            SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e DESC, priority, number
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
            FROM place WHERE NOT base)
        WHERE reach IS NULL OR reach < e),
    line AS (
        SELECT *, lag(e) OVER o > s AND lag(priority) OVER o < priority AS lost_before,
               lead(s) OVER o < e AND lead(priority) OVER o < priority AS lost_after
        FROM outermost WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
    good AS (SELECT * FROM line WHERE label IS NOT NULL AND NOT coalesce(lost_before, false) AND NOT coalesce(lost_after, false)),
    basic AS (
        SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
        FROM place WHERE base GROUP BY doc_id),
    total AS (
        SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
        FROM (SELECT doc_id, label, score FROM good UNION ALL SELECT doc_id, label, score FROM place WHERE base) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
           coalesce(labels, '') AS labels, coalesce(score, 0) AS score
    FROM t LEFT JOIN basic USING (doc_id) LEFT JOIN total USING (doc_id)
    """


@query("op13_license_scan", _LICENSES)
def op13_license_scan(spark, folder):
    return licenses.scan(read_table(spark, folder, "documents"))


def _framed(column: str) -> str:
    return f"coalesce(strlen({column}::varchar)::varchar || ':' || {column}::varchar, '-')"


_MERKLE_LEAF = " || ".join(map(_framed, ("doc_id", "source", "lang", "{n_chars}", "text")))
# All levels are built one by one; level 0 of the upper tree continues from the groups' last levels.
_MERKLE = rf"""
    WITH RECURSIVE
    t AS (SELECT *, {_CRC32.format(text="doc_id::varchar")} % 7 = 0 AS changed FROM documents),
    leaf AS (
        SELECT doc_id, lang, sha256({_MERKLE_LEAF.format(n_chars="n_chars")}) AS leaf,
               sha256({_MERKLE_LEAF.format(n_chars="(n_chars + changed::int)")}) AS given
        FROM t),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaf),
    lower AS (
        SELECT lang, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM placed
        UNION ALL
        SELECT lang, any_value(level) + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
        FROM lower WHERE n > 1 GROUP BY lang, idx // 2),
    sub AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS ord FROM lower WHERE n = 1),
    upper AS (
        SELECT 0 AS level, ord AS idx, subroot AS digest, (SELECT count(*) FROM sub) AS n FROM sub
        UNION ALL
        SELECT any_value(level) + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
        FROM upper WHERE n > 1 GROUP BY idx // 2),
    low AS (
        SELECT doc_id, lang, leaf, 0 AS level, idx, given AS folded, '' AS proof FROM placed
        UNION ALL
        SELECT c.doc_id, c.lang, c.leaf, c.level + 1, c.idx // 2,
               sha256(CASE WHEN s.digest IS NULL THEN folded WHEN c.idx % 2 = 1 THEN s.digest || folded ELSE folded || s.digest END),
               proof || coalesce(s.digest, '')
        FROM low c JOIN (SELECT lang, level, any_value(n) AS n FROM lower GROUP BY lang, level) z
               ON z.lang IS NOT DISTINCT FROM c.lang AND z.level = c.level AND z.n > 1
        LEFT JOIN lower s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.idx = xor(c.idx, 1)),
    met AS (
        SELECT l.doc_id, l.leaf, sub.subroot, 0 AS level, sub.ord AS idx, l.folded, l.proof
        FROM low l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang
        WHERE l.level = (SELECT max(level) FROM lower x WHERE x.lang IS NOT DISTINCT FROM l.lang)),
    high AS (
        SELECT * FROM met
        UNION ALL
        SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.idx // 2,
               sha256(CASE WHEN s.digest IS NULL THEN folded WHEN c.idx % 2 = 1 THEN s.digest || folded ELSE folded || s.digest END),
               proof || coalesce(s.digest, '')
        FROM high c JOIN (SELECT level, any_value(n) AS n FROM upper GROUP BY level) z ON z.level = c.level AND z.n > 1
        LEFT JOIN upper s ON s.level = c.level AND s.idx = xor(c.idx, 1)),
    root AS (SELECT digest AS root FROM upper WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM high, root WHERE level = (SELECT max(level) FROM upper)
    """


@query("op12_merkle_manifest", _MERKLE)
def op12_merkle_manifest(spark, folder):
    return merkle.prove(merkle.build(read_table(spark, folder, "documents"), shown=merkle.tampered()))
