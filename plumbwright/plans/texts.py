"""Queries: logs, chunking, CSV wrangling, forecast grids and byte costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbwright.functions.cells import coerce_kind, field
from plumbwright.functions.fixed import FORECAST_CELL, SKY
from plumbwright.operators import bytecost, chunk, forecast, logs, wrangle
from plumbwright.plans.base import (
    GAP,
    LOG_REGEX,
    PARAGRAPH_REGEX,
    WS_CLASS,
    Tables,
    plan,
    s_float,
    s_is_whole,
    s_long_int,
    s_norm,
    s_strip,
    sql,
)
from plumbwright.sources.files import json_text

# -- access logs ------------------------------------------------------------

_LOG = ("v_log_lines",)
_PARSED = {
    "m": f"""SELECT pos, regexp_matches({s_strip('line')}, '{LOG_REGEX}') AS ok,
regexp_extract({s_strip('line')}, '{LOG_REGEX}', ['ip', 'ts', 'method', 'path', 'status', 'bytes', 'ms']) AS g
FROM v_log_lines WHERE {s_norm('line')} <> ''""",
    "r": """SELECT pos, g.ip AS ip, g.ts AS ts, g.method AS method, g.path AS path, g.status::int AS status,
CASE WHEN g.bytes = '-' THEN 0 ELSE try_cast(g.bytes AS bigint) END AS bytes, g.ms::bigint AS ms FROM m WHERE ok""",
}
_SUMMARY = """SELECT count(*) AS total_requests, (SELECT count(*) FROM m WHERE NOT ok) AS malformed_lines,
coalesce(round_even(100.0::double * count(*) FILTER (WHERE status >= 400) / count(*), 1), 0.0)::double AS error_rate_pct,
count(*) FILTER (WHERE ms >= 500) AS slow_requests FROM r"""
_SLOWEST = "SELECT path, avg(ms) AS avg_ms, min(pos) AS p FROM r GROUP BY path ORDER BY avg(ms) DESC, min(pos) LIMIT 3"
_TALKERS = "SELECT ip, count(*) AS n, min(pos) AS p FROM r GROUP BY ip ORDER BY count(*) DESC, min(pos) LIMIT 3"


def _parsed(t: Tables):
    return logs.parse_lines(t["v_log_lines"])


@plan("log_parse", sql("SELECT * FROM r", _LOG, **_PARSED))
def log_parse(t: Tables):
    return logs.records(_parsed(t))


@plan("log_malformed", sql(f"SELECT pos, {s_strip('line')} AS raw FROM v_log_lines JOIN m USING (pos) WHERE NOT ok", _LOG, **_PARSED))
def log_malformed(t: Tables):
    return logs.malformed(_parsed(t))


def summary_sql() -> str:
    return sql(_SUMMARY, _LOG, **_PARSED)


@plan("log_summary", summary_sql())
def log_summary(t: Tables):
    return logs.traffic_summary(_parsed(t))


@plan("log_status", sql("SELECT status, count(*) AS n FROM r GROUP BY status", _LOG, **_PARSED))
def log_status(t: Tables):
    return logs.status_counts(_parsed(t))


@plan("log_slowest", sql("SELECT path, round(avg_ms, 6) AS avg_ms FROM s", _LOG, **_PARSED, s=_SLOWEST))
def log_slowest(t: Tables):
    return logs.slowest_endpoints(_parsed(t), "pos").withColumn("avg_ms", F.round("avg_ms", 6))


@plan("log_talkers", sql("SELECT ip, n FROM s", _LOG, **_PARSED, s=_TALKERS))
def log_talkers(t: Tables):
    return logs.top_talkers(_parsed(t), "pos")


@plan(
    "log_report",
    sql(
        """SELECT 'status_counts' AS section, status::varchar AS item, NULL::int AS rank, count(*)::double AS value FROM r GROUP BY status
UNION ALL SELECT 'slowest_endpoints', path, (row_number() OVER (ORDER BY avg_ms DESC, p))::int, round(avg_ms, 6) FROM s
UNION ALL SELECT 'top_talkers', ip, (row_number() OVER (ORDER BY n DESC, p))::int, n FROM k
UNION ALL SELECT 'total_requests', '', NULL, total_requests FROM o
UNION ALL SELECT 'malformed_lines', '', NULL, malformed_lines FROM o
UNION ALL SELECT 'error_rate_pct', '', NULL, error_rate_pct FROM o
UNION ALL SELECT 'slow_requests', '', NULL, slow_requests FROM o""",
        _LOG,
        **_PARSED,
        s=_SLOWEST,
        k=_TALKERS,
        o=_SUMMARY,
    ),
)
def log_report(t: Tables):
    return logs.log_report(_parsed(t), "pos").withColumn("value", F.round("value", 6))


# -- chunking ---------------------------------------------------------------


def _sentence_list(text: str) -> str:
    marked = f"regexp_replace({s_strip(text)}, '([.!?])[{WS_CLASS}]+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda x: {s_strip('x')}), lambda x: x <> '')"


_PARAGRAPHS = (
    f"list_filter(list_transform(string_split_regex(text, '{PARAGRAPH_REGEX}'), lambda x: {s_strip('x')}), lambda x: x <> '')"
)


@plan(
    "chunk_sentences",
    sql(
        "SELECT doc_id, (unnest(range(len(l))))::int AS pos, unnest(l) AS unit FROM x",
        x=f"SELECT doc_id, {_sentence_list('text')} AS l FROM documents",
    ),
)
def chunk_sentences(t: Tables):
    return chunk.sentence_rows(t["documents"], ["doc_id"])


@plan(
    "chunk_units",
    sql(
        "SELECT doc_id, (unnest(range(len(l))))::int AS pos, unnest(l) AS unit FROM x",
        ("v_paragraphs",),
        x=f"""SELECT doc_id, flatten(list_transform({_PARAGRAPHS}, lambda p: {_sentence_list('p')})) AS l
FROM v_paragraphs""",
    ),
)
def chunk_units(t: Tables):
    return chunk.unit_rows(t["v_paragraphs"], ["doc_id"])


SIZE, OVERLAP, FLOOR = 60, 10, 40
_STEP = SIZE - OVERLAP


def _chunk_sql(view: str) -> str:
    return sql(
        """SELECT c.doc_id, c.k::int AS index, string_agg(w.w, ' ' ORDER BY w.i) AS text, count(*)::int AS word_count,
  any_value(c.start_word)::int AS start_word, any_value(c.end_word)::int AS end_word,
  any_value(greatest(0, c.next_start - c.end_word))::int AS gap_words
FROM c JOIN w ON w.doc_id = c.doc_id AND w.i >= c.start_word AND w.i < c.end_word GROUP BY c.doc_id, c.k""",
        ("v_paragraphs",) if view == "v_paragraphs" else (),
        p=f"SELECT doc_id, unnest(range(len(l))) AS pno, unnest(l) AS p FROM (SELECT doc_id, {_PARAGRAPHS} AS l FROM {view})",
        x=f"""SELECT doc_id, pno, unnest(range(len(l))) AS wno, unnest(l) AS w, len(l) AS len
FROM (SELECT doc_id, pno, list_filter(string_split_regex(p, {GAP}), lambda y: y <> '') AS l FROM p)""",
        w="""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pno, wno) - 1 AS i, w,
  (right(w, 1) IN ('.', '!', '?') OR wno = len - 1) AS closes FROM x""",
        d="SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id",
        b=f"""SELECT doc_id, n, k, k * {_STEP} AS start_word, least(k * {_STEP} + {SIZE}, n) AS hard,
  CASE WHEN k = last THEN n ELSE (k + 1) * {_STEP} END AS next_start
FROM (SELECT doc_id, n, last, unnest(range(last + 1)) AS k
      FROM (SELECT doc_id, n, greatest(0, ceil((n - {SIZE}) / {_STEP}.0))::bigint AS last FROM d))""",
        c=f"""SELECT b.doc_id, b.k, b.start_word, b.next_start, coalesce(max(w.i) + 1, b.hard) AS end_word
FROM b LEFT JOIN w ON w.doc_id = b.doc_id AND w.closes AND w.i >= b.start_word + {FLOOR} AND w.i < b.hard
GROUP BY b.doc_id, b.k, b.start_word, b.next_start, b.hard""",
    )


@plan("chunk_windows", _chunk_sql("documents"))
def chunk_windows(t: Tables):
    return chunk.chunk_documents(t["documents"], ["doc_id"], chunk_size=SIZE, overlap=OVERLAP)


@plan("chunk_windows_paragraphs", _chunk_sql("v_paragraphs"))
def chunk_windows_paragraphs(t: Tables):
    return chunk.chunk_documents(t["v_paragraphs"], ["doc_id"], chunk_size=SIZE, overlap=OVERLAP)


@plan("chunk_long", _chunk_sql("v_paragraphs"))
def chunk_long(t: Tables):
    """The same without a document's words in one row."""
    return chunk.chunk_long_documents(t["v_paragraphs"], ["doc_id"], chunk_size=SIZE, overlap=OVERLAP)


# -- CSV wrangling ----------------------------------------------------------

# The columns of the table that is wrangled.
REQUIRED = ("member_id", "age", "monthly_premium")
CELLS = ("member_id", "name", "age", "monthly_premium")
_CSV = ("v_csv_cells",)
_GOOD = " AND ".join(f"{s_norm(c)} <> ''" for c in REQUIRED)


def _kind(c: str) -> str:
    return (
        f"CASE WHEN {s_norm(c)} = '' THEN NULL WHEN ({s_long_int(c)}) IS NOT NULL THEN 'int' "
        f"WHEN NOT {s_is_whole(c)} AND isfinite({s_float(c)}) THEN 'float' ELSE 'string' END"
    )


def _text(c: str) -> str:
    return (
        f"CASE WHEN {s_norm(c)} = '' THEN NULL WHEN ({s_long_int(c)}) IS NOT NULL THEN ({s_long_int(c)})::varchar "
        f"WHEN NOT {s_is_whole(c)} AND isfinite({s_float(c)}) THEN ({s_float(c)})::varchar ELSE {s_strip(c)} END"
    )


_CLEAN_COLUMNS = ", ".join(f"{_kind(c)} AS {c}_kind, {_text(c)} AS {c}" for c in CELLS)


def clean_sql(key: str) -> str:
    """Clean rows as text under a key expression."""
    cells = ", ".join(f"{_text(c)} AS {c}" for c in CELLS)
    return f"SELECT {key}, {cells} FROM v_csv_cells WHERE {_GOOD}"


@plan("wr_clean", sql(f"SELECT lineno, {_CLEAN_COLUMNS} FROM v_csv_cells WHERE {_GOOD}", _CSV))
def wr_clean(t: Tables):
    clean, _ = wrangle.wrangle(t["v_csv_cells"], REQUIRED)
    kinds = [coerce_kind(field(c).cast("string")).alias(f"{c}_kind") for c in CELLS]
    return clean.select("lineno", *kinds, *[field(c).cast("string").alias(c) for c in CELLS])


_MISSING = "array_to_string(list_filter([{}], lambda x: x IS NOT NULL), ', ')".format(
    ", ".join(f"CASE WHEN {s_norm(c)} = '' THEN '{c}' END" for c in REQUIRED)
)


@plan(
    "wr_rejects",
    sql(
        f"SELECT lineno, 'line ' || lineno || ': missing ' || {_MISSING} || ' -> skipped' AS message "
        f"FROM v_csv_cells WHERE NOT ({_GOOD})",
        _CSV,
    ),
)
def wr_rejects(t: Tables):
    return wrangle.wrangle(t["v_csv_cells"], REQUIRED)[1]


def _json(c: str) -> str:
    quoted = f"'\"' || {_text(c)} || '\"'"
    return f"coalesce(CASE WHEN {_kind(c)} = 'string' THEN {quoted} ELSE {_text(c)} END, 'null')"


_OBJECT = " || ',' || ".join(f"'\"{c}\":' || {_json(c)}" for c in sorted(CELLS))


@plan("wr_json", sql(f"SELECT lineno, '{{' || {_OBJECT} || '}}' AS value FROM v_csv_cells WHERE {_GOOD}", _CSV))
def wr_json(t: Tables):
    clean, _ = wrangle.wrangle(t["v_csv_cells"], REQUIRED)
    return clean.select("lineno", json_text(clean, exclude=["lineno"]).alias("value"))


# -- forecast grids ---------------------------------------------------------

_FC = ("v_forecast_lines",)
_CODES = ", ".join(f"'{c}'" for c in SKY)
_LEGEND = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SKY.items())


def _cell_sql(token: str, tag: str) -> str:
    c = f"string_split(lower({token}), '/')"
    shaped = f"regexp_full_match(lower({token}), '{FORECAST_CELL}')"
    return f"""CASE WHEN {shaped} THEN {c}[1]::int END AS {tag}_hi, CASE WHEN {shaped} THEN {c}[2]::int END AS {tag}_lo,
CASE WHEN {shaped} THEN {c}[3] END AS {tag}_sky"""


_GRID = {
    "w": f"""SELECT pos, {s_strip('line')} AS raw, list_filter(string_split_regex({s_strip('line')}, {GAP}), lambda x: x <> '') AS tk
FROM v_forecast_lines WHERE {s_norm('line')} <> ''""",
    "c": f"SELECT pos, raw, tk, {_cell_sql('tk[-2]', 'today')}, {_cell_sql('tk[-1]', 'next')} FROM w",
    "g": f"""SELECT *, coalesce(len(tk) >= 3 AND today_sky IN ({_CODES}) AND next_sky IN ({_CODES})
  AND today_lo <= today_hi AND next_lo <= next_hi, false) AS ok FROM c""",
    "r": """SELECT pos, array_to_string(tk[1:len(tk) - 2], ' ') AS city, today_hi, today_lo, today_sky, next_hi, next_lo, next_sky,
  today_hi - today_lo AS spread, next_hi - today_hi AS hi_change FROM g WHERE ok""",
}


def _grid(t: Tables):
    return forecast.parse_table(t["v_forecast_lines"])


def _grid_rows(t: Tables):
    return forecast.forecast_rows(_grid(t))


@plan("fc_rows", sql("SELECT * FROM r", _FC, **_GRID))
def fc_rows(t: Tables):
    flat = [F.col(f"{s}.{f}").alias(f"{tag}_{f}") for s, tag in (("today", "today"), ("next_day", "next")) for f in ("hi", "lo", "sky")]
    return _grid_rows(t).select("pos", "city", *flat, "spread", "hi_change")


@plan("fc_rejects", sql("SELECT raw FROM g WHERE NOT ok", _FC, **_GRID))
def fc_rejects(t: Tables):
    return forecast.forecast_rejects(_grid(t))


@plan(
    "fc_summary",
    sql(
        """SELECT count(*) FILTER (WHERE ok) AS parsed, count(*) FILTER (WHERE NOT ok) AS rejected,
round(avg(today_hi) FILTER (WHERE ok), 6) AS avg_hi FROM g""",
        _FC,
        **_GRID,
    ),
)
def fc_summary(t: Tables):
    return forecast.forecast_summary(_grid(t)).withColumn("avg_hi", F.round("avg_hi", 6))


_EXTREMES = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{m}' AS metric, city, {v} AS value FROM r ORDER BY {v} {d}, pos LIMIT 1)"
    for m, v, d in (
        ("hottest", "today_hi", "DESC"), ("coolest", "today_hi", "ASC"), ("widest", "spread", "DESC"),
        ("warming", "hi_change", "DESC"), ("cooling", "hi_change", "ASC"),
    )
)


@plan("fc_extremes", sql(_EXTREMES, _FC, **_GRID))
def fc_extremes(t: Tables):
    return forecast.forecast_extremes(_grid_rows(t), "pos")


@plan("fc_sky", sql(f"SELECT CASE today_sky {_LEGEND} END AS sky, count(*) AS n FROM r GROUP BY 1", _FC, **_GRID))
def fc_sky(t: Tables):
    return forecast.sky_distribution(_grid_rows(t), "pos")


# -- byte costs -------------------------------------------------------------


@plan(
    "bc_cost",
    "SELECT doc_id, strlen(text)::int AS bytes, length(text)::int AS chars, strlen(text) = length(text) AS one_byte FROM documents",
)
def bc_cost(t: Tables):
    return bytecost.byte_costs(t["documents"]).select("doc_id", "bytes", "chars", "one_byte")


_FORMS = {
    "f": "SELECT source AS entity, lang AS market, avg(strlen(text)) AS bytes, min(doc_id) AS p FROM documents GROUP BY source, lang",
    "b": """SELECT f.*, e.bytes AS base_bytes FROM f
LEFT JOIN (SELECT entity, bytes FROM f WHERE market = 'en') e ON e.entity = f.entity""",
}


def _market_costs(t: Tables):
    return bytecost.market_costs(t["documents"], "source", "lang", "en", position="doc_id")


@plan(
    "bc_ratio",
    sql("SELECT entity, market, round(bytes, 6) AS bytes, round(bytes / base_bytes, 6) AS ratio FROM b", **_FORMS),
)
def bc_ratio(t: Tables):
    return _market_costs(t).select("entity", "market", F.round("bytes", 6).alias("bytes"), F.round("ratio", 6).alias("ratio"))


@plan(
    "bc_worst",
    sql(
        """SELECT entity, market, round(bytes, 6) AS bytes, round(bytes / base_bytes, 6) AS ratio,
round((bytes - base_bytes) * 3.0, 6) AS extra_usd
FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY bytes DESC, p) AS rn FROM b) WHERE rn = 1""",
        **_FORMS,
    ),
)
def bc_worst(t: Tables):
    worst = bytecost.worst_markets(_market_costs(t))
    return worst.withColumns({c: F.round(c, 6) for c in ("bytes", "ratio", "extra_usd")})


@plan(
    "bc_summary",
    """SELECT count(text) AS measured, count(*) FILTER (WHERE strlen(text) = length(text)) AS one_byte,
count(*) FILTER (WHERE strlen(text) <> length(text)) AS more FROM documents""",
)
def bc_summary(t: Tables):
    return bytecost.byte_summary(t["documents"])
