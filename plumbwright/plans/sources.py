"""Queries: file sources and sinks.

Each query writes a table to the shared folder in a text format, reads it back
through the source under test and reports what it read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field, normalise
from plumbwright.operators import logs, wrangle
from plumbwright.plans.base import Tables, plan, s_norm, sql
from plumbwright.plans.texts import CELLS, REQUIRED, clean_sql, summary_sql
from plumbwright.sources import files
from plumbwright.sources.scratch import new_folder

_CSV = ("v_csv_cells",)
COLUMNS = ("id", *CELLS)


def _csv_folder(t: Tables) -> str:
    folder = new_folder(t.spark, "csv")
    rows = t["v_csv_cells"].withColumnRenamed("lineno", "id").select(*COLUMNS)
    rows.write.options(header=True, quote='"', escape='"', emptyValue="").csv(folder)
    return folder


def _wrangled(t: Tables) -> tuple[DataFrame, DataFrame]:
    return wrangle.wrangle(files.read_csv_records(t.spark, _csv_folder(t), COLUMNS), REQUIRED, irregular="irregular")


@plan(
    "src_csv_cells",
    sql(f"SELECT lineno::varchar AS id, {', '.join(f'{s_norm(c)} AS {c}' for c in CELLS)} FROM v_csv_cells", _CSV),
)
def src_csv_cells(t: Tables):
    raw = files.read_csv_cells(t.spark, _csv_folder(t), COLUMNS)
    return raw.select(*[normalise(field(c)).alias(c) for c in COLUMNS])


# Files of the queries that read ordinals back: a row's file is its key modulo this.
PARTS = 16


def _part_files(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Rows of (part, id, ...) placed so that a part is one file in the order of id, and a folder for them."""
    placed = rows.repartition(PARTS, "part").sortWithinPartitions("part", "id")
    return placed, new_folder(rows.sparkSession, name)


@plan(
    "src_csv_records",
    sql(
        f"""SELECT lineno::varchar AS id, row_number() OVER (PARTITION BY lineno % {PARTS} ORDER BY lineno) + 1 AS lineno,
false AS irregular FROM v_csv_cells""",
        _CSV,
    ),
)
def src_csv_records(t: Tables):
    """Which record has which ordinal: counted per file, after the header."""
    rows = t["v_csv_cells"].withColumnRenamed("lineno", "id").select((F.col("id") % PARTS).alias("part"), *COLUMNS)
    placed, folder = _part_files(rows, "csv")
    placed.write.partitionBy("part").options(header=True, quote='"', escape='"', emptyValue="").csv(folder)
    return files.read_csv_records(t.spark, folder, COLUMNS).select("id", "lineno", "irregular")


# Wide, short and long-quoted records by the key's remainder.
_RAGGED = """CASE CAST(c_custkey % 4 AS int)
  WHEN 0 THEN concat(c_custkey, ',', c_name, ',note,', '"more, ', repeat('x', 2000), '",1')
  WHEN 1 THEN concat(c_custkey, ',', c_name)
  WHEN 2 THEN concat(c_custkey, ',"', c_name, ', ""q"" ', repeat('y', 2000), '",note')
  ELSE concat(c_custkey, ',', c_name, ',note') END"""


@plan(
    "src_csv_ragged",
    sql(
        f"""SELECT c_custkey::varchar AS id, row_number() OVER (PARTITION BY c_custkey % {PARTS} ORDER BY c_custkey) + 1 AS lineno,
c_custkey % 4 = 0 AS irregular, CASE WHEN c_custkey % 4 = 2 THEN c_name || ', "q" ' || repeat('y', 2000) ELSE c_name END AS name,
CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 'note' END AS note FROM customer"""
    ),
)
def src_csv_ragged(t: Tables):
    """Records with more and fewer cells than the header, and long quoted cells."""
    rows = t["customer"].selectExpr(f"c_custkey % {PARTS} AS part", "c_custkey AS id", f"{_RAGGED} AS line")
    header = t.spark.range(PARTS).selectExpr("id AS part", "-1L AS id", "'id,name,note' AS line")
    placed, folder = _part_files(rows.union(header), "ragged")
    placed.drop("id").write.partitionBy("part").text(folder)
    records = files.read_csv_records(t.spark, folder, ["id", "name", "note"])
    return records.withColumns({"name": normalise(F.col("name")), "note": normalise(F.col("note"))})


@plan("src_csv_wrangle", sql(clean_sql("lineno::varchar AS id"), _CSV))
def src_csv_wrangle(t: Tables):
    clean, _ = _wrangled(t)
    return clean.select(F.col("id").cast("string").alias("id"), *[field(c).cast("string").alias(c) for c in CELLS])


@plan("src_json_lines", sql(clean_sql("lineno AS id"), _CSV))
def src_json_lines(t: Tables):
    clean, _ = _wrangled(t)
    folder = new_folder(t.spark, "json")
    files.write_json_lines(clean.drop("lineno"), folder)
    row = F.parse_json("value")
    reloaded = t.spark.read.text(folder)
    return reloaded.select(
        F.variant_get(row, "$.id", "bigint").alias("id"),
        *[F.variant_get(row, f"$.{c}", "variant").cast("string").alias(c) for c in CELLS],
    )


@plan("src_json_round_trip", sql(f"SELECT *, 0::bigint AS differences FROM ({clean_sql('lineno AS id')})", _CSV))
def src_json_round_trip(t: Tables):
    """The reloaded values, and how many rows differ from what was written."""
    clean, _ = wrangle.wrangle(t["v_csv_cells"], REQUIRED)
    folder = new_folder(t.spark, "json")
    files.write_json_lines(clean, folder)
    differ = files.round_trip_differences(clean, folder).agg(F.count(F.lit(1))).scalar()
    row = F.parse_json("value")
    return t.spark.read.text(folder).select(
        F.variant_get(row, "$.lineno", "bigint").alias("id"),
        *[F.variant_get(row, f"$.{c}", "variant").cast("string").alias(c) for c in CELLS],
        differ.alias("differences"),
    )


@plan("src_json_array", sql(f"SELECT *, 0::bigint AS differences FROM ({clean_sql('lineno AS id')})", _CSV))
def src_json_array(t: Tables):
    """The same from one array in several parts."""
    clean, _ = wrangle.wrangle(t["v_csv_cells"], REQUIRED)
    folder = new_folder(t.spark, "json")
    files.write_json_array(clean, folder)
    differ = files.round_trip_differences(clean, folder, array=True).agg(F.count(F.lit(1))).scalar()
    row = F.parse_json("value")
    return files.read_json_array(t.spark, folder).select(
        F.variant_get(row, "$.lineno", "bigint").alias("id"),
        *[F.variant_get(row, f"$.{c}", "variant").cast("string").alias(c) for c in CELLS],
        differ.alias("differences"),
    )


# Files of one folder with their columns in another order, one of them without some, and quoted line breaks.
_ORDERS = (COLUMNS, COLUMNS[::-1], COLUMNS[:3])


@plan(
    "src_csv_orders",
    sql(
        f"""SELECT lineno::varchar AS id, row_number() OVER (PARTITION BY lineno % {len(_ORDERS)} ORDER BY lineno) + 1 AS lineno,
{', '.join(f"CASE WHEN lineno % {len(_ORDERS)} < 2 OR '{c}' IN {_ORDERS[2]} THEN {s_norm(c)} ELSE '' END AS {c}" for c in CELLS)} FROM v_csv_cells""",
        _CSV,
    ),
)
def src_csv_orders(t: Tables):
    """Files keep their own headers; ordinals count in each file."""
    return _ordered_files(t, in_splits=False)


@plan("src_csv_breaks", sql("SELECT id, lineno, note FROM b", b=f"""SELECT c_custkey::varchar AS id,
row_number() OVER (PARTITION BY c_custkey % {PARTS} ORDER BY c_custkey) + 1 AS lineno,
CASE WHEN c_custkey % 3 = 0 THEN 'one' || chr(10) || chr(10) || 'two "' || c_name || '", three' ELSE c_name END AS note FROM customer"""))
def src_csv_breaks(t: Tables):
    """Quoted line breaks read in splits."""
    note = "CASE WHEN c_custkey % 3 = 0 THEN concat('one\\n\\ntwo \"', c_name, '\", three') ELSE c_name END"
    rows = t["customer"].selectExpr(f"c_custkey % {PARTS} AS part", "c_custkey AS id", f"{note} AS note")
    placed, folder = _part_files(rows, "breaks")
    placed.write.partitionBy("part").options(header=True, quote='"', escape='"').csv(folder)
    return files.read_csv_records(t.spark, folder, in_splits=True).select("id", "lineno", "note")


def _ordered_files(t: Tables, in_splits: bool) -> DataFrame:
    rows = t["v_csv_cells"].withColumnRenamed("lineno", "id")
    folder = new_folder(t.spark, "orders")
    for i, names in enumerate(_ORDERS):
        some = rows.filter(F.col("id") % len(_ORDERS) == i).repartition(1).sortWithinPartitions("id")
        some.select(*names).write.mode("append").options(header=True, quote='"', escape='"', emptyValue="").csv(folder)
    records = files.read_csv_records(t.spark, folder, in_splits=in_splits)
    return records.select("id", "lineno", *[normalise(field(c)).alias(c) for c in CELLS])


@plan("src_text_lines", summary_sql())
def src_text_lines(t: Tables):
    folder = new_folder(t.spark, "lines")
    t["v_log_lines"].select("line").write.text(folder)
    return logs.traffic_summary(logs.parse_lines(files.read_lines(t.spark, folder)))


@plan(
    "src_table_lines",
    sql(
        "SELECT doc_id, unnest(range(len(l)))::int AS pos, unnest(l) AS line FROM x",
        x=r"SELECT doc_id, string_split_regex(text, '\r\n|[\x0a-\x0d\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS l FROM documents",
    ),
)
def src_table_lines(t: Tables):
    return files.table_lines(t["documents"], "text", keep=["doc_id"])
