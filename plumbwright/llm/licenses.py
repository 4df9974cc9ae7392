"""Licence scan by ordered signature rules, in column expressions only.

Texts become words (lower case, letters and digits).  Keywords are looked up
among a text's words first; only texts with a keyword are put together again and
joined with the rules of their keywords, a list of fixed size.  A rule that
matches gives intervals of words.  An interval inside another one is
suppressed, equal intervals go to the better rule, and of neighbours that
overlap the one with the worse priority goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbwright.functions.cells import field
from plumbwright.llm.license_rules import BASE_SCORE, Rule, rules, spaced
from plumbwright.sources.scratch import write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LICENCE_WORDS = ("license", "licence")


def _once(**columns: Column) -> Column:
    """Compute columns once: a generator is not merged into the expressions above it."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def _spoken(c: Column) -> Column:
    """Number of words in a piece of spaced text, where each word has a blank on either side."""
    return ((F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("long")


def rule_values() -> str:
    """The rules as rows of SQL literals, with spaced patterns."""

    def literal(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower()

    return ", ".join(f"({', '.join(map(literal, r._replace(pattern=spaced(r.pattern))))})" for r in rules())


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as a table of fixed size."""
    rows = spark.sql(f"SELECT * FROM VALUES {rule_values()} AS t({', '.join(Rule._fields)})")
    return rows.withColumn("score", F.col("score").cast("double"))


def prepare(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A stored table of row, the kept columns, n_words, keys (keywords found) and body (spaced words; NULL without keys).

    ``row`` tells rows apart, whatever their ids.
    """
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules()} | set(LICENCE_WORDS))])
    words = F.filter(F.split(F.translate(F.coalesce(field(text), F.lit("")), UPPER, LOWER), NO_WORD), lambda w: w != "")
    cut = docs.select(F.monotonically_increasing_id().alias("_row"), *[field(k).alias(k) for k in keep], _once(_words=words))
    cut = cut.select("*", _once(_keys=F.array_intersect("_words", keywords)))
    body = F.when(F.size("_keys") > 0, F.concat(F.lit(" "), F.array_join("_words", "  "), F.lit(" ")))
    licence = F.arrays_overlap("_keys", F.array(*map(F.lit, LICENCE_WORDS)))
    table = cut.select(
        F.col("_row").alias("row"), *keep, F.size("_words").cast("long").alias("n_words"), F.col("_keys").alias("keys"),
        licence.alias("licence"), body.alias("body"),
    )
    return write_table(table, "licence-words")


def places(prepared: DataFrame) -> DataFrame:
    """Every match: row, start and end (words, end exclusive), number, priority, label, score, base.

    Texts meet the rules of their keywords only.  Starts are sums over the pieces
    between matches, in a window over one rule's matches in one text.
    """
    table = rule_table(prepared.sparkSession)
    some = prepared.filter(F.col("body").isNotNull())
    met = some.select("row", "body", F.col("licence").alias("_said"), F.explode("keys").alias("keyword"))
    # The rules are a list of fixed size.
    met = met.join(F.broadcast(table), "keyword").filter((F.col("_said") | ~F.col("licence")) & F.expr("body RLIKE pattern"))
    parts = met.select("row", "number", "priority", "label", "score", "base", _once(
        pieces=F.expr("split(body, pattern)"), hits=F.expr("regexp_extract_all(body, pattern, 0)")))
    sizes = F.arrays_zip(
        F.transform(F.slice("pieces", 1, F.size("hits")), _spoken).alias("before"), F.transform("hits", _spoken).alias("length")
    )
    each = parts.select(*[c for c in parts.columns if c not in ("pieces", "hits")], F.posexplode(sizes).alias("at", "s"))
    upto = Window.partitionBy("row", "number").orderBy("at")
    end = F.sum(F.col("s.before") + F.col("s.length")).over(upto)
    return each.select("*", end.alias("end")).select(
        "row", (F.col("end") - F.col("s.length")).alias("start"), "end", "number", "priority", "label", "score", "base"
    )


def detections(found: DataFrame) -> DataFrame:
    """The matches of signature rules that no other one suppresses, with their labels."""
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "priority", "number")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    outer = found.filter(~F.col("base")).select("*", reach.alias("_reach"))
    outer = outer.filter(F.col("_reach").isNull() | (F.col("_reach") < F.col("end")))
    # What is left begins and ends in the same order; a neighbour may still overlap.
    line = Window.partitionBy("row").orderBy("start")
    before = (F.lag("end").over(line) > F.col("start")) & (F.lag("priority").over(line) < F.col("priority"))
    after = (F.lead("start").over(line) < F.col("end")) & (F.lead("priority").over(line) < F.col("priority"))
    no = F.lit(False)
    beaten = F.coalesce(before, no) | F.coalesce(after, no)
    return (
        outer.select("*", beaten.alias("_beaten"))
        .filter(~F.col("_beaten") & F.col("label").isNotNull())
        .select("row", "start", "end", "number", "label", "score")
    )


def license_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per detection: doc_id, start and length in words, label, score."""
    prepared = prepare(docs, text)
    kept = detections(places(prepared)).join(prepared.select("row", "doc_id"), "row")
    return kept.select("doc_id", "start", (F.col("end") - F.col("start")).alias("length"), "label", "score")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Licence labels of every document.

    Returns doc_id, n_words, n_base (places of the base phrases), first_word and
    last_word (the smallest and largest start of these), base_labels, labels
    (those of the base phrases and of the detections; distinct, sorted, joined by
    commas) and score (the best score of a label, 0 without labels).

    Defined cases: NULL and empty texts have no words and no labels; a NULL
    doc_id stays NULL; repeated rows are returned once each; an empty table gives
    no rows; other columns are ignored.  A match never crosses documents; matches
    of one rule do not overlap each other.
    """
    prepared = prepare(docs, text)
    # Both aggregates below read the matches.
    found = write_table(places(prepared), "licence-places")
    labels = F.sort_array(F.collect_set("label"))
    base = found.filter("base").groupBy("row").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        labels.alias("_base"), F.lit(None).cast("array<string>").alias("_more"), F.lit(BASE_SCORE).alias("_score"),
    )
    none = F.lit(None).cast("long")
    more = detections(found).groupBy("row").agg(
        none.alias("n_base"), none.alias("first_word"), none.alias("last_word"),
        F.lit(None).cast("array<string>").alias("_base"), labels.alias("_more"), F.max("score").alias("_score"),
    )
    both = base.unionByName(more).groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("n_base", "first_word", "last_word", "_base", "_more", "_score")]
    )
    out = prepared.select("row", "doc_id", "n_words").join(both, "row", "left")
    empty = F.array().cast("array<string>")
    mine, others = F.coalesce("_base", empty), F.coalesce("_more", empty)
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.array_join(mine, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(mine, others)), ",").alias("labels"),
        F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
