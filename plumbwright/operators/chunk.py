"""Overlapping word-window chunks of documents.

Chunk k always starts at word k * (size - overlap), so chunks need no running
state: each document yields its chunk array inside one projection, without a
shuffle, and the word array is never copied per chunk.

A window prefers to close after the last sentence end in its final third.  Such
a chunk may close before the next one starts; ``gap_words`` counts the words
that then belong to no chunk, and ``prefer_boundary=False`` avoids it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions import text as T
from plumbwright.functions.cells import field
from plumbwright.functions.fixed import CHUNK_FLOOR, SENTENCE_MARKS


def sentence_rows(df: DataFrame, id_columns: Sequence[str], text: str = "text") -> DataFrame:
    """One row per sentence of the text, with its position."""
    return _rows(df, id_columns, T.sentences(field(text)))


def unit_rows(df: DataFrame, id_columns: Sequence[str], text: str = "text") -> DataFrame:
    """One row per sentence within a paragraph, with its position."""
    return _rows(df, id_columns, T.units(field(text)))


def _rows(df, id_columns, parts: Column) -> DataFrame:
    return df.select(*[field(c) for c in id_columns], F.posexplode(parts).alias("pos", "unit"))


def chunk_documents(
    df: DataFrame,
    id_columns: Sequence[str],
    text: str = "text",
    chunk_size: int = 60,
    overlap: int = 10,
    prefer_boundary: bool = True,
    tokenise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Cut every document into chunks of at most ``chunk_size`` words.

    ``tokenise`` replaces the word split: it maps a column of paragraph arrays
    to arrays of token arrays, for example through a pandas UDF that calls the
    tokenizer of a model.
    """
    _check(chunk_size, overlap)
    step = chunk_size - overlap
    ids = [field(c) for c in id_columns]

    if tokenise is None:
        # A projection of its own, so that the trimmed text is computed once.
        staged = df.select(*ids, T.plain_text(field(text)).alias("_t"))
        staged = staged.select(*ids, T.marked_words(F.col("_t")).alias("_w"))
    else:
        staged = df.select(*ids, tokenise(T.paragraphs(field(text))).alias("_p"))
        staged = staged.select(*ids, T.mark_paragraphs(F.col("_p")).alias("_w"))

    staged = staged.withColumn("_n", F.size("_w"))
    staged = staged.withColumn("_last", _last_chunk(chunk_size, step))
    cut = _Cutter(chunk_size, overlap, prefer_boundary)
    whole = F.lit(0)
    windows = F.transform(F.sequence(F.lit(0), F.col("_last")), lambda k: cut.window(k, whole))
    chunks = F.when(F.col("_n") > 0, F.transform(windows, lambda s: cut.chunk(s, whole)))
    return staged.select(*ids, F.inline(chunks))


def chunk_long_documents(
    df: DataFrame,
    id_columns: Sequence[str],
    text: str = "text",
    chunk_size: int = 60,
    overlap: int = 10,
    prefer_boundary: bool = True,
) -> DataFrame:
    """The chunks of :func:`chunk_documents` for documents whose word arrays are too large for one row.

    A text is cut into pieces of a fixed number of words, so a piece's number
    tells where its words stand.  Each piece sends every chunk that reaches into
    it the words they share; a task then holds single chunks.  One shuffle, which
    carries the overlapping words twice.  A document's text itself is one cell.
    """
    _check(chunk_size, overlap)
    step = chunk_size - overlap
    ids = [field(c) for c in id_columns]
    # The row number keeps documents with equal ids apart.
    plain = df.select(*ids, F.monotonically_increasing_id().alias("_row"), T.plain_text(field(text)).alias("_t"))
    pieces = plain.select(*ids, "_row", F.inline(F.array(F.struct(T.marked_pieces(F.col("_t")).alias("_p")))))
    before = F.lit(T.PIECE_WORDS) * (F.size("_p") - 1)
    counted = pieces.filter(F.size("_p") > 0).withColumn("_n", before + F.size(T.piece_words(F.element_at("_p", -1))))
    counted = counted.withColumn("_last", _last_chunk(chunk_size, step))
    each = counted.select(*ids, "_row", "_n", "_last", F.posexplode("_p").alias("_at", "_piece"))
    each = each.select(*ids, "_row", "_n", "_last", (F.col("_at") * T.PIECE_WORDS).alias("_from"), F.inline(F.array(F.struct(T.piece_words(F.col("_piece")).alias("_words")))))
    upto = F.col("_from") + F.size("_words")
    first = F.greatest(F.lit(0), F.ceil((F.col("_from") - chunk_size + 1) / F.lit(step)).cast("int"))
    final = F.least(F.col("_last"), F.floor((upto - 1) / F.lit(step)).cast("int"))
    met = each.select("*", F.explode(F.when(first <= final, F.sequence(first, final))).alias("_k"))
    low = F.greatest(F.col("_k") * step, F.col("_from"))
    high = F.least(F.col("_k") * step + chunk_size, upto)
    part = F.slice("_words", low - F.col("_from") + 1, high - low)
    shared = met.filter(high > low).select(*ids, "_row", "_n", "_last", "_k", F.struct(low.alias("low"), part.alias("words")).alias("_part"))
    grouped = shared.groupBy(*ids, "_row", "_n", "_last", "_k").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    staged = grouped.select(*ids, "_n", "_last", "_k", F.flatten(F.col("_parts.words")).alias("_w"))
    cut = _Cutter(chunk_size, overlap, prefer_boundary)
    origin = F.col("_k") * step
    chunk = F.inline(F.array(cut.window(F.col("_k"), origin).alias("_s")))
    staged = staged.select(*ids, "_n", "_last", "_w", "_k", chunk).withColumn("_s", F.struct("k", "hard_end", "back"))
    return staged.select(*ids, F.inline(F.array(cut.chunk(F.col("_s"), origin))))


def _last_chunk(chunk_size: int, step: int) -> Column:
    return F.greatest(F.lit(0), F.ceil((F.col("_n") - chunk_size) / F.lit(step)).cast("int"))


class _Cutter:
    """Columns for the chunks of a document's words ``_w``, of which the first is word ``origin``."""

    def __init__(self, chunk_size: int, overlap: int, prefer_boundary: bool):
        self.size, self.step, self.prefer_boundary = chunk_size, chunk_size - overlap, prefer_boundary
        self.floor = max(1, int(chunk_size * CHUNK_FLOOR))

    def window(self, k: Column, origin: Column) -> Column:
        start = k * self.step
        hard_end = F.least(start + self.size, F.col("_n"))
        back = F.lit(0)
        if self.prefer_boundary:
            # Distance of the last sentence end from the window's end, 0 for none.
            tail = F.slice("_w", start - origin + self.floor + 1, F.greatest(hard_end - start - self.floor, F.lit(0)))
            flags = F.reverse(F.transform(tail, _closes_sentence))
            # The end of the text is an end of its last sentence.
            back = F.when(hard_end < F.col("_n"), F.array_position(flags, True).cast("int")).otherwise(0)
        return F.struct(k.alias("k"), hard_end.alias("hard_end"), back.alias("back"))

    def chunk(self, s: Column, origin: Column) -> Column:
        start = s["k"] * self.step
        end = s["hard_end"] - F.greatest(s["back"] - 1, F.lit(0))
        next_start = F.when(s["k"] < F.col("_last"), start + self.step).otherwise(F.col("_n"))
        joined = F.array_join(F.slice("_w", start - origin + 1, end - start), " ")
        return F.struct(
            s["k"].alias("index"),
            F.replace(joined, F.lit(T.PARAGRAPH_MARK), F.lit("")).alias("text"),
            (end - start).alias("word_count"),
            start.alias("start_word"),
            end.alias("end_word"),
            F.greatest(F.lit(0), next_start - end).alias("gap_words"),
        )


def _check(chunk_size: int, overlap: int) -> None:
    if not 0 <= overlap < chunk_size:
        raise ValueError("overlap must be at least 0 and smaller than chunk_size")


def _closes_sentence(word: Column) -> Column:
    """True for a word that ends a sentence or its paragraph."""
    ends = (*SENTENCE_MARKS, T.PARAGRAPH_MARK)
    flags = [F.endswith(word, F.lit(e)) for e in ends]
    return flags[0] | flags[1] | flags[2] | flags[3]
