"""Column expressions that cut text into lines, paragraphs, sentences and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbwright.functions.cells import strip_ws
from plumbwright.functions.fixed import LINE_BREAK, PARAGRAPH_BREAK, SENTENCE_END, WHITESPACE_CLASS

_GAP = rf"(?U)[{WHITESPACE_CLASS}]+"
_BREAK = "(?U)" + PARAGRAPH_BREAK.replace("{ws}", WHITESPACE_CLASS)
# A separator character, so it never occurs inside a word of the text.
PARAGRAPH_MARK = "\x1e"
# Starts only at the first blank of a run: a run without a break is looked at once.
_BREAK_RUN = rf"(?U)(?<![{WHITESPACE_CLASS}])[{WHITESPACE_CLASS}]*\n[{WHITESPACE_CLASS}]*\n"
_UNMARKED_GAP = r"(?U)[\s\x1c\x1d\x1f]+"
_AFTER_END = rf"(?U)(?<={SENTENCE_END})[{WHITESPACE_CLASS}]+"


def _filled(parts: Column) -> Column:
    return F.filter(parts, lambda p: p != "")


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def words(text: Column) -> Column:
    return _filled(F.split(text, _GAP))


def plain_text(text: Column) -> Column:
    """Trimmed text without the mark character, ready for :func:`marked_words`."""
    return F.replace(strip_ws(text), F.lit(PARAGRAPH_MARK), F.lit(" "))


def marked_words(plain: Column) -> Column:
    """Words of a :func:`plain_text`; the last word of a paragraph ends in the mark.

    One split yields the words of all paragraphs: paragraph breaks become marks
    that are not cut at.  Texts without a break skip the rewrite.
    """
    marked = F.regexp_replace(plain, _BREAK_RUN, f"{PARAGRAPH_MARK} ")
    return _filled(F.split(F.when(plain.rlike(_BREAK), marked).otherwise(plain), _UNMARKED_GAP))


# Words in a piece of a long text.
PIECE_WORDS = 256
_PIECE = rf"(?U)(?:[^\s\x1c\x1d\x1f]++[\s\x1c\x1d\x1f]*+){{1,{PIECE_WORDS}}}+"


def marked_pieces(plain: Column) -> Column:
    """The words of :func:`marked_words` in runs of ``PIECE_WORDS`` as texts; the last run may be shorter."""
    marked = F.regexp_replace(plain, _BREAK_RUN, f"{PARAGRAPH_MARK} ")
    return F.regexp_extract_all(F.when(plain.rlike(_BREAK), marked).otherwise(plain), F.lit(_PIECE), F.lit(0))


def piece_words(piece: Column) -> Column:
    return _filled(F.split(piece, _UNMARKED_GAP))


def mark_paragraphs(per_paragraph: Column) -> Column:
    """The same from an array of word arrays."""

    def mark(w: Column) -> Column:
        head = F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
        return F.concat(head, F.transform(F.slice(w, -1, 1), lambda x: F.concat(x, F.lit(PARAGRAPH_MARK))))

    return F.flatten(F.transform(F.filter(per_paragraph, lambda w: F.size(w) > 0), mark))


def paragraphs(text: Column) -> Column:
    return _filled(F.transform(F.split(text, _BREAK), strip_ws))


def sentences(text: Column) -> Column:
    """Sentences with their punctuation; text without any yields one sentence."""
    parts = F.split(strip_ws(text), _AFTER_END)
    return _filled(F.transform(parts, strip_ws))


def units(text: Column) -> Column:
    """Sentences inside paragraphs, in reading order."""
    return F.flatten(F.transform(paragraphs(text), sentences))


def byte_length(text: Column) -> Column:
    """UTF-8 bytes."""
    return F.octet_length(text)
