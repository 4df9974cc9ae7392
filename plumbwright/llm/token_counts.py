"""Exact token counts at every prefix of a text, for byte-level BPE vocabularies.

The encoding of a prefix is the encoding of a shorter prefix and one last token,
so a table of last tokens, filled byte by byte, holds the count at every prefix.
A token may end at a byte if its own encoding and its pairing with the last
token before it survive the merges; exactly one such token exists.

Texts are cut into units (white space and the following word).  Counts of a unit
don't depend on its neighbours, so each distinct unit is computed once and a
text's counts are the running sum of its units' steps.  Questions about
truncation and budgets are then look-ups, without encoding again.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from operator import sub

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.llm.common import Rows, arrow_schema, raw_texts, texts

BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")

# Distinct units that a worker remembers before it starts afresh; bounds its memory.
REMEMBERED_UNITS = 700_000
REMEMBERED_PAIRS = 1_000_000
LONGEST_REMEMBERED = 64

# Unicode white space, and the split of byte-level vocabularies.
_WHITE = r"\t-\r \x85\xa0  -     　"
_WHITE_SET = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{_WHITE}]", c))
_UNIT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+")
_LONG_CONTRACTIONS = {"'re", "'ve", "'ll"}
_PLAIN = re.compile("[\x00-ɏ]*")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabulary files write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


def _steps(raw: bytes, counts: list[int]) -> bytes:
    """Changes between counts from 0 bytes on; inside a character the count stays."""
    if raw.isascii():
        return array("h", map(sub, counts[1:], counts)).tobytes()
    out, before = array("h"), 0
    for n, following in zip(counts[1:], [*raw[1:], 0]):
        if following & 0xC0 == 0x80:
            n = before
        out.append(n - before)
        before = n
    return out.tobytes()


class PrefixCounter:
    """Token counts at all prefixes, as the tokenizers library would give for each."""

    def __init__(self, path: str = BYTE_FILE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        # Tokens by the order of their merges: bytes first.
        self.token = {bytes([b]): b for b in range(256)}
        self.parts = [(b, b) for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            a, b = (raw(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            number = len(self.parts)
            if self.token.setdefault(a + b, number) != number:
                raise ValueError(f"two merges give {a + b!r}")
            self.parts.append((self.token[a], self.token[b]))
            self.merged[self.parts[-1]] = number
        self.ends = ahocorasick.Automaton()
        for t, number in self.token.items():
            self.ends.add_word(t.decode("latin-1"), (number, len(t)))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.whole: dict[bytes, bool] = {}
        self.units: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special_split = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens, side by side, never join across their border."""
        parts, merged = self.parts, self.merged
        before = len(parts)
        while True:
            # What touches the border now would have joined if its merge came earlier.
            joined = merged.get((left, right))
            if joined is not None and joined < before:
                return False
            # Undo the later merge; of equal ones, the right one is done last.
            if left > right or right < 256:
                if left < 256:
                    return True
                before, left = left, parts[left][1]
            else:
                before, right = right + 1, parts[right][0]

    def _pair(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stays_apart(left, right)
        return known

    def _survives(self, raw: bytes) -> bool:
        """Whether a token's bytes alone are encoded as that token."""
        known = self.whole.get(raw)
        if known is None:
            a, b = self.parts[self.token[raw]]
            known = a == b and len(raw) == 1 or self._survives_split(raw, a, b)
            self.whole[raw] = known
        return known

    def _survives_split(self, raw: bytes, a: int, b: int) -> bool:
        symbols = list(raw)
        while len(symbols) > 1:
            ranks = [self.merged.get(p, len(self.parts)) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == len(self.parts):
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and self.merged.get((symbols[i], symbols[i + 1])) == best:
                    out.append(best)
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols == [self.token[raw]]

    def _counts(self, raw: bytes) -> list[int]:
        """Counts at every byte prefix of one word of the split, from 0 bytes on."""
        pairs, last, counts, done = self.pairs, [0], [0], 0
        # Tokens that end at each byte, the longest first.
        for at, (t, size) in self.ends.iter(raw.decode("latin-1")):
            if at < done:
                continue
            start = at + 1 - size
            if start:
                key = last[start] << 32 | t
                fits = pairs[key] if key in pairs else self._pair(last[start], t)
            else:
                fits = self._survives(raw[:size])
            if fits:
                last.append(t)
                counts.append(counts[start] + 1)
                done = at + 1
        return counts

    def word(self, word: str) -> bytes:
        """Steps of the count (16-bit) at every byte of one word of the split."""
        known = self.words.get(word)
        if known is None:
            raw = word.encode()
            counts = self._counts(raw)
            if word in _LONG_CONTRACTIONS:
                # A prefix that ends inside is an apostrophe and a letter: two words.
                counts[2] = counts[1] + 1
            known = _steps(raw, counts)
            if len(word) <= LONGEST_REMEMBERED:
                if len(self.words) >= REMEMBERED_UNITS:
                    self.words.clear()
                self.words[word] = known
        return known

    def _unit(self, unit: str) -> bytes:
        body = unit.lstrip(_WHITE_SET)
        white = unit[: len(unit) - len(body)]
        if not body:
            return self.word(white)
        words = _WORD.findall((" " if white.endswith(" ") else "") + body)
        if len(white) <= 1:
            return b"".join(map(self.word, words if white in ("", " ") else [white, *words]))
        # A prefix that ends in white space has it all as one word; with the word
        # that follows, the last character goes to that word or stands alone.
        steps = array("h", self.word(white))
        first = array("h", self.word(words[0] if white.endswith(" ") else white[-1]))
        before = sum(array("h", self.word(white[:-1])))
        if white.endswith(" "):
            own = before + first[0]
            rest = first[1:]
        else:
            own = before + sum(first)
            rest = array("h", self.word(words[0]))
        rest[0] += own - sum(steps)
        return b"".join([steps.tobytes(), rest.tobytes(), *map(self.word, words[1:])])

    def steps(self, unit: str) -> bytes:
        """Changes of the count (16-bit) at every byte of a unit, the whole change at a character's last byte."""
        known = self.units.get(unit)
        if known is None:
            known = self._unit(unit)
            if not _PLAIN.fullmatch(unit) and sum(array("h", known)) != self._library(unit):
                # A character that the two Unicode tables class differently.
                counts = [0]
                for i, c in enumerate(unit):
                    counts += [counts[-1]] * (len(c.encode()) - 1) + [self._library(unit[: i + 1])]
                known = _steps(unit.encode(), counts)
            if len(unit) <= LONGEST_REMEMBERED:
                if len(self.units) >= REMEMBERED_UNITS:
                    self.units.clear()
                self.units[unit] = known
        return known

    def _library(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def _segment(self, text: str) -> list[bytes]:
        units = _UNIT.findall(text)
        known = list(map(self.units.get, units))
        if None in known:
            known = [self.steps(u) if k is None else k for u, k in zip(units, known)]
        return known

    def prefixes(self, text: str) -> np.ndarray:
        """The count at every byte prefix from 1 byte on; inside a character, that of the characters before."""
        if self.special_split is None or not any(s in text for s in self.special):
            steps = self._segment(text)
        else:
            steps = self._with_specials(text)
        return np.cumsum(np.frombuffer(b"".join(steps), "<i2"), dtype=np.int64)

    def _with_specials(self, text: str) -> list[bytes]:
        steps, at = [], 0
        for found in self.special_split.finditer(text):
            segment = text[at : found.start()]
            steps += self._segment(segment)
            # Inside the special string a prefix ends in ordinary text, which joins the last unit.
            units = _UNIT.findall(segment)
            tail = units[-1] if units else ""
            own = self._total(tail)
            counts = [self._total(tail + found[0][:k]) - own for k in range(1, len(found[0]))] + [1]
            ends = [0]
            for c, n in zip(found[0], counts):
                ends += [ends[-1]] * (len(c.encode()) - 1) + [n]
            steps.append(_steps(found[0].encode(), ends))
            at = found.end()
        return steps + self._segment(text[at:])

    def _total(self, unit: str) -> int:
        return sum(array("h", self.steps(unit)))


def fitting_bytes(raw: bytes, counts: np.ndarray, limit: int) -> int:
    """Bytes of the longest prefix, in whole characters, with at most ``limit`` tokens."""
    # A count may fall again, so the last fitting prefix counts, not the first that doesn't fit.
    fits = np.flatnonzero(counts <= limit)
    for p in fits[::-1]:
        end = int(p) + 1
        if end == len(raw) or raw[end] & 0xC0 != 0x80:
            return end
    return 0


_counters: dict[str, PrefixCounter] = {}


def prefix_counter(path: str = BYTE_FILE) -> PrefixCounter:
    """The worker's counter for a file; its remembered units outlive a task."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _counting(path: str, limit: int, with_prefixes: bool):
    fields = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64(), "fit_bytes": pa.int64()}
    schema = arrow_schema(fields | ({"prefix_counts": pa.list_(pa.int32())} if with_prefixes else {}))

    def run(batches):
        counter, rows = prefix_counter(path), Rows(schema)
        for batch in batches:
            for key, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                counts = counter.prefixes(raw.decode())
                n = int(counts[-1]) if len(counts) else 0
                more = [counts.astype(np.int32)] if with_prefixes else []
                rows.add(key, len(raw), n, fitting_bytes(raw, counts, limit), *more, size=4 * len(raw) * with_prefixes)
                yield from rows.take()
        yield from rows.take(last=True)

    return run


def token_counts(
    docs: DataFrame, path: str = BYTE_FILE, limit: int = 1024, with_prefixes: bool = True
) -> DataFrame:
    """Exact token counts of whole texts and of all their prefixes.

    Returns doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens),
    fit_bytes (the longest prefix within the limit) and, unless
    ``with_prefixes`` is false, prefix_counts: an array whose element k is the
    count of the first k + 1 bytes.

    Defined cases: NULL and empty texts have 0 bytes and 0 tokens; a NULL doc_id
    stays NULL; repeated rows give a row each; special strings inside texts are
    one token, as the library has it; an empty table gives no rows; other
    columns are ignored.
    """
    kind = "doc_id long, n_bytes long, n_tokens long, fit_bytes long"
    kind += ", prefix_counts array<int>" if with_prefixes else ""
    counted = texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        _counting(path, limit, with_prefixes), kind
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
