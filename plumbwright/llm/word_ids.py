"""Token ids of whole texts, word by word.

For a vocabulary that drops white space (its pieces never reach across it), the
ids of a text are the ids of its white-space-separated words in order.  Every
distinct word gets a number when it is first seen and is encoded once; texts are
then gathered from the words' ids as arrays.  Most words of a large corpus occur
once, so a full memory lets those go that no later texts had.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")

# Distinct words that a worker remembers before it lets some go, and as many pieces of words; bounds its memory.
REMEMBERED_WORDS = 350_000
# Longer words are encoded each time they occur.
LONGEST_REMEMBERED = 64
# A control character that stands as a word of its own between words of one call.
_MARK = "\x01"
# Words in one call of the library.
_CALL = 64
# Texts, and bytes of them, that are encoded together; their words and ids are in memory at once.
TOGETHER, TOGETHER_BYTES = 256, 1 << 20
# The vocabulary composes (NFC) before it lower-cases, and some marks compose with a
# small letter only.  A mark can only join the letter right before it.
_OPEN_CAPITAL = re.compile(rb"[A-Z][\x80-\xff]")
# How a vocabulary cuts texts whose pieces are runs of letters, runs of marks and digits.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Pieces of plain words: small Latin letters, which neither composing nor lower-casing
# changes, ASCII digits, and ASCII marks but for the apostrophe.
_PLAIN_PIECE = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_PLAIN = re.compile(f"(?:{_PLAIN_PIECE.pattern})+")


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


_BYTE_LETTERS = _byte_letters()


def _spelt(raw: bytes) -> list[bytes]:
    """The words of a text, lower-cased where that can't change their ids, so that spellings share an entry."""
    if b"<|" in raw:
        # Special strings are case-sensitive.
        return raw.split()
    if raw.isascii() or not _OPEN_CAPITAL.search(raw):
        return raw.lower().split()
    return [w.lower() if w.isascii() else w for w in raw.split()]


class _Numbers(dict):
    """Words by number; an unknown word gets the next one and waits in ``fresh``."""

    def __init__(self):
        self.fresh: list[bytes] = []
        self.count = 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.count
        self.count += 1
        self.fresh.append(word)
        return number


def _gathered(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of these beginnings and sizes, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class WordIds:
    """Encodes texts with a tokenizers file whose pieces never hold white space."""

    def __init__(self, path: str = WORD_FILE, remembered: int = REMEMBERED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.remembered = remembered
        mark = self.library.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        told = json.loads(self.library.to_str())
        cut = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.cuts_are_known = (
            (told["normalizer"] or {}).get("normalizers") == _NORMALIZER
            and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
            and cut[0]["pattern"] == {"Regex": _PIECES}
            and not cut[1]["add_prefix_space"]
            and not cut[1]["use_regex"]
        )
        self.pieces: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        # Ids of all known words one after another, and by number where a word's ids begin and how many they are.
        self.flat, self.used = np.empty(1 << 16, self.dtype), 0
        self.first, self.size, self.learnt = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), 0
        # By number: has a later call had the word again?
        self.again = np.zeros(1 << 12, bool)

    def _forget_rare(self) -> None:
        """Keep the words that occurred again, if they leave room for others."""
        kept = [(w, n) for w, n in self.numbers.items() if self.again[n]]
        flat, first, size = self.flat, self.first, self.size
        self._forget()
        if len(kept) > self.remembered // 2:
            return
        some = np.array([n for _, n in kept], np.int64)
        for w, _ in kept:
            self.numbers[w]
        self.numbers.fresh = []
        self._store(_gathered(flat, first[some], size[some]), size[some])

    def _store(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add words of the next numbers: their ids one after another and how many each has."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.learnt + len(sizes) > len(self.first):
            self.first = np.concatenate([self.first, np.empty_like(self.first)])
            self.size = np.concatenate([self.size, np.empty_like(self.size)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        upto = slice(self.learnt, self.learnt + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[upto], self.size[upto] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.learnt = self.used + len(ids), upto.stop

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else "".join([_BYTE_LETTERS[b] for b in piece.encode()])
        ids = self._bytes([t.id for t in self.model.tokenize(text)])
        if len(self.pieces) >= self.remembered:
            self.pieces.clear()
        if len(piece) <= LONGEST_REMEMBERED:
            self.pieces[piece] = ids
        return ids

    def _plain(self, word: bytes) -> bytes | None:
        """Ids of a word whose pieces can be told here."""
        text = word.decode()
        if not _PLAIN.fullmatch(text) or "<|" in text or text != text.lower():
            return None
        known = self.pieces.get
        return b"".join([known(piece) or self._piece(piece) for piece in _PLAIN_PIECE.findall(text)])

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words: plain ones by pieces, others by the library, marked words in one call."""
        found: list = [self._plain(w) if self.cuts_are_known else None for w in words]
        together, alone = [], []
        for i, ids in enumerate(found):
            if ids is None:
                (alone if self.mark is None or b"\x01" in words[i] or b"<|" in words[i] else together).append(i)
        calls = [together[i : i + _CALL] for i in range(0, len(together), _CALL)]
        joined = [f" {_MARK} ".join(words[i].decode() for i in c) for c in calls]
        for call, out in zip(calls, self.library.encode_batch_fast(joined, add_special_tokens=False)):
            ids, at = out.ids, 0
            if ids.count(self.mark) != len(call) - 1:
                alone += call
                continue
            for i in call[:-1]:
                end = ids.index(self.mark, at)
                found[i], at = self._bytes(ids[at:end]), end + 1
            found[call[-1]] = self._bytes(ids[at:])
        singles = self.library.encode_batch_fast([words[i].decode() for i in alone], add_special_tokens=False)
        for i, out in zip(alone, singles):
            found[i] = self._bytes(out.ids)
        return found

    def _learn(self) -> None:
        words = self.numbers.fresh
        encoded = self._encode(words)
        sizes = np.array([len(e) for e in encoded], np.int64) // self.dtype.itemsize
        self._store(np.frombuffer(b"".join(encoded), self.dtype), sizes)
        for w in words:
            if len(w) > LONGEST_REMEMBERED:
                del self.numbers[w]
        self.numbers.fresh = []

    def many(self, raws: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text, as many bytes an id as ``dtype`` has."""
        if self.numbers.count > self.remembered:
            self._forget_rare()
        known = self.numbers.count
        split = [_spelt(r) for r in raws]
        counts = np.array([len(words) for words in split], np.int64)
        words = map(self.numbers.__getitem__, chain.from_iterable(split))
        numbers = np.fromiter(words, np.int64, int(counts.sum()))
        if self.numbers.fresh:
            self._learn()
        self.again[numbers[numbers < known]] = True
        sizes = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = _gathered(self.flat, self.first[numbers], sizes)
        cuts = ends[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def each(self, raws: Iterable[bytes]) -> Iterator[bytes]:
        """Little-endian ids of one text after another, some texts encoded together."""
        some, held = [], 0
        for raw in raws:
            some.append(raw)
            held += len(raw)
            if len(some) >= TOGETHER or held >= TOGETHER_BYTES:
                yield from self.many(some)
                some, held = [], 0
        if some:
            yield from self.many(some)


_encoders: dict[str, WordIds] = {}


def word_ids(path: str = WORD_FILE) -> WordIds:
    """The worker's encoder for a file; its remembered words outlive a task."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def id_bytes32(raw: bytes, dtype: np.dtype) -> bytes:
    """The same ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(raw, dtype).astype("<u4").tobytes()
