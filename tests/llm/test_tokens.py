"""Token counts, packing and record files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from plumbwright.llm import packing, records, token_counts, word_ids


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(token_counts.BYTE_FILE)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(word_ids.WORD_FILE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


PIECES = [*"aabcdehilnorst'' ..,!\n\n\t  éñ中　\x85\x1c\u0107ẞİ\U0001f600123\x01", "'re", "'LL", "'s", "the ", " And", "<|endoftext|>",
          "<|startoftext|>", "<|end", "|>", "<|ENDOFTEXT|>", "́", "가"]


def wild(seed, n=300, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_counts_at_every_prefix_equal_the_library(byte_library):
    counter = token_counts.PrefixCounter()
    for text in wild(1):
        counts, at = counter.prefixes(text), 0
        for i, c in enumerate(text):
            at += len(c.encode())
            assert counts[at - 1] == len(ids_of(byte_library, text[: i + 1])), text[: i + 1]


def test_counts_of_documents(sample, byte_library):
    docs, rows = sample
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, limit=50).collect()}
    for doc_id, text, _ in rows:
        r, n = got[doc_id], len(ids_of(byte_library, text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 50)
        assert (list(r["prefix_counts"]) or [0])[-1] == n
        fits = text.encode()[: r["fit_bytes"]].decode()
        assert len(ids_of(byte_library, fits)) <= 50
        # No longer prefix near the border fits.
        for more in range(len(fits) + 1, min(len(text), len(fits) + 30) + 1):
            assert len(ids_of(byte_library, text[:more])) > 50


def test_counts_of_odd_rows(odd, empty, byte_library):
    got = token_counts.token_counts(odd, with_prefixes=False).collect()
    want = sorted((r["doc_id"] or -1, len(ids_of(byte_library, r["text"]))) for r in odd.collect())
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == want
    assert token_counts.token_counts(empty).collect() == []


def test_remembered_units_may_run_out(monkeypatch, byte_library):
    for name in ("REMEMBERED_UNITS", "REMEMBERED_PAIRS"):
        monkeypatch.setattr(token_counts, name, 3)
    counter = token_counts.PrefixCounter()
    for text in wild(2, 60):
        assert (counter.prefixes(text).tolist() or [0])[-1] == len(ids_of(byte_library, text))


@pytest.mark.parametrize("remembered", [400_000, 5])
def test_word_ids_equal_the_library(word_library, remembered):
    encoder = word_ids.WordIds(remembered=remembered)
    texts = wild(3, 400) + [w + " " + w.upper() for w in wild(4, 50, 6)] + ["y" * 300]
    for text, raw in zip(texts, encoder.many([t.encode() for t in texts])):
        assert np.frombuffer(raw, encoder.dtype).tolist() == ids_of(word_library, text), text


def test_word_ids_of_many_strings_equal_the_library(word_library):
    """Small Latin letters, digits and marks in any order, and everything that needs the library."""
    rng = random.Random(8)
    alphabet = "abcdezß éöÿžſıŁ" + "0123²½" + ".,;:!?-_'\"<|>#$%&()*+/=@[]^`{}~" + "ABΣσ\u0301\u0338\u1e9e\n"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(20_000)]
    texts += ["don't", "it's", "<|endoftext|>", "a<|endoftext|>b", "x<|y", "'s", "''", "end.", "a1b2", "\x7f", "a\x01b"]
    encoder = word_ids.WordIds(remembered=4_000)
    assert encoder.cuts_are_known
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        got = [np.frombuffer(raw, encoder.dtype).tolist() for raw in encoder.many([t.encode() for t in some])]
        want = [e.ids for e in word_library.encode_batch(some, add_special_tokens=False)]
        assert got == want, next((t, g, w) for t, g, w in zip(some, got, want) if g != w)


def test_recurring_words_stay_when_a_full_memory_lets_rare_ones_go(monkeypatch, word_library):
    encoder, encoded = word_ids.WordIds(remembered=300), []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda words: encoded.extend(words) or encode(words))
    for at in range(40):
        text = "the often,met word " + " ".join(f"once{at}x{i}" for i in range(30))
        got = np.frombuffer(encoder.many([text.encode()])[0], encoder.dtype).tolist()
        assert got == ids_of(word_library, text)
        assert len(encoder.numbers) <= 300 + 33 and len(encoder.pieces) <= 300
    assert [encoded.count(w) for w in (b"the", b"often,met", b"word")] == [1, 1, 1]


def test_long_texts_are_encoded_a_few_at_a_time(monkeypatch, word_library):
    monkeypatch.setattr(word_ids, "TOGETHER_BYTES", 1_000)
    encoder, calls = word_ids.WordIds(), []
    many = encoder.many
    monkeypatch.setattr(encoder, "many", lambda raws: calls.append(sum(map(len, raws))) or many(raws))
    texts = [f"word{i} " * 40 for i in range(50)] + ["", "end."]
    for text, raw in zip(texts, encoder.each(t.encode() for t in texts), strict=True):
        assert np.frombuffer(raw, encoder.dtype).tolist() == ids_of(word_library, text)
    assert max(calls) < 1_000 + 400 and list(encoder.each([])) == []


def with_end(library, text):
    return np.array([*ids_of(library, text), 1], "<u4")


def check_pieces(rows, texts, library, longest):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids, at = with_end(library, texts[doc_id]), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = ids[at : at + r["length"]].tobytes()
            assert (r["start"], r["doc_tokens"], r["offset"]) == (at, len(ids), 0)
            assert r["length"] <= longest and r["length"].bit_count() == 1
            assert r["ids_crc32"] == zlib.crc32(part) and r["ids"] == part
            at += r["length"]
        assert at == len(ids) and len(pieces) == at // longest + (at % longest).bit_count()
    numbers = [r["sequence_id"] for r in rows]
    assert len(set(numbers)) == len(numbers)
    for length in {r["length"] for r in rows}:
        bucket = sorted(r["bucket_index"] for r in rows if r["length"] == length)
        assert bucket == list(range(len(bucket)))


@pytest.mark.parametrize("longest", [2048, 64])
def test_pieces_are_powers_of_two(make, sample, word_library, longest):
    rows = [(i, t) for i, t, _ in sample[1]][:60] + [(500, None), (501, ""), (502, "a " * 5000)]
    got = packing.pack(make(rows), longest=longest).collect()
    check_pieces(got, dict(rows), word_library, longest)


def test_packing_odd_rows(odd, empty):
    got = packing.pack(odd, with_ids=False)
    assert got.filter("doc_id is null").count() > 0
    assert got.agg({"length": "sum"}).first()[0] == sum(
        r["doc_tokens"] for r in got.filter("start = 0").collect()
    )
    assert got.filter("doc_id = 1").select("length").first()[0] == 1
    assert packing.pack(empty).collect() == []
    with pytest.raises(ValueError):
        packing.pack(odd, longest=100)


def crc_slow(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    assert crc_slow(b"123456789") == 0xE3069283  # the check value of the published code
    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in (4, 5, 63, 64, 65, 66, 67, 68, 128, 129, 1000, 4097)]
    assert records.crc32c_many(parts).tolist() == list(map(crc_slow, parts))


def test_records_round_trip(make, sample, word_library, tmp_path):
    rows = [(i, t) for i, t, _ in sample[1]][:80] + [(-5, None), (900, "")]
    written = records.write_records(make(rows), folder=str(tmp_path / "r"), per_file=10)
    got = records.read_records(written).collect()
    start = 0
    for (doc_id, text), r in zip(sorted(rows), sorted(got, key=lambda r: (r["start"], r["doc_id"])), strict=True):
        ids = with_end(word_library, text)
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc_id, start, len(ids))
        assert r["ids"] == ids.tobytes() and r["ids_crc32"] == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert written.index.select("path").distinct().count() > 5
    # The index reads single records, in another order than that of the files.
    places = written.index.filter("doc_id % 7 = 3").orderBy("n_tokens", "doc_id")
    found = records.read_places(written, places).collect()
    assert [r["doc_id"] for r in found] == [r["doc_id"] for r in places.collect()]
    assert all(r["ids"] == with_end(word_library, dict(rows)[r["doc_id"]]).tobytes() for r in found)


@pytest.mark.parametrize("where", [3, 9, 40, -2, "cut"])
def test_damaged_files_are_noticed(make, tmp_path, where):
    written = records.write_records(make([(1, "some words of a text here"), (2, "b")], 1), folder=str(tmp_path / "r"))
    path = tmp_path / "r" / "part-0000000.rec"
    raw = bytearray(path.read_bytes())
    if where == "cut":
        raw = raw[:-3]
    else:
        raw[where] ^= 4
    path.write_bytes(raw)
    with pytest.raises(Exception, match="DamagedRecord"):
        records.read_records(written).collect()


def test_records_of_odd_rows(odd, empty):
    got = records.read_records(records.write_records(odd, per_file=3), with_ids=False).orderBy("start").collect()
    assert [r["doc_id"] for r in got][:5] == [None, 1, 2, 3, 4] and len(got) == 11
    assert got[1]["n_tokens"] == 1
    assert records.read_records(records.write_records(empty)).collect() == []


@pytest.mark.parametrize("letters", ["aH\u0331b", "T\u0308", "W\u030a x", "Y\u030a", "J\u030c", "H\u05b0\u0331 And THE <b>"])
def test_capitals_before_marks_that_join_small_letters_only(word_library, letters):
    encoder = word_ids.WordIds()
    for text in (letters, "Plain WORDS " + letters, letters.lower()):
        got = np.frombuffer(encoder.many([text.encode()])[0], encoder.dtype).tolist()
        assert got == ids_of(word_library, text)
