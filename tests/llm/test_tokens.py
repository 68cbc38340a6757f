import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import sentence_pieces, token_counts, token_files
from orderlens.llm.byte_bpe import byte_bpe
from orderlens.llm.pieces import piece_model
from orderlens.sources.sinks import work_folder

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
CHARACTERS = [*"abcdetheinr'sT12 -.,!|\n\t\r  é中😀▁<>\u00a0\u2003", "<|endoftext|>", "<s>"]
HARD = st.lists(st.sampled_from(CHARACTERS), max_size=40).map("".join)


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(HARD, max_size=6))
def test_byte_bpe_equals_the_library(texts):
    ids, counts = byte_bpe(BYTES).ids(*buffer(texts))
    expected = [byte_bpe(BYTES).tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(expected, []) and counts.tolist() == [len(e) for e in expected]


@settings(max_examples=300, deadline=None)
@given(st.lists(HARD, max_size=6))
def test_pieces_equal_the_library_and_decode(texts):
    ids, offsets = sentence_pieces.ids_of(PIECES, *buffer(texts))
    expected = [LIBRARY.encode(t) for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
    decoded = sentence_pieces.texts_of(piece_model(PIECES), ids, offsets)
    assert [d.decode() for d in decoded] == [LIBRARY.decode(e) for e in expected]


@given(st.integers(1, 31), st.integers(0, 300), st.data())
def test_packed_ids_come_back_from_any_place(bits, count, data):
    ids = np.array([data.draw(st.integers(0, 2**bits - 1)) for _ in range(min(count, 40))] * 3, np.int64)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    first = data.draw(st.integers(0, len(ids)))
    size = data.draw(st.integers(0, len(ids) - first))
    assert token_files.unpack(packed, bits, first, size).tolist() == ids[first : first + size].tolist()


TEXTS = ["Hello there.\nGeneral  Kenobi!", None, "", "x" * 5000, "<|endoftext|> it's", "a b " * 4000, "Hello there.\nGeneral  Kenobi!"]


def test_files_give_back_every_document(session, docs, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    path = work_folder(session, "files")
    rows = [*enumerate(TEXTS * 4)]
    token_files.write(docs(rows[::-1]), path, BYTES, end_id=0)
    tokenizer, start, expected = Tokenizer.from_file(BYTES), 0, {}
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    found = {r["doc_id"]: (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in token_files.read(session, path).collect()}
    assert found == expected
    some = token_files.read(session, path, session.range(3, 20, 8).select(F.col("id").alias("doc_id"))).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in some} == {k: expected[k] for k in (3, 11, 19)}


def test_files_without_rows_and_without_ids(session, docs):
    path = work_folder(session, "none")
    token_files.write(docs([]), path, BYTES)
    assert token_files.read(session, path).collect() == []
    path = work_folder(session, "odd")
    token_files.write(docs([(1, "b"), (None, "a"), (1, "b"), (1, "a")]), path, BYTES)
    found = sorted((r["start"], str(r["doc_id"]), r["n_tokens"]) for r in token_files.read(session, path).collect())
    assert found == [(0, "None", 2), (2, "1", 2), (4, "1", 2), (6, "1", 2)]


def test_counts_and_cuts_equal_the_library(docs):
    limit = 7
    rows = [*enumerate([*TEXTS, "one two three four five six seven eight nine", "é😀中" * 9])]
    found = token_counts.count_tokens(docs(rows), PIECES, limit).collect()
    assert len(found) == len(rows)
    for r in found:
        text = dict(rows)[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(LIBRARY.encode(text)))
        assert r["over_limit"] == (r["n_tokens"] > limit)
        if r["over_limit"] and len(text) < 300:
            fits = [k for k in range(len(text) + 1) if len(LIBRARY.encode(text[:k])) <= limit]
            assert r["cut_chars"] == fits[-1]
        elif not r["over_limit"]:
            assert r["cut_chars"] == len(text)


def test_prefixes_answer_questions_without_encoding_again(docs):
    rows = [(1, "Hello there, General  Kenobi!\n é"), (2, None), (3, "")]
    stored = token_counts.prefix_counts(docs(rows), PIECES)
    for r in stored.collect():
        text = dict(rows)[r["doc_id"]] or ""
        assert r["prefix_tokens"] == [len(LIBRARY.encode(text[:k])) for k in range(1, len(text) + 1)]
    asked = stored.select("doc_id", token_counts.tokens_at(F.col("prefix_tokens"), F.lit(5)).alias("n"))
    assert {r["doc_id"]: r["n"] for r in asked.collect()}[1] == len(LIBRARY.encode("Hello"))
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncated(docs(rows), PIECES, 3).collect()}
    assert len(LIBRARY.encode(cut[1])) <= 3 and rows[0][1].startswith(cut[1]) and cut[2] is None
    assert token_counts.count_tokens(docs([]), PIECES, 3).collect() == []


def test_encoding_keeps_other_columns(docs):
    coded = sentence_pieces.decode(sentence_pieces.encode(docs([*enumerate(TEXTS)]), PIECES), PIECES)
    for r in coded.collect():
        assert r["ids"] == LIBRARY.encode(r["text"] or "") and r["decoded"] == (r["text"] or "")
        assert (r["lang"], r["n_tokens"]) == ("en", "kept")
    at_once = sentence_pieces.encode(docs([*enumerate(TEXTS)]), PIECES, decoded="decoded")
    assert sorted(map(str, at_once.collect())) == sorted(map(str, coded.collect()))
    assert sentence_pieces.encode(docs([]), PIECES).collect() == []
    replaced = token_counts.count_tokens(docs([(1, "a")]), PIECES, 5)
    assert dict(replaced.dtypes)["n_tokens"] == "bigint" and replaced.columns.count("n_tokens") == 1


@pytest.mark.parametrize("value", ["", " ", "\n"])
def test_blank_texts(docs, value):
    assert sentence_pieces.encode(docs([(1, value)]), PIECES).first()["ids"] == LIBRARY.encode(value)


def test_units_in_lines_have_the_ids_of_the_whole_text():
    """Blanks of every kind before, between and after words, contractions and marks."""
    rng = random.Random(11)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "a", "word", "'s", "'", "don't", "1", "23", "é", "ßx", ".", "...", "-", "\x00", "漢", "\u200b", "\x1d", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    ids, counts = byte_bpe(BYTES).ids(*buffer(texts))
    expected = [x.ids for x in byte_bpe(BYTES).tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
