"""Encoders against their libraries, token files and packing against plain arithmetic."""

import random
import re
import weakref
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing, pieces, token_files, tokens
from tessera.llm.common import importable, kept_by_worker, looked_up, stretches
from tessera.llm.tokens import WordEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, ids string, piece string, key string"
ROWS = [
    (5, "The cat sat.\nIt's 2024!", "x", "x", "x"),
    (None, "no id", "x", "x", "x"),
    (2, None, "x", "x", "x"),
    (3, "", "x", "x", "x"),
    (5, "The cat sat.\nIt's 2024!", "x", "x", "x"),
    (4, "word " * 3000, "x", "x", "x"),
    (6, "a" * 5000, "x", "x", "x"),
    (7, "É́ ß 日本 <|endoftext|> \x00 \x85x", "x", "x", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def words():
    return WordEncoder(WORD), Tokenizer.from_file(WORD)


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


TEXT = st.text(st.one_of(st.sampled_from("aAé'sLl 09.,<|>\n\t\x0b\x85\xa0İ́Σς日²"), st.characters(codec="utf-8")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_words_encode_as_the_library_does(words, text):
    encoder, library = words
    for t in (text, text + "<|endoftext|>" + text):
        assert encoder.encode(t.encode()) == as_bytes(library.encode(t, add_special_tokens=False).ids)


def test_a_word_is_made_once_and_all_go_when_they_are_many():
    encoder, asked = WordEncoder(WORD, kept_words=2000, kept_pieces=2000), []
    encoder._words._make = lambda w, make=encoder._words._make: asked.append(w) or make(w)
    fresh = WordEncoder(WORD)
    for text in ("a b a B c", "a d", "new " * 3):
        assert encoder.encode(text.encode()) == fresh.encode(text.encode())
    assert asked == ["a", "b", "c", "d", "new"]
    many = " ".join(f"w{i}" for i in range(50))
    assert encoder.encode(many.encode()) == fresh.encode(many.encode())
    assert len(encoder._words) > 50
    encoder.encode(b"a")
    assert asked[-1] == "a" and list(encoder._words) == ["a"]


def test_many_texts_encode_by_words_as_one_by_one(words):
    encoder, asked = WordEncoder(WORD), []
    encoder._words._make = lambda w, make=encoder._words._make: asked.append(w) or make(w)
    ids = [as_bytes(words[1].encode(t, add_special_tokens=False).ids) for t in MANY]
    blobs = [t.encode() for t in MANY]
    assert list(encoder.encode_all(blobs)) == ids == [encoder.encode(b) for b in blobs]
    assert len(asked) == len(set(asked))
    assert list(encoder.encode_all([])) == [] and list(encoder.encode_all([b"", b" "])) == [b"", b""]


@pytest.mark.parametrize("highest", [0, 1, 255, 2**16 - 1, 2**16, 2**32 - 1])
def test_planes_of_narrow_and_wide_ids(highest):
    ids = np.array([highest, 0, highest // 2, highest, 1 % (highest + 1)] * 300, dtype="<u4")
    matrix = token_files.WaveletMatrix.from_bytes(token_files.WaveletMatrix.build(ids).to_bytes())
    assert matrix.all().tolist() == ids.tolist()
    assert [matrix.access(i) for i in range(5)] == ids[:5].tolist()
    assert matrix.rank(highest, len(ids)) == ids.tolist().count(highest)


PIECE_TEXT = st.one_of(TEXT, st.text("aabcdeinorst ", max_size=60), st.text(" ▁\nx", max_size=40))


@pytest.fixture(scope="module")
def piece_models():
    return pieces.PieceEncoder(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=400, deadline=None)
@given(text=PIECE_TEXT)
def test_pieces_encode_as_the_library_does(piece_models, text):
    encoder, library = piece_models
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert encoder.encode(text) == as_bytes(ids)
    assert encoder.decode(as_bytes(ids)) == library.decode(ids)


def test_pieces_of_random_pieces(piece_models):
    encoder, library = piece_models
    rng = random.Random(3)
    vocabulary = [library.id_to_piece(i) for i in range(259, 32000)]
    for _ in range(2000):
        text = "".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 8)))
        assert encoder.encode(text) == as_bytes(library.encode(text, add_bos=True, add_eos=True))


MANY = ["a b\xa0a B", "", "b  a", " a", "a ", "▁a b", "a\tb <|endoftext|> a", "日本 İ b", "thand, it's 2024 thand\nit's", "a b\xa0a B"]


def test_many_texts_encode_by_pieces_as_one_by_one(piece_models):
    _, library = piece_models
    encoder, asked = pieces.PieceEncoder(PIECE), []
    encoder._words._make = lambda w, make=encoder._words._make: asked.append(w) or make(w)
    ids = [as_bytes(library.encode(t, add_bos=True, add_eos=True)) for t in MANY]
    assert list(encoder.encode_all(MANY)) == ids == [encoder.encode(t) for t in MANY]
    assert len(asked) == len(set(asked))
    assert list(encoder.encode_all([])) == [] and list(encoder.encode_all([""])) == ids[1:2]


def test_each_word_of_many_texts_is_asked_for_once():
    asked = []
    lists = pa.array([["a", "b", "a"], [], ["b", ""]], pa.list_(pa.large_string()))
    assert looked_up(lists, lambda w: asked.append(w) or 2 * w.encode()) == [b"aabbaa", b"", b"bb"]
    assert sorted(asked) == ["", "a", "b"]
    assert looked_up(lists[2:], str.encode) == [b"b"] and looked_up(lists, lambda w: b"") == [b""] * 3
    assert looked_up(lists[1:2], None) == [b""] and looked_up(lists[:0], None) == []
    assert list(stretches(["aa", "b", "cccc", "", "d"], 3)) == [["aa", "b"], ["cccc"], ["", "d"]]


def test_every_row_is_encoded_and_decoded(docs, piece_models):
    _, library = piece_models
    got = sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in pieces.encoded_and_decoded(docs, PIECE).collect()), key=repr)
    ids = [(d, library.encode(t or "", add_bos=True, add_eos=True)) for d, t, *_ in ROWS]
    assert got == sorted(((d, as_bytes(i), library.decode(i)) for d, i in ids), key=repr)
    assert pieces.encoded_and_decoded(docs.limit(0), PIECE).count() == 0


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.integers(0, 40), max_size=1500), top=st.sampled_from([0, 1, 49_000]))
def test_wavelet_matrix(ids, top):
    ids = [*ids, top]
    matrix = token_files.WaveletMatrix.from_bytes(token_files.WaveletMatrix.build(np.array(ids)).to_bytes())
    assert matrix.all().tolist() == ids
    for place in {0, len(ids) // 2, len(ids) - 1}:
        assert matrix.access(place) == ids[place]
        token = ids[place]
        assert matrix.rank(token, place) == ids[:place].count(token)
        assert matrix.select(token, ids[:place].count(token)) == place
    assert matrix.rank(39, len(ids)) == ids.count(39)
    with pytest.raises(IndexError):
        matrix.select(top, ids.count(top))


@pytest.mark.parametrize("file_tokens", [50, 4_000_000])
def test_token_files_hold_all_rows_in_order(spark, docs, words, file_tokens):
    folder = token_files.write_token_files(docs, WORD, end_id=1, file_tokens=file_tokens)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    texts = sorted(((-1 if d is None else d), t or "") for d, t, *_ in ROWS)
    start = 0
    for row, (doc, text) in zip(got, texts, strict=True):
        ids = [*words[1].encode(text, add_special_tokens=False).ids, 1]
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (None if doc < 0 else doc, start, len(ids), as_bytes(ids))
        start += len(ids)


def test_no_documents_make_no_files(spark, docs):
    empty = docs.limit(0)
    assert token_files.read_token_files(spark, token_files.write_token_files(empty, WORD)).count() == 0
    assert packing.packed_documents(empty, WORD).count() == 0


def test_packing_loses_nothing_and_leaves_no_gaps(docs, words):
    rows = packing.packed_documents(docs, WORD, end_id=0, capacity=64).collect()
    cut = []
    for d, t, *_ in ROWS:
        ids = [*words[1].encode(t or "", add_special_tokens=False).ids, 0]
        cut += [(d, p, at, as_bytes(ids[at : at + 64])) for p, at in enumerate(range(0, len(ids), 64))]
    assert sorted(((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows), key=repr) == sorted(cut, key=repr)
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0) and r.length == len(r.ids) // 4
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 64


def test_sequences_join_their_pieces(docs):
    packed = packing.packed_documents(docs, WORD, capacity=64).cache()
    total = packed.agg(F.sum("length")).first()[0]
    rows = packing.sequences(packed).collect()
    assert sum(len(r.ids) // 4 for r in rows) == total and all(r.offsets[0] == 0 for r in rows)


def test_sum_of_squares_is_close_to_the_bound():
    rng = random.Random(1)
    items = sorted((min(2048, int(rng.lognormvariate(5.7, 0.9)) + 1) for _ in range(4000)), reverse=True)
    packer = packing.SumOfSquares(2048)
    filled = {}
    for n in items:
        b, at = packer.place(n)
        assert at == filled.get(b, 0)
        filled[b] = at + n
    assert max(filled.values()) <= 2048 and packer.bins <= 1.01 * (sum(items) / 2048) + 2
    with pytest.raises(ValueError):
        packer.place(0)


def test_a_worker_keeps_for_one_operator_only():
    encoder = tokens.word_encoder(WORD)
    assert tokens.word_encoder(WORD) is encoder
    kept_by_worker("another")
    assert tokens.word_encoder(WORD) is not encoder


def test_a_worker_gives_back_what_it_kept_and_what_arrow_held():
    def held_mb():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    kept_by_worker("one")
    gone = weakref.ref(tokens.word_encoder(WORD))
    batches = [pa.array([b"x" * 2000] * 500) for _ in range(200)]
    del batches
    before = held_mb()
    kept_by_worker("another")
    assert gone() is None
    assert held_mb() < before - 50


def test_a_worker_gives_back_what_the_c_library_held():
    def held_mb():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    kept_by_worker("one")["texts"] = texts = [b"%d" % i * 400 for i in range(40_000)]
    last = texts[::400]  # what stays in between, so that nothing goes by itself
    del texts
    before = held_mb()
    kept_by_worker("another")
    assert len(last) == 100 and held_mb() < before - 40
