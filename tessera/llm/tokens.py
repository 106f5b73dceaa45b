"""Encoding whole texts with a word-bounded tokenizer of the tokenizers library."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Made, blobs, kept_by_worker, looked_up, stretches

#: Bytes of words, and of pieces of words, whose ids a worker keeps; beyond that it starts anew.
KEPT_WORDS, KEPT_PIECES = 150_000_000, 40_000_000

_SMALL = [chr(c) for c in range(0x250)]
#: The byte alphabet: bytes that print stand for themselves, the others are numbered from 256 on.
_PRINTING = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OF_BYTES = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTING)))}
#: Composed as they are, and lowered one by one; no controls but white space.
_SIMPLE = re.compile("[\\t-\\r\\x20-~\xa0-\u012F\u0131-\u024F]*")


def _of_category(category: str) -> str:
    return "".join(re.escape(c) for c in _SMALL if unicodedata.category(c)[0] == category)


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers, the same as the library gives for it.

    For tokenizers that compose, drop white space, lower the case and split by a pattern that never
    reaches across white space (``word_bpe``): the ids of a text are those of its words, one after the
    other, and those of a word are its pieces'. So the library merges each distinct piece once. Texts of
    characters up to U+024F are split here; a word with others, or with what may be a special
    token, goes to the library whole.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS, kept_pieces: int = KEPT_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self._tokenizer.to_str())
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or byte_level["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a tokenizer of words")
        pattern = split["pattern"]["Regex"]
        for name, chars in (("\\p{L}", _of_category("L")), ("\\p{N}", _of_category("N")), ("\\s", "\\t-\\r\\x20\x85\xa0")):
            pattern = pattern.replace(name, chars)
        self._pieces_of = re.compile(pattern).findall
        self._model = self._tokenizer.model
        self._pieces = Made(self._piece, kept_pieces)
        self._words = Made(self._word, kept_words)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_OF_BYTES)
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word in lower case. Letters alone are one piece, and as a word they may be known already."""
        if word.isalpha():
            return self._pieces.get(word) or self._piece(word)
        words, pieces = self._words, self._pieces
        return b"".join([(words.get(p) if p.isalpha() else None) or pieces[p] for p in self._pieces_of(word)])

    def encode(self, blob: bytes) -> bytes:
        text = blob.decode()
        if "<|" in text or not _SIMPLE.fullmatch(text):
            return b"".join(map(self._encode_word, blob.split()))
        return self._encode_simple(text)

    def encode_all(self, blobs: list[bytes]) -> Iterator[bytes]:
        """The same for many texts, in order; those of a stretch ask once for each word that they share."""
        for some in stretches(blobs):
            texts = [b.decode() for b in some]
            simple = ["<|" not in t and _SIMPLE.fullmatch(t) is not None for t in texts]
            lowered = [t.lower().replace("\xa0", " ") for t, s in zip(texts, simple, strict=True) if s]
            self._tidy()
            made = iter(looked_up(pc.ascii_split_whitespace(pa.array(lowered, pa.large_string())), self._words.__getitem__))
            for blob, s in zip(some, simple, strict=True):
                yield next(made) if s else self.encode(blob)

    def _encode_word(self, blob: bytes) -> bytes:
        word = blob.decode()
        if "<|" in word or not _SIMPLE.fullmatch(word):
            return array("I", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return self._encode_simple(word)

    def _encode_simple(self, text: str) -> bytes:
        self._tidy()
        return b"".join(map(self._words.__getitem__, text.lower().split()))

    def _tidy(self) -> None:
        self._words.tidy()
        self._pieces.tidy()


def word_encoder(path: str, kept_words: int = KEPT_WORDS, kept_pieces: int = KEPT_PIECES) -> WordEncoder:
    """This worker's encoder."""
    key, held = (path, kept_words, kept_pieces), kept_by_worker("words")
    if key not in held:
        held[key] = WordEncoder(*key)
    return held[key]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, piece_tokens: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each text's ids with ``end_id`` appended, cut into pieces of at most ``piece_tokens``.

    Columns: the key, piece (from 0), start (ids of the document before it), length, ids (binary,
    little-endian unsigned 32-bit). A null text is empty and gives the end id alone. Only the two
    columns named are used, so others may have any name.
    """
    tail = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema(
        [("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )
    step = 4 * piece_tokens

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        for batch in batches:
            out: list[tuple] = []
            for doc, made in zip(batch.column(0).to_pylist(), encoder.encode_all(blobs(batch.column(1))), strict=True):
                ids = made + tail
                for i, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    out.append((doc, i, at // 4, len(cut) // 4, cut))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
                )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    pieces = rows.mapInArrow(encode, "key long, piece int, start long, length long, ids binary")
    return pieces.withColumnRenamed("key", key)
