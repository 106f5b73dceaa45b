"""Token counts of whole texts without encoding what is known to be one token.

Before any text is read, every string of the vocabulary is encoded alone; those that come out as one token are the whole
tokens. In a text, a pre-token that is a whole token counts as one by a look-up; only the others are merged, each distinct one
once for as long as there is room to keep its count.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import kept_by_worker

#: Bytes of merged pre-tokens whose counts a worker keeps; beyond that it starts anew. Longer ones (characters) are not kept.
KEPT_BYTES, KEPT_LENGTH = 64_000_000, 100
#: Characters of a text that are split at a time, about.
STRETCH = 1 << 20

_SMALL = [chr(c) for c in range(0x250)]
_SPACE = "\\t-\\r\\x20\x85\xa0"
_LETTER = "".join(re.escape(c) for c in _SMALL if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(re.escape(c) for c in _SMALL if unicodedata.category(c)[0] == "N")


def _split(space: str, letter: str, number: str) -> re.Pattern:
    """The split of byte-level tokenizers over texts whose characters of each class are these."""
    rest = f" ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+|{rest}")


#: For characters up to U+024F, whose classes no newer Unicode changes, and for plain ones.
_PIECES, _PLAIN_PIECES = _split(_SPACE, _LETTER, _NUMBER), _split("\\t-\\r\\x20", "A-Za-z", "0-9")
_SIMPLE = re.compile("[\0-\u024f]*")
#: All white space that the libraries know: no pre-token goes on from a character that is none to one that is.
_ALL_SPACE = _SPACE + "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNKS = re.compile(f"[{_ALL_SPACE}]*[^{_ALL_SPACE}]+|[{_ALL_SPACE}]+")
_CUT = re.compile(f"(?<=[^{_ALL_SPACE}])(?=[{_ALL_SPACE}])")


def _byte_alphabet() -> dict[str, int]:
    """What stands for each byte in the vocabulary: itself if it prints, otherwise the next character after U+00FF."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


_ALPHABET = _byte_alphabet()
_SHOWN = {b: c for c, b in _ALPHABET.items()}


class TokenCounter:
    """Counts tokens as a byte-level tokenizer of the tokenizers library does, special tokens in a text as one each."""

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        spec = json.loads(self._tokenizer.to_str())
        split = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{path} is not a byte-level tokenizer that leaves texts as they are")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} has added tokens that take in what is around them")
        special = "|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))
        self._special = re.compile(special) if special else None
        self._model = self._tokenizer.model
        self.whole = self._whole_tokens({t["content"] for t in added})
        self._merged: dict[str, int] = {}
        self._room = self._all_room = kept_bytes

    def _whole_tokens(self, added: set[str]) -> frozenset[str]:
        """The vocabulary's strings that, encoded alone, are one token."""
        texts = []
        for entry in self._tokenizer.get_vocab():
            if entry not in added:
                try:
                    texts.append(bytes(_ALPHABET[c] for c in entry).decode())
                except UnicodeDecodeError:  # part of a character: never a whole pre-token
                    continue
        encoded = self._tokenizer.encode_batch(texts, add_special_tokens=False)
        return frozenset(t for t, e in zip(texts, encoded, strict=True) if len(e.ids) == 1)

    def _merge(self, piece: str) -> int:
        """Tokens of a pre-token."""
        return len(self._model.tokenize(piece.encode().decode("latin-1").translate(_SHOWN)))

    def _split_and_merge(self, chunk: str) -> int:
        """Tokens of a stretch up to white space, split by the library."""
        return sum(len(self._model.tokenize(part)) for part, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(chunk))

    def _counted(self, piece: str, count: Callable[[str], int]) -> int:
        """The count of a piece, taken once for as long as there is room to keep it."""
        known = self._merged.get(piece)
        if known is None:
            known = count(piece)
            if len(piece) <= KEPT_LENGTH:
                size = sys.getsizeof(piece) + 120  # the entry's share of the table and its number
                if size > self._room:
                    self._merged.clear()
                    self._room = self._all_room
                self._merged[piece] = known
                self._room -= size
        return known

    def _pieces(self, pieces: list[str]) -> int:
        whole, counted, merge = self.whole, self._counted, self._merge
        return sum([1 if p in whole else counted(p, merge) for p in pieces])

    def _stretch(self, text: str) -> int:
        if text.isascii():
            return self._pieces(_PLAIN_PIECES.findall(text))
        if _SIMPLE.fullmatch(text):
            return self._pieces(_PIECES.findall(text))
        # The library splits what holds other characters; white space never joins two chunks.
        total, simple = 0, []
        for chunk in _CHUNKS.findall(text):
            if _SIMPLE.fullmatch(chunk):
                simple += _PIECES.findall(chunk)
            else:
                total += self._counted(chunk, self._split_and_merge)
        return total + self._pieces(simple)

    def count(self, text: str) -> int:
        if not self._special:
            return self._plain(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        total, at = 0, 0
        while len(text) - at > STRETCH:
            cut = _CUT.search(text, at + STRETCH)
            if not cut:
                break
            total += self._stretch(text[at : cut.start()])
            at = cut.start()
        return total + self._stretch(text[at:] if at else text)


def token_counter(path: str) -> TokenCounter:
    """This worker's counter."""
    held = kept_by_worker("counts")
    if path not in held:
        held[path] = TokenCounter(path)
    return held[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: the key, n_bytes (of the text in UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    A null text is empty: no bytes, no tokens. Rows are counted one by one, so null and repeated keys, equal texts and any
    other columns change nothing, and no rows give no rows. A very long text is split at white space and
    counted a stretch at a time. Nothing is shuffled.
    """
    schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(tokenizer_path)
        for batch in batches:
            sizes, counts = [], []
            for value in batch.column(1):
                found = value.as_py() or ""
                sizes.append(len(found.encode()))
                counts.append(counter.count(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(count, "key long, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
