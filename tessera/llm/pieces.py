"""Encoding and decoding texts as a SentencePiece model of the merging kind does.

The last piece of a text's encoding follows from the text alone. So for every prefix of a text the table
holds the last piece of that prefix's encoding: of the pieces that end there (an automaton over the vocabulary finds them,
longest first) it is the one that stands at the text's start, or whose pair with the last piece of the
prefix before it encodes to just that pair. From the end of the text back, the table gives the ids.
Time is linear in the text. That holds as pieces have scores of their own. Pieces of blanks alone share one score,
below all others: they are merged last, from the left, within each run of blanks that is left single.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Made, blobs, kept_by_worker, looked_up, stretches

BLANK = "▁"
#: Bytes of words whose ids a worker keeps, and pairs of pieces; beyond that it starts anew.
KEPT_WORDS = 200_000_000
KEPT_PAIRS = 1_000_000


class PieceEncoder:
    """Encodes without sampling, with begin and end ids; decodes with the library."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self._model = model
        self._score: dict[str, float] = {}
        self._id: dict[str, int] = {}
        self._byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self._id[piece], self._score[piece] = i, model.get_score(i)
        if not all(model.is_byte(i) for i in self._byte):
            raise ValueError(f"{path} has no byte pieces")
        self._runs = {p: s for p, s in self._score.items() if len(p) > 1 and not p.strip(BLANK)}
        merged = {p: s for p, s in self._score.items() if p not in self._runs}
        many = [s for p, s in merged.items() if len(p) > 1]
        if len(set(many)) < len(many) or any(BLANK in p.lstrip(BLANK) for p in merged):
            raise ValueError(f"{path}: pieces share scores, or hold blanks inside")
        if self._runs and (len(set(self._runs.values())) > 1 or max(self._runs.values()) >= min(many)):
            raise ValueError(f"{path}: pieces of blanks are not merged last")
        #: Characters that some piece holds but no piece is; they may stand alone while merging.
        self._alone = {c for p in merged for c in p} - merged.keys()
        self._merged = merged
        self._list = [*(p for p in merged), *sorted(self._alone)]
        self._automaton = ahocorasick.Automaton()
        for k, piece in enumerate(self._list):
            if len(piece) == 1 or self._merge(piece) == [piece]:  # others never come out
                self._automaton.add_word(piece, (k, len(piece)))
        self._automaton.make_automaton()
        self._bytes = [self._ids_of(p) for p in self._list]
        self._pairs: dict[int, bool] = {}
        self._begin, self._end = (np.array([i], dtype="<u4").tobytes() for i in (model.bos_id(), model.eos_id()))
        self._words = Made(lambda w: self._chunk(BLANK + w), KEPT_WORDS)

    def _ids_of(self, piece: str) -> bytes:
        ids = [self._id[piece]] if piece in self._id else [self._byte[b] for b in piece.encode()]
        return np.array(ids, dtype="<u4").tobytes()

    def _merge(self, text: str) -> list[str]:
        """The best pair first, the left one of equals; for short texts."""
        parts, score = list(text), self._merged
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        key = left * len(self._list) + right
        known = self._pairs.get(key)
        if known is None:
            a, b = self._list[left], self._list[right]
            known = self._merge(a + b) == [a, b]
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def _prefix_table(self, text: str) -> list[tuple[int, int] | None]:
        """The last piece, and its length, of each prefix's encoding; None where an unknown character ends it."""
        last: list[tuple[int, int] | None] = [None] * len(text)
        fits, pairs, n = self._fits, self._pairs, len(self._list)
        for end, found in self._automaton.iter(text):
            if last[end] is None:
                before = end - found[1]
                if before < 0 or (left := last[before]) is None:
                    last[end] = found
                else:
                    known = pairs.get(left[0] * n + found[0])
                    if known if known is not None else fits(left[0], found[0]):
                        last[end] = found
        return last

    def _chunk(self, text: str) -> bytes:
        """Ids of a text whose blanks all stand in front."""
        last, out, end, blanks = self._prefix_table(text), [], len(text) - 1, 0
        while end >= 0:
            found = last[end]
            if found is None:
                out.append(self._ids_of(text[end]))
                end -= 1
            elif self._runs and self._list[found[0]] == BLANK:
                blanks = end + 1  # nothing but blanks in front
                break
            else:
                out.append(self._bytes[found[0]])
                end -= found[1]
        out.reverse()
        return (self._blanks(blanks) if blanks else b"") + b"".join(out)

    def _blanks(self, n: int) -> bytes:
        """Ids of a run of blanks: pairs of one score, so always the leftmost pair that makes a piece."""
        lengths, out, left = {len(p) for p in self._runs}, [1] * n, 0
        while left < len(out) - 1:
            if out[left] + out[left + 1] in lengths:
                out[left : left + 2] = [out[left] + out[left + 1]]
                left = max(0, left - 1)
            else:
                left += 1
        return b"".join(self._ids_of(BLANK * k) for k in out)

    def encode(self, text: str) -> bytes:
        """Ids, little-endian unsigned 32-bit, with those of begin and end."""
        return self._begin + self.encode_plain(text) + self._end

    def encode_plain(self, text: str) -> bytes:
        """The same without begin and end. The text gets a blank in front, an empty one stays empty."""
        if not text:
            return b""
        # No piece holds a blank behind another character: each run of blanks starts anew.
        words = text.replace(BLANK, " ").split(" ")
        self._words.tidy()
        if "" not in words:
            return b"".join(map(self._words.__getitem__, words))
        out, blanks = [], 0
        for w in words:
            blanks += 1
            if w:
                out.append(self._words[w] if blanks == 1 else self._chunk(BLANK * blanks + w))
                blanks = 0
        if blanks:
            out.append(self._blanks(blanks) if self._runs else self._ids_of(BLANK) * blanks)
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids with begin and end of many texts, in order; those of a stretch ask once for each word that they share."""
        for some in stretches(texts):
            spaced = [t.replace(BLANK, " ") for t in some]
            single = [t != "" and t[0] != " " and t[-1] != " " and "  " not in t for t in spaced]
            self._words.tidy()
            words = pc.split_pattern(pa.array([t for t, s in zip(spaced, single, strict=True) if s], pa.large_string()), " ")
            made = iter(looked_up(words, self._words.__getitem__))
            for text, s in zip(some, single, strict=True):
                yield self._begin + next(made) + self._end if s else self.encode(text)

    def decode(self, ids: bytes) -> str:
        return self._model.decode(np.frombuffer(ids, "<u4").tolist())


def piece_encoder(path: str) -> PieceEncoder:
    """This worker's encoder."""
    held = kept_by_worker("pieces")
    if path not in held:
        held[path] = PieceEncoder(path)
    return held[path]


def encoded_and_decoded(docs: DataFrame, model_path: str) -> DataFrame:
    """Each row's text as ids and decoded again: doc_id, ids (little-endian unsigned 32-bit), decoded.

    No shuffle; every row gives a row, whatever its doc_id. A null text is empty: its ids are begin and end alone,
    its decoded text is empty.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        for batch in batches:
            ids = list(encoder.encode_all([b.decode() for b in blobs(batch.column(1))]))
            texts = pa.array([encoder.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), texts], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")
