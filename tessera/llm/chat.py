"""Conversations as training texts with loss masks that line up with the tokens.

A conversation is rendered whole and encoded once, with the place of every token in the text. The places of the assistant's turns are
known from rendering; both lists are sorted, so a binary search tells which tokens meet a turn.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import kept_by_worker

#: Before a turn, between role and text, after a turn. Each is one token of its own.
START, SAYS, END = "<|turn|>", "<|says|>", "<|done|>"

_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(END), re.DOTALL)


def escaped(text: str) -> str:
    """No control string is left in the result: ``<|`` gets a backslash inside, and one more if it has some."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


@dataclass
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of the assistant's texts, in code points


def rendered(turns: list[tuple[str, str]], learn: str = "assistant") -> Rendered:
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = START + escaped(role) + SAYS, escaped(text)
        if role == learn and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return Rendered("".join(parts), spans)


def turns_of(text: str) -> list[tuple[str, str]]:
    """Roles and texts, read back from a rendered conversation."""
    return [(unescaped(role), unescaped(body)) for role, body in _TURN.findall(text)]


def mask_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of the tokens, sorted by place, meet one of the sorted spans."""
    if not spans:
        return np.zeros(len(starts), dtype=bool)
    span_starts, span_ends = np.array(spans).T
    before = np.searchsorted(span_starts, ends, side="left") - 1  # the last span that starts before the token ends
    return (before >= 0) & (span_ends[before] > starts) & (ends > starts)


def masked_text(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """All text under a mask, once and in order, without escapes."""
    starts, ends = starts[mask], ends[mask]
    if not len(starts):
        return ""
    # Parts of one character have the same place; a gap ends a run.
    reach = np.maximum.accumulate(ends)
    breaks = np.flatnonzero(starts[1:] > reach[:-1]) + 1
    firsts, lasts = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(starts)]]) - 1
    return "".join(unescaped(text[starts[a] : reach[b]]) for a, b in zip(firsts, lasts, strict=True))


def chat_tokenizer(path: str):
    """This worker's tokenizer, with the control strings as tokens and nothing else special."""
    held = kept_by_worker("chats")
    if path not in held:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_tokens([AddedToken(c, normalized=False, special=False) for c in (START, SAYS, END)])
        tokenizer.encode_special_tokens = True
        held[path] = tokenizer
    return held[path]


def formatted(conversations: DataFrame, tokenizer_path: str, rows_per_batch: int = 100) -> DataFrame:
    """One row per conversation: conv_id, n_turns, text, ids, starts, ends (of tokens in the text), mask (per token).

    Rows of a conversation stand by turn, rows of one turn by role and text; repeated rows stay. Null turns come first, null
    roles and texts are empty, and rows without conv_id are one conversation. An empty text of the assistant
    has no tokens to learn. Other columns are not read. A conversation is one value and must fit a task. No rows give no rows.
    """
    said = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), said.alias("said"))
    whole = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    ints = pa.list_(pa.int32())
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string()), ("ids", ints), ("starts", ints), ("ends", ints), ("mask", pa.list_(pa.bool_()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_batch):
                rows = []
                for row in batch.slice(at, rows_per_batch).to_pylist():
                    done = rendered([(t["role"], t["text"]) for t in row["turns"]])
                    encoding = tokenizer.encode(done.text, add_special_tokens=False)
                    starts, ends = np.array(encoding.offsets, dtype=np.int32).reshape(-1, 2).T
                    mask = mask_of(starts, ends, done.spans)
                    rows.append((row["conv_id"], len(row["turns"]), done.text, encoding.ids, starts, ends, mask))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                )

    kinds = "conv_id long, n_turns long, text string, ids array<int>, starts array<int>, ends array<int>, mask array<boolean>"
    return whole.mapInArrow(run, kinds)


def read_back(chats: DataFrame) -> DataFrame:
    """What a formatted conversation says: conv_id, turns (array of role and text), loss_text (all text under the mask)."""
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("turns", pa.list_(turn)), ("loss_text", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text, starts, ends, mask in zip(*batch.columns, strict=True):
                body = text.as_py()
                places = [np.asarray(c.values) for c in (starts, ends)]
                learnt = np.asarray(mask.values.to_numpy(zero_copy_only=False), dtype=bool)
                said = [{"role": r, "text": t} for r, t in turns_of(body)]
                out.append((conv.as_py(), said, masked_text(body, *places, learnt), len(body)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
                )

    kinds = "conv_id long, turns array<struct<role:string,text:string>>, loss_text string, formatted_chars long"
    return chats.select("conv_id", "text", "starts", "ends", "mask").mapInArrow(run, kinds)
