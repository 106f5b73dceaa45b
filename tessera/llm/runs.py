"""Periodic runs of words: stretches in which the same words come again and again.

A run with period q ends in a square (a stretch of q words twice) that is branching: what follows its two halves differs. So
the two halves begin suffixes that share exactly q words and stand in one LCP interval of that depth, under different children.
For each interval of the enhanced suffix array the suffixes of the smaller child look by the inverse suffix array whether
the suffix one depth further on, or one depth back, stands on the other side. Each square found so is rotated to the left for as
long as it stays a square, which gives the run; squares of one run that differ in period merge into the smallest.

The documents of a block are one array, in which a suffix ends with its document. Everything but the last step over the few
runs found works on whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Kept, blobs, kept_by_worker

#: Words that a block of documents holds (about; a longer document is a block of its own), and suffixes looked up at a time.
BLOCK_WORDS, AT_ONCE = 200_000, 1 << 20
#: Bytes of distinct words that a worker keeps numbers of; beyond that it starts anew with the next block.
KEPT_BYTES = 48_000_000


class WordNumbers:
    """A number for each distinct word, the same until ``tidy`` starts anew."""

    def __init__(self, kept_bytes: int = KEPT_BYTES):
        self._known = Kept(kept_bytes)

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        try:
            return np.fromiter([known[w] for w in words], np.int64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known.add(w, len(known))
            return np.fromiter([known[w] for w in words], np.int64, len(words))

    def tidy(self) -> None:
        self._known.tidy()


def _starts_of_groups(keys: np.ndarray) -> np.ndarray:
    """For sorted keys: whether each is the first of its like."""
    return np.concatenate([[True], keys[1:] != keys[:-1]])


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, their ranks, and how many words each shares with the one before it.

    ``words`` are numbers; ``ends`` gives for each place where its document ends. Suffixes of different documents
    share nothing. Ranks double the words that they look at; only suffixes whose rank is not theirs alone go on.
    """
    n = len(words)
    span = np.int64(words.max()) + 1
    sa = np.argsort(ends * span + words, kind="stable")
    first = _starts_of_groups((ends * span + words)[sa])
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, slots, 0))
    # Of the boundary before each slot: the round in which it appeared; -1 for different words at once.
    born = np.where(first, -1, -2)
    ranks, h = [], 1
    while True:
        alone = first & np.append(first[1:], True)
        open_slots = np.flatnonzero(~alone)
        ranks.append(rank.astype(np.int32) if n < 2**31 else rank.copy())
        if not len(open_slots):
            break
        here = sa[open_slots]
        after = here + h
        then = np.where(after < ends[here], rank[np.minimum(after, n - 1)] + 1, 0)
        keys = rank[here] * np.int64(n + 1) + then
        order = np.argsort(keys, kind="stable")
        sa[open_slots] = here[order]
        new = _starts_of_groups(keys[order])
        fresh = open_slots[new & ~first[open_slots]]
        born[fresh] = len(ranks) - 1
        first[fresh] = True
        firsts = np.maximum.accumulate(np.where(first, slots, 0))
        rank[sa[open_slots]] = firsts[open_slots]
        h *= 2
    lcp = np.where(born >= 0, np.left_shift(np.int64(1), np.maximum(born, 0)), 0)
    for level in range(len(ranks) - 2, -1, -1):
        pairs = np.flatnonzero(born > level)
        if len(pairs):
            a, b = sa[pairs - 1] + lcp[pairs], sa[pairs] + lcp[pairs]
            inside = np.maximum(a, b) < ends[sa[pairs]]
            same = inside & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
            lcp[pairs[same]] += 1 << level
    return sa, rank, lcp


def _nearest(values: np.ndarray, at: np.ndarray, stops, side: int) -> np.ndarray:
    """For each boundary in ``at`` the nearest one before (side -1) or after (1) whose value ``stops`` it; by jumps over known stretches."""
    n = len(values)
    jump = np.arange(n) + side
    left = at
    while len(left):
        to = jump[left]
        going = (to >= 0) & (to < n)
        going[going] = ~stops(values[to[going]], values[left[going]])
        left = left[going]
        jump[left] = jump[jump[left]]
    return jump[at]


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Places and periods of branching squares, with the LCP interval (first slot, slot after) of the suffixes that begin like them.

    ``most`` is the greatest period that matters at each place. A boundary parts its interval into what is left of it and what is
    right of it, down to the nearest boundaries of lower depth; boundaries of one depth part it child by child.
    """
    n = len(sa)
    at = np.flatnonzero((lcp > 0) & (lcp <= most[sa]))
    if not len(at):
        return
    # Every boundary with a depth can stand on the way of a jump; where there is none, depth 0 stops all.
    deep = np.flatnonzero(lcp > 0)
    place = np.searchsorted(deep, at)
    left = _nearest(lcp, deep, lambda there, own: there <= own, -1)[place]
    low = _nearest(lcp, deep, lambda there, own: there < own, -1)[place]
    right = _nearest(lcp, deep, lambda there, own: there < own, 1)[place]
    smaller_left = at - left <= right - at
    begin, size = np.where(smaller_left, left, at), np.where(smaller_left, at - left, right - at)
    other_begin, other_end = np.where(smaller_left, at, left), np.where(smaller_left, right, at)
    depth, cuts = lcp[at], np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), AT_ONCE))
    cuts = np.unique(np.append(cuts, len(at)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        count = size[a:b]
        node = np.repeat(np.arange(a, b), count)
        slot = begin[node] + np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)
        here, q = sa[slot], depth[node]
        for first, second in ((here, here + q), (here - q, here)):
            look = second if first is here else first
            ok = (look >= 0) & (look < n)
            r = isa[np.where(ok, look, 0)]
            ok &= (r >= other_begin[node]) & (r < other_end[node])
            yield first[ok], q[ok], low[node[ok]], right[node[ok]]


def periodic_runs(words: np.ndarray, lengths: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Runs of at least ``least`` words and ``times`` periods: rows of document, start, length, period, in that order.

    ``words`` are the documents' words as numbers, one document after the other, of ``lengths`` words each. ``times`` is 2 or more.
    """
    n = len(words)
    if not n:
        return np.empty((0, 4), dtype=np.int64)
    stops = np.cumsum(lengths)
    of = np.repeat(np.arange(len(lengths)), lengths)
    ends, begins = stops[of], (stops - lengths)[of]
    sa, isa, lcp = suffix_array(words, ends)
    found = []
    for i, q, low, high in branching_squares(sa, isa, lcp, (ends - begins) // times):
        back = i
        for _ in range(times - 2):  # rotated by whole periods: the suffix there begins like the square
            back = back - q
            r = isa[np.maximum(back, 0)]
            stays = (back >= 0) & (r >= low) & (r < high)
            i, q, low, high, back = i[stays], q[stays], low[stays], high[stays], back[stays]
        for end, period, start in zip((i + 2 * q).tolist(), q.tolist(), back.tolist(), strict=True):
            first = int(begins[end - 1])
            while start > first:  # and then by single words, as many at a time as a period holds
                step = min(max(period, 64), start - first)
                differ = np.flatnonzero(words[start - step : start] != words[start - step + period : start + period])
                start -= step - 1 - int(differ[-1]) if len(differ) else step
                if len(differ):
                    break
            if end - start >= least:
                found.append((int(of[start]), start - first, end - start, period))
    if not found:
        return np.empty((0, 4), dtype=np.int64)
    rows = np.array(found, dtype=np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))  # the same stretch: the smallest period
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _blocks(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    block, held = [], 0
    for text in texts:
        words = text.split()
        if block and held + len(words) > BLOCK_WORDS:
            yield block
            block, held = [], 0
        block.append(words)
        held += len(words)
    if block:
        yield block


def document_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: the key, n_words, runs (array of start, length, period; by start, then period) and collapsed.

    A run is a stretch of words with smallest period q and a length of at least 6 and 4 * q that no neighbouring word extends keeping that
    period. ``collapsed`` is the text's words without those that a run contains after its first q words, joined by one space. Words
    are numbered from 0 and told apart exactly. A null text has no words, no runs and an empty collapsed text, and so has one of blanks.
    Rows are judged one by one: null and repeated keys, equal texts and other columns change nothing; no rows give no rows. A document
    needs memory in proportion to its words, a block of short ones is bounded. Nothing is shuffled.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker("runs")
        numbers = WordNumbers()
        for batch in batches:
            at = 0
            for block in _blocks(blobs(batch.column(1))):
                lengths = np.array([len(words) for words in block], dtype=np.int64)
                rows = periodic_runs(numbers.of([w for words in block for w in words]), lengths)
                numbers.tidy()
                kept = [b" ".join(words) for words in block]
                for doc in np.unique(rows[:, 0]).tolist():
                    gone = np.zeros(lengths[doc] + 1, dtype=np.int64)
                    mine = rows[rows[:, 0] == doc]
                    np.add.at(gone, mine[:, 1] + mine[:, 3], 1)
                    np.add.at(gone, mine[:, 1] + mine[:, 2], -1)
                    stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
                    kept[doc] = b" ".join([block[doc][i] for i in stay])
                offsets = np.concatenate([[0], np.cumsum(np.bincount(rows[:, 0], minlength=len(block)))])
                parts = [pa.array(rows[:, k], pa.int64()) for k in (1, 2, 3)]
                runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(run)))
                texts = pa.array(kept, pa.binary()).cast(pa.string())
                keys = batch.column(0).slice(at, len(block))
                yield pa.RecordBatch.from_arrays([keys, pa.array(lengths, pa.int64()), runs, texts], schema=schema)
                at += len(block)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    runs = "array<struct<start: long, length: long, period: long>>"
    return rows.mapInArrow(find, f"key long, n_words long, runs {runs}, collapsed string").withColumnRenamed("key", key)
