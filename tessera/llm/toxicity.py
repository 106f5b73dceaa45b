"""Toxicity of texts by weak supervision.

Voters look for one word, or one beginning of words, each (the lexicons), or for a pattern of the whole text; the given label is a
voter too. A generative label model estimates by expectation-maximisation how accurate each voter is, the label included, and
which voters depend on each other beyond the class: those are paired along a forest, and a vote counts for what it adds to its
parent's. A linear classifier of the voters' findings is trained on the posterior labels and scores every text.

Lexicons and model are fitted on a bounded sample of labelled rows, ``SAMPLE`` of each label; shares of the labels are counted
over all of them. Nothing but the text enters a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blobs, kept_by_worker

#: Labelled rows of each label that lexicons and model are fitted on, at most.
SAMPLE = 3_000
#: Voters at most, and how far from chance (likelihood ratio) a word or beginning must be to be one.
VOTERS, LEAST_EVIDENCE = 400, 30.0
BEGINNINGS = (4, 5, 6)
ROUNDS = 30
#: Votes' worth of belief that a voter votes without regard to the one that it depends on.
LOOSE = 2.0
PATTERNS = ("shouting", "exclaiming", "no finding", "two findings")
_FACTORS = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_EDGES = b".,;:!?\"'()[]{}#*$%&|<>-_"


def marks_of(word: bytes) -> list[str]:
    """What a lexicon voter can look for in a word: itself, and its beginnings."""
    text = word.strip(_EDGES).decode().lower()
    return [f"={text}", *(f"^{text[:n]}" for n in BEGINNINGS if len(text) > n)] if text else []


def patterns_of(text: bytes) -> tuple[bool, bool]:
    """Whether most letters are capitals, and whether exclamation marks abound."""
    raw = np.frombuffer(text, np.uint8)
    upper, lower = (int(np.count_nonzero(raw - np.uint8(first) < 26)) for first in (65, 97))
    return upper + lower > 20 and upper > lower, 20 * text.count(b"!") > len(raw) // 6 + 20


@dataclass
class Classifier:
    """Weights of the voters' findings; ``score`` is the chance that a text is toxic."""

    bias: float = -30.0
    weights: dict[str, float] = field(default_factory=dict)
    patterns: list[float] = field(default_factory=lambda: [0.0] * len(PATTERNS))
    many: float = 0.0

    def __post_init__(self):
        self._known: dict[bytes, tuple[str, ...]] = {}

    def findings(self, text: bytes) -> set[str]:
        known, found = self._known, set()
        if len(known) > 500_000:
            known.clear()
        for word in set(text.lower().split()):
            marks = known.get(word)
            if marks is None:
                marks = known[word] = tuple(m for m in marks_of(word) if m in self.weights)
            if marks:
                found.update(marks)
        return found

    def score(self, text: bytes) -> float:
        found = self.findings(text)
        votes = [*patterns_of(text), not found, len(found) > 1]
        total = self.bias + sum(self.weights[m] for m in found) + self.many * math.log1p(len(found))
        total += sum(w for w, v in zip(self.patterns, votes, strict=True) if v)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def _distinct(rows: list[tuple[list[str], int, tuple[bool, bool]]]) -> list[tuple[list[str], int, tuple[bool, bool]]]:
    """Without near copies, whose chance words would look like evidence: two of four signatures seen before."""
    seen: set[tuple] = set()
    kept = []
    for words, label, patterns in rows:
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words] or [0], dtype=np.uint64)
        permuted = [hashes * np.uint64(f) for f in _FACTORS]
        keys = {(label, i, int(p.min()), int(p.max())) for i, p in enumerate(permuted)}
        if len(keys & seen) < 2:
            kept.append((words, label, patterns))
        seen |= keys
    return kept


def _evidence(inside: tuple[int, int], sizes: tuple[int, int]) -> float:
    """Likelihood ratio of a mark's counts in both labels; negative where it speaks against toxicity."""
    total, n = sum(inside), sum(sizes)
    cells = [(inside[y], total * sizes[y] / n) for y in (0, 1)] + [(sizes[y] - inside[y], (n - total) * sizes[y] / n) for y in (0, 1)]
    ratio = 2 * sum(a * math.log(a / b) for a, b in cells if a > 0)
    return ratio if inside[1] * sizes[0] > inside[0] * sizes[1] else -ratio


def lexicon(rows: list[tuple[list[str], int, tuple[bool, bool]]]) -> list[str]:
    """The words and beginnings that speak most for toxicity."""
    sizes = [sum(y == k for _, y, _ in rows) for k in (0, 1)]
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for words, label, _ in rows:
        counts[label].update({m for w in words for m in marks_of(w.encode())})
    if 0 in sizes:
        return []
    found = {m: _evidence((counts[0][m], n), (sizes[0], sizes[1])) for m, n in counts[1].items() if n * 2 > LEAST_EVIDENCE / 2}
    return sorted((m for m, e in found.items() if e >= LEAST_EVIDENCE), key=lambda m: (-found[m], m))[:VOTERS]


@dataclass
class LabelModel:
    """What voters say of a class: a vote depends on the class and on the vote of one other voter at most, its parent.

    ``chances[c, j, p, v]`` is the chance that voter j votes v where the class is c and its parent votes p. Votes are numbered
    0 (none), 1 (for) and 2 (against); a voter without a parent has p = 0.
    """

    prior: float
    parents: np.ndarray
    chances: np.ndarray

    def odds(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of the class, given rows of votes (1, 0 or -1; a column per voter)."""
        codes = _codes(votes, self.parents)
        tell = np.log(self.chances[1] / self.chances[0]).reshape(len(self.parents), 9)
        found = sum((codes == k) @ tell[:, k] for k in range(9))
        return math.log(self.prior / (1 - self.prior)) + found

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(votes), -30, 30)))


def _codes(votes: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Three times the parent's vote, plus the voter's own, as numbered by the model."""
    numbered = (votes % 3).astype(np.int8)
    return 3 * np.where(parents >= 0, numbered[:, parents], 0) + numbered


def estimated(votes: np.ndarray, parents: np.ndarray, share: np.ndarray, prior: float) -> LabelModel:
    """The model, given each row's chance of the class: a voter is taken to be right rather than wrong by one vote, and to
    vote without regard to its parent by ``LOOSE`` votes."""
    codes = _codes(votes, parents)
    chances = np.empty((2, votes.shape[1], 3, 3))
    for c, weight in enumerate((1 - share, share)):
        counts = np.column_stack([weight @ (codes == k) for k in range(9)]).reshape(-1, 3, 3)
        alone = counts.sum(axis=1) + np.where(np.arange(3) == 2 - c, 2.0, 1.0)
        alone /= alone.sum(axis=1, keepdims=True)
        chances[c] = (counts + LOOSE * alone[:, None, :]) / (counts.sum(axis=2, keepdims=True) + LOOSE)
    return LabelModel(prior, parents, chances)


def dependent(votes: np.ndarray, share: np.ndarray, least: float = LEAST_EVIDENCE) -> np.ndarray:
    """A parent for each voter (-1: none): the forest of the pairs that tell most of each other beyond the class.

    A pair's weight is the likelihood ratio of its counts in each class against chance, of whether the two vote at all.
    """
    fires = (votes != 0).astype(float)
    told = np.zeros((votes.shape[1],) * 2)
    for weight in (share, 1 - share):
        n, both = weight.sum(), fires.T @ (fires * weight[:, None])
        one = np.diag(both)
        neither = n - one[:, None] - one[None, :] + both
        cells = ((both, one, one), (one[:, None] - both, one, n - one), (one[None, :] - both, n - one, one), (neither, n - one, n - one))
        for seen, a, b in cells:
            seen, chance = seen.clip(0), np.outer(a, b) / max(n, 1e-9)
            told += 2 * np.where(seen > 1e-9, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(chance, 1e-9)), 0.0)
    parents = np.full(len(told), -1)
    best, source, open_ones = np.full(len(told), -1.0), np.full(len(told), -1), np.ones(len(told), dtype=bool)
    for _ in parents:
        # The next voter is the one that the tree so far tells most of, or begins a tree of its own.
        j = int(np.where(open_ones, best, -2.0).argmax())
        parents[j] = source[j] if best[j] >= least else -1
        open_ones[j] = False
        closer = told[j] > best
        best, source = np.where(closer, told[j], best), np.where(closer, j, source)
    return parents


def label_model(votes: np.ndarray, labels: np.ndarray, prior: float, rounds: int = ROUNDS) -> tuple[LabelModel, np.ndarray]:
    """The model of the votes and the posterior of each row, by expectation-maximisation.

    The given label is one more voter, the last one, that depends on the class alone: its accuracy is estimated like the others'. It
    is where the rounds begin. Pairs are sought at once, as copies of one voter would otherwise pass for the class, and again half-way.
    """
    say = np.column_stack([votes, np.where(labels == 1, 1, -1)]).astype(int)
    share = np.where(labels == 1, 0.95, 0.05)
    for round_ in range(rounds):
        if round_ in (0, rounds // 2):
            parents = np.append(dependent(say[:, :-1], share), -1)
        model = estimated(say, parents, share, prior)
        share = model.posterior(say)
    return model, share


def _regression(x: np.ndarray, goal: np.ndarray, importance: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the first column is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (importance * (p - goal)) + penalty * w
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fitted(rows: Iterable[tuple[list[str], int, tuple[bool, bool]]], toxic_share: float) -> Classifier:
    """From sampled rows (distinct words, label, patterns) and the share of toxic ones among all labelled rows."""
    sample = _distinct(sorted(rows, key=lambda r: (r[1], r[0])))
    marks = lexicon(sample)
    if not marks:
        return Classifier()
    number = {m: i for i, m in enumerate(marks)}
    found = np.zeros((len(sample), len(marks)))
    for i, (words, _, _) in enumerate(sample):
        for m in {m for w in words for m in marks_of(w.encode())}:
            if m in number:
                found[i, number[m]] = 1
    labels = np.array([y for _, y, _ in sample])
    hits = found.sum(axis=1)
    patterns = np.column_stack([np.array([p for _, _, p in sample], dtype=float).reshape(-1, 2), hits == 0, hits > 1])
    votes = np.column_stack([found, patterns * np.array([1, 1, -1, 1])])
    prior = min(0.99, max(0.01, toxic_share))
    share = labels.mean()
    _, goal = label_model(votes, labels, min(0.99, max(0.01, share)))
    importance = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    x = np.column_stack([np.ones(len(sample)), found, patterns, np.log1p(hits)])
    w = _regression(x, goal, importance)
    n = len(marks)
    return Classifier(float(w[0]), dict(zip(marks, w[1 : n + 1].tolist(), strict=True)), w[n + 1 : -1].tolist(), float(w[-1]))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fit on at most ``sample`` labelled rows of each label, those of the smallest hash of doc_id, none held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic or toxic == total:
        return Classifier()
    mixed = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("toxic") == y).orderBy(mixed, "doc_id").limit(sample) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # two numbers a row, and at most 2 * sample rows: safe to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = blobs(batch.column(1))
            lists = [sorted({w.decode() for w in t.lower().split()}) for t in found]
            patterns = [list(map(bool, patterns_of(t))) for t in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.string())), pa.array(patterns, pa.list_(pa.bool_()))],
                names=["toxic", "words", "patterns"],
            )

    sampled = rows.mapInArrow(words, "toxic int, words array<string>, patterns array<boolean>")
    return fitted(((r["words"], r["toxic"], tuple(r["patterns"])) for r in sampled.toLocalIterator()), toxic / total)


def scored(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts have the score of a text without findings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker("toxicity")
        for batch in batches:
            scores = [classifier.score(t) for t in blobs(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``threshold`` on).

    Rows with a null or repeated doc_id are scored like others; a null doc_id is not held out. A doc_id that the labels
    name twice is toxic if either says so. Without toxic and harmless labelled rows, or if no word tells
    them apart, every score is next to 0. No documents give no rows.
    """
    rows = scored(docs, trained(docs, labels, sample))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
