"""Quality rules, and outliers among the documents of a language and source.

Fixed rules reject very short and self-repeating texts. Of the others, each language and source gets a
minimum-covariance-determinant estimate of its documents' statistics: concentration steps keep the three quarters
of the documents that lie closest to the estimate so far and estimate anew from them. A document is rejected if its robust
Mahalanobis distance is beyond a chi-squared quantile. All documents take part in all estimates: counts,
sums and quantiles are aggregates that combine before the shuffle, so a language and source may hold any share of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import blobs, kept_by_worker, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct")
SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?"
MIN_WORDS = 20
REPEAT_WINDOW = 8
#: Words that each document is taken to have besides its own, of the corpus's mean rates, so that chance weighs less in short ones.
PRIOR_WORDS = 50
#: Smallest standard deviation of each statistic: differences below it are never odd.
LEAST_SPREAD = (0.05, 0.05, 0.05, 0.05, 0.03)
SIZE = len(LEAST_SPREAD)
HELD = 0.75
STEPS = 4
CUTOFF = 0.9999
#: Languages and sources with fewer documents are judged with all small ones of their language, or of all languages.
LEAST_GROUP = 50

_WEIGHTS = np.random.default_rng(8).integers(1, 2**63, REPEAT_WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(ids: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words in windows of ``window`` words that the text has twice or more; ``ids`` numbers its distinct words."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, dtype=np.uint64)
    for j in range(window):
        hashes += mixed[j : j + n] * _WEIGHTS[j % len(_WEIGHTS)]
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order[1:]] == hashes[order[:-1]]
    if not equal.any():
        return 0
    among = np.sort(order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])])
    # Equal hashes only point to the windows; the words decide.
    _, inverse, counts = np.unique(
        np.lib.stride_tricks.sliding_window_view(ids, window)[among], axis=0, return_inverse=True, return_counts=True
    )
    starts = among[counts[inverse.reshape(-1)] > 1]
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def counts_of(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of a text in UTF-8."""
    words = text.split()
    joined = b"".join(words)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return (
        len(words),
        len(joined) if joined.isascii() else len(joined.decode()),
        int(by_byte[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(ids) if len(number) < len(words) else 0,
        int(by_byte[65:91].sum()),
        int(by_byte[list(MARKS)].sum()),
        len(number),
    )


def counted(docs: DataFrame, keep: list[str], text: str = "text", within: str | None = None) -> DataFrame:
    """The columns ``keep``, and the ``COUNTS`` of each text as the struct ``counts``.

    ``within``: a struct among ``keep``, never null, whose field ``text`` is meant; texts then go to Python once, not twice.
    """
    kind = pa.struct([(c, pa.int64()) for c in COUNTS])
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    field = docs.schema[within].dataType.fieldNames().index(text) if within else None
    if within and isinstance(docs.schema[within].dataType[field].dataType, T.StringType):
        first, of = 0, keep.index(within)
        taken = docs.select(*kept)
    else:
        first, of, field = 1, 0, None
        source = F.col(f"`{within}`").getField(text) if within else F.col(text)
        taken = docs.select(source.cast("string").alias("text"), *kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker("quality")
        for batch in batches:
            texts = batch.column(of) if field is None else batch.column(of).field(field)
            found = [counts_of(b) for b in blobs(texts)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * len(COUNTS)
            counts = pa.StructArray.from_arrays(columns, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], counts], names=[*(f"k{i}" for i in range(len(keep))), "counts"])

    fields = ", ".join(f"k{i} {t.dataType.simpleString()}" for i, t in enumerate(taken.schema.fields[first:]))
    counts = "counts struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"
    rows = taken.mapInArrow(count, f"{fields}, {counts}" if fields else counts)
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "counts")


def base_failed() -> Column:
    n, repeated = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > 30 * n)


def _vector(rates: dict[str, float]) -> Column:
    """Word length, symbols, capitals, marks and variety, transformed to stable spread."""
    n = F.col("counts.n_words")

    def share(count: str, rate: str, of: Column, scale: float = 1.0) -> Column:
        smooth = (F.col(f"counts.{count}") + PRIOR_WORDS * scale * rates[rate]) / (of + PRIOR_WORDS * scale)
        return F.asin(F.sqrt(F.least(smooth, F.lit(1.0))))

    length = F.log((F.col("counts.word_chars") + PRIOR_WORDS * rates["length"]) / (n + PRIOR_WORDS))
    variety = F.log(F.greatest(F.col("counts.n_distinct"), F.lit(1))) / F.log(F.greatest(n, F.lit(2)))
    return F.array(
        length,
        share("n_symbols", "symbols", n),
        share("n_upper", "upper", F.col("counts.word_chars"), rates["length"]),
        share("n_marks", "marks", n),
        variety,
    )


def _named(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _grouped(rows: DataFrame) -> DataFrame:
    """Add ``part``: the language and source, or the pool of small ones they fall to."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < LEAST_GROUP
    pools = sizes.filter(small).groupBy("lang").agg(F.sum("n").alias("pool"))
    place = sizes.join(pools, "lang", "left").select(
        "lang",
        "source",
        F.when(~small, F.to_json(F.array("lang", "source")))
        .when(F.col("pool") >= LEAST_GROUP, F.to_json(F.array("lang")))
        .otherwise(F.lit("[]"))
        .alias("part"),
    )
    return rows.join(place, ["lang", "source"])


def _moments(rows: DataFrame, inside: Column) -> DataFrame:
    """Count, means and products of the rows inside, by part."""
    x = [F.when(inside, F.col("x")[i]) for i in range(SIZE)]
    pairs = [F.avg(x[i] * x[j]) for i in range(SIZE) for j in range(i, SIZE)]
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in x]).alias("mean"), F.array(*pairs).alias("products")
    )


def _estimates(moments: DataFrame) -> DataFrame:
    """Centre and whitening matrix (by rows) of each part, one small row each.

    The matrix is the inverse of the Cholesky factor of the covariance, column by column of both; workers for Python are
    not needed here, so that they may end meanwhile and their memory with them.
    """
    places = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
    product = {(j, i): F.col("products")[at] for at, (i, j) in enumerate(places)}
    cov = {(i, j): x - F.col("mean")[i] * F.col("mean")[j] for (i, j), x in product.items()}
    # Spread below the least counts as the least; correlations stay.
    rows = moments.select("part", "n", "mean", *[(x + F.lit(LEAST_SPREAD[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for (i, j), x in cov.items()])
    for j in range(SIZE):
        rest = {i: F.col(f"c{i}{j}") for i in range(j, SIZE)}
        for k in range(j):
            rest = {i: x - F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for i, x in rest.items()}
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(rest[j]))
        rows = rows.withColumns({f"l{i}{j}": rest[i] / F.col(f"l{j}{j}") for i in range(j + 1, SIZE)})
    for i in range(SIZE):
        made = {f"w{i}{i}": 1 / F.col(f"l{i}{i}")}
        for j in range(i):
            total = F.lit(0.0)
            for k in range(j, i):
                total = total - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
            made[f"w{i}{j}"] = total / F.col(f"l{i}{i}")
        rows = rows.withColumns(made)
    whiten = [F.col(f"w{i}{j}") if j <= i else F.lit(0.0) for i in range(SIZE) for j in range(SIZE)]
    return rows.select("part", "n", "mean", F.array(*whiten).alias("whiten"))


def _distance() -> Column:
    """Squared Mahalanobis distance from ``mean`` and ``whiten``."""
    rows = []
    for i in range(SIZE):
        terms = [F.col("whiten")[SIZE * i + j] * (F.col("x")[j] - F.col("mean")[j]) for j in range(i + 1)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        rows.append(total * total)
    total = rows[0]
    for r in rows[1:]:
        total = total + r
    return total


def _scaled(rows: DataFrame, estimates: DataFrame, quantiles: list[float]) -> DataFrame:
    """Estimates with these quantiles of the distances of all rows of the part."""
    away = rows.join(estimates, "part").select("part", _distance().alias("d"))
    cuts = away.groupBy("part").agg(F.percentile_approx("d", F.array(*map(F.lit, quantiles)), 2000).alias("cuts"))
    return estimates.join(cuts, "part")


def chi_squared(p: float, df: int) -> float:
    """Quantile after Wilson and Hilferty."""
    c = 2 / (9 * df)
    return df * (1 - c + NormalDist().inv_cdf(p) * math.sqrt(c)) ** 3


def fitted(stats: DataFrame, cutoff: float = CUTOFF) -> tuple[dict[str, float], DataFrame]:
    """Mean rates, and by part the estimate: mean, whiten, limit (of the squared distance).

    ``stats`` is read several times, so it should be a written table. Rows: lang, source (no nulls), counts.
    """
    spark = stats.sparkSession
    sound = stats.filter(~base_failed())
    total = sound.agg(*[F.sum(f"counts.{c}").alias(c) for c in COUNTS]).first().asDict()
    n, chars = max(1, total["n_words"] or 0), max(1, total["word_chars"] or 0)
    rates = {
        "length": chars / n,
        "symbols": min(1.0, (total["n_symbols"] or 0) / n),
        "upper": (total["n_upper"] or 0) / chars,
        "marks": min(1.0, (total["n_marks"] or 0) / n),
    }
    rows = written(_grouped(sound.select("lang", "source", _vector(rates).alias("x"), "counts")).select("part", "x"), "quality-vectors")
    quartiles = [F.percentile_approx(F.col("x")[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"q{i}") for i in range(SIZE)]
    start = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *quartiles).filter(F.col("n") >= LEAST_GROUP)
    spread = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(LEAST_SPREAD[i])) for i in range(SIZE)]
    diagonal = [1 / spread[i] if i == j else F.lit(0.0) for i in range(SIZE) for j in range(SIZE)]
    now = start.select("part", "n", F.array(*[F.col(f"q{i}")[1] for i in range(SIZE)]).alias("mean"), F.array(*diagonal).alias("whiten"))
    half = chi_squared(0.5, SIZE)
    for step in range(STEPS + 1):
        # Concentration steps keep the closest; the last one reweights, keeping all but clear outliers.
        last = step == STEPS
        # A written table of a row per part is small enough to meet the rows where they are.
        cuts = written(_scaled(rows, written(now, "quality-step"), [0.5, HELD]), "quality-cuts")
        near = F.col("cuts")[0] / half * chi_squared(0.975, SIZE) if last else F.col("cuts")[1]
        joined = rows.join(cuts.select("part", "mean", "whiten", near.alias("near")), "part")
        inside = _distance() <= F.col("near")
        now = _estimates(_moments(joined, inside))
    limit = F.greatest(F.col("cuts")[0] / half, F.lit(1.0)) * chi_squared(cutoff, SIZE)
    found = _scaled(rows, written(now, "quality-step"), [0.5, HELD]).select("part", "mean", "whiten", limit.alias("limit"))
    parts = _grouped(sound.select("lang", "source")).distinct()
    return rates, written(parts.join(found, "part").select("lang", "source", "mean", "whiten", "limit"), "quality-estimates")


def judged(rows: DataFrame, rates: dict[str, float], estimates: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to rows with lang, source and counts."""
    estimates = estimates.withColumnsRenamed({"lang": "e_lang", "source": "e_source"})
    on = (_named("lang") == F.col("e_lang")) & (_named("source") == F.col("e_source"))
    known = rows.join(estimates, on, "left").withColumn("x", _vector(rates))
    odd = F.coalesce(_distance() > F.col("limit"), F.lit(False))
    judged = known.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~odd)
    return judged.drop("e_lang", "e_source", "mean", "whiten", "limit", "x")


def _statistics(docs: DataFrame) -> DataFrame:
    rows = counted(docs, ["doc_id", "lang", "source"])
    return written(rows.select("doc_id", _named("lang").alias("lang"), _named("source").alias("source"), "counts"), "quality-counts")


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the ``COUNTS``, base_failed, kept.

    Null and empty texts have no words and fail the rules. Null languages and sources are one group each. Repeated rows
    count and come out as often as they are there. Groups below ``LEAST_GROUP``
    documents are judged in pools; where even the pool is smaller, only the rules decide. No documents give no rows.
    """
    stats = _statistics(docs)
    rates, estimates = fitted(stats)
    return judged(stats, rates, estimates).select("doc_id", *[f"counts.{c}" for c in COUNTS], "base_failed", "kept")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of documents that ``quality`` keeps, with all their columns.

    The estimates come from a first pass; the second counts each text again, which spares a join of
    texts by an id that need not be unique.
    """
    rates, estimates = fitted(_statistics(docs))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = counted(docs.select(row), ["row"], within="row").select("row", "row.lang", "row.source", "counts")
    return judged(rows, rates, estimates).filter("kept").select("row.*")
