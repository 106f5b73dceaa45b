"""Token counts against the library, periodic runs and whitening against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries, runs, token_counts, whitening
from tessera.llm.common import importable

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, key string, n_words int, runs string, x int"


def rows_of(texts):
    return [(i, t, "k", 7, "r", 1) for i, t in enumerate(texts)]


# -- token counts ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(spark, library, monkeypatch):
    importable(spark)
    rng = random.Random(1)
    parts = [
        "a", "B", "é", "é", "ß", " ", "  ", "\n", "\t", "\x85", "\xa0", " ", "　", "\x1c", "1", "²", "٣",
        "<|endoftext|>", "'s", "'ll", "'", "字", "한", "\U0001f600", "՘", "​", "﻿", "\U0003fc3b", "the", "ing", "!", "...",
    ]
    texts = ["", None, " ", "<|endoftext|>", "x" * 3000, "word " * 4000, "\n" * 2000, "a字 " * 900]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    texts += texts[-3:]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in token_counts.token_counts(docs, BYTE_BPE, 512).collect())
    assert got == [(i, len((t or "").encode()), library(t), library(t) > 512) for i, t in enumerate(texts)]
    assert token_counts.token_counts(docs.limit(0), BYTE_BPE, 512).count() == 0
    no_id = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in token_counts.token_counts(no_id, BYTE_BPE, 1).collect()) == [(0, 0, False), (3, 2, True)]


def test_long_texts_are_counted_by_stretches_and_little_is_kept(library, monkeypatch):
    monkeypatch.setattr(token_counts, "STRETCH", 50)
    counter = token_counts.TokenCounter(BYTE_BPE, kept_bytes=1000)
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["ab", "xq", " ", "  ", "\n", "　", "字", "1", "!", "'s"]) for _ in range(400))
        assert counter.count(text) == library(text)
        assert counter._room >= 0


def test_whole_tokens_are_those_that_stay_one(library):
    counter = token_counts.TokenCounter(BYTE_BPE)
    assert " the" in counter.whole and "<|endoftext|>" not in counter.whole
    assert all(library(t) == 1 for t in random.Random(0).sample(sorted(counter.whole), 300))


# -- periodic runs --------------------------------------------------------------------------------


def plain_runs(words):
    """Every stretch that keeps a period as long as it can, with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q) and i > start:
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words):
    gone = {i for s, length, q in plain_runs(words) for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    words = [rng.choice("abcde"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 70))]
    if words and rng.random() < 0.6:
        a = rng.randrange(len(words))
        p = rng.randint(1, max(1, (len(words) - a) // rng.randint(2, 6)))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("block", [200_000, 40])
def test_runs_as_trying_all_periods_says(spark, monkeypatch, block):
    importable(spark)
    monkeypatch.setattr(runs, "BLOCK_WORDS", block)
    rng = random.Random(block)
    texts = ["", None, " \n", "one", "a " * 5, "a " * 6, "a " * 5000, "a b " * 3000 + "c", "  é " * 9]
    texts += [(" " if rng.random() < 0.7 else "\n\t").join(repetitive(rng)) for _ in range(300)]
    texts += texts[-2:]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    got = {r.doc_id: r for r in runs.document_runs(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = [w.decode() for w in (text or "").encode().split()]
        if len(words) < 1000:
            assert [tuple(r) for r in got[i].runs] == plain_runs(words), words
            assert (got[i].n_words, got[i].collapsed) == (len(words), plain_collapsed(words))
    assert [tuple(r) for r in got[6].runs] == [(0, 5000, 1)] and got[6].collapsed == "a"
    assert [tuple(r) for r in got[7].runs] == [(0, 6000, 2)] and got[7].collapsed == "a b c"
    assert runs.document_runs(docs.limit(0)).count() == 0
    no_id = spark.createDataFrame([(None, "a " * 6)], "doc_id long, text string")
    assert [tuple(r.runs[0]) for r in runs.document_runs(no_id).collect()] == [(0, 6, 1)]


def test_words_are_numbered_anew_only_between_blocks():
    numbers = runs.WordNumbers(kept_bytes=300)
    first = numbers.of([b"a", b"b", b"c", b"d", b"a"])
    assert first[0] == first[4] and len(set(first.tolist())) == 4
    numbers.tidy()
    assert numbers.of([b"d"]).tolist() == [0]


def test_repeated_stretches_of_the_query(spark, tmp_path):
    importable(spark)
    rng = random.Random(5)
    texts = [None, "", " ", "one", *[" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))) for _ in range(400)]]
    spark.createDataFrame(rows_of(texts), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    changed = 0
    for i, text in enumerate(texts):
        words, h = (text or "").split(), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        found = plain_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        wanted = (i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
        hashes = tuple(hashlib.sha256(t.encode()).hexdigest() for t in (lines, plain_collapsed(words)))
        assert tuple(got[i]) == (*wanted, *hashes)
    assert changed > 20


# -- whitening ------------------------------------------------------------------------------------


def triangles():
    rng = np.random.default_rng(0)
    for kind in range(6):
        for _ in range(12):
            d, n = int(rng.integers(1, 40)), int(rng.integers(1, 80))
            x = rng.normal(size=(n, d))
            if kind == 1:
                x = x * np.logspace(0, -12, d)
            elif kind == 2:
                x = x[:, :3] @ rng.normal(size=(x[:, :3].shape[1], d))
            elif kind == 3:
                x = np.repeat(np.eye(d), 2, axis=0)
            elif kind == 4:
                x = np.round(x * 3)
            elif kind == 5:
                x = np.concatenate([np.eye(d), -np.eye(d)]) * np.r_[np.full(d // 2, 3.0), np.ones(d - d // 2)]
            r = np.linalg.qr(x, mode="r")
            yield x, np.concatenate([r, np.zeros((max(0, d - len(r)), d))])


def test_components_as_the_singular_value_decomposition_says():
    for x, r in triangles():
        d = r.shape[1]
        values, vectors = whitening.components_of(r, 4)
        wanted = np.concatenate([np.linalg.svd(x, compute_uv=False) ** 2, np.zeros(d)])[: len(values)]
        assert len(values) == min(4, d) and np.abs(values - wanted).max() <= 1e-13 * wanted[0]
        real = values > 1e-20 * values[0]
        z = vectors[:, real]
        assert np.abs(x.T @ x @ z - z * values[real]).max() <= 1e-12 * wanted[0]
        assert np.abs(z.T @ z - np.eye(real.sum())).max() <= 1e-12
    assert whitening.components_of(np.zeros((3, 3)), 4)[0].tolist() == [0, 0, 0]


def test_small_singular_values_keep_their_digits():
    diagonal, above = np.array([1.0, 1e-3, 1e-7, 1e-11]), np.array([1e-2, 1e-5, 1e-9])
    got = np.sqrt(whitening.dqds(diagonal, above))
    assert np.prod(got) == pytest.approx(np.prod(diagonal), rel=1e-13)  # the determinant


def plain_whitening(vectors, scale, count):
    x = {i: tuple(int(np.floor(scale * float(np.float32(c)))) for c in v) for i, v in vectors}
    fit = np.array(sorted(set(x.values())), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:count], directions[:, ::-1][:, :count]
    out = {}
    for i, row in x.items():
        off = [n * a - int(s) for a, s in zip(row, sums, strict=True)]
        out[i] = (n, sum(v * v for v in off), (np.array(row) - sums / n) @ directions / np.sqrt(values))
    return out, values / np.trace(centred.T @ centred / n)


def test_whitening_as_plain_eigenvectors_say(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(whitening, "FAN", 2)  # several rounds of stacks
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 100)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(300, 12)) * np.linspace(1, 0.1, 12)) @ rng.normal(size=(12, 12))
    rows = [(i, [float(c) for c in v], "z") for i, v in enumerate(x.astype(np.float32))]
    copies = [(1000 + i, rows[5][1], "z") for i in range(200)]
    bad = [(2000, None, "z"), (2001, [None] * 12, "z"), (2002, [float("nan")] * 12, "z"), (2003, [float("inf")] * 12, "z"), (2004, [], "z"),
           (2005, [1.0], "z")]
    frame = spark.createDataFrame(rows + copies + bad, "vec_id long, embedding array<float>, component string").repartition(7)
    got = whitening.whitened(frame, "vec_id", "embedding", 256, 4).collect()
    wanted, shares = plain_whitening([(i, v) for i, v, _ in rows + copies], 256, 4)
    assert len(got) == 4 * len(wanted)
    signs = {}
    for r in sorted(got, key=lambda r: (r.vec_id, r.component)):
        n, deviation, white = wanted[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-10)
        assert r.identity_error < 1e-10
        sign = signs.setdefault(r.component, 1 if white[r.component - 1] * r.whitened >= 0 else -1)
        assert r.whitened * sign == pytest.approx(white[r.component - 1], abs=1e-9)
    assert len({r.identity_error for r in got}) == 1


def test_whitening_of_little(spark):
    importable(spark)
    schema = "vec_id long, embedding array<float>"

    def result(rows):
        found = whitening.whitened(spark.createDataFrame(rows, schema), "vec_id", "embedding", 256, 4).collect()
        return sorted((tuple(r) for r in found), key=repr)

    assert result([]) == [] and result([(1, None), (2, [])]) == []
    assert result([(1, [0.5, 2.0]), (None, [0.5, 2.0])]) == sorted(
        [(i, c, 1, 0, None, None, None) for i in (1, None) for c in (1, 2)], key=repr
    )
    on_a_line = result([(1, [0.0, 0.0]), (2, [1.0, 0.0])])
    assert [(r[0], r[1], r[3]) for r in on_a_line] == [(1, 1, 65536), (1, 2, 65536), (2, 1, 65536), (2, 2, 65536)]
    assert [abs(r[4]) if r[4] is not None else None for r in on_a_line] == [1.0, None, 1.0, None]
    huge = result([(1, [1e30, 0.0]), (2, [0.0, 1e30]), (3, [-3e9, 1.0])])
    assert len(huge) == 6 and {r[2] for r in huge} == {3}
