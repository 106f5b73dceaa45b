"""Near copies, repeated passages and components against plain versions."""

import random
import time
from collections import Counter

import numpy as np
import pytest

from tessera.llm import minhash, shingles, substrings
from tessera.llm.common import importable
from tessera.llm.components import components

SCHEMA = "doc_id long, text string, digest string, key string, rest string, start int"


def corpus(seed=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = ["", None, "  \n", "one", "ONE", "one two", "one two", "x y z a b", "a " * 50]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        texts += [" ".join(base)] * rng.randint(1, 3)
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(("\n" if rng.random() < 0.3 else " ").join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for n in range(6):
        texts.append(" ".join([f"own{n}{i}" for i in range(40)] + passage[n : 55 + n // 2] + [f"end{n}{i}" for i in range(20)]))
    rows = [(i * 3 + 1, t, "d", "k", "r", 7) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def plain_components(rows, length):
    sets = {}
    for doc, text, *_ in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets[doc] = {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


@pytest.mark.parametrize(
    ("seed", "length", "classes", "shingles"), [(0, 4, 2000, 500_000), (1, 5, 2000, 500_000), (2, 4, 3, 500_000), (3, 4, 2000, 150)]
)
def test_near_duplicates_as_all_pairs_say(spark, monkeypatch, seed, length, classes, shingles):
    importable(spark)
    monkeypatch.setattr(minhash, "BLOCK_CLASSES", classes)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs, length).collect())
    assert got == plain_components(rows, length)


def test_near_duplicates_without_ids_and_with_repeated_ones(spark):
    importable(spark)
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (9, "q r s t u v"), (9, "q r s t u v"), (8, "q r s t u v"), (7, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(
        [(None, 3, None, True)] * 2 + [(9, 3, 8, False)] * 2 + [(8, 3, 8, True), (7, 0, 7, True)], key=repr
    )
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), 4).count() == 0


def test_one_of_each_judges_rows_by_their_own_text(spark):
    importable(spark)
    text = "a b c d e f g h"
    rows = [
        (None, text, "x"), (None, text, "y"), (5, text, "z"), (7, text, "z"), (None, "quite another text of words", "x"), (None, None, "x"), (None, "", "w"),
        (9, "one id", "x"), (9, "and two texts", "x"), (9, "one id", "x"), (3, "one id", "x"),
    ]
    got = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, own string"), 5)
    assert got.columns == ["doc_id", "text", "own"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(5, text, "z"), (None, "quite another text of words", "x"), (None, None, "x"), (None, "", "w"), (9, "and two texts", "x"), (3, "one id", "x")],
        key=repr,
    )
    assert minhash.one_of_each(got.limit(0), 5).count() == 0


def test_links_hold_the_components_together():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: 100 - k], rng.integers(0, 2**63, k, dtype=np.uint64)])) for k in range(0, 60, 4)]
    near = {
        (i, j) for i in range(len(sets)) for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    links = minhash.linked(sets, 0, 80)
    assert set(links) <= near and len(links) < len(sets)
    cross = minhash.linked(sets, 7, 80)
    assert all(i >= 7 > j for i, j in cross) and set(cross) <= near
    assert minhash.linked(sets, 0, 80, [5] * len(sets)) == []


def parts_of(m, links):
    root = list(range(m))
    for i, j in links:
        a, b = root[i], root[j]
        root = [a if r == b else r for r in root]
    return {frozenset(k for k in range(m) if root[k] == r) for r in root}


@pytest.mark.parametrize("seed", range(4))
def test_links_of_many_sets_make_the_components_of_all_pairs(seed):
    rng = np.random.default_rng(seed)
    bases = [np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64)) for _ in range(2)]
    sets = []
    for _ in range(150):
        base = bases[rng.integers(0, 2)]
        kept = rng.random(len(base)) > rng.choice([0.02, 0.1, 0.15, 0.4])
        sets.append(np.unique(np.concatenate([base[kept], rng.integers(0, 2**63, int(rng.integers(0, 8)), dtype=np.uint64)])))
    pairs = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    ]
    assert parts_of(len(sets), minhash.linked(sets, 0, 80)) == parts_of(len(sets), pairs)
    labels = [min(part) for k in range(len(sets)) for part in parts_of(len(sets), pairs[::3]) if k in part]
    assert parts_of(len(sets), [*pairs[::3], *minhash.linked(sets, 0, 80, labels)]) == parts_of(len(sets), pairs)
    cross = [(i, j) for i, j in pairs if i >= 70 > j]
    assert parts_of(len(sets), minhash.linked(sets, 70, 80)) == parts_of(len(sets), cross)


def test_many_near_copies_are_compared_once_each():
    rng = np.random.default_rng(0)
    base = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    sets = []
    for _ in range(2000):
        copy = base.copy()
        copy[rng.integers(0, 1000, 20)] = rng.integers(0, 2**63, 20, dtype=np.uint64)
        sets.append(np.unique(copy))
    started = time.perf_counter()
    assert len(minhash.linked(sets, 0, 80)) == 1999
    assert time.perf_counter() - started < 5


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_repeats(rows, length):
    seen = Counter()
    words = [(text or "").split() for _, text, *_ in rows]
    for w in words:
        seen.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = []
    for (doc, *_), w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for j in range(i, i + length)}
        out.append((doc, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "length"), [(0, 35), (1, 20)])
def test_repeats_as_counting_all_stretches_says(spark, seed, length):
    importable(spark)
    rows = [*corpus(seed), *corpus(seed)[:3], (None, "no id", "d", "k", "r", 7)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    done = substrings.without_repeats(docs, length)
    assert sorted(done.columns) == sorted([*docs.columns, "n_words", "n_removed"])
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in done.collect()), key=repr)
    assert got == plain_repeats(rows, length)
    kept = {(r.doc_id, r.text) for r in substrings.without_repeats(docs, length, layout=True).collect()}
    for (doc, text, *_), (_, _, gone, _) in zip(sorted(rows, key=repr), sorted(plain_repeats(rows, length), key=repr), strict=False):
        if doc is None:
            assert (doc, text) in kept
    assert substrings.without_repeats(docs.limit(0), length).count() == 0


def test_seeds_hit_every_stretch():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**63, 500, dtype=np.uint64)
    words[200:260] = words[3]  # equal words, so ties
    hashes, places = substrings.seeds(words, 35)
    assert len(hashes) == len(places)
    for i in range(len(words) - 34):
        inside = (places >= i) & (places + substrings.SEED <= i + 35)
        assert inside.any()
    again = substrings.seeds(np.concatenate([rng.integers(0, 2**63, 77, dtype=np.uint64), words[100:135]]), 35)[0]
    assert set(again.tolist()) & set(hashes.tolist())


def test_hashes_of_stretches_follow_from_their_words_alone():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 2**63, 400, dtype=np.uint64)
    words[200:300] = words[50:150]
    starts, stops = np.arange(365), np.arange(365) + 35
    for salt in (0, 1, 2):
        hashes = shingles.stretch_hashes(words, starts, stops, salt)
        assert (hashes[200:266] == hashes[50:116]).all() and len(np.unique(hashes)) == 365 - 66
    assert len({int(shingles.stretch_hashes(words, np.array([9]), np.array([k]))[0]) for k in range(9, 100)}) == 91
    assert not set(shingles.stretch_hashes(words, starts, stops, 1)) & set(shingles.stretch_hashes(words, starts, stops, 2))
