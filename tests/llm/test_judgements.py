"""Quality, personal data, toxicity, search and chats against plain versions."""

import math
import random
import time
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import chat, kdtree, pii, quality, toxicity
from tessera.llm.common import importable

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    importable(spark)


# -- quality --------------------------------------------------------------------------------------


def plain_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


def test_counts_of_any_text():
    rng = random.Random(0)
    for _ in range(300):
        parts = [rng.choice(["a", "bé", "日", "#|", "\n", " ", "\x0b", "\xa0", "\x1f", "a b c d e f g h\n", "x x x x x x x x x "]) for _ in range(rng.randint(0, 40))]
        text = "".join(parts)
        assert quality.counts_of(text.encode())[:5] == plain_counts(text)


def prose(rng, n):
    return " ".join(rng.choice(["the", "cat", "sat", "on", "mats", "while", "dogs"]) + (rng.choice(".,") if rng.random() < 0.1 else "") + rng.choice("abcdefgh") for _ in range(n))


def quality_rows():
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(40, 300)), "en", rng.choice(["a", "b", None])) for i in range(400)]
    rows += [(1000 + i, " ".join(w + "%%%" for w in prose(rng, 100).split()), "en", "a") for i in range(20)]
    rows += [(2000, None, None, None), (2001, "", "en", "a"), (2002, "few words", "xx", "rare"), (2003, prose(rng, 60), "xx", "rare")]
    rows += [(2004, "same eight words come here again and again " * 10, "en", "a"), (None, prose(rng, 80), "en", "a")]
    return rows


def test_rules_and_outliers(spark):
    rows = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        r = got[doc]
        counts = plain_counts(text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r.base_failed and r.kept)
    assert not any(got[1000 + i].kept for i in range(20))
    assert sum(got[i].kept for i in range(400)) >= 396
    assert got[2003].kept and got[None].kept


def test_good_documents_keep_their_columns(spark):
    docs = spark.createDataFrame(
        [(*r, 1, 2.0, "z") for r in quality_rows()], "doc_id long, text string, lang string, source string, kept int, counts double, row string"
    )
    kept = quality.good_documents(docs)
    assert kept.schema == docs.schema
    wanted = {r.doc_id for r in quality.quality(docs).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == wanted
    assert quality.good_documents(docs.limit(0)).count() == 0
    assert quality.quality(docs.limit(0)).count() == 0


def test_chi_squared_quantiles():
    assert math.isclose(quality.chi_squared(0.5, 5), 4.351, rel_tol=0.01)
    assert math.isclose(quality.chi_squared(0.9999, 5), 25.74, rel_tol=0.03)


def test_estimates_of_parts_need_no_python(spark):
    rng = np.random.default_rng(3)
    rows, wanted = [], {}
    for part in "abc":
        x = rng.normal(size=(60, quality.SIZE)) @ rng.normal(size=(quality.SIZE, quality.SIZE))
        if part == "c":
            x[:, 1:] = x[:, :1]  # no spread but along one line
        rows += [(part, r.tolist()) for r in x]
        cov = np.cov(x.T, bias=True) + np.diag(np.square(quality.LEAST_SPREAD))
        wanted[part] = x.mean(axis=0), np.linalg.inv(np.linalg.cholesky(cov))
    table = spark.createDataFrame(rows, "part string, x array<double>").localCheckpoint()
    found = quality._estimates(quality._moments(table, quality.F.lit(True)))
    assert not re.search("Pandas|Arrow|Python", found._jdf.queryExecution().executedPlan().toString())
    got = {r.part: r for r in found.collect()}
    assert set(got) == set(wanted)
    for part, (mean, whiten) in wanted.items():
        assert got[part].n == 60 and np.allclose(got[part].mean, mean)
        assert np.allclose(np.reshape(got[part].whiten, whiten.shape), whiten, rtol=1e-6, atol=1e-9)


def test_texts_go_to_python_once(spark, monkeypatch):
    seen = []

    def counted(docs, *args, **named):
        rows = found(docs, *args, **named)
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows

    found = quality.counted
    monkeypatch.setattr(quality, "counted", counted)
    docs = spark.createDataFrame([(1, "a b c", "en", "web")], "doc_id long, text string, lang string, source string")
    quality.good_documents(docs)
    below = seen[-1].split("MapInArrow")[1]
    assert len(re.findall(r"text#\d+(?= AS k|,| AS text)", below.split("LogicalRDD")[0].split("LocalRelation")[0])) == 1, below


# -- personal data --------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in sorted(out))


def pii_rows():
    rng = random.Random(6)
    bits = [
        "a@b.c", "x@a_b@c.d", "@", ".", "a.b+c@d-e.f.g", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "007.0000.1.255", "4111111111111111",
        "4111 1111 1111 1111", "41111111-11111111", "4539578763621486 4539578763621486", "1", "12", " ", "-", "+1 (555) 123-4567", "+1", "+49.30.1234567",
        "日", "😀", "é", "\n", "word", "call me: 555-123-4567", "mail me at joe [at] site [dot] com", "000000000000", "1234567890123",
    ]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " ", ""]) for _ in range(rng.randint(1, 12)))) for i in range(400)]
    return [*rows, (1000, None), (1001, ""), (None, "a@b.c"), (1002, "1" * 30_000), (1003, "a" * 30_000), (1004, "a@" + "b." * 10_000 + "c")]


def test_base_spans_as_the_plain_patterns_say(spark):
    rows = pii_rows()
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        r = got[doc]
        wanted = plain_spans(text or "")
        assert r.base == wanted, text
        kinds = Counter(s.split(":")[0] for s in wanted.split(",") if s)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in PLAIN)
        assert set(wanted.split(",")) <= set(r.spans.split(",")) | {""}


def plain_choice(spans, surer):
    """Base spans, and of the others, by start, those that overlap nothing taken and no base span."""
    taken = [(a, k, b) for a, k, b, base in spans if base]
    for a, k, b, base in sorted(spans):
        if not base and (a, k, b) in surer and not any(x < b and a < y for x, _, y in taken):
            taken.append((a, k, b))
    return sorted(taken)


def test_added_spans_overlap_nothing(spark):
    rng = random.Random(4)
    rows, wanted = [], {}
    for doc in range(200):
        spans, surer = [], set()
        for _ in range(rng.choice([0, 1, 5, 40, 90])):
            a, k = rng.randrange(300), rng.randrange(4)
            b, base, sure = a + rng.randint(1, 25), rng.random() < 0.3, rng.random() < 0.7
            if all((a, k, b) != s[:3] for s in spans):
                spans.append((a, k, b, base))
                surer |= {(a, k, b)} if sure else set()
        votes = {s: [1 if s[:3] in surer else -1] * 5 for s in spans}
        rows.append((doc, [(a, b, k, base, votes[a, k, b, base]) for a, k, b, base in spans]))
        wanted[doc] = plain_choice(spans, surer)
    frame = spark.createDataFrame(rows, "doc_id long, spans array<struct<start: int, end: int, kind: int, base: boolean, votes: array<int>>>")
    weights = [[0.0, *[9.0] * 5, *[-9.0] * 5]] * 4
    got = {r.doc_id: [tuple(s) for s in r.chosen] for r in pii._with_chosen(frame, weights, 0.9).collect()}
    assert got == wanted


def test_one_text_with_very_many_spans(spark):
    text = " ".join(f"10.{i % 250}.{i % 99}.7 mail u{i}@x.org" for i in range(12_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.perf_counter()
    row = pii.personal_data(docs).collect()[0]
    assert (row.n_email, row.n_ip) == (12_000, 12_000) and row.base == plain_spans(text)
    masked = pii.masked(docs).collect()[0].text
    assert masked == " ".join(["<IP> mail <EMAIL>"] * 12_000)
    assert time.perf_counter() - started < 60


def test_masks_cover_the_spans(spark):
    docs = spark.createDataFrame([(*r, "x", "y") for r in pii_rows()], "doc_id long, text string, spans string, body string")
    done = pii.masked(docs)
    assert done.columns == docs.columns
    rows = {r.doc_id: r for r in done.collect()}
    assert len(rows) == docs.count() and rows[1000].text == "" and rows[None].text == "<EMAIL>"
    assert rows[1003].text == "a" * 30_000 and rows[1004].text == "<EMAIL>"
    for r in rows.values():
        left = plain_spans(r.text).split(",")
        assert not any(s.startswith(("email", "ip")) for s in left)
    assert pii.masked(docs.limit(0)).count() == 0
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_plan_of_personal_data_has_no_python(spark):
    docs = spark.createDataFrame(pii_rows(), "doc_id long, text string")
    for rows in (pii.personal_data(docs), pii.masked(docs)):
        assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_labelers_that_agree_are_found_reliable():
    rng = random.Random(2)
    counts = Counter()
    for _ in range(4000):
        y = rng.random() < 0.5
        right = [0.95, 0.8, 0.9, 0.6, 0.5]
        counts[tuple((1 if (rng.random() < p) == y else -1) if rng.random() < 0.9 else 0 for p in right)] += 1
    model = pii.LabelModel.estimate(counts)
    said = [yes[1] / (yes[1] + yes[-1]) for yes, _ in model.given]
    assert said[0] > 0.88 and said[2] > 0.83 and abs(said[4] - 0.5) < 0.1
    weights = pii.trained(counts)
    assert weights[1] > weights[5] and pii.trained({})[0] < -2


# -- toxicity -------------------------------------------------------------------------------------


def toxic_rows():
    rng = random.Random(9)
    parts = ["tal", "mor", "ven", "sil", "dra", "kel", "pon", "wis", "fer", "gan", "hul", "jat"]
    harmless = [a + b + c for a in parts for b in parts for c in ("an", "en", "or", "is", "um", "ed", "ak")]
    bad = ["grumhead", "slimer", "blorgar", "blorgen", "blorgis", "blorgum"]
    docs, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.2
        words = [rng.choice(harmless) for _ in range(rng.randint(20, 80))]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "", ".", "!"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_scores_of_held_out_rows(spark):
    docs, labels = toxic_rows()
    extra = [(None, "grumhead slimer you"), (-1, None), (-2, ""), (5, docs[5][1])]
    table = spark.createDataFrame(docs + extra, "doc_id long, text string")
    known = spark.createDataFrame(labels[:1200] + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(table, known).collect()
    assert len(got) == len(docs) + len(extra)
    by_id = {r.doc_id: r for r in got}
    for doc, _ in docs:
        assert by_id[doc].held_out == (zlib.crc32(str(doc).encode()) % 4 == 2)
    truth = dict(labels)
    tested = [r for r in got if r.doc_id in truth and (r.held_out or r.doc_id >= 1200)]
    right = sum(r.predicted == truth[r.doc_id] for r in tested)
    assert right >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert by_id[None].predicted == 1 and by_id[-1].score == by_id[-2].score < 0.3


def plain_posteriors(say, labels, parents, prior, rounds):
    """Expectation-maximisation of voters that depend on a parent's vote (0 where there is none), row by row and vote by vote."""
    share = [0.95 if y else 0.05 for y in labels]
    for _ in range(rounds):
        chance = {}
        for c in (0, 1):
            weight = [s if c else 1 - s for s in share]
            for j, parent in enumerate(parents):
                seen = Counter()
                for w, row in zip(weight, say, strict=True):
                    seen[row[parent] if parent >= 0 else 0, row[j]] += w
                for v in (0, 1, -1):
                    alone = (sum(seen[p, v] for p in (0, 1, -1)) + (2 if v == (1 if c else -1) else 1)) / (sum(weight) + 4)
                    for p in (0, 1, -1):
                        chance[c, j, p, v] = (seen[p, v] + 2 * alone) / (sum(seen[p, u] for u in (0, 1, -1)) + 2)
        share = []
        for row in say:
            votes = [(j, row[p] if p >= 0 else 0, row[j]) for j, p in enumerate(parents)]
            both = [(prior if c else 1 - prior) * math.prod(chance[c, *vote] for vote in votes) for c in (0, 1)]
            share.append(both[1] / sum(both))
    return share


def made_votes(rows=600, wrong=0.1):
    """Three voters of known accuracy, and labels of which some are wrong."""
    rng = np.random.default_rng(3)
    truth = rng.random(rows) < 0.3
    votes = np.column_stack([np.where(rng.random(rows) < right, np.where(truth, 1, 0), np.where(truth, 0, 1)) for right in (0.9, 0.85, 0.8)])
    return truth, votes, np.where(rng.random(rows) < wrong, ~truth, truth).astype(int)


@pytest.mark.parametrize("parents", [[-1, -1, -1, -1], [-1, 0, 1, -1], [2, -1, 1, -1]])
def test_posteriors_as_the_plain_model_has_them(parents):
    _, votes, labels = made_votes()
    say = np.column_stack([votes, np.where(labels == 1, 1, -1)])
    share = np.where(labels == 1, 0.95, 0.05)
    for _ in range(6):
        share = toxicity.estimated(say, np.array(parents), share, 0.3).posterior(say)
    np.testing.assert_allclose(share, plain_posteriors(say.tolist(), labels.tolist(), parents, 0.3, 6), atol=1e-9)


def test_a_vote_counts_for_what_it_adds_to_its_parents():
    truth, votes, labels = made_votes(2000)
    copied = np.column_stack([votes, *[votes[:, :1]] * 5])
    parents = toxicity.dependent(copied, truth.astype(float))
    copies = [0, 3, 4, 5, 6, 7]
    assert sum(parents[j] in copies for j in copies) == 5 and all(parents[j] == -1 for j in (1, 2))
    _, once = toxicity.label_model(votes, labels, 0.3)
    _, often = toxicity.label_model(copied, labels, 0.3)
    assert np.abs(once - often).mean() < 0.03


def test_the_label_is_a_voter_whose_accuracy_is_estimated():
    truth, votes, labels = made_votes(4000, wrong=0.1)
    model, share = toxicity.label_model(votes, labels, 0.3)
    assert abs(model.chances[1, -1, 0, 1] - 0.9) < 0.05 and abs(model.chances[0, -1, 0, 2] - 0.9) < 0.05
    assert ((share > 0.5) != truth).mean() < (labels != truth).mean() - 0.02  # it mends wrong labels


def test_nothing_to_learn_from_scores_next_to_nothing(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, 0)]):
        got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert [r.predicted for r in got] == [0, 0]
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


# -- search ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("shard", [8_000, 70])
def test_top_k_as_all_products_say(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "LEAF", 16)
    rng = np.random.default_rng(5)
    vectors = [(i, (rng.normal(size=6) / 2).tolist()) for i in range(400)]
    vectors += [(1000 + i, [0.5] * 6) for i in range(60)]
    odd = [(2000, None), (2020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2040, [float("nan")] * 6), (2060, [float("inf")] + [0.0] * 5), (None, [9.0] * 6), (2080, [1.0, 2.0])]
    table = spark.createDataFrame(vectors + vectors[:7] + odd, "vec_id long, embedding array<double>").repartition(3)
    got = [tuple(r) for r in kdtree.top_k(table, "embedding", kdtree.F.col("vec_id") % 20 == 0, k=5, shard_vectors=shard).collect()]
    whole = {i: [math.floor(64 * x) for x in v] for i, v in vectors}
    wanted = []
    for q in [i for i in whole if i % 20 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        wanted += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(got) == sorted(wanted)
    assert kdtree.top_k(table.limit(0), "embedding", kdtree.F.col("vec_id") % 20 == 0).count() == 0


def test_small_shards_and_empty_vectors(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "LEAF", 4)
    is_query = kdtree.F.col("vec_id") % 20 == 0
    schema = "vec_id long, embedding array<double>, shard string, cell int, size int"
    far = [(i, [1.0 if i < 50 else -1.0, i / 100], "s", 1, 1) for i in range(100)]
    # Shards that queries alone come to, and more empty vectors than a leaf holds.
    empty = [(1000 + i, [], "s", 1, 1) for i in range(30)]
    table = spark.createDataFrame(far + empty, schema)
    got = sorted(tuple(r) for r in kdtree.top_k(table, "embedding", is_query, k=3, shard_vectors=5).collect())
    whole = {i: [math.floor(64 * x) for x in v] for i, v, *_ in far + empty}
    wanted = []
    for q in [i for i in whole if i % 20 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        wanted += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:3], 1)]
    assert got == sorted(wanted)


def test_queries_go_only_where_a_box_allows(spark):
    rng = np.random.default_rng(1)
    centres = np.array([[x, y, z, 0] for x in (-5, 5) for y in (-5, 5) for z in (-5, 5)])
    rows = [(i, (centres[i % 8] + rng.normal(size=4) / 20).tolist()) for i in range(1600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    placed = kdtree._in_cells(kdtree.whole_numbers(table, "embedding", 64), 200)
    boxes = kdtree._boxes(placed)
    assert len(boxes[4][0]) == 8 == placed.select("cell").distinct().count()
    asked = placed.filter("vec_id < 80").selectExpr("*", "0 as number", "cast(250000 as double) as floor")
    assert kdtree._to_search(asked, boxes).count() == 80  # of 640
    assert kdtree._to_search(asked.withColumn("floor", kdtree.F.lit(None).cast("double")), boxes).count() == 640


# -- chats ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "<|turn|>", "<\\|says|>", "<\\\\|", "a <|done|>", "<|", "|>", "<", "\\", "</s>[INST] ok [/INST]"])
def test_escapes_undo(text):
    assert "<|" not in chat.escaped(text) and chat.unescaped(chat.escaped(text)) == text


def test_chats_read_back(spark):
    hard = ["<|turn|>user<|says|>", "é日😀 \n\n", " leading", "<\\|done|>", "", None, "<|endoftext|>", "</s>[INST] ok [/INST]", "trailing<"]
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|done|>"]), rng.choice(hard), "x") for c in [*range(30), None] for t in range(rng.randint(1, 6))]
    rows += [(50, None, "assistant", "first", "x"), (50, 0, "assistant", "second", "x"), (50, 0, "assistant", "second", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string").repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(table, BYTE)).collect()}
    assert len(got) == 32
    for conv, r in got.items():
        turns = sorted(((-1 if t is None else t), role or "", text or "") for c, t, role, text, _ in rows if c == conv)
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in turns]
        assert r.loss_text == "".join(text for _, role, text in turns if role == "assistant")
    assert chat.formatted(table.limit(0), BYTE).count() == 0


def test_masks_are_those_of_comparing_all():
    rng = random.Random(1)
    for _ in range(200):
        edges = sorted(rng.sample(range(60), 12))
        spans = [(edges[i], edges[i + 1]) for i in range(0, 12, 2)]
        cuts = [0, *sorted(rng.sample(range(1, 60), 20)), 60]
        starts, ends = np.array(cuts[:-1]), np.array(cuts[1:])
        plain = [any(a < e and s < b for s, e in spans) for a, b in zip(starts, ends, strict=True)]
        assert chat.mask_of(starts, ends, spans).tolist() == plain
