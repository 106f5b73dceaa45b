"""The stages on the smallest tables against plain versions, and the registered queries."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.common import importable, written
from tessera.llm.oracles import ORACLES
from tessera.llm.queries import QUERIES

from test_duplicates import plain_components, plain_repeats
from test_judgements import plain_counts, plain_spans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parents[2]
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def results(spark):
    """What each stage returned, the input first."""
    importable(spark)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF_DIR), name.replace(" ", "-")))
    return [rows.collect() for rows in kept]


@needs_tables
def test_stages_return_documents(results):
    for rows in results[1:-1]:
        assert set(rows[0].__fields__) == set(corpus_pipeline.COLUMNS)
        assert all(r.n_chars == len(r.text) for r in rows[1:])


@needs_tables
def test_quality_rules_reject_whole_documents(results):
    before, after = ({r.doc_id: r for r in rows} for rows in results[:2])
    assert set(after) < set(before)
    for doc, r in after.items():
        n, _, _, _, repeated = plain_counts(r.text)
        assert r.text == before[doc].text and n >= 20 and 100 * repeated <= 30 * n


@needs_tables
def test_one_of_each_group_stays(results):
    groups = plain_components([(r.doc_id, r.text) for r in results[1]], 5)
    assert sorted(r.doc_id for r in results[2]) == [d for d, _, _, kept in groups if kept]


@needs_tables
def test_repeats_go(results):
    plain = {d: (gone, text) for d, _, gone, text in plain_repeats([(r.doc_id, r.text) for r in results[2]], 35)}
    before = {r.doc_id: r.text for r in results[2]}
    got = {r.doc_id: r.text for r in results[3]}
    assert got == {d: text if gone else before[d] for d, (gone, text) in plain.items()}


@needs_tables
def test_personal_data_goes(results):
    before = {r.doc_id: r.text for r in results[3]}
    touched = 0
    for r in results[4]:
        spans = plain_spans(before[r.doc_id])
        if spans:
            touched += 1
            assert r.text != before[r.doc_id] and r.text.count("<") >= 1
        elif "<" not in r.text:
            assert r.text == before[r.doc_id]
    assert touched and len(before) == len(results[4])


@needs_tables
def test_all_tokens_are_packed(results):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in results[4]}
    got = {}
    for r in results[5]:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == wanted


@needs_tables
def test_run_gives_what_the_stages_give(spark, results):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    plain = [(r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows]
    assert sorted(plain) == sorted((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in results[5])


def test_thirteen_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def run_over(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_run_over_an_empty_table(spark, tmp_path):
    assert run_over(spark, tmp_path, []) == []


def test_run_over_rows_without_ids_and_with_repeated_ones(spark, tmp_path):
    def text(salt):
        return " ".join(f"{salt}{'abcdefghij'[i % 10]}{'klmno'[i // 10]}" for i in range(50))

    rows = [
        (None, text("first"), "en", "s", 1), (None, text("first"), "en", "s", 1), (None, text("second"), None, None, None),
        (4, text("third"), "en", "s", 1), (4, text("fourth"), "en", "s", 1), (6, text("first"), "de", "t", 1), (7, None, "en", "s", 0), (8, "", "en", "s", 0),
    ]
    got = run_over(spark, tmp_path, rows)
    # Of the first text the copy with an id stays; the second and both texts of one id stay as well; texts without words are rejected.
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 4), (False, 4), (False, 6), (True, 0)]


def test_the_rest_imports_without_this_package():
    block = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tessera.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'l1_people' in e.queries() and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", block], cwd=ROOT, check=True, timeout=120)
    for library in ("xxhash", "ahocorasick", "public_tokenizers"):
        missing = block.replace("name == 'corpus_pipeline' or name.startswith('tessera.llm')", f"name == {library!r}")
        subprocess.run([sys.executable, "-c", missing], cwd=ROOT, check=True, timeout=120)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    wanted = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF_DIR).toPandas()
    columns = sorted(wanted.columns)
    assert sorted(got.columns) == columns
    rows = [sorted(map(tuple, t[columns].astype(str).itertuples(index=False))) for t in (got, wanted)]
    assert rows[0] == rows[1]
