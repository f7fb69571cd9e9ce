"""The registered queries on the smallest tables, and the pipeline's stages."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from bronzeway.llm import decontam, quality
from bronzeway.llm.queries import ORACLES, QUERIES

from .helpers import kept_bytes, linked_components, repeated_bytes
from .test_dedup import spans_by_hand
from .test_text import ORIGINAL, base_by_hand

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(oracle):
    return oracle.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    got = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(names)
    rows = sorted(repr(tuple(r[n] for n in names)) for r in got.collect())
    assert rows and rows == sorted(map(repr, expected.fetchall()))


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert "pipeline" in driver.queries() and set(QUERIES) <= set(driver.queries())
    assert len(corpus_pipeline.STAGES) == 5


def test_sentence_spans(spark, documents):
    expected = spans_by_hand([r[:2] for r in documents], 3, 18)
    got = QUERIES["op1_sentence_spans"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed, r.kept) for r in got} == {k[0]: v for k, v in expected.items()}


def test_suffix_array(spark, documents):
    expected = repeated_bytes([t for _, t, _ in documents], 200)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_suffix_array"](spark, SF_DIR).collect()}
    assert got == {d[0]: e for d, e in zip(documents, expected)}


def test_html_text(spark):
    rows = QUERIES["op3_html_text"](spark, SF_DIR).collect()
    assert len(rows) == 50 and all(r.n_chars == len(r.text) > 0 for r in rows)
    assert not any("&middot;" in r.text or "©" in r.text or "track(" in r.text for r in rows)


def test_quality(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, SF_DIR).collect()}
    words = quality._vocabularies(quality.read_model(quality.RANKS), quality.read_model(quality.MODEL))
    for key, text, lang in documents:
        assert tuple(rows[key][c] for c in list(quality.MEASURES)[:6]) == base_by_hand(text)
        fit = quality.fertility(*words, text)
        assert tuple(rows[key][c] for c in list(quality.MEASURES)[6:10]) == pytest.approx(fit)
        assert rows[key].kept == (not rows[key].base_failed and quality.judge(text, lang, *fit))
    clean = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1").collect()
    lost = [r.doc_id for r in clean if not rows[r.doc_id].kept and not rows[r.doc_id].base_failed]
    assert lost == []


def test_sentencepiece(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, SF_DIR).collect()}
    for key, text, _ in documents:
        ids = ORIGINAL.encode(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (rows[key].n_tokens, rows[key].ids_sha256, rows[key].round_trip) == (len(ids), digest, True)
        assert rows[key].parity is True


def test_licences(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_licence_scan"](spark, SF_DIR).collect()}
    marks = {"apache": "Apache License", "mit": "MIT License", "gpl": "GNU General Public", "cc": "CC BY"}
    for key, text, _ in documents:
        assert set(rows[key].families.split()) == {f for f, mark in marks.items() if mark in text}


def test_pipeline_stages(spark, oracle):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = oracle.execute("SELECT item_id, text FROM benchmark").fetchall()
    before = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        after = spark.createDataFrame(after.collect(), after.schema)
        seen.append((sorted(before.collect(), key=lambda r: r.doc_id), sorted(after.collect(), key=lambda r: r.doc_id)))
        before = after
    quality_rows, near, cut, decontaminated, encoded = seen
    assert {r.doc_id for r in quality_rows[0]} - {r.doc_id for r in quality_rows[1]} >= {
        r.doc_id for r in quality_rows[0] if base_by_hand(r.text)[-1]
    }
    components = linked_components([(r.doc_id, r.text) for r in near[0]], 5, 80)
    assert [r.doc_id for r in near[1]] == sorted({c for _, c in components})
    expected = kept_bytes([r.text for r in cut[0]], 200)
    assert [r.text for r in cut[1]] == [kept.decode(errors="ignore") for _, kept in expected]
    assert any(any(covered) for covered, _ in expected)
    assert all(r.n_chars == len(r.text) for r in cut[1])
    index = decontam.build_index(items, decontam.Q, decontam.EDIT_RATE)
    held = {r.doc_id for r in decontaminated[0] if decontam.find(index, [decontam.plain(r.text)], decontam.Q)}
    assert [r.doc_id for r in decontaminated[1]] == [r.doc_id for r in decontaminated[0] if r.doc_id not in held]
    assert held and [r.ids for r in encoded[1]] == [ORIGINAL.encode(r.text) for r in encoded[0]]


def test_pipeline_takes_nulls_and_no_rows(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, None, "en", None, None), (2, "a b " * 50, None, "s", 200)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF_DIR).collect()
            assert len(after) <= len(rows)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r.round_trip for r in rows)
