"""The registered queries on the small tables: SQL where there is some, else what holds."""

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from brindle.llm.queries import ORACLE, QUERIES

BASE = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "conversations"):
        connection.execute(f"create view {table} as select * from '{BASE}/{table}.parquet'")
    yield connection
    connection.close()


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert [int(n.split("_")[0][2:]) for n in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sql, name):
    got = QUERIES[name](spark, BASE)
    want = sql.sql(ORACLE[name]).select(", ".join(got.columns))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_toxicity_on_held_out_rows(spark, sql):
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.1/labels.parquet'").fetchall()
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_language_on_held_out_rows(spark, sql):
    got = {r.doc_id: r for r in QUERIES["op7_language"](spark, BASE).collect()}
    langs = sql.sql("select doc_id, lang from documents").fetchall()
    held = [got[i].lang_pred == x for i, x in langs if got[i].held_out]
    assert len(got) == len(langs) and sum(held) / len(held) > 0.97


def test_every_item_found_word_for_word_is_a_hit(spark, sql):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, BASE).collect()}
    want = set(sql.sql("select doc_id, item_id from documents d, benchmark b where contains(d.text, b.text)").fetchall())
    assert want and want <= got and len(got) <= len(want) + 3


def test_quality_keeps_good_documents(spark, sql):
    got = {r.doc_id: r for r in QUERIES["op3_quality"](spark, BASE).collect()}
    labels = sql.sql("select doc_id, quality from labels").fetchall()
    assert len(got) == 1000
    assert sum(got[i].kept for i, q in labels if q) / sum(q for _, q in labels) > 0.98
    assert sum(not got[i].kept for i, q in labels if not q) / sum(1 - q for _, q in labels) > 0.6


def test_licenses_are_found(spark, sql):
    got = QUERIES["op1_licenses"](spark, BASE).collect()
    want = sql.sql("select doc_id from documents where contains(text, 'Released under the MIT License.')").fetchall()
    assert {r.doc_id for r in got if r.license == "mit"} == {i for i, in want}


def test_pipeline_stage_by_stage(spark, sql):
    """Each stage against what the operators' own tests hold them to, on its own input."""
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, BASE), "test-stage")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if name == "line dedup":
            assert set(after) == set(before)
            assert all(set((r.text or "").split("\n")) <= {*before[i].text.split("\n"), ""} for i, r in after.items())
            assert all(r.n_chars == len(r.text) for r in after.values())
            lines = [x.strip().translate(LOWER) for r in after.values() for x in r.text.split("\n") if x.strip()]
            assert len(lines) == len(set(lines))
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "benchmark decontamination":
            items = [t for t, in sql.sql("select text from benchmark").fetchall()]
            assert not any(t in r.text for r in after.values() for t in items)
        before = after
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, BASE).collect()
    assert {r.doc_id for r in ids} == set(before) and all(len(r.ids) == r.n_tokens for r in ids)
