"""The pipeline's stages on tables with everything that may be wrong with them."""

import random

import pytest

import corpus_pipeline
from tests.llm.helpers import awkward

BASE = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, doc string, gone int, key string, removed string"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t), 7, "d", 8, "k", "r") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmno", k=draw.randrange(2, 9))) for _ in range(n)) + "."


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_and_awkward_tables(spark, name, tmp_path):
    texts = awkward()
    ids = [*range(12), *[None] * (len(texts) - 14), 3, 3]
    for k, rows in enumerate((documents(spark, []), documents(spark, texts, ids))):
        place = str(tmp_path / str(k))
        rows.write.parquet(place)
        docs = spark.read.parquet(place)
        got = STAGES[name](spark, docs, BASE)
        if name != "BPE encoding and decoding":
            assert got.columns == docs.columns
        left = got.collect()
        assert len(left) <= docs.count()
        if name in ("line dedup", "BPE encoding and decoding"):
            assert len(left) == docs.count()
        if k == 1 and name != "BPE encoding and decoding":
            assert all((r.row, r.doc, r.gone, r.key, r.removed) == (7, "d", 8, "k", "r") for r in left)
            assert {0, 1, 2, 3} <= {r.doc_id for r in left}  # null and blank texts


def test_one_of_the_copies_stays_whatever_the_keys(spark, tmp_path):
    a, b = prose(1), prose(2)
    near = a.rsplit(" ", 2)[0] + " other end."
    # copies that share a key, have none, and a different text under the key of a copy
    docs = documents(spark, [a, a, a, near, b, b, a], [1, 1, None, 2, 2, None, 5])
    docs.write.parquet(str(tmp_path / "docs"))
    got = STAGES["n-gram Jaccard join"](spark, spark.read.parquet(str(tmp_path / "docs")), BASE).collect()
    assert sorted(r.text for r in got) == sorted([a, b])


def test_repeated_lines_go_from_rows_without_keys_too(spark, tmp_path):
    line = prose(3, 12)
    docs = documents(spark, [line + "\n" + prose(4, 12), line, line], [None, None, 3])
    docs.write.parquet(str(tmp_path / "docs"))
    got = STAGES["line dedup"](spark, spark.read.parquet(str(tmp_path / "docs")), BASE).collect()
    assert sum((r.text or "").count(line) for r in got) == 1 and len(got) == 3
    assert all(r.n_chars == len(r.text) for r in got)


def test_unrelated_text_under_the_key_of_a_hit_stays(spark, tmp_path):
    item = spark.read.parquet(f"{BASE}/benchmark.parquet").first().text
    docs = documents(spark, [prose(5) + " " + item, prose(6)], [4, 4])
    docs.write.parquet(str(tmp_path / "docs"))
    got = STAGES["benchmark decontamination"](spark, spark.read.parquet(str(tmp_path / "docs")), BASE).collect()
    assert [r.text for r in got] == [prose(6)]
