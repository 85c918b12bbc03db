import duckdb
import pyarrow as pa
import pytest

from brindle.llm import line_rules, text
from brindle.llm.queries import ORACLE
from tests.llm.helpers import awkward, frame

LINES = [
    "A sentence of some length that ends as it should.",
    "home | about | contact | help.",
    "Home » News » Sports » Weather.",
    "no stop here",
    "One sentence. And then it breaks",
    "EVERYTHING HERE IS SHOUTED AT YOU!",
    "bu% th### ca*** fo$$$ end.",
    "All Rights Reserved, of course.",
    "  \t ",
    "",
]


def test_failing_rules():
    found = [line_rules.failing_rule(x.encode()) for x in LINES[:8]]
    assert found == [None, "symbols", "navigation", "punctuation", None, "shouting", "symbols", "boilerplate"]


def test_same_as_the_sql(spark):
    draw = __import__("random").Random(3)
    texts = awkward() + ["\n".join(draw.choices(LINES, k=draw.randrange(1, 30))) for _ in range(100)]
    texts += [" ".join(draw.choices("ab cd ef gh ij kl".split(), k=60)) + "." for _ in range(20)]
    got = line_rules.clean(frame(spark, texts)).drop("clean_text")
    documents = pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    sql = duckdb.connect()
    sql.register("documents", documents)
    want = sql.sql(ORACLE["op4_line_rules"]).select(", ".join(got.columns))
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_clean_text_is_what_is_left(spark):
    body = "\n".join(LINES)
    got = line_rules.clean(frame(spark, [body, None])).orderBy("doc_id").collect()
    assert got[0].clean_text == "\n".join([LINES[0], LINES[4], LINES[8], LINES[9]])
    assert got[0].n_lines_removed == 6 and not got[0].kept
    assert (got[1].clean_text, got[1].n_words, got[1].base_failed) == ("", 0, True)


@pytest.mark.parametrize("size", [2, 8])
def test_repeated_words_by_hand(size):
    draw = __import__("random").Random(size)
    texts = [" ".join(draw.choices("ab", k=draw.randrange(0, 60))) for _ in range(50)]
    data, at = text.utf8(pa.array(texts))
    starts, ends, first = text.words(data, at)
    got = line_rules.repeated_words(text.hashes(data, starts, ends), first, size)
    for t, n in zip(texts, got):
        w = t.split()
        runs = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
        assert n == len({i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(size)})


def test_empty_table(spark):
    assert line_rules.clean(frame(spark, [])).collect() == []
