import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import decontaminate, text
from tests.llm.helpers import awkward, frame


def words(body):
    return re.findall(r"[a-z0-9À-ɏ]+", (body or "").lower())


def brute(texts, items, threshold):
    """All pairs (text, item) with a passage that scores enough, and the best score."""
    n, bags = len(items), [words(i) for i in items]
    df = {w: sum(w in b for b in bags) for b in bags for w in b}
    mean = sum(map(len, bags)) / n
    weights = []
    for b in bags:
        w = {}
        for t in set(b):
            tf, idf = b.count(t), math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
            w[t] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(b) / mean))
        total = sum(w.values())
        weights.append({t: x / total for t, x in w.items()})
    out = {}
    for r, body in enumerate(texts):
        own = words(body)
        for i, w in enumerate(weights):
            step = max(64, 1 << (len(bags[i]) - 1).bit_length())
            for s in range(max(1, math.ceil(len(own) / step))):
                passage = set(own[s * step : (s + 2) * step])
                score = sum(x for t, x in w.items() if t in passage)
                if w and score >= threshold:
                    out[r, i] = max(out.get((r, i), 0), score)
    return out


def corpus():
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60
    items = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(8, 70))) for _ in range(30)]
    texts = []
    for k in range(80):
        body = [draw.choice(vocabulary) for _ in range(draw.randrange(1, 500))]
        if k % 4 == 0:
            item = draw.choice(items).split()
            item = [x if draw.random() > 0.1 * (k % 3) else "changed" for x in item]
            at = draw.randrange(len(body))
            body[at:at] = item
        texts.append(" ".join(body))
    return items, texts


@pytest.mark.parametrize("threshold, portion", [(0.55, 1 << 20), (0.55, 7), (0.2, 100), (0.9, 100), (1.0, 1)])
def test_retrieves_all_above_the_threshold(monkeypatch, threshold, portion):
    monkeypatch.setattr(decontaminate, "PORTION", portion)
    items, texts = corpus()
    items += ["w1 w2", "the of and", " ".join(f"long{k}" for k in range(300)), items[0]]
    texts += [items[-2] + " more", "the of and", items[0]]
    data, at = text.utf8(pa.array(texts))
    got = decontaminate.search_piece(data, at, decontaminate.build_index(items, threshold), 0.0)
    want = {k: v for k, v in brute(texts, items, threshold - 1e-12).items()}
    sure = {k for k, v in want.items() if v > threshold + 1e-9}
    assert sure <= set(got) <= set(want) and len(want) >= 8
    assert all(got[k][0] == pytest.approx(want[k]) for k in got)


def test_memory_does_not_grow_with_the_index():
    """One piece of text against an index of almost the allowed size, and a very long item."""
    draw = np.random.default_rng(3)

    def some(n):  # every other word is one of a hundred
        return [f"w{a if c else 100 + b}" for a, b, c in zip(draw.integers(0, 100, n), draw.integers(0, 100_000, n), draw.integers(0, 2, n))]

    rank = some(480_000)
    items = [" ".join(rank[i : i + 12]) for i in range(0, 480_000, 12)] + [" ".join(f"v{k}" for k in range(10_000))]
    index = decontaminate.build_index(items)
    body = " ".join([*some(200_000), items[77], items[-1]])
    data, at = text.utf8(pa.array([body]))
    tracemalloc.start()
    got = decontaminate.search_piece(data, at, index, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(0, 77), (0, 40_000)} <= set(got)
    assert peak < 300e6


def test_finds_whole_items_wherever_they_are(spark):
    items, texts = corpus()
    docs = [f"{t}\n{items[i % 30].upper()}, {t}" for i, t in enumerate(texts)] + awkward()
    bench = spark.createDataFrame([*enumerate(items), (98, None), (99, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    assert {(i, i % 30) for i in range(len(texts))} <= got
    assert all(d < len(texts) for d, _ in got)


def test_both_question_and_answer_must_overlap(spark):
    item = "what is the name of the largest river of that old country? it is the blue winding river kaloa"
    texts = [item, item.split("?")[0], f"{item.split('?')[0]} nobody ever knows what might be the answer here"]
    bench = spark.createDataFrame([(1, item), (1, item), (2, "an unrelated text of other words")], "item_id bigint, text string")
    got = decontaminate.contaminated(frame(spark, texts), bench, threshold=0.3).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 1)}
    assert got[0].question_overlap == got[0].answer_overlap == 1.0


def test_an_index_is_never_larger_than_its_bound(spark, monkeypatch):
    items, texts = corpus()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = frame(spark, [*items, *texts[:5]])
    monkeypatch.setattr(decontaminate, "WORDS_PER_INDEX", 400)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert {(i, i) for i in range(30)} <= got


def test_empty_tables_and_null_ids(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(None, "some words that are to be found again")], none.schema)
    assert decontaminate.contaminated(frame(spark, awkward()), none).collect() == []
    assert decontaminate.contaminated(frame(spark, []), one).collect() == []
    got = decontaminate.contaminated(frame(spark, ["some words that are to be found again"] * 2, [None, 3]), one)
    assert sorted((r.doc_id or 0, r.item_id) for r in got.collect()) == [(0, None), (3, None)]


def test_runs_of_short_parts():
    codes = np.array([5, 6], np.uint64)
    assert decontaminate.overlap_of(codes, np.array([4, 5, 6, 7], np.uint64)) == 1.0
    assert decontaminate.overlap_of(codes, np.array([6, 5], np.uint64)) == 0.0
    assert decontaminate.overlap_of(codes[:0], codes) == 1.0
