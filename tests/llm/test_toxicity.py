import math
import random
import re

import numpy as np
import pyarrow as pa

from brindle.llm import text, toxicity
from tests.llm.helpers import awkward, frame


def labelled(spark, n=600):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        body = [draw.choice(words) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            body[draw.randrange(40)] = draw.choice(["nasty", "vile"])
        rows.append((i, " ".join(body) + ".", int(bad)))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, label int")


def test_learns_held_out_rows(spark):
    rows, frame_ = labelled(spark)
    weights = toxicity.fit(frame_.where("doc_id < 400"))
    assert 0 < len(weights.features) < 1000
    got = {r.doc_id: r.score for r in toxicity.score(frame_, weights).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 400]
    assert sum(held) / len(held) > 0.97


def test_score_is_the_sum_over_distinct_features():
    texts = ["Nasty one, nasty two", "", "one two three", "ÉTÉ nasty été"]
    data, at = text.utf8(pa.array(texts))
    numbers, row = toxicity.features(data, at)
    chosen = np.unique(numbers)[::2]
    weights = toxicity.Weights(chosen, np.linspace(-1, 1, len(chosen)), -0.3)
    got = toxicity.score_piece(data, at, weights)
    of = dict(zip(chosen.tolist(), weights.values.tolist()))
    for r, t in enumerate(texts):
        alone, _ = toxicity.features(*text.utf8(pa.array([t])))
        n = len(re.findall(r"\w+", t))
        assert len(alone) == n + max(0, n - 1) + max(0, n - 2)
        margin = -0.3 + sum(of.get(x, 0.0) for x in set(alone.tolist()))
        assert math.isclose(got[r], 1 / (1 + math.exp(-margin)))


def test_ftrl_shrinks_noise_to_zero():
    draw = np.random.default_rng(1)
    rows = [np.unique(np.append(draw.integers(100, 2000, 20), 7 if y else 8)).astype(np.uint32) for y in (0, 1) * 300]
    found, w, _ = toxicity.ftrl(rows, np.array([0, 1] * 300, float), toxicity.Settings())
    assert dict(zip(found.tolist(), w))[7] > 0 and len(found) < 1000


def test_awkward_tables(spark):
    texts = awkward()
    weights = toxicity.Weights(np.zeros(0, np.uint32), np.zeros(0), 0.0)
    got = toxicity.score(frame(spark, texts), weights).collect()
    assert [r.score for r in got] == [0.5] * len(texts)
    assert toxicity.score(frame(spark, []), weights).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, text string, label int")
    one = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "b", None)], none.schema)
    for labels, low, high in ((none, 0, 1e-9), (one, 1 - 1e-9, 1)):
        scores = [r.score for r in toxicity.score(frame(spark, texts), toxicity.fit(labels)).collect()]
        assert all(low <= s <= high for s in scores)
