import math
import random

import pytest
from pyspark.sql import functions as F

from brindle.operators import evaluation


def metrics(spark, rows, cut=0.5):
    scored = spark.createDataFrame(rows, "score double, label boolean")
    return evaluation.binary_metrics(
        scored, F.col("score"), F.col("label"), cut
    ).first()


@pytest.mark.parametrize("spread", ["hundredths", "doubles", "wide"])
def test_metrics_against_all_pairs(spark, spread):
    draw = random.Random(6)
    score = {
        "hundredths": lambda: draw.randrange(-60, 100) / 100,
        "doubles": lambda: draw.choice([0.25, 0.25 - 1e-17, 0.2499999999, 0.2500000001, draw.random()]),
        "wide": lambda: draw.uniform(-1, 1) * 10 ** draw.randrange(-15, 300),
    }[spread]
    rows = [(score(), draw.random() < 0.3) for _ in range(300)]
    rows += [(None, True), (0.2, None)]
    got = metrics(spark, rows, 0.25)
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    positives = [s for s, y in known if y]
    negatives = [s for s, y in known if not y]
    wins = sum((p > q) + (p == q) / 2 for p in positives for q in negatives)
    tp, fp = sum(p >= 0.25 for p in positives), sum(q >= 0.25 for q in negatives)
    assert (got.tp, got.fp) == (tp, fp)
    assert (got.fn, got.tn) == (len(positives) - tp, len(negatives) - fp)
    assert got.auc == pytest.approx(wins / len(positives) / len(negatives), abs=1e-15)
    assert got.precision == tp / (tp + fp) and got.recall == tp / len(positives)
    assert got.f1 == pytest.approx(2 * tp / (tp + fp + len(positives)))


def test_equal_scores_give_one_half(spark):
    assert metrics(spark, [(0.7, True), (0.7, False), (0.7, False)]).auc == 0.5


def test_one_class_only(spark):
    got = metrics(spark, [(0.1, False), (0.9, False)])
    assert (got.tp, got.fp, got.fn, got.tn) == (0, 1, 0, 1)
    assert got.recall is None and got.auc is None and got.precision == 0.0


def test_nothing_predicted(spark):
    got = metrics(spark, [(0.1, False), (0.2, True)])
    assert got.precision is None and got.f1 == 0.0 and got.auc == 1.0


def test_drift_keeps_empty_bins(spark):
    a = [float(i) for i in range(100)]
    b = [1.0] * 50 + [99.0] * 50
    rows = spark.createDataFrame(
        [("a", v) for v in a] + [("b", v) for v in b] + [("c", 5.0), ("a", None)],
        "period string, v double",
    )
    got = evaluation.drift(
        rows, "v", F.col("period") == "a", F.col("period") == "b", n=4
    ).orderBy("bin").collect()
    assert [(r.bin, r.n_a, r.n_b) for r in got] == [
        (-1, 1, 0), (0, 25, 50), (1, 25, 0), (2, 25, 0), (3, 25, 50)
    ]
    shares = [(1 / 101, 1e-6), *((25 / 101, p) for p in (0.5, 1e-6, 1e-6, 0.5))]
    terms = [(a - b) * math.log(a / b) for a, b in shares]
    assert [r.term_e9 for r in got] == [math.floor(t * 1e9 + 0.5) for t in terms]
    assert {r.psi_e9 for r in got} == {sum(r.term_e9 for r in got)}


def test_scores_are_compared_as_they_are(spark):
    rows = [(0.504, True), (0.496, True), (0.4999, False), (0.5, False), (float("nan"), True)]
    got = metrics(spark, rows)
    assert (got.tp, got.fp, got.fn, got.tn) == (1, 1, 1, 1)


def test_drift_sees_missing_values_and_an_empty_first_period(spark):
    rows = spark.createDataFrame(
        [("a", float(i)) for i in range(100)]
        + [("b", float(i) if i % 2 else float("nan")) for i in range(100)],
        "period string, v double",
    )
    got = evaluation.drift(rows, "v", F.col("period") == "a", F.col("period") == "b", n=4).collect()
    assert {r.bin: r.n_b for r in got}[-1] == 50 and sum(r.n_b for r in got) == 100
    assert got[0].psi_e9 > 10**9
    empty = evaluation.drift(rows, "v", F.col("period") == "c", F.col("period") == "a", n=4).collect()
    assert {r.bin: (r.n_a, r.n_b) for r in empty} == {-1: (0, 0), 0: (0, 100), 1: (0, 0), 2: (0, 0), 3: (0, 0)}
