import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brindle.operators import model

START = datetime(2024, 3, 1)


def test_label_looks_at_the_next_calendar_day(spark):
    events = spark.createDataFrame(
        [
            (1, START + timedelta(hours=1), "view", 1.5),
            (1, START + timedelta(hours=30), "purchase", None),
            (1, START + timedelta(hours=80), "purchase", 2.0),
            (2, START + timedelta(hours=2), "click", 1.0),
        ],
        "user_id bigint, ts timestamp_ntz, event_type string, value double",
    )
    got = {(r.user_id, r.day): r for r in model.daily_features(events).collect()}
    days = [START + timedelta(days=d) for d in range(4)]
    assert {k: r.label for k, r in got.items()} == {
        (1, days[0]): 1,
        (1, days[1]): 0,  # the next purchase is two days later
        (1, days[3]): None,  # last day
        (2, days[0]): 0,
    }
    assert got[1, days[0]].value_sum == 1.5 and got[1, days[1]].value_sum == 0.0


def test_scores_every_labelled_row_outside_the_fit(spark):
    rows = spark.range(400).select(
        "id",
        (F.col("id") % 10).cast("double").alias("x"),
        F.when(F.col("id") % 40 == 0, None)
        .otherwise((F.col("id") % 10 >= 5).cast("int"))
        .alias("label"),
    )
    scored = model.fit_and_score(rows, ["x"], F.col("id") < 200, ["id"]).collect()
    assert sorted(r.id for r in scored) == [i for i in range(200, 400) if i % 40]
    assert all((r.score > 0.5) == (r.label == 1) for r in scored)


def test_score_is_the_regression_s_own_probability(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = spark.range(300).select(
        "id",
        F.sin("id").alias("x"),
        F.cos(F.col("id") * 3).alias("z"),
        (F.sin("id") + F.cos(F.col("id") * 7) > 0.2).cast("int").alias("label"),
    )
    fit = F.col("id") < 200
    got = {r.id: r.score for r in model.fit_and_score(rows, ["x", "z"], fit, ["id"]).collect()}
    vectors = VectorAssembler(inputCols=["x", "z"], outputCol="v").transform(rows)
    fitted = LogisticRegression(
        featuresCol="v", labelCol="label", maxIter=50, regParam=1e-3
    ).fit(vectors.where(fit))
    want = fitted.transform(vectors.where(~fit)).select(
        "id", vector_to_array("probability")[1].alias("p")
    )
    assert got == pytest.approx({r.id: r.p for r in want.collect()}, abs=1e-6)


def test_rows_with_an_unknown_fit_condition_are_scored(spark):
    rows = spark.range(150).select(
        "id",
        (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 10 >= 5).cast("int").alias("label"),
        F.when(F.col("id") < 100, F.when(F.col("id") < 50, True).otherwise(False)).alias("fit"),
    )
    assert model.fit_and_score(rows, ["x"], F.col("fit"), ["id"]).count() == 100


def test_naive_bayes_by_hand(spark):
    rows = spark.createDataFrame(
        [(1, 2, 1, True), (2, 0, 0, True), (3, 1, 1, True), (4, 0, 1, True), (5, 3, 0, False),
         (6, None, 1, None), (7, 1, None, False)],
        "id bigint, x int, label int, fit boolean",
    )
    got = {r.id: r.log_odds_e9 for r in model.naive_bayes(rows, ["x"], F.col("fit"), ["id"]).collect()}
    prior = math.log(4 / 6) - math.log(2 / 6)
    there, absent = math.log(3 / 5) - math.log(1 / 3), math.log(2 / 5) - math.log(2 / 3)
    assert got == pytest.approx({5: (prior + there) * 1e9, 6: (prior + absent) * 1e9}, abs=2)
