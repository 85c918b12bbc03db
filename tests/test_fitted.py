import random
import statistics

import pytest
from pyspark.sql import functions as F

from brindle.operators import fitted

SCHEMA = "id bigint, x double, fitted boolean"


def frame(spark, values, fitted_flags=None):
    flags = fitted_flags or [True] * len(values)
    return spark.createDataFrame(
        [(i, v, f) for i, (v, f) in enumerate(zip(values, flags))], SCHEMA
    )


def test_standardise_uses_fitted_rows_and_fills_with_their_mean(spark):
    rows = frame(spark, [1.0, 2.0, 3.0, None, 100.0], [True, True, True, True, False])
    got = {r.id: r for r in fitted.standardise(rows, ["x"], F.col("fitted"), ["id"]).collect()}
    assert [got[i].x_z for i in (0, 1, 2)] == pytest.approx([-1.0, 0.0, 1.0])
    assert got[3].x_z == 0.0 and got[3].x_unit == 0.5
    assert got[4].x_z == pytest.approx((100 - 2) / statistics.stdev([1, 2, 3]))


def test_standardise_far_from_zero(spark):
    rows = frame(spark, [1e9 + 0.01, 1e9 + 0.02, 1e9 + 0.03])
    got = [r.x_z for r in fitted.standardise(rows, ["x"], F.col("fitted"), ["id"]).collect()]
    assert got == [-1.0, 0.0, 1.0]


@pytest.mark.parametrize("values", [[5.0, 5.0], [None, None], [7.0]])
def test_standardise_without_spread_gives_null(spark, values):
    got = fitted.standardise(frame(spark, values), ["x"], F.col("fitted"), ["id"]).collect()
    assert all(r.x_z is None and r.x_unit is None for r in got)


def quantile(values, numerator, n):
    ordered = sorted(values)
    rank, rest = divmod((len(ordered) - 1) * numerator, n)
    upper = ordered[min(rank + 1, len(ordered) - 1)]
    return ordered[rank] * n + rest * (upper - ordered[rank])


@pytest.mark.parametrize(
    "values",
    [
        [random.Random(1).randrange(-5_000, 5_000) for _ in range(500)],
        [random.Random(2).randrange(-(10**13), 10**13) for _ in range(300)],
        [7] * 200 + [random.Random(3).randrange(10**9) for _ in range(150)],
        [-(2**62), 2**62, 0],
        [42],
        [1, 2],
    ],
    ids=["narrow", "wide", "one value a majority", "ends of bigint", "single", "fewer than bins"],
)
def test_cut_points_are_exact(spark, values):
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    n = 7
    assert fitted.cut_points(rows, F.col("v"), n) == [
        quantile(values, i, n) for i in range(1, n)
    ]


def test_cut_points_agree_with_percentile(spark):
    draw = random.Random(4)
    rows = spark.createDataFrame([(int(draw.gauss(0, 10**6)),) for _ in range(1000)], "v bigint")
    want = rows.select(F.percentile("v", [i / 10 for i in range(1, 10)])).first()[0]
    got = [c / 10 for c in fitted.cut_points(rows, F.col("v"), 10)]
    assert got == pytest.approx(want)


def test_quantile_bins_of_nulls_ties_and_unfitted_rows(spark):
    values = [1.0, 1.0, 1.0, 2.0, None, -9.0, 99.0]
    rows = frame(spark, values, [True] * 5 + [False] * 2)
    got = {r.id: r.bin for r in fitted.quantile_bins(rows, "x", F.col("fitted"), ["id"], 4).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: None, 5: 0, 6: 3}


def test_nan_counts_as_missing(spark):
    rows = frame(spark, [1.0, float("nan"), 3.0])
    scaled = {r.id: r for r in fitted.standardise(rows, ["x"], F.col("fitted"), ["id"]).collect()}
    assert scaled[1].x_z == 0.0 and scaled[0].x_unit == 0.0
    binned = {r.id: r.bin for r in fitted.quantile_bins(rows, "x", F.col("fitted"), ["id"], 2).collect()}
    assert binned == {0: 0, 1: None, 2: 1}


def test_quantile_bins_without_fitted_rows(spark):
    rows = frame(spark, [1.0, 2.0], [False, False])
    got = fitted.quantile_bins(rows, "x", F.col("fitted"), ["id"]).collect()
    assert [r.bin for r in got] == [None, None]


def test_smoothed_means_of_null_and_unseen_categories(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1, True), (2, "a", 0, True), (3, None, 1, True), (4, "new", 1, False)],
        "id bigint, c string, y int, fitted boolean",
    )
    got = fitted.smoothed_means(rows, "c", F.col("y") == 1, F.col("fitted"), ["id"], 1.0)
    overall = 2 / 3
    assert {r.id: r.encoded for r in got.collect()} == pytest.approx(
        {1: (1 + overall) / 3, 2: (1 + overall) / 3, 3: (1 + overall) / 2, 4: overall}
    )


def test_missing_outcomes_count_for_nothing(spark):
    rows = spark.createDataFrame([(1, "a", True), (2, "a", None), (3, "a", None)], "id bigint, c string, y boolean")
    got = fitted.smoothed_means(rows, "c", F.col("y"), F.lit(True), ["id"]).collect()
    assert {r.encoded for r in got} == {1.0}


def test_small_values_fall_into_different_bins(spark):
    rows = frame(spark, [i * 1e-6 for i in range(1000)])
    got = fitted.quantile_bins(rows, "x", F.col("fitted"), ["id"], 10).collect()
    assert sorted({r.bin for r in got}) == list(range(10))
    with pytest.raises(Exception, match="digits"):
        fitted.quantile_bins(frame(spark, [1e30, 5.0]), "x", F.col("fitted"), ["id"], 2).collect()
