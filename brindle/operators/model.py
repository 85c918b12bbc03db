"""A purchase forecast from what a user did in a day: regression and naive Bayes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import DIGITS, exact, exact_sum, fixed_point
from brindle.sources.scratch import new_place

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def daily_features(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    type_col: str = "event_type",
    value: str = "value",
    types: Sequence[str] = EVENT_TYPES,
    outcome: str = "purchase",
    digits: int = DIGITS,
) -> DataFrame:
    """Per key and active day: counts per type, value sum, and ``label``.

    ``label`` is 1 if the next day has an event of type ``outcome``; null on the
    last day of all, whose next day is not known.
    """
    days = (
        events.groupBy(key, F.to_date(ts).cast("timestamp_ntz").alias("day"))
        .agg(
            *[F.count_if(F.col(type_col) == t).alias(f"n_{t}") for t in types],
            exact_sum(exact(F.col(value), digits)).alias("total"),
        )
        .withColumn("value_sum", F.coalesce(F.col("total").cast("double"), F.lit(0.0)))
    )
    # a key has one row per day here, so its window group is bounded by the calendar
    next_day = (
        Window.partitionBy(key).orderBy(F.unix_date(F.to_date("day"))).rangeBetween(1, 1)
    )
    last = events.agg(F.to_date(F.max(ts)).cast("timestamp_ntz")).scalar()
    return days.select(
        key,
        "day",
        *[f"n_{t}" for t in types],
        "value_sum",
        F.when(
            F.col("day") < last,
            F.coalesce(F.max(f"n_{outcome}").over(next_day) > 0, F.lit(False)).cast("int"),
        ).alias("label"),
    )


def fit_and_score(
    rows: DataFrame,
    features: Sequence[str],
    fit: Column,
    keep: Sequence[str],
    label: str = "label",
) -> DataFrame:
    """Fit on labelled rows where ``fit`` holds, score the labelled others, also those
    whose ``fit`` is null.

    The rows are written to the shared folder first: each iteration reads them,
    and a lost executor then costs a read, not the aggregation before it.
    """
    place = new_place(rows.sparkSession, "model-rows")
    labelled = rows.where(F.col(label).isNotNull()).select(
        *keep, *[c for c in (*features, label) if c not in keep], F.coalesce(fit, F.lit(False)).alias("_fit")
    )
    labelled.write.partitionBy("_fit").parquet(place)
    stored = rows.sparkSession.read.schema(labelled.schema).parquet(place)

    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    regression = LogisticRegression(
        featuresCol="_features", labelCol=label, maxIter=50, regParam=1e-3
    )
    model = regression.fit(assembler.transform(stored.where("_fit")))

    # one number per feature: scoring is then a plain expression, without vectors
    margin = F.lit(float(model.intercept))
    for name, weight in zip(features, model.coefficients.toArray()):
        margin = margin + F.lit(float(weight)) * F.col(name)
    return stored.where("not _fit").select(
        *keep,
        *([label] if label not in keep else []),
        (1 / (1 + F.exp(-margin))).alias("score"),
    )


def naive_bayes(
    rows: DataFrame,
    features: Sequence[str],
    fit: Column,
    keep: Sequence[str],
    label: str = "label",
) -> DataFrame:
    """Log odds of label 1 from which of the ``features`` are above 0, in billionths.

    Fitted by counting the labelled rows where ``fit`` holds: the model is one row of
    counts, two for each feature, with one added to each (Laplace). Scores the labelled
    others, also those whose ``fit`` is null. A missing feature counts as not above 0.
    Each feature's term is rounded to billionths and the terms are added as whole
    numbers, so the score does not depend on the order of addition.
    """
    fitted = F.coalesce(fit, F.lit(False))
    positive = F.col(label) == 1
    seen = {f: F.coalesce(F.col(f) > 0, F.lit(False)) for f in features}
    counts = (
        rows.where(F.col(label).isNotNull() & fitted)
        .agg(
            F.count_if(positive).alias("n_1"),
            F.count_if(~positive).alias("n_0"),
            *[F.count_if(positive & s).alias(f"{f}_1") for f, s in seen.items()],
            *[F.count_if(~positive & s).alias(f"{f}_0") for f, s in seen.items()],
        )
        .first()
    )

    def odds(for_1: int, of_1: int, for_0: int, of_0: int) -> Column:
        return fixed_point(F.ln(F.lit(for_1 / of_1)) - F.ln(F.lit(for_0 / of_0)))

    n1, n0 = counts["n_1"], counts["n_0"]
    score = odds(n1 + 1, n1 + n0 + 2, n0 + 1, n1 + n0 + 2)
    for f, s in seen.items():
        with_1, with_0 = counts[f"{f}_1"], counts[f"{f}_0"]
        there = odds(with_1 + 1, n1 + 2, with_0 + 1, n0 + 2)
        absent = odds(n1 - with_1 + 1, n1 + 2, n0 - with_0 + 1, n0 + 2)
        score = score + F.when(s, there).otherwise(absent)
    return rows.where(F.col(label).isNotNull() & ~fitted).select(
        *keep, *([label] if label not in keep else []), score.alias("log_odds_e9")
    )
