"""Quality of a score and change of a column between periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import DIGITS, fixed_point, scaled
from brindle.operators.fitted import bin_of, cut_points
from brindle.sources.scratch import new_place

def binary_metrics(rows: DataFrame, score: Column, label: Column, cut: float) -> DataFrame:
    """One row: confusion counts at ``cut``, precision, recall, F1 and the AUC.

    A row is positive if its score, as it is, is at least ``cut``. Rows with equal scores
    share a rank. Rows without score (NaN too) or label don't count. All of it comes
    from the counts per distinct score, dealt by ranges of the score into tasks of equal
    size, so rows are read once and never ranked one by one, and no task sees more
    scores than its range. Null where a class or side is empty.
    """
    # one row per distinct score; written, so that each score keeps its range
    place = new_place(rows.sparkSession, "score-counts")
    score_counts(rows, score, label).repartitionByRange("x").withColumn("range", F.spark_partition_id()).write.parquet(place)
    stored = rows.sparkSession.read.schema("x double, pos bigint, neg bigint, range int").parquet(place)
    exactly = "cast({} as decimal(18,0)) * cast({} as decimal(18,0))"
    lower = Window.partitionBy("range").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    high = F.col("x") >= F.lit(float(cut))
    # wins, times two: how often a positive beats a negative of its range; half for a tie
    ranges = (
        stored.withColumn("below", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
        .groupBy("range")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.when(high, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(high, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.expr(f"{exactly.format('pos', '2 * below + neg')}").cast("decimal(38,0)")).alias("wins"),
            F.min("x").alias("least"),
        )
    )
    # from here on one row per range, which is one per task
    earlier = Window.partitionBy(F.lit(0)).orderBy("least").rowsBetween(Window.unboundedPreceding, -1)
    total = ranges.withColumn("before", F.coalesce(F.sum("neg").over(earlier), F.lit(0))).agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp")],
        F.sum(F.expr(f"wins + {exactly.format('pos', '2 * before')}").cast("decimal(38,0)")).alias("wins"),
    )
    return total.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in ("pos", "neg", "tp", "fp")], "wins").selectExpr(
        "tp",
        "fp",
        "pos - tp as fn",
        "neg - fp as tn",
        "tp / nullif(tp + fp, 0) as precision",
        "tp / nullif(pos, 0) as recall",
        "2 * tp / nullif(pos + tp + fp, 0) as f1",
        "cast(wins as double) / nullif(2 * cast(pos as double) * cast(neg as double), 0)"
        " as auc",
    )


def score_counts(rows: DataFrame, score: Column, label: Column) -> DataFrame:
    """Positives and negatives of each distinct score ``x``."""
    number = F.nanvl(score.cast("double"), F.lit(None).cast("double"))
    return (
        rows.select(number.alias("x"), label.alias("label"))
        .where("x is not null and label is not null")
        .groupBy("x")
        .agg(F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg"))
    )


def drift(
    rows: DataFrame,
    col: str,
    period_a: Column,
    period_b: Column,
    n: int = 10,
    digits: int = DIGITS,
    floor: float = 1e-6,
) -> DataFrame:
    """Population stability index of ``col`` over quantile bins of period a.

    One row per bin, empty ones too, with shares at least ``floor``; bin -1 holds the
    rows whose value is missing. Without a value in period a there are no cut points
    and all values lie in bin 0. The index and its terms are in billionths.
    """
    value = scaled(F.col(col), digits)
    both = rows.where(period_a | period_b)
    cuts = cut_points(both.where(period_a), value, n)
    known = F.lit(0).cast("bigint") if cuts is None else bin_of(value, cuts, n)
    # at most n + 1 rows of counts; joining the list of bins brings back the empty ones
    counted = (
        both.groupBy(F.when(value.isNull(), F.lit(-1)).otherwise(known).alias("bin"))
        .agg(F.count_if(period_a).alias("n_a"), F.count_if(period_b).alias("n_b"))
    )
    bins = rows.sparkSession.range(-1, n, numPartitions=1).withColumnRenamed("id", "bin")
    over_bins = Window.partitionBy(F.lit(0))

    def share(count: str) -> Column:
        total = F.sum(count).over(over_bins)
        return F.when(total > 0, F.greatest(F.col(count) / total, F.lit(floor)))

    shares = (
        bins.join(F.broadcast(counted), "bin", "left")
        .na.fill(0, ["n_a", "n_b"])
        .select("*", share("n_a").alias("a"), share("n_b").alias("b"))
    )
    term = fixed_point((F.col("a") - F.col("b")) * F.ln(F.col("a") / F.col("b")))
    return shares.select("bin", "n_a", "n_b", term.alias("term_e9")).withColumn(
        "psi_e9", F.sum("term_e9").over(over_bins)
    )
