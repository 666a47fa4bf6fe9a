"""Classification metrics from a confusion matrix, each named for what it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import stored


def confusion_matrix(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_report(confusion: DataFrame) -> DataFrame:
    """Per class: rows with the label, rows predicted as it, and rows that are both."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("correct")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("correct")),
    )
    return (
        confusion.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("correct").alias("correct"))
    )


def summary(confusion: DataFrame) -> DataFrame:
    """One row: accuracy, f1 weighted by support, and balanced accuracy (mean recall)."""
    f1 = 2.0 * F.col("correct") / (F.col("support") + F.col("predicted"))
    recall = F.when(F.col("support") > 0, F.col("correct") / F.col("support"))
    return class_report(confusion).agg(
        F.sum("support").alias("rows"),
        (F.sum("correct") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("support") * f1) / F.sum("support")).alias("weighted_f1"),
        F.avg(recall).alias("balanced_accuracy"),
    )


def area_under_roc(scored: DataFrame, label: str = "label", score: str = "score", *by: str) -> DataFrame:
    """One row for each value of `by`: the share of pairs of a 1 and a 0 in which the 1 has the higher score, ties as halves.

    Rows are counted per score and dealt to tasks by ranges of it. Running sums are taken inside a range
    and over the ranges, whose number is that of the tasks. Null where a class is missing; rows
    without label or score are left out.
    """
    counts = (
        scored.select(*by, F.col(label).alias("label"), F.col(score).alias("score"))
        .filter("label is not null and score is not null")
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros"))
    )
    ranges = stored(counts.repartitionByRange(*by, "score").withColumn("part", F.spark_partition_id()), "scores")
    parts = ranges.groupBy(*by, "part").agg(F.sum("zeros").alias("in_part"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("in_part").over(before), F.lit(0))
    inside = Window.partitionBy(*by, "part").orderBy("score")
    placed = ranges.withColumn("upto", F.sum("zeros").over(inside)).join(parts.select(*by, "part", below.alias("below")), [*by, "part"])
    won = F.col("ones").cast("double") * (F.col("below") + F.col("upto") - F.col("zeros") / 2)
    pairs = F.sum("ones").cast("double") * F.sum("zeros")
    return placed.groupBy(*by).agg((F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("area_under_roc"))
