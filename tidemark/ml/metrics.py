"""Evaluation tables from columns of labels and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction): at most classes squared rows, all metrics follow from it."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1 and support; a class never predicted (or never true) scores 0."""
    cells = _confusion(df, label, prediction)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.lit(True).alias("true_side")),
                F.struct(F.col("prediction").alias("class"), F.lit(False).alias("true_side")),
            )
        ).alias("side"),
        "n",
        (F.col("label") == F.col("prediction")).alias("hit"),
    )
    per_class = sides.groupBy(F.col("side.class").alias("Class")).agg(
        F.sum(F.when(F.col("side.true_side"), F.col("n")).otherwise(0)).alias("Support"),
        F.sum(F.when(~F.col("side.true_side"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("side.true_side") & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"),
    )
    return per_class.select(
        "Class",
        _or_zero(F.col("hits"), F.col("predicted")).alias("Precision"),
        _or_zero(F.col("hits"), F.col("Support")).alias("Recall"),
        _or_zero(2 * F.col("hits"), F.col("predicted") + F.col("Support")).alias("F1"),
        "Support",
    )


def classification_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and weighted F1 in one row."""
    report = classification_report(df, label, prediction)
    return report.agg(
        (F.sum(F.col("Recall") * F.col("Support")) / F.sum("Support")).alias("accuracy"),
        (F.sum(F.col("F1") * F.col("Support")) / F.sum("Support")).alias("weighted_f1"),
    )


def confusion_matrix(
    df: DataFrame, classes: list, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return (
        _confusion(df, label, prediction)
        .groupBy("label")
        .pivot("prediction", classes)
        .agg(F.sum("n"))
        .fillna(0)
    )


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean squared error, R2 and mean absolute error in one pass."""
    y, error = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("spread"),
    ).select("mse", F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread")).alias("r2"), "mae")
