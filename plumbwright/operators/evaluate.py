"""Classification metrics.

Label pairs are counted once into a confusion matrix; every other metric is
arithmetic over its cells, so the row-level data is scanned and shuffled once
(as partial counts) however many classes there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import ratio


def pair_labels(truth: DataFrame, predicted: DataFrame, key: Sequence[str]) -> DataFrame:
    """Match two label tables on an ordinal or key; unmatched rows drop out."""
    return truth.join(predicted, list(key), "inner")


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    return df.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_counts(df: DataFrame, positive, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """tp, fp, fn and tn with one class taken as positive."""
    t, p = F.col(y_true).eqNullSafe(F.lit(positive)), F.col(y_pred).eqNullSafe(F.lit(positive))
    return df.agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )


def class_counts(matrix: DataFrame) -> DataFrame:
    """tp, fp, fn and support per class that occurs among the true labels."""
    hit = F.col("y_true").eqNullSafe(F.col("y_pred"))
    zero = F.lit(0).cast("bigint")

    def share(label, support, predicted, tp):
        return F.struct(
            F.col(label).alias("label"), support.alias("support"), predicted.alias("predicted"), tp.alias("tp")
        )

    n = F.col("n")
    shares = F.array(share("y_true", n, zero, F.when(hit, n).otherwise(zero)), share("y_pred", zero, n, zero))
    per_class = matrix.select(F.inline(shares)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    return per_class.filter("support > 0").select(
        "label",
        "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        (F.col("support") - F.col("tp")).alias("fn"),
        "support",
    )


def _scored(matrix: DataFrame) -> DataFrame:
    counts = class_counts(matrix).select(
        "*",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return counts.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), both))


def per_class(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per true class; empty denominators give 0.0."""
    return _scored(matrix).select("label", "precision", "recall", "f1", "support")


def evaluation_summary(matrix: DataFrame) -> DataFrame:
    """Accuracy and macro F1 over the classes seen among the true labels.

    Both follow from the per-class table: the supports sum to the row count and
    the true positives to the exact matches.
    """
    return _scored(matrix).agg(
        F.coalesce(F.sum("support"), F.lit(0)).alias("n"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"),
    )


def accuracy(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    hit = F.col(y_true).eqNullSafe(F.col(y_pred)).cast("int")
    return df.agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("accuracy"))


def classification_report(matrix: DataFrame) -> DataFrame:
    """Per-class rows followed by accuracy and macro F1 as (section, label, metric, value)."""
    scored = per_class(matrix)
    rows = scored.select(
        F.lit("class").alias("section"),
        F.col("label").cast("string").alias("label"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in ("precision", "recall", "f1", "support")
                ]
            )
        ),
    )
    overall = evaluation_summary(matrix).select(
        F.lit("overall").alias("section"),
        F.lit("").alias("label"),
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "macro_f1")]
            )
        ),
    )
    return rows.unionByName(overall)
