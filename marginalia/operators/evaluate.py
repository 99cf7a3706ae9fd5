"""Evaluation of scored rows: reports, curves, lift and regression errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.columns import one_row, ratio
from marginalia.operators.windows import quantile_cut, running_totals


def classification_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages.

    Works on the confusion counts: one row per (actual, predicted) pair.
    """
    cells = scored.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("said")
    ).agg(F.count("*").alias("n"))
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).alias("said_n")),
        F.struct(F.col("said").alias("class"), F.lit(0).alias("support"), F.col("n").alias("said_n")),
    )
    hit = F.when(F.col("actual") == F.col("said"), F.col("n")).otherwise(0)
    flat = cells.select(hit.alias("hit"), F.explode(sides).alias("s")).select("hit", "s.*")
    classes = flat.groupBy("class").agg(
        F.sum("support").alias("support"),
        F.sum("said_n").alias("said"),
        # Both sides of a diagonal cell carry the hit.
        (F.sum("hit") / 2).alias("hit"),
    )
    zero = F.lit(0.0)
    scores = classes.withColumns(
        {
            "precision": F.coalesce(ratio(F.col("hit"), F.col("said")), zero),
            "recall": F.coalesce(ratio(F.col("hit"), F.col("support")), zero),
            "f1": F.coalesce(ratio(2 * F.col("hit"), F.col("said") + F.col("support")), zero),
        }
    )
    scores = scores.where("support > 0 OR said > 0")
    measures = ["precision", "recall", "f1"]
    weight = F.sum("support")
    summary = scores.agg(
        weight.alias("support"),
        F.sum("hit").alias("hit"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), weight).alias(f"w_{m}") for m in measures],
    )
    accuracy = F.try_divide(F.col("hit"), F.col("support"))
    rows = [
        ("accuracy", [accuracy, accuracy, accuracy]),
        ("macro avg", [F.col(f"macro_{m}") for m in measures]),
        ("weighted avg", [F.col(f"w_{m}") for m in measures]),
    ]
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                *[v.alias(m) for m, v in zip(measures, values)],
                F.col("support").cast("bigint").alias("support"),
            )
            for name, values in rows
        ]
    )
    overall = summary.select(F.explode(entries).alias("e")).select("e.*")
    columns = ["class", *measures, "support"]
    per_class = scores.withColumn("class", F.col("class").cast("string"))
    return per_class.select(*columns).unionByName(overall)


def threshold_counts(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score, from high to low: counts and running counts of both classes.

    Equal scores are counted first; running counts then span the whole table by range
    partition, never one task. Rows without a score belong to no threshold.
    """
    counts = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    running = running_totals(counts, [F.col("threshold").desc()], {"tp": "pos", "fp": "neg"})
    totals = running.agg(F.max("tp").alias("all_pos"), F.max("fp").alias("all_neg"))
    return running.withColumn("_totals", one_row(totals)).select("*", "_totals.*").drop("_totals")


def _end_point(scored: DataFrame, score: str, **values: float) -> DataFrame:
    row = scored.sparkSession.range(1)
    kind = dict(scored.dtypes)[score]
    fixed = [F.lit(value).alias(name) for name, value in values.items()]
    return row.select(F.lit(None).cast(kind).alias("threshold"), *fixed)


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score, and the origin, which has no threshold."""
    points = threshold_counts(scored, label, score)
    points = points.select(
        "threshold",
        ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    return points.unionByName(_end_point(scored, score, fpr=0.0, tpr=0.0))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area: each score adds a strip whose two heights follow from its own counts."""
    points = threshold_counts(scored, label, score)
    strip = F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos")).cast("double")
    return points.agg(
        F.try_divide(
            F.sum(strip), F.lit(2.0) * F.max("all_pos") * F.max("all_neg")
        ).alias("auc")
    )


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score, and the end without positives, which has no threshold."""
    points = threshold_counts(scored, label, score)
    points = points.select(
        "threshold",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("all_pos")).alias("recall"),
    )
    return points.unionByName(_end_point(scored, score, precision=1.0, recall=0.0))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Sum of precision times the recall gained at each distinct score."""
    points = threshold_counts(scored, label, score)
    gained = F.col("pos") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return points.agg(
        F.try_divide(F.sum(gained), F.max("all_pos").cast("double")).alias("average_precision")
    )


def lift_table(
    scored: DataFrame, label: str = "label", score: str = "score", q: int = 10
) -> DataFrame:
    """Counts, rates and lift per score decile, riskiest first. Rows without a score are left out."""
    known = scored.select(label, score).where(F.col(score).isNotNull())
    binned = quantile_cut(known, score, q, "decile")
    rows = binned.groupBy("decile").agg(
        F.count(label).alias("n"),
        F.sum(F.col(label).cast("bigint")).alias("churned"),
        F.avg(score).alias("avg_churn_prob"),
    )
    # At most q rows from here on.
    everyone = Window.partitionBy()
    from_top = Window.orderBy(F.col("decile").desc())
    from_top = from_top.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = ratio(F.sum("churned").over(everyone), F.sum("n").over(everyone))
    rate = ratio(F.col("churned"), F.col("n"))
    return rows.select(
        "decile",
        "n",
        "churned",
        "avg_churn_prob",
        rate.alias("churn_rate"),
        F.sum("churned").over(from_top).alias("cum_churned"),
        F.try_divide(rate, base).alias("lift"),
    ).orderBy(F.col("decile").desc())


def regression_metrics(
    scored: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """MAE, RMSE, R squared and MAPE with denominators of at least 1, from one aggregate."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted)
    sums = scored.agg(
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.count("*") * F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(e / F.greatest(y, F.lit(1.0)))) * 100).alias("mape"),
    )
    return sums


def with_residuals(
    scored: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    return scored.withColumn("residual", F.col(actual).cast("double") - F.col(predicted))
