"""Fitted models: customer segments, churn, returns, revenue and demand."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.functions.columns import ratio
from marginalia.operators import boosting, clean, features, forest
from marginalia.operators.aggregates import CHURN_FEATURES
from marginalia.operators.boosting import Boosted, Boosting
from marginalia.operators.forest import Forest, LevelForest, held_out_scores
from marginalia.operators.windows import running_totals

# Names of the clusters by falling mean monetary value.
CLUSTER_LABELS = ["Champions", "Loyal", "At Risk", "Lost"]

LINE_KEY = ["order_id", "product_id"]

RETURN_CATEGORIES = ["category", "sub_category", "channel", "segment"]
RETURN_FEATURES = [
    "sales", "quantity", "discount", "profit_margin", "ship_days",
    *[f"{name}_enc" for name in RETURN_CATEGORIES],
]
REVENUE_FEATURES = ["lag1", "lag3", "lag12", "month_num"]
RESIDUAL_FEATURES = ["lag1", "lag3", "month_num"]
DEMAND_FEATURES = [
    "sub_category_enc", "lag1", "lag2", "lag3", "rolling_mean3", "month_num",
]


@dataclass
class Fitted:
    """A fitted model with its feature names and the scored rows."""

    model: PipelineModel | LevelForest | Boosted
    features: list[str]
    scored: DataFrame


def rfm_clusters(
    customers: DataFrame, k: int = 4, seed: int = 42, restarts: int = 10
) -> DataFrame:
    """K-means on scaled recency, frequency and monetary value, the best of several starts.

    ``customers`` has customer_id and the three columns. Clusters are named by falling mean
    monetary value; beyond the fourth they are numbered.
    """
    columns = ["recency", "frequency", "monetary"]
    prepare = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=True),
        ]
    )
    # Ten starts read the points many times, so they are written once.
    base = storage.stage(customers.select("customer_id", *columns), "rfm")
    points = prepare.fit(base).transform(base).drop("_raw")
    points = points.persist()
    # Each start is a chain of small jobs; a few starts at a time fill the cluster's slots.
    with ThreadPool(min(restarts, 4)) as pool:
        starts = [KMeans(k=k, seed=seed + i) for i in range(restarts)]
        session = inheritable_thread_target(customers.sparkSession)
        fits = pool.map(session(lambda start: start.fit(points)), starts)
    best = min(fits, key=lambda model: model.summary.trainingCost)
    points.unpersist()
    placed = best.transform(points).withColumnRenamed("prediction", "cluster").drop("features")
    # One row per cluster.
    means = placed.groupBy("cluster").agg(F.avg("monetary").alias("_mean"))
    place = F.row_number().over(Window.orderBy(F.col("_mean").desc(), "cluster"))
    names = F.array(*[F.lit(name) for name in CLUSTER_LABELS])
    label = F.coalesce(
        F.try_element_at(names, place), F.concat(F.lit("Cluster "), place.cast("string"))
    )
    labels = means.select("cluster", label.alias("segment_label"))
    return placed.join(labels, "cluster").select(
        "customer_id", *columns, F.col("cluster").cast("bigint").alias("cluster"), "segment_label"
    )


def cluster_means(clusters: DataFrame) -> DataFrame:
    means = [
        F.round(F.avg(name), 2).alias(name) for name in ("recency", "frequency", "monetary")
    ]
    return clusters.groupBy("segment_label").agg(F.count("*").alias("customers"), *means)


def _pipeline(names: list[str], estimator: Estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    return Pipeline(stages=[assembler, estimator])


def balance_weights(train: DataFrame, label: str) -> tuple[float, float]:
    """Rows of each class, for class weights: two numbers."""
    row = train.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return float(row.neg), float(row.pos)


def fit_churn(
    customers: DataFrame,
    rounds: int = 300,
    rate: float = 0.05,
    depth: int = 5,
    threshold: float = 0.5,
    exclude_recency: bool = False,
    score_all: bool = False,
    seed: int = 42,
) -> Fitted:
    """Boosted trees for churn on an exact stratified split.

    The positive class weighs negatives over positives. Only customers of the test split get
    a probability unless ``score_all``; the rest stay NULL. The label follows from recency,
    so ``exclude_recency`` gives a model that cannot read it off.
    """
    names = [n for n in CHURN_FEATURES if not (exclude_recency and n == "recency")]
    # Counting, binning and scoring read the customers with their split, so they are written once.
    split = storage.stage(features.stratified_split(customers, ["customer_id"], "churned"), "split")
    train = split.where("is_test = 0")
    negatives, positives = balance_weights(train, "churned")
    heavy = negatives / positives if positives else 1.0
    table, edges = boosting.binned(train.withColumn("fold", F.lit(-1)), names, ["customer_id"], "churned")
    trees = Boosting(rounds, rate, depth, row_share=0.8, column_share=0.8, seed=seed)
    (model,) = boosting.fit(table, names, edges, trees, [(1.0, heavy)])
    storage.discard(table)
    scored = model.transform(split)
    probability = vector_to_array("probability")[1]
    if not score_all:
        probability = F.when(F.col("is_test") == 1, probability)
    scored = scored.withColumn("churn_prob", probability)
    scored = scored.withColumn("prediction", (F.col("churn_prob") >= threshold).cast("int"))
    return Fitted(model, names, scored.drop("rawPrediction", "probability"))


def return_inputs(lines: DataFrame) -> DataFrame:
    """Labelled lines with the model's numeric and encoded columns; missing numbers are 0."""
    rows = features.return_label(lines)
    rows = clean.encode_ordinal(rows, RETURN_CATEGORIES)
    numbers = [
        F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in RETURN_FEATURES
    ]
    return rows.select(*LINE_KEY, "returned", *numbers)


def fit_returns(
    lines: DataFrame, trees: int = 200, depth: int = 8, threshold: float = 0.5, seed: int = 42
) -> Fitted:
    """Random forest for return risk with balanced class weights on a stratified split.

    Each tree is grown from a bootstrap of all training lines, and no line carries its draws.
    """
    # Counting, binning and scoring read the lines with their split, so they are written once.
    split = storage.stage(features.stratified_split(return_inputs(lines), LINE_KEY, "returned"), "returns")
    negatives, positives = balance_weights(split.where("is_test = 0"), "returned")
    everyone = negatives + positives
    weights = tuple(everyone / (2 * rows) if rows else 1.0 for rows in (negatives, positives))
    known = F.coalesce("returned", F.raise_error(F.lit("labels must not be null")))
    train = split.where("is_test = 0").withColumn("returned", known)
    edges = forest.bin_edges(train, RETURN_FEATURES)
    table = forest.binned(train.withColumn("fold", F.lit(0)), RETURN_FEATURES, LINE_KEY, "returned", edges)
    model = forest.fit_levels(table, RETURN_FEATURES, edges, trees, depth, weights, seed)
    storage.discard(table)
    scored = model.score(split.where("is_test = 1"), "return_prob")
    scored = scored.withColumn("prediction", (F.col("return_prob") >= threshold).cast("int"))
    return Fitted(model, RETURN_FEATURES, scored)


def _fit_regression(
    rows: DataFrame, names: list[str], label: str, rounds: int, rate: float, depth: int,
    row_share: float, seed: int,
) -> Fitted:
    trees = GBTRegressor(
        labelCol=label,
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        subsamplingRate=row_share,
        seed=seed,
    )
    model = _pipeline(names, trees).fit(rows.where("is_test = 0"))
    scored = model.transform(rows.where("is_test = 1")).drop("features")
    scored = scored.withColumnRenamed("prediction", "predicted")
    return Fitted(model, names, scored.withColumn("actual", F.col(label).cast("double")))


def fit_revenue(lines: DataFrame, rounds: int = 200, rate: float = 0.05, seed: int = 42) -> Fitted:
    """Monthly revenue from its lags, trained on the first 80 % of the months."""
    rows = features.chronological_split(features.revenue_lags(lines), "month_no")
    # A row a month, which the fit reads several times: the lines are summed once.
    rows = storage.stage(rows, "months")
    return _fit_regression(rows, REVENUE_FEATURES, "revenue", rounds, rate, 6, 1.0, seed)


def fit_residuals(lines: DataFrame, rounds: int = 200, rate: float = 0.3, seed: int = 42) -> Fitted:
    """Monthly revenue on a random split, whose residuals are examined."""
    rows = storage.stage(features.hash_split(features.residual_lags(lines), ["month_no"]), "months")
    return _fit_regression(rows, RESIDUAL_FEATURES, "revenue", rounds, rate, 6, 1.0, seed)


def fit_demand(
    lines: DataFrame, rounds: int = 300, rate: float = 0.05, depth: int = 5, seed: int = 42
) -> Fitted:
    """Monthly quantity per sub-category from its lags, on a random split."""
    rows = clean.encode_ordinal(features.demand_lags(lines), ["sub_category"])
    rows = features.hash_split(rows, ["sub_category", "month_no"])
    return _fit_regression(rows, DEMAND_FEATURES, "quantity", rounds, rate, depth, 0.8, seed)


def feature_importance(fitted: Fitted) -> DataFrame:
    """Importance per feature, one row each."""
    model = fitted.model
    values = model.importances if isinstance(model, LevelForest | Boosted) else model.stages[-1].featureImportances
    rows = [(name, float(values[i])) for i, name in enumerate(fitted.features)]
    spark = fitted.scored.sparkSession
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def save_model(model: PipelineModel | Boosted, path: str) -> None:
    if isinstance(model, Boosted):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | Boosted:
    try:
        return boosting.load(SparkSession.active(), path)
    except AnalysisException:
        # Spark's own models keep folders, not a table.
        return PipelineModel.load(path)


def cross_validate(
    rows: DataFrame,
    names: list[str],
    keys: list[str],
    label: str,
    estimator: Estimator | Forest | Boosting,
    folds: int = 5,
    balanced: bool = False,
) -> DataFrame:
    """Stratified cross-validation: mean and deviation over folds of AUC, F1, precision, recall.

    A ``Forest`` or ``Boosting`` grows the trees of all folds from one binned table. Folds of an
    estimator are fitted side by side, as a fit is a chain of small jobs. Held-out scores are measured together.
    """
    numbered = storage.stage(features.stratified_folds(rows, keys, label, folds), "folds")
    if isinstance(estimator, Forest):
        return _over_folds(held_out_scores(numbered, names, keys, label, estimator, folds))
    if isinstance(estimator, Boosting):
        return _over_folds(boosting.held_out_scores(numbered, names, keys, label, estimator, folds, balanced))

    def held_out(fold: int) -> DataFrame:
        train = numbered.where(F.col("fold") != fold)
        own = estimator
        if balanced:
            # Weights follow from the training folds alone.
            negatives, positives = balance_weights(train, label)
            heavy = (negatives + positives) / (2 * positives) if positives else 1.0
            light = (negatives + positives) / (2 * negatives) if negatives else 1.0
            train = train.withColumn("weight", F.when(F.col(label) == 1, heavy).otherwise(light))
            own = estimator.copy({estimator.weightCol: "weight"})
        scored = _pipeline(names, own).fit(train).transform(numbered.where(F.col("fold") == fold))
        return scored.select(
            "fold", F.col(label).alias("label"), vector_to_array("probability")[1].alias("score")
        )

    with ThreadPool(folds) as pool:
        session = inheritable_thread_target(rows.sparkSession)
        parts = pool.map(session(held_out), range(folds))
    return _over_folds(storage.stage(reduce(DataFrame.unionByName, parts), "held-out"))


def _over_folds(scores: DataFrame) -> DataFrame:
    per_fold = fold_metrics(scores)
    metrics = ["auc", "f1", "precision", "recall"]
    summary = per_fold.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics],
    )
    cells = ", ".join(f"'{m}', {m}_mean, {m}_std" for m in metrics)
    return summary.select(F.expr(f"stack({len(metrics)}, {cells}) AS (metric, mean, std)"))


def fold_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """AUC, F1, precision and recall of each fold from one ordered pass over all scores."""
    label = F.col("label").cast("bigint")
    counts = scored.groupBy("fold", "score").agg(
        F.sum(label).alias("pos"), F.sum(1 - label).alias("neg")
    )
    running = running_totals(counts, ["fold", F.col("score").desc()], {"_tp": "pos"})
    folds = running.groupBy("fold").agg(
        F.min(F.col("_tp") - F.col("pos")).alias("_start"),
        F.sum("pos").alias("_pos"),
        F.sum("neg").alias("_neg"),
        F.sum(F.when(F.col("score") >= threshold, F.col("pos")).otherwise(0)).alias("_hit"),
        F.sum(F.when(F.col("score") >= threshold, F.col("neg")).otherwise(0)).alias("_false"),
        # The start of the fold shifts every strip alike, so it is taken off afterwards.
        F.sum(F.col("neg") * (2 * F.col("_tp") - F.col("pos")).cast("double")).alias("_area"),
    )
    area = F.col("_area") - 2.0 * F.col("_start") * F.col("_neg")
    zero = F.lit(0.0)
    said = F.col("_hit") + F.col("_false")
    return folds.select(
        "fold",
        F.try_divide(area, 2.0 * F.col("_pos") * F.col("_neg")).alias("auc"),
        F.coalesce(ratio(2 * F.col("_hit"), said + F.col("_pos")), zero).alias("f1"),
        F.coalesce(ratio(F.col("_hit"), said), zero).alias("precision"),
        F.coalesce(ratio(F.col("_hit"), F.col("_pos")), zero).alias("recall"),
    )


def churn_estimator(rounds: int = 200, rate: float = 0.05, depth: int = 6) -> Boosting:
    return Boosting(rounds, rate, depth)


def returns_estimator(trees: int = 100, depth: int | None = None) -> Forest:
    """Trees of any depth, as the reference grows them, with balanced classes."""
    return Forest(trees=trees, depth=depth)
