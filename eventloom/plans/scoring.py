"""Purchase and churn models, per-user predictions and the daily trend row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.labels import (
    CHURN_THRESHOLD,
    HIGH_RISK,
    HIGH_VALUE,
    PURCHASE_THRESHOLD,
    risk_tier,
    value_tier,
)
from eventloom.plans.features import model_features, model_features_of
from eventloom.schemas import PREDICTION_TREND, PREDICTIONS, as_schema
from eventloom.sources.guards import path_exists

# Names and order of the features of both models.
PURCHASE_FEATURES = (
    "total_events", "total_page_views", "add_to_cart_count", "purchase_count",
    "avg_engagement_time_msec", "ga_session_id_count", "unique_pages",
    "avg_session_number", "scroll_count", "engaged_cnt", "outbound_cnt", "search_cnt",
    "view_to_cart_rate",
)
CHURN_FEATURES = (
    "total_events", "unique_pages", "scroll_count", "engaged_cnt",
    "avg_engagement_time_msec", "purchase_count", "total_page_views",
    "main_device_category", "main_traffic_source",
)
# Fixed value: assumed price of one purchase in the trend row.
ASSUMED_PRICE = 30_000


def purchase_matrix(features: DataFrame) -> DataFrame:
    """Features with missing numbers filled by 0."""
    return features.na.fill(0, list(PURCHASE_FEATURES))


def churn_matrix(
    features: DataFrame, user_channels: DataFrame | None = None
) -> DataFrame:
    """Churn features; the device and channel columns are constant 0 by default.

    ``user_channels`` (user features with one row per user) replaces the constants by a
    number per device and source name: a hash bucket, so no list of names is collected.
    """
    known = [c for c in CHURN_FEATURES if not c.startswith("main_")]
    channel_columns = ("main_device_category", "main_traffic_source")
    if user_channels is None:
        coded = features.withColumns({c: F.lit(0) for c in channel_columns})
    else:
        codes = {
            c: F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(1024)) + 1)
            for c in channel_columns
        }
        lookup = user_channels.select("user_pseudo_id", *channel_columns)
        coded = features.join(lookup, "user_pseudo_id", "left").withColumns(codes)
    return coded.na.fill(0, known)


def purchase_label() -> Column:
    """Bought at least once."""
    return (F.col("purchase_count") > 0).cast("int")


def label_counts(labelled: DataFrame, label: str) -> dict[int, int]:
    """Rows per label; at most one entry per class reaches the driver."""
    rows = labelled.groupBy(label).agg(F.count("*").alias("n")).limit(3).collect()
    return {r[label]: r["n"] for r in rows}


def fit_classifier(
    labelled: DataFrame,
    columns: Sequence[str],
    label: str,
    max_iter: int,
    strength: float = 1.0,
) -> PipelineModel:
    """Standardise the columns and fit an L2-regularised logistic regression.

    ``strength`` is the inverse regularisation of a loss summed over rows. Spark averages
    the loss and scales by the sample deviation (n - 1); the regularisation below undoes
    both, so the fitted probabilities are those of the summed loss on columns scaled by
    the population deviation.
    """
    # Read once per pass of the optimiser; a lost block is recomputed from its lineage.
    rows = labelled.select(*columns, label).persist()
    try:
        return _fit(rows, columns, label, max_iter, strength)
    finally:
        rows.unpersist()


def _fit(
    rows: DataFrame, columns: Sequence[str], label: str, max_iter: int, strength: float
) -> PipelineModel:
    counts = label_counts(rows, label)
    if set(counts) != {0, 1}:
        raise ValueError(
            f"label {label!r} must have both classes 0 and 1 to train on, found "
            f"{sorted(counts, key=str)}"
        )
    n = sum(counts.values())
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="raw_vector"),
        StandardScaler(
            inputCol="raw_vector", outputCol="vector", withMean=True, withStd=True
        ),
        LogisticRegression(
            featuresCol="vector",
            labelCol=label,
            maxIter=max_iter,
            regParam=(n - 1) / n / (n * strength),
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-9,
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def train_purchase(
    features: DataFrame, columns: Sequence[str] = PURCHASE_FEATURES, max_iter: int = 2000
) -> PipelineModel:
    """Purchase model. Leave ``purchase_count`` out of ``columns`` to keep the label from
    being one of its own features."""
    labelled = purchase_matrix(features).withColumn("bought", purchase_label())
    return fit_classifier(labelled, columns, "bought", max_iter)


def train_churn(
    features: DataFrame,
    user_features: DataFrame,
    max_iter: int = 100,
    use_channels: bool = False,
) -> PipelineModel:
    """Churn model on the churn flag of the user features."""
    flags = user_features.select("user_pseudo_id", "is_churned")
    matrix = churn_matrix(features, user_features if use_channels else None)
    labelled = matrix.join(flags, "user_pseudo_id")
    return fit_classifier(labelled, CHURN_FEATURES, "is_churned", max_iter)


def cut_off(until: date, churn_days: int) -> str:
    """The last day of the features a churn model is trained on."""
    return (until - timedelta(days=churn_days)).strftime("%Y%m%d")


def _train_on_return(features: DataFrame, later: DataFrame, max_iter: int) -> PipelineModel:
    """Churn model whose label says who of ``features`` is not among the ``later`` rows."""
    back = later.select("user_pseudo_id", F.lit(0).alias("gone")).distinct()
    labelled = churn_matrix(features).join(back, "user_pseudo_id", "left")
    labelled = labelled.withColumn("is_churned", F.coalesce("gone", F.lit(1)))
    return fit_classifier(labelled, CHURN_FEATURES, "is_churned", max_iter)


def train_churn_on_history(
    history: DataFrame, until: date, churn_days: int, max_iter: int = 100
) -> PipelineModel:
    """Churn model on stored events: features up to a cut-off, label from what follows.

    The cut-off is ``churn_days`` before ``until``. A user has churned (1) who was active
    by the cut-off and not between it and ``until``. Both periods are read by day.
    """
    day, last = F.col("event_date"), cut_off(until, churn_days)
    features = model_features(history.where(day <= last))
    return _train_on_return(features, history.where(day > last), max_iter)


def train_churn_on_parts(
    totals: DataFrame, facts: DataFrame, until: date, churn_days: int, max_iter: int = 100
) -> PipelineModel:
    """As :func:`train_churn_on_history`, from the feature parts of the days."""
    day, last = F.col("event_date"), cut_off(until, churn_days)
    features = model_features_of(totals.where(day <= last), facts.where(day <= last))
    return _train_on_return(features, totals.where(day > last), max_iter)


def load_or_train(
    spark: SparkSession, path: str, train: Callable[[], PipelineModel]
) -> PipelineModel:
    """The model saved at ``path``; if there is none, ``train()`` and save it.

    A model that is there but cannot be read is an error: it is never trained over. A
    trained model is read back: the one in memory carries its training summary, which
    holds on to the session and cannot always be sent to the executors.
    """
    if not path_exists(spark, path):
        train().write().save(path)
    return PipelineModel.load(path)


def _probability(model: PipelineModel, matrix: DataFrame, name: str) -> DataFrame:
    scored = model.transform(matrix).withColumn(
        name, F.get(vector_to_array("probability"), F.lit(1))
    )
    return scored.drop("raw_vector", "vector", "rawPrediction", "probability", "prediction")


def score(
    features: DataFrame,
    purchase_model: PipelineModel,
    churn_model: PipelineModel,
    user_channels: DataFrame | None = None,
) -> DataFrame:
    """Features plus ``purchase_probability`` and ``churn_probability``, row by row."""
    bought = _probability(purchase_model, purchase_matrix(features), "purchase_probability")
    return _probability(churn_model, churn_matrix(bought, user_channels), "churn_probability")


def with_decisions(
    scored: DataFrame,
    purchase_from: float = PURCHASE_THRESHOLD,
    churn_from: float = CHURN_THRESHOLD,
) -> DataFrame:
    """Add 0/1 decisions and tiers from the two probabilities."""
    purchase, churn = F.col("purchase_probability"), F.col("churn_probability")
    return scored.withColumns(
        {
            "predicted_purchase": (purchase >= purchase_from).cast("int"),
            "predicted_churn": (churn >= churn_from).cast("int"),
            "value_segment": value_tier(purchase),
            "risk_segment": risk_tier(churn, churn_from),
        }
    )


def predictions(decided: DataFrame, prediction_date: date) -> DataFrame:
    """Per-user result table. No users give no rows and the same schema."""
    return as_schema(
        decided.withColumn("prediction_date", F.lit(prediction_date)), PREDICTIONS
    )


def prediction_trend(
    decided: DataFrame, prediction_date: date, assumed_price: float = ASSUMED_PRICE
) -> DataFrame:
    """One row summing up a day's predictions; all zeros when there are no users."""
    users = F.count("*")
    bought = F.coalesce(F.sum("purchase_count"), F.lit(0))
    churners = F.coalesce(F.sum("predicted_churn"), F.lit(0))

    def mean(column: str) -> Column:
        return F.coalesce(F.avg(column), F.lit(0.0))

    def per_user(total: Column) -> Column:
        return F.coalesce(total / F.nullif(users, F.lit(0)), F.lit(0.0))

    trend = decided.agg(
        users.alias("total_users"),
        F.coalesce(F.sum("predicted_purchase"), F.lit(0)).alias("predicted_purchasers"),
        churners.alias("predicted_churners"),
        mean("predicted_purchase").alias("predicted_purchase_rate"),
        mean("predicted_churn").alias("predicted_churn_rate"),
        mean("purchase_probability").alias("avg_purchase_probability"),
        mean("churn_probability").alias("avg_churn_probability"),
        F.count_if(F.col("value_segment") == HIGH_VALUE).alias("high_value_count"),
        F.count_if(F.col("risk_segment") == HIGH_RISK).alias("high_risk_count"),
        F.coalesce(F.sum("ga_session_id_count"), F.lit(0)).alias("actual_sessions"),
        (bought * assumed_price).alias("actual_revenue"),
        per_user(bought).alias("trend_purchase_rate"),
        per_user(churners).alias("trend_churn_rate"),
    )
    return as_schema(
        trend.withColumn("prediction_date", F.lit(prediction_date)), PREDICTION_TREND
    )
