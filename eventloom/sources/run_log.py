"""Metrics, parameters and tags of a scoring run, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.schemas import RUN_METRICS, RUNS, as_schema
from eventloom.sources.warehouse import Warehouse

# Metric name -> column of the trend row.
METRICS: dict[str, str] = {
    "total_users": "total_users",
    "predicted_purchasers": "predicted_purchasers",
    "predicted_churners": "predicted_churners",
    "purchase_rate": "predicted_purchase_rate",
    "churn_rate": "predicted_churn_rate",
    "avg_p_prob": "avg_purchase_probability",
    "avg_c_prob": "avg_churn_probability",
    "high_value_count": "high_value_count",
    "high_risk_count": "high_risk_count",
    "actual_sessions": "actual_sessions",
    "actual_revenue": "actual_revenue",
    "trend_purchase_rate": "trend_purchase_rate",
    "trend_churn_rate": "trend_churn_rate",
}


def _run_name() -> Column:
    return F.concat(F.lit("Inference_"), F.col("prediction_date").cast("string"))


def run_metrics(trend: DataFrame) -> DataFrame:
    """The 13 metrics of each trend row, one per row."""
    wide = trend.select(
        _run_name().alias("run_name"),
        "prediction_date",
        *[F.col(c).cast("double").alias(m) for m, c in METRICS.items()],
    )
    long = wide.unpivot(["run_name", "prediction_date"], list(METRICS), "metric", "value")
    return as_schema(long, RUN_METRICS)


def _text_map(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def runs(trend: DataFrame, params: dict[str, str], source: str = "eventloom") -> DataFrame:
    """One row per run with its parameters and tags."""
    tags = {
        "prediction_date": F.col("prediction_date").cast("string"),
        "run_type": F.lit("inference"),
        "source": F.lit(source),
    }
    return as_schema(
        trend.select(
            _run_name().alias("run_name"),
            "prediction_date",
            _text_map({k: F.lit(v) for k, v in params.items()}).alias("params"),
            _text_map(tags).alias("tags"),
        ),
        RUNS,
    )


def log_run(
    warehouse: Warehouse, trend: DataFrame, params: dict[str, str], source: str = "eventloom"
) -> None:
    """Append the metrics and the run of a trend row; ``source`` names what ran."""
    warehouse.append("run_metrics", run_metrics(trend))
    warehouse.append("runs", runs(trend, params, source))
