from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.inputs import flat_table, session_table
from eventloom import schemas
from eventloom.plans import marts, scoring
from eventloom.plans.features import model_features
from eventloom.schemas import conform

DAY = date(2020, 12, 19)


@pytest.fixture(scope="module")
def features(spark):
    return model_features(flat_table(spark, "/root/testdata/sf0.01")).cache()


def brute_force(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Minimise sum of log losses + |w|^2 / 2 on columns scaled by population deviation."""
    scale = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(scale == 0, 1, scale)
    z = np.hstack([z, np.ones((len(z), 1))])
    penalty = np.append(np.ones(x.shape[1]), 0.0)
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-12)
        w = w - np.linalg.solve(hessian, gradient)
    return 1 / (1 + np.exp(-z @ w))


def test_purchase_model_minimises_the_summed_loss(features):
    model = scoring.train_purchase(features)
    scored = (
        model.transform(scoring.purchase_matrix(features))
        .select(
            *scoring.PURCHASE_FEATURES,
            scoring.purchase_label().alias("y"),
            F.get(scoring.vector_to_array("probability"), F.lit(1)).alias("p"),
        )
        .toPandas()
    )
    x = scored[list(scoring.PURCHASE_FEATURES)].to_numpy(float)
    expected = brute_force(x, scored["y"].to_numpy(float))
    assert np.abs(expected - scored["p"].to_numpy()).max() < 1e-3


def test_single_class_label_is_rejected(features):
    buyers = features.where("purchase_count > 0")
    with pytest.raises(ValueError, match="both classes"):
        scoring.train_purchase(buyers)


def test_scoring_end_to_end(spark, features, tmp_path):
    sf = "/root/testdata/sf0.01"
    users = marts.user_features(
        flat_table(spark, sf), session_table(spark, sf), reference_date=DAY
    ).cache()
    path = str(tmp_path / "purchase")
    calls = []

    def train():
        calls.append(1)
        return scoring.train_purchase(features)

    first = scoring.load_or_train(spark, path, train)
    again = scoring.load_or_train(spark, path, train)
    assert len(calls) == 1
    assert first.stages[-1].coefficients == again.stages[-1].coefficients
    churn = scoring.train_churn(features, users)
    decided = scoring.with_decisions(scoring.score(features, again, churn)).cache()
    t7 = conform(scoring.predictions(decided, DAY), schemas.PREDICTIONS)
    t8 = conform(scoring.prediction_trend(decided, DAY), schemas.PREDICTION_TREND).first()
    assert t7.count() == features.count() == t8.total_users
    assert t7.agg(F.sum("predicted_purchase")).first()[0] == t8.predicted_purchasers
    assert t7.where("value_segment = '고가치'").count() == t8.high_value_count
    assert t7.where("purchase_probability NOT BETWEEN 0 AND 1").isEmpty()
    with_channels = scoring.train_churn(features, users, use_channels=True)
    assert scoring.score(features, again, with_channels, users).count() == t8.total_users


def test_a_model_that_cannot_be_read_is_not_trained_over(spark, tmp_path):
    folder = tmp_path / "model"
    folder.mkdir()
    (folder / "broken").write_text("x")
    with pytest.raises(Exception, match="metadata|Path|path|exist"):
        scoring.load_or_train(spark, str(folder), lambda: pytest.fail("trained"))
    assert (folder / "broken").read_text() == "x"


def test_churn_on_history_looks_past_the_cutoff(spark):
    flat = flat_table(spark, "/root/testdata/sf0.01")
    model = scoring.train_churn_on_history(flat, DAY, 15)
    assert model.stages[-1].coefficients.size == len(scoring.CHURN_FEATURES)
    with pytest.raises(ValueError, match="both classes"):
        scoring.train_churn_on_history(flat.where("event_date <= '20201201'"), DAY, 1)


def test_features_per_user_and_day(spark):
    flat = flat_table(spark, "/root/testdata/sf0.01")
    per_day = model_features(flat, by=("user_pseudo_id", "event_date"))
    assert per_day.columns == schemas.MODEL_FEATURES.fieldNames()
    days = flat.select("user_pseudo_id", "event_date").distinct().count()
    assert per_day.count() == days
    total = model_features(flat).agg(F.sum("total_events")).first()
    assert per_day.agg(F.sum("total_events")).first() == total


def decided_from(spark, *pairs):
    rows = [(f"u{i}", p, c, 2, 1) for i, (p, c) in enumerate(pairs)]
    df = spark.createDataFrame(
        rows,
        "user_pseudo_id string, purchase_probability double, churn_probability double, "
        "ga_session_id_count bigint, purchase_count bigint",
    )
    return scoring.with_decisions(df)


def test_thresholds_are_inclusive(spark):
    decided = decided_from(spark, (0.825, 0.65), (0.8249, 0.6499))
    rows = decided.orderBy("user_pseudo_id").collect()
    assert [(r.predicted_purchase, r.predicted_churn) for r in rows] == [(1, 1), (0, 0)]
    trend = scoring.prediction_trend(decided, DAY).first()
    assert (trend.actual_sessions, trend.actual_revenue) == (4, 60000.0)
    assert (trend.trend_purchase_rate, trend.trend_churn_rate) == (1.0, 0.5)


def test_no_users(spark):
    decided = decided_from(spark).where("false")
    assert scoring.predictions(decided, DAY).collect() == []
    row = scoring.prediction_trend(decided, DAY).first().asDict()
    assert row.pop("prediction_date") == DAY
    assert set(row.values()) == {0}


def test_features_from_parts_equal_the_direct_ones(flat):
    """NULL sessions and pages, a session over two days, a user without id."""
    from eventloom.plans.features import (
        feature_day_facts,
        feature_day_totals,
        model_features,
        model_features_of,
    )

    events = flat(
        {"param_ga_session_id": None, "param_page_location": "p"},
        {"param_ga_session_id": 5, "param_page_location": None},
        {"param_ga_session_id": 5, "event_date": "20201202", "param_page_location": "p"},
        {"param_ga_session_id": None, "event_date": "20201202", "event_name": "purchase"},
        {"user_pseudo_id": None, "param_engagement_time_msec": 7},
        {"user_pseudo_id": "v", "event_name": "add_to_cart", "param_outbound": "Yes"},
        {"user_pseudo_id": "v", "param_percent_scrolled": 90, "param_search_term": "x"},
    )
    parts = feature_day_totals(events), feature_day_facts(events)
    for by in (("user_pseudo_id",), ("user_pseudo_id", "event_date")):
        direct = sorted(map(str, model_features(events, by=by).collect()))
        assert sorted(map(str, model_features_of(*parts, by=by).collect())) == direct
    nobody = events.where("user_pseudo_id = 'nobody'")
    assert model_features_of(feature_day_totals(nobody), feature_day_facts(nobody)).count() == 0
