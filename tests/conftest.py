from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom.schemas import NESTED_EVENT  # noqa: E402
from eventloom.session import local_session  # noqa: E402
from eventloom.sources.scratch import clear_scratch  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def nested(spark):
    """Build nested events from partial dicts; everything left out is NULL."""

    def build(*events: dict):
        rows = []
        for event in events:
            filled = {f.name: None for f in NESTED_EVENT.fields} | {
                "event_name": "page_view",
                "event_date": "20201201",
                "event_timestamp": 1_606_800_000_000_000,
                "user_pseudo_id": "u",
            } | event
            params = filled["event_params"]
            if params is not None:
                filled["event_params"] = [
                    {
                        "key": key,
                        "value": {
                            "string_value": v if isinstance(v, str) else None,
                            "int_value": v if isinstance(v, int) else None,
                            "double_value": v if isinstance(v, float) else None,
                        },
                    }
                    for key, v in params
                ]
            rows.append(filled)
        return spark.createDataFrame(rows, NESTED_EVENT)

    return build


FLAT_DEFAULTS = {
    "event_timestamp": 1_606_800_000_000_000, "user_pseudo_id": "u",
    "event_name": "page_view", "event_date": "20201201", "param_ga_session_id": 1,
    "param_ga_session_number": 1, "param_engagement_time_msec": None,
    "category": "desktop", "source": "google", "medium": "cpc", "country": None,
    "region": None, "offset_minutes": 0, "param_page_location": None,
    "param_outbound": None, "param_search_term": None, "param_percent_scrolled": None,
    "param_shipping_tier": None, "transaction_id": None, "purchase_revenue": None,
    "item_name": None, "item_category": None, "price": None, "quantity": None,
}


@pytest.fixture
def flat(spark):
    """Build flat events from partial dicts over fixed defaults."""
    from checks.fixture import FLAT_COLUMNS

    def build(*events: dict):
        return spark.createDataFrame([FLAT_DEFAULTS | e for e in events], FLAT_COLUMNS)

    return build
