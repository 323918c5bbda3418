"""Schemas of the nested source events and of every derived table.

Derived tables are checked by name, order and type with :func:`conform`, so a mart
that drifts fails where it is built and not where it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.params import PARAM_SPECS


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _schema(columns: str, **nested: T.DataType) -> T.StructType:
    """Struct of "name type" pairs; a type may also be the name of a ``nested`` one.

    Needs no running session, unlike a DDL string.
    """
    types = _TYPES | nested
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, types[kind]) for name, kind in pairs])


_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
_PARAM = _schema(
    "key string, value slots",
    slots=_schema("string_value string, int_value bigint, double_value double"),
)
_ITEM = _schema(
    """
    item_id string, item_name string, item_brand string, item_variant string,
    item_category string, price double, price_in_usd double, quantity bigint,
    item_revenue double, item_revenue_in_usd double, item_list_id string,
    item_list_index string, promotion_name string, creative_name string
    """
)
NESTED_EVENT = _schema(
    """
    event_name string, event_date string, event_timestamp bigint,
    event_value_in_usd double, event_bundle_sequence_id bigint, stream_id string,
    platform string, user_pseudo_id string, user_first_touch_timestamp bigint,
    user_ltv ltv, device device, geo geo, traffic_source traffic,
    ecommerce ecommerce, event_params params, items items
    """,
    ltv=_schema("revenue double, currency string"),
    device=_schema(
        """
        category string, mobile_brand_name string, mobile_model_name string,
        operating_system string, operating_system_version string, language string,
        web_info web
        """,
        web=_schema("browser string, browser_version string"),
    ),
    geo=_schema(
        "continent string, sub_continent string, country string, region string, city string"
    ),
    traffic=_schema("medium string, name string, source string"),
    ecommerce=_schema(
        """
        total_item_quantity bigint, purchase_revenue_in_usd double,
        purchase_revenue double, tax_value_in_usd double, tax_value double,
        unique_items bigint, transaction_id string
        """
    ),
    params=T.ArrayType(_PARAM),
    items=T.ArrayType(_ITEM),
)

# Flat column -> path in the nested event. The timestamp and the user lead because
# grouping and sorting compare columns in this order and these two tell rows apart.
EVENT_FIELDS: dict[str, str] = {
    "event_timestamp": "event_timestamp",
    "user_pseudo_id": "user_pseudo_id",
    "event_name": "event_name",
    "event_date": "event_date",
    "event_value_in_usd": "event_value_in_usd",
    "event_bundle_sequence_id": "event_bundle_sequence_id",
    "stream_id": "stream_id",
    "platform": "platform",
    "user_first_touch_timestamp": "user_first_touch_timestamp",
    "revenue": "user_ltv.revenue",
    "currency": "user_ltv.currency",
    "category": "device.category",
    "mobile_brand_name": "device.mobile_brand_name",
    "mobile_model_name": "device.mobile_model_name",
    "operating_system": "device.operating_system",
    "operating_system_version": "device.operating_system_version",
    "language": "device.language",
    "browser": "device.web_info.browser",
    "browser_version": "device.web_info.browser_version",
    "continent": "geo.continent",
    "sub_continent": "geo.sub_continent",
    "country": "geo.country",
    "region": "geo.region",
    "city": "geo.city",
    "medium": "traffic_source.medium",
    "name": "traffic_source.name",
    "source": "traffic_source.source",
    "total_item_quantity": "ecommerce.total_item_quantity",
    "purchase_revenue_in_usd": "ecommerce.purchase_revenue_in_usd",
    "purchase_revenue": "ecommerce.purchase_revenue",
    "tax_value_in_usd": "ecommerce.tax_value_in_usd",
    "tax_value": "ecommerce.tax_value",
    "unique_items": "ecommerce.unique_items",
    "transaction_id": "ecommerce.transaction_id",
}

ITEM_FIELDS: tuple[str, ...] = tuple(_ITEM.fieldNames())

PARAM_COLUMNS: tuple[str, ...] = tuple(s.column for s in PARAM_SPECS)


def _type_at(path: str) -> T.DataType:
    node: T.DataType = NESTED_EVENT
    for part in path.split("."):
        node = node[part].dataType
    return node


# Column order of the flat event table as users see it.
_EVENT_ORDER = (
    "event_name", "event_date", "event_timestamp", "event_value_in_usd",
    "event_bundle_sequence_id", "stream_id", "platform", "user_pseudo_id",
    "user_first_touch_timestamp",
)
FLAT_EVENT = T.StructType(
    [
        T.StructField(c, _type_at(EVENT_FIELDS[c]))
        for c in _EVENT_ORDER + tuple(c for c in EVENT_FIELDS if c not in _EVENT_ORDER)
    ]
    + _ITEM.fields
    + [T.StructField(s.column, s.spark_type) for s in PARAM_SPECS]
    + [
        T.StructField("offset_minutes", T.IntegerType()),
        T.StructField("GMT", T.StringType()),
        T.StructField("hour_gmt", T.IntegerType()),
    ]
)

DAILY_SUMMARY = _schema(
    """
    event_date string, daily_sessions bigint, daily_users bigint,
    daily_revenue double, daily_transactions bigint, daily_avg_order_value double,
    daily_conversion_rate double, ground_shipping_cnt bigint,
    air_shipping_cnt bigint, period_label string
    """
)

ORDERS = _schema(
    """
    transaction_id string, user_pseudo_id string, event_date string,
    order_date date, order_month string, order_revenue double, item_count bigint,
    is_bundle_order int, period_label string
    """
)

ORDER_ITEMS = _schema(
    """
    transaction_id string, user_pseudo_id string, event_date string,
    item_name string, item_category string, item_revenue double,
    item_quantity bigint, event_month string, period_label string
    """
)

SESSION_FUNNEL = _schema(
    """
    user_pseudo_id string, ga_session_id bigint, session_date date,
    session_hour int, session_weekday string, session_page_views bigint,
    session_view_item_count bigint, session_add_to_cart_count bigint,
    session_checkout_count bigint, session_add_shipping_info_count bigint,
    session_add_payment_info_count bigint, session_purchase_count bigint,
    session_scroll_count bigint, session_event_count bigint,
    session_engagement_time bigint, session_device string,
    session_traffic_source string, session_traffic_medium string,
    session_number bigint, period_label string, session_funnel_step int,
    purchase_flag int, bounce_flag int, session_funnel_stage string,
    churn_session_flag int
    """
)

FUNNEL_DAILY = _schema(
    """
    event_date date, period_label string, funnel_step int, funnel_stage string,
    session_cnt bigint, drop_off_cnt bigint, drop_off_rate double,
    cumulative_pass_rate double
    """
)

DEVICE_CHANNEL = _schema(
    """
    session_device string, session_traffic_source string,
    session_traffic_medium string, total_sessions bigint, purchase_sessions bigint,
    bounce_sessions bigint, churn_sessions bigint, conversion_rate double,
    bounce_rate double, churn_session_rate double, avg_funnel_depth double,
    avg_page_views double, avg_engagement_time double
    """
)

# Additive parts per day; the two marts over the whole history are sums of them.
DEVICE_CHANNEL_DAILY = _schema(
    """
    session_date date, session_device string, session_traffic_source string,
    session_traffic_medium string, total_sessions bigint, purchase_sessions bigint,
    bounce_sessions bigint, churn_sessions bigint, depth_sum bigint, views_sum bigint,
    engagement_sum bigint, engagement_rows bigint
    """
)

USER_DAY_TOTALS = _schema(
    """
    event_date string, user_pseudo_id string, total_page_views bigint,
    view_item_count bigint, add_to_cart_count bigint, begin_checkout_count bigint,
    add_shipping_info_count bigint, add_payment_info_count bigint,
    purchase_count bigint, scroll_count bigint, user_engagement_count bigint,
    total_active_time bigint, total_events bigint
    """
)

USER_DAY_FACTS = _schema(
    "event_date string, user_pseudo_id string, kind string, fact string"
)

# State between daily runs: each user's last session, and the flags decided by each day.
USER_LAST_SESSION = _schema(
    "as_of date, user_pseudo_id string, session_date date, ga_session_id bigint"
)

CHURN_FLAGS = _schema(
    "decided_on date, user_pseudo_id string, session_date date, ga_session_id bigint"
)

# Additive parts of the model features per day and user. A fact may be NULL: no session and
# no page count as one more value.
FEATURE_DAY_TOTALS = _schema(
    """
    event_date string, user_pseudo_id string, total_events bigint,
    total_page_views bigint, add_to_cart_count bigint, purchase_count bigint,
    scroll_count bigint, engaged_cnt bigint, outbound_cnt bigint, search_cnt bigint,
    rows bigint, engagement_rows bigint, engagement_sum double, number_sum double
    """
)

FEATURE_DAY_FACTS = _schema(
    "event_date string, user_pseudo_id string, kind string, fact string"
)

# Which event rows a day holds: a digest of event and item columns and one of parameters.
EVENT_DIGESTS = _schema(
    "event_date string, digest_1 bigint, digest_2 bigint, params bigint"
)

# Mergeable states per day, and per day and user.
DAY_SKETCHES = _schema("event_date string, users binary, buyers binary, sessions binary")

USER_DAY_SKETCHES = _schema(
    """
    event_date string, user_pseudo_id string, session binary, view_item binary,
    purchase binary
    """
)

USER_FEATURES = _schema(
    """
    user_pseudo_id string, is_purchaser int, is_repeat_purchaser int,
    is_churned int, funnel_stage string, funnel_max_step int,
    total_page_views bigint, view_item_count bigint, add_to_cart_count bigint,
    begin_checkout_count bigint, add_shipping_info_count bigint,
    add_payment_info_count bigint, purchase_count bigint, scroll_count bigint,
    user_engagement_count bigint, view_to_cart_rate double,
    cart_to_purchase_rate double, checkout_abandonment bigint,
    total_sessions bigint, total_active_time bigint,
    avg_engagement_time_msec double, days_since_first_visit int,
    days_since_last_visit int, event_per_session double, visit_frequency double,
    prev_funnel_stage string, funnel_improvement int, unique_items_viewed bigint,
    main_device_category string, main_traffic_source string,
    first_traffic_source string
    """
)

MODEL_FEATURES = _schema(
    """
    user_pseudo_id string, total_events bigint, total_page_views bigint,
    add_to_cart_count bigint, purchase_count bigint,
    avg_engagement_time_msec double, ga_session_id_count bigint,
    unique_pages bigint, avg_session_number double, scroll_count bigint,
    engaged_cnt bigint, outbound_cnt bigint, search_cnt bigint,
    view_to_cart_rate double
    """
)

PREDICTIONS = _schema(
    """
    user_pseudo_id string, purchase_probability double, predicted_purchase int,
    churn_probability double, predicted_churn int, prediction_date date,
    value_segment string, risk_segment string
    """
)

PREDICTION_TREND = _schema(
    """
    prediction_date date, total_users bigint, predicted_purchasers bigint,
    predicted_churners bigint, predicted_purchase_rate double,
    predicted_churn_rate double, avg_purchase_probability double,
    avg_churn_probability double, high_value_count bigint, high_risk_count bigint,
    actual_sessions bigint, actual_revenue double, trend_purchase_rate double,
    trend_churn_rate double
    """
)

RUN_METRICS = _schema(
    "run_name string, prediction_date date, metric string, value double"
)

RUNS = _schema(
    "run_name string, prediction_date date, params text_map, tags text_map",
    text_map=_TEXT_MAP,
)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order, casting each to its declared type."""

    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            f.name
            if types[f.name] == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if its column names, order and types match, else raise."""
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if want != have:
        missing = [w for w in want if w not in have]
        extra = [h for h in have if h not in want]
        raise ValueError(
            f"schema mismatch: missing or changed {missing}, unexpected {extra}, "
            f"order {'differs' if not missing and not extra else 'not compared'}"
        )
    return df
