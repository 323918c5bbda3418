"""Web events derived from the supplied ``events`` and ``part`` tables.

Every source row is used. Some users' days are moved to earlier dates, which leaves the
gaps in their visits that the churn flags need; see README.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.geo_time import MICROS_PER_DAY
from eventloom.schemas import NESTED_EVENT, as_schema

# Source days start 2024-01-01; the derived ones start 2020-11-20.
DAYS_BACK = 1137
# Columns of the flat form the marts and features read.
FLAT_COLUMNS = (
    "event_timestamp bigint, user_pseudo_id string, event_name string, "
    "event_date string, param_ga_session_id bigint, param_ga_session_number bigint, "
    "param_engagement_time_msec bigint, category string, source string, medium string, "
    "country string, region string, offset_minutes int, param_page_location string, "
    "param_outbound string, param_search_term string, param_percent_scrolled bigint, "
    "param_shipping_tier string, transaction_id string, purchase_revenue double, "
    "item_name string, item_category string, price double, quantity bigint"
)
ITEM_EVENTS = ("purchase", "view_item", "add_to_cart")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86400 + (
        F.hour(ts) * 3600 + F.minute(ts) * 60
    )
    of_minute = F.extract(F.lit("SECOND"), ts) * 1_000_000
    return seconds * 1_000_000 + of_minute.cast("long")


def _choice(selector: Column, *values: object) -> Column:
    """``values[selector]``."""
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(selector == i, F.lit(values[i])).otherwise(out)
    return out


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source event with the few columns that all others follow from."""
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")

    day = F.floor(F.col("us0") / MICROS_PER_DAY)
    moved_back = (
        F.when((user % 10 == 0) & day.between(18591, 18610), 30)
        .when((user % 10 == 1) & (day > 18597), 60)
        .otherwise(0)
    )
    event_name = (
        F.when(kind == "view", _choice(event % 3, "page_view", "view_item", "scroll"))
        .when(
            kind == "click",
            _choice(event % 3, "add_to_cart", "begin_checkout", "user_engagement"),
        )
        .when(kind == "signup", _choice(event % 2, "add_shipping_info", "add_payment_info"))
        .when(kind == "error", F.lit("page_view"))
        .when(event % 4 == 0, F.lit("purchase"))
        .otherwise(F.lit("view_item"))
    )
    return (
        read_table(spark, sf_dir, "events")
        .withColumns(
            {
                "k": F.get_json_object("props", "$.k").cast("long"),
                "us0": _micros(F.col("ts")) - DAYS_BACK * MICROS_PER_DAY,
            }
        )
        .withColumns(
            {
                "event_timestamp": F.col("us0") - moved_back * F.lit(MICROS_PER_DAY),
                "event_name": event_name,
            }
        )
        .select("event_id", "user_id", "event_type", "value", "k", "event_timestamp", "event_name")
    )


def by_day(source: DataFrame) -> DataFrame:
    """``source`` with ``event_date``, dealt out by it as the tables are partitioned.

    Rows move before they are derived, while they are narrow.
    """
    days = F.floor(F.col("event_timestamp") / MICROS_PER_DAY).cast("int")
    return source.withColumn(
        "event_date", F.date_format(F.date_from_unix_date(days), "yyyyMMdd")
    ).hint("rebalance", "event_date")


def base_events(source: DataFrame, *carried: str) -> DataFrame:
    """Every scalar column of the flat form, and the ``carried`` ones.

    Made of rows that have found their items and lie by day: joins and the exchange by day
    then shuffle the few columns of :func:`source_events` and not all those that follow.
    """
    source = by_day(source)
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    k, us, name = F.col("k"), F.col("event_timestamp"), F.col("event_name")
    is_purchase = name == "purchase"
    return source.select(
        *carried,
        "event_id",
        "k",
        "value",
        us.alias("event_timestamp"),
        user.cast("string").alias("user_pseudo_id"),
        name.alias("event_name"),
        "event_date",
        F.when(k != 0, F.floor(us / (MICROS_PER_DAY // 4))).alias("param_ga_session_id"),
        (F.floor(us / MICROS_PER_DAY) - 18585).alias("param_ga_session_number"),
        F.when(k % 5 != 0, F.floor(F.col("value") * 100)).alias("param_engagement_time_msec"),
        # Device, channel and place change from event to event, with NULLs and ties.
        _choice((user + k) % 4, "desktop", "mobile", "tablet", None).alias("category"),
        _choice(
            (user + event) % 5, "google", "(direct)", "shop.example", None, "news.example"
        ).alias("source"),
        _choice((user + k) % 5, "cpc", "(none)", "referral", None, "email").alias("medium"),
        _choice(
            (user + event) % 8, "United States", "United States", "Canada", "India", "Georgia",
            "Nepal", "Atlantis", None,
        ).alias("country"),
        _choice(
            (user + event) % 8, "California", "Georgia", "Newfoundland and Labrador", None,
            None, None, None, None,
        ).alias("region"),
        _choice((user + event) % 8, -480, -300, -210, 330, 240, 345, 0, 0).alias(
            "offset_minutes"
        ),
        F.when(k % 7 != 0, F.concat(F.lit("/p/"), (k % 20).cast("string"))).alias(
            "param_page_location"
        ),
        F.when(kind == "click", _choice(k % 4, "True", "false", "YES", None)).alias(
            "param_outbound"
        ),
        F.when(
            (kind == "view") & (k % 11 == 0), F.concat(F.lit("q"), k.cast("string"))
        ).alias("param_search_term"),
        F.when(name == "scroll", k).alias("param_percent_scrolled"),
        F.when(
            name == "add_shipping_info",
            _choice(k % 4, "Ground", "Next Day Air", "2 Day Air", None),
        ).alias("param_shipping_tier"),
        F.when(
            is_purchase & (k % 10 != 0), F.floor(event / 8).cast("string")
        ).alias("transaction_id"),
        F.when(is_purchase, F.col("value")).alias("purchase_revenue"),
    )


def _item_key(parts: DataFrame, ordinal: Column) -> Column:
    """Part shown as item ``ordinal`` of an event.

    Events with no such item get a key no part has, spread over many values so that a
    shuffled join does not send them all to one task.
    """
    n_parts = parts.agg(F.count("*")).scalar()
    shown = F.col("event_name").isin(*ITEM_EVENTS) & (ordinal <= F.col("k") % 3)
    return F.when(shown, (F.col("event_id") * 7 + ordinal * 13) % n_parts).otherwise(
        -1 - F.col("event_id") % 1000
    )


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat form: one row per event and item, as the marts read it."""
    parts = read_table(spark, sf_dir, "part")
    source = source_events(spark, sf_dir)
    last = F.when(
        F.col("event_name").isin(*ITEM_EVENTS), (F.col("k") % 3).cast("int")
    ).otherwise(F.lit(0))
    rows = source.withColumn("j", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.withColumn("item_key", _item_key(parts, F.col("j")))
    items = parts.select(
        F.col("p_partkey").alias("item_key"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("item_category"),
        F.col("p_retailprice").alias("price"),
    )
    joined = rows.join(items, "item_key", "left").withColumn(
        "quantity", F.when(F.col("item_key") >= 0, F.col("k") % 4 + 1)
    )
    return base_events(
        joined, "item_name", "item_category", "price", "quantity"
    ).drop("k", "value", "event_id")


def _value(
    text: Column | None = None, integer: Column | None = None, double: Column | None = None
) -> Column:
    null = F.lit(None)
    return F.struct(
        (null if text is None else text).cast("string").alias("string_value"),
        (null if integer is None else integer).cast("long").alias("int_value"),
        (null if double is None else double).cast("double").alias("double_value"),
    )


def _params() -> Column:
    c, k = F.col, F.col("k")

    def entry(key: str, present: Column, **slots: Column) -> Column:
        return F.when(
            present, F.struct(F.lit(key).alias("key"), _value(**slots).alias("value"))
        )

    def carried(key: str, slot: str) -> Column:
        column = c(f"param_{key}")
        return entry(key, column.isNotNull(), **{slot: column})

    purchase = c("event_name") == "purchase"
    page = c("param_page_location")
    return F.array_compact(
        F.array(
            # A page that repeats: the copy comes first and is the smaller text.
            entry(
                "page_location",
                page.isNotNull() & (k % 9 == 0),
                text=F.concat(F.lit("/dup"), page),
            ),
            carried("ga_session_id", "integer"),
            carried("ga_session_number", "integer"),
            entry(
                "engagement_time_msec",
                c("param_engagement_time_msec").isNotNull(),
                integer=c("param_engagement_time_msec") + c("copy"),
            ),
            carried("page_location", "text"),
            carried("outbound", "text"),
            carried("search_term", "text"),
            carried("percent_scrolled", "integer"),
            carried("shipping_tier", "text"),
            entry("session_engaged", k % 3 == 0, text=F.lit("1")),
            entry("session_engaged", k % 3 == 1, integer=F.lit(1)),
            entry("tax", purchase & (k % 2 == 0), double=c("value")),
            entry("tax", purchase & (k % 2 == 1), integer=k),
            entry("value", purchase, double=c("value"), integer=k),
            entry("transaction_id", c("transaction_id").isNotNull() & (k % 2 == 0),
                  text=c("transaction_id")),
            entry("transaction_id", c("transaction_id").isNotNull() & (k % 2 == 1),
                  integer=c("transaction_id").cast("long")),
            entry("unread_key", k % 4 == 0, text=F.lit("x")),
        )
    )


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested form. Some events appear twice with different parameter values."""
    parts = read_table(spark, sf_dir, "part")
    copies = F.when(F.col("k") % 10 == 3, F.lit(1)).otherwise(F.lit(0))
    events = source_events(spark, sf_dir).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), copies))
    )
    items = []
    for j in range(3):
        looked_up = parts.select(
            F.col("p_partkey").alias(f"key_{j}"),
            F.struct(
                F.col("p_partkey").cast("string").alias("id"),
                F.col("p_name").alias("name"),
                F.col("p_brand").alias("brand"),
                F.col("p_type").alias("type"),
                F.col("p_retailprice").alias("price"),
            ).alias(f"part_{j}"),
        )
        events = events.withColumn(f"key_{j}", _item_key(parts, F.lit(j))).join(
            looked_up, f"key_{j}", "left"
        )
        part = F.col(f"part_{j}")
        null_text = F.lit(None).cast("string")
        null_number = F.lit(None).cast("double")
        items.append(
            F.when(
                part.isNotNull(),
                F.struct(
                    part["id"].alias("item_id"),
                    part["name"].alias("item_name"),
                    part["brand"].alias("item_brand"),
                    null_text.alias("item_variant"),
                    part["type"].alias("item_category"),
                    part["price"].alias("price"),
                    part["price"].alias("price_in_usd"),
                    (F.col("k") % 4 + 1).alias("quantity"),
                    null_number.alias("item_revenue"),
                    null_number.alias("item_revenue_in_usd"),
                    null_text.alias("item_list_id"),
                    null_text.alias("item_list_index"),
                    null_text.alias("promotion_name"),
                    null_text.alias("creative_name"),
                ),
            )
        )
    # The first item is listed twice in some events: equal items merge when flattened.
    repeated = F.when(F.col("k") % 6 == 1, items[0])
    listed = F.array_compact(F.array(*items, repeated))
    shown = [f"part_{j}" for j in range(3)]
    events = base_events(events, "copy", *shown)

    def null(kind: str = "string") -> Column:
        return F.lit(None).cast(kind)

    nested = events.select(
        "event_name",
        "event_date",
        "event_timestamp",
        F.when(F.col("event_name") == "purchase", F.col("value")).alias("event_value_in_usd"),
        F.col("event_id").alias("event_bundle_sequence_id"),
        F.lit("stream-1").alias("stream_id"),
        F.lit("WEB").alias("platform"),
        "user_pseudo_id",
        null("long").alias("user_first_touch_timestamp"),
        F.struct(F.lit(0.0).alias("revenue"), F.lit("USD").alias("currency")).alias("user_ltv"),
        F.struct(
            "category",
            null().alias("mobile_brand_name"),
            null().alias("mobile_model_name"),
            F.lit("Web").alias("operating_system"),
            null().alias("operating_system_version"),
            F.lit("en-us").alias("language"),
            F.struct(
                F.lit("Chrome").alias("browser"), null().alias("browser_version")
            ).alias("web_info"),
        ).alias("device"),
        F.struct(
            null().alias("continent"),
            null().alias("sub_continent"),
            "country",
            "region",
            null().alias("city"),
        ).alias("geo"),
        F.struct("medium", null().alias("name"), "source").alias("traffic_source"),
        F.struct(
            null("long").alias("total_item_quantity"),
            null("double").alias("purchase_revenue_in_usd"),
            "purchase_revenue",
            null("double").alias("tax_value_in_usd"),
            null("double").alias("tax_value"),
            null("long").alias("unique_items"),
            "transaction_id",
        ).alias("ecommerce"),
        _params().alias("event_params"),
        F.when(F.size(listed) > 0, listed)
        .when(F.col("k") % 2 == 0, F.filter(listed, lambda _: F.lit(False)))
        .alias("items"),
    )
    return as_schema(nested, NESTED_EVENT)
