"""Turn the key/value parameter array of an event into typed columns, inside the row.

The array is never exploded: a parameter lookup costs a scan of one event's own array
and no shuffle. A key that an event carries more than once yields the largest value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The parameter keys and the slot each one is read from.
TEXT_KEYS = (
    "campaign", "clean_event", "coupon", "currency", "link_classes", "link_domain",
    "link_url", "medium", "outbound", "page_location", "page_referrer", "page_title",
    "payment_type", "promotion_name", "search_term", "shipping_tier", "source", "term",
)
INTEGER_KEYS = (
    "debug_mode", "engaged_session_event", "engagement_time_msec", "entrances",
    "ga_session_id", "ga_session_number", "percent_scrolled", "unique_search_term",
)
MIXED_KEYS = {
    "session_engaged": "text_or_integer",
    "tax": "number_as_text",
    "transaction_id": "text_or_integer",
    "value": "number_as_text",
}

@dataclass(frozen=True)
class ParamSpec:
    """One parameter key and the slot its value is taken from."""

    key: str
    slot: str

    @property
    def column(self) -> str:
        return f"param_{self.key}"

    @property
    def spark_type(self) -> T.DataType:
        return T.LongType() if self.slot == "integer" else T.StringType()


PARAM_SPECS: tuple[ParamSpec, ...] = (
    tuple(ParamSpec(k, "text") for k in TEXT_KEYS)
    + tuple(ParamSpec(k, "integer") for k in INTEGER_KEYS)
    + tuple(ParamSpec(k, slot) for k, slot in MIXED_KEYS.items())
)

# Value of a slot that is a field of its own, and of one that mixes fields.
_FIELDS = {"text": "string_value", "integer": "int_value"}
_MIXTURES = {
    "text_or_integer": "coalesce(v.string_value, CAST(v.int_value AS STRING))",
    "number_as_text": (
        "CAST(coalesce(v.double_value, CAST(v.int_value AS DOUBLE)) AS STRING)"
    ),
}


def _one_per_key(params: str) -> str:
    """The array with each key once; a repeated key gets the maximum of every field.

    Only events that do repeat a key pay for the rewrite.
    """
    fields = ", ".join(
        f"'{f}', array_max(transform(filter({params}, p -> p.key = k), p -> p.value.{f}))"
        for f in ("string_value", "int_value", "double_value")
    )
    merged = (
        f"transform(array_distinct({params}.key), "
        f"k -> named_struct('key', k, 'value', named_struct({fields})))"
    )
    return f"CASE WHEN {_repeats(params)} THEN {merged} ELSE {params} END"


def _repeats(params: str) -> str:
    return f"size(array_distinct({params}.key)) < size({params}.key)"


def param_sql(spec: ParamSpec, params: str, one_per_key: str, repeats: str) -> str:
    """SQL of one parameter column.

    A value is found by position in the array with unique keys, which compiles with the
    rest of the stage. A mixed slot takes the maximum of the mixed values, so an event that
    repeats keys looks at every occurrence of it.
    """
    at = f"array_position({one_per_key}.key, '{spec.key}') - 1"
    found = f"get({one_per_key}, CAST({at} AS INT)).value"
    if spec.slot in _FIELDS:
        return f"{found}.{_FIELDS[spec.slot]}"
    mixture = _MIXTURES[spec.slot]
    same_key = f"transform(filter({params}, p -> p.key = '{spec.key}'), p -> p.value)"
    largest = f"array_max(transform({same_key}, v -> {mixture}))"
    return f"CASE WHEN {repeats} THEN {largest} ELSE {mixture.replace('v.', found + '.')} END"


def pivot_params(
    events: DataFrame,
    params: str = "event_params",
    specs: Sequence[ParamSpec] = PARAM_SPECS,
) -> DataFrame:
    """Replace the parameter array by one column per spec."""
    unique, repeats = "one_per_key", "repeats_a_key"
    rest = [f"`{c}`" for c in events.columns if c != params]
    pivoted = [f"{param_sql(s, params, unique, repeats)} AS {s.column}" for s in specs]
    return events.withColumns(
        {unique: F.expr(_one_per_key(params)), repeats: F.expr(_repeats(params))}
    ).selectExpr(*rest, *pivoted)
