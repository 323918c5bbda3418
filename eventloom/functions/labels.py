"""Labels: promotion periods, funnel steps and stages, value and risk tiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Period(NamedTuple):
    """A named range of days, both ends included, as ``yyyyMMdd`` text."""

    label: str
    first_day: str
    last_day: str


# Promotion calendar and the label of all other days.
PROMO_CALENDAR: tuple[Period, ...] = (
    Period("black_friday", "20201123", "20201130"),
    Period("christmas", "20201207", "20201218"),
)
NORMAL_PERIOD = "normal"

# Funnel stages by step, from first contact to purchase.
FUNNEL_STAGES: dict[int, str] = {
    1: "발견",
    2: "흥미",
    3: "욕망",
    4: "구매 시도",
    5: "구매 임박",
    6: "구매 완료",
}

# Tier names and thresholds.
HIGH_VALUE, POTENTIAL_VALUE, LOW_VALUE = "고가치", "잠재", "저관여"
HIGH_RISK, STABLE = "고위험", "안정"
HIGH_VALUE_FROM, POTENTIAL_VALUE_FROM = 0.7, 0.4
PURCHASE_THRESHOLD, CHURN_THRESHOLD = 0.825, 0.65


def period_label(day: Column, calendar: Sequence[Period] = PROMO_CALENDAR) -> Column:
    """Label of the first calendar range holding ``day`` (``yyyyMMdd`` text)."""
    label = F.lit(NORMAL_PERIOD)
    for period in reversed(calendar):
        label = F.when(
            day.between(period.first_day, period.last_day), F.lit(period.label)
        ).otherwise(label)
    return label


def first_true(*cases: tuple[Column, object], default: object) -> Column:
    """Value of the first condition that holds, else ``default``."""
    if not cases:
        return F.lit(default)
    (condition, value), *rest = cases
    chain = F.when(condition, F.lit(value))
    return reduce(lambda c, x: c.when(x[0], F.lit(x[1])), rest, chain).otherwise(
        F.lit(default)
    )


def funnel_step() -> Column:
    """Deepest funnel step a session reached, from its event counts."""
    count = F.col
    return first_true(
        (count("session_purchase_count") > 0, 6),
        (
            (count("session_add_payment_info_count") > 0)
            | (count("session_add_shipping_info_count") > 0),
            5,
        ),
        (count("session_checkout_count") > 0, 4),
        (count("session_add_to_cart_count") > 0, 3),
        (count("session_view_item_count") > 0, 2),
        default=1,
    )


def funnel_stage(step: Column) -> Column:
    """Stage name of a funnel step; unknown steps count as the first stage."""
    later = [(step == n, name) for n, name in FUNNEL_STAGES.items() if n > 1]
    return first_true(*later, default=FUNNEL_STAGES[1])


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def value_tier(
    probability: Column,
    high: float = HIGH_VALUE_FROM,
    potential: float = POTENTIAL_VALUE_FROM,
) -> Column:
    return first_true(
        (probability >= high, HIGH_VALUE),
        (probability >= potential, POTENTIAL_VALUE),
        default=LOW_VALUE,
    )


def risk_tier(probability: Column, high: float = CHURN_THRESHOLD) -> Column:
    return first_true((probability >= high, HIGH_RISK), default=STABLE)
