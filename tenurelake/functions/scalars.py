"""Column expressions shared by the marts: exact rounding, labels, derived attributes."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, functions as F

# Labels of the performance ratings and of the risk quartiles.
RATING_LABELS = {1: "Poor", 2: "Below Average", 3: "Good", 4: "Outstanding"}
RISK_LABELS = {1: "High Risk", 2: "Medium Risk", 3: "Low Risk", 4: "Very Low Risk"}

# The six ratings of a review.
SCORE_COLUMNS = [
    "performance_rating",
    "job_satisfaction",
    "environment_satisfaction",
    "relationship_satisfaction",
    "work_life_balance",
    "job_involvement",
]


def half_up(num: Column, den: Column, k: int = 0) -> Column:
    """``num / den`` rounded half up at ``k`` decimals, as an integer count of 10^-k steps.

    Integer arithmetic only, so the value does not depend on the order in which tasks add up.
    Both inputs must be whole and ``num`` not negative; a zero ``den`` gives NULL.
    """
    wide = num.cast("decimal(38,0)")
    base = F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", wide * F.lit(2 * 10**k) + base, base * F.lit(2))


def unscale(steps: Column, k: int) -> Column:
    return (steps / F.lit(float(10**k))).cast("double")


def exact_avg(total: Column, n: Column, k: int = 2) -> Column:
    return unscale(half_up(total, n, k), k)


def safe_pct(num: Column, den: Column, k: int = 2) -> Column:
    """``num * 100 / den`` at ``k`` decimals, NULL when ``den`` is zero."""
    return exact_avg(num * F.lit(100), den, k)


def cents(money: Column) -> Column:
    return (money.cast("decimal(18,2)") * F.lit(100)).cast("bigint")


def from_cents(value: Column) -> Column:
    return unscale(value, 2)


def full_name(first: str | Column = "first_name", last: str | Column = "last_name") -> Column:
    return F.concat(first, F.lit(" "), last)


def annual_income(monthly: str | Column = "monthly_income") -> Column:
    return (F.col(monthly) if isinstance(monthly, str) else monthly) * F.lit(12)


def duration_days(start: str, end: str) -> Column:
    return F.datediff(F.col(end), F.col(start))


def overall_score() -> Column:
    total = sum((F.col(c) for c in SCORE_COLUMNS[1:]), F.col(SCORE_COLUMNS[0]))
    return exact_avg(total, F.lit(len(SCORE_COLUMNS)))


def label(value: Column, labels: dict[int, str], default: str | None = None) -> Column:
    out = F.lit(default).cast("string")
    for key, text in labels.items():
        out = F.when(value == key, text).otherwise(out)
    return out


def rating_label(value: str = "performance_rating") -> Column:
    return label(F.col(value), RATING_LABELS, "Unknown")


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def clip(value: Column, low: Decimal | int, high: Decimal | int) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def parse_date(text: Column, default: dt.date) -> Column:
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.lit(default))


def changed_beyond(old: Column, new: Column, threshold: Decimal = Decimal("0.05")) -> Column:
    """True when ``new`` differs from ``old`` by strictly more than ``threshold`` of ``old``.

    Compared without dividing: no rounding at exactly five per cent. An ``old`` of zero or less
    has no relative change and counts as unchanged; NULL compares as unchanged too.
    """
    moved = (old > 0) & (F.abs(old - new) > old * F.lit(threshold))
    return F.coalesce(moved, F.lit(False))
