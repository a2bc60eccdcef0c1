"""Business rules. The first matching branch wins; a comparison with null never matches."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.times import ago, days_between, now
from martloom.params import Params
from martloom.schemas import MONEY

# Labels of continents; anything else is "Other".
CONTINENT_LABELS = {
    "North America": "NA",
    "Europe": "EU",
    "Asia": "AS",
    "South America": "SA",
    "Africa": "AF",
    "Oceania": "OC",
}
# Labels of income groups; anything else is "Tier 3".
INCOME_LABELS = {"High Income": "Tier 1", "Upper Middle Income": "Tier 2"}


def first_match(branches: list[tuple[Column, object]], otherwise: object = None) -> Column:
    (condition, result), *rest = branches
    chain = reduce(lambda acc, branch: acc.when(*branch), rest, F.when(condition, result))
    return chain.otherwise(otherwise)


def no_money() -> Column:
    return F.lit(0).cast(MONEY)


def is_completed(status: Column) -> Column:
    return status == "completed"


# customers


def activity_status(last_order: Column, params: Params) -> Column:
    return first_match(
        [
            (last_order >= ago(params, timedelta(days=params.active_days)), "active"),
            (last_order >= ago(params, timedelta(days=params.dormant_days)), "dormant"),
        ],
        "inactive",
    )


def customer_tier(total_spent: Column, params: Params) -> Column:
    return first_match(
        [
            (total_spent >= F.lit(params.tier_vip), "VIP"),
            (total_spent >= F.lit(params.tier_premium), "Premium"),
            (total_spent >= F.lit(params.tier_regular), "Regular"),
            (total_spent > 0, "New"),
        ],
        "Prospect",
    )


def customer_lifetime_days(registered_at: Column, last_order: Column, params: Params) -> Column:
    return days_between(registered_at, F.coalesce(last_order, now(params)))


def days_between_orders(lifetime_days: Column, total_orders: Column) -> Column:
    per_order = lifetime_days.cast("double") / F.nullif(total_orders, F.lit(0))
    return F.when(total_orders == 0, F.lit(0.0)).otherwise(per_order)


def avg_order_value(total_spent: Column, total_orders: Column) -> Column:
    """Completed revenue over the number of all orders."""
    per_order = total_spent.cast("double") / F.nullif(total_orders, F.lit(0))
    return F.when(total_orders > 0, per_order).otherwise(F.lit(0.0))


def recency_segment(last_order: Column, params: Params) -> Column:
    age = days_between(last_order, now(params))
    return first_match(
        [(age <= params.recency_active_days, "Active"), (age <= params.recency_warm_days, "Warm")], "Cold"
    )


def frequency_segment(total_orders: Column, params: Params) -> Column:
    return first_match(
        [(total_orders >= params.frequency_high, "High"), (total_orders >= params.frequency_medium, "Medium")], "Low"
    )


def monetary_segment(total_spent: Column, params: Params) -> Column:
    return first_match(
        [
            (total_spent >= F.lit(params.monetary_high), "High"),
            (total_spent >= F.lit(params.monetary_medium), "Medium"),
        ],
        "Low",
    )


def continent_group(continent: Column) -> Column:
    return first_match([(continent == name, label) for name, label in CONTINENT_LABELS.items()], "Other")


def economic_tier(gdp_category: Column) -> Column:
    return first_match([(gdp_category == name, label) for name, label in INCOME_LABELS.items()], "Tier 3")


# orders and payments


def order_payment_status(payment_count: Column, total_paid: Column, order_amount: Column) -> Column:
    """Payments count whatever their own status; paying too much is still fully paid."""
    return first_match([(payment_count == 0, "unpaid"), (total_paid >= order_amount, "fully_paid")], "partially_paid")


def net_revenue(order_status: Column, order_amount: Column) -> Column:
    return F.when(is_completed(order_status), order_amount).otherwise(no_money())


def paid_amount(payment_status: Column, order_amount: Column) -> Column:
    """The order's amount once it is fully paid (not the sum of its payments)."""
    return F.when(payment_status == "fully_paid", order_amount).otherwise(no_money())


def outstanding_amount(order_amount: Column, total_paid: Column) -> Column:
    return order_amount - F.coalesce(total_paid, no_money())


def is_successful_payment(payment_status: Column) -> Column:
    return F.when(is_completed(payment_status), 1).otherwise(0)


# cohorts and regions


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals, rounded half-up; null if the whole is 0."""
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 2)


def mean(total: Column, count: Column) -> Column:
    """Average from an exact sum: independent of the order in which rows are added up."""
    return total.cast("double") / F.nullif(count, F.lit(0))
