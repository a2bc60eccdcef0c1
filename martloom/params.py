"""Everything a model run may be parameterised with.

Business rules in this warehouse depend on "now". It is a parameter here, so that a run can be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    # None means "the time the query runs".
    as_of: datetime | None = None
    # Rows loaded before this moment are left out by the staging models.
    start_date: datetime = datetime(2024, 1, 1)

    # Business thresholds.
    active_days: int = 30
    dormant_days: int = 90
    tier_vip: Decimal = Decimal(1000)
    tier_premium: Decimal = Decimal(500)
    tier_regular: Decimal = Decimal(100)
    recency_active_days: int = 30
    recency_warm_days: int = 90
    frequency_high: int = 10
    frequency_medium: int = 5
    monetary_high: Decimal = Decimal(1000)
    monetary_medium: Decimal = Decimal(500)

    # Whether customer and order ids occur once each: a property of the sources (the current state of captured
    # tables, or tables that have passed the uniqueness check). False is right for any ids and costs more.
    unique_ids: bool = False
