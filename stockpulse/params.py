"""Run parameters.  Every "today" is explicit so results are reproducible."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    """Thresholds of the ledger; defaults are the reference constants."""

    as_of: dt.datetime
    # suppression (view 2)
    stale_days: int = 7
    fence_days: int = 7
    early_issue_days: int = 7
    inventory_window_days: int = 45
    inventory_site_prefix: str = "WC-W"
    # quarantine pipe (view 3)
    lot_window_days: int = 65
    lot_sites: tuple[str, ...] = ("WF-Q", "UNDERINV")
    sop_days_series_10: int = 21
    sop_days_default: int = 14
    valid_expiry_days: int = 90
    # safety stock
    receipts_since: dt.datetime = dt.datetime(2020, 1, 1)
    demand_years: tuple[int, ...] = (2024, 2025)
    ss_value_cap: float = 20000.0
    # risk / buyer control
    default_lead_days: int = 30
    annual_factor: int = 12
    default_holding_rate: float = 0.25
    order_cost: float = 50.00
    fallback_multiplier: float = 1.5
    # semantics
    case_insensitive: bool = True  # text keys compare like a CI collation
    # Spark collation by which text is ordered (ORDER BY, MIN, MAX), e.g. UNICODE_CI; None: code points
    collation: str | None = None
    date_formats: tuple[str, ...] = ()  # date patterns to accept besides the known shapes
    normalize_issue_mo: bool = False  # True: clean issue order numbers like demand ones before matching
    dedupe_timing: bool = False  # True: a ledger row meets its item's earliest release only
    dedupe_vendor_join: bool = False  # True: buyer sums are not multiplied by ledger and safety-stock rows
    sort_by_severity: bool = False  # buyer queue: False keeps alphabetical urgency
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def today(self) -> dt.date:
        return self.as_of.date()
