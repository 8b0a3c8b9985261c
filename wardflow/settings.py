"""Analysis scope, thresholds and output labels. Everything here can be overridden by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Scope:
    """Which months, beds and claims an analysis covers.

    Claims admitted up to ``claims_until`` (the end, if not given) take part in choosing each stay's row: a report on some
    months still has to see later claims, since a stay's discharge can lie before its admission. ``chosen`` months are those
    that a report counts, all if not given.
    """

    start: date = date(2024, 6, 1)
    end: date = date(2026, 5, 31)
    bed_types: tuple[str, ...] = ("1", "2")
    own_flag: int = 1
    claim_kind: str = "1"
    claims_until: date | None = None
    chosen: tuple[date, ...] | None = None

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError(f"scope starts {self.start} after it ends {self.end}")

    @property
    def months(self) -> list[date]:
        """First day of each month of the scope."""
        first = self.start.year * 12 + self.start.month - 1
        last = self.end.year * 12 + self.end.month - 1
        return [date(m // 12, m % 12 + 1, 1) for m in range(first, last + 1)]

    @property
    def first_month(self) -> date:
        return self.months[0]

    @property
    def last_month(self) -> date:
        return self.months[-1]

    @property
    def periods(self) -> list[str]:
        return [m.strftime("%Y%m") for m in self.months]


@dataclass(frozen=True)
class Thresholds:
    z_limit: float = 1.5
    severe_below: float = 70.0
    idle_below: float = 75.0
    healthy_up_to: float = 85.0
    high_from: float = 75.0
    gap_above: float = 20.0
    min_months: int = 12
    min_claims: int = 30
    approx_month_days: int = 30
    approx_year_days: int = 365


@dataclass(frozen=True)
class Labels:
    yes: str = "yes"
    no: str = "no"
    unknown_facility: str = "facility: "
    unknown_type: str = "unspecified"
    no_public_beds: str = "no public beds"
    no_production: str = "no production"
    severe_idle: str = "severe idleness"
    idle: str = "idleness"
    healthy: str = "healthy"
    overload: str = "overload"
    no_stays: str = "no stays"
    above: str = "above"
    below: str = "below"
    within: str = "within"
    short_series: str = "short series"
    inconsistent: str = "registry inconsistency"
    no_public_beds_in_period: str = "no public beds in period"
    high_high: str = "high on both"
    high_public_only: str = "high on public beds only"
    low_low: str = "low on both"
    gap_alert: str = "gap between total and public beds above "


@dataclass(frozen=True)
class Settings:
    scope: Scope = field(default_factory=Scope)
    thresholds: Thresholds = field(default_factory=Thresholds)
    labels: Labels = field(default_factory=Labels)
