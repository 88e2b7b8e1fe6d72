"""Run parameters. Every operator takes its "today" from here; none asks the clock."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal


@dataclass(frozen=True)
class Config:
    as_of: date
    loaded_at: datetime | None = None
    cost_per_credit: Decimal = Decimal("3.00")
    query_history_days: int = 30
    metering_history_days: int = 30
    storage_history_days: int = 365
    storage_cost_per_tb_per_month: Decimal = Decimal("23.0")
    days_per_month: Decimal = Decimal("30.44")
    forecast_lookback_days: int = 60
    forecast_horizon_days: int = 30
    # Hour a metering row is booked on: "end" books [h, h+1) on h+1, "start" on h.
    meter_bucket: str = "end"
    # True keeps the one-day mismatch between insight spend (days - 1) and budget (days).
    strict_parity: bool = False
    # What to do when a batch brings columns the target lacks: "sync" adds them, "fail" raises.
    schema_policy: str = "sync"

    def __post_init__(self) -> None:
        if self.meter_bucket not in ("end", "start"):
            raise ValueError(f"meter_bucket must be 'end' or 'start', not {self.meter_bucket!r}")
        if self.schema_policy not in ("sync", "fail"):
            raise ValueError(f"schema_policy must be 'sync' or 'fail', not {self.schema_policy!r}")

    def days_ago(self, days: int) -> date:
        return self.as_of - timedelta(days=days)

    @property
    def load_time(self) -> datetime:
        return self.loaded_at or datetime.combine(self.as_of, datetime.min.time())

    @classmethod
    def from_env(cls, as_of: date, env: Mapping[str, str] | None = None, **overrides) -> Config:
        """Read the tunable knobs from environment-style settings, all optional."""
        env = os.environ if env is None else env
        knobs: dict = {}
        if "COST_PER_CREDIT" in env:
            knobs["cost_per_credit"] = Decimal(env["COST_PER_CREDIT"])
        if "WINDOW_DAYS" in env:
            knobs["query_history_days"] = knobs["metering_history_days"] = int(env["WINDOW_DAYS"])
        if "STORAGE_COST_PER_TB_PER_MONTH" in env:
            knobs["storage_cost_per_tb_per_month"] = Decimal(env["STORAGE_COST_PER_TB_PER_MONTH"])
        if "STORAGE_HISTORY_DAYS" in env:
            knobs["storage_history_days"] = int(env["STORAGE_HISTORY_DAYS"])
        if "FORECAST_LOOKBACK_DAYS" in env:
            knobs["forecast_lookback_days"] = int(env["FORECAST_LOOKBACK_DAYS"])
        return cls(as_of=as_of, **{**knobs, **overrides})
