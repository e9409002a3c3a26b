"""Validated run parameters shared by all jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from wardmill.constants import SCORING_LOOKBACK_DAYS
from wardmill.sources.writers import DISPOSITIONS


@dataclass(frozen=True)
class RunParams:
    run_date: str
    lookback_days: int = SCORING_LOOKBACK_DAYS
    write_disposition: str = "WRITE_APPEND"
    dry_run: bool = False

    def __post_init__(self) -> None:
        try:
            parsed = date.fromisoformat(self.run_date)
        except (TypeError, ValueError) as e:
            raise ValueError(f"run_date must be YYYY-MM-DD, got {self.run_date!r}") from e
        if parsed.isoformat() != self.run_date:
            raise ValueError(f"run_date must be YYYY-MM-DD, got {self.run_date!r}")
        if not isinstance(self.lookback_days, int) or not 1 <= self.lookback_days <= 365:
            raise ValueError(f"lookback_days must be a whole number from 1 to 365, got {self.lookback_days!r}")
        if self.write_disposition not in DISPOSITIONS:
            raise ValueError(f"write_disposition must be one of {sorted(DISPOSITIONS)}")

    def days_back(self, days: int) -> str:
        return (date.fromisoformat(self.run_date) - timedelta(days=days)).isoformat()
