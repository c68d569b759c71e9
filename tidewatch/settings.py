"""Parameters of a build. Only a missing report day is taken from the clock."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(*texts: str) -> str:
    """SQL literals of texts, separated by commas."""
    escaped = (t.replace("\\", "\\\\").replace("'", "\\'") for t in texts)
    return ", ".join(f"'{t}'" for t in escaped)


@dataclass(frozen=True)
class Settings:
    """Build parameters shared by all plans.

    ``as_of`` is the day the report is made for; None means the day of the run.
    """

    as_of: date | None = None
    window_days: int = 14
    lookback_days: int = 3
    internal_pattern: str = "%@corp.%"
    internal_domains: Mapping[str, str] = field(
        default_factory=lambda: {"is_corp_com": "%@corp.com", "is_corp_io": "%@corp.io"}
    )
    open_statuses: tuple[str, ...] = ("open", "pending")
    high_priorities: tuple[str, ...] = ("high", "urgent")
    min_sample: int = 3
    blank_emails_match: bool = True

    def today(self) -> Column:
        return F.expr(self.today_sql)

    @property
    def today_sql(self) -> str:
        return "current_date()" if self.as_of is None else f"date '{self.as_of}'"

    @property
    def urgent_sql(self) -> str:
        """Condition for a ticket of high priority."""
        return f"priority in ({quoted(*self.high_priorities)})"

    @property
    def open_sql(self) -> str:
        return f"status in ({quoted(*self.open_statuses)})"
