"""Where the jobs keep their tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta


@dataclass(frozen=True)
class Store:
    """Folders below one root that all executors can reach."""

    root: str

    @property
    def observations(self) -> str:
        return f"{self.root}/observations"

    @property
    def row_index(self) -> str:
        """Observations per city and month."""
        return f"{self.root}/row_index"

    @property
    def state(self) -> str:
        """What checks need to know of each city."""
        return f"{self.root}/state"

    @property
    def features(self) -> str:
        return f"{self.root}/features"

    @property
    def models(self) -> str:
        return f"{self.root}/registry"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def runs(self) -> str:
        """What each step of each run handed on."""
        return f"{self.root}/runs"

    @property
    def attributions(self) -> str:
        return f"{self.root}/attributions"


def day_range(start: str | None, end: str | None, as_of: datetime, days: int) -> tuple[str, str]:
    """The given days, ``yyyy-mm-dd`` only. A missing end is ``as_of``, a missing start is ``days`` days before the end."""
    last = datetime.strptime(end, "%Y-%m-%d") if end else as_of
    first = datetime.strptime(start, "%Y-%m-%d") if start else last - timedelta(days=days)
    return first.strftime("%Y-%m-%d"), last.strftime("%Y-%m-%d")
