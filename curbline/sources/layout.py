"""Where the tables live: one directory per source month, histories beside them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Layout:
    raw: str
    curated: str
    rejects: str
    history: str  # runs, checks and source state: outside the months, so a rewrite keeps them
    dataset: str = "yellow"

    @classmethod
    def under(cls, root: str, dataset: str = "yellow") -> Layout:
        root = root.rstrip("/")
        return cls(f"{root}/raw", f"{root}/curated", f"{root}/rejects", f"{root}/history", dataset)

    def base(self, area: str) -> str:
        """All months of one area: raw, curated or rejects."""
        return f"{getattr(self, area)}/dataset={self.dataset}"

    def month(self, area: str, month: date) -> str:
        return f"{self.base(area)}/year={month:%Y}/month={month:%m}"

    def table(self, name: str) -> str:
        """An append-only table: runs, checks or source_state."""
        return f"{self.history}/dataset={self.dataset}/{name}"
