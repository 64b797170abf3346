"""Banded scoring: a numeric column to a small integer score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """One score band. A missing bound is open-ended; bounds are inclusive unless marked."""

    score: int
    lo: float | None = None
    hi: float | None = None
    lo_open: bool = False
    hi_open: bool = False

    def test(self, column: str) -> str:
        checks = []
        if self.lo is not None:
            checks.append(f"`{column}` {'>' if self.lo_open else '>='} {self.lo}")
        if self.hi is not None:
            checks.append(f"`{column}` {'<' if self.hi_open else '<='} {self.hi}")
        return " AND ".join(checks) or f"`{column}` IS NOT NULL"


def score_bands(column: str, bands: Sequence[Band], default: int = 0) -> Column:
    """Score of the first band that holds ``column``; ``default`` if none does or it is null."""
    branches = " ".join(f"WHEN {band.test(column)} THEN {band.score}" for band in bands)
    return F.expr(f"CASE {branches} ELSE {default} END" if bands else str(default))
