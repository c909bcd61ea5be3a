"""Job parameters: slice list parsing and slice bounds."""

from __future__ import annotations

import calendar
import datetime as dt
import re
from dataclasses import dataclass

from strata.presets import DEFAULT_MONTHS

_SLICE_RE = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def parse_slices(value: str) -> list[str]:
    """'2024-12, 2025-01' -> sorted, de-duplicated ['2024-12', '2025-01'].

    Raises ``ValueError`` on an empty list or a value that is not YYYY-MM.
    """
    slices = sorted({s.strip() for s in (value or "").split(",") if s.strip()})
    bad = [s for s in slices if not _SLICE_RE.fullmatch(s)]
    if not slices or bad:
        raise ValueError(f"invalid slice list {value!r}: expected YYYY-MM[,YYYY-MM...]")
    return slices


def slice_bounds(slices: list[str]) -> tuple[dt.date, dt.date]:
    """First day of the first slice and last day of the last one; gaps are included."""
    y0, m0 = map(int, slices[0].split("-"))
    y1, m1 = map(int, slices[-1].split("-"))
    return dt.date(y0, m0, 1), dt.date(y1, m1, calendar.monthrange(y1, m1)[1])


@dataclass(frozen=True)
class JobParams:
    """Run parameters shared by all stages."""
    root: str
    months: str = DEFAULT_MONTHS
    run_id: str = "manual"
    source_format: str = "csv"
    top_k: int = 20
    export_enabled: bool = False

    @property
    def slices(self) -> list[str]:
        return parse_slices(self.months)
