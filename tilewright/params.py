"""Thresholds of the load planner."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PlanParams:
    """Limits that decide a table's load strategy; the defaults are the production values."""

    row_limit: int = 10_000_000
    max_tiles: int = 10
    lob_limit_kb: int = 1024
    small_bytes: int = 1024
    size_bounds: tuple[int, int, int] = (10_000, 50_000, 100_000)
    # Cases 1 and 6 share an id base, so their rule ids may collide; give case 6
    # another base to keep them apart.
    case6_base: int = 100_000_000
    # Name under which the report itself is stored; hidden from the final report.
    report_name: str = "load_report"
