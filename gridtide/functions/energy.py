"""Power, energy and share expressions shared by the marts."""

from __future__ import annotations

from collections.abc import Iterable


def total(names: Iterable[str]) -> str:
    """Row total in which a missing reading counts as nothing; 64-bit, as readings may fill 32 bits."""
    return "(" + " + ".join(f"coalesce(CAST({name} AS bigint), 0L)" for name in names) + ")"


def mwh(power_sum: str) -> str:
    """Energy of quarter-hours: X MW over a quarter is X/4 MWh."""
    return f"round(CAST({power_sum} AS double) / 4.0D)"


def share_pct(part: str, whole: str) -> str:
    """Percentage to one digit; null over an empty whole."""
    return f"round(100.0D * CAST({part} AS double) / nullif(CAST({whole} AS double), 0.0D), 1)"
