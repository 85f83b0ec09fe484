"""Numbers as text."""

from __future__ import annotations


def one_digit(value: str) -> str:
    """A non-negative double with one decimal, rounded by its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form half up instead, so it turns
    4.25 into 4.3 and 4.35 (which lies below the tie) into 4.4. Here the side of the
    tie is the sign of ``20 * value - (2 * tenths + 1)``, computed without rounding.
    """
    tenths = f"CAST(floor({value} * 10.0D) AS bigint)"
    side = f"(({value} * 16.0D - CAST({tenths} * 2 + 1 AS double)) + {value} * 4.0D)"
    rounded = (
        f"CASE WHEN {side} > 0 THEN {tenths} + 1 WHEN {side} < 0 THEN {tenths} "
        f"ELSE {tenths} + {tenths} % 2 END"
    )
    return f"concat(({rounded}) div 10, '.', ({rounded}) % 10)"
