"""Typed coercion of payload text, as built-in SQL expressions only.

A coercion gives null for null input and for text that does not coerce; its
``_why`` twin gives the reason in the second case only. Casts are ``try_cast``
throughout, so ANSI mode does not turn bad text into a failed job.
"""

from __future__ import annotations

# The accepted forms of a number and of an ISO 8601 instant.
NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
# Bare NaN and Infinity tokens reach us in quotes.
NOT_A_NUMBER = r'^"?[+-]?[nN][aA][nN]"?$'
INFINITE = r'^"?[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?"?$'
INSTANT = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2}(:\d{2})?)?)$"
)
NAIVE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?)?$"
BLANKS = r"' \t\n\r\u000B\u000C'"


def _bare(raw: str) -> str:
    return f"btrim({raw}, {BLANKS})"


def plain_integer(raw: str) -> str:
    """Plain 32-bit integer text, which is nearly all of a feed; null for anything else."""
    return f"try_cast({raw} AS int)"


def integer(raw: str) -> str:
    """Any accepted number text as a 32-bit integer, halves to even, infinities refused."""
    cast = f"try_cast(replace({_bare(raw)}, '_', '') AS double)"
    number = f"CASE WHEN {_bare(raw)} RLIKE r'{NUMBER}' THEN {cast} END"
    return f"coalesce({plain_integer(raw)}, try_cast(rint({number}) AS int))"


def integer_why(raw: str) -> str:
    """Why a text is no integer; null if it is one."""
    return f"""CASE WHEN {raw} IS NULL OR {integer(raw)} IS NOT NULL THEN NULL
        WHEN {_bare(raw)} RLIKE r'{NOT_A_NUMBER}' THEN 'not a number'
        WHEN {_bare(raw)} RLIKE r'{INFINITE}' THEN 'not a finite number'
        WHEN {_bare(raw)} RLIKE r'{NUMBER}' THEN 'number out of 32-bit range'
        ELSE concat('could not convert string to float: \\'', {raw}, '\\'') END"""


def instant(raw: str) -> str:
    """Instant of ISO 8601 text that carries its own offset; seconds may be left out."""
    seconds = f"regexp_replace({raw}, r'^(.{{13}}:\\d{{2}})(Z|[+-])', r'$1:00$2')"
    cast = f"coalesce(try_cast({raw} AS timestamp), try_cast({seconds} AS timestamp))"
    return f"CASE WHEN {raw} RLIKE r'{INSTANT}' THEN {cast} END"


def instant_why(raw: str) -> str:
    """Why a text is no instant; null if it is one."""
    return f"""CASE WHEN {raw} IS NULL OR {instant(raw)} IS NOT NULL THEN NULL
        WHEN {raw} RLIKE r'{NAIVE}' THEN 'timestamp lacks a timezone offset'
        ELSE concat('Invalid isoformat string: \\'', {raw}, '\\'') END"""
