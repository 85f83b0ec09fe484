"""Mart scripts: a name, a build function, and the marts it reads."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from types import CodeType
from typing import Any

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Script:
    """``build(rows, layout)``, or ``build(rows, layout, marts)`` with ``inputs``: then ``marts`` maps their names to frames.

    Names order the scripts, as file names would. Inputs are names of marts that come before.
    """

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()


def scripts_of(given: Sequence[Script | tuple]) -> tuple[Script, ...]:
    """Scripts, also from plain tuples, in order of their names; inputs must come earlier."""
    found = tuple(sorted((s if isinstance(s, Script) else Script(*s) for s in given), key=lambda s: s.name))
    seen: set[str] = set()
    for script in found:
        if script.name in seen:
            raise ValueError(f"two marts are named {script.name}")
        missing = [name for name in script.inputs if name not in seen]
        if missing:
            raise ValueError(f"mart {script.name} reads {missing[0]}, which no earlier script builds")
        seen.add(script.name)
    return found


def levels(scripts: Sequence[Script]) -> list[list[Script]]:
    """Scripts in groups: each reads only marts of earlier groups, so those of a group can be built at the same time."""
    depth: dict[str, int] = {}
    for script in scripts:
        depth[script.name] = 1 + max((depth[name] for name in script.inputs), default=-1)
    return [[s for s in scripts if depth[s.name] == n] for n in range(max(depth.values(), default=-1) + 1)]


def digest(build: Callable) -> str:
    """A digest of any callable by its name, code and what it is bound to, the same in every session."""
    return hashlib.sha256(repr(_told(build)).encode()).hexdigest()


def _told(value: Any) -> Any:
    if isinstance(value, partial):
        return "partial", _told(value.func), [_told(a) for a in value.args], sorted((k, _told(v)) for k, v in value.keywords.items())
    if isinstance(value, CodeType):
        return value.co_code, value.co_names, value.co_varnames, [_told(c) for c in value.co_consts]
    code = getattr(value, "__code__", None)
    if code is not None:
        bound = [_told(cell.cell_contents) for cell in getattr(value, "__closure__", None) or ()]
        return value.__module__, value.__qualname__, _told(code), repr(value.__defaults__), bound
    if callable(value):
        name = getattr(value, "__qualname__", type(value).__qualname__)
        called = getattr(type(value).__call__, "__code__", None)
        return name, None if called is None else _told(called), sorted((k, _told(v)) for k, v in getattr(value, "__dict__", {}).items())
    if isinstance(value, (str, bytes, int, float, bool, type(None))):
        return value
    if isinstance(value, (list, tuple)):
        return [_told(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted(repr(_told(v)) for v in value)
    if isinstance(value, dict):
        return sorted((repr(_told(k)), _told(v)) for k, v in value.items())
    return type(value).__qualname__
