"""Policies, fill values and tags: the user's settings, resolved on the driver."""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flatweave.functions.names import literal
from flatweave.functions.text import is_float, is_integer

# The default fill, and the fills named by a word in any case.
DEFAULT_FILL = -999.0
FILL_WORDS = {"x": "x", "nan": math.nan}

NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?", re.IGNORECASE)

# Fixed value: the form of a truncating policy.
FIRST_N = re.compile(r"first:\s*([+-]?\d+)\s*")

TAG_RANGE = range(-128, 128)


def slots_for(policy: str | None, longest: int, name: str) -> int:
    """Flat columns a jagged column gets; 0 means it is dropped."""
    if policy is None or policy == "pad_max":
        return longest
    if policy == "drop":
        return 0
    first = FIRST_N.fullmatch(policy)
    if first:
        return max(0, min(int(first.group(1)), longest))
    warnings.warn(f"unknown policy '{policy}' on {name}, using pad_max", stacklevel=2)
    return longest


def resolve_fill(fill: float | str | None = None) -> float | str:
    """The fill as a float if it is or spells a number, NaN included; otherwise as text."""
    if fill is None:
        return DEFAULT_FILL
    if isinstance(fill, (int, float)):
        return float(fill)
    word = fill.strip()
    return float(word) if NUMBER.fullmatch(word) else FILL_WORDS.get(word.lower(), word)


def resolve_tags(tags: Mapping[str, int] | Iterable[str] | None) -> dict[str, int]:
    """Tags from a mapping or from ``KEY=VALUE`` strings, checked to fit a tinyint."""
    if not tags:
        return {}
    if isinstance(tags, Mapping):
        pairs = list(tags.items())
    else:
        pairs = []
        for tag in tags:
            key, equals, value = tag.partition("=")
            if not equals:
                raise ValueError(f"a tag must be KEY=VALUE, got: {tag}")
            pairs.append((key.strip(), value.strip()))
    resolved = {}
    for key, value in pairs:
        try:
            number = int(value)
        except (TypeError, ValueError):
            raise ValueError(f"the value of tag {key} must be an integer, got: {value}") from None
        if number not in TAG_RANGE:
            raise ValueError(f"the value of tag {key} must fit in one byte, got: {number}")
        resolved[key] = number
    return resolved


def resolve_policies(policies: Mapping[str, str] | DataFrame | None) -> dict[str, str]:
    """Policy edits by column name, from a mapping or a (name, policy) DataFrame.

    The DataFrame holds one row per edited column of one table.
    """
    if policies is None:
        return {}
    if isinstance(policies, DataFrame):
        return {r["name"]: r["policy"] for r in policies.select("name", "policy").collect()}
    return dict(policies)


def slot_type(element: T.DataType, fill: float | str) -> T.DataType:
    """The one type shared by all slots of a column."""
    if isinstance(fill, float):
        if is_float(element):
            return T.DoubleType()
        if is_integer(element):
            return T.LongType() if is_exact_long(fill) else T.DoubleType()
    return T.StringType()


def is_exact_long(fill: float) -> bool:
    return fill.is_integer() and -2.0 ** 63 <= fill < 2.0 ** 63


def fill_literal(fill: float | str, slot: T.DataType) -> str:
    """The fill as an SQL literal of the slots' type; among text, NaN is a missing cell."""
    if isinstance(slot, T.StringType) and fill != fill:
        return "cast(null as string)"
    text = str(int(fill)) if isinstance(slot, T.LongType) else str(fill)
    return f"cast({literal(text)} as {slot.simpleString()})"
