"""Reason arrays: every rule that does not hold says so by a code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, Column | str]


def _code(code: Column | str) -> Column:
    return F.lit(code) if isinstance(code, str) else code


def reasons(*rules: Rule) -> Column:
    """Codes of the conditions that hold, in order; null conditions don't."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(cond, _code(code)) for cond, code in rules]))


def first_reason(*rules: Rule) -> Column:
    """The code of the first condition that holds, else null."""
    out = None
    for cond, code in rules:
        out = F.when(cond, _code(code)) if out is None else out.when(cond, _code(code))
    return F.lit(None).cast("string") if out is None else out


def none(codes: Column) -> Column:
    return F.size(codes) == 0
