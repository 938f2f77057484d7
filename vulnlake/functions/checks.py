"""Validation predicates. A predicate is true when the row is bad; null input counts as stated."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CVE_ID = r"^CVE-\d{4}-\d{4,}$"


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition holds, null when none does."""
    (name, bad), *rest = rules
    start = F.when(bad, F.lit(name))
    return reduce(lambda chain, rule: chain.when(rule[1], F.lit(rule[0])), rest, start)


def bad_id(identifier: Column, pattern: str = CVE_ID) -> Column:
    """Null or not of the given form."""
    return ~F.coalesce(identifier.rlike(pattern), F.lit(False))


def out_of_range(value: Column, low: float, high: float) -> Column:
    """Present but outside [low, high]; null passes."""
    return F.coalesce(~value.between(low, high), F.lit(False))


def missing(value: Column) -> Column:
    return value.isNull()


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""
