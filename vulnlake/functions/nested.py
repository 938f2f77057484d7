"""Expressions over arrays of structs; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# All white-space characters of Unicode (fixed values).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove any leading and trailing white space, line breaks included."""
    return F.trim(text, F.lit(WHITE_SPACE))


def strip_left(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITE_SPACE))


def best_of(items: Column, preferred: Callable[[Column], Column]) -> Column:
    """The first preferred element, else the first element, else null."""
    return F.coalesce(F.get(F.filter(items, preferred), F.lit(0)), F.get(items, F.lit(0)))


def last_of(items: Column, keep: Callable[[Column], Column]) -> Column:
    """The last element that passes `keep`, null when none does."""
    return F.try_element_at(F.filter(items, keep), F.lit(-1))


def distinct_values(groups: Column, pick: Callable[[Column], Column]) -> Column:
    """Distinct values over an array of groups, in first-seen order; empty for a null array."""
    flat = F.flatten(F.transform(groups, lambda g: F.coalesce(pick(g), F.array().cast("array<string>"))))
    return F.coalesce(F.array_distinct(flat), F.array().cast("array<string>"))


def count_nested(items: Column, size_of: Callable[[Column], Column]) -> Column:
    """Sum of `size_of(element)`; a null array or a null size counts as 0."""
    total = F.aggregate(items, F.lit(0), lambda acc, x: acc + F.coalesce(size_of(x), F.lit(0)))
    return F.coalesce(total, F.lit(0))


def length_of(items: Column) -> Column:
    """Array length with null as 0."""
    return F.coalesce(F.array_size(items), F.lit(0))
