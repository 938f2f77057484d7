"""Labels and score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnlake.functions.nested import let


def within_horizon(days_until: Column, horizon: int) -> Column:
    """1 inside the horizon, 0 outside or never, null when the outcome is not in the future."""
    return (
        F.when(days_until.isNull(), F.lit(0))
        .when(days_until <= 0, F.lit(None).cast("int"))
        .otherwise((days_until <= horizon).cast("int"))
    )


def clamp_unit(value: Column) -> Column:
    """Limit a prediction to [0, 1]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def blended_score(cvss: Column, exploit: Column, outcome: Column, w1, w2, w3) -> Column:
    """10 * (w1 * cvss/10 + w2 * exploit + w3 * outcome); a missing CVSS score counts as 0."""
    w1, w2, w3 = (w if isinstance(w, Column) else F.lit(float(w)) for w in (w1, w2, w3))
    term = F.least(F.coalesce(cvss, F.lit(0.0)) / F.lit(10.0), F.lit(1.0))
    return F.lit(10.0) * (w1 * term + w2 * exploit + w3 * outcome)


def round_binary(value: Column, digits: int) -> Column:
    """Round by the exact value of the double, ties to even.

    `F.round` works on the printed decimal, so 3.15 (a little less as a double) would go up. The
    product with 10^digits is split into its rounded value and the exact rest (Veltkamp splitting),
    and the rest decides where the rounded product lies exactly between two whole numbers.
    """
    scale = float(10**digits)

    def split(x: Column) -> Column:
        high = x * 134217729.0 - (x * 134217729.0 - x)
        product = x * scale
        rest = (high * scale - product) + (x - high) * scale
        return F.struct(F.floor(product).alias("down"), (product - F.floor(product)).alias("part"), rest.alias("rest"))

    def decide(s: Column) -> Column:
        half = s["part"] == 0.5
        up = (s["part"] > 0.5) | (half & ((s["rest"] > 0) | ((s["rest"] == 0) & (s["down"] % 2 != 0))))
        return (s["down"] + up.cast("int")) / F.lit(scale)

    return let(let(value, split), decide)


def count_at_or_below(score: Column, cuts: Column) -> Column:
    """How many values of a sorted array of any size are <= score, by binary search."""
    highest = F.floor(F.log2(F.greatest(F.array_size(cuts), F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(highest, F.lit(0), F.lit(-1)), lambda i: F.call_function("shiftleft", F.lit(1), i))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: found + F.when(F.get(cuts, found + step - 1) <= score, step).otherwise(F.lit(0)),
    )


def percentile_table(cuts: Column) -> Column:
    """Percentile for 0, 1, ... all cut points at or below a score; 0 without cut points."""
    size = F.array_size(cuts)
    return F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.coalesce(round_binary(F.lit(100.0) * i / F.nullif(size, F.lit(0)), 2), F.lit(0.0)),
    )


def percentile_of(score: Column, cuts: Column, table: Column | None = None) -> Column:
    """Share of the sorted cut points at or below the score, in percent.

    `table` is the precomputed `percentile_table(cuts)`, when many rows share the cut points.
    """
    return F.get(percentile_table(cuts) if table is None else table, count_at_or_below(score, cuts))


def priority(percentile: Column) -> Column:
    """Percentile on a 0-10 scale."""
    return round_binary(percentile / F.lit(10.0), 2)
