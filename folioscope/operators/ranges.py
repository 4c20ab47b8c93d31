"""Amounts that are intervals [low, high], with an open end or unknown; null is never zero."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WIDE = "decimal(38,0)"


def open_ended(low: Column, high: Column) -> Column:
    return low.isNotNull() & high.isNull()


def reaches(low: Column, high: Column, at_least: int) -> Column:
    """Whether the amount may be that much: its upper end is, or it has none."""
    return F.coalesce(high >= at_least, F.lit(False)) | open_ended(low, high)


def verdict(low: Column, high: Column, threshold: int) -> Column:
    """in: surely above; out: surely not; else indeterminate."""
    return F.when(low > threshold, "in").when(high <= threshold, "out").otherwise("indeterminate")


def range_sum(low: Column, high: Column) -> Column:
    """Aggregate: struct<kind, low, high> of a sum of intervals.  empty without rows,
    undisclosed without any known amount, closed, or open where an amount has no upper
    end or isn't known.  A floor of $X+1 counts as $X."""
    floor = F.when(low % 1000 == 1, low - 1).otherwise(low)
    n, known = F.count(F.lit(1)), F.count(F.when(low.isNotNull() | high.isNotNull(), 1))
    unbounded = F.count_if(high.isNull())
    lo = F.coalesce(F.sum(floor.cast(WIDE)), F.lit(0).cast(WIDE)).cast("long")
    hi = F.sum(high.cast(WIDE)).cast("long")
    kind = F.when(n == 0, "empty").when(known == 0, "undisclosed").when(unbounded > 0, "open").otherwise("closed")
    return F.struct(
        kind.alias("kind"), F.when((n > 0) & (known > 0), lo).alias("low"), F.when((known > 0) & (unbounded == 0), hi).alias("high")
    )


def net(buys: Column, sales: Column) -> Column:
    """Net interval of two range sums: [buys.low - sales.high, buys.high - sales.low];
    an undisclosed side poisons it, an open side takes away the bound it decides."""
    zero = lambda r, f: F.when(r["kind"] == "empty", F.lit(0)).otherwise(r[f])
    none = F.lit(None).cast("long")
    unknown = (buys["kind"] == "undisclosed") | (sales["kind"] == "undisclosed")
    both = (buys["kind"] == "empty") & (sales["kind"] == "empty")
    low = F.when(sales["kind"] != "open", zero(buys, "low") - zero(sales, "high"))
    high = F.when(buys["kind"] != "open", zero(buys, "high") - zero(sales, "low"))
    kind = (
        F.when(unknown, "undisclosed").when(both, "empty").when(low.isNotNull() & high.isNotNull(), "finite")
        .when(high.isNotNull(), "lower_open").when(low.isNotNull(), "upper_open").otherwise("unbounded")
    )
    blank = unknown | both
    return F.struct(kind.alias("kind"), F.when(blank, none).otherwise(low).alias("low"), F.when(blank, none).otherwise(high).alias("high"))


def net_order(c: Column) -> list[Column]:
    """Most bought first: known before undisclosed, then lower and upper ends."""
    least = F.lit(-(2**63))
    return [
        c["kind"].isin("undisclosed", "empty").asc(),
        F.coalesce(c["low"], least).desc(),
        F.when(c["kind"].isin("upper_open", "unbounded"), F.lit(2**63 - 1)).otherwise(F.coalesce(c["high"], least)).desc(),
    ]
