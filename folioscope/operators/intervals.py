"""What an identifier meant on a date: half-open intervals, failing closed when ambiguous."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

OPEN = "9999-12-31"


def end_or_open(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(OPEN).cast("date"))


def resolve_as_of(
    events: DataFrame, value: str, at: str, intervals: DataFrame, layers: Sequence[int] = (0,), payload: str = "payload"
) -> DataFrame:
    """``events`` with ``resolved``: the payload of the one interval of the value that
    covers the date (``valid_from <= at < valid_to``, null end open).

    ``intervals`` has value, valid_from, valid_to, payload, disputed and layer.  The
    first of ``layers`` with any covering interval owns the decision, even if it ends in
    null: several covering intervals or a disputed one resolve to nothing.  Distinct
    (value, date) pairs are resolved once and joined back, so a value on most rows costs
    no more than a rare one.  Events with a null value or date resolve to null."""
    pairs = events.select(F.col(value).alias("_v"), F.col(at).alias("_at")).dropna().distinct()
    iv = intervals.select(F.col("value").alias("_v"), F.col("valid_from").alias("_f"), end_or_open("valid_to").alias("_t"), F.col(payload).alias("_p"), F.coalesce("disputed", F.lit(False)).alias("_d"), F.col("layer").alias("_l"))
    hit = pairs.join(iv, (pairs["_v"] == iv["_v"]) & (F.col("_f") <= F.col("_at")) & (F.col("_at") < F.col("_t"))).select(pairs["_v"], "_at", "_p", "_d", "_l")
    per = hit.groupBy("_v", "_at").agg(
        *[x for i, k in enumerate(layers) for x in (
            F.count_if(F.col("_l") == k).alias(f"_n{i}"), F.count_if((F.col("_l") == k) & F.col("_d")).alias(f"_d{i}"), F.min(F.when(F.col("_l") == k, F.col("_p"))).alias(f"_p{i}"),
        )]
    )
    out = F.lit(None).cast(intervals.schema[payload].dataType)
    for i in reversed(range(len(layers))):
        out = F.when((F.col(f"_n{i}") == 1) & (F.col(f"_d{i}") == 0), F.col(f"_p{i}")).when(F.col(f"_n{i}") == 0, out)
    per = per.select("_v", "_at", out.alias("resolved"))
    return events.join(per, (F.col(value) == F.col("_v")) & (F.col(at) == F.col("_at")), "left").drop("_v", "_at")


def union_intervals(df: DataFrame, keys: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Overlapping or touching intervals of a key merged; a null end is open."""
    w = W.partitionBy(*keys).orderBy("_s", "_e")
    rows = df.select(*keys, F.col(start).alias("_s"), end_or_open(end).alias("_e")).filter(F.col("_s") < F.col("_e"))
    reach = F.max("_e").over(w.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.coalesce(F.col("_s") > F.col("_r"), F.lit(True)).cast("int")).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    merged = rows.withColumn("_r", reach).withColumn("_i", island).groupBy(*keys, "_i").agg(F.min("_s").alias(start), F.max("_e").alias("_e"))
    return merged.select(*keys, start, F.when(F.col("_e") < F.lit(OPEN).cast("date"), F.col("_e")).alias(end))


def overlaps(df: DataFrame, keys: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Intervals of a key that begin before an earlier one has ended."""
    w = W.partitionBy(*keys).orderBy(start, end_or_open(end)).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_r", F.max(end_or_open(end)).over(w)).filter(F.col(start) < F.col("_r")).drop("_r")


def cut(df: DataFrame, windows: DataFrame, key: str, owner: str) -> DataFrame:
    """Intervals cut at the boundaries of ownership windows of their key."""
    w = windows.select(F.col(key).alias("_k"), F.col(owner), F.col("valid_from").alias("_f"), end_or_open("valid_to").alias("_t"))
    j = df.withColumn("_e", end_or_open("valid_to")).join(w, (F.col(key) == F.col("_k")) & (F.col("valid_from") < F.col("_t")) & (F.col("_f") < F.col("_e")))
    to = F.least("_e", "_t")
    return j.select(key, owner, F.greatest("valid_from", "_f").alias("valid_from"), F.when(to < F.lit(OPEN).cast("date"), to).alias("valid_to"))


def history(df: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Intervals of a value from dated observations: a change closes one and opens the
    next, absence keeps it open."""
    w = W.partitionBy(key).orderBy(at)
    changed = df.withColumn("_b", F.lag(value).over(w)).filter(F.col("_b").isNull() | (F.col("_b") != F.col(value)))
    return changed.select(key, value, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"))


def apply_snapshot(open_rows: DataFrame, snapshot: DataFrame, key: str, value: str, at) -> DataFrame:
    """One snapshot applied to the current intervals: (key, value, valid_from, valid_to).
    Raises on a snapshot older than an open interval."""
    newest = open_rows.filter(F.col("valid_to").isNull()).agg(F.max("valid_from")).first()[0]
    if newest is not None and newest > at:
        raise ValueError("the snapshot is older than the registry")
    s = snapshot.select(F.col(key), F.col(value).alias("_new"))
    cur = open_rows.filter(F.col("valid_to").isNull()).join(s, key, "full_outer")
    day = F.lit(at).cast("date")
    keep = cur.filter(F.col("valid_from").isNotNull()).select(key, value, "valid_from", F.when(F.col("_new").isNotNull() & (F.col("_new") != F.col(value)), day).alias("valid_to"))
    opened = cur.filter(F.col("_new").isNotNull() & (F.col("valid_from").isNull() | (F.col("_new") != F.col(value)))).select(key, F.col("_new").alias(value), day.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return open_rows.filter(F.col("valid_to").isNotNull()).select(key, value, "valid_from", "valid_to").unionByName(keep).unionByName(opened)


def long_gaps(df: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """Consecutive intervals of a key with a gap of at least ``days`` between them."""
    w = W.partitionBy(*keys).orderBy("valid_from")
    gap = F.datediff("valid_from", F.col("_b"))
    return df.withColumn("_b", F.lag("valid_to").over(w)).filter(gap >= days).select(*keys, "valid_from", gap.alias("gap_days"))


def unique_or_null(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, candidates): the one distinct value of a key, null if several."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("candidates"), F.min(value).alias("_v")).select(key, F.when(F.col("candidates") == 1, F.col("_v")).alias(value), "candidates")
