"""Attributes as known at event time: a merge in time shards with carried-in versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import BROADCAST_ROWS, require

#: Events of one entity above which it is cut into shards of about so many.
SHARD_ROWS = 32_768
#: Time shards of one entity at most; beyond, each is split further by a hash.
TIME_SHARDS = 128


def disjoint_versions(versions: Column, start: str, end: str, payload: str, floor: Column) -> Column:
    """Turns an array of version structs in any order, with repeats, gaps or overlaps,
    into disjoint segments struct<valid_from, valid_to, payload, covered>, in order,
    the first beginning at ``floor``.  Where versions overlap, the one that began last
    holds (then the greater payload).  A null end is open; a null start never begins."""
    ok = F.filter(versions, lambda v: v[start].isNotNull() & (v[end].isNull() | (v[start] < v[end])))
    points = F.array_sort(
        F.array_distinct(
            F.concat(F.array(floor), F.transform(ok, lambda v: v[start]), F.array_compact(F.transform(ok, lambda v: v[end])))
        )
    )

    def segment(p: Column, i: Column) -> Column:
        covering = F.filter(ok, lambda v: (v[start] <= p) & (v[end].isNull() | (p < v[end])))
        best = F.array_max(F.transform(covering, lambda v: F.struct(v[start].alias("s"), v[payload].alias("x"))))
        return F.struct(
            p.alias("valid_from"),
            F.get(points, i + 1).alias("valid_to"),
            best["x"].alias(payload),
            best.isNotNull().alias("covered"),
        )

    return F.when(versions.isNotNull(), F.transform(points, segment)).otherwise(
        F.array(F.struct(floor.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(None).cast("string").alias(payload), F.lit(False).alias("covered")))
    )


def _number(df: DataFrame, column: str, name: str = "_t") -> Column:
    """``name``, which holds values of ``df``'s ``column``, as a double."""
    if df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
        return F.col(name).cast("timestamp").cast("double")
    return F.col(name).cast("double")


def _cuts(times: DataFrame, shard_rows: int, time_shards: int) -> DataFrame:
    """(_e, _b, _parts) of the entities in ``times`` (_e, _n, _q): the bounds of the
    shards along time, and into how many parts each shard is split by a hash."""
    fractions = [i / time_shards for i in range(1, time_shards)]
    wanted = F.least(F.lit(time_shards), F.ceil(F.col("_n") / F.lit(shard_rows)).cast("int"))
    every = F.sequence(F.lit(1), F.greatest(F.col("_w") - 1, F.lit(1)))
    nth = lambda i: F.get(F.col("_pct"), F.floor(i * F.lit(time_shards) / F.col("_w")).cast("int") - 1)
    return (
        times.groupBy("_e", "_n")
        .agg(F.percentile_approx("_q", fractions, 1000).alias("_pct"))
        .withColumn("_w", wanted)
        .withColumn("_b0", F.transform(every, nth))
        .withColumn("_b", F.array_distinct("_b0"))
        .withColumn(
            "_parts",
            F.greatest(
                F.lit(1),
                # what the quantiles could not separate, and what lies beyond the most shards
                F.ceil(F.size("_b0") / F.size("_b")).cast("int"),
                F.ceil(F.col("_n") / F.lit(shard_rows * time_shards)).cast("int"),
            ),
        )
        .select("_e", "_b", "_parts")
    )


def asof_join(
    events: DataFrame,
    versions: DataFrame,
    entity: str,
    event_time: str,
    valid_from: str,
    valid_to: str,
    payload: Sequence[str],
    shard_rows: int = SHARD_ROWS,
    time_shards: int = TIME_SHARDS,
) -> DataFrame:
    """Every event with the ``payload`` of the version that held at its time:
    the version that began last at or before it, unless that one has ended
    (``valid_from <= t < valid_to``, a null end is open).

    Entities with more than ``shard_rows`` events are cut along time at quantiles of
    their own event times.  Each version goes to the shard it begins in and to every
    later shard up to the one in which the next version begins; so each shard is
    given its last preceding version as carry-in and can be merged on its own.
    Shards that one instant fills, or entities beyond ``time_shards`` shards, are
    split further by a hash of the event, with the versions copied to each part.
    A shard's merge is a sort by time of events and versions together with a running
    "last version seen"; nothing is looked up across shards.

    Sizes: the list of cut entities has at most ``events / shard_rows`` rows; it is
    broadcast only if a count shows it to be small.  Nothing is collected.

    Defined cases: events with a null entity or time, and events before any version
    or after its end, come out once with a null payload; repeated events come out as
    often as they came in; of versions of one entity that begin together the one with
    the greatest end (open is greatest), then payload, holds; versions with a null
    entity or start never hold.  ``events`` columns named like a payload column keep
    their name and the payload's gets the prefix ``asof_``.
    """
    require(events, entity, event_time)
    require(versions, entity, valid_from, valid_to, *payload)
    names = {c: f"asof_{c}" if c in events.columns else c for c in payload}
    everything = F.struct(*[F.col(c) for c in events.columns]).alias("_ev")
    usable = F.col(entity).isNotNull() & F.col(event_time).isNotNull()
    ev = events.filter(usable).select(F.col(entity).alias("_e"), F.col(event_time).alias("_t"), everything)
    ver = versions.select(
        F.col(entity).alias("_e"),
        F.col(valid_from).alias("_t"),
        F.struct(F.col(valid_to).alias("to"), *[F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]).alias("_x"),
    ).filter(F.col("_e").isNotNull() & F.col("_t").isNotNull())
    # of versions that begin together one holds
    ver = ver.groupBy("_e", "_t").agg(F.max(F.struct(F.col("_x.to").isNull().alias("open"), F.col("_x"))).alias("_m"))
    ver = ver.select("_e", "_t", F.col("_m._x").alias("_x"))

    counts = ev.groupBy("_e").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > shard_rows)
    number = _number(events, event_time)
    n_hot = counts.limit(BROADCAST_ROWS + 1).count()
    event_type, version_type = ev.schema["_ev"].dataType, ver.schema["_x"].dataType
    if not n_hot:
        # no entity needs a second shard: one merge per entity
        ev = ev.withColumns({"_s": F.lit(0), "_h": F.lit(0)})
        ver = ver.withColumns({"_s": F.lit(0), "_h": F.lit(0)})
    else:
        small = (lambda df: F.broadcast(df)) if n_hot <= BROADCAST_ROWS else (lambda df: df)
        hot = small(_cuts(ev.select("_e", number.alias("_q")).join(small(counts), "_e"), shard_rows, time_shards))
        shard = lambda q: F.when(F.col("_b").isNull(), F.lit(0)).otherwise(F.size(F.filter("_b", lambda b: b <= q)))
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        ev = ev.join(hot, "_e", "left").select(
            "_e", "_t", "_ev", shard(number).alias("_s"),
            F.when(parts > 1, F.pmod(F.xxhash64("_ev"), parts).cast("int")).otherwise(0).alias("_h"),
        )
        ver = ver.withColumn("_to", F.lead("_t").over(W.partitionBy("_e").orderBy("_t"))).join(hot, "_e", "left")
        last = F.when(F.col("_b").isNull(), F.lit(0)).when(F.col("_to").isNull(), F.size("_b")).otherwise(
            shard(_number(versions, valid_from, "_to"))
        )
        ver = (
            ver.select("_e", "_t", "_x", parts.alias("_parts"), F.explode(F.sequence(shard(_number(versions, valid_from, "_t")), last)).alias("_s"))
            .select("_e", "_t", "_x", "_s", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_h"))
        )
    ev = ev.select("_e", "_t", F.lit(1).alias("_kind"), "_s", "_h", "_ev", F.lit(None).cast(version_type).alias("_x"))
    ver = ver.select("_e", "_t", F.lit(0).alias("_kind"), "_s", "_h", F.lit(None).cast(event_type).alias("_ev"), "_x")
    w = W.partitionBy("_e", "_s", "_h").orderBy("_t", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    merged = (
        ev.unionByName(ver)
        .withColumn("_held", F.last("_x", ignorenulls=True).over(w))
        .filter(F.col("_kind") == 1)
        .withColumn("_held", F.when(F.col("_held.to").isNull() | (F.col("_t") < F.col("_held.to")), F.col("_held")))
    )
    found = merged.select("_ev.*", *[F.col(f"_held.p{i}").alias(names[c]) for i, c in enumerate(payload)])
    apart = events.filter(~F.coalesce(usable, F.lit(False))).select(
        *events.columns, *[F.lit(None).cast(versions.schema[c].dataType).alias(names[c]) for c in payload]
    )
    return found.unionByName(apart)
