"""What changed between consecutive full snapshots: a merge over sorted key ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import BROADCAST_ROWS, is_small, require

#: Copies of a calendar row when the calendar is too large to broadcast.
CALENDAR_SALTS = 16


def snapshot_calendar(df: DataFrame, entity: str, snapshot: str) -> DataFrame:
    """(_e, _p, _prev, _next): each snapshot an entity delivered with the one before
    and after it, however large the gap."""
    w = W.partitionBy("_e").orderBy("_p")
    return (
        df.select(F.col(entity).alias("_e"), F.col(snapshot).alias("_p"))
        .dropna()
        .distinct()
        .select("_e", "_p", F.lag("_p").over(w).alias("_prev"), F.lead("_p").over(w).alias("_next"))
    )


def diff_snapshots(
    df: DataFrame,
    entity: str,
    snapshot: str,
    key: Sequence[str],
    compare: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Typed changes between each entity's consecutive snapshots, all held in ``df``.

    The rows are range-partitioned and sorted by (entity, key, snapshot), so a
    range holds, for each key, the run of its rows through the snapshots.  Two
    pointers then walk the sorted range together: the current row and the row behind
    it.  Where the row behind is not of the entity's preceding snapshot, the key was
    added; where the row ahead is not of its following snapshot, it was removed
    there; where both are and a compared column differs, it changed.  A range is
    streamed; nothing of an entity is gathered, and an entity with most of the rows
    is cut into many ranges by its keys.  One range exchange serves the sort, the
    removal of repeated rows and the merge.

    Output: entity, snapshot (the later one), key columns, ``change_kind`` (added,
    removed, changed), and per compared column ``old_x`` and ``new_x``.

    Defined cases: rows with a null entity or snapshot belong to no snapshot and are
    left out; a null in a key column is a value like any other (filter beforehand if
    it means unknown); null equals null in a compared column and differs from every
    value; of repeated rows of one key and snapshot one counts, and of rows that
    differ the one smallest in its compared columns, nulls first, so the result does
    not depend on the order of rows; an entity's first snapshot yields nothing; an
    empty table yields no rows.  Where some rows only tell that a snapshot was
    delivered and are not to be compared, use :func:`diff_snapshots_of`.
    """
    return diff_snapshots_of(df, df, entity, snapshot, key, compare, broadcast_rows)


def diff_snapshots_of(
    delivered: DataFrame,
    df: DataFrame,
    entity: str,
    snapshot: str,
    key: Sequence[str],
    compare: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """:func:`diff_snapshots` where ``delivered`` says which snapshots exist and
    ``df`` holds the rows to compare."""
    require(df, entity, snapshot, *key, *compare)
    require(delivered, entity, snapshot)
    calendar = snapshot_calendar(delivered, entity, snapshot)
    keys = [f"_k{i}" for i in range(len(key))]
    rows = df.select(
        F.col(entity).alias("_e"),
        F.col(snapshot).alias("_p"),
        *[F.col(c).alias(k) for k, c in zip(keys, key)],
        F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(compare)]).alias("_v"),
    ).filter(F.col("_e").isNotNull() & F.col("_p").isNotNull())
    if is_small(calendar, broadcast_rows):
        rows = rows.join(F.broadcast(calendar), ["_e", "_p"])
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(CALENDAR_SALTS - 1)))
        rows = (
            rows.withColumn("_s", F.pmod(F.xxhash64(*keys), F.lit(CALENDAR_SALTS)).cast("int"))
            .join(calendar.withColumn("_s", salts), ["_e", "_p", "_s"])
            .drop("_s")
        )
    run = ["_e", *keys]
    ranged = rows.repartitionByRange(*run).sortWithinPartitions(*run, "_p")
    one = ranged.groupBy(*run, "_p", "_prev", "_next").agg(F.min("_v").alias("_v"))
    w = W.partitionBy(*run).orderBy("_p")
    walked = one.select(
        "*",
        F.lag(F.struct("_p", "_v")).over(w).alias("_behind"),
        F.lead("_p").over(w).alias("_ahead"),
    )
    here_before = F.col("_behind._p").eqNullSafe(F.col("_prev"))
    change = lambda at, kind, old, new: F.struct(
        at.alias("at"), F.lit(kind).alias("kind"), old.alias("old"), new.alias("new")
    )
    nothing = F.lit(None).cast(one.schema["_v"].dataType)
    arrived = F.when(F.col("_prev").isNotNull() & ~here_before, change(F.col("_p"), "added", nothing, F.col("_v"))).when(
        F.col("_prev").isNotNull() & ~F.col("_behind._v").eqNullSafe(F.col("_v")),
        change(F.col("_p"), "changed", F.col("_behind._v"), F.col("_v")),
    )
    left = F.when(
        F.col("_next").isNotNull() & ~F.col("_ahead").eqNullSafe(F.col("_next")),
        change(F.col("_next"), "removed", F.col("_v"), nothing),
    )
    out = walked.select(*run, F.explode(F.array_compact(F.array(arrived, left))).alias("_c"))
    return out.select(
        F.col("_e").alias(entity),
        F.col("_c.at").alias(snapshot),
        *[F.col(k).alias(c) for k, c in zip(keys, key)],
        F.col("_c.kind").alias("change_kind"),
        *[F.col(f"_c.old.v{i}").alias(f"old_{c}") for i, c in enumerate(compare)],
        *[F.col(f"_c.new.v{i}").alias(f"new_{c}") for i, c in enumerate(compare)],
    )
