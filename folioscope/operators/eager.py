"""Results per key when a few keys hold most rows: eager aggregation through a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, require

WIDE = "decimal(38,0)"
#: Parts into which states without a join key are dealt.
NULL_SALTS = 64


def distinct_records(df: DataFrame, record_id: str, columns: Sequence[str]) -> DataFrame:
    """One row per non-null ``record_id`` with ``columns``; a record delivered again
    counts once.  The shuffle is on the record id, which no key can make uneven, and
    copies already meet before it (partial aggregation)."""
    require(df, record_id, *columns)
    rest = [c for c in columns if c != record_id]
    return (
        df.filter(F.col(record_id).isNotNull())
        .groupBy(record_id)
        .agg(F.first(F.struct(*[F.col(c) for c in rest])).alias("_r"))
        .select(record_id, *[F.col(f"_r.{c}").alias(c) for c in rest])
    )


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    join_keys: Sequence[str],
    group_by: Sequence[str],
    left_sums: Sequence[str] = (),
    right_sums: Sequence[str] = (),
) -> DataFrame:
    """``left LEFT JOIN right USING (join_keys) GROUP BY group_by`` without ever
    building the join's rows.

    Both inputs are aggregated by join key first (the left one also by group), the
    compact states are joined, and the join's totals follow by algebra: a state of
    ``nl`` left rows that meets ``nr`` right rows stands for ``nl * nr`` joined rows,
    in which a left sum occurs ``nr`` times and a right sum ``nl`` times.  A last
    aggregation rolls the states up to the groups.  A key with most of the rows is
    reduced to a few states inside each map task, so no reducer receives its rows.

    Output: ``group_by``, ``n_left`` (left rows), ``n_joined`` (rows of the left
    join), ``n_matched`` (left rows with a partner), and per summed column ``x``:
    ``sum_x`` over the joined rows and ``known_x``, in how many of these ``x`` is not
    null.  Sums are decimal(38,0).

    Nulls: a null join key matches nothing, the left row is kept; a null group is a
    group of its own; null measures are skipped, and a sum over none but nulls is
    null, never 0.  Empty inputs give no rows.  Other columns are ignored.
    """
    require(left, *join_keys, *group_by, *left_sums)
    require(right, *join_keys, *right_sums)

    def states(df: DataFrame, keys: list[Column], n: str, sums: Sequence[str], p: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).cast(WIDE).alias(n),
            *[F.sum(F.col(c).cast(WIDE)).alias(f"_{p}s_{c}") for c in sums],
            *[F.count(F.col(c)).cast(WIDE).alias(f"_{p}k_{c}") for c in sums],
        )

    ls = states(
        left,
        [*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_by)], *[F.col(c).alias(f"_j{i}") for i, c in enumerate(join_keys)]],
        "_nl", left_sums, "l",
    )
    rs = states(
        right.dropna(subset=list(join_keys)),
        [F.col(c).alias(f"_j{i}") for i, c in enumerate(join_keys)],
        "_nr", right_sums, "r",
    )
    # states without a key match nothing; a salt keeps them from one partition of the join
    names = [f"_j{i}" for i in range(len(join_keys))]
    bare = F.exists(F.array(*[F.col(k).isNull() for k in names]), lambda x: x)
    salt = F.when(bare, F.pmod(F.xxhash64(*[F.col(f"_g{i}") for i in range(len(group_by))]), F.lit(NULL_SALTS))).otherwise(0)
    joined = ls.withColumn("_salt", salt).join(rs.withColumn("_salt", F.lit(0).cast("long")), [*names, "_salt"], "left")
    times = F.coalesce(F.col("_nr"), F.lit(1).cast(WIDE))
    total = lambda c: F.sum(c.cast(WIDE))
    return joined.groupBy(*[F.col(f"_g{i}").alias(c) for i, c in enumerate(group_by)]).agg(
        F.sum("_nl").cast("long").alias("n_left"),
        total(F.col("_nl") * times).alias("n_joined"),
        F.coalesce(F.sum(F.when(F.col("_nr").isNotNull(), F.col("_nl"))), F.lit(0)).cast("long").alias("n_matched"),
        *[total(F.col(f"_ls_{c}") * times).alias(f"sum_{c}") for c in left_sums],
        *[total(F.col(f"_lk_{c}") * times).alias(f"known_{c}") for c in left_sums],
        *[total(F.col(f"_rs_{c}") * F.col("_nl")).alias(f"sum_{c}") for c in right_sums],
        *[F.coalesce(total(F.col(f"_rk_{c}") * F.col("_nl")), F.lit(0).cast(WIDE)).alias(f"known_{c}") for c in right_sums],
    )


def heavy_groups(per_group: DataFrame, count: str, numerator: int, denominator: int) -> DataFrame:
    """The groups whose ``count`` is at least ``numerator / denominator`` of the sum
    over all groups, compared in whole numbers.  The groups, a row each, are written once,
    so that the total doesn't reduce the records a second time."""
    if numerator < 0 or denominator <= 0:
        raise ValueError("a share is a non-negative fraction")
    per_group = cut_lineage(per_group)
    total = per_group.agg(F.sum(F.col(count)).cast(WIDE).alias("t")).scalar()
    return per_group.filter(F.col(count).cast(WIDE) * denominator >= total * numerator)
