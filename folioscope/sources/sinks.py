"""Writers: whole partitions replaced, keys merged, rows numbered, feeds split by entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.common import cut_lineage


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces exactly the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def merge(base: DataFrame, updates: DataFrame, key: Sequence[str], keep_existing: bool = False) -> DataFrame:
    """Base with updates by key: updated rows win, or existing ones if ``keep_existing``.
    Of several updates of a key the greatest row counts.  One aggregation over both,
    which copies of a key meet before the shuffle."""
    rest = [c for c in base.columns if c not in key]
    tag = lambda df, w: df.select(*key, F.struct(F.lit(w).alias("w"), *rest).alias("r"))
    both = tag(base, 1 if keep_existing else 0).unionByName(tag(updates, 0 if keep_existing else 1))
    return both.groupBy(*key).agg(F.max("r").alias("r")).select(*[F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in base.columns])


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """Rows numbered from 0 in a total order without a single task: ranges are sorted on
    their own, and each begins where the ranges before it end (one number a range)."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    placed = cut_lineage(placed)
    part, at = F.shiftrightunsigned("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_p", before.alias("_b"))  # as many rows as ranges
    return placed.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn(name, F.col("_b") + at).drop("_m", "_p", "_b")


def write_feeds(df: DataFrame, path: str, entity: str, order: Sequence[Column], limit: int) -> None:
    """The newest rows of every entity as JSON, one folder each, in one job."""
    w = W.partitionBy(entity).orderBy(*order)
    top = df.filter(F.col(entity).isNotNull()).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= limit).drop("_r")
    top.repartition(entity).write.mode("overwrite").partitionBy(entity).json(path)
