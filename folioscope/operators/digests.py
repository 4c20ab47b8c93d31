"""Digests of tables, and samples that every run draws alike."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def canonical(columns: Sequence[str]) -> Column:
    """A row as text: values between bars, null as a tilde."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])


def multiset_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n, digest): equal for equal multisets of rows in any order; one aggregation."""
    part = F.conv(F.substring(F.md5(canonical(columns)), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest"))


def exact_digest(df: DataFrame, columns: Sequence[str]) -> str:
    """SHA-256 over the sorted rows, streamed to the driver a partition at a time."""
    h = hashlib.sha256()
    line = df.select(canonical(columns).alias("l"))
    for r in line.orderBy("l").toLocalIterator():
        h.update(r.l.encode() + b"\n")
    return h.hexdigest()


def stratified_sample(df: DataFrame, strata: Sequence[str], key: str, per_stratum: int, seed: str) -> DataFrame:
    """``per_stratum`` rows of every stratum, chosen by a hash of seed and key."""
    order = F.md5(F.concat(F.lit(seed), F.lit(":"), F.col(key)))
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*strata).orderBy(order, key))).filter(F.col("_r") <= per_stratum).drop("_r")


def search(tables: Sequence[tuple[str, DataFrame, str, str]], text: str, most: int = 20) -> DataFrame:
    """(kind, id, label): of each kind the first entries whose label begins with the text,
    then those that hold it, any case; % and _ mean themselves."""
    t, out = text.lower(), None
    for kind, df, key, label in tables:
        hit = df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.col(label).alias("label")).distinct().filter(F.lower("label").contains(t))
        # a top-k per kind: nothing but the first few leaves a task
        top = hit.orderBy(F.lower("label").startswith(t).desc(), "label", "id").limit(most)
        out = top if out is None else out.unionByName(top)
    return out
