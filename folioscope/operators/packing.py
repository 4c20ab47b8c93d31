"""Byte-bounded pages, caps and payloads."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F


def shards(
    df: DataFrame, group: str, order: Sequence[str], size: Column, limit: int, policy: str = "single", dependency: str | None = None, dependency_size: int = 0,
    most_shards: int | None = None,
) -> DataFrame:
    """``df``'s group and order columns with ``shard``: rows in order put into pages of at
    most ``limit`` bytes, greedily.  A row larger than that has a page of its own
    (``single``) or raises (``fail``).  What rows refer to (``dependency``) is charged once
    a page.  More than ``most_shards`` pages of a group raise.

    Greedy filling is sequential within a group.  Only keys and sizes are moved, and
    they are streamed through in order, so a group of any size needs no memory."""
    named = F.lit(None).cast("string") if dependency is None else F.col(dependency).cast("string")
    slim = df.select(F.col(group), *order, size.cast("long").alias("_size"), named.alias("_dep"))
    schema = slim.schema.add("shard", "long")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, used, page, begun, held = None, 0, 0, False, set()
        for f in frames:
            out = []
            for g, n, dep in zip(f[group], f["_size"], f["_dep"]):
                n = 0 if n is None or n != n else int(n)
                extra = dependency_size if dependency is not None and dep is not None else 0
                if n + extra > limit and policy == "fail":
                    raise ValueError(f"a row of {n + extra} bytes exceeds {limit}")
                if not begun or not (g == at or (g is None and at is None)):
                    at, used, page, begun, held = g, 0, 0, True, set()
                elif used + n + (0 if dep in held else extra) > limit:
                    used, page, held = 0, page + 1, set()
                    if most_shards is not None and page >= most_shards:
                        raise ValueError(f"more than {most_shards} pages")
                used += n + (0 if dep in held else extra)
                held.add(dep)
                out.append(page)
            yield f.assign(shard=pd.Series(out, dtype="int64", index=f.index))

    placed = slim.repartition(group).sortWithinPartitions(group, *order)
    return placed.mapInPandas(run, schema).drop("_size", "_dep")


def reassemble(fragments: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Fragments of a group put together again in the order of shard and row; raises on a
    group whose shards don't count up from 0."""
    n = fragments.groupBy(group).agg(F.countDistinct("shard").alias("n"), F.max("shard").alias("m"))
    bad = n.filter(F.col("n") != F.col("m") + 1).limit(1).count()
    if bad:
        raise ValueError("a fragment is missing")
    return fragments.orderBy(group, "shard", *order)


def encode_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows as arrays of text by position; the list of columns is the contract."""
    return df.select(F.array(*[F.col(c).cast("string") for c in columns]).alias("r"))


def decode_rows(encoded: DataFrame, columns: Sequence[str], schema) -> DataFrame:
    """The inverse of :func:`encode_rows`; a row of another length raises."""
    ok = F.assert_true(F.size("r") == len(columns), F.lit("a row has another number of columns"))
    row = encoded.withColumn("_ok", ok).filter(F.col("_ok").isNull())
    return row.select(*[F.get("r", F.lit(i)).cast(schema[c].dataType).alias(c) for i, c in enumerate(columns)])


def parse_payload(df: DataFrame, text: str, schema: str) -> DataFrame:
    """JSON payloads as ``p``; one that doesn't fit the schema, or has keys outside it, raises."""
    p = F.from_json(text, schema, {"mode": "FAILFAST"})
    keys = F.array_sort(F.json_object_keys(text))
    known = F.array_sort(F.json_object_keys(F.to_json(p, {"ignoreNullFields": "false"})))
    ok = F.assert_true(F.size(F.array_except(keys, known)) == 0, F.lit("a payload has an unknown key"))
    return df.withColumn("p", p).withColumn("_ok", ok).filter(F.col("_ok").isNull()).drop("_ok")


def filer_payloads(rows: DataFrame, filings: DataFrame, changes: DataFrame, concentration: DataFrame) -> DataFrame:
    """(cik, periods, rows, filings, changes): a filer's payload as arrays in order, for
    filers known to fit a row; larger ones go through :func:`shards`.  Filings are those
    that the rows refer to."""
    gather = lambda df, name, columns: df.groupBy("cik").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
    used = filings.join(rows.select("filing_key").distinct(), "filing_key", "left_semi").join(rows.select("cik").distinct(), "cik", "left_semi")
    out = gather(concentration, "periods", ["period", "total_value", "hhi", "flag"])
    for df, name, columns in (
        (rows, "rows", ["period", "row_id", "position_key", "put_call_bucket", "unit_key", "value_usd", "shares", "filing_key"]),
        (used, "filings", ["filing_key", "accession", "filed_date"]), (changes, "changes", ["period", "position_key", "put_call_bucket", "unit_key", "change_kind", "delta_value"]),
    ):
        out = out.join(gather(df, name, columns), "cik", "left").withColumn(name, F.coalesce(name, F.array().cast(gather(df, name, columns).schema[name].dataType)))
    return out


def cap_rows(df: DataFrame, group: str, order: Sequence[Column], size: Column, most_rows: int, most_bytes: int) -> DataFrame:
    """The prefix of each group within a number of rows and bytes; the first row stays."""
    w = W.partitionBy(group).orderBy(*order)
    run = F.sum(F.coalesce(size.cast("long"), F.lit(0))).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    nth = F.row_number().over(w)
    return df.withColumn("_n", nth).withColumn("_b", run).filter((F.col("_n") == 1) | ((F.col("_n") <= most_rows) & (F.col("_b") <= most_bytes))).drop("_n", "_b")


def cap_bounds(df: DataFrame, capped: DataFrame, group: str, most_rows: int) -> DataFrame:
    """(group, total, kept, bound_by) of what :func:`cap_rows` made of ``df``: bound_by is
    ``bytes`` or ``rows``, null where nothing was left out."""
    both = df.select(group, F.lit(0).alias("k")).unionByName(capped.select(group, F.lit(1).alias("k")))
    n = both.groupBy(group).agg(F.count_if(F.col("k") == 0).alias("total"), F.count_if(F.col("k") == 1).alias("kept"))
    bound = F.when(F.col("kept") < F.least(F.col("total"), F.lit(most_rows)), "bytes").when(F.col("kept") < F.col("total"), "rows")
    return n.withColumn("bound_by", bound)


def payloads(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """All rows of an entity as one sorted JSON array, for entities known to fit a row."""
    return df.groupBy(entity).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*columns)))).alias("payload"), F.count(F.lit(1)).alias("n"))
