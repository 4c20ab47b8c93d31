"""Dated committee seats, sectors of issuers, and where a trade touches both."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Divisions of the standard industrial classification.
SECTORS = [
    (100, 999, "Agriculture"), (1000, 1499, "Mining"), (1500, 1799, "Construction"), (2000, 3999, "Manufacturing"), (4000, 4999, "Transport and utilities"),
    (5000, 5199, "Wholesale"), (5200, 5999, "Retail"), (6000, 6799, "Finance"), (7000, 8999, "Services"), (9100, 9729, "Public administration"),
]


def sector(sic):
    out = F.lit(None).cast("string")
    for a, b, name in SECTORS:
        out = F.when(sic.between(a, b), name).otherwise(out)
    return F.when(sic.isNotNull(), F.coalesce(out, F.lit("Unknown")))


def membership_as_of(events: DataFrame, member: str, at: str, seats: DataFrame) -> DataFrame:
    """Events with ``committees``: null outside the time the seats cover (unknown), empty
    inside it with no seat, else the sorted seats held (``valid_from <= at < valid_to``)."""
    span = seats.agg(F.min("valid_from").alias("a"), F.max(F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))).alias("z"))
    a, z = span.select("a").scalar(), span.select("z").scalar()
    asked = events.select(F.col(member).alias("_m"), F.col(at).alias("_at")).dropna().distinct()
    s = seats.select(F.col("bioguide_id").alias("_s"), "committee_id", F.col("valid_from").alias("_f"), F.col("valid_to").alias("_t"))
    held = asked.join(s, (F.col("_m") == F.col("_s")) & (F.col("_f") <= F.col("_at")) & (F.col("_t").isNull() | (F.col("_at") < F.col("_t"))))
    held = held.groupBy("_m", "_at").agg(F.array_sort(F.collect_set("committee_id")).alias("_c"))
    out = events.join(held, (F.col(member) == F.col("_m")) & (F.col(at) == F.col("_at")), "left")
    inside = F.coalesce((F.col(at) >= a) & (F.col(at) < z), F.lit(False))
    return out.withColumn("committees", F.when(inside, F.coalesce("_c", F.array().cast("array<string>")))).drop("_m", "_at", "_c")


def issuer_sector(trades: DataFrame, tickers: DataFrame, sics: DataFrame) -> DataFrame:
    """Trades with ``sector``, or which hop was missing: no_ticker, no_issuer, no_sic."""
    t = tickers.select(F.col("ticker").alias("_k"), F.col("cik").alias("_c"))
    s = sics.select(F.col("cik").alias("_i"), F.col("sic").alias("_sic"))
    j = trades.join(t, F.col("ticker") == F.col("_k"), "left").join(s, F.col("_c") == F.col("_i"), "left")
    label = F.when(F.col("ticker").isNull(), "no_ticker").when(F.col("_k").isNull(), "no_issuer").when(F.col("_i").isNull(), "no_sic").otherwise(sector(F.col("_sic")))
    return j.withColumn("sector", label).drop("_k", "_c", "_i", "_sic")


def jurisdiction_overlap(trades: DataFrame, jurisdictions: DataFrame) -> DataFrame:
    """Trades (with ``committees`` and ``sector``) by whether a seat oversees the sector:
    overlap, none, undatable, unmapped."""
    j = jurisdictions.groupBy(F.col("sector").alias("_s")).agg(F.collect_set("committee_id").alias("_j"))  # a row a sector
    x = trades.join(F.broadcast(j), F.col("sector") == F.col("_s"), "left")
    state = F.when(F.col("committees").isNull(), "undatable").when(F.col("sector").isNull() | F.col("sector").startswith("no_"), "unmapped").when(
        F.coalesce(F.arrays_overlap("committees", "_j"), F.lit(False)), "overlap"
    ).otherwise("none")
    return x.withColumn("jurisdiction", state).drop("_s", "_j")
