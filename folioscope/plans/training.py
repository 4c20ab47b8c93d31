"""Queries of the general data-preparation operators (p1, p2, p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.common import cut_lineage
from ..operators.asof import asof_join, disjoint_versions
from ..operators.eager import distinct_records, eager_join_aggregate, heavy_groups
from ..operators.snapshots import diff_snapshots_of
from ..sources import table

POSITION = ["position_key", "put_call_bucket", "unit_key"]


def per_filer(spark: SparkSession, d: str) -> DataFrame:
    holdings = distinct_records(
        table(spark, d, "serving_filer_rows"), "row_id", ["cik", "filing_key", "value_usd", "shares"]
    )
    reports = table(spark, d, "inst_filings").select("filing_key", "table_value_total_usd")
    return eager_join_aggregate(
        holdings, reports, ["filing_key"], ["cik"], ["value_usd", "shares"], ["table_value_total_usd"]
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    holdings = distinct_records(table(spark, d, "serving_filer_rows"), "row_id", ["cik", "filing_key"])
    reports = table(spark, d, "inst_filings").select("filing_key")
    counts = eager_join_aggregate(holdings, reports, ["filing_key"], ["cik"])
    # without a column of the joined states Spark drops the join; n_matched never exceeds n_left
    counts = counts.withColumn("n", F.greatest("n_left", "n_matched"))
    return heavy_groups(counts, "n", 2, 100).filter(F.col("cik").isNotNull()).select("cik")


def p1_per_filer(spark: SparkSession, d: str) -> DataFrame:
    return per_filer(spark, d).select(
        "cik", "n_left", F.col("n_joined").cast("long").alias("n_joined"), "n_matched",
        F.col("sum_value_usd").cast("long").alias("sum_value_usd"),
        F.col("known_value_usd").cast("long").alias("known_value_usd"),
        F.col("sum_shares").cast("long").alias("sum_shares"),
        F.col("sum_table_value_total_usd").cast("string").alias("sum_cover_total_usd"),
    )


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Holdings beside every filing of their filer: each holding meets as many rows as the
    filer has filings, and each filing as many as it has holdings."""
    holdings = distinct_records(table(spark, d, "serving_filer_rows"), "row_id", ["cik", "period", "value_usd"])
    reports = table(spark, d, "inst_filings").select("cik", "table_value_total_usd")
    pairs = eager_join_aggregate(holdings, reports, ["cik"], ["cik", "period"], ["value_usd"], ["table_value_total_usd"])
    return pairs.select(
        "cik", "period", "n_left", F.col("n_joined").cast("long").alias("n_joined"), "n_matched",
        F.col("sum_value_usd").cast("string").alias("sum_value_usd"), F.col("sum_table_value_total_usd").cast("string").alias("sum_cover_total_usd"),
    )


def p2_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "serving_filer_rows")
    keyed = rows.filter(F.col("position_key").isNotNull())
    return diff_snapshots_of(rows, keyed, "cik", "period", POSITION, ["shares", "value_usd"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_changes(spark, d).select("cik", "period", *POSITION, "change_kind")


def party_at_trade(spark: SparkSession, d: str) -> DataFrame:
    """Each dated trade of a member once, with the party on its date and on the roster."""
    floor = F.lit("0001-01-01").cast("date")
    versions = (
        table(spark, d, "members")
        .withColumn("_t", F.explode(disjoint_versions(F.col("terms"), "start", "end", "party", floor)))
        .select(
            "bioguide_id", F.col("_t.valid_from").alias("valid_from"), F.col("_t.valid_to").alias("valid_to"),
            F.when(F.col("_t.covered"), F.col("_t.party")).otherwise("none").alias("party"),
            F.col("party").alias("roster_party"), F.lit(True).alias("on_roster"),
        )
    )
    trades = (
        table(spark, d, "transactions")
        .filter(F.col("bioguide_id").isNotNull() & F.col("transaction_date").isNotNull() & F.col("txn_id").isNotNull())
        .select("txn_id", "bioguide_id", "transaction_date")
        .dropDuplicates(["txn_id"])
    )
    trades = cut_lineage(trades)  # read for the cuts and for the merge
    joined = asof_join(
        trades, versions, "bioguide_id", "transaction_date", "valid_from", "valid_to", ["party", "roster_party", "on_roster"]
    )
    # a member no list knows has no term at any date
    return joined.withColumn("party", F.when(F.col("on_roster"), F.col("party")).otherwise("none"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    differs = F.col("roster_party").isNull() | ~F.col("party").eqNullSafe(F.col("roster_party"))
    return party_at_trade(spark, d).filter(differs).select("txn_id", "party")


def p6_party_at_trade(spark: SparkSession, d: str) -> DataFrame:
    return party_at_trade(spark, d).select("txn_id", "bioguide_id", "transaction_date", "party", "roster_party")


QUERIES = {
    "p1_found": p1_found,
    "p1_per_filer": p1_per_filer,
    "p1_pairs": p1_pairs,
    "p2_found": p2_found,
    "p2_changes": p2_changes,
    "p6_found": p6_found,
    "p6_party_at_trade": p6_party_at_trade,
}

_CHANGES = """
WITH cal AS (
  SELECT cik, period, lag(period) OVER w AS prev, lead(period) OVER w AS nxt
  FROM (SELECT DISTINCT cik, period FROM serving_filer_rows WHERE cik IS NOT NULL AND period IS NOT NULL)
  WINDOW w AS (PARTITION BY cik ORDER BY period)
), h AS (
  SELECT DISTINCT cik, period, position_key, put_call_bucket, unit_key, shares, value_usd
  FROM serving_filer_rows WHERE position_key IS NOT NULL
), c AS (SELECT h.*, cal.prev, cal.nxt FROM h JOIN cal USING (cik, period)),
f AS (
  SELECT a.cik, a.period, a.position_key, a.put_call_bucket, a.unit_key,
         CASE WHEN b.cik IS NULL THEN 'added' ELSE 'changed' END AS change_kind,
         b.shares AS old_shares, b.value_usd AS old_value_usd, a.shares AS new_shares, a.value_usd AS new_value_usd
  FROM c a LEFT JOIN c b ON b.cik = a.cik AND b.period = a.prev AND b.position_key = a.position_key
    AND b.put_call_bucket IS NOT DISTINCT FROM a.put_call_bucket AND b.unit_key IS NOT DISTINCT FROM a.unit_key
  WHERE a.prev IS NOT NULL AND (b.cik IS NULL OR a.shares IS DISTINCT FROM b.shares OR a.value_usd IS DISTINCT FROM b.value_usd)
  UNION ALL
  SELECT a.cik, a.nxt, a.position_key, a.put_call_bucket, a.unit_key, 'removed', a.shares, a.value_usd, NULL, NULL
  FROM c a LEFT JOIN c b ON b.cik = a.cik AND b.period = a.nxt AND b.position_key = a.position_key
    AND b.put_call_bucket IS NOT DISTINCT FROM a.put_call_bucket AND b.unit_key IS NOT DISTINCT FROM a.unit_key
  WHERE a.nxt IS NOT NULL AND b.cik IS NULL
)
"""
_PARTY = """
WITH t AS (SELECT DISTINCT txn_id, bioguide_id, transaction_date FROM transactions
           WHERE txn_id IS NOT NULL AND bioguide_id IS NOT NULL AND transaction_date IS NOT NULL),
v AS (SELECT bioguide_id, unnest(terms) AS x FROM members),
f AS (
  SELECT t.txn_id, t.bioguide_id, t.transaction_date,
         coalesce(max_by(v.x.party, v.x.start), 'none') AS party, any_value(m.party) AS roster_party
  FROM t LEFT JOIN members m ON m.bioguide_id = t.bioguide_id
  LEFT JOIN v ON v.bioguide_id = t.bioguide_id AND v.x.start <= t.transaction_date
    AND (v.x."end" IS NULL OR t.transaction_date < v.x."end")
  GROUP BY t.txn_id, t.bioguide_id, t.transaction_date
)
"""

SQL = {
    "p1_found": """
SELECT cik FROM (SELECT cik, count(DISTINCT row_id) AS n FROM serving_filer_rows GROUP BY cik)
WHERE cik IS NOT NULL AND n * 100 >= 2 * (SELECT count(DISTINCT row_id) FROM serving_filer_rows)
""",
    "p1_per_filer": """
SELECT h.cik, count(*) AS n_left, count(*) AS n_joined, count(f.filing_key) AS n_matched,
       CAST(sum(h.value_usd) AS BIGINT) AS sum_value_usd, count(h.value_usd) AS known_value_usd,
       CAST(sum(h.shares) AS BIGINT) AS sum_shares, CAST(sum(f.table_value_total_usd) AS VARCHAR) AS sum_cover_total_usd
FROM (SELECT DISTINCT row_id, cik, filing_key, value_usd, shares FROM serving_filer_rows) h
LEFT JOIN inst_filings f USING (filing_key) GROUP BY h.cik
""",
    "p1_pairs": """
SELECT h.cik, h.period, count(DISTINCT h.row_id) AS n_left, count(*) AS n_joined, count(DISTINCT h.row_id) FILTER (f.filing_key IS NOT NULL) AS n_matched,
       CAST(sum(h.value_usd) AS VARCHAR) AS sum_value_usd, CAST(sum(f.table_value_total_usd) AS VARCHAR) AS sum_cover_total_usd
FROM (SELECT DISTINCT row_id, cik, period, value_usd FROM serving_filer_rows) h LEFT JOIN inst_filings f ON f.cik = h.cik GROUP BY h.cik, h.period
""",
    "p2_found": _CHANGES + "SELECT cik, period, position_key, put_call_bucket, unit_key, change_kind FROM f",
    "p2_changes": _CHANGES + "SELECT * FROM f",
    "p6_found": _PARTY + "SELECT txn_id, party FROM f WHERE roster_party IS NULL OR party <> roster_party",
    "p6_party_at_trade": _PARTY + "SELECT * FROM f",
}
