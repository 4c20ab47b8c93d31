"""Serving: numbered rows, merges, caps, payloads, digests, samples and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import digests as D, packing as K, populations as P
from ..sources import table
from ..sources.sinks import merge, numbered
from .congress import by_recency, trades
from .institutions import rows

#: Most rows and bytes of an embedded prefix in the reference.
EMBED_ROWS, EMBED_BYTES = 20_000, 2 * 1024 * 1024
ROW = ["txn_id", "filing_id", "bioguide_id", "ticker", "side", "transaction_date", "amount_low", "amount_high"]


def q_row_ids(spark, d):
    r = rows(spark, d).select("cik", "period", "value_usd", F.col("row_id").alias("source_row"))
    order = [F.col("cik"), F.col("period").desc(), F.col("value_usd").desc_nulls_last(), F.col("source_row")]
    return numbered(r, order).select("row_no", "source_row")


def q_filing_keys(spark, d):
    """Dense keys from 0 in the order of filing_id."""
    return numbered(table(spark, d, "inst_filings").select("filing_id"), [F.col("filing_id")], "dense_key")


def q_merge(spark, d):
    """Filings ingested since a day merged into those before: withdrawn ones win."""
    f = P.once(table(spark, d, "filings"), "filing_id").select("filing_id", "lifecycle", "row_count")
    return merge(f, f.filter(F.col("row_count").isNull()).withColumn("row_count", F.lit(0)), ["filing_id"])


def q_cap(spark, d):
    t = table(spark, d, "documents").select("doc_id", "source", "text")
    return K.cap_rows(t, "source", [F.col("doc_id")], F.octet_length("text"), EMBED_ROWS, EMBED_BYTES).select("doc_id", "source")


def q_cap_bounds(spark, d):
    """How many documents of a source there are, how many are embedded, and what bounds them."""
    return K.cap_bounds(table(spark, d, "documents"), q_cap(spark, d), "source", EMBED_ROWS)


def q_shards(spark, d):
    return K.shards(table(spark, d, "documents"), "source", ["doc_id"], F.octet_length("text"), 65_536)


def q_payloads(spark, d):
    return K.payloads(trades(spark, d).filter(F.col("bioguide_id").isNotNull()), "bioguide_id", ["txn_id"])


def q_digest(spark, d):
    return D.multiset_digest(P.once(table(spark, d, "transactions"), "txn_id"), ROW)


def q_holdings_digest(spark, d):
    return D.multiset_digest(rows(spark, d), ["row_id", "cik", "period", "position_key", "value_usd", "shares"])


def q_sample(spark, d):
    t = P.once(table(spark, d, "transactions"), "txn_id").withColumn("era", F.year("filed_date"))
    return D.stratified_sample(t, ["chamber", "era"], "txn_id", 5, "audit-1").select("chamber", "era", "txn_id")


def q_search(spark, d):
    m = table(spark, d, "members")
    t = table(spark, d, "transactions").filter(F.col("ticker").isNotNull())
    r = table(spark, d, "serving_filer_rows")
    return D.search([("member", m, "bioguide_id", "full_name"), ("ticker", t, "ticker", "ticker"), ("issuer", r, "cusip", "issuer_name")], "ken")


def q_feed_merge(spark, d):
    """Trades and paper filings in one feed, trades first on equal days; page by trades before."""
    t = trades(spark, d).select("filed_date", F.lit(0).alias("kind"), F.col("txn_id").alias("id"))
    f = P.once(table(spark, d, "filings"), "filing_id").filter((F.col("lifecycle") == "active") & (F.col("parse_status") == "needs_ocr"))
    both = t.unionByName(f.select("filed_date", F.lit(1).alias("kind"), F.col("filing_id").alias("id")))
    n = numbered(both, [F.col("filed_date").desc(), F.col("kind"), F.col("id")], "place")
    return n.select("place", "kind", "id")


def q_page(spark, d):
    return trades(spark, d).orderBy(*by_recency()).offset(100).limit(50).select("txn_id")


QUERIES = {
    "serving_row_ids": q_row_ids, "dense_filing_keys": q_filing_keys, "merge_sink": q_merge, "embed_cap": q_cap, "embed_bounds": q_cap_bounds, "byte_shards": q_shards, "member_payloads": q_payloads,
    "trade_digest": q_digest, "holdings_digest": q_holdings_digest, "audit_sample": q_sample, "search_index": q_search, "merged_feed": q_feed_merge, "trade_page": q_page,
}

from .congress import _T  # noqa: E402

_DIG = "count(*) AS n, CAST(CAST(coalesce(sum(CAST(('0x' || md5({r})[1:12]) AS UBIGINT)), 0) AS HUGEINT) AS VARCHAR) AS digest"
_ROW = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in ROW) + ")"
_HOLD = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in ["row_id", "cik", "period", "position_key", "value_usd", "shares"]) + ")"

SQL = {
    "serving_row_ids": "SELECT row_number() OVER (ORDER BY cik, period DESC, value_usd DESC NULLS LAST, row_id) - 1 AS row_no, row_id AS source_row FROM (SELECT DISTINCT ON (row_id) * FROM serving_filer_rows)",
    "dense_filing_keys": "SELECT filing_id, row_number() OVER (ORDER BY filing_id) - 1 AS dense_key FROM inst_filings",
    "merge_sink": "SELECT DISTINCT filing_id, lifecycle, coalesce(row_count, 0) AS row_count FROM filings",
    "embed_cap": """SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER w AS n, sum(coalesce(strlen(text), 0)) OVER w AS b FROM documents
 WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING)) WHERE n = 1 OR (n <= 20000 AND b <= 2097152)""",
    "byte_shards": """WITH RECURSIVE d AS (SELECT source, doc_id, coalesce(strlen(text), 0) AS b, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
 w AS (SELECT source, doc_id, i, b AS used, 0 AS shard FROM d WHERE i = 1
  UNION ALL SELECT d.source, d.doc_id, d.i, CASE WHEN w.used + d.b > 65536 THEN d.b ELSE w.used + d.b END, CASE WHEN w.used + d.b > 65536 THEN w.shard + 1 ELSE w.shard END FROM w JOIN d ON d.source = w.source AND d.i = w.i + 1)
 SELECT source, doc_id, CAST(shard AS BIGINT) AS shard FROM w""",
    "member_payloads": _T + """SELECT bioguide_id, '[' || string_agg('{"txn_id":"' || txn_id || '"}', ',' ORDER BY txn_id) || ']' AS payload, count(*) AS n FROM tr WHERE bioguide_id IS NOT NULL GROUP BY ALL""",
    "trade_digest": _T + f"SELECT {_DIG.replace('{r}', _ROW)} FROM tx",
    "holdings_digest": f"SELECT {_DIG.replace('{r}', _HOLD)} FROM (SELECT DISTINCT ON (row_id) * FROM serving_filer_rows)",
    "audit_sample": _T + """SELECT chamber, year(filed_date) AS era, txn_id FROM tx QUALIFY row_number() OVER (PARTITION BY chamber, year(filed_date) ORDER BY md5('audit-1:' || txn_id), txn_id) <= 5""",
    "search_index": """WITH k AS (SELECT DISTINCT 'member' AS kind, bioguide_id AS id, full_name AS label FROM members UNION ALL SELECT DISTINCT 'ticker', ticker, ticker FROM transactions WHERE ticker IS NOT NULL
 UNION ALL SELECT DISTINCT 'issuer', cusip, issuer_name FROM serving_filer_rows)
 SELECT * FROM k WHERE contains(lower(label), 'ken') QUALIFY row_number() OVER (PARTITION BY kind ORDER BY starts_with(lower(label), 'ken') DESC, label, id NULLS FIRST) <= 20""",
    "merged_feed": _T + """, b AS (SELECT filed_date, 0 AS kind, txn_id AS id FROM tr UNION ALL SELECT filed_date, 1, filing_id FROM ac WHERE parse_status = 'needs_ocr')
 SELECT row_number() OVER (ORDER BY filed_date DESC, kind, id) - 1 AS place, kind, id FROM b""",
    "trade_page": _T + "SELECT txn_id FROM tr ORDER BY filed_date DESC NULLS LAST, transaction_date DESC NULLS LAST, txn_id LIMIT 50 OFFSET 100",
}

SQL["embed_bounds"] = f"""SELECT source, total, kept, CASE WHEN kept < least(total, 20000) THEN 'bytes' WHEN kept < total THEN 'rows' END AS bound_by
 FROM (SELECT source, count(*) AS total FROM documents GROUP BY ALL) a JOIN (SELECT source, count(*) AS kept FROM ({SQL["embed_cap"]}) GROUP BY ALL) b USING (source)"""
