"""Questions about the identity registry.  The tables hold no separate observations and no
authority: a holding is an observation of its CUSIP at the end of its quarter, with its
issuer name's first word as the candidate entity, and CUSIPs ending in an even digit are declared."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import intervals as I, registry as R
from ..sources import table

#: Days of a gap worth a review on these twelve quarters.
GAP = 180


def observations(spark, d):
    r = table(spark, d, "serving_filer_rows").filter(F.col("cusip").isNotNull())
    name = F.element_at(F.split(N.issuer_name(F.col("issuer_name")), " "), 1)
    return r.select(F.lit("cusip").alias("id_type"), F.col("cusip").alias("value"), F.col("period").cast("date").alias("at"), F.when(F.col("security_id").isNotNull(), name).alias("candidate")).distinct()


def authority(spark, d):
    """Declared CUSIPs: one owner up to the middle of 2023, another from then on."""
    c = observations(spark, d).select("id_type", "value").distinct().filter(F.substring("value", 9, 1).isin("0", "2", "4", "6", "8"))
    day = F.lit("2023-07-01").cast("date")
    none = F.lit(None).cast("date")
    early = c.select("*", F.concat(F.lit("sec:a:"), "value").alias("owner"), F.lit("equity").alias("class"), none.alias("valid_from"), day.alias("valid_to"))
    late = c.select("*", F.concat(F.lit("sec:b:"), "value").alias("owner"), F.lit("equity").alias("class"), day.alias("valid_from"), none.alias("valid_to"))
    return early.unionByName(late)


def continuities(spark, d):
    c = observations(spark, d).select("id_type", "value").distinct().filter(F.substring("value", 9, 1).isin("1", "3"))
    return c.select("*", F.lit("2020-01-01").cast("date").alias("gap_from"), F.lit("2030-01-01").cast("date").alias("gap_to"), F.when(F.substring("value", 9, 1) == "1", "reviewed").otherwise("auto").alias("review_state"))


def q_bindings(spark, d):
    """Quarters in which a CUSIP was listed, by owner, cut where the owner changes."""
    return R.list_bindings(observations(spark, d), authority(spark, d)).withColumn("valid_to", F.coalesce("valid_to", F.lit(I.OPEN).cast("date")))


def q_links(spark, d):
    return R.entity_links(observations(spark, d), authority(spark, d))


def q_review(spark, d):
    return R.reuse_review(R.list_bindings(observations(spark, d), authority(spark, d)), authority(spark, d), continuities(spark, d), GAP)


def q_supersessions(spark, d):
    """What a declaration replaces of the registry without any."""
    o, a = observations(spark, d), authority(spark, d)
    links = R.supersessions(R.bindings(o, a.limit(0)), R.bindings(o, a))
    return R.successor(links)


def q_state(spark, d):
    o, a = observations(spark, d), authority(spark, d)
    b = R.list_bindings(o, a)
    return R.registry_state(b, R.entity_links(o, a), R.reuse_review(b, a, continuities(spark, d), GAP))


def snapshots(spark, d):
    """Yearly snapshots of what a ticker was called in that year's filings."""
    t = table(spark, d, "transactions").filter(F.col("ticker").isNotNull() & F.col("filed_date").isNotNull())
    return t.groupBy(F.col("ticker").alias("key"), F.trunc("filed_date", "year").alias("at")).agg(F.min("asset_name").alias("value"))


def q_names(spark, d):
    return R.name_history(snapshots(spark, d))


def q_name_as_of(spark, d):
    """Every trade with what its ticker was called as of its filing."""
    iv = q_names(spark, d).select(F.col("key").alias("value"), "valid_from", "valid_to", F.col("value").alias("payload"), F.lit(False).alias("disputed"), F.lit(0).alias("layer"))
    t = table(spark, d, "transactions").filter(F.col("ticker").isNotNull()).select("txn_id", "ticker", "filed_date").distinct()
    return I.resolve_as_of(t, "ticker", "filed_date", iv).select("txn_id", F.col("resolved").alias("name"))


QUERIES = {
    "registry_bindings": q_bindings, "registry_links": q_links, "registry_review": q_review, "registry_supersessions": q_supersessions, "registry_state": q_state,
    "ticker_names": q_names, "ticker_name_as_of": q_name_as_of,
}

_R = r"""WITH o AS (SELECT DISTINCT cusip AS value, CAST(period AS DATE) AS at_, CASE WHEN security_id IS NOT NULL THEN string_split(upper(trim(regexp_replace(issuer_name, '\s+', ' ', 'g'))), ' ')[1] END AS candidate
  FROM serving_filer_rows WHERE cusip IS NOT NULL),
v AS (SELECT DISTINCT value, value[9] IN ('0', '2', '4', '6', '8') AS declared FROM o),
w AS (SELECT value, 'sec:a:' || value AS security_id, 'declared' AS id_state, DATE '0001-01-01' AS a, DATE '2023-07-01' AS z FROM v WHERE declared UNION ALL SELECT value, 'sec:b:' || value, 'declared', DATE '2023-07-01', DATE '9999-12-31' FROM v WHERE declared
 UNION ALL SELECT value, 'sec:prov:' || sha256('{"id_type":"cusip","value":"' || value || '"}')[1:32], 'provisional', DATE '0001-01-01', DATE '9999-12-31' FROM v WHERE NOT declared),
ow AS (SELECT o.*, w.security_id, w.id_state FROM o JOIN w ON w.value = o.value AND w.a <= at_ AND at_ < w.z),
q AS (SELECT DISTINCT value, CAST(date_trunc('quarter', at_) AS DATE) AS qa, CAST(date_trunc('quarter', at_) + INTERVAL 3 MONTH AS DATE) AS qz FROM o),
cu AS (SELECT w.security_id, q.value, w.id_state, greatest(qa, a) AS a, least(qz, z) AS z FROM q JOIN w USING (value) WHERE qa < z AND a < qz),
g1 AS (SELECT *, CASE WHEN a <= max(z) OVER (PARTITION BY security_id, value ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM cu),
g2 AS (SELECT *, sum(n) OVER (PARTITION BY security_id, value ORDER BY a) AS isl FROM g1),
b AS (SELECT security_id, 'cusip' AS id_type, value, id_state, min(a) AS valid_from, max(z) AS valid_to FROM g2 GROUP BY security_id, value, id_state, isl),
lk AS (SELECT security_id, CASE WHEN count(DISTINCT candidate) = 1 THEN min(candidate) END AS entity_id, CASE count(DISTINCT candidate) WHEN 1 THEN 'resolved' WHEN 0 THEN 'unresolved' ELSE 'conflict' END AS state, count(DISTINCT candidate) AS candidates FROM ow GROUP BY security_id),
gp AS (SELECT * FROM (SELECT id_type, value, lag(valid_to) OVER (PARTITION BY value ORDER BY valid_from) AS gap_from, valid_from AS gap_to FROM b) WHERE gap_from < gap_to AND date_diff('day', gap_from, gap_to) >= 180),
rv AS (SELECT *, CASE WHEN value[9] IN ('0', '2', '4', '6', '8') AND DATE '2023-07-01' BETWEEN gap_from AND gap_to THEN 'explained' WHEN value[9] = '1' THEN 'cleared' ELSE 'disputed' END AS decision FROM gp)
"""
_NM = """WITH s AS (SELECT ticker AS key, CAST(date_trunc('year', filed_date) AS DATE) AS at_, min(asset_name) AS value FROM transactions WHERE ticker IS NOT NULL AND filed_date IS NOT NULL GROUP BY ALL),
c AS (SELECT * FROM s QUALIFY lag(value) OVER (PARTITION BY key ORDER BY at_) IS DISTINCT FROM value), h AS (SELECT key, value, at_ AS valid_from, lead(at_) OVER (PARTITION BY key ORDER BY at_) AS valid_to FROM c)
"""

SQL = {
    "registry_bindings": _R + "SELECT * FROM b",
    "registry_links": _R + "SELECT * FROM lk",
    "registry_review": _R + "SELECT * FROM rv",
    "registry_supersessions": _R + """SELECT 'sec:prov:' || sha256('{"id_type":"cusip","value":"' || value || '"}')[1:32] AS old_security_id, CASE WHEN count(DISTINCT security_id) = 1 THEN min(security_id) END AS security_id, count(DISTINCT security_id) AS successors FROM ow WHERE id_state = 'declared' GROUP BY value""",
    "registry_state": _R + "SELECT 'binding' AS kind, id_state AS state, count(*) AS n FROM b GROUP BY ALL UNION ALL SELECT 'link', state, count(*) FROM lk GROUP BY ALL UNION ALL SELECT 'review', decision, count(*) FROM rv GROUP BY ALL",
    "ticker_names": _NM + "SELECT * FROM h",
    "ticker_name_as_of": _NM + "SELECT t.txn_id, h.value AS name FROM (SELECT DISTINCT txn_id, ticker, filed_date FROM transactions WHERE ticker IS NOT NULL) t LEFT JOIN h ON h.key = t.ticker AND h.valid_from <= t.filed_date AND (h.valid_to IS NULL OR t.filed_date < h.valid_to)",
}
