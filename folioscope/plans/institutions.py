"""Questions about reported holdings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions import normalize as N
from ..operators import populations as P, positions as Q
from ..operators.common import cut_lineage
from ..operators.graph import connected_components
from ..sources import table


def filings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "inst_filings")


def rows(spark: SparkSession, d: str) -> DataFrame:
    return P.once(table(spark, d, "serving_filer_rows"), "row_id")


def composed(spark: SparkSession, d: str) -> DataFrame:
    """Surviving filings with their quarter and the marks of the two populations."""
    return quarter(P.composed_filings(filings(spark, d), rows(spark, d)))


def books(spark: SparkSession, d: str) -> DataFrame:
    """:func:`composed`, a few columns a filing, written once for questions that look at it
    several times, so that the holdings are summed once."""
    keep = ["filing_key", "cik", "period", "period_of_report", "submission_type", "is_amendment", "amendment_type", "parse_status", "filed_date", "accession", "within", "affiliated"]
    return cut_lineage(composed(spark, d).select(*keep))


def reported_periods(spark: SparkSession, d: str, f: DataFrame | None = None) -> DataFrame:
    """The periods a filer reported for, also those without a holding."""
    f = composed(spark, d) if f is None else f
    return f.filter("within").select("cik", "period").distinct()


def reported_rows(spark: SparkSession, d: str, f: DataFrame | None = None) -> DataFrame:
    """Every filer's own book: the rows of its composed filings."""
    f = composed(spark, d) if f is None else f
    return rows(spark, d).join(f.filter("within").select("filing_key"), "filing_key", "left_semi")


def default_rows(spark: SparkSession, d: str, f: DataFrame | None = None) -> DataFrame:
    """The rows that count across filers: as reported, affiliates counted once."""
    f = composed(spark, d) if f is None else f
    return rows(spark, d).join(f.filter(F.col("within") & ~F.col("affiliated")).select("filing_key"), "filing_key", "left_semi")


def deltas(spark: SparkSession, d: str, f: DataFrame | None = None) -> DataFrame:
    f = books(spark, d) if f is None else f
    return Q.qoq_deltas(Q.fold_positions(default_rows(spark, d, f)), reported_periods(spark, d, f))


def issuer():
    return N.issuer_key(F.col("cusip"), F.col("issuer_name"))


def quarter(f: DataFrame) -> DataFrame:
    return f.withColumn("period", F.date_format(N.quarter_end(F.col("period_of_report")), "yyyy-MM-dd"))


def q_survivors(spark, d):
    return P.restatement_survivors(filings(spark, d)).select("filing_key")


def q_reconciled(spark, d):
    return P.suppress_affiliates(P.restatement_survivors(filings(spark, d))).select("filing_key")


def q_default(spark, d):
    return P.default_filings(filings(spark, d), rows(spark, d)).select("filing_key")


def q_reported(spark, d):
    return P.filer_reported_filings(filings(spark, d), rows(spark, d)).select("filing_key")


def q_marked(spark, d):
    """Reported holdings marked with whether they count by default."""
    f = composed(spark, d).filter("within").select("filing_key", "affiliated")
    g = rows(spark, d).join(f, "filing_key").groupBy("cik", "period")
    return g.agg(F.count(F.lit(1)).alias("holdings"), F.count_if(~F.col("affiliated")).alias("default_holdings"))


def q_authoritative(spark, d):
    return P.authoritative_periods(P.filer_reported_filings(filings(spark, d), rows(spark, d)))


def q_links(spark, d):
    return P.link_amendments(filings(spark, d))


def q_affiliates(spark, d):
    return P.affiliate_flags(P.restatement_survivors(filings(spark, d)))


def q_groups(spark, d):
    """Affiliate groups per period: connected filers, named by the smallest cik."""
    e = P.affiliate_flags(P.restatement_survivors(filings(spark, d)))
    return connected_components(e.select("period_of_report", "cik", "covered"), ["period_of_report"], "cik", "covered")


def q_positions(spark, d):
    return Q.fold_positions(default_rows(spark, d))


def q_display(spark, d):
    return Q.display_positions(reported_rows(spark, d))


def q_deltas(spark, d):
    return deltas(spark, d)


def q_moves(spark, d):
    return deltas(spark, d).orderBy(*Q.by_move()).limit(100).select("cik", "position_key", "put_call_bucket", "unit_key", "period", "change_kind", "delta_value")


def q_exits(spark, d):
    f = books(spark, d)
    a = quarter(P.authoritative_periods(f.filter("within").drop("period")))
    x = Q.downgrade_exits(deltas(spark, d, f), a)
    return x.groupBy("period", "change_kind").agg(F.count(F.lit(1)).alias("n"))


def q_holders(spark, d):
    return Q.top_holders(default_rows(spark, d), issuer())


def q_concentration(spark, d, f=None):
    f = books(spark, d) if f is None else f
    return Q.concentration(reported_rows(spark, d, f), reported_periods(spark, d, f))


def q_outsized(spark, d):
    """A period is admitted if none of its surviving filings failed or conflicts with its cover."""
    f = books(spark, d)
    bad = ~F.col("within") | F.coalesce(F.col("parse_status") == "failed", F.lit(False))
    admitted = f.groupBy("cik", "period").agg((F.count_if(bad) == 0).alias("admitted"))
    shares = q_concentration(spark, d, f).join(admitted, ["cik", "period"])
    return Q.outsized(shares, f.filter("within"))


def q_coverage(spark, d):
    f = quarter(P.restatement_survivors(filings(spark, d)))
    return Q.coverage(f, rows(spark, d), ["period"])


def q_covers(spark, d):
    return Q.cover_dispositions(filings(spark, d), rows(spark, d))


def q_registry(spark, d):
    """Every filer with a reported filing, all its periods rolled up; filers without
    holdings stay."""
    b = books(spark, d)
    h = reported_rows(spark, d, b).groupBy("cik").agg(
        F.count(F.lit(1)).alias("holdings"), F.coalesce(Q.exact_sum("value_usd"), F.lit(0)).alias("value"),
        F.count_if(F.col("value_usd").isNull()).alias("undisclosed"), F.count_if(F.col("position_key").isNull()).alias("unkeyed"),
    )
    f = b.filter("within").groupBy("cik").agg(F.count(F.lit(1)).alias("filings"), F.max("filed_date").alias("latest_filed"), F.max("period").alias("latest_period"))
    z = [F.coalesce(c, F.lit(0)).alias(c) for c in ("holdings", "value", "undisclosed", "unkeyed")]
    return f.join(h, "cik", "left").select("cik", "filings", "latest_filed", *z, "latest_period")


def q_effective(spark, d):
    """Filers by the covers of their surviving filings; one failed cover excludes a filer."""
    s = P.restatement_survivors(filings(spark, d))
    g = s.groupBy("cik").agg(Q.exact_sum("table_value_total_usd").alias("value"), F.count_if(F.col("parse_status") == "failed").alias("bad"))
    g = g.filter((F.col("bad") == 0) & F.col("value").isNotNull())
    # the first 500 alone are kept, so the order is a top-k and not a global sort
    return g.orderBy(F.desc("value"), "cik").limit(500).select("cik", "value")


def q_issuer_grain(spark, d):
    """Issuer, period and filer: the value is null if a part is undisclosed; the total
    over the default population, null likewise, stands beside it."""
    f = composed(spark, d).filter("within").select("filing_key", "affiliated")
    r = rows(spark, d).join(f, "filing_key").withColumn("issuer_key", issuer())
    mine = ~F.col("affiliated")
    g = r.groupBy("issuer_key", "period", "cik").agg(
        F.when(F.count("value_usd") == F.count(F.lit(1)), Q.exact_sum("value_usd")).alias("value"), F.count(F.lit(1)).alias("n"),
        F.sum(F.when(mine, F.col("value_usd").cast(Q.WIDE))).alias("_v"), F.count_if(mine & F.col("value_usd").isNull()).alias("_u"),
    )
    t = g.groupBy("issuer_key", "period").agg(F.when(F.sum("_u") == 0, F.coalesce(F.sum("_v"), F.lit(0).cast(Q.WIDE))).cast("long").alias("dedup_total"))
    return g.drop("_v", "_u").join(t, ["issuer_key", "period"])


def q_latest(spark, d):
    """Each filer's latest period with holdings, whole."""
    return Q.latest(reported_rows(spark, d, books(spark, d)), "cik").select("row_id", "cik", "period")


def q_period_diff(spark, d):
    """A filer page's comparison of the two newest periods."""
    f = books(spark, d)
    return Q.diff_latest(Q.display_positions(reported_rows(spark, d, f)), reported_periods(spark, d, f))


def q_filer_covers(spark, d):
    """The composition's latest filing: latest date, then greatest accession."""
    f = quarter(P.filer_reported_filings(filings(spark, d), rows(spark, d))).filter(F.col("filed_date").isNotNull())
    return f.groupBy("cik", "period").agg(F.max_by("filing_key", F.struct("filed_date", "accession")).alias("latest_filing"), F.max("filed_date").alias("filed"), F.count(F.lit(1)).alias("filings"))


def q_lag(spark, d):
    lag = F.datediff("filed_date", N.quarter_end(F.col("period_of_report")))
    late = F.col("filed_date") > N.filing_deadline(F.col("period_of_report"))
    return filings(spark, d).select("filing_key", N.quarter_tag(F.col("period_of_report")).alias("quarter"), lag.alias("lag_days"), late.alias("late"))


def q_universal_flags(spark, d):
    """The flags that rows of a filer's period carry, and whether every row does."""
    r = reported_rows(spark, d, books(spark, d)).withColumn("f", F.from_json("flags", "array<string>"))
    n = r.groupBy("cik", "period").agg(F.count(F.lit(1)).alias("rows"))
    k = r.select("cik", "period", F.explode(F.array_distinct("f")).alias("flag")).groupBy("cik", "period", "flag").agg(F.count(F.lit(1)).alias("carried"))
    return k.join(n, ["cik", "period"]).withColumn("universal", F.col("carried") == F.col("rows"))


QUERIES = {
    "restatement_survivors": q_survivors, "reconciled_filings": q_reconciled, "default_filings": q_default, "reported_filings": q_reported,
    "default_marks": q_marked, "authoritative_periods": q_authoritative, "amendment_links": q_links, "affiliate_flags": q_affiliates,
    "affiliate_groups": q_groups, "position_fold": q_positions, "display_positions": q_display, "qoq_deltas": q_deltas, "biggest_moves": q_moves,
    "exit_downgrade": q_exits, "issuer_top_holders": q_holders, "filer_concentration": q_concentration, "outsized_periods": q_outsized,
    "period_coverage": q_coverage, "cover_dispositions": q_covers, "filer_registry": q_registry, "effective_filers": q_effective,
    "issuer_holder_grain": q_issuer_grain, "latest_period_rows": q_latest, "period_diff": q_period_diff, "composition_latest": q_filer_covers,
    "reporting_lag": q_lag, "universal_flags": q_universal_flags,
}

_B = """
WITH RECURSIVE r AS (SELECT DISTINCT ON (row_id) * FROM serving_filer_rows),
li AS (SELECT *, strftime(last_day(date_trunc('quarter', period_of_report) + INTERVAL 2 MONTH), '%Y-%m-%d') AS period,
  {'d': filed_date, 'n': coalesce(amendment_no, 0), 'a': accession} AS place FROM inst_filings WHERE lifecycle = 'active'),
-- the greatest restatement of a filer's period displaces all that come before it
re AS (SELECT cik, period_of_report, max(place) AS top FROM li WHERE amendment_type = 'RESTATEMENT' AND filed_date IS NOT NULL GROUP BY ALL),
sv AS (SELECT li.* EXCLUDE (place) FROM li LEFT JOIN re USING (cik, period_of_report) WHERE top IS NULL OR filed_date IS NULL OR place >= top),
om AS (SELECT filing_key, cik, period_of_report, unnest(other_managers) AS m FROM sv),
na AS (SELECT period_of_report, m.file_number_norm AS file_number_norm, list(DISTINCT filing_key) AS who FROM om WHERE m.file_number_norm IS NOT NULL GROUP BY ALL),
rs AS (SELECT filing_key, sum(value_usd) AS s FROM r WHERE security_id IS NOT NULL GROUP BY ALL),
cm AS (SELECT sv.*, coalesce(len(list_filter(who, lambda k: k <> sv.filing_key)) > 0, false) AS affiliated,
  coalesce(coalesce(s, 0) - table_value_total_usd <= greatest(1000, table_value_total_usd // 1000), true) AS within
 FROM sv LEFT JOIN na USING (period_of_report, file_number_norm) LEFT JOIN rs USING (filing_key)),
rc AS (SELECT * FROM cm WHERE NOT affiliated), fr AS (SELECT * FROM cm WHERE within), df AS (SELECT * FROM fr WHERE NOT affiliated), fp AS (SELECT DISTINCT cik, period FROM fr),
dr AS (SELECT r.* FROM r SEMI JOIN df USING (filing_key)), rr AS (SELECT r.* FROM r SEMI JOIN fr USING (filing_key)),
au AS (SELECT cik, period_of_report FROM (SELECT *, upper(regexp_replace(submission_type, '[\\s-]', '', 'g')) AS fm,
   coalesce(is_amendment, false) OR upper(regexp_replace(submission_type, '\\s', '', 'g')) LIKE '%/A' AS am FROM fr)
  GROUP BY ALL HAVING count(*) FILTER (fm LIKE '13FHR%' AND (NOT am OR coalesce(amendment_type = 'RESTATEMENT', false))) = 1
   AND count(*) FILTER (coalesce(parse_status <> 'parsed', true)) = 0 AND count(*) FILTER (am AND NOT coalesce(amendment_type IN ('RESTATEMENT', 'NEW_HOLDINGS'), false)) = 0),
ps AS (
  SELECT cik, period, position_key, put_call_bucket, unit_key, CAST(sum(value_usd) AS BIGINT) AS value,
   CASE WHEN count(shares) = count(*) THEN CAST(sum(shares) AS BIGINT) END AS shares,
   CASE WHEN count(cusip) = count(*) AND min(cusip) = max(cusip) THEN min(cusip) END AS cusip
  FROM dr WHERE position_key IS NOT NULL GROUP BY ALL
)
"""
_Q = _B + """, cal AS (SELECT * FROM (SELECT cik, period, lag(period) OVER (PARTITION BY cik ORDER BY period) AS prev FROM fp) WHERE prev IS NOT NULL),
cu AS (SELECT p.*, cal.prev FROM ps p JOIN cal USING (cik, period)),
pr AS (SELECT p.* REPLACE (cal.period AS period), p.period AS prev FROM ps p JOIN cal ON cal.cik = p.cik AND cal.prev = p.period),
m1 AS (SELECT c, p, false AS rec FROM cu c JOIN pr p ON c.cik = p.cik AND c.period = p.period AND c.position_key = p.position_key AND c.put_call_bucket = p.put_call_bucket AND c.unit_key = p.unit_key),
c2 AS (SELECT * FROM cu ANTI JOIN pr USING (cik, period, position_key, put_call_bucket, unit_key)), p2 AS (SELECT * FROM pr ANTI JOIN cu USING (cik, period, position_key, put_call_bucket, unit_key)),
c2u AS (SELECT * FROM c2 QUALIFY count(*) OVER (PARTITION BY cik, period, position_key, put_call_bucket) = 1), p2u AS (SELECT * FROM p2 QUALIFY count(*) OVER (PARTITION BY cik, period, position_key, put_call_bucket) = 1),
m2 AS (SELECT c, p, false AS rec FROM c2u c JOIN p2u p ON c.cik = p.cik AND c.period = p.period AND c.position_key = p.position_key AND c.put_call_bucket = p.put_call_bucket),
c3 AS (SELECT * FROM c2 ANTI JOIN (SELECT c.cik, c.period, c.position_key, c.put_call_bucket, c.unit_key FROM m2) USING (cik, period, position_key, put_call_bucket, unit_key)),
p3 AS (SELECT * FROM p2 ANTI JOIN (SELECT p.cik, p.period, p.position_key, p.put_call_bucket, p.unit_key FROM m2) USING (cik, period, position_key, put_call_bucket, unit_key)),
c3u AS (SELECT * FROM c3 WHERE cusip IS NOT NULL QUALIFY count(*) OVER (PARTITION BY cik, period, cusip, put_call_bucket) = 1), p3u AS (SELECT * FROM p3 WHERE cusip IS NOT NULL QUALIFY count(*) OVER (PARTITION BY cik, period, cusip, put_call_bucket) = 1),
m3 AS (SELECT c, p, true AS rec FROM c3u c JOIN p3u p ON c.cik = p.cik AND c.period = p.period AND c.cusip = p.cusip AND c.put_call_bucket = p.put_call_bucket WHERE (c.position_key LIKE 'sid:%') <> (p.position_key LIKE 'sid:%')),
c4 AS (SELECT * FROM c3 ANTI JOIN (SELECT c.cik, c.period, c.position_key, c.put_call_bucket, c.unit_key FROM m3) USING (cik, period, position_key, put_call_bucket, unit_key)),
p4 AS (SELECT * FROM p3 ANTI JOIN (SELECT p.cik, p.period, p.position_key, p.put_call_bucket, p.unit_key FROM m3) USING (cik, period, position_key, put_call_bucket, unit_key)),
al AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3 UNION ALL SELECT c4, NULL, false FROM c4 UNION ALL SELECT NULL, p4, false FROM p4),
ca AS (SELECT *, CASE WHEN c IS NULL THEN 0 ELSE c.value END AS cv, CASE WHEN p IS NULL THEN 0 ELSE p.value END AS pv,
  CASE WHEN c IS NOT NULL AND p IS NOT NULL THEN CASE WHEN c.unit_key = p.unit_key THEN c.shares - p.shares END WHEN c IS NOT NULL THEN c.shares ELSE -p.shares END AS ds FROM al),
qd AS (SELECT coalesce(c.cik, p.cik) AS cik, coalesce(c.position_key, p.position_key) AS position_key, coalesce(c.put_call_bucket, p.put_call_bucket) AS put_call_bucket, coalesce(c.unit_key, p.unit_key) AS unit_key,
  coalesce(c.period, p.period) AS period, coalesce(c.prev, p.prev) AS prev_period,
  CASE WHEN p IS NULL THEN 'new' WHEN c IS NULL THEN 'exit' WHEN ds > 0 THEN 'add' WHEN ds < 0 THEN 'trim' WHEN cv - pv >= 0 THEN 'add' WHEN cv - pv < 0 THEN 'trim' ELSE 'unclassified' END AS change_kind,
  pv AS prev_value, cv AS curr_value, cv - pv AS delta_value, p.shares AS prev_shares, c.shares AS curr_shares, ds AS delta_shares,
  '[' || array_to_string(list_sort(list_filter([CASE WHEN rec THEN '"identity_reconciled_by_cusip"' END, CASE WHEN cv IS NULL OR pv IS NULL THEN '"value_undisclosed_one_side"' END,
    CASE WHEN c IS NOT NULL AND p IS NOT NULL AND ds IS NULL THEN '"shares_unit_mismatch"' END,
    CASE WHEN c IS NOT NULL AND p IS NOT NULL AND coalesce(ds, 0) = 0 THEN CASE WHEN cv - pv IS NOT NULL THEN '"classified_by_value"' ELSE '"change_kind_undeterminable"' END END], lambda x: x IS NOT NULL)), ',') || ']' AS flags
 FROM ca)
"""
_I = "CASE WHEN length(cusip) >= 6 THEN 'cusip6:' || cusip[1:6] ELSE 'name:' || upper(trim(regexp_replace(issuer_name, '\\s+', ' ', 'g'))) END AS issuer_key"
_PE = "strftime(last_day(date_trunc('quarter', period_of_report) + INTERVAL 2 MONTH), '%Y-%m-%d') AS period"
_CO = _B + """, k AS (SELECT cik, period, coalesce(position_key, 'row:' || row_id) AS k, put_call_bucket, sum(value_usd) AS v, count(*) AS c, count(*) - count(value_usd) AS u FROM rr GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY cik, period ORDER BY v DESC NULLS LAST, k, put_call_bucket) AS rn FROM k),
g AS (SELECT fp.cik, fp.period, coalesce(sum(c), 0) AS positions, coalesce(sum(u), 0) AS undisclosed, coalesce(sum(v), 0) AS t, sum(v) FILTER (rn <= 10) AS top, max(v) AS most, sum(v * v) AS sq FROM fp LEFT JOIN n USING (cik, period) GROUP BY ALL),
cc AS (SELECT cik, period, positions, undisclosed, CAST(t AS BIGINT) AS total_value, CASE WHEN t > 0 THEN CAST(top * 10000 // t AS BIGINT) END AS topn_bps, CASE WHEN t > 0 THEN CAST(most * 10000 // t AS BIGINT) END AS max_bps,
  CASE WHEN t > 0 THEN CAST(sq * 10000 // (t * t) AS BIGINT) END AS hhi, CASE WHEN t <= 0 THEN 'concentration_unavailable' END AS flag FROM g)
"""

SQL = {
    "restatement_survivors": _B + "SELECT filing_key FROM sv", "reconciled_filings": _B + "SELECT filing_key FROM rc",
    "default_filings": _B + "SELECT filing_key FROM df", "reported_filings": _B + "SELECT filing_key FROM fr",
    "default_marks": _B + "SELECT rr.cik, rr.period, count(*) AS holdings, count(df.filing_key) AS default_holdings FROM rr LEFT JOIN df USING (filing_key) GROUP BY ALL",
    "authoritative_periods": _B + "SELECT * FROM au",
    "amendment_links": _B + """, f AS (SELECT *, coalesce(is_amendment, false) OR upper(regexp_replace(submission_type, '\\s', '', 'g')) LIKE '%/A' AS am FROM inst_filings WHERE filed_date IS NOT NULL)
 SELECT a.filing_id, CASE WHEN count(b.filing_id) = 1 THEN min(b.filing_id) END AS base_filing_id, count(b.filing_id) <> 1 AS amendment_unresolved
 FROM f a LEFT JOIN f b ON b.cik = a.cik AND b.period_of_report = a.period_of_report AND NOT b.am AND b.filed_date <= a.filed_date WHERE a.am GROUP BY a.filing_id""",
    "affiliate_flags": _B + """, e AS (SELECT DISTINCT om.period_of_report, om.cik, s.cik AS covered FROM om JOIN sv s ON s.period_of_report = om.period_of_report AND s.file_number_norm = om.m.file_number_norm WHERE s.cik <> om.cik)
 SELECT e.*, EXISTS (SELECT 1 FROM e b WHERE b.period_of_report = e.period_of_report AND b.cik = e.covered AND b.covered = e.cik) AS mutual FROM e""",
    "affiliate_groups": _B + """, e AS (SELECT DISTINCT om.period_of_report AS p, om.cik AS a, s.cik AS b FROM om JOIN sv s ON s.period_of_report = om.period_of_report AND s.file_number_norm = om.m.file_number_norm WHERE s.cik <> om.cik),
 u AS (SELECT p, a, b FROM e UNION SELECT p, b, a FROM e), w AS (SELECT p, a, a AS b FROM u UNION SELECT w.p, w.a, u.b FROM w JOIN u ON u.p = w.p AND u.a = w.b)
 SELECT p AS period_of_report, a AS node, min(b) AS component FROM w GROUP BY ALL""",
    "position_fold": _B + "SELECT * FROM ps",
    "display_positions": _B + """SELECT cik, period, position_key, put_call_bucket, unit_key, CASE WHEN count(value_usd) = count(*) THEN CAST(sum(value_usd) AS BIGINT) END AS value,
 CASE WHEN count(shares) = count(*) THEN CAST(sum(shares) AS BIGINT) END AS shares, to_json(list_sort(list_distinct(flatten(list(from_json(flags, '["VARCHAR"]'))))))::VARCHAR AS flags, count(*) AS parts
 FROM rr WHERE position_key IS NOT NULL GROUP BY ALL""",
    "qoq_deltas": _Q + "SELECT * FROM qd",
    "biggest_moves": _Q + "SELECT cik, position_key, put_call_bucket, unit_key, period, change_kind, delta_value FROM qd ORDER BY abs(delta_value) DESC NULLS LAST, cik, position_key, put_call_bucket, unit_key, period LIMIT 100",
    "exit_downgrade": _Q + f""", ap AS (SELECT DISTINCT cik, {_PE} FROM au)
 SELECT q.period, CASE WHEN change_kind = 'exit' AND ap.cik IS NULL THEN 'unclassified' ELSE change_kind END AS change_kind, count(*) AS n FROM qd q LEFT JOIN ap ON ap.cik = q.cik AND ap.period = q.period GROUP BY ALL""",
    "issuer_top_holders": _B + f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issuer_key, period ORDER BY value DESC, cik) AS rank FROM (
 SELECT {_I}, period, cik, CAST(sum(value_usd) AS BIGINT) AS value, count(DISTINCT position_key) AS positions FROM dr GROUP BY ALL) WHERE value IS NOT NULL) WHERE rank <= 25""",
    "filer_concentration": _CO + "SELECT * FROM cc",
    "outsized_periods": _CO + """, sq AS (SELECT period, row_number() OVER (ORDER BY period) AS i FROM (SELECT DISTINCT period FROM fp)), ad AS (SELECT cik, period, count(*) FILTER (NOT within OR parse_status = 'failed') = 0 AS admitted FROM cm GROUP BY ALL),
 s AS (SELECT cik, period, CASE WHEN undisclosed = 0 AND admitted THEN max_bps END AS max_bps, i FROM cc JOIN sq USING (period) JOIN ad USING (cik, period)),
 b AS (SELECT *, count(max_bps) OVER w AS k, max(max_bps) OVER w AS mx, lag(i, 4) OVER (PARTITION BY cik ORDER BY i) AS l FROM s WINDOW w AS (PARTITION BY cik ORDER BY i ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
 z AS (SELECT cik, period, max_bps, CASE WHEN k = 4 AND i - l = 4 THEN mx END AS baseline_bps FROM b)
 SELECT *, CASE WHEN baseline_bps IS NULL OR max_bps IS NULL THEN 'awaiting_baseline' WHEN max_bps * 100 > baseline_bps * 150 AND max_bps >= 500 THEN 'outsized' ELSE 'not_outsized' END AS state FROM z""",
    "period_coverage": _B + """, f AS (SELECT period, filing_key, table_value_total_usd AS t FROM sv), g AS (SELECT period, count(*) AS filings, count(*) - count(t) AS unmeasurable,
  CAST(sum(coalesce(s, 0)) AS BIGINT) AS resolved, CAST(sum(greatest(coalesce(t, 0), coalesce(s, 0))) AS BIGINT) AS denominator FROM f LEFT JOIN rs USING (filing_key) GROUP BY ALL)
 SELECT *, round(resolved / nullif(denominator, 0), 6) AS coverage, unmeasurable = 0 AND coalesce(resolved / nullif(denominator, 0) >= 0.95, false) AS certifiable FROM g""",
    "cover_dispositions": _B + """, p AS (SELECT filing_key, CAST(sum(value_usd) AS BIGINT) AS reported, count(*) AS n_rows, count(security_id) AS resolved_rows FROM r GROUP BY ALL)
 SELECT f.filing_key, n_rows, resolved_rows, reported, reported - table_value_total_usd AS delta, CASE WHEN reported - table_value_total_usd IS NULL THEN 'unknown' WHEN reported = table_value_total_usd THEN 'exact'
 WHEN abs(reported - table_value_total_usd) <= greatest(1000, table_value_total_usd // 1000) THEN 'rounding' ELSE 'conflict' END AS disposition FROM inst_filings f JOIN p USING (filing_key)""",
    "filer_registry": _B + """, h AS (SELECT cik, count(*) AS holdings, CAST(coalesce(sum(value_usd), 0) AS BIGINT) AS value, count(*) - count(value_usd) AS undisclosed, count(*) - count(position_key) AS unkeyed FROM rr GROUP BY ALL)
 SELECT f.cik, filings, latest_filed, coalesce(holdings, 0) AS holdings, coalesce(value, 0) AS value, coalesce(undisclosed, 0) AS undisclosed, coalesce(unkeyed, 0) AS unkeyed, latest_period
 FROM (SELECT cik, count(*) AS filings, max(filed_date) AS latest_filed, max(period) AS latest_period FROM fr GROUP BY ALL) f LEFT JOIN h USING (cik)""",
    "effective_filers": _B + "SELECT cik, CAST(sum(table_value_total_usd) AS BIGINT) AS value FROM sv GROUP BY cik HAVING count(*) FILTER (parse_status = 'failed') = 0 AND sum(table_value_total_usd) IS NOT NULL ORDER BY value DESC, cik LIMIT 500",
    "issuer_holder_grain": _B + f""", a AS (SELECT {_I}, period, cik, CASE WHEN count(value_usd) = count(*) THEN CAST(sum(value_usd) AS BIGINT) END AS value, count(*) AS n FROM rr GROUP BY ALL),
 b AS (SELECT {_I}, period, CASE WHEN count(value_usd) = count(*) THEN CAST(sum(value_usd) AS BIGINT) END AS total, true AS has FROM dr GROUP BY ALL)
 SELECT a.*, CASE WHEN has THEN total ELSE 0 END AS dedup_total FROM a LEFT JOIN b USING (issuer_key, period)""",
    "latest_period_rows": _B + "SELECT row_id, cik, period FROM rr QUALIFY period = max(period) OVER (PARTITION BY cik)",
    "period_diff": _B + """, dp AS (SELECT cik, period, position_key, put_call_bucket, unit_key, CASE WHEN count(value_usd) = count(*) THEN CAST(sum(value_usd) AS BIGINT) END AS value,
  CASE WHEN count(shares) = count(*) THEN CAST(sum(shares) AS BIGINT) END AS shares FROM rr WHERE position_key IS NOT NULL GROUP BY ALL),
 k AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY period DESC) AS k FROM fp), c AS (SELECT dp.* FROM dp JOIN k USING (cik, period) WHERE k = 1), p AS (SELECT dp.* FROM dp JOIN k USING (cik, period) WHERE k = 2),
 j AS (SELECT cik, position_key, put_call_bucket, unit_key, c.period AS a, p.period AS b, c.value - p.value AS dv, c.shares - p.shares AS ds FROM c FULL JOIN p USING (cik, position_key, put_call_bucket, unit_key))
 SELECT cik, position_key, put_call_bucket, unit_key, CASE WHEN b IS NULL THEN 'added' WHEN a IS NULL THEN 'removed' WHEN dv > 0 THEN 'increased' WHEN dv < 0 THEN 'decreased' WHEN ds > 0 THEN 'increased' WHEN ds < 0 THEN 'decreased' WHEN dv = 0 THEN 'unchanged' ELSE 'unclassified' END AS kind,
  dv AS delta_value, ds AS delta_shares FROM j""",
    "composition_latest": _B + "SELECT cik, period, arg_max(filing_key, (filed_date, accession)) AS latest_filing, max(filed_date) AS filed, count(*) AS filings FROM fr WHERE filed_date IS NOT NULL GROUP BY ALL",
    "reporting_lag": """SELECT filing_key, year(period_of_report) || 'q' || quarter(period_of_report) AS quarter, date_diff('day', qe, filed_date) AS lag_days, filed_date > qe + 45 AS late
 FROM (SELECT *, last_day(date_trunc('quarter', period_of_report) + INTERVAL 2 MONTH) AS qe FROM inst_filings)""",
    "universal_flags": _B + """, x AS (SELECT cik, period, unnest(list_distinct(from_json(flags, '["VARCHAR"]'))) AS flag FROM rr), n AS (SELECT cik, period, count(*) AS rows FROM rr GROUP BY ALL)
 SELECT x.cik, x.period, flag, count(*) AS carried, n.rows, count(*) = n.rows AS universal FROM x JOIN n ON n.cik = x.cik AND n.period = x.period GROUP BY x.cik, x.period, flag, n.rows""",
}
