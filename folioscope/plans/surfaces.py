"""Smaller questions of the surfaces: feeds, reconciliation, provenance, registry figures."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import normalize as N, text as X
from ..operators import populations as P, positions as Q, ranges as R
from ..sources import table
from . import congress as C, institutions as I

#: Filers with a page of their own.
FILER_PAGES = 1_500


def q_feed_counts(spark, d):
    """A filtered feed: shown, indeterminate by amount, and all, per side and owner group."""
    t = C.trades(spark, d)
    passes = F.coalesce(F.col("owner"), F.lit("none")).isin("none", "self", "spouse") & (F.lower(F.coalesce("member", "filer_name_raw")).contains("a") | F.coalesce(F.col("ticker").startswith("A"), F.lit(False)))
    v = R.verdict(F.col("amount_low"), F.col("amount_high"), 15_000)
    return t.groupBy("side", F.coalesce("owner", F.lit("none")).alias("owner_group")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(passes & (v == "in")).alias("shown"), F.count_if(passes & (v == "indeterminate")).alias("indeterminate")
    )


def watched(t, paper, members, tickers, last_seen):
    """(kind, entity, latest, new, coverage): what is new since a day for the watched
    members and tickers, each one's latest filing, and whether what is retained, trades
    and paper filings, reaches back to that day (else gap).  ``members`` has bioguide_id,
    ``tickers`` ticker; None watches all."""
    since = t.select("filed_date").unionByName(paper.select("filed_date")).agg(F.min("filed_date").alias("m")).scalar()
    def by(c, who):
        rows = t.filter(F.col(c).isNotNull()) if who is None else t.join(who.select(c).distinct(), c, "left_semi")
        return rows.groupBy(F.lit(c).alias("kind"), F.col(c).alias("entity")).agg(F.max("filed_date").alias("latest"), F.count_if(F.col("filed_date") > last_seen).alias("new"))
    out = by("bioguide_id", members).unionByName(by("ticker", tickers))
    day = F.lit(last_seen).cast("date")
    return out.withColumn("coverage", F.when(day.isNull(), "none").when(day < since, "gap").otherwise("current"))


def q_watch(spark, d):
    """The members of one state, and the tickers they traded, since a day."""
    t = C.trades(spark, d)
    m = table(spark, d, "members").filter(F.col("state") == "CA")
    paper = P.once(table(spark, d, "filings"), "filing_id").filter((F.col("lifecycle") == "active") & (F.col("parse_status") == "needs_ocr"))
    k = t.join(m.select("bioguide_id"), "bioguide_id", "left_semi").filter(F.col("ticker").isNotNull())
    return watched(t, paper, m, k.select("ticker"), "2022-06-30")


def q_watch_all(spark, d):
    """The same of every member and every ticker, since a day before anything retained."""
    t = C.trades(spark, d)
    paper = P.once(table(spark, d, "filings"), "filing_id").filter((F.col("lifecycle") == "active") & (F.col("parse_status") == "needs_ocr"))
    return watched(t, paper, None, None, "2010-06-30")


def q_crosswalk(spark, d):
    """Seed filings retired for a parsed primary one."""
    f = P.once(table(spark, d, "filings"), "filing_id")
    p = f.filter(F.col("parse_status") == "parsed").select(F.col("filing_id").alias("p_id"), F.col("chamber").alias("p_chamber"))
    j = f.filter(F.col("primary_filing_id").isNotNull()).join(p, (F.col("primary_filing_id") == F.col("p_id")) & (F.col("chamber") == F.col("p_chamber")), "left")
    return j.select("filing_id", F.when(F.col("p_id").isNotNull(), "retired").otherwise(F.col("lifecycle")).alias("lifecycle"))


def q_reconcile(spark, d):
    """Filings by how the trades found agree with the count declared."""
    f = P.once(table(spark, d, "filings"), "filing_id")
    n = P.once(table(spark, d, "transactions"), "txn_id").groupBy("filing_id").agg(F.count(F.lit(1)).alias("found"))
    j = f.join(n, "filing_id", "left")
    state = F.when(F.col("row_count").isNull(), F.when(F.col("found").isNull(), "nothing_declared").otherwise("undeclared")).when(F.coalesce("found", F.lit(0)) == F.col("row_count"), "agrees").otherwise("differs")
    return j.groupBy("chamber", "parse_status", state.alias("state")).agg(F.count(F.lit(1)).alias("filings"))


def q_floor(spark, d):
    """Identities of a baseline that the corpus must still hold, per source and chamber."""
    f = P.once(table(spark, d, "filings"), "filing_id")
    base, now = f.filter(F.col("ingested_at") < F.lit("2022-01-01").cast("timestamp_ntz")), f.filter(F.col("lifecycle") == "active")
    lost = base.join(now.select("filing_id"), "filing_id", "left_anti").groupBy("source", "chamber").agg(F.count(F.lit(1)).alias("lost"))
    return base.groupBy("source", "chamber").agg(F.count(F.lit(1)).alias("baseline")).join(lost, ["source", "chamber"], "left").select("source", "chamber", "baseline", F.coalesce("lost", F.lit(0)).alias("lost"))


def q_reparse(spark, d):
    """Filings to parse again since a day, split by whether they were archived."""
    f = P.once(table(spark, d, "filings"), "filing_id").filter((F.col("filed_date") >= "2018-01-01") & F.col("parse_status").isin("failed", "needs_ocr"))
    return f.groupBy("chamber", F.col("doc_url").isNotNull().alias("archived")).agg(F.count(F.lit(1)).alias("n"))


def q_severity(spark, d):
    """Eras that miss the gate, worst first: share without a measure, shortfall, size."""
    g = C.q_parse_gate(spark, d).filter(F.col("status") != "pass")
    return g.select("chamber", "year", "filings", F.col("paper").alias("unmeasurable"), (F.col("filings") - F.col("paper") - F.col("parsed")).alias("shortfall")).orderBy(F.desc(F.col("unmeasurable") / F.col("filings")), F.desc("shortfall"), F.desc("filings"), "chamber", "year")


def q_pair_flags(spark, d):
    """Filings on either side of an amendment flagged unresolved."""
    p = C.q_pairs(spark, d)
    return p.select(F.col("amendment_filing_id").alias("filing_id")).union(p.select("original_filing_id")).distinct()


def q_composition(spark, d):
    """What a filer's period is composed of, and why it may be incomplete."""
    f = I.composed(spark, d).filter("within")
    am = P.is_amendment()
    full = ~am | F.coalesce(F.col("amendment_type") == "RESTATEMENT", F.lit(False))
    additive = am & F.coalesce(F.col("amendment_type") == "NEW_HOLDINGS", F.lit(False))
    g = f.groupBy("cik", "period").agg(F.count_if(full).alias("full_reports"), F.count_if(additive).alias("additive"), F.count_if(~full & ~additive).alias("unknown"), F.count_if(F.col("parse_status") != "parsed").alias("unparsed"))
    why = F.array_compact(F.array(F.when(F.col("full_reports") == 0, "no_full_report"), F.when(F.col("full_reports") > 1, "several_full_reports"), F.when(F.col("unknown") > 0, "unknown_amendment"), F.when(F.col("unparsed") > 0, "unparsed_member")))
    return g.withColumn("reasons", F.to_json(why))


def q_provenance(spark, d):
    """Accessions of a composition in order, the latest date and its lag."""
    f = I.composed(spark, d).filter("within")
    g = f.groupBy("cik", "period").agg(
        F.array_join(F.array_sort(F.collect_list("accession")), ",").alias("accessions"), F.max("filed_date").alias("latest"), (F.count("filed_date") == F.count(F.lit(1))).alias("known")
    )
    return g.withColumn("lag_days", F.datediff("latest", F.col("period").cast("date")))


def q_disclosed_totals(spark, d):
    """Disclosed value and undisclosed rows, resolved and not, per filer and period."""
    res = F.col("security_id").isNotNull()
    return I.reported_rows(spark, d).groupBy("cik", "period").agg(
        Q.exact_sum("value_usd").alias("disclosed"), F.count_if(F.col("value_usd").isNull()).alias("undisclosed_rows"),
        F.sum(F.when(res, F.col("value_usd").cast("decimal(38,0)"))).cast("long").alias("resolved"), F.count_if(res).alias("resolved_rows"),
    )


def q_keying(spark, d):
    """How issuers are keyed: by CUSIP block or by name."""
    k = F.substring_index(I.issuer(), ":", 1)
    return I.reported_rows(spark, d).groupBy("period", k.alias("keyed_by")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("cik").alias("filers"))


def q_display_names(spark, d):
    """A position's issuer name in its period, else in the period before."""
    f = I.books(spark, d)
    r = I.reported_rows(spark, d, f).filter(F.col("position_key").isNotNull())
    n = r.groupBy("cik", "period", "position_key").agg(F.min("issuer_name").alias("name"))
    deltas = I.deltas(spark, d, f).select("cik", "period", "prev_period", "position_key")
    a = deltas.join(n, ["cik", "period", "position_key"], "left")
    b = n.select("cik", F.col("period").alias("prev_period"), "position_key", F.col("name").alias("old_name"))
    return a.join(b, ["cik", "prev_period", "position_key"], "left").select("cik", "period", "position_key", F.coalesce("name", "old_name").alias("name")).distinct()


def q_tiers(spark, d, most=FILER_PAGES):
    """Filers by the value of their latest period: the top tier and the rest."""
    v = Q.latest(I.reported_rows(spark, d, I.books(spark, d)), "cik").groupBy("cik").agg(Q.exact_sum("value_usd").alias("value"))
    # a top-k, not a global ranking; its size is the parameter
    top = v.orderBy(F.col("value").desc_nulls_last(), "cik").limit(most).select("cik", F.lit(True).alias("top"))
    return v.join(F.broadcast(top), "cik", "left").select("cik", "value", F.when(F.col("top"), "top").otherwise("tail").alias("tier"))


def q_comparable(spark, d):
    """The concentration index, withheld where a position's value is unknown."""
    return I.q_concentration(spark, d).select("cik", "period", F.when(F.col("undisclosed") == 0, F.col("hhi")).alias("hhi"), (F.col("undisclosed") > 0).alias("withheld"))


def q_routing(spark, d):
    """Filer periods by whether they lie in the two newest published periods."""
    g = I.reported_rows(spark, d).groupBy("period").agg(F.countDistinct("cik").alias("filers"))  # a row a period
    k = F.row_number().over(W.orderBy(F.desc("period")))
    return g.withColumn("k", k).select("period", "filers", F.when(F.col("k") <= 2, "published").otherwise("off_universe").alias("route"))


def q_grid(spark, d):
    """Every chamber, year band and asset class, also those without any trade."""
    t = P.once(table(spark, d, "transactions"), "txn_id")
    y = F.year("filed_date")
    band = F.when(y < 2016, "2012-2015").when(y < 2020, "2016-2019").when(y < 2024, "2020-2023").otherwise("2024+")
    cls = F.when(F.col("asset_type").isin("ST", "OP"), "equity").otherwise("other")
    got = t.groupBy("chamber", band.alias("band"), cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.createDataFrame([(a, b, c) for a in ("house", "senate") for b in ("2012-2015", "2016-2019", "2020-2023", "2024+") for c in ("equity", "other")], "chamber string, band string, class string")
    return grid.join(got, ["chamber", "band", "class"], "left").select("chamber", "band", "class", F.coalesce("n", F.lit(0)).alias("n"))


def q_sizes(spark, d):
    """Median, 90th percentile and greatest bytes of the documents of a source."""
    b = table(spark, d, "documents").select("source", F.octet_length("text").alias("b"))
    return b.groupBy("source").agg(F.percentile("b", 0.5).alias("median"), F.percentile("b", 0.9).alias("p90"), F.max("b").alias("most"))


def q_rates(spark, d):
    t = C.trades(spark, d)
    g = t.groupBy("bioguide_id").agg(F.count_if("is_late").alias("late"), F.count("is_late").alias("datable"), F.count_if(F.col("amount_low").isNull() & F.col("amount_high").isNull()).alias("undisclosed"), F.count(F.lit(1)).alias("n"))
    return g.select("bioguide_id", X.cut_percent(F.col("late"), F.col("datable")).alias("late_percent"), X.cut_percent(F.col("undisclosed"), F.col("n")).alias("undisclosed_percent"))


def q_defects(spark, d):
    """Trades with a defect of parsing, and with the flags their amounts imply."""
    t = P.once(table(spark, d, "transactions"), "txn_id")
    unread = F.col("amount_low").isNull() & F.col("amount_high").isNull()
    f = F.array_sort(F.array_union(F.coalesce("flags", F.array().cast("array<string>")), F.when(unread, F.array(F.lit("amount_unparsed"))).otherwise(F.array().cast("array<string>"))))
    return t.select("txn_id", F.coalesce(N.has_parse_defect(f), F.lit(False)).alias("defect"), F.array_join(f, ",").alias("effective"))


def q_notable(spark, d):
    """The largest lower bounds of each week of filing; anomalies and unknown amounts apart."""
    t = C.trades(spark, d)
    state = F.when(F.col("filed_date") < F.col("transaction_date"), "anomaly").when(F.col("amount_low").isNull(), "unrankable").otherwise("ranked")
    w = W.partitionBy("week", "standing").orderBy(F.col("amount_low").desc_nulls_last(), "txn_id")
    return t.withColumn("week", F.trunc("filed_date", "week")).withColumn("standing", state).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 3).select("week", "standing", "rank", "txn_id")


QUERIES = {
    "feed_counts": q_feed_counts, "watchlist": q_watch, "watch_all": q_watch_all, "crosswalk": q_crosswalk, "index_reconciliation": q_reconcile, "corpus_floor": q_floor, "reparse_targets": q_reparse,
    "gate_severity": q_severity, "pair_flags": q_pair_flags, "composition": q_composition, "provenance": q_provenance, "disclosed_totals": q_disclosed_totals,
    "issuer_keying": q_keying, "display_names": q_display_names, "filer_tiers": q_tiers, "comparable_hhi": q_comparable, "published_routing": q_routing,
    "stratum_grid": q_grid, "document_sizes": q_sizes, "member_rates": q_rates, "effective_flags": q_defects, "notable_trades": q_notable,
}

_B, _Q, _CO, _T, _PE, _I = I._B, I._Q, I._CO, C._T, I._PE, I._I
_PCT = "CASE WHEN {w} <= 0 THEN NULL WHEN {p} = {w} THEN 100.0 ELSE least(floor({p} * 1000 / {w}) / 10, 99.9) END"

_WATCH = ", mn AS (SELECT min(filed_date) AS since FROM (SELECT filed_date FROM tr UNION ALL SELECT filed_date FROM ac WHERE parse_status = 'needs_ocr'))"
_SEEN = "max(filed_date) AS latest, count(*) FILTER (filed_date > DATE '{day}') AS new, CASE WHEN DATE '{day}' < any_value(since) THEN 'gap' ELSE 'current' END AS coverage"

SQL = {
    "feed_counts": _T + """, k AS (SELECT *, coalesce(owner, 'none') AS owner_group, coalesce(owner, 'none') IN ('none', 'self', 'spouse') AND (contains(lower(coalesce(member, filer_name_raw)), 'a') OR coalesce(ticker LIKE 'A%', false)) AS ok FROM tr)
 SELECT side, owner_group, count(*) AS total, count(*) FILTER (ok AND coalesce(amount_low > 15000, false)) AS shown, count(*) FILTER (ok AND NOT coalesce(amount_low > 15000, false) AND NOT coalesce(amount_high <= 15000, false)) AS indeterminate FROM k GROUP BY ALL""",
    "watchlist": _T + f"""{_WATCH}, ca AS (SELECT bioguide_id FROM members WHERE state = 'CA'), k AS (SELECT DISTINCT ticker FROM tr SEMI JOIN ca USING (bioguide_id) WHERE ticker IS NOT NULL)
 SELECT 'bioguide_id' AS kind, bioguide_id AS entity, {_SEEN.replace('{day}', '2022-06-30')} FROM tr, mn WHERE bioguide_id IN (FROM ca) GROUP BY ALL
 UNION ALL SELECT 'ticker', ticker, {_SEEN.replace('{day}', '2022-06-30')} FROM tr, mn WHERE ticker IN (FROM k) GROUP BY ALL""",
    "watch_all": _T + f"""{_WATCH} SELECT 'bioguide_id' AS kind, bioguide_id AS entity, {_SEEN.replace('{day}', '2010-06-30')} FROM tr, mn WHERE bioguide_id IS NOT NULL GROUP BY ALL
 UNION ALL SELECT 'ticker', ticker, {_SEEN.replace('{day}', '2010-06-30')} FROM tr, mn WHERE ticker IS NOT NULL GROUP BY ALL""",
    "crosswalk": _T + "SELECT f.filing_id, CASE WHEN p.filing_id IS NOT NULL THEN 'retired' ELSE f.lifecycle END AS lifecycle FROM fl f LEFT JOIN fl p ON p.filing_id = f.primary_filing_id AND p.chamber = f.chamber AND p.parse_status = 'parsed' WHERE f.primary_filing_id IS NOT NULL",
    "index_reconciliation": _T + """SELECT chamber, parse_status, CASE WHEN row_count IS NULL THEN CASE WHEN found IS NULL THEN 'nothing_declared' ELSE 'undeclared' END WHEN coalesce(found, 0) = row_count THEN 'agrees' ELSE 'differs' END AS state, count(*) AS filings
 FROM fl LEFT JOIN (SELECT filing_id, count(*) AS found FROM tx GROUP BY ALL) USING (filing_id) GROUP BY ALL""",
    "corpus_floor": _T + "SELECT source, chamber, count(*) AS baseline, count(*) FILTER (lifecycle <> 'active') AS lost FROM fl WHERE ingested_at < TIMESTAMP '2022-01-01' GROUP BY ALL",
    "reparse_targets": _T + "SELECT chamber, doc_url IS NOT NULL AS archived, count(*) AS n FROM fl WHERE filed_date >= DATE '2018-01-01' AND parse_status IN ('failed', 'needs_ocr') GROUP BY ALL",
    "gate_severity": _T + """SELECT chamber, year, filings, paper AS unmeasurable, filings - paper - parsed AS shortfall FROM (SELECT chamber, year(filed_date) AS year, count(*) AS filings, count(*) FILTER (parse_status = 'parsed') AS parsed,
 count(*) FILTER (parse_status = 'needs_ocr') AS paper FROM ac GROUP BY ALL) WHERE filings = paper OR parsed * 100 < (filings - paper) * 97""",
    "pair_flags": _T + "SELECT a.filing_id FROM fl a JOIN fl o ON o.filing_id = a.supersedes UNION SELECT o.filing_id FROM fl a JOIN fl o ON o.filing_id = a.supersedes",
    "composition": _B + f""", f AS (SELECT cik, period, parse_status, coalesce(is_amendment, false) OR upper(regexp_replace(submission_type, '\\s', '', 'g')) LIKE '%/A' AS am, amendment_type AS t FROM fr),
 g AS (SELECT cik, period, count(*) FILTER (NOT am OR coalesce(t = 'RESTATEMENT', false)) AS full_reports, count(*) FILTER (am AND coalesce(t = 'NEW_HOLDINGS', false)) AS additive,
  count(*) FILTER (am AND NOT coalesce(t IN ('RESTATEMENT', 'NEW_HOLDINGS'), false)) AS unknown, count(*) FILTER (parse_status <> 'parsed') AS unparsed FROM f GROUP BY ALL)
 SELECT *, '[' || array_to_string(list_filter([CASE WHEN full_reports = 0 THEN '"no_full_report"' END, CASE WHEN full_reports > 1 THEN '"several_full_reports"' END, CASE WHEN unknown > 0 THEN '"unknown_amendment"' END, CASE WHEN unparsed > 0 THEN '"unparsed_member"' END], lambda x: x IS NOT NULL), ',') || ']' AS reasons FROM g""",
    "provenance": _B + f"SELECT *, date_diff('day', CAST(period AS DATE), latest) AS lag_days FROM (SELECT cik, period, string_agg(accession, ',' ORDER BY accession) AS accessions, max(filed_date) AS latest, count(filed_date) = count(*) AS known FROM fr GROUP BY cik, period)",
    "disclosed_totals": _B + "SELECT cik, period, CAST(sum(value_usd) AS BIGINT) AS disclosed, count(*) - count(value_usd) AS undisclosed_rows, CAST(sum(value_usd) FILTER (security_id IS NOT NULL) AS BIGINT) AS resolved, count(security_id) AS resolved_rows FROM rr GROUP BY ALL",
    "issuer_keying": _B + "SELECT period, CASE WHEN length(cusip) >= 6 THEN 'cusip6' ELSE 'name' END AS keyed_by, count(*) AS n, count(DISTINCT cik) AS filers FROM rr GROUP BY ALL",
    "display_names": _Q + """, n AS (SELECT cik, period, position_key, min(issuer_name) AS name FROM rr WHERE position_key IS NOT NULL GROUP BY ALL)
 SELECT DISTINCT q.cik, q.period, q.position_key, coalesce(a.name, b.name) AS name FROM qd q LEFT JOIN n a ON a.cik = q.cik AND a.period = q.period AND a.position_key = q.position_key LEFT JOIN n b ON b.cik = q.cik AND b.period = q.prev_period AND b.position_key = q.position_key""",
    "filer_tiers": _B + """, l AS (SELECT * FROM rr QUALIFY period = max(period) OVER (PARTITION BY cik)), v AS (SELECT cik, CAST(sum(value_usd) AS BIGINT) AS value FROM l GROUP BY cik)
 SELECT cik, value, CASE WHEN row_number() OVER (ORDER BY value DESC NULLS LAST, cik) <= 1500 THEN 'top' ELSE 'tail' END AS tier FROM v""",
    "comparable_hhi": _CO + "SELECT cik, period, CASE WHEN undisclosed = 0 THEN hhi END AS hhi, undisclosed > 0 AS withheld FROM cc",
    "published_routing": _B + "SELECT period, count(DISTINCT cik) AS filers, CASE WHEN period IN (SELECT DISTINCT period FROM rr ORDER BY period DESC LIMIT 2) THEN 'published' ELSE 'off_universe' END AS route FROM rr GROUP BY period",
    "stratum_grid": _T + """, g AS (SELECT * FROM (SELECT unnest(['house', 'senate']) AS chamber), (SELECT unnest(['2012-2015', '2016-2019', '2020-2023', '2024+']) AS band), (SELECT unnest(['equity', 'other']) AS class)),
 x AS (SELECT chamber, CASE WHEN year(filed_date) < 2016 THEN '2012-2015' WHEN year(filed_date) < 2020 THEN '2016-2019' WHEN year(filed_date) < 2024 THEN '2020-2023' ELSE '2024+' END AS band, CASE WHEN asset_type IN ('ST', 'OP') THEN 'equity' ELSE 'other' END AS class FROM tx)
 SELECT g.chamber, g.band, g.class, count(x.chamber) AS n FROM g LEFT JOIN x ON x.chamber = g.chamber AND x.band = g.band AND x.class = g.class GROUP BY ALL""",
    "document_sizes": "SELECT source, quantile_cont(strlen(text), 0.5) AS median, quantile_cont(strlen(text), 0.9) AS p90, max(strlen(text)) AS most FROM documents GROUP BY source",
    "member_rates": _T + f""", g AS (SELECT bioguide_id, count(*) FILTER (is_late) AS late, count(is_late) AS datable, count(*) FILTER (amount_low IS NULL AND amount_high IS NULL) AS u, count(*) AS n FROM tr GROUP BY ALL)
 SELECT bioguide_id, {_PCT.replace('{p}', 'late').replace('{w}', 'datable')} AS late_percent, {_PCT.replace('{p}', 'u').replace('{w}', 'n')} AS undisclosed_percent FROM g""",
    "effective_flags": _T + """, f AS (SELECT txn_id, list_sort(list_distinct(list_concat(coalesce(flags, []), CASE WHEN amount_low IS NULL AND amount_high IS NULL THEN ['amount_unparsed'] ELSE [] END))) AS e FROM tx)
 SELECT txn_id, list_has_any(e, ['amount_unparsed', 'asset_unparsed', 'owner_unparsed', 'row_incomplete', 'side_unparsed']) AS defect, coalesce(array_to_string(e, ','), '') AS effective FROM f""",
    "notable_trades": _T + """, k AS (SELECT *, CAST(date_trunc('week', filed_date) AS DATE) AS week, CASE WHEN filed_date < transaction_date THEN 'anomaly' WHEN amount_low IS NULL THEN 'unrankable' ELSE 'ranked' END AS standing FROM tr)
 SELECT week, standing, rank, txn_id FROM (SELECT *, row_number() OVER (PARTITION BY week, standing ORDER BY amount_low DESC NULLS LAST, txn_id) AS rank FROM k) WHERE rank <= 3""",
}
