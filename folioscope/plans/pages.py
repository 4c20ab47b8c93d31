"""Questions of pages and lists: filtered feeds, orders, coverage, sectors, payloads, audits."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import normalize as N
from ..operators import committees as K, feed as E, packing as B, populations as P, positions as Q, signals as S
from ..sources import table
from . import congress as C, institutions as I, surfaces as U

FILTER = E.FeedFilter(chamber="house", side="buy", owner="none", text="a", since="2018-01-01", until="2022-12-31", basis="traded", at_least=15_000)
PAPER_FILTER = E.FeedFilter(chamber="senate", text="e", since="2014-01-01")


def named(t):
    return t.withColumn("name", F.coalesce("member", "filer_name_raw"))


def paper(spark, d):
    m = table(spark, d, "members").select("bioguide_id", F.col("full_name").alias("member"), "party")
    f = P.once(table(spark, d, "filings"), "filing_id").filter((F.col("lifecycle") == "active") & (F.col("parse_status") == "needs_ocr"))
    return named(f.join(m, "bioguide_id", "left"))


def q_feed_filter(spark, d):
    t, p = named(C.trades(spark, d)), paper(spark, d)
    a, b = (E.feed_counts(t, p, f).withColumn("filter", F.lit(n)) for n, f in (("trading", FILTER), ("paper", PAPER_FILTER)))
    return a.unionByName(b)


def q_amount_order(spark, d):
    """The 200 trades that head the feed by amount, and 200 from its other end."""
    t = C.trades(spark, d)
    def end(name, down):
        return t.orderBy(*E.by_amount(down)).limit(200).select(F.lit(name).alias("end"), "txn_id", E.amount_key().alias("key"))
    return end("top", True).unionByName(end("bottom", False))


def q_page_budget(spark, d):
    """Entities that get a page: members cost 1, tickers 2, of 300."""
    t = C.trades(spark, d)
    by = lambda c, cost: t.filter(F.col(c).isNotNull()).groupBy(F.lit(c).alias("kind"), F.col(c).alias("entity")).agg(F.count(F.lit(1)).alias("rows")).withColumn("cost", F.lit(cost))
    return E.within_budget(by("bioguide_id", 1).unionByName(by("ticker", 2)), "rows", "cost", ["kind", "entity"], 300)


def activity(spark, d):
    f = I.books(spark, d)
    a = f.filter("within")
    ok = P.authoritative_periods(a).join(a.select("cik", "period_of_report", "period").distinct(), ["cik", "period_of_report"]).select("cik", "period")
    return Q.downgrade_exits(I.deltas(spark, d, f), ok)


def q_activity(spark, d):
    """The largest changes of all filers, with what the filer holds by the registry."""
    top = activity(spark, d).orderBy(*E.activity_order()).limit(200)
    r = I.q_registry(spark, d).select("cik", F.col("value").alias("filer_value"))
    return top.join(r, "cik", "left").select("cik", "period", "position_key", "put_call_bucket", "unit_key", "change_kind", "delta_value", "filer_value")


def q_page_changes(spark, d):
    """Every filer's changes in the order of its page, within the rows of an embed, with the
    number there are in all."""
    w = W.partitionBy("cik", "period").orderBy(*E.page_order())
    x = I.deltas(spark, d).withColumn("place", F.row_number().over(w)).withColumn("total", F.count(F.lit(1)).over(W.partitionBy("cik", "period")))
    return x.filter(F.col("place") <= 20_000).select("cik", "period", "place", "position_key", "put_call_bucket", "unit_key", "total")


def q_filer_index(spark, d):
    """Filers found by name or number, by concentration of their latest period, those
    without a comparable index last."""
    r = I.q_registry(spark, d)
    r = r.filter(F.regexp_replace("cik", "^0+", "").startswith("70010") | F.lower("cik").contains("x"))
    c = I.q_concentration(spark, d).withColumnRenamed("period", "latest_period")
    c = c.select("cik", "latest_period", "total_value", "positions", F.when(F.col("undisclosed") == 0, F.col("hhi")).alias("hhi"))
    t = U.q_tiers(spark, d).select("cik", "tier")
    return r.select("cik", "latest_period").join(c, ["cik", "latest_period"], "left").join(t, "cik", "left").withColumn("tier", F.coalesce("tier", F.lit("tail"))).orderBy(*E.ranked_last("hhi", ["cik"]))


def securities(rows):
    """(security_id, entity_id, entity_link_state): the CUSIP block a security was reported
    under stands for its issuer; several are a conflict."""
    g = rows.filter(F.col("security_id").isNotNull()).groupBy("security_id").agg(F.countDistinct(F.substring("cusip", 1, 6)).alias("n"), F.min(F.substring("cusip", 1, 6)).alias("e"))
    state = F.when(F.col("n") == 1, "resolved").when(F.col("n") == 0, "unresolved").otherwise("conflict")
    return g.select("security_id", F.when(F.col("n") == 1, F.col("e")).alias("entity_id"), state.alias("entity_link_state"))


def linked(rows, secs):
    """Holdings with their security's entity and the issuer key that follows from it."""
    j = rows.join(secs, "security_id", "left")
    return j.withColumn("issuer_key", N.issuer_key(F.col("cusip"), F.col("issuer_name"), F.col("entity_id"))).withColumn("issuer_key_source", F.substring_index("issuer_key", ":", 1))


def holdings(spark, d):
    return linked(I.reported_rows(spark, d), securities(I.rows(spark, d)))


def q_issuer_links(spark, d):
    return holdings(spark, d).groupBy("period", "issuer_key_source", F.coalesce("entity_link_state", F.lit("none")).alias("link")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("issuer_key").alias("issuers"))


def q_holder_coverage(spark, d):
    g = holdings(spark, d).groupBy("issuer_key", "period", "cik").agg(F.when(F.count("value_usd") == F.count(F.lit(1)), Q.exact_sum("value_usd")).alias("value"))
    return E.holder_coverage(g)


def tickers(spark, d):
    """A ticker snapshot: the tables have none, so the first four signs of a CUSIP serve."""
    return I.rows(spark, d).filter(F.col("cusip").isNotNull()).select(F.substring("cusip", 1, 4).alias("ticker"), F.substring("cusip", 1, 6).alias("entity_id")).distinct()


def ticker_holders(rows, mapping):
    """(ticker, outcome, issuers, holders, value): holders of the one issuer a ticker means;
    a ticker of several issuers is refused, and only issuers keyed by entity are looked at."""
    one = mapping.groupBy("ticker").agg(F.countDistinct("entity_id").alias("issuers"), F.min("entity_id").alias("e"))
    h = rows.filter(F.col("issuer_key_source") == "entity").groupBy(F.col("entity_id").alias("e")).agg(F.countDistinct("cik").alias("holders"), Q.exact_sum("value_usd").alias("value"))
    j = one.join(h, "e", "left")
    outcome = F.when(F.col("issuers") > 1, "ambiguous").when(F.col("holders").isNull(), "no_holders").otherwise("found")
    keep = lambda c: F.when(outcome == "found", F.col(c)).alias(c)
    return j.select("ticker", outcome.alias("outcome"), "issuers", keep("holders"), keep("value"))


def q_ticker_holders(spark, d):
    return ticker_holders(holdings(spark, d), tickers(spark, d))


def seats(spark, d):
    """Committee seats: a member's terms, the state standing for the committee."""
    t = table(spark, d, "members").select("bioguide_id", F.explode("terms").alias("t"))
    return t.select(F.col("t.state").alias("committee_id"), "bioguide_id", F.col("t.start").alias("valid_from"), F.col("t.end").alias("valid_to")).distinct()


def remits(spark, d):
    """Which sector a committee oversees: by its first letter."""
    c = seats(spark, d).select("committee_id").distinct()
    names = F.array(*[F.lit(n) for *_, n in K.SECTORS])
    return c.select("committee_id", F.get(names, F.ascii("committee_id") % len(K.SECTORS)).alias("sector"))


def overseen(spark, d):
    """Trades with the seats held on the day, the issuer's sector and whether they meet.
    Tickers beginning with A have no issuer, those ending in Z no classification."""
    t = C.trades(spark, d)
    t = K.membership_as_of(t, "bioguide_id", "filed_date", seats(spark, d))
    k = t.filter(F.col("ticker").isNotNull() & ~F.col("ticker").startswith("A")).select("ticker").distinct().withColumn("cik", F.col("ticker"))
    sic = 100 + (F.ascii("cik") * 997 + F.ascii(F.substring("cik", 2, 1)) * 131) % 9600
    s = k.filter(~F.col("ticker").endswith("Z")).select("cik", sic.alias("sic"))
    return K.jurisdiction_overlap(K.issuer_sector(t, k, s), remits(spark, d))


def q_jurisdiction(spark, d):
    return overseen(spark, d).groupBy("chamber", "jurisdiction").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bioguide_id").alias("members"))


def q_sector_mix(spark, d):
    """Trades per sector, real ones first, then what kept a sector from being found."""
    real = ~F.coalesce(F.col("sector").startswith("no_"), F.lit(True))
    g = overseen(spark, d).groupBy("sector").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bioguide_id").alias("members"))
    return g.withColumn("bucket", F.when(real, 0).otherwise(1)).orderBy("bucket", F.desc("n"), "sector")


def q_jurisdiction_signals(spark, d):
    return S.jurisdiction(overseen(spark, d)).select("kind", "bioguide_id", "ticker", "dedupe_key")


def q_stats_inventory(spark, d):
    f = P.once(table(spark, d, "filings"), "filing_id")
    return f.groupBy("source", "chamber", "parse_status", "lifecycle").agg(
        F.count(F.lit(1)).alias("filings"), F.count("bioguide_id").alias("joined"), F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("declared_rows"), F.min("filed_date").alias("first"), F.max("filed_date").alias("last"),
    )


def q_filing_reconciliation(spark, d):
    """Per filing the sum of its rows against its cover, and what of it is resolved."""
    v = F.col("value_usd").cast(Q.WIDE)
    g = I.rows(spark, d).groupBy("filing_key").agg(F.sum(v).cast("long").alias("value"), F.count(F.lit(1)).alias("entries"), F.count("security_id").alias("resolved_entries"), F.sum(F.when(F.col("security_id").isNotNull(), v)).cast("long").alias("resolved_value"))
    f = table(spark, d, "inst_filings").select("filing_key", "table_value_total_usd")
    return f.join(g, "filing_key", "left").select("filing_key", F.coalesce("entries", F.lit(0)).alias("entries"), F.coalesce("resolved_entries", F.lit(0)).alias("resolved_entries"), "value", "resolved_value", (F.col("value") - F.col("table_value_total_usd")).alias("delta"))


def q_period_universe(spark, d):
    """What a filer's changes can be about: positions, unkeyed rows, undisclosed ones."""
    f = I.books(spark, d)
    g = I.reported_rows(spark, d, f).groupBy("cik", "period").agg(
        F.count(F.lit(1)).alias("holdings"), F.coalesce(Q.exact_sum("value_usd"), F.lit(0)).alias("value"), F.count_if(F.col("value_usd").isNull()).alias("undisclosed"),
        F.count_if(F.col("position_key").isNull()).alias("unkeyed"), F.countDistinct("position_key", "put_call_bucket", "unit_key").alias("positions"),
    )
    p = I.reported_periods(spark, d, f).join(g, ["cik", "period"], "left")
    return p.select("cik", "period", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("holdings", "value", "undisclosed", "unkeyed", "positions")], F.ceil(F.coalesce("holdings", F.lit(0)) / 100).alias("pages"))


def q_member_sources(spark, d):
    """Members known to the roster, to filings or to trades, with where from."""
    ids = lambda n, s: table(spark, d, n).select("bioguide_id", F.lit(s).alias("s")).filter(F.col("bioguide_id").isNotNull())
    both = ids("members", "roster").union(ids("filings", "filings")).union(ids("transactions", "trades")).distinct()
    return both.groupBy("bioguide_id").agg(F.array_join(F.array_sort(F.collect_set("s")), ",").alias("sources"))


def q_periods(spark, d):
    """Every period that filings, holdings or changes speak of."""
    one = lambda df, c: df.select(F.col(c).alias("period"))
    f = I.books(spark, d)
    x = I.deltas(spark, d, f)
    return one(I.reported_periods(spark, d, f), "period").union(one(I.reported_rows(spark, d, f), "period")).union(one(x, "period")).union(one(x, "prev_period")).distinct()


def q_compact(spark, d):
    """Changes by compact code and mask, and how many come back as they were."""
    a = I.deltas(spark, d)
    c = E.compact_changes(a.withColumn("was", F.concat_ws("|", "change_kind", "flags")))
    same = F.concat_ws("|", "change_kind", "flags") == F.col("was")
    return E.expand_changes(c.withColumn("c", F.col("code")).withColumn("m", F.col("mask"))).groupBy(F.col("c").alias("code"), F.col("m").alias("mask")).agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("restored"))


def q_payloads(spark, d):
    """The parts of each filer's payload: rows, filings they refer to, changes, periods."""
    f = I.books(spark, d)
    return B.filer_payloads(I.reported_rows(spark, d, f), table(spark, d, "inst_filings"), I.deltas(spark, d, f), I.q_concentration(spark, d, f)).select(
        "cik", F.size("rows").alias("n_rows"), F.size("filings").alias("n_filings"), F.size("changes").alias("n_changes"), F.size("periods").alias("n_periods")
    )


def q_fragments(spark, d):
    """Holdings of each filer cut into fragments of at most 8 KiB, filings charged once a
    fragment."""
    r = I.reported_rows(spark, d)
    size = F.octet_length("issuer_name") + 64
    return B.shards(r, "cik", ["row_id"], size, 8_192, dependency="filing_key", dependency_size=120)


def q_codec(spark, d):
    """Trades through the columnar codec and back."""
    t = C.trades(spark, d).select(*C.TRADE)
    back = B.decode_rows(B.encode_rows(t, C.TRADE), C.TRADE, t.schema)
    same = F.struct(*[F.col(f"b.{c}") for c in C.TRADE])
    j = t.alias("a").join(back.alias("b"), F.col("a.txn_id") == F.col("b.txn_id")).select(F.struct(*[F.col(f"a.{c}") for c in C.TRADE]).eqNullSafe(same).alias("same"))
    return j.agg(F.count(F.lit(1)).alias("rows"), F.count_if("same").alias("same"))


def q_audit(spark, d):
    """Seed trades drawn per chamber and year, judged by a stated rule, scored."""
    t = P.once(table(spark, d, "transactions"), "txn_id").filter(F.col("source") == "kadoa").withColumn("band", N.year_band(F.year("filed_date")))
    mark = F.substring(F.md5("txn_id"), 1, 1)
    return E.audit_score(t.withColumn("verdict", F.when(mark == "0", "wrong").when(mark != "f", "ok")), ["chamber", "band"])


def q_audit_population(spark, d):
    """Fields that an audit is bound to, of every seed row."""
    t = P.once(table(spark, d, "transactions"), "txn_id").filter(F.col("source") == "kadoa")
    return t.select("txn_id", "filing_id", "chamber", "bioguide_id", "owner", "ticker", "asset_name", "asset_type", "side", "transaction_date", "filed_date", "amount_low", "amount_high").orderBy("txn_id")


QUERIES = {
    "feed_filter": q_feed_filter, "amount_order": q_amount_order, "page_budget": q_page_budget, "activity_top": q_activity, "page_changes": q_page_changes, "filer_index": q_filer_index,
    "issuer_links": q_issuer_links, "holder_coverage": q_holder_coverage, "ticker_holders": q_ticker_holders, "jurisdiction_overlap": q_jurisdiction, "sector_mix": q_sector_mix,
    "jurisdiction_signals": q_jurisdiction_signals, "stats_inventory": q_stats_inventory, "filing_reconciliation": q_filing_reconciliation, "period_universe": q_period_universe,
    "member_sources": q_member_sources, "known_periods": q_periods, "compact_changes": q_compact, "filer_payloads": q_payloads, "payload_fragments": q_fragments, "row_codec": q_codec,
    "audit_score": q_audit, "audit_population": q_audit_population,
}

_B, _Q, _CO, _T = I._B, I._Q, I._CO, C._T
_AC = _Q + """, ap AS (SELECT DISTINCT fr.cik, fr.period FROM au JOIN fr USING (cik, period_of_report)), ak AS (SELECT q.* REPLACE (CASE WHEN change_kind = 'exit' AND ap.cik IS NULL THEN 'unclassified' ELSE change_kind END AS change_kind) FROM qd q LEFT JOIN ap ON ap.cik = q.cik AND ap.period = q.period)
"""
_NA = """, nm AS (SELECT *, coalesce(member, filer_name_raw) AS name FROM tr), pp AS (SELECT f.*, m.party, coalesce(m.full_name, f.filer_name_raw) AS name FROM ac f LEFT JOIN members m ON m.bioguide_id = f.bioguide_id WHERE f.parse_status = 'needs_ocr')
"""
_LK = _B + """, se AS (SELECT security_id, CASE WHEN count(DISTINCT cusip[1:6]) = 1 THEN min(cusip[1:6]) END AS entity_id, CASE count(DISTINCT cusip[1:6]) WHEN 1 THEN 'resolved' WHEN 0 THEN 'unresolved' ELSE 'conflict' END AS link FROM r WHERE security_id IS NOT NULL GROUP BY ALL),
lk AS (SELECT rr.*, entity_id, coalesce(link, 'none') AS link, CASE WHEN entity_id IS NOT NULL THEN 'entity:' || entity_id WHEN length(cusip) >= 6 THEN 'cusip6:' || cusip[1:6] ELSE 'name:' || upper(trim(regexp_replace(issuer_name, '\\s+', ' ', 'g'))) END AS issuer_key FROM rr LEFT JOIN se USING (security_id))
"""
_SE = "CASE " + " ".join(f"WHEN {{s}} BETWEEN {a} AND {z} THEN '{n}'" for a, z, n in K.SECTORS) + " ELSE 'Unknown' END"
_LIST = "[" + ", ".join(f"'{n}'" for *_, n in K.SECTORS) + "]"
_OV = _T + f""", st AS (SELECT DISTINCT bioguide_id, t.state AS committee, t.start AS a, coalesce(t."end", DATE '9999-12-31') AS z FROM (SELECT bioguide_id, unnest(terms) AS t FROM members)), sp AS (SELECT min(a) AS a, max(z) AS z FROM st),
 rm AS (SELECT DISTINCT committee, {_LIST}[ascii(committee) % {len(K.SECTORS)} + 1] AS sector FROM st),
 sx AS (SELECT tr.*, 100 + (ascii(ticker) * 997 + coalesce(ascii(substring(ticker, 2, 1)), 0) * 131) % 9600 AS sic FROM tr),
 sc AS (SELECT *, CASE WHEN ticker IS NULL THEN 'no_ticker' WHEN ticker LIKE 'A%' THEN 'no_issuer' WHEN ticker LIKE '%Z' THEN 'no_sic' ELSE {_SE.replace('{s}', 'sic')} END AS sector FROM sx),
 ov AS (SELECT sc.*, CASE WHEN NOT coalesce(bioguide_id IS NOT NULL AND filed_date >= sp.a AND filed_date < sp.z, false) AND NOT (filed_date >= sp.a AND filed_date < sp.z) THEN 'undatable' WHEN sector LIKE 'no\\_%' ESCAPE '\\' THEN 'unmapped'
   WHEN EXISTS (SELECT 1 FROM st JOIN rm USING (committee) WHERE st.bioguide_id = sc.bioguide_id AND st.a <= filed_date AND filed_date < st.z AND rm.sector = sc.sector) THEN 'overlap' ELSE 'none' END AS jurisdiction FROM sc, sp)
"""

SQL = {
    "feed_filter": _T + _NA + """, x AS (SELECT *, chamber = 'house' AND side = 'purchase' AND owner IS NULL AND coalesce(transaction_date BETWEEN DATE '2018-01-01' AND DATE '2022-12-31', false) AND NOT coalesce(list_contains(flags, 'date_anomaly'), false)
  AND (coalesce(contains(lower(name), 'a'), false) OR coalesce(upper(ticker) LIKE 'A%', false)) AS a, chamber = 'senate' AND filed_date >= DATE '2014-01-01' AND (coalesce(contains(lower(name), 'e'), false) OR coalesce(upper(ticker) LIKE 'E%', false)) AS b FROM nm)
 SELECT 'trade' AS kind, 'trading' AS filter, count(*) AS total, count(*) FILTER (a AND coalesce(amount_low > 15000, false)) AS shown, count(*) FILTER (a AND NOT coalesce(amount_low > 15000, false) AND NOT coalesce(amount_high <= 15000, false)) AS indeterminate FROM x
 UNION ALL SELECT 'trade', 'paper', count(*), count(*) FILTER (b), 0 FROM x UNION ALL SELECT 'paper', 'trading', count(*), 0, 0 FROM pp
 UNION ALL SELECT 'paper', 'paper', count(*), count(*) FILTER (chamber = 'senate' AND filed_date >= DATE '2014-01-01' AND contains(lower(name), 'e')), 0 FROM pp""",
    "amount_order": _T + """, k AS (SELECT *, coalesce(amount_low, CASE WHEN amount_high IS NOT NULL THEN 0 END) AS key FROM tr)
 (SELECT 'top' AS "end", txn_id, key FROM k ORDER BY key IS NULL, key DESC, filed_date DESC NULLS LAST, txn_id LIMIT 200) UNION ALL (SELECT 'bottom', txn_id, key FROM k ORDER BY key IS NULL, key, filed_date DESC NULLS LAST, txn_id LIMIT 200)""",
    "page_budget": _T + """, e AS (SELECT 'bioguide_id' AS kind, bioguide_id AS entity, count(*) AS rows, 1 AS cost FROM tr WHERE bioguide_id IS NOT NULL GROUP BY ALL UNION ALL SELECT 'ticker', ticker, count(*), 2 FROM tr WHERE ticker IS NOT NULL GROUP BY ALL)
 SELECT * FROM (SELECT *, CAST(sum(cost) OVER (ORDER BY rows DESC, kind, entity ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent FROM e) WHERE spent <= 300""",
    "activity_top": _AC + """, h AS (SELECT cik, CAST(coalesce(sum(value_usd), 0) AS BIGINT) AS v FROM rr GROUP BY ALL) SELECT a.cik, period, position_key, put_call_bucket, unit_key, change_kind, delta_value, coalesce(h.v, CASE WHEN a.cik IN (SELECT cik FROM fr) THEN 0 END) AS filer_value
 FROM (SELECT * FROM ak ORDER BY delta_value IS NULL, abs(delta_value) DESC, cik, position_key, put_call_bucket, unit_key LIMIT 200) a LEFT JOIN h USING (cik)""",
    "page_changes": _Q + """SELECT cik, period, row_number() OVER (PARTITION BY cik, period ORDER BY coalesce(curr_value, prev_value, -1) DESC, position_key, put_call_bucket, unit_key) AS place, position_key, put_call_bucket, unit_key, count(*) OVER (PARTITION BY cik, period) AS total FROM qd""",
    "filer_index": _CO + """, la AS (SELECT cik, max(period) AS latest_period FROM fr GROUP BY ALL), lv AS (SELECT cik FROM rr GROUP BY cik QUALIFY row_number() OVER (ORDER BY sum(value_usd) FILTER (period = (SELECT max(x.period) FROM rr x WHERE x.cik = rr.cik)) DESC NULLS LAST, cik) <= 1500)
 SELECT la.cik, latest_period, total_value, positions, CASE WHEN undisclosed = 0 THEN hhi END AS hhi, CASE WHEN la.cik IN (SELECT cik FROM rr) THEN 'top' ELSE 'tail' END AS tier FROM la LEFT JOIN cc ON cc.cik = la.cik AND cc.period = la.latest_period WHERE ltrim(la.cik, '0') LIKE '70010%'""",
    "issuer_links": _LK + "SELECT period, string_split(issuer_key, ':')[1] AS issuer_key_source, link, count(*) AS n, count(DISTINCT issuer_key) AS issuers FROM lk GROUP BY ALL",
    "holder_coverage": _LK + """, g AS (SELECT issuer_key LIKE 'entity:%' AS res, period, cik, CASE WHEN count(value_usd) = count(*) THEN sum(value_usd) END AS v FROM lk GROUP BY issuer_key, period, cik),
 k AS (SELECT period, count(*) FILTER (res) AS resolved_rows, coalesce(sum(v) FILTER (res), 0) AS r, count(*) FILTER (res AND v IS NULL) AS ru, count(*) FILTER (NOT res) AS unresolved_rows, coalesce(sum(v) FILTER (NOT res), 0) AS u, count(*) FILTER (NOT res AND v IS NULL) AS uu FROM g GROUP BY period)
 SELECT period, resolved_rows, CAST(r AS BIGINT) AS resolved_value, ru AS resolved_undisclosed, unresolved_rows, CAST(u AS BIGINT) AS unresolved_value, uu AS unresolved_undisclosed, CASE WHEN r + u > 0 THEN CAST((r * 20000 + r + u) // (2 * (r + u)) AS BIGINT) END AS coverage_bps FROM k""",
    "ticker_holders": _LK + """, m AS (SELECT cusip[1:4] AS ticker, count(DISTINCT cusip[1:6]) AS issuers, min(cusip[1:6]) AS e FROM r WHERE cusip IS NOT NULL GROUP BY ALL), h AS (SELECT entity_id AS e, count(DISTINCT cik) AS holders, CAST(sum(value_usd) AS BIGINT) AS value FROM lk WHERE entity_id IS NOT NULL GROUP BY ALL)
 SELECT ticker, CASE WHEN issuers > 1 THEN 'ambiguous' WHEN holders IS NULL THEN 'no_holders' ELSE 'found' END AS outcome, issuers, CASE WHEN issuers = 1 THEN holders END AS holders, CASE WHEN issuers = 1 THEN value END AS value FROM m LEFT JOIN h USING (e)""",
    "jurisdiction_overlap": _OV + "SELECT chamber, jurisdiction, count(*) AS n, count(DISTINCT bioguide_id) AS members FROM ov GROUP BY ALL",
    "sector_mix": _OV + "SELECT sector, count(*) AS n, count(DISTINCT bioguide_id) AS members, CASE WHEN sector LIKE 'no\\_%' ESCAPE '\\' THEN 1 ELSE 0 END AS bucket FROM ov GROUP BY ALL",
    "jurisdiction_signals": _OV + "SELECT 's5-jurisdiction' AS kind, bioguide_id, ticker, txn_id AS dedupe_key FROM ov WHERE jurisdiction = 'overlap'",
    "stats_inventory": _T + "SELECT source, chamber, parse_status, lifecycle, count(*) AS filings, count(bioguide_id) AS joined, CAST(coalesce(sum(row_count), 0) AS BIGINT) AS declared_rows, min(filed_date) AS first, max(filed_date) AS last FROM fl GROUP BY ALL",
    "filing_reconciliation": _B + """, g AS (SELECT filing_key, CAST(sum(value_usd) AS BIGINT) AS value, count(*) AS entries, count(security_id) AS resolved_entries, CAST(sum(value_usd) FILTER (security_id IS NOT NULL) AS BIGINT) AS resolved_value FROM r GROUP BY ALL)
 SELECT f.filing_key, coalesce(entries, 0) AS entries, coalesce(resolved_entries, 0) AS resolved_entries, value, resolved_value, value - table_value_total_usd AS delta FROM inst_filings f LEFT JOIN g USING (filing_key)""",
    "period_universe": _B + """, g AS (SELECT cik, period, count(*) AS holdings, CAST(coalesce(sum(value_usd), 0) AS BIGINT) AS value, count(*) - count(value_usd) AS undisclosed, count(*) - count(position_key) AS unkeyed, count(DISTINCT CASE WHEN position_key IS NOT NULL THEN (position_key, put_call_bucket, unit_key) END) AS positions FROM rr GROUP BY ALL)
 SELECT fp.cik, fp.period, coalesce(holdings, 0) AS holdings, coalesce(value, 0) AS value, coalesce(undisclosed, 0) AS undisclosed, coalesce(unkeyed, 0) AS unkeyed, coalesce(positions, 0) AS positions, CAST(ceil(coalesce(holdings, 0) / 100) AS BIGINT) AS pages FROM fp LEFT JOIN g USING (cik, period)""",
    "member_sources": """SELECT bioguide_id, string_agg(s, ',' ORDER BY s) AS sources FROM (SELECT bioguide_id, 'roster' AS s FROM members UNION SELECT bioguide_id, 'filings' FROM filings UNION SELECT bioguide_id, 'trades' FROM transactions) WHERE bioguide_id IS NOT NULL GROUP BY ALL""",
    "known_periods": _Q + "SELECT period FROM fp UNION SELECT period FROM rr UNION SELECT period FROM qd UNION SELECT prev_period FROM qd",
    "compact_changes": _Q + """, k AS (SELECT list_position(['new', 'exit', 'add', 'trim', 'unclassified'], change_kind) - 1 AS code, CAST(list_sum([CASE WHEN contains(flags, 'change_kind_undeterminable') THEN 1 ELSE 0 END, CASE WHEN contains(flags, 'classified_by_value') THEN 2 ELSE 0 END,
  CASE WHEN contains(flags, 'identity_reconciled_by_cusip') THEN 4 ELSE 0 END, CASE WHEN contains(flags, 'shares_unit_mismatch') THEN 8 ELSE 0 END, CASE WHEN contains(flags, 'value_undisclosed_one_side') THEN 16 ELSE 0 END]) AS INT) AS mask FROM qd)
 SELECT code, mask, count(*) AS n, count(*) AS restored FROM k GROUP BY ALL""",
    "filer_payloads": _CO + _Q[len(_B):] + """, a AS (SELECT cik, count(*) AS n_rows, count(DISTINCT filing_key) AS n_filings FROM rr GROUP BY ALL), b AS (SELECT cik, count(*) AS n_changes FROM qd GROUP BY ALL), c0 AS (SELECT cik, count(*) AS n_periods FROM cc GROUP BY ALL)
 SELECT c0.cik, coalesce(n_rows, 0) AS n_rows, coalesce(n_filings, 0) AS n_filings, coalesce(n_changes, 0) AS n_changes, n_periods FROM c0 LEFT JOIN a USING (cik) LEFT JOIN b USING (cik)""",
    "payload_fragments": _B + """, d AS (SELECT cik, row_id, filing_key, strlen(issuer_name) + 64 AS b, row_number() OVER (PARTITION BY cik ORDER BY row_id) AS i FROM rr),
 w AS (SELECT cik, row_id, i, b + 120 AS used, 0 AS shard, [filing_key] AS held FROM d WHERE i = 1
  UNION ALL SELECT d.cik, d.row_id, d.i, CASE WHEN w.used + d.b + CASE WHEN list_contains(held, filing_key) THEN 0 ELSE 120 END > 8192 THEN d.b + 120 ELSE w.used + d.b + CASE WHEN list_contains(held, filing_key) THEN 0 ELSE 120 END END,
   CASE WHEN w.used + d.b + CASE WHEN list_contains(held, filing_key) THEN 0 ELSE 120 END > 8192 THEN w.shard + 1 ELSE w.shard END,
   CASE WHEN w.used + d.b + CASE WHEN list_contains(held, filing_key) THEN 0 ELSE 120 END > 8192 THEN [filing_key] ELSE list_distinct(list_append(held, filing_key)) END FROM w JOIN d ON d.cik = w.cik AND d.i = w.i + 1)
 SELECT cik, row_id, CAST(shard AS BIGINT) AS shard FROM w""",
    "row_codec": _T + "SELECT count(*) AS rows, count(*) AS same FROM tr",
    "audit_score": _T + """, k AS (SELECT chamber, CASE WHEN year(filed_date) < 2016 THEN '2012-2015' WHEN year(filed_date) < 2020 THEN '2016-2019' WHEN year(filed_date) < 2024 THEN '2020-2023' ELSE '2024+' END AS band, md5(txn_id)[1] AS m FROM tx WHERE source = 'kadoa'),
 g AS (SELECT chamber, band, count(*) FILTER (m <> 'f') AS checked, count(*) FILTER (m = '0') AS wrong, count(*) FILTER (m = 'f') AS unchecked FROM k GROUP BY ALL), b AS (SELECT *, CASE WHEN wrong = 0 AND checked > 0 THEN 1 - pow(0.05, 1.0 / checked) END AS ub FROM g)
 SELECT chamber, band, checked, wrong, unchecked, round(ub, 6) AS upper_bound, CASE WHEN unchecked > 0 THEN 'incomplete' WHEN checked = 0 THEN 'empty' WHEN wrong > 0 THEN 'fail' WHEN ub <= 0.05 THEN 'pass' ELSE 'too_small' END AS decision FROM b""",
    "audit_population": _T + "SELECT txn_id, filing_id, chamber, bioguide_id, owner, ticker, asset_name, asset_type, side, transaction_date, filed_date, amount_low, amount_high FROM tx WHERE source = 'kadoa'",
}
