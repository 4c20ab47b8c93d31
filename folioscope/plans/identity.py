"""Questions about identity at a date, signals, and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from ..functions import normalize as N
from ..operators import intervals as I, populations as P, signals as S
from ..operators.members import apply_members, pair_amendments, resolve_members
from ..sources import table
from .congress import _T, trades
from .institutions import rows


def observed(spark: SparkSession, d: str):
    """Quarters in which a CUSIP was reported as a security, as half-open intervals."""
    q = F.col("period").cast("date")
    return rows(spark, d).filter(F.col("cusip").isNotNull() & F.col("security_id").isNotNull()).select(
        "cusip", "security_id", N.quarter_start(q).alias("valid_from"), F.date_add(N.quarter_end(q), 1).alias("valid_to")
    ).distinct()


def q_cusip_intervals(spark, d):
    return I.union_intervals(observed(spark, d), ["cusip", "security_id"])


def q_cusip_overlaps(spark, d):
    """Every CUSIP's intervals, those that begin before an earlier one ended, and securities."""
    iv = q_cusip_intervals(spark, d)
    bad = I.overlaps(iv, ["cusip"]).groupBy("cusip").agg(F.count(F.lit(1)).alias("overlaps"))
    g = iv.groupBy("cusip").agg(F.count(F.lit(1)).alias("intervals"), F.countDistinct("security_id").alias("securities"))
    return g.join(bad, "cusip", "left").select("cusip", "intervals", "securities", F.coalesce("overlaps", F.lit(0)).alias("overlaps"))


def q_cusip_gaps(spark, d):
    return I.long_gaps(q_cusip_intervals(spark, d), ["cusip", "security_id"], 180)


def q_cusip_as_of(spark, d):
    """Rows without a security resolved by their CUSIP as of their period: the intervals
    of the layer 1 (even quarters' observations) own the decision where they cover."""
    iv = q_cusip_intervals(spark, d)
    both = iv.select(F.col("cusip").alias("value"), "valid_from", "valid_to", F.col("security_id").alias("payload"), F.lit(False).alias("disputed"), F.when(F.month("valid_from").isin(1, 7), 1).otherwise(2).alias("layer"))
    ev = rows(spark, d).filter(F.col("cusip").isNotNull()).withColumn("at", F.col("period").cast("date"))
    return I.resolve_as_of(ev, "cusip", "at", both, (1, 2)).select("row_id", "cusip", "resolved")


def q_issuer_history(spark, d):
    """The name of each CUSIP through the periods, as intervals."""
    names = rows(spark, d).filter(F.col("cusip").isNotNull()).groupBy("cusip", "period").agg(F.max(N.issuer_name(F.col("issuer_name"))).alias("name"))
    return I.history(names, "cusip", "period", "name")


def q_link_candidates(spark, d):
    """CUSIPs by how many securities they were reported as: one resolves, several conflict."""
    return I.unique_or_null(rows(spark, d).filter(F.col("cusip").isNotNull()), "cusip", "security_id")


def q_alias_overlaps(spark, d):
    a = table(spark, d, "member_aliases").select("alias_id", F.lower("alias").alias("name"), "chamber", "valid_from", "valid_to")
    bad = I.overlaps(a, ["name", "chamber"]).select("alias_id", F.lit(True).alias("_o"))
    return a.join(bad, "alias_id", "left").select("alias_id", F.coalesce("_o", F.lit(False)).alias("overlaps"))


def q_member_resolution(spark, d):
    return resolve_members(P.once(table(spark, d, "filings"), "filing_id"), table(spark, d, "member_aliases"), table(spark, d, "members"))


def q_member_writeback(spark, d):
    """Trades with the member found for their filing, beside the one they came with."""
    f, t = P.once(table(spark, d, "filings"), "filing_id"), P.once(table(spark, d, "transactions"), "txn_id")
    _, new = apply_members(f, t.withColumn("was", F.col("bioguide_id")), q_member_resolution(spark, d))
    state = F.when(F.col("bioguide_id").isNull(), F.when(F.col("was").isNull(), "still_none").otherwise("lost")).when(F.col("was").isNull(), "found").when(F.col("was") == F.col("bioguide_id"), "same").otherwise("changed")
    return new.groupBy("chamber", "source", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def q_amendment_pairing(spark, d):
    """Amendments paired by printed filer and date; the tables have no title dates, so the
    year of filing stands in."""
    f = P.once(table(spark, d, "filings"), "filing_id").withColumn("title_date", F.trunc("filed_date", "year"))
    return pair_amendments(f)


def all_signals(t):
    out = S.large(t)
    for f in (S.first_disclosure, S.infrequent, S.late_large):
        out = out.unionByName(f(t))
    return out


def q_signals(spark, d):
    return all_signals(trades(spark, d))


def q_clusters(spark, d):
    return S.cluster_starts(trades(spark, d), members=2).select("ticker", "side", "most", F.array_join(F.transform("starts", lambda x: x.cast("string")), ",").alias("starts"))


def q_gate(spark, d):
    t = trades(spark, d)
    return S.gate(all_signals(t).unionByName(S.cooccurrence(t)), t)


def q_signal_lifecycle(spark, d):
    """Three builds chained: of filings up to 2018, from 2015 up to 2022, and from 2017."""
    t = trades(spark, d)
    a, z = F.lit("2019-01-01").cast("date"), F.lit("2023-01-01").cast("date")
    one = S.lifecycle(None, S.large(t.filter(F.col("filed_date") < a)), "b1")
    two = S.lifecycle(one, S.large(t.filter((F.col("filed_date") >= "2015-01-01") & (F.col("filed_date") < z))), "b2")
    return S.lifecycle(two, S.large(t.filter(F.col("filed_date") >= "2017-01-01")), "b3")


def q_scalar_holdings(spark, d):
    """Grain tokens, issuer keys, CUSIP checks and flags of every holding."""
    r = rows(spark, d)
    flags = F.from_json("flags", "array<string>")
    return r.select(
        "row_id", N.cik(F.concat(F.lit("CIK"), F.col("cik"))).alias("cik"), N.position_key(F.col("security_id"), F.col("cusip")).alias("key"),
        N.put_call_bucket(F.col("put_call")).alias("bucket"), N.unit_key(F.col("ssh_type")).alias("unit"),
        N.issuer_key(F.col("cusip"), F.col("issuer_name")).alias("issuer_key"), N.cusip_check_ok(F.col("cusip")).alias("check_ok"),
        N.flags_json(flags).alias("flags"), F.array_contains(flags, "unmapped_security").alias("unmapped"),
        N.share_bps(F.col("value_usd"), F.lit(10**9)).alias("bps"),
    )


def q_scalar_trades(spark, d):
    """Dates, amounts and texts derived for every trade."""
    t = P.once(table(spark, d, "transactions"), "txn_id")
    lo, hi, traded, filed = F.col("amount_low"), F.col("amount_high"), F.col("transaction_date"), F.col("filed_date")
    label = N.amount_label(lo, hi)
    back = N.amount_bounds(label)
    return t.select(
        "txn_id", N.days_to_file(traded, filed).alias("days"), N.is_late(traded, filed).alias("late"), N.date_anomaly(traded, filed).alias("anomaly"),
        N.quarter_tag(filed).alias("quarter"), N.filing_deadline(filed).alias("deadline"), label.alias("label"),
        back["low"].alias("low"), back["high"].alias("high"), N.range_text(lo, hi).alias("text"), F.round(N.band_position(lo), 6).alias("band"),
        N.printed_ticker(F.col("ticker")).alias("ticker"), N.side(F.col("side")).alias("side"), N.owner(F.col("owner")).alias("owner"),
        N.printed_date(F.date_format(traded, "M/d/yyyy")).alias("parsed_date"),
    )


def q_scalar_filings(spark, d):
    f = table(spark, d, "inst_filings")
    return f.select(
        "filing_key", N.file_number(F.col("file_number_norm")).alias("file_number"), N.unit_multiplier(F.col("filed_date")).alias("multiplier"),
        N.cover_tolerance(F.col("table_value_total_usd")).alias("tolerance"), N.iso_date(F.col("filed_date").cast("string")).alias("filed"),
        F.size("other_managers").alias("managers"), N.quarter_end(F.col("period_of_report")).alias("quarter_end"),
    )


def q_scalar_members(spark, d):
    m = table(spark, d, "members")
    return m.select("bioguide_id", N.party_code(F.col("party")).alias("code"), N.earliest_term(F.col("terms")).alias("since"), F.octet_length("full_name").alias("bytes"))


QUERIES = {
    "cusip_intervals": q_cusip_intervals, "cusip_overlaps": q_cusip_overlaps, "cusip_gaps": q_cusip_gaps, "cusip_as_of": q_cusip_as_of,
    "issuer_name_history": q_issuer_history, "cusip_link_candidates": q_link_candidates, "alias_overlaps": q_alias_overlaps,
    "member_resolution": q_member_resolution, "signals": q_signals, "signal_clusters": q_clusters, "signal_lifecycle": q_signal_lifecycle,
    "member_writeback": q_member_writeback, "amendment_pairing": q_amendment_pairing, "signal_gate": q_gate, "scalar_holdings": q_scalar_holdings, "scalar_trades": q_scalar_trades, "scalar_filings": q_scalar_filings, "scalar_members": q_scalar_members,
}

_IV = """
WITH r AS (SELECT DISTINCT ON (row_id) * FROM serving_filer_rows),
ob AS (SELECT DISTINCT cusip, security_id, CAST(date_trunc('quarter', CAST(period AS DATE)) AS DATE) AS a, last_day(date_trunc('quarter', CAST(period AS DATE)) + INTERVAL 2 MONTH) + 1 AS b FROM r WHERE cusip IS NOT NULL AND security_id IS NOT NULL),
i1 AS (SELECT *, max(b) OVER (PARTITION BY cusip, security_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ob),
i2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY cusip, security_id ORDER BY a, b) AS isl FROM i1),
iv AS (SELECT cusip, security_id, min(a) AS valid_from, CAST(max(b) AS DATE) AS valid_to FROM i2 GROUP BY cusip, security_id, isl)
"""
_DROPPED = "['hon', 'dr', 'mr', 'mrs', 'ms', 'jr', 'sr', 'ii', 'iii', 'iv', 'v', 'md', 'facs', 'dds', 'esq', 'phd']"
_S = "(CASE WHEN contains({c}, ',') THEN substr({c}, strpos({c}, ',') + 1) || ' ' || substr({c}, 1, strpos({c}, ',') - 1) ELSE {c} END)"
_N = rf"array_to_string(list_filter(string_split(trim(regexp_replace(lower(strip_accents({_S})), '\W+', ' ', 'g')), ' '), lambda w: NOT list_contains({_DROPPED}, w)), ' ')"
_SIG = "chamber, bioguide_id, ticker, side, filed_date AS at, txn_id AS dedupe_key"
_BT = r"CASE WHEN {c} >= 1000000 THEN '$' || regexp_replace(format('{:.1f}', round({c} / 1000000.0, 1)), '\.0$', '') || 'M' ELSE '$' || regexp_replace(format('{:.1f}', round({c} / 1000.0, 1)), '\.0$', '') || 'K' END"
_LO, _HI = _BT.replace("{c}", "(CASE WHEN amount_low % 1000 = 1 THEN amount_low - 1 ELSE amount_low END)"), _BT.replace("{c}", "amount_high")
_LABEL = "CASE " + " ".join(f"WHEN amount_low = {a} AND amount_high {'IS NULL' if b is None else f'= {b}'} THEN '{x}'" for x, a, b in N.AMOUNTS[:10]) + " END"

_MR = f"""WITH f AS (SELECT DISTINCT filing_id, chamber, filed_date, {_N.replace('{c}', 'filer_name_raw')} AS name FROM filings),
 tm AS (SELECT bioguide_id, CASE t.type WHEN 'rep' THEN 'house' WHEN 'sen' THEN 'senate' END AS chamber, t.start AS a, coalesce(t."end", DATE '9999-12-31') AS z FROM (SELECT bioguide_id, unnest(terms) AS t FROM members)),
 al AS (SELECT DISTINCT {_N.replace('{c}', 'alias')} AS name, chamber, valid_from, coalesce(valid_to, DATE '9999-12-31') AS z, bioguide_id FROM member_aliases),
 fn AS (SELECT bioguide_id, {_N.replace('{c}', 'full_name')} AS name FROM members),
 va AS (SELECT * FROM fn UNION SELECT bioguide_id, string_split(name, ' ')[1] || ' ' || string_split(name, ' ')[-1] FROM fn),
 vk AS (SELECT bioguide_id, string_split(name, ' ')[1] || ' ' || string_split(name, ' ')[-1] AS k FROM va WHERE len(string_split(name, ' ')) >= 2
  UNION SELECT bioguide_id, string_split(name, ' ')[2] || ' ' || string_split(name, ' ')[-1] FROM va WHERE len(string_split(name, ' ')) >= 3),
 fk AS (SELECT *, string_split(name, ' ')[1] || ' ' || string_split(name, ' ')[-1] AS k1, CASE WHEN len(string_split(name, ' ')) >= 3 AND length(string_split(name, ' ')[1]) = 1 THEN string_split(name, ' ')[2] || ' ' || string_split(name, ' ')[-1] END AS k2 FROM f WHERE len(string_split(name, ' ')) >= 2),
 ca AS (SELECT 1 AS step, f.filing_id, al.bioguide_id FROM f JOIN al ON al.name = f.name AND al.chamber = f.chamber AND al.valid_from <= f.filed_date AND f.filed_date < al.z JOIN tm ON tm.bioguide_id = al.bioguide_id AND tm.chamber = f.chamber AND f.filed_date BETWEEN tm.a AND tm.z
  UNION SELECT 2, f.filing_id, va.bioguide_id FROM f JOIN va ON va.name = f.name JOIN tm ON tm.bioguide_id = va.bioguide_id AND tm.chamber = f.chamber AND f.filed_date BETWEEN tm.a AND tm.z
  UNION SELECT 3, f.filing_id, vk.bioguide_id FROM fk f JOIN vk ON (vk.k = f.k1 OR vk.k = f.k2) JOIN tm ON tm.bioguide_id = vk.bioguide_id AND tm.chamber = f.chamber AND f.filed_date BETWEEN tm.a AND tm.z),
 st AS (SELECT filing_id, step, count(DISTINCT bioguide_id) AS n, min(bioguide_id) AS b FROM ca GROUP BY ALL), fi AS (SELECT * FROM st QUALIFY step = min(step) OVER (PARTITION BY filing_id)),
 rm AS (SELECT f.filing_id, CASE WHEN n = 1 THEN b END AS bioguide_id, CASE WHEN n IS NULL THEN 'unmatched' WHEN step = 1 THEN CASE WHEN n = 1 THEN 'alias' ELSE 'alias_conflict' END WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS outcome FROM f LEFT JOIN fi USING (filing_id))
"""
_SG = f""", ms AS (SELECT min(filed_date) AS s FROM tr),
 s2 AS (SELECT *, row_number() OVER (PARTITION BY bioguide_id, ticker ORDER BY filed_date, txn_id) AS n FROM tr WHERE bioguide_id IS NOT NULL AND ticker IS NOT NULL),
 s4 AS (SELECT t.*, (SELECT count(*) FROM tr b WHERE b.bioguide_id = t.bioguide_id AND b.filed_date < t.filed_date) AS n FROM tr t WHERE t.bioguide_id IS NOT NULL),
 sg AS (SELECT 's1-large' AS kind, {_SIG} FROM tr WHERE amount_low >= 250000
 UNION ALL SELECT 's2-first', {_SIG} FROM s2, ms WHERE n = 1 AND date_diff('day', s, filed_date) >= 365
 UNION ALL SELECT 's4-infrequent', {_SIG} FROM s4 WHERE side = 'purchase' AND amount_low >= 50000 AND n <= 10
 UNION ALL SELECT 's6-late-large', {_SIG} FROM tr WHERE is_late AND amount_low >= 100000)
"""
_CL = """, o AS (SELECT DISTINCT ticker, side, transaction_date AS d, bioguide_id FROM tr WHERE bioguide_id IS NOT NULL AND ticker IS NOT NULL AND transaction_date IS NOT NULL AND filed_date >= transaction_date),
 dn AS (SELECT a.ticker, a.side, a.d, count(DISTINCT b.bioguide_id) AS n FROM (SELECT DISTINCT ticker, side, d FROM o) a JOIN o b ON a.ticker = b.ticker AND a.side = b.side AND b.d BETWEEN a.d AND a.d + 13 GROUP BY ALL),
 ok AS (SELECT * FROM dn WHERE n >= {least}), gr AS (SELECT ticker, side, min(d) AS d FROM ok GROUP BY ALL UNION ALL
  SELECT g.ticker, g.side, min(ok.d) FROM gr g JOIN ok ON ok.ticker = g.ticker AND ok.side = g.side AND ok.d >= g.d + 14 GROUP BY g.ticker, g.side)
"""

SQL = {
    "cusip_intervals": _IV + "SELECT * FROM iv",
    "cusip_overlaps": _IV + """, o AS (SELECT *, valid_from < coalesce(max(valid_to) OVER (PARTITION BY cusip ORDER BY valid_from, valid_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), DATE '0001-01-01') AS bad FROM iv)
 SELECT cusip, count(*) AS intervals, count(DISTINCT security_id) AS securities, count(*) FILTER (bad) AS overlaps FROM o GROUP BY cusip""",
    "cusip_gaps": _IV + "SELECT * FROM (SELECT cusip, security_id, valid_from, date_diff('day', lag(valid_to) OVER (PARTITION BY cusip, security_id ORDER BY valid_from), valid_from) AS gap_days FROM iv) WHERE gap_days >= 180",
    "cusip_as_of": _IV + """, l AS (SELECT *, CASE WHEN month(valid_from) IN (1, 7) THEN 1 ELSE 2 END AS layer FROM iv),
 h AS (SELECT r.row_id, r.cusip, count(security_id_1) FILTER (layer = 1) AS n1, min(security_id_1) FILTER (layer = 1) AS p1, count(security_id_1) FILTER (layer = 2) AS n2, min(security_id_1) FILTER (layer = 2) AS p2
  FROM r LEFT JOIN (SELECT cusip AS c, security_id AS security_id_1, valid_from, valid_to, layer FROM l) x ON x.c = r.cusip AND x.valid_from <= CAST(r.period AS DATE) AND CAST(r.period AS DATE) < x.valid_to WHERE r.cusip IS NOT NULL GROUP BY ALL)
 SELECT row_id, cusip, CASE WHEN n1 = 1 THEN p1 WHEN n1 = 0 AND n2 = 1 THEN p2 END AS resolved FROM h""",
    "issuer_name_history": _IV + r""", n AS (SELECT cusip, period, max(upper(trim(regexp_replace(issuer_name, '\s+', ' ', 'g')))) AS name FROM r WHERE cusip IS NOT NULL GROUP BY ALL),
 c AS (SELECT * FROM n QUALIFY lag(name) OVER (PARTITION BY cusip ORDER BY period) IS DISTINCT FROM name) SELECT cusip, name, period AS valid_from, lead(period) OVER (PARTITION BY cusip ORDER BY period) AS valid_to FROM c""",
    "cusip_link_candidates": _IV + "SELECT cusip, CASE WHEN count(DISTINCT security_id) = 1 THEN min(security_id) END AS security_id, count(DISTINCT security_id) AS candidates FROM r WHERE cusip IS NOT NULL GROUP BY cusip",
    "alias_overlaps": """SELECT alias_id, coalesce(valid_from < max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY lower(alias), chamber ORDER BY valid_from, coalesce(valid_to, DATE '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS overlaps FROM member_aliases""",
    "member_resolution": _MR + "SELECT * FROM rm",
    "signals": _T + _SG + "SELECT * FROM sg",
    "signal_clusters": _T.replace("WITH", "WITH RECURSIVE", 1) + _CL.replace("{least}", "2") + """ SELECT a.ticker, a.side, a.most, coalesce(string_agg(CAST(d AS VARCHAR), ',' ORDER BY d), '') AS starts FROM (SELECT ticker, side, max(n) AS most FROM dn GROUP BY ALL) a LEFT JOIN gr USING (ticker, side) GROUP BY ALL""",
    "signal_lifecycle": _T + """, k AS (SELECT DISTINCT 's1-large:' || txn_id AS id, filed_date < DATE '2019-01-01' AS a, filed_date >= DATE '2015-01-01' AND filed_date < DATE '2023-01-01' AS b, filed_date >= DATE '2017-01-01' AS c FROM tr WHERE amount_low >= 250000)
 SELECT id, CASE WHEN c THEN 'active' ELSE 'superseded' END AS status, CASE WHEN a THEN 'b1' WHEN b THEN 'b2' ELSE 'b3' END AS first_seen, CASE WHEN c THEN 'b3' WHEN b THEN 'b2' ELSE 'b1' END AS last_seen,
  CASE WHEN c THEN NULL WHEN b THEN 'b3' ELSE 'b2' END AS superseded_in FROM k WHERE a OR b OR c""",
    "member_writeback": _MR + """SELECT t.chamber, t.source, CASE WHEN rm.bioguide_id IS NULL THEN CASE WHEN t.bioguide_id IS NULL THEN 'still_none' ELSE 'lost' END WHEN t.bioguide_id IS NULL THEN 'found' WHEN t.bioguide_id = rm.bioguide_id THEN 'same' ELSE 'changed' END AS state, count(*) AS n
 FROM (SELECT DISTINCT ON (txn_id) * FROM transactions) t LEFT JOIN rm USING (filing_id) GROUP BY ALL""",
    "amendment_pairing": _T + """, a AS (SELECT * FROM fl WHERE filing_kind LIKE '%amendment'), o AS (SELECT * FROM fl WHERE filing_kind NOT LIKE '%amendment'),
 c AS (SELECT a.filing_id, count(DISTINCT o.filing_id) AS n, min(o.filing_id) AS b FROM a LEFT JOIN o ON o.chamber = a.chamber AND o.filer_name_raw = a.filer_name_raw AND (date_trunc('year', o.filed_date) = date_trunc('year', a.filed_date) OR o.filed_date = date_trunc('year', a.filed_date)) GROUP BY ALL)
 SELECT filing_id, CASE WHEN n = 1 THEN b END AS supersedes, n AS candidates FROM c""",
    "signal_gate": _T.replace("WITH", "WITH RECURSIVE", 1) + _SG + _CL.replace("{least}", "4") + """, w AS (SELECT kind, chamber, "at" FROM sg UNION ALL SELECT 's3-cooccurrence', NULL, d FROM gr WHERE d IS NOT NULL), sp AS (SELECT max(filed_date) AS z, date_diff('day', min(filed_date), max(filed_date)) AS days FROM tr),
 k AS (SELECT * FROM (VALUES ('s1-large', 120, 50, 0), ('s2-first', 400, 1, 365), ('s3-cooccurrence', 20, 0, 0), ('s4-infrequent', 60, 1, 365), ('s5-jurisdiction', NULL, NULL, NULL), ('s6-late-large', 40, 10, 0)) v(kind, most, least, needs)),
 g AS (SELECT kind, count(*) AS total, count(*) FILTER ("at" > z - 90) AS r FROM w, sp GROUP BY ALL),
 x AS (SELECT k.*, days, coalesce(total, 0) AS total, round(coalesce(r, 0) * 30 / 90, 4) AS busiest FROM k CROSS JOIN sp LEFT JOIN g USING (kind))
 SELECT kind, total, busiest, CASE WHEN most IS NULL THEN 'inputs-not-in-build' WHEN days < needs THEN 'insufficient-history' WHEN busiest > most OR total < least THEN 'volume-out-of-bounds' END AS withheld FROM x""",
    "scalar_holdings": _IV + r"""SELECT row_id, cik, CASE WHEN security_id IS NOT NULL THEN 'sid:' || security_id WHEN cusip IS NOT NULL THEN 'cusip:' || cusip END AS key,
 CASE WHEN put_call IN ('PUT', 'CALL') THEN put_call ELSE 'LONG' END AS bucket, CASE WHEN ssh_type IN ('SH', 'PRN') THEN ssh_type ELSE 'UNKNOWN' END AS unit,
 CASE WHEN length(cusip) >= 6 THEN 'cusip6:' || cusip[1:6] ELSE 'name:' || upper(trim(regexp_replace(issuer_name, '\s+', ' ', 'g'))) END AS issuer_key,
 CASE WHEN regexp_full_match(cusip, '[0-9A-Z]{8}[0-9]') THEN (10 - list_sum(list_transform(generate_series(1, 8), lambda i: list_sum(list_transform([(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substring(cusip, CAST(i AS INTEGER), 1)) - 1) * (CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END)], lambda v: v // 10 + v % 10)))) % 10) % 10 = CAST(cusip[9] AS INTEGER) END AS check_ok,
 to_json(list_sort(list_distinct(from_json(flags, '["VARCHAR"]'))))::VARCHAR AS flags, list_contains(from_json(flags, '["VARCHAR"]'), 'unmapped_security') AS unmapped, CAST(CAST(value_usd AS HUGEINT) * 10000 // 1000000000 AS BIGINT) AS bps FROM r""",
    "scalar_trades": _T + f"""SELECT txn_id, date_diff('day', transaction_date, filed_date) AS days, date_diff('day', transaction_date, filed_date) > 45 AS late, filed_date < transaction_date AS anomaly,
 year(filed_date) || 'q' || quarter(filed_date) AS quarter, CAST(last_day(date_trunc('quarter', filed_date) + INTERVAL 2 MONTH) + 45 AS DATE) AS deadline, {_LABEL} AS label,
 CASE WHEN {_LABEL} IS NOT NULL THEN amount_low END AS low, CASE WHEN {_LABEL} IS NOT NULL THEN amount_high END AS high,
 CASE WHEN amount_low IS NULL AND amount_high IS NULL THEN NULL WHEN amount_high IS NULL THEN 'Over ' || {_LO} WHEN amount_low IS NULL THEN 'Under ' || {_HI} ELSE {_LO} || '–' || {_HI} END AS text,
 round(least(1.0, greatest(0.0, (log10(greatest(amount_low, 1)) - 3.0) / 4.698970004336019)), 6) AS band,
 CASE WHEN trim(ticker) NOT IN ('', '--') THEN upper(trim(ticker)) END AS ticker, CASE WHEN side IN ('purchase', 'exchange') THEN side ELSE 'other' END AS side,
 CASE lower(owner) WHEN 'sp' THEN 'spouse' WHEN 'spouse' THEN 'spouse' WHEN 'dc' THEN 'child' WHEN 'child' THEN 'child' WHEN 'jt' THEN 'joint' WHEN 'joint' THEN 'joint' WHEN 'self' THEN 'self' END AS owner,
 transaction_date AS parsed_date FROM tx""",
    "scalar_filings": r"""SELECT filing_key, CASE WHEN regexp_full_match(trim(file_number_norm), '0*[0-9]+-0*[0-9]+') THEN lpad(regexp_extract(trim(file_number_norm), '^0*([0-9]+)-0*([0-9]+)$', 1), 3, '0') || '-' || regexp_extract(trim(file_number_norm), '^0*([0-9]+)-0*([0-9]+)$', 2) END AS file_number,
 CASE WHEN filed_date >= DATE '2023-01-03' THEN 1 WHEN filed_date IS NOT NULL THEN 1000 END AS multiplier, CASE WHEN table_value_total_usd IS NOT NULL THEN greatest(1000, table_value_total_usd // 1000) END AS tolerance, filed_date AS filed,
 len(other_managers) AS managers, CAST(last_day(date_trunc('quarter', period_of_report) + INTERVAL 2 MONTH) AS DATE) AS quarter_end FROM inst_filings""",
    "scalar_members": """SELECT bioguide_id, CASE WHEN party LIKE 'D%' THEN 'D' WHEN party LIKE 'R%' THEN 'R' WHEN party LIKE 'I%' THEN 'I' ELSE '' END AS code,
 list_min(list_transform(terms, lambda t: t.start)) AS since, strlen(full_name) AS bytes FROM members""",
}
