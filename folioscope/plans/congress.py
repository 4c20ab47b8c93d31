"""Questions about disclosed trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..operators import populations as P, ranges as R
from ..sources import table


def trades(spark: SparkSession, d: str) -> DataFrame:
    """The canonical projection over the default population."""
    f = P.once(table(spark, d, "filings"), "filing_id")
    t = P.default_transactions(P.once(table(spark, d, "transactions"), "txn_id"), f)
    m = table(spark, d, "members").select("bioguide_id", F.col("full_name").alias("member"), "party", "state", "district")
    return t.join(f.select("filing_id", "doc_url", "parse_status", "filer_name_raw"), "filing_id").join(m, "bioguide_id", "left")


TRADE = ["txn_id", "filing_id", "bioguide_id", "member", "party", "state", "chamber", "owner", "ticker", "side", "transaction_date", "filed_date", "amount_low", "amount_high"]



def by_recency() -> list[Column]:
    return [F.col("filed_date").desc_nulls_last(), F.col("transaction_date").desc_nulls_last(), F.col("txn_id").asc()]


def recent_trades(
    rows: DataFrame, since=None, until=None, chamber: str | None = None, party: str | None = None, state: str | None = None, side: str | None = None,
    ticker: str | None = None, member: str | None = None, min_amount: int | None = None, limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """Trades under all given conditions, newest first."""
    for c, v in (("chamber", chamber), ("party", party), ("state", state), ("side", side), ("ticker", ticker), ("bioguide_id", member)):
        if v is not None:
            rows = rows.filter(F.col(c) == v)
    if since is not None:
        rows = rows.filter(F.col("filed_date") >= since)
    if until is not None:
        rows = rows.filter(F.col("filed_date") <= until)
    if min_amount is not None:
        rows = rows.filter(R.reaches(F.col("amount_low"), F.col("amount_high"), min_amount))
    rows = rows.orderBy(*by_recency())
    return rows.offset(offset).limit(limit) if limit is not None else rows


def biggest_trades(rows: DataFrame, limit: int, since=None, side: str | None = None) -> DataFrame:
    """Open-ended amounts first, then by upper end."""
    rows = since_and_side(rows, since, side)
    is_open = R.open_ended(F.col("amount_low"), F.col("amount_high"))
    return rows.orderBy(is_open.desc(), F.col("amount_high").desc_nulls_last(), F.col("filed_date").desc_nulls_last(), "txn_id").limit(limit)


def flow(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    lo, hi = F.col("amount_low"), F.col("amount_high")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trades"), F.countDistinct("bioguide_id").alias("members"),
        F.count_if(F.col("side") == "purchase").alias("purchases"), F.count_if(F.col("side").startswith("sale")).alias("sales"),
        F.min(lo).alias("min_low"), F.max(hi).alias("max_high"),
        F.max(R.open_ended(lo, hi).cast("int")).alias("any_open_ended"),
    )


def since_and_side(rows: DataFrame, since=None, side: str | None = None) -> DataFrame:
    rows = rows if since is None else rows.filter(F.col("filed_date") >= since)
    return rows if side is None else rows.filter(F.col("side") == side)


def top_tickers(rows: DataFrame, limit: int, since=None, side: str | None = None) -> DataFrame:
    """Most trades first, then ticker."""
    rows = since_and_side(rows, since, side).filter(F.col("ticker").isNotNull())
    return flow(rows, ["ticker"]).orderBy(F.desc("trades"), "ticker").limit(limit)


def q_recent(spark, d):
    return recent_trades(trades(spark, d), since="2020-01-01", chamber="house", side="purchase", min_amount=50_000, limit=200).select(*TRADE)


def q_canonical(spark, d):
    return trades(spark, d).select(*TRADE)


def q_default_population(spark, d):
    return P.default_transactions(P.once(table(spark, d, "transactions"), "txn_id"), table(spark, d, "filings")).select("txn_id", "filing_id")


def q_biggest(spark, d):
    return biggest_trades(trades(spark, d), 100).select("txn_id", "amount_low", "amount_high", "filed_date")


def q_top_tickers(spark, d):
    return top_tickers(trades(spark, d), 50)


def q_top_bought(spark, d):
    return top_tickers(trades(spark, d), 50, since="2018-01-01", side="purchase")


def q_member_flows(spark, d):
    return flow(trades(spark, d).filter(F.col("bioguide_id").isNotNull()), ["bioguide_id", "ticker"]).drop("members")


def q_party_side(spark, d):
    return trades(spark, d).groupBy("ticker", "party", "side").agg(F.count(F.lit(1)).alias("trades"))


def q_verdicts(spark, d):
    lo, hi = F.col("amount_low"), F.col("amount_high")
    v = R.verdict(lo, hi, 50_000)
    return trades(spark, d).groupBy("chamber", v.alias("verdict"), R.open_ended(lo, hi).alias("open_ended")).agg(F.count(F.lit(1)).alias("n"))


def q_date_windows(spark, d):
    """Filed or traded window with anomalies and undated trades counted apart."""
    t = trades(spark, d)
    traded, filed = F.col("transaction_date"), F.col("filed_date")
    state = (
        F.when(traded.isNull(), "undated").when(filed < traded, "anomaly")
        .when(traded.between(F.lit("2018-01-01").cast("date"), F.lit("2022-12-31").cast("date")), "in").otherwise("out")
    )
    return t.groupBy("chamber", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def q_members_search(spark, d):
    """Members whose name holds the text, any case; % and _ mean themselves."""
    return table(spark, d, "members").filter(F.lower("full_name").contains("kenn")).select("bioguide_id", "full_name", "chamber", "party", "state").orderBy("full_name", "bioguide_id")


def q_latest_filings(spark, d):
    f = P.once(table(spark, d, "filings"), "filing_id").withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))
    f = f.filter((F.col("lifecycle") == "active") & (F.col("ingested_at") >= F.lit("2024-01-01").cast("timestamp_ntz")))
    return f.select("filing_id", "chamber", "filed_date", "parse_status", "row_count").orderBy(F.desc("filed_date"), "filing_id")


def q_range_sums(spark, d):
    t = trades(spark, d).filter(F.col("bioguide_id").isNotNull())
    g = t.groupBy("bioguide_id", "side").agg(R.range_sum(F.col("amount_low"), F.col("amount_high")).alias("r"))
    return g.select("bioguide_id", "side", F.col("r.kind").alias("kind"), F.col("r.low").alias("low"), F.col("r.high").alias("high"))


def net_flows(t: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net interval per group: purchases less sales, others counted apart."""
    lo, hi = F.col("amount_low"), F.col("amount_high")

    def part(p: Column) -> Column:
        floor = F.when(lo % 1000 == 1, lo - 1).otherwise(lo)
        n, known, unb = F.count_if(p), F.count_if(p & (lo.isNotNull() | hi.isNotNull())), F.count_if(p & hi.isNull())
        low, high = F.sum(F.when(p, floor.cast(R.WIDE))), F.sum(F.when(p, hi.cast(R.WIDE)))
        kind = F.when(n == 0, "empty").when(known == 0, "undisclosed").when(unb > 0, "open").otherwise("closed")
        return F.struct(kind.alias("kind"), F.coalesce(low, F.lit(0).cast(R.WIDE)).cast("long").alias("low"), F.when(unb == 0, high.cast("long")).alias("high"))

    buys, sales = F.col("side") == "purchase", F.col("side").startswith("sale")
    g = t.groupBy(*keys).agg(part(buys).alias("b"), part(sales).alias("s"), F.count_if(~F.coalesce(buys | sales, F.lit(False))).alias("others"))
    return g.withColumn("net", R.net(F.col("b"), F.col("s")))


def q_net_by_ticker(spark, d):
    t = trades(spark, d).filter(F.col("ticker").isNotNull())
    return net_flows(t, ["ticker"]).select("ticker", F.col("net.kind").alias("kind"), F.col("net.low").alias("low"), F.col("net.high").alias("high"), "others")


SIDES = ["purchase", "sale", "sale_partial", "exchange", "other"]


def quarterly_flow(t: DataFrame) -> DataFrame:
    """(state, quarter, side, n, kind, low, high): trades and their range sum per quarter,
    over every quarter from the first to the last dated trade, those without any too;
    anomalous and undated trades are counted without a quarter."""
    traded = F.col("transaction_date")
    state = F.when(traded.isNull(), "undated").when(F.col("filed_date") < traded, "anomaly").otherwise("dated")
    rows = t.withColumn("state", state).withColumn("quarter", F.when(F.col("state") == "dated", F.trunc("transaction_date", "quarter")))
    rows = rows.withColumn("side", F.when(F.col("side").isin(SIDES), F.col("side")).otherwise("other"))
    got = rows.groupBy("state", "quarter", "side").agg(F.count(F.lit(1)).alias("n"), R.range_sum(F.col("amount_low"), F.col("amount_high")).alias("r"))
    span = rows.agg(F.min("quarter").alias("a"), F.max("quarter").alias("z")).filter(F.col("a").isNotNull())
    every = span.select(F.explode(F.expr("sequence(a, z, interval 3 months)")).alias("quarter"), F.lit("dated").alias("state"))
    every = every.withColumn("side", F.explode(F.array(*[F.lit(x) for x in SIDES])))
    keys = ["state", "quarter", "side"]
    told = got.filter(F.col("quarter").isNull()).unionByName(every.join(got, keys, "left").select(*keys, "n", "r"))
    return told.select(*keys, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("r.kind", F.lit("empty")).alias("kind"), F.col("r.low").alias("low"), F.col("r.high").alias("high"))


def q_quarterly_flow(spark, d):
    return quarterly_flow(trades(spark, d))


def q_habits(spark, d):
    t = trades(spark, d).filter(F.col("bioguide_id").isNotNull())
    return t.groupBy("bioguide_id").agg(
        F.count(F.lit(1)).alias("trades"), F.countDistinct("ticker").alias("tickers"), F.percentile("days_to_file", 0.5).alias("median_days"),
        F.count_if(F.col("is_late")).alias("late"), F.count(F.col("is_late")).alias("datable"),
    )


def disclosure_rankings(t: DataFrame, months: int) -> DataFrame:
    """Who disclosed most in the months up to the newest filing, by traded or else filed
    date, anomalies left out; filers not joined stand under their printed name."""
    at = F.coalesce("transaction_date", "filed_date")
    until = t.agg(F.max("filed_date").alias("m")).scalar()
    ok = ~F.coalesce(F.col("filed_date") < F.col("transaction_date"), F.lit(False)) & (at > F.add_months(until, -months)) & (at <= until)
    key = F.coalesce("bioguide_id", F.concat(F.lit("raw:"), F.col("filer_name_raw")))
    return t.filter(ok).groupBy(key.alias("filer")).agg(F.count(F.lit(1)).alias("trades"), F.count_if("is_late").alias("late"), F.count("is_late").alias("datable"))


def q_rankings(spark, d):
    return disclosure_rankings(trades(spark, d), 12)


def q_ticker_rankings(spark, d):
    """Tickers by members disclosing in the 24 months up to the newest filing."""
    t = trades(spark, d)
    until = t.agg(F.max("filed_date").alias("m")).scalar()
    at = F.coalesce("transaction_date", "filed_date")
    ok = F.col("ticker").isNotNull() & ~F.coalesce(F.col("filed_date") < F.col("transaction_date"), F.lit(False)) & (at > F.add_months(until, -24)) & (at <= until)
    return t.filter(ok).groupBy("ticker").agg(F.count(F.lit(1)).alias("trades"), F.countDistinct("bioguide_id").alias("members"))


def q_stats(spark, d):
    """Rows, late rate and median delay by era and chamber."""
    t = trades(spark, d)
    return t.groupBy("chamber", F.year("filed_date").alias("era")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("transaction_date").alias("dated"), F.count_if("is_late").alias("late"),
        F.percentile("days_to_file", 0.5).alias("median_days"), F.count("bioguide_id").alias("joined"),
    )


def q_parse_gate(spark, d):
    """Share of filings parsed per chamber and year, against 97 percent."""
    f = P.once(table(spark, d, "filings"), "filing_id").filter(F.col("lifecycle") == "active")
    g = f.groupBy("chamber", F.year("filed_date").alias("year")).agg(
        F.count(F.lit(1)).alias("filings"), F.count_if(F.col("parse_status") == "parsed").alias("parsed"), F.count_if(F.col("parse_status") == "needs_ocr").alias("paper")
    )
    e = F.col("filings") - F.col("paper")
    status = F.when(e == 0, "no_efile_filings").when(F.col("parsed") * 100 >= e * 97, "pass").otherwise("miss")
    return g.withColumn("status", status)


def q_join_coverage(spark, d):
    f = P.once(table(spark, d, "filings"), "filing_id")
    return f.groupBy(F.year("filed_date").alias("era")).agg(
        F.count(F.lit(1)).alias("filings"), F.count("bioguide_id").alias("joined"),
        F.countDistinct(F.when(F.col("bioguide_id").isNull(), F.col("filer_name_raw"))).alias("unresolved_names"),
    )


def q_pairs(spark, d):
    return P.amendment_pairs(P.once(table(spark, d, "filings"), "filing_id"))


def q_pair_violations(spark, d):
    """Every amendment that names an original, with what is wrong about the pair."""
    f = P.once(table(spark, d, "filings"), "filing_id")
    bad = P.pair_violations(f)
    return f.filter(F.col("supersedes").isNotNull()).select("filing_id", "supersedes").join(bad.select("filing_id", "violation"), "filing_id", "left").select("filing_id", "supersedes", F.coalesce("violation", F.lit("none")).alias("violation"))


def q_orphans(spark, d):
    """Per check how many references were looked up and how many led nowhere."""
    t = P.once(table(spark, d, "transactions"), "txn_id")
    f = table(spark, d, "filings").select("filing_id", F.lit(1).alias("hit")).distinct()
    m = table(spark, d, "members").select("bioguide_id", F.lit(1).alias("hit"))
    def check(rows, target, key, name):
        j = rows.filter(F.col(key).isNotNull()).select(key).join(target, key, "left")
        return j.agg(F.count(F.lit(1)).alias("looked_up"), F.count_if(F.col("hit").isNull()).alias("missing")).select(F.lit(name).alias("check"), "looked_up", "missing")
    fl = P.once(table(spark, d, "filings"), "filing_id")
    return check(t, f, "filing_id", "trade_filing").unionByName(check(t, m, "bioguide_id", "trade_member")).unionByName(check(fl, m, "bioguide_id", "filing_member"))


#: Newest trades a member or ticker is given in feeds.
SLICE_ROWS = 200


def feed_slices(t: DataFrame, most: int = SLICE_ROWS) -> DataFrame:
    """The newest trades of every member, and of every ticker, in one pass each."""
    def top(c):
        w = W.partitionBy(c).orderBy(*by_recency())
        return t.filter(F.col(c).isNotNull()).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select(F.lit(c).alias("kind"), F.col(c).alias("entity"), "rank", "txn_id")
    return top("bioguide_id").unionByName(top("ticker"))


def q_feed_slices(spark, d):
    return feed_slices(trades(spark, d))


def q_dup_seq(spark, d):
    """Sequence of equal rows within a filing: fingerprint, number, id."""
    from ..functions.normalize import record_id, row_fingerprint

    t = P.once(table(spark, d, "transactions"), "txn_id")
    cols = {c: F.col(c).cast("string") for c in ("ticker", "asset_name", "side", "transaction_date")}
    fp = t.withColumn("fp", row_fingerprint(cols))
    seq = F.row_number().over(W.partitionBy("filing_id", "fp").orderBy("txn_id"))
    n = fp.withColumn("dup_seq", seq).withColumn("fp32", F.substring("fp", 1, 32))
    return n.select("txn_id", "fp32", "dup_seq", record_id(F.col("filing_id"), F.col("fp32"), F.col("dup_seq")).alias("built_id"))


QUERIES = {
    "recent_trades": q_recent, "canonical_trades": q_canonical, "default_population": q_default_population, "biggest_trades": q_biggest,
    "top_tickers": q_top_tickers, "member_flows": q_member_flows, "party_side_breakdown": q_party_side, "amount_verdicts": q_verdicts,
    "date_windows": q_date_windows, "member_search": q_members_search, "latest_filings": q_latest_filings, "range_sums": q_range_sums,
    "net_by_ticker": q_net_by_ticker, "quarterly_flow": q_quarterly_flow, "habit_summary": q_habits, "disclosure_rankings": q_rankings,
    "era_stats": q_stats, "parse_gate": q_parse_gate, "join_coverage": q_join_coverage, "amendment_pairs": q_pairs,
    "pair_violations": q_pair_violations, "orphans": q_orphans, "feed_slices": q_feed_slices, "top_bought": q_top_bought, "ticker_rankings": q_ticker_rankings, "dup_seq": q_dup_seq,
}

_T = """
WITH fl AS (SELECT DISTINCT * FROM filings), ac AS (SELECT * FROM fl WHERE lifecycle = 'active'),
tx AS (SELECT DISTINCT ON (txn_id) * FROM transactions),
tr AS (
  SELECT t.*, m.full_name AS member, m.party, m.state, f.filer_name_raw
  FROM tx t JOIN ac f USING (filing_id) LEFT JOIN members m ON m.bioguide_id = t.bioguide_id
  WHERE NOT EXISTS (SELECT 1 FROM ac a WHERE a.supersedes = f.filing_id)
)
"""
_C = "txn_id, filing_id, bioguide_id, member, party, state, chamber, owner, ticker, side, transaction_date, filed_date, amount_low, amount_high"
_FLOW = """count(*) AS trades, count(DISTINCT bioguide_id) AS members, count(*) FILTER (side = 'purchase') AS purchases,
 count(*) FILTER (side LIKE 'sale%') AS sales, min(amount_low) AS min_low, max(amount_high) AS max_high,
 max(CASE WHEN amount_low IS NOT NULL AND amount_high IS NULL THEN 1 ELSE 0 END) AS any_open_ended"""
_FLOOR = "CASE WHEN amount_low % 1000 = 1 THEN amount_low - 1 ELSE amount_low END"

SQL = {
    "recent_trades": _T + f"""SELECT {_C} FROM tr WHERE filed_date >= DATE '2020-01-01' AND chamber = 'house' AND side = 'purchase'
 AND (amount_high >= 50000 OR (amount_low IS NOT NULL AND amount_high IS NULL))
 ORDER BY filed_date DESC NULLS LAST, transaction_date DESC NULLS LAST, txn_id LIMIT 200""",
    "canonical_trades": _T + f"SELECT {_C} FROM tr",
    "default_population": _T + "SELECT txn_id, filing_id FROM tr",
    "biggest_trades": _T + """SELECT txn_id, amount_low, amount_high, filed_date FROM tr
 ORDER BY (amount_low IS NOT NULL AND amount_high IS NULL) DESC, amount_high DESC NULLS LAST, filed_date DESC NULLS LAST, txn_id LIMIT 100""",
    "top_tickers": _T + f"SELECT ticker, {_FLOW} FROM tr WHERE ticker IS NOT NULL GROUP BY ticker ORDER BY trades DESC, ticker LIMIT 50",
    "top_bought": _T + f"SELECT ticker, {_FLOW} FROM tr WHERE ticker IS NOT NULL AND filed_date >= DATE '2018-01-01' AND side = 'purchase' GROUP BY ticker ORDER BY trades DESC, ticker LIMIT 50",
    "member_flows": _T + f"SELECT * EXCLUDE (members) FROM (SELECT bioguide_id, ticker, {_FLOW} FROM tr WHERE bioguide_id IS NOT NULL GROUP BY ALL)",
    "party_side_breakdown": _T + "SELECT ticker, party, side, count(*) AS trades FROM tr GROUP BY ALL",
    "amount_verdicts": _T + """SELECT chamber, CASE WHEN amount_low > 50000 THEN 'in' WHEN amount_high <= 50000 THEN 'out' ELSE 'indeterminate' END AS verdict,
 (amount_low IS NOT NULL AND amount_high IS NULL) AS open_ended, count(*) AS n FROM tr GROUP BY ALL""",
    "date_windows": _T + """SELECT chamber, CASE WHEN transaction_date IS NULL THEN 'undated' WHEN filed_date < transaction_date THEN 'anomaly'
 WHEN transaction_date BETWEEN DATE '2018-01-01' AND DATE '2022-12-31' THEN 'in' ELSE 'out' END AS state, count(*) AS n FROM tr GROUP BY ALL""",
    "member_search": "SELECT bioguide_id, full_name, chamber, party, state FROM members WHERE contains(lower(full_name), 'kenn')",
    "latest_filings": _T + "SELECT filing_id, chamber, filed_date, parse_status, row_count FROM ac WHERE ingested_at >= TIMESTAMP '2024-01-01'",
    "range_sums": _T + f"""SELECT bioguide_id, side,
 CASE WHEN count(coalesce(amount_low, amount_high)) = 0 THEN 'undisclosed' WHEN count(*) > count(amount_high) THEN 'open' ELSE 'closed' END AS kind,
 CASE WHEN count(coalesce(amount_low, amount_high)) > 0 THEN CAST(coalesce(sum({_FLOOR}), 0) AS BIGINT) END AS low,
 CASE WHEN count(*) = count(amount_high) THEN CAST(sum(amount_high) AS BIGINT) END AS high
 FROM tr WHERE bioguide_id IS NOT NULL GROUP BY ALL""",
    "net_by_ticker": _T + f""", g AS (
 SELECT ticker, count(*) FILTER (side = 'purchase') AS bn, count(coalesce(amount_low, amount_high)) FILTER (side = 'purchase') AS bk,
  count(*) FILTER (side = 'purchase' AND amount_high IS NULL) AS bo, coalesce(sum({_FLOOR}) FILTER (side = 'purchase'), 0) AS bl, coalesce(sum(amount_high) FILTER (side = 'purchase'), 0) AS bh,
  count(*) FILTER (side LIKE 'sale%') AS sn, count(coalesce(amount_low, amount_high)) FILTER (side LIKE 'sale%') AS sk,
  count(*) FILTER (side LIKE 'sale%' AND amount_high IS NULL) AS so, coalesce(sum({_FLOOR}) FILTER (side LIKE 'sale%'), 0) AS sl, coalesce(sum(amount_high) FILTER (side LIKE 'sale%'), 0) AS sh,
  count(*) FILTER (NOT coalesce(side = 'purchase' OR side LIKE 'sale%', false)) AS others FROM tr WHERE ticker IS NOT NULL GROUP BY ticker
), k AS (SELECT *, (bn > 0 AND bk = 0) OR (sn > 0 AND sk = 0) AS un, bn = 0 AND sn = 0 AS em FROM g)
 SELECT ticker, others, CASE WHEN un THEN 'undisclosed' WHEN em THEN 'empty' WHEN so = 0 AND bo = 0 THEN 'finite' WHEN bo = 0 THEN 'lower_open' WHEN so = 0 THEN 'upper_open' ELSE 'unbounded' END AS kind,
  CASE WHEN NOT un AND NOT em AND so = 0 THEN CAST(bl - sh AS BIGINT) END AS low, CASE WHEN NOT un AND NOT em AND bo = 0 THEN CAST(bh - sl AS BIGINT) END AS high FROM k""",
    "quarterly_flow": _T + f""", k AS (SELECT *, CASE WHEN transaction_date IS NULL THEN 'undated' WHEN filed_date < transaction_date THEN 'anomaly' ELSE 'dated' END AS st,
  CASE WHEN side IN ('purchase', 'sale', 'sale_partial', 'exchange') THEN side ELSE 'other' END AS sd FROM tr),
 g AS (SELECT st, CASE WHEN st = 'dated' THEN CAST(date_trunc('quarter', transaction_date) AS DATE) END AS quarter, sd AS side, count(*) AS n,
  CASE WHEN count(coalesce(amount_low, amount_high)) = 0 THEN 'undisclosed' WHEN count(*) > count(amount_high) THEN 'open' ELSE 'closed' END AS kind,
  CASE WHEN count(coalesce(amount_low, amount_high)) > 0 THEN CAST(coalesce(sum({_FLOOR}), 0) AS BIGINT) END AS low, CASE WHEN count(*) = count(amount_high) THEN CAST(sum(amount_high) AS BIGINT) END AS high FROM k GROUP BY ALL),
 cal AS (SELECT CAST(unnest(generate_series(min(quarter), max(quarter), INTERVAL 3 MONTH)) AS DATE) AS quarter FROM g), s AS (SELECT unnest(['purchase', 'sale', 'sale_partial', 'exchange', 'other']) AS side)
 SELECT st AS state, quarter, side, n, kind, low, high FROM g WHERE quarter IS NULL UNION ALL
 SELECT 'dated', cal.quarter, s.side, coalesce(n, 0), coalesce(kind, 'empty'), low, high FROM cal CROSS JOIN s LEFT JOIN g ON g.quarter = cal.quarter AND g.side = s.side""",
    "habit_summary": _T + """SELECT bioguide_id, count(*) AS trades, count(DISTINCT ticker) AS tickers, median(days_to_file) AS median_days,
 count(*) FILTER (is_late) AS late, count(is_late) AS datable FROM tr WHERE bioguide_id IS NOT NULL GROUP BY ALL""",
    "disclosure_rankings": _T + """, u AS (SELECT max(filed_date) AS z FROM tr) SELECT coalesce(bioguide_id, 'raw:' || filer_name_raw) AS filer, count(*) AS trades, count(*) FILTER (is_late) AS late, count(is_late) AS datable FROM tr, u
 WHERE NOT coalesce(filed_date < transaction_date, false) AND coalesce(transaction_date, filed_date) > z - INTERVAL 12 MONTH AND coalesce(transaction_date, filed_date) <= z GROUP BY 1""",
    "ticker_rankings": _T + """, u AS (SELECT max(filed_date) AS z FROM tr) SELECT ticker, count(*) AS trades, count(DISTINCT bioguide_id) AS members FROM tr, u WHERE ticker IS NOT NULL
 AND NOT coalesce(filed_date < transaction_date, false) AND coalesce(transaction_date, filed_date) > z - INTERVAL 24 MONTH AND coalesce(transaction_date, filed_date) <= z GROUP BY 1""",
    "era_stats": _T + """SELECT chamber, year(filed_date) AS era, count(*) AS rows, count(transaction_date) AS dated, count(*) FILTER (is_late) AS late,
 median(days_to_file) AS median_days, count(bioguide_id) AS joined FROM tr GROUP BY ALL""",
    "parse_gate": _T + """SELECT *, CASE WHEN filings = paper THEN 'no_efile_filings' WHEN parsed * 100 >= (filings - paper) * 97 THEN 'pass' ELSE 'miss' END AS status FROM (
 SELECT chamber, year(filed_date) AS year, count(*) AS filings, count(*) FILTER (parse_status = 'parsed') AS parsed, count(*) FILTER (parse_status = 'needs_ocr') AS paper FROM ac GROUP BY ALL)""",
    "join_coverage": _T + """SELECT year(filed_date) AS era, count(*) AS filings, count(bioguide_id) AS joined,
 count(DISTINCT CASE WHEN bioguide_id IS NULL THEN filer_name_raw END) AS unresolved_names FROM fl GROUP BY ALL""",
    "amendment_pairs": _T + """SELECT a.filing_id AS amendment_filing_id, a.chamber, a.filed_date AS amendment_filed_date, a.lifecycle AS amendment_lifecycle,
 o.filing_id AS original_filing_id, o.filed_date AS original_filed_date, o.lifecycle AS original_lifecycle FROM fl a JOIN fl o ON o.filing_id = a.supersedes""",
    "pair_violations": _T + """SELECT a.filing_id, a.supersedes, CASE WHEN a.supersedes = a.filing_id THEN 'self_reference' WHEN o.filing_id IS NULL THEN 'missing_original'
 WHEN o.chamber <> a.chamber THEN 'chamber_mismatch' WHEN o.filed_date > a.filed_date THEN 'filed_before_original' ELSE 'none' END AS violation
 FROM fl a LEFT JOIN fl o ON o.filing_id = a.supersedes WHERE a.supersedes IS NOT NULL""",
    "orphans": _T + """SELECT 'trade_filing' AS "check", count(*) AS looked_up, count(*) FILTER (filing_id NOT IN (SELECT filing_id FROM fl)) AS missing FROM tx WHERE filing_id IS NOT NULL
 UNION ALL SELECT 'trade_member', count(*), count(*) FILTER (bioguide_id NOT IN (SELECT bioguide_id FROM members)) FROM tx WHERE bioguide_id IS NOT NULL
 UNION ALL SELECT 'filing_member', count(*), count(*) FILTER (bioguide_id NOT IN (SELECT bioguide_id FROM members)) FROM fl WHERE bioguide_id IS NOT NULL""",
    "feed_slices": _T + """, k AS (SELECT 'bioguide_id' AS kind, bioguide_id AS entity, * FROM tr WHERE bioguide_id IS NOT NULL UNION ALL SELECT 'ticker', ticker, * FROM tr WHERE ticker IS NOT NULL)
 SELECT kind, entity, rank, txn_id FROM (SELECT kind, entity, txn_id, row_number() OVER (PARTITION BY kind, entity ORDER BY filed_date DESC NULLS LAST, transaction_date DESC NULLS LAST, txn_id) AS rank FROM k) WHERE rank <= 200""",
    "dup_seq": _T + """, f AS (SELECT *, sha256('{"asset_name":' || coalesce(to_json(asset_name)::VARCHAR, 'null') || ',"side":' || coalesce(to_json(side)::VARCHAR, 'null') || ',"ticker":' || coalesce(to_json(ticker)::VARCHAR, 'null')
 || ',"transaction_date":' || coalesce(to_json(transaction_date::VARCHAR)::VARCHAR, 'null') || '}') AS fp FROM tx), n AS (SELECT *, row_number() OVER (PARTITION BY filing_id, fp ORDER BY txn_id) AS dup_seq FROM f)
 SELECT txn_id, fp[1:32] AS fp32, dup_seq, filing_id || ':' || fp[1:32] || CASE WHEN dup_seq > 1 THEN '#' || dup_seq ELSE '' END AS built_id FROM n""",
}
