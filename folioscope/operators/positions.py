"""Positions of a filer, their change from quarter to quarter, holders and concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

WIDE = "decimal(38,0)"
GRAIN = ["cik", "period", "position_key", "put_call_bucket", "unit_key"]


def exact_sum(c: str) -> Column:
    return F.sum(F.col(c).cast(WIDE)).cast("long")


def fold_positions(rows: DataFrame) -> DataFrame:
    """Rows to positions: the value is null if no part discloses one, shares if any part
    doesn't, the CUSIP if there are several."""
    one = (F.count("cusip") == F.count(F.lit(1))) & (F.min("cusip") == F.max("cusip"))
    return rows.filter(F.col("position_key").isNotNull()).groupBy(*GRAIN).agg(
        exact_sum("value_usd").alias("value"),
        F.when(F.count("shares") == F.count(F.lit(1)), exact_sum("shares")).alias("shares"),
        F.when(one, F.min("cusip")).alias("cusip"),
    )


def display_positions(rows: DataFrame) -> DataFrame:
    """As a page shows them: a value or share count with an undisclosed part is null;
    flags and filings united."""
    known = lambda c: F.when(F.count(c) == F.count(F.lit(1)), exact_sum(c))
    flags = F.from_json("flags", "array<string>")
    return rows.filter(F.col("position_key").isNotNull()).groupBy(*GRAIN).agg(
        known("value_usd").alias("value"), known("shares").alias("shares"),
        F.to_json(F.array_sort(F.array_distinct(F.flatten(F.collect_set(flags))))).alias("flags"),
        F.count(F.lit(1)).alias("parts"),
    )


def period_calendar(periods: DataFrame) -> DataFrame:
    """(cik, period, prev_period, next_period) among the periods a filer filed for, also
    those whose filings hold no position: such a quarter parts its neighbours."""
    w = W.partitionBy("cik").orderBy("period")
    return periods.select("cik", "period").dropna().distinct().select("cik", "period", F.lag("period").over(w).alias("prev_period"), F.lead("period").over(w).alias("next_period"))


def qoq_deltas(positions: DataFrame, periods: DataFrame) -> DataFrame:
    """Position changes between a filer's consecutive periods, those of ``periods``.

    Matched in three passes: by the full grain; what is left by key and bucket where
    both sides are unique (the unit changed); what is left by CUSIP and bucket where
    both sides are unique and exactly one is a resolved security (the key changed).
    The rest is new or gone.  Every position is put once on the current side of its
    period and once on the preceding side of the next.  The first two passes are one
    aggregation, which holds the few units of a key; only what it leaves is shuffled
    again for the third, where rows without a CUSIP stand alone.

    Values of undisclosed positions are null, never zero; a missing position counts as
    zero.  Direction is by shares where units agree, else by value (flagged), else
    unclassified."""
    x = F.struct("position_key", "unit_key", "value", "shares", "cusip")
    now = F.when(F.col("prev_period").isNotNull(), F.struct("period", "prev_period", F.lit(True).alias("now")))
    then = F.when(F.col("next_period").isNotNull(), F.struct(F.col("next_period").alias("period"), F.col("period").alias("prev_period"), F.lit(False).alias("now")))
    sides = (
        positions.join(period_calendar(periods), ["cik", "period"])
        .select("cik", "position_key", "put_call_bucket", x.alias("x"), F.explode(F.array_compact(F.array(now, then))).alias("s"))
        .select("cik", "s.*", "position_key", "put_call_bucket", "x")
    )
    pair = ["cik", "period", "prev_period"]
    kept = sides.groupBy(*pair, "put_call_bucket", "position_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("now"), F.col("x")))).alias("cs"), F.array_sort(F.collect_list(F.when(~F.col("now"), F.col("x")))).alias("ps")
    )
    none = F.lit(None).cast(sides.schema["x"].dataType)
    both = lambda c, p: F.struct(c.alias("c"), p.alias("p"))
    has = lambda side, e: F.exists(side, lambda o: o["unit_key"] == e["unit_key"])
    same = F.transform(F.filter("cs", lambda c: has("ps", c)), lambda c: both(c, F.get(F.filter("ps", lambda p: p["unit_key"] == c["unit_key"]), F.lit(0))))
    kept = kept.select(*pair, "put_call_bucket", same.alias("same"), F.filter("cs", lambda c: ~has("ps", c)).alias("lc"), F.filter("ps", lambda p: ~has("cs", p)).alias("lp"))
    changed = F.when((F.size("lc") == 1) & (F.size("lp") == 1), F.array(both(F.get("lc", F.lit(0)), F.get("lp", F.lit(0)))))
    alone = F.concat(F.transform("lc", lambda c: both(c, none)), F.transform("lp", lambda p: both(none, p)))
    rows = kept.select(*pair, "put_call_bucket", F.inline(F.concat("same", F.coalesce(changed, alone))))
    whole = F.col("c").isNotNull() & F.col("p").isNotNull()
    matched = rows.filter(whole).withColumn("reconciled", F.lit(False))
    left = rows.filter(~whole).withColumn("o", F.coalesce("c", "p"))
    key = F.coalesce(F.concat(F.lit("c:"), F.col("o.cusip")), F.concat_ws("|", F.lit("k:"), "o.position_key", "o.unit_key", F.col("c").isNull().cast("string")))
    w = W.partitionBy(*pair, "put_call_bucket", "_key")
    left = left.withColumn("_key", key).select(
        "*", F.max("p").over(w).alias("_p"),
        ((F.count("c").over(w) == 1) & (F.count("p").over(w) == 1) & (F.sum(F.col("o.position_key").startswith("sid:").cast("int")).over(w) == 1)).alias("m"),
    )
    # of a matched pair the current side is kept and given the other
    third = left.filter(~F.col("m") | F.col("c").isNotNull()).select(
        *pair, "put_call_bucket", "c", F.when(F.col("m"), F.col("_p")).otherwise(F.col("p")).alias("p"), F.col("m").alias("reconciled")
    )
    return classify(matched.unionByName(third))


def classify(m: DataFrame) -> DataFrame:
    cur, old = F.col("c").isNotNull(), F.col("p").isNotNull()
    cv = F.when(cur, F.col("c.value")).otherwise(0)
    pv = F.when(old, F.col("p.value")).otherwise(0)
    dv = cv - pv
    same_unit = F.col("c.unit_key") == F.col("p.unit_key")
    ds = F.when(cur & old, F.when(same_unit, F.col("c.shares") - F.col("p.shares"))).when(cur, F.col("c.shares")).otherwise(-F.col("p.shares"))
    by_value = cur & old & (ds.isNull() | (ds == 0))
    kind = (
        F.when(~old, "new").when(~cur, "exit").when(ds > 0, "add").when(ds < 0, "trim")
        .when(dv >= 0, "add").when(dv < 0, "trim").otherwise("unclassified")
    )
    flags = F.array_sort(F.array_compact(F.array(
        F.when(F.col("reconciled"), "identity_reconciled_by_cusip"),
        F.when((cur & F.col("c.value").isNull()) | (old & F.col("p.value").isNull()), "value_undisclosed_one_side"),
        F.when(cur & old & ds.isNull(), "shares_unit_mismatch"),
        F.when(by_value & dv.isNotNull(), "classified_by_value"),
        F.when(by_value & dv.isNull(), "change_kind_undeterminable"),
    )))
    return m.select(
        "cik", F.coalesce("c.position_key", "p.position_key").alias("position_key"), "put_call_bucket",
        F.coalesce("c.unit_key", "p.unit_key").alias("unit_key"), "period", "prev_period", kind.alias("change_kind"),
        pv.alias("prev_value"), cv.alias("curr_value"), dv.alias("delta_value"),
        F.col("p.shares").alias("prev_shares"), F.col("c.shares").alias("curr_shares"), ds.alias("delta_shares"), F.to_json(flags).alias("flags"),
    )


def downgrade_exits(deltas: DataFrame, authoritative: DataFrame) -> DataFrame:
    """An exit is asserted only where the period's filings can assert absence."""
    ok = authoritative.select("cik", "period", F.lit(True).alias("_ok")).distinct()
    cant = (F.col("change_kind") == "exit") & F.col("_ok").isNull()
    flags = F.array_sort(F.array_union(F.from_json("flags", "array<string>"), F.array(F.lit("exit_not_assertable"))))
    return (
        deltas.join(ok, ["cik", "period"], "left")
        .withColumn("flags", F.when(cant, F.to_json(flags)).otherwise(F.col("flags")))
        .withColumn("change_kind", F.when(cant, "unclassified").otherwise(F.col("change_kind")))
        .drop("_ok")
    )


def by_move() -> list[Column]:
    return [F.abs("delta_value").desc_nulls_last(), F.col("cik"), F.col("position_key"), F.col("put_call_bucket"), F.col("unit_key"), F.col("period")]


def top_holders(rows: DataFrame, issuer: Column, n: int = 25) -> DataFrame:
    """The n holders of every issuer and period with the most value, then smaller cik;
    the partial ranking before the shuffle is Spark's."""
    g = rows.withColumn("issuer_key", issuer).groupBy("issuer_key", "period", "cik").agg(exact_sum("value_usd").alias("value"), F.countDistinct("position_key").alias("positions"))
    w = W.partitionBy("issuer_key", "period").orderBy(F.col("value").desc_nulls_last(), "cik")
    return g.filter(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def concentration(rows: DataFrame, periods: DataFrame, n: int = 10) -> DataFrame:
    """Per filer and period of ``periods``, also those without a holding: combined share of
    the n largest positions, largest share (basis points) and the index of squared
    shares, over the disclosed values; null with a flag where the total isn't positive.
    Rows without a key stand alone.  Exact whole numbers."""
    key = F.coalesce("position_key", F.concat(F.lit("row:"), F.col("row_id").cast("string")))
    pos = rows.groupBy("cik", "period", key.alias("k"), "put_call_bucket").agg(
        F.sum(F.col("value_usd").cast(WIDE)).alias("v"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("value_usd").isNull()).alias("u")
    )
    w = W.partitionBy("cik", "period").orderBy(F.col("v").desc_nulls_last(), "k", "put_call_bucket")
    g = pos.withColumn("r", F.row_number().over(w)).groupBy("cik", "period").agg(
        F.sum("n").alias("positions"), F.sum("u").alias("undisclosed"),
        F.sum("v").cast(WIDE).alias("t"), F.sum(F.when(F.col("r") <= n, F.col("v"))).cast(WIDE).alias("top"),
        F.max("v").alias("most"), F.sum((F.col("v").cast("decimal(19,0)") * F.col("v").cast("decimal(18,0)")).cast(WIDE)).cast(WIDE).alias("sq"),
    )
    g = periods.select("cik", "period").distinct().join(g, ["cik", "period"], "left")
    g = g.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("positions", "undisclosed")}).withColumn("t", F.coalesce("t", F.lit(0).cast(WIDE)))
    ok = F.col("t") > 0
    return g.select(
        "cik", "period", "positions", "undisclosed", F.col("t").cast("long").alias("total_value"),
        F.when(ok, F.expr("cast(top as decimal(24,0)) * 10000 div nullif(t, 0)")).alias("topn_bps"),
        F.when(ok, F.expr("cast(most as decimal(24,0)) * 10000 div nullif(t, 0)")).alias("max_bps"),
        F.when(ok, F.expr("cast(sq as decimal(33,0)) * 10000 div nullif(cast(cast(t as decimal(19,0)) * cast(t as decimal(19,0)) as decimal(38,0)), 0)")).alias("hhi"),
        F.when(~ok, "concentration_unavailable").alias("flag"),
    )


def outsized(books: DataFrame, published: DataFrame, times_percent: int = 150, floor_bps: int = 500, window: int = 4) -> DataFrame:
    """Periods whose largest share exceeds ``times_percent`` of the greatest in the
    ``window`` published periods before, and the floor.  ``books`` has cik, period,
    max_bps, undisclosed and admitted.  A book with an undisclosed value, or not
    admitted, has no largest share; a period awaits a baseline where its own book or one
    before has none, or those before don't follow each other in the published sequence."""
    seq = published.select("period").distinct().withColumn("i", F.row_number().over(W.orderBy("period")))  # some dozens of periods
    share = F.when((F.col("undisclosed") == 0) & F.col("admitted"), F.col("max_bps"))
    s = books.withColumn("max_bps", share).join(F.broadcast(seq), "period")
    w = W.partitionBy("cik").orderBy("i")
    back = w.rowsBetween(-window, -1)
    base = F.when((F.count("max_bps").over(back) == window) & (F.col("i") - F.lag("i", window).over(w) == window), F.max("max_bps").over(back))
    state = F.when(base.isNull() | F.col("max_bps").isNull(), "awaiting_baseline").when(
        (F.col("max_bps") * 100 > base * times_percent) & (F.col("max_bps") >= floor_bps), "outsized"
    ).otherwise("not_outsized")
    return s.select("cik", "period", "max_bps", base.alias("baseline_bps"), state.alias("state"))


def latest(rows: DataFrame, key: str, period: str = "period") -> DataFrame:
    """The rows of each key's latest period.  The periods are a row a key, joined back, so
    no key's rows are gathered."""
    last = rows.groupBy(key).agg(F.max(period).alias(period))
    return rows.join(last, [key, period])


def diff_latest(folded: DataFrame, periods: DataFrame) -> DataFrame:
    """The positions of a filer's two newest periods, folded as a page shows them, side by
    side.  Present on one side only: added or removed, which asserts no more than that.
    Direction is by value, then by shares of the same unit; unclassified where neither
    is disclosed on both sides."""
    k = F.row_number().over(W.partitionBy("cik").orderBy(F.desc("period")))
    two = periods.select("cik", "period").distinct().withColumn("k", k).filter(F.col("k") <= 2)
    keys = ["cik", "position_key", "put_call_bucket", "unit_key"]
    side = lambda i: F.max(F.when(F.col("k") == i, F.struct("value", "shares")))
    g = folded.join(two, ["cik", "period"]).groupBy(*keys).agg(side(1).alias("c"), side(2).alias("p"))
    dv, ds = F.col("c.value") - F.col("p.value"), F.col("c.shares") - F.col("p.shares")
    kind = (
        F.when(F.col("p").isNull(), "added").when(F.col("c").isNull(), "removed").when(dv > 0, "increased").when(dv < 0, "decreased")
        .when(ds > 0, "increased").when(ds < 0, "decreased").when(dv == 0, "unchanged").otherwise("unclassified")
    )
    return g.select(*keys, kind.alias("kind"), dv.alias("delta_value"), ds.alias("delta_shares"))


def coverage(filings: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Resolved value over the greater of declared and resolved, per filing, then summed."""
    per = rows.groupBy("filing_key").agg(
        F.coalesce(F.sum(F.when(F.col("security_id").isNotNull(), F.col("value_usd").cast(WIDE))), F.lit(0)).cast(WIDE).alias("resolved"),
        F.coalesce(F.sum(F.col("value_usd").cast(WIDE)), F.lit(0)).cast(WIDE).alias("reported"),
    )
    f = filings.join(per, "filing_key", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(WIDE)) for c in ("resolved", "reported")})
    declared = F.coalesce(F.col("table_value_total_usd").cast(WIDE), F.lit(0).cast(WIDE))
    g = f.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("filings"), F.count_if(F.col("table_value_total_usd").isNull()).alias("unmeasurable"),
        F.sum("resolved").cast("long").alias("resolved"), F.sum(F.greatest(declared, F.col("resolved"))).cast("long").alias("denominator"),
    )
    ratio = F.when(F.col("denominator") > 0, F.col("resolved") / F.col("denominator"))
    return g.withColumn("coverage", F.round(ratio, 6)).withColumn("certifiable", (F.col("unmeasurable") == 0) & F.coalesce(ratio >= 0.95, F.lit(False)))


def cover_dispositions(filings: DataFrame, rows: DataFrame) -> DataFrame:
    """How a filing's rows add up to its cover: exact, rounding (within tolerance), conflict, unknown."""
    per = rows.groupBy("filing_key").agg(F.sum(F.col("value_usd").cast(WIDE)).cast("long").alias("reported"), F.count(F.lit(1)).alias("n_rows"), F.count("security_id").alias("resolved_rows"))
    f = filings.join(per, "filing_key")
    off = F.col("reported") - F.col("table_value_total_usd")
    kind = F.when(off.isNull(), "unknown").when(off == 0, "exact").when(F.abs(off) <= F.greatest(F.lit(1000), F.expr("table_value_total_usd div 1000")), "rounding").otherwise("conflict")
    return f.select("filing_key", "n_rows", "resolved_rows", "reported", off.alias("delta"), kind.alias("disposition"))
