"""Which records count: amendments composed before any number is computed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def once(df: DataFrame, key: str) -> DataFrame:
    """Records delivered again count once (every other column is equal)."""
    return df.dropDuplicates([key])


def default_transactions(transactions: DataFrame, filings: DataFrame) -> DataFrame:
    """Trades of active filings that no active amendment supersedes."""
    active = filings.filter(F.col("lifecycle") == "active")
    replaced = active.select(F.col("supersedes").alias("filing_id")).dropna().distinct()
    counted = active.select("filing_id").distinct().join(replaced, "filing_id", "left_anti")
    return transactions.join(counted, "filing_id", "left_semi")


def amendment_pairs(filings: DataFrame) -> DataFrame:
    """Both sides of every amendment."""
    a, o = filings.alias("a"), filings.alias("o")
    return a.join(o, F.col("a.supersedes") == F.col("o.filing_id")).select(
        F.col("a.filing_id").alias("amendment_filing_id"), F.col("a.chamber"), F.col("a.filed_date").alias("amendment_filed_date"),
        F.col("a.lifecycle").alias("amendment_lifecycle"), F.col("o.filing_id").alias("original_filing_id"),
        F.col("o.filed_date").alias("original_filed_date"), F.col("o.lifecycle").alias("original_lifecycle"),
    )


def pair_violations(filings: DataFrame) -> DataFrame:
    """Amendments that refer to themselves, to nothing, to the other chamber or to a later filing."""
    o = filings.select(F.col("filing_id").alias("o_id"), F.col("chamber").alias("o_chamber"), F.col("filed_date").alias("o_filed"))
    kind = (
        F.when(F.col("supersedes") == F.col("filing_id"), "self_reference")
        .when(F.col("o_id").isNull(), "missing_original")
        .when(F.col("o_chamber") != F.col("chamber"), "chamber_mismatch")
        .when(F.col("o_filed") > F.col("filed_date"), "filed_before_original")
    )
    return (
        filings.filter(F.col("supersedes").isNotNull()).join(o, F.col("supersedes") == F.col("o_id"), "left")
        .select("filing_id", "supersedes", kind.alias("violation")).filter(F.col("violation").isNotNull())
    )


def _order() -> Column:
    return F.struct(F.col("filed_date"), F.coalesce(F.col("amendment_no"), F.lit(0)).alias("n"), F.col("accession"))


def restatement_survivors(filings: DataFrame) -> DataFrame:
    """Active filings that no active restatement of the same filer and period out-orders
    by (filed_date, amendment_no, accession).  One window maximum instead of a join on
    inequalities.  A filing without a filed_date is neither out-ordered nor out-orders."""
    w = W.partitionBy("cik", "period_of_report")
    restates = (F.col("amendment_type") == "RESTATEMENT") & F.col("filed_date").isNotNull()
    active = filings.filter(F.col("lifecycle") == "active")
    latest = active.withColumn("_latest", F.max(F.when(restates, _order())).over(w))
    return latest.filter(F.col("_latest").isNull() | F.col("filed_date").isNull() | (_order() >= F.col("_latest"))).drop("_latest")


def mark_affiliates(survivors: DataFrame) -> DataFrame:
    """``survivors`` with ``affiliated``: whether another survivor of the period names the
    filing's file number among its other managers.  One row a period and number is joined,
    with who names it, so the join is on equal keys alone."""
    named = (
        survivors.select(F.col("period_of_report").alias("_p"), "filing_key", F.explode("other_managers").alias("m"))
        .select("_p", "filing_key", F.col("m.file_number_norm").alias("_n")).filter(F.col("_n").isNotNull())
        .groupBy("_p", "_n").agg(F.min("filing_key").alias("_a"), F.max("filing_key").alias("_z"))
    )
    other = (F.col("_a") != F.col("filing_key")) | (F.col("_z") != F.col("filing_key"))
    j = survivors.join(named, (F.col("period_of_report") == F.col("_p")) & (F.col("file_number_norm") == F.col("_n")), "left")
    return j.withColumn("affiliated", F.coalesce(other, F.lit(False))).drop("_p", "_n", "_a", "_z")


def suppress_affiliates(survivors: DataFrame) -> DataFrame:
    """Without the affiliated filings."""
    return mark_affiliates(survivors).filter(~F.col("affiliated")).drop("affiliated")


def within_tolerance(resolved: Column, total: Column) -> Column:
    """The resolved sum may exceed the cover's total by max(1000, total div 1000);
    an unknown total passes."""
    return total.isNull() | (resolved - total <= F.greatest(F.lit(1000), F.expr("table_value_total_usd div 1000")))


def composed_filings(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """The survivors with ``affiliated``, and ``within``: whether their resolved holdings
    keep to the cover's total.  One pass over the holdings serves both populations."""
    resolved = (
        holdings.filter(F.col("security_id").isNotNull() & F.col("filing_key").isNotNull())
        .groupBy("filing_key").agg(F.sum(F.col("value_usd").cast("decimal(38,0)")).alias("_resolved"))
    )
    value = F.coalesce(F.col("_resolved"), F.lit(0).cast("decimal(38,0)"))
    joined = mark_affiliates(restatement_survivors(filings)).join(resolved, "filing_key", "left")
    return joined.withColumn("within", within_tolerance(value, F.col("table_value_total_usd"))).drop("_resolved")


def default_filings(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """Survivors, affiliates counted once, within the cover's tolerance."""
    return composed_filings(filings, holdings).filter(F.col("within") & ~F.col("affiliated")).drop("within", "affiliated")


def filer_reported_filings(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """A filer's own book: as the default, without the suppression of affiliates."""
    return composed_filings(filings, holdings).filter("within").drop("within", "affiliated")


def is_amendment(submission: str = "submission_type", flag: str = "is_amendment") -> Column:
    return F.coalesce(F.col(flag), F.lit(False)) | F.coalesce(F.regexp_replace(F.upper(submission), r"\s", "").endswith("/A"), F.lit(False))


def authoritative_periods(reported: DataFrame) -> DataFrame:
    """(cik, period_of_report) whose filings can assert that a position is gone: one full
    report, all parsed, every amendment of a known type."""
    amends = is_amendment()
    form = F.regexp_replace(F.upper("submission_type"), r"[\s-]", "")
    known = F.coalesce(F.col("amendment_type").isin("RESTATEMENT", "NEW_HOLDINGS"), F.lit(False))
    full = form.startswith("13FHR") & (~amends | F.coalesce(F.col("amendment_type") == "RESTATEMENT", F.lit(False)))
    return (
        reported.groupBy("cik", "period_of_report")
        .agg(
            F.count_if(F.coalesce(full, F.lit(False))).alias("_full"),
            F.count_if(~F.coalesce(F.col("parse_status") == "parsed", F.lit(False))).alias("_unparsed"),
            F.count_if(amends & ~known).alias("_unknown"),
        )
        .filter((F.col("_full") == 1) & (F.col("_unparsed") == 0) & (F.col("_unknown") == 0))
        .select("cik", "period_of_report")
    )


def link_amendments(filings: DataFrame) -> DataFrame:
    """For each amendment the one first report of the filer and period filed no later;
    none if there are several (then flagged).  Counted per filer and period over the
    filing order instead of joined on the inequality."""
    amends = is_amendment()
    w = W.partitionBy("cik", "period_of_report").orderBy("filed_date").rangeBetween(W.unboundedPreceding, W.currentRow)
    base = F.when(~F.col("_a"), F.col("filing_id"))
    return (
        filings.filter(F.col("filed_date").isNotNull()).withColumn("_a", amends)
        .select("filing_id", "cik", "period_of_report", "_a", F.count(base).over(w).alias("bases"), F.min(base).over(w).alias("first_base"))
        .filter("_a")
        .select("filing_id", F.when(F.col("bases") == 1, F.col("first_base")).alias("base_filing_id"), (F.col("bases") != 1).alias("amendment_unresolved"))
    )


def affiliate_flags(survivors: DataFrame) -> DataFrame:
    """Who covers whom in a period through other managers, mutually or one way."""
    e = survivors.select("cik", "period_of_report", F.explode("other_managers").alias("m")).select("cik", "period_of_report", F.col("m.file_number_norm").alias("n")).dropna()
    who = survivors.select(F.col("cik").alias("covered"), "period_of_report", F.col("file_number_norm").alias("n")).dropna()
    edges = e.join(who, ["period_of_report", "n"]).filter(F.col("cik") != F.col("covered")).select("period_of_report", "cik", "covered").distinct()
    back = edges.select("period_of_report", F.col("covered").alias("cik"), F.col("cik").alias("covered"), F.lit(True).alias("_m"))
    return edges.join(back, ["period_of_report", "cik", "covered"], "left").select("period_of_report", "cik", "covered", F.coalesce("_m", F.lit(False)).alias("mutual"))
