"""Feeds: filters that trades and paper filings share as far as they can, orders, budgets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import ranges as R

SIDES = {"buy": ["purchase"], "sell": ["sale", "sale_partial"], "exch": ["exchange"]}


@dataclass(frozen=True)
class FeedFilter:
    """What a feed is narrowed to; the defaults let everything through.  ``owner`` none:
    trades without an owner.  ``basis``: the date that ``since`` and ``until`` look at."""

    chamber: str | None = None
    party: str | None = None
    side: str | None = None
    owner: str | None = None
    late: bool = False
    text: str = ""
    since: str | None = None
    until: str | None = None
    basis: str = "filed"
    at_least: int = 0
    watched: bool = False
    members: Sequence[str] = field(default_factory=tuple)
    tickers: Sequence[str] = field(default_factory=tuple)

    def _common(self, at: Column, name: str) -> Column:
        ok = F.lit(True)
        for c, v in (("chamber", self.chamber), ("party", self.party)):
            ok = ok if v is None else ok & F.coalesce(F.col(c) == v, F.lit(False))
        if self.since:
            ok = ok & F.coalesce(at >= F.lit(self.since).cast("date"), F.lit(False))
        if self.until:
            ok = ok & F.coalesce(at <= F.lit(self.until).cast("date"), F.lit(False))
        return ok

    def trade(self) -> Column:
        """Whether a trade passes everything but the amount.  In a window of trading dates
        anomalies and undated trades have no place."""
        traded, windowed = self.basis == "traded", bool(self.since or self.until)
        ok = self._common(F.col("transaction_date" if traded else "filed_date"), "member")
        if traded and windowed:
            ok = ok & ~F.coalesce(F.array_contains("flags", "date_anomaly"), F.lit(False))
        if self.side:
            ok = ok & F.coalesce(F.col("side").isin(SIDES[self.side]), F.lit(False))
        if self.owner == "none":
            ok = ok & F.col("owner").isNull()
        elif self.owner:
            ok = ok & F.coalesce(F.col("owner") == self.owner, F.lit(False))
        if self.late:
            ok = ok & F.coalesce(F.col("is_late"), F.lit(False))
        if self.watched:
            ok = ok & (F.coalesce(F.col("bioguide_id").isin(list(self.members)), F.lit(False)) | F.coalesce(F.col("ticker").isin(list(self.tickers)), F.lit(False)))
        if self.text:
            hit = F.coalesce(F.lower("name").contains(self.text.lower()), F.lit(False)) | F.coalesce(F.upper("ticker").startswith(self.text.upper()), F.lit(False))
            ok = ok & hit
        return ok

    def paper(self) -> Column:
        """Whether a paper filing passes: it has no side, amount, owner, lateness or trading
        date, so a filter on one of these hides it."""
        if self.side or self.at_least or self.owner or self.late or (self.basis == "traded" and (self.since or self.until)):
            return F.lit(False)
        ok = self._common(F.col("filed_date"), "name")
        if self.watched:
            ok = ok & F.coalesce(F.col("bioguide_id").isin(list(self.members)), F.lit(False))
        return ok & F.coalesce(F.lower("name").contains(self.text.lower()), F.lit(False)) if self.text else ok

    def verdict(self) -> Column:
        return R.verdict(F.col("amount_low"), F.col("amount_high"), self.at_least) if self.at_least else F.lit("in")


def feed_counts(trades: DataFrame, paper: DataFrame, f: FeedFilter) -> DataFrame:
    """(kind, total, shown, indeterminate): what a filter leaves of the trades and of the
    paper filings, and the trades whose amount it can neither take nor leave."""
    v, ok = f.verdict(), f.trade()
    t = trades.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok & (v == "in")).alias("shown"), F.count_if(ok & (v == "indeterminate")).alias("indeterminate"))
    p = paper.agg(F.count(F.lit(1)).alias("total"), F.count_if(f.paper()).alias("shown"), F.lit(0).cast("long").alias("indeterminate"))
    return t.select(F.lit("trade").alias("kind"), "*").unionByName(p.select(F.lit("paper").alias("kind"), "*"))


def amount_key() -> Column:
    """The disclosed lower bound; 0 where only an upper one is known; null where neither is."""
    return F.coalesce("amount_low", F.when(F.col("amount_high").isNotNull(), F.lit(0)))


def by_amount(descending: bool = True) -> list[Column]:
    """Ranked trades by lower bound, newest filing first among equals; unknown amounts
    behind all, in a bucket of their own."""
    k = amount_key()
    return [k.isNull().asc(), k.desc() if descending else k.asc(), F.col("filed_date").desc_nulls_last(), F.col("txn_id").asc()]


def within_budget(entities: DataFrame, size: str, cost: str, key: Sequence[str], budget: int) -> DataFrame:
    """The entities, largest first, whose costs together stay within the budget; the walk
    ends at the first that doesn't fit.  Every cost is at least 1, so no more than
    ``budget`` entities come together for the running sum."""
    order = [F.col(size).desc(), *[F.col(k).asc() for k in key]]
    first = entities.orderBy(*order).limit(budget)
    return first.withColumn("spent", F.sum(cost).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))).filter(F.col("spent") <= budget)


def activity_order() -> list[Column]:
    """Changes by size, undisclosed ones last, then filer, position, bucket and unit."""
    d = F.col("delta_value")
    return [d.isNull().asc(), F.abs(d).desc(), F.col("cik"), F.col("position_key"), F.col("put_call_bucket"), F.col("unit_key")]


def page_order() -> list[Column]:
    """A filer page's changes by what is held, else by what was, undisclosed last."""
    return [F.coalesce("curr_value", "prev_value", F.lit(-1)).desc(), F.col("position_key"), F.col("put_call_bucket"), F.col("unit_key")]


def ranked_last(key: str, ties: Sequence[str], descending: bool = True) -> list[Column]:
    """By a key, rows without one in a trailing bucket and never as if it were zero."""
    c = F.col(key)
    return [c.isNull().asc(), c.desc() if descending else c.asc(), *[F.col(t) for t in ties]]


def holder_coverage(holders: DataFrame) -> DataFrame:
    """(period, resolved and unresolved rows, value and undisclosed rows, coverage_bps) over
    every holder row: an unresolved one belongs to no issuer, so it is counted corpus-wide."""
    res = F.startswith("issuer_key", F.lit("entity:"))
    value = lambda p: F.coalesce(F.sum(F.when(p, F.col("value").cast("decimal(38,0)"))), F.lit(0).cast("decimal(38,0)"))
    g = holders.groupBy("period").agg(
        F.count_if(res).alias("resolved_rows"), value(res).alias("r"), F.count_if(res & F.col("value").isNull()).alias("resolved_undisclosed"),
        F.count_if(~res).alias("unresolved_rows"), value(~res).alias("u"), F.count_if(~res & F.col("value").isNull()).alias("unresolved_undisclosed"),
    )
    whole = F.col("r") + F.col("u")
    bps = F.when(whole > 0, F.floor((F.col("r") * 20000 + whole) / F.nullif(whole * 2, F.lit(0).cast("decimal(38,0)"))).cast("long"))  # half up
    return g.select("period", "resolved_rows", F.col("r").cast("long").alias("resolved_value"), "resolved_undisclosed", "unresolved_rows", F.col("u").cast("long").alias("unresolved_value"), "unresolved_undisclosed", bps.alias("coverage_bps"))


def audit_score(sheet: DataFrame, strata: Sequence[str], most: float = 0.05) -> DataFrame:
    """Per stratum of a worksheet (verdict ok, wrong or null): checked, wrong, unchecked, the
    95 percent upper bound of the error rate where nothing is wrong, and the decision: a
    sheet not wholly checked fails closed."""
    g = sheet.groupBy(*strata).agg(F.count_if(F.col("verdict").isNotNull()).alias("checked"), F.count_if(F.col("verdict") == "wrong").alias("wrong"), F.count_if(F.col("verdict").isNull()).alias("unchecked"))
    bound = F.when((F.col("wrong") == 0) & (F.col("checked") > 0), 1 - F.pow(F.lit(0.05), 1 / F.nullif(F.col("checked"), F.lit(0))))
    decision = F.when(F.col("unchecked") > 0, "incomplete").when(F.col("checked") == 0, "empty").when(F.col("wrong") > 0, "fail").when(bound <= most, "pass").otherwise("too_small")
    return g.select(*strata, "checked", "wrong", "unchecked", F.round(bound, 6).alias("upper_bound"), decision.alias("decision"))


# The codes of compact position changes.
CHANGE_CODES = ["new", "exit", "add", "trim", "unclassified"]
CHANGE_FLAGS = ["change_kind_undeterminable", "classified_by_value", "identity_reconciled_by_cusip", "shares_unit_mismatch", "value_undisclosed_one_side"]


def compact_changes(deltas: DataFrame) -> DataFrame:
    """Changes with their kind as a code and their flags as a mask."""
    flags = F.from_json("flags", "array<string>")
    mask = sum((F.when(F.array_contains(flags, f), 1 << i).otherwise(0) for i, f in enumerate(CHANGE_FLAGS)), F.lit(0))
    code = F.array_position(F.array(*[F.lit(k) for k in CHANGE_CODES]), F.col("change_kind")) - 1
    return deltas.withColumn("code", code.cast("int")).withColumn("mask", mask).drop("change_kind", "flags")


def expand_changes(compact: DataFrame) -> DataFrame:
    """The inverse of :func:`compact_changes`."""
    kind = F.get(F.array(*[F.lit(k) for k in CHANGE_CODES]), F.col("code"))
    flags = F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(1 << i) != 0, f) for i, f in enumerate(CHANGE_FLAGS)]))
    return compact.withColumn("change_kind", kind).withColumn("flags", F.to_json(F.array_sort(flags))).drop("code", "mask")
