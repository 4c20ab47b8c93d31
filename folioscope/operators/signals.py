"""Rule-based signals over disclosed trades, their gate and their life from build to build."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

# The rules' thresholds.
LARGE, INFREQUENT_LOW, LATE_LARGE = 250_000, 50_000, 100_000
CLUSTER_MEMBERS, CLUSTER_DAYS, MOST_PRIOR, CORPUS_DAYS = 4, 14, 10, 365
RETENTION_DAYS = 90


@dataclass(frozen=True)
class Bound:
    """What a kind was calibrated to: most signals in 30 days, of all and of either
    chamber, fewest over the whole history, and the days of history it needs."""

    per_30d: int
    total: int
    history: int


# The calibrated bounds.
BOUNDS: dict[str, Bound] = {
    "s1-large": Bound(120, 50, 0), "s2-first": Bound(400, 1, 365), "s3-cooccurrence": Bound(20, 0, 0), "s4-infrequent": Bound(60, 1, 365), "s6-late-large": Bound(40, 10, 0),
}
KINDS = ["s1-large", "s2-first", "s3-cooccurrence", "s4-infrequent", "s5-jurisdiction", "s6-late-large"]


def _signal(df: DataFrame, kind: str) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), "chamber", "bioguide_id", "ticker", "side", F.col("filed_date").alias("at"), F.col("txn_id").alias("dedupe_key"))


def large(t: DataFrame) -> DataFrame:
    return _signal(t.filter(F.col("amount_low") >= LARGE), "s1-large")


def first_disclosure(t: DataFrame) -> DataFrame:
    """A member's first disclosure of a ticker, once the corpus is a year old.  The least
    (date, id) of a pair is an aggregate, so no member's trades are gathered."""
    start = t.agg(F.min("filed_date").alias("s")).scalar()
    rows = t.filter(F.col("bioguide_id").isNotNull() & F.col("ticker").isNotNull())
    one = rows.groupBy("bioguide_id", "ticker").agg(F.min(F.struct("filed_date", "txn_id", "side", "chamber")).alias("x")).select("bioguide_id", "ticker", "x.*")
    return _signal(one.filter(F.datediff("filed_date", start) >= CORPUS_DAYS), "s2-first")


def cluster_starts(t: DataFrame, members: int = CLUSTER_MEMBERS, days: int = CLUSTER_DAYS, cooldown: int = CLUSTER_DAYS) -> DataFrame:
    """(ticker, side, most, starts): the most members that traded a ticker the same way
    within ``days`` days of trading, and the first days of the windows in which at least
    ``members`` did, each at least ``cooldown`` days after the one before.  Trades filed
    before they were made are left out.  Trades are reduced to a member a day before the
    window, which holds ``days`` days, and to days before they are gathered."""
    ok = F.col("bioguide_id").isNotNull() & F.col("ticker").isNotNull() & F.col("transaction_date").isNotNull() & (F.col("filed_date") >= F.col("transaction_date"))
    day = F.datediff("transaction_date", F.lit("1970-01-01").cast("date"))
    one = t.filter(ok).select("ticker", "side", day.alias("day"), "bioguide_id").distinct()
    w = W.partitionBy("ticker", "side").orderBy("day").rangeBetween(0, days - 1)
    daily = one.withColumn("n", F.size(F.collect_set("bioguide_id").over(w))).groupBy("ticker", "side", "day").agg(F.max("n").alias("n"))
    g = daily.groupBy("ticker", "side").agg(F.max("n").alias("most"), F.array_sort(F.collect_set(F.when(F.col("n") >= members, F.col("day")))).alias("d"))
    late_enough = lambda kept, x: (F.size(kept) == 0) | (x >= F.element_at(kept, -1) + cooldown)
    kept = F.aggregate("d", F.array().cast("array<int>"), lambda kept, x: F.when(late_enough(kept, x), F.array_append(kept, x)).otherwise(kept))
    return g.select("ticker", "side", "most", F.transform(kept, lambda x: F.date_add(F.lit("1970-01-01").cast("date"), x)).alias("starts"))


def cooccurrence(t: DataFrame, members: int = CLUSTER_MEMBERS, days: int = CLUSTER_DAYS, cooldown: int = CLUSTER_DAYS) -> DataFrame:
    """A signal per cluster, keyed by ticker, side and the window's first day."""
    c = cluster_starts(t, members, days, cooldown).select("ticker", "side", F.explode("starts").alias("at"))
    none = F.lit(None).cast("string")
    return c.select(F.lit("s3-cooccurrence").alias("kind"), none.alias("chamber"), none.alias("bioguide_id"), "ticker", "side", "at", F.concat_ws("+", "ticker", "side", F.col("at").cast("string")).alias("dedupe_key"))


def infrequent(t: DataFrame) -> DataFrame:
    """A large purchase by a member with few disclosures before.  Trades are first counted
    by member and day, and the running sum goes over those days."""
    rows = t.filter(F.col("bioguide_id").isNotNull())
    daily = rows.groupBy("bioguide_id", "filed_date").agg(F.count(F.lit(1)).alias("n"))
    run = F.coalesce(F.sum("n").over(W.partitionBy("bioguide_id").orderBy("filed_date").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    few = daily.withColumn("_before", run).filter(F.col("_before") <= MOST_PRIOR).select("bioguide_id", "filed_date")
    hit = rows.filter((F.col("side") == "purchase") & (F.col("amount_low") >= INFREQUENT_LOW)).join(few, ["bioguide_id", "filed_date"])
    return _signal(hit, "s4-infrequent")


def jurisdiction(t: DataFrame) -> DataFrame:
    """Trades marked by :func:`committees.jurisdiction_overlap` as within a seat's remit."""
    return _signal(t.filter(F.col("jurisdiction") == "overlap"), "s5-jurisdiction")


def late_large(t: DataFrame) -> DataFrame:
    return _signal(t.filter(F.col("is_late") & (F.col("amount_low") >= LATE_LARGE)), "s6-late-large")


def gate(signals: DataFrame, history: DataFrame, bounds: Mapping[str, Bound] = BOUNDS, kinds: list[str] = KINDS, retention: int = RETENTION_DAYS) -> DataFrame:
    """(kind, total, busiest, withheld): per kind its signals, the most in 30 days among
    all and either chamber, over the last ``retention`` days, and why it is withheld:
    ``inputs-not-in-build`` without a calibration, ``insufficient-history``, or
    ``volume-out-of-bounds``, so that a busy chamber can't hide behind a quiet one."""
    span = history.agg(F.max("filed_date").alias("z"), F.min("filed_date").alias("a"))
    z, days = span.select("z").scalar(), span.select(F.datediff("z", "a")).scalar()
    recent = F.col("at") > F.date_sub(z, retention)
    cohort = lambda c: F.count_if(recent & ((F.col("chamber") == c) if c else F.lit(True)))
    g = signals.groupBy("kind").agg(F.count(F.lit(1)).alias("total"), F.greatest(cohort(None), cohort("house"), cohort("senate")).alias("recent"))
    spark = signals.sparkSession
    known = spark.createDataFrame([(k, b.per_30d, b.total, b.history) if (b := bounds.get(k)) else (k, None, None, None) for k in kinds], "kind string, most int, least int, needs int")
    x = known.join(F.broadcast(g), "kind", "left").withColumn("total", F.coalesce("total", F.lit(0))).withColumn("busiest", F.round(F.coalesce("recent", F.lit(0)) * 30 / F.lit(retention), 4))
    why = F.when(F.col("most").isNull(), "inputs-not-in-build").when(days < F.col("needs"), "insufficient-history").when((F.col("busiest") > F.col("most")) | (F.col("total") < F.col("least")), "volume-out-of-bounds")
    return x.select("kind", "total", "busiest", why.alias("withheld"))


def retained(signals: DataFrame, gate_: DataFrame, history: DataFrame, retention: int = RETENTION_DAYS) -> DataFrame:
    """The signals that a build gives out: kinds not withheld, of the last ``retention`` days."""
    z = history.agg(F.max("filed_date").alias("z")).scalar()
    ok = gate_.filter(F.col("withheld").isNull()).select("kind")
    return signals.filter(F.col("at") > F.date_sub(z, retention)).join(F.broadcast(ok), "kind", "left_semi")


LIFE = ["id", "status", "first_seen", "last_seen", "superseded_in"]


def lifecycle(prior: DataFrame | None, current: DataFrame, build: str) -> DataFrame:
    """(id, status, first_seen, last_seen, superseded_in) of a build chained to the one
    before.  The id is made of kind and key, so a filing has one in every build.  First
    seen is carried on; what is gone becomes superseded in this build, and what was
    superseded before stays as it was, unless it is back."""
    now = current.select(F.concat_ws(":", "kind", "dedupe_key").alias("id")).distinct()
    if prior is None:
        return now.select("id", F.lit("active").alias("status"), F.lit(build).alias("first_seen"), F.lit(build).alias("last_seen"), F.lit(None).cast("string").alias("superseded_in"))
    p = prior.select(F.col("id").alias("_p"), *LIFE[1:])
    j = now.join(p, F.col("id") == F.col("_p"), "full_outer")
    here = F.col("id").isNotNull()
    return j.select(
        F.coalesce("id", "_p").alias("id"), F.when(here, "active").otherwise("superseded").alias("status"), F.coalesce("first_seen", F.lit(build)).alias("first_seen"),
        F.when(here, F.lit(build)).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(~here, F.when(F.col("status") == "superseded", F.col("superseded_in")).otherwise(F.lit(build))).alias("superseded_in"),
    )
