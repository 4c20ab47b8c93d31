"""The identity registry as a pure function of dated observations and a reviewed authority.

``observations``: id_type, value, at (date), candidate (an entity, may be null).
``authority`` (ownership windows): id_type, value, valid_from, valid_to, owner, class; a value
it doesn't name belongs for all time to a provisional security made from the value.
Since nothing is kept from run to run but observations, any split, order or backfill of
them gives the same registry, and a changed authority is a recomputation whose difference
to the registry before is the list of supersessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import normalize as N
from .intervals import OPEN, end_or_open, union_intervals

#: Days without an observation after which a reuse of the identifier is looked into.
REVIEW_DAYS = 3_650
BEGIN = "0001-01-01"


def authority_errors(authority: DataFrame) -> DataFrame:
    """(id_type, value, error): values whose declared windows overlap, leave a gap, or do not
    reach from the beginning to the end of time."""
    w = W.partitionBy("id_type", "value").orderBy("a", "z")
    x = authority.select("id_type", "value", F.coalesce("valid_from", F.lit(BEGIN).cast("date")).alias("a"), end_or_open("valid_to").alias("z"))
    x = x.withColumn("before", F.lag("z").over(w)).withColumn("after", F.lead("a").over(w))
    bad = (
        F.when(F.col("a") >= F.col("z"), "empty_window").when(F.col("a") < F.col("before"), "overlap").when(F.col("a") > F.col("before"), "gap")
        .when(F.col("before").isNull() & (F.col("a") > F.lit(BEGIN).cast("date")), "open_start").when(F.col("after").isNull() & (F.col("z") < F.lit(OPEN).cast("date")), "open_end")
    )
    return x.withColumn("error", bad).filter(F.col("error").isNotNull()).select("id_type", "value", "error")


def owner_windows(values: DataFrame, authority: DataFrame) -> DataFrame:
    """(id_type, value, security_id, id_state, class, valid_from, valid_to): who owns each of
    ``values`` when, over all time; touching windows of one owner are one."""
    declared = authority.select(
        "id_type", "value", F.col("owner").alias("security_id"), F.col("class"), F.coalesce("valid_from", F.lit(BEGIN).cast("date")).alias("valid_from"), end_or_open("valid_to").alias("valid_to"),
    )
    merged = union_intervals(declared, ["id_type", "value", "security_id", "class"]).withColumn("id_state", F.lit("declared"))
    asked = values.select("id_type", "value").distinct()
    free = asked.join(declared.select("id_type", "value").distinct(), ["id_type", "value"], "left_anti")
    free = free.select(
        "id_type", "value", N.provisional_security(F.col("id_type"), F.col("value")).alias("security_id"), F.lit(None).cast("string").alias("class"),
        F.lit(BEGIN).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit("provisional").alias("id_state"),
    )
    return merged.join(asked, ["id_type", "value"], "left_semi").unionByName(free)


def owned(observations: DataFrame, authority: DataFrame) -> DataFrame:
    """Observations with the security that owned the value on their day."""
    w = owner_windows(observations, authority).withColumnRenamed("valid_from", "_f").withColumn("_t", end_or_open("valid_to")).drop("valid_to")
    j = observations.join(w, ["id_type", "value"])
    return j.filter((F.col("_f") <= F.col("at")) & (F.col("at") < F.col("_t"))).drop("_f", "_t")


def bindings(observations: DataFrame, authority: DataFrame) -> DataFrame:
    """(security_id, id_type, value, id_state, valid_from, valid_to): the days a value was
    seen as a security, neighbouring days joined and gaps left open."""
    days = owned(observations, authority).select("security_id", "id_type", "value", "id_state", F.col("at").alias("valid_from"), F.date_add("at", 1).alias("valid_to")).distinct()
    return union_intervals(days, ["security_id", "id_type", "value", "id_state"])


def list_bindings(lines: DataFrame, authority: DataFrame) -> DataFrame:
    """Bindings from a quarterly list (id_type, value, quarter start as at): each line holds
    for its quarter, cut where the ownership changes within it."""
    q = lines.select("id_type", "value", F.trunc("at", "quarter").alias("_a")).distinct().withColumn("_z", F.add_months("_a", 3))
    w = owner_windows(lines, authority)
    j = q.join(w, ["id_type", "value"]).withColumn("a", F.greatest("_a", "valid_from")).withColumn("z", F.least("_z", end_or_open("valid_to")))
    cut = j.filter(F.col("a") < F.col("z")).select("security_id", "id_type", "value", "id_state", F.col("a").alias("valid_from"), F.col("z").alias("valid_to"))
    return union_intervals(cut, ["security_id", "id_type", "value", "id_state"])


def entity_links(observations: DataFrame, authority: DataFrame) -> DataFrame:
    """(security_id, entity_id, state, candidates): candidates gather as a set; one resolves,
    several conflict, none leaves the security unresolved."""
    g = owned(observations, authority).groupBy("security_id").agg(F.countDistinct("candidate").alias("candidates"), F.min("candidate").alias("_c"))
    state = F.when(F.col("candidates") == 1, "resolved").when(F.col("candidates") == 0, "unresolved").otherwise("conflict")
    return g.select("security_id", F.when(F.col("candidates") == 1, F.col("_c")).alias("entity_id"), state.alias("state"), "candidates")


def reuse_review(bound: DataFrame, authority: DataFrame, continuities: DataFrame, days: int = REVIEW_DAYS) -> DataFrame:
    """(id_type, value, gap_from, gap_to, decision) of every long gap in which a value was not
    seen.  ``explained``: a declared change of owner falls into it.  ``cleared``: a reviewed
    continuity (id_type, value, gap_from, gap_to, review_state) covers it; one that isn't
    reviewed clears nothing.  Else ``disputed``.  A gap only asks for a review; it widens
    and bridges no interval."""
    w = W.partitionBy("id_type", "value").orderBy("valid_from")
    gaps = bound.select("id_type", "value", F.lag("valid_to").over(w).alias("gap_from"), F.col("valid_from").alias("gap_to"))
    gaps = gaps.filter((F.col("gap_from") < F.col("gap_to")) & (F.datediff("gap_to", "gap_from") >= days))
    b = authority.filter(F.col("valid_from").isNotNull()).select("id_type", "value", F.col("valid_from").alias("_b"))
    c = continuities.filter(F.col("review_state") == "reviewed").select("id_type", "value", F.col("gap_from").alias("_f"), F.col("gap_to").alias("_t"))
    key = ["id_type", "value", "gap_from", "gap_to"]
    x = gaps.join(b, ["id_type", "value"], "left").groupBy(*key).agg(F.coalesce(F.bool_or((F.col("gap_from") <= F.col("_b")) & (F.col("_b") <= F.col("gap_to"))), F.lit(False)).alias("owner"))
    x = x.join(c, ["id_type", "value"], "left").groupBy(*key, "owner").agg(F.coalesce(F.bool_or((F.col("_f") <= F.col("gap_from")) & (F.col("gap_to") <= F.col("_t"))), F.lit(False)).alias("kept"))
    return x.select(*key, F.when(F.col("owner"), "explained").when(F.col("kept"), "cleared").otherwise("disputed").alias("decision"))


def with_review(bound: DataFrame, review: DataFrame) -> DataFrame:
    """Bindings with ``review_state``: disputed where any gap of the value is, reviewed where
    all its gaps are cleared or explained and one is cleared, else auto."""
    g = review.groupBy("id_type", "value").agg(F.bool_or(F.col("decision") == "disputed").alias("_d"), F.bool_or(F.col("decision") == "cleared").alias("_c"))
    state = F.when(F.col("_d"), "disputed").when(F.col("_c"), "reviewed").otherwise("auto")
    return bound.join(g, ["id_type", "value"], "left").withColumn("review_state", state).drop("_d", "_c")


def supersessions(before: DataFrame, after: DataFrame) -> DataFrame:
    """(old_security_id, security_id): securities that no longer hold a binding, with all that
    hold it now; one may have several successors."""
    at = lambda df, s: df.select("id_type", "value", F.col("security_id").alias(s), "valid_from", end_or_open("valid_to").alias(f"{s}_to")).withColumnRenamed("valid_from", f"{s}_from")
    j = at(before, "o").join(at(after, "n"), ["id_type", "value"]).filter((F.col("o_from") < F.col("n_to")) & (F.col("n_from") < F.col("o_to")) & (F.col("o") != F.col("n")))
    gone = before.select(F.col("security_id").alias("o")).distinct().join(after.select(F.col("security_id").alias("o")).distinct(), "o", "left_anti")
    return j.join(gone, "o", "left_semi").select(F.col("o").alias("old_security_id"), F.col("n").alias("security_id")).distinct()


def successor(links: DataFrame) -> DataFrame:
    """(old_security_id, security_id, successors): the one successor, null if there are several."""
    g = links.groupBy("old_security_id").agg(F.countDistinct("security_id").alias("successors"), F.min("security_id").alias("s"))
    return g.select("old_security_id", F.when(F.col("successors") == 1, F.col("s")).alias("security_id"), "successors")


def reconcile(observations: DataFrame, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bindings under the new authority, supersessions from the old)."""
    after = bindings(observations, new)
    return after, supersessions(bindings(observations, old), after)


def name_history(snapshots: DataFrame) -> DataFrame:
    """(key, value, valid_from, valid_to) from dated snapshots (key, value, at) in one pass: a
    changed value closes the open interval and opens the next on the snapshot's day,
    absence leaves it open.  Applying the snapshots one by one in order gives the same."""
    w = W.partitionBy("key").orderBy("at")
    one = snapshots.groupBy("key", "at").agg(F.min("value").alias("value"))
    changed = one.withColumn("_b", F.lag("value").over(w)).filter(F.col("_b").isNull() | (F.col("_b") != F.col("value")))
    return changed.select("key", "value", F.col("at").alias("valid_from"), F.lead("at").over(w).alias("valid_to"))


def registry_state(bound: DataFrame, links: DataFrame, review: DataFrame) -> DataFrame:
    """(kind, state, n): how many bindings, links and reviews there are of each state."""
    count = lambda df, kind, c: df.groupBy(F.lit(kind).alias("kind"), F.col(c).alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return count(bound, "binding", "id_state").unionByName(count(links, "link", "state")).unionByName(count(review, "review", "decision"))
