"""Printed filer names to members: reviewed aliases first, then names with a term at the time."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

# Honorifics and suffixes that never tell members apart.
DROPPED = ["hon", "dr", "mr", "mrs", "ms", "jr", "sr", "ii", "iii", "iv", "v", "md", "facs", "dds", "esq", "phd"]
OPEN = "9999-12-31"
# How the yearly index prints a seat, and how seed records end an office.
SEAT, OFFICE = "^[A-Z]{2}[0-9]{2}$", r"([A-Z]{2})-(\d+)\s*$"


def _accents() -> tuple[str, str]:
    """Latin letters that decompose into a plain letter and marks, with that letter."""
    marked, plain = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        parts = unicodedata.normalize("NFD", chr(code).casefold())
        if len(parts) > 1 and parts[0].isascii() and all(unicodedata.combining(c) for c in parts[1:]):
            marked.append(chr(code))
            plain.append(parts[0])
    return "".join(marked), "".join(plain)


MARKED, PLAIN = _accents()


def filer_name(c: Column) -> Column:
    """Lower case without accents; what stands behind the first comma goes first; no
    punctuation, honorifics or suffixes."""
    t = F.regexp_replace(F.lower(F.translate(c, MARKED, PLAIN)), r"\p{Mn}", "")
    t = F.when(F.contains(t, F.lit(",")), F.concat_ws(" ", F.regexp_extract(t, r"(?s)^[^,]*,(.*)$", 1), F.substring_index(t, ",", 1))).otherwise(t)
    words = F.split(F.trim(F.regexp_replace(t, r"(?U)[^\w]+", " ")), " +")
    return F.array_join(F.filter(words, lambda w: ~w.isin(DROPPED)), " ")


def word(name: Column, i: int) -> Column:
    ws = F.split(name, " ")
    return F.element_at(ws, -1) if i < 0 else F.get(ws, F.lit(i))


def typed_keys(name: Column) -> Column:
    """First and last word; where the first is an initial also second and last."""
    n = F.size(F.split(name, " "))
    key = lambda i: F.concat_ws(" ", word(name, i), word(name, -1))
    return F.array_compact(F.array(F.when(n >= 2, key(0)), F.when((n >= 3) & (F.length(word(name, 0)) == 1), key(1))))


def listed_keys(name: Column) -> Column:
    """First and last word, and second and last where there are three."""
    n = F.size(F.split(name, " "))
    key = lambda i: F.concat_ws(" ", word(name, i), word(name, -1))
    return F.array_compact(F.array(F.when(n >= 2, key(0)), F.when(n >= 3, key(1))))


def member_terms(members: DataFrame) -> DataFrame:
    """(bioguide_id, chamber, start, end, t_state, t_district) of every term."""
    t = members.select("bioguide_id", F.explode("terms").alias("t"))
    chamber = F.when(F.col("t.type") == "rep", "house").when(F.col("t.type") == "sen", "senate")
    return t.select(
        "bioguide_id", chamber.alias("chamber"), F.coalesce("t.start", F.lit("0001-01-01").cast("date")).alias("start"),
        F.coalesce("t.end", F.lit(OPEN).cast("date")).alias("end"), F.col("t.state").alias("t_state"), F.col("t.district").alias("t_district"),
    )


def member_variants(members: DataFrame) -> DataFrame:
    """(bioguide_id, name, since, until) of the names a member may be filed under: those in
    ``variants`` (array of name, since, until), where the table has them, else the full
    name and its first and last word.  Null bounds are open, both ends count."""
    bounds = "struct<name:string,since:date,until:date>"
    if "variants" in members.columns:
        v = members.select("bioguide_id", F.explode("variants").alias("v")).select("bioguide_id", filer_name(F.col("v.name")).alias("name"), F.col("v.since").alias("since"), F.col("v.until").alias("until"))
    else:
        full = filer_name(F.col("full_name"))
        names = F.array_distinct(F.array(full, F.concat_ws(" ", word(full, 0), word(full, -1))))
        v = members.select("bioguide_id", F.explode(F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(None).cast("date").alias("since"), F.lit(None).cast("date").alias("until")).cast(bounds))).alias("v"))
        v = v.select("bioguide_id", "v.*")
    return v.filter(F.col("name") != "").distinct()


def resolve_members(filings: DataFrame, aliases: DataFrame, members: DataFrame) -> DataFrame:
    """(filing_id, bioguide_id, outcome).  An alias of the chamber valid on the date, whose
    member has a term then, decides (alias, or alias_conflict if several members); else
    the whole name of members with a term of the chamber then; else two words of it, only
    where the whole name found none.  One member: matched; several: ambiguous; none:
    unmatched.  ``state`` and ``district`` of a filing, where it has them, must agree with
    the alias or the term (the district only in the house); they are never given up to
    find somebody."""
    hint = lambda c: F.col(c) if c in filings.columns else F.lit(None).cast("string")
    f = filings.select("filing_id", "chamber", "filed_date", hint("state").alias("state"), hint("district").alias("district"), filer_name(F.col("filer_name_raw")).alias("name")).dropDuplicates(["filing_id"])
    ask = ["name", "chamber", "filed_date", "state", "district"]
    asked = f.select(*ask).dropna(subset=ask[:3]).distinct()  # each question once, however many filings ask it
    terms = member_terms(members)
    agrees = lambda h, c: F.col(h).isNull() | F.coalesce(F.col(h) == F.col(c), F.lit(False))

    def serving(found: DataFrame, hinted: bool) -> DataFrame:
        """Of (question, bioguide_id) those with a term of the chamber on the date."""
        t = terms.withColumnRenamed("chamber", "_ch")
        j = found.join(t, "bioguide_id").filter((F.col("chamber") == F.col("_ch")) & (F.col("start") <= F.col("filed_date")) & (F.col("filed_date") <= F.col("end")))
        if hinted:
            j = j.filter(agrees("state", "t_state") & ((F.col("chamber") != "house") | agrees("district", "t_district")))
        return j

    def counted(found: DataFrame, p: str) -> DataFrame:
        g = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("state", "district") else F.col(c) for c in ask]
        return found.groupBy(*g).agg(F.countDistinct("bioguide_id").alias(f"{p}n"), F.min("bioguide_id").alias(f"{p}id"))

    al = aliases.select(
        filer_name(F.col("alias")).alias("name"), F.col("chamber").alias("_ac"), F.col("state").alias("a_state"), F.col("district").alias("a_district"),
        "valid_from", F.coalesce("valid_to", F.lit(OPEN).cast("date")).alias("valid_to"), "bioguide_id",
    ).distinct()
    valid = (F.col("chamber") == F.col("_ac")) & (F.col("valid_from") <= F.col("filed_date")) & (F.col("filed_date") < F.col("valid_to"))
    by_alias = asked.join(al, "name").filter(valid & agrees("state", "a_state") & agrees("district", "a_district")).select(*ask, "bioguide_id")
    variants = member_variants(members)
    open_ = lambda df: df.filter((F.col("since").isNull() | (F.col("since") <= F.col("filed_date"))) & (F.col("until").isNull() | (F.col("filed_date") <= F.col("until")))).select(*ask, "bioguide_id")
    by_name = open_(asked.join(variants, "name"))
    keyed = asked.withColumn("key", F.explode(typed_keys(F.col("name"))))
    by_key = open_(keyed.join(variants.select("bioguide_id", "since", "until", F.explode(listed_keys(F.col("name"))).alias("key")), "key"))
    one = asked.withColumns({c: F.coalesce(c, F.lit("")) for c in ("state", "district")})
    for found, hinted, p in ((by_alias, False, "a"), (by_name, True, "f"), (by_key, True, "k")):
        one = one.join(counted(serving(found, hinted), p), ask, "left")
    outcome = (
        F.when(F.col("an") == 1, "alias").when(F.col("an") > 1, "alias_conflict").when(F.col("fn") == 1, "matched").when(F.col("fn") > 1, "ambiguous")
        .when(F.col("kn") == 1, "matched").when(F.col("kn") > 1, "ambiguous").otherwise("unmatched")
    )
    who = F.when(F.col("an") == 1, F.col("aid")).when(F.col("an") > 1, None).when(F.col("fn") == 1, F.col("fid")).when(F.col("fn") > 1, None).when(F.col("kn") == 1, F.col("kid"))
    one = one.select(*ask, who.alias("bioguide_id"), outcome.alias("outcome"))
    f = f.withColumns({c: F.coalesce(c, F.lit("")) for c in ("state", "district")})
    return f.join(one, ask, "left").select("filing_id", "bioguide_id", F.coalesce("outcome", F.lit("unmatched")).alias("outcome"))


def apply_members(filings: DataFrame, transactions: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Filings and their trades with the member found written to both; null where none was."""
    r = resolved.select("filing_id", F.col("bioguide_id").alias("_b"), "outcome")
    out = lambda df: df.drop("bioguide_id").join(r, "filing_id", "left").withColumnRenamed("_b", "bioguide_id")
    return out(filings), out(transactions).drop("outcome")


def index_hints(index: DataFrame) -> DataFrame:
    """(filing_id, state, district) from the yearly index (doc_id and StateDst such as
    ``MO04``); the district without leading zeros, 0 at large."""
    ok = F.col("state_dst").rlike(SEAT)
    return index.filter(ok & (F.trim("doc_id") != "")).select(
        F.concat(F.lit("house:"), F.trim("doc_id")).alias("filing_id"), F.substring("state_dst", 1, 2).alias("state"),
        F.substring("state_dst", 3, 2).cast("int").cast("string").alias("district"),
    )


def seed_hints(records: DataFrame) -> DataFrame:
    """(filing_id, state, district) from seed records (id, branch, chamber, state, office
    ending in ``CT-04``)."""
    at = lambda i: F.nullif(F.regexp_extract("office", OFFICE, i), F.lit(""))
    house = F.col("chamber") == "house"
    r = records.filter((F.col("branch") == "congress") & F.coalesce(F.col("id") != "", F.lit(False)))
    return r.select(
        F.concat(F.lit("kadoa:"), "id").alias("filing_id"), F.coalesce(F.nullif("state", F.lit("")), F.when(house, at(1))).alias("state"),
        F.when(house, at(2).cast("int").cast("string")).alias("district"),
    )


def pair_amendments(filings: DataFrame, titled: str = "title_date") -> DataFrame:
    """(filing_id, supersedes) of amendments: the one original of the same printed filer
    that bears the same title date or was filed on it; null if there are several or none."""
    a = filings.filter(F.col("filing_kind").endswith("amendment")).select("filing_id", "chamber", "filer_name_raw", F.col(titled).alias("_d"))
    o = filings.filter(~F.col("filing_kind").endswith("amendment")).select(F.col("filing_id").alias("o_id"), "chamber", "filer_name_raw", F.col(titled).alias("_t"), F.col("filed_date").alias("_f"))
    on = ["chamber", "filer_name_raw", "_d"]
    found = a.join(o.withColumnRenamed("_t", "_d"), on).unionByName(a.join(o.withColumnRenamed("_f", "_d"), on), allowMissingColumns=True)
    g = found.filter(F.col("o_id") != F.col("filing_id")).groupBy("filing_id").agg(F.countDistinct("o_id").alias("n"), F.min("o_id").alias("o"))
    return a.select("filing_id").join(g, "filing_id", "left").select("filing_id", F.when(F.col("n") == 1, F.col("o")).alias("supersedes"), F.coalesce("n", F.lit(0)).alias("candidates"))
