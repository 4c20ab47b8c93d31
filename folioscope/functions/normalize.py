"""Column functions that bring printed values into one form; nothing is guessed.

Every function takes and gives Columns, stays in the JVM, and maps null to null
unless it says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Printed codes and labels.
SIDES = {
    "p": "purchase", "s": "sale", "s(partial)": "sale_partial", "e": "exchange",
    "purchase": "purchase", "sale(full)": "sale", "sale(partial)": "sale_partial", "exchange": "exchange",
}
OWNERS = {"sp": "spouse", "dc": "child", "jt": "joint", "self": "self", "spouse": "spouse", "child": "child", "joint": "joint"}
AMOUNTS = [
    ("$1,001 - $15,000", 1_001, 15_000), ("$15,001 - $50,000", 15_001, 50_000), ("$50,001 - $100,000", 50_001, 100_000),
    ("$100,001 - $250,000", 100_001, 250_000), ("$250,001 - $500,000", 250_001, 500_000),
    ("$500,001 - $1,000,000", 500_001, 1_000_000), ("$1,000,001 - $5,000,000", 1_000_001, 5_000_000),
    ("$5,000,001 - $25,000,000", 5_000_001, 25_000_000), ("$25,000,001 - $50,000,000", 25_000_001, 50_000_000),
    ("Over $50,000,000", 50_000_001, None), ("Over $1,000,000", 1_000_001, None), ("Spouse/DC Over $1,000,000", 1_000_001, None),
]
PARSE_DEFECTS = ["amount_unparsed", "asset_unparsed", "owner_unparsed", "row_incomplete", "side_unparsed"]
LATE_DAYS = 45
WHOLE_DOLLARS_SINCE = "2023-01-03"


def collapse(c: Column) -> Column:
    """Any white space, also Unicode's, as single spaces; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def lookup(key: Column, table: dict[str, str]) -> Column:
    """A small fixed table as one expression."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def side(c: Column) -> Column:
    """Side of a trade; what is not known is 'other'."""
    return F.coalesce(lookup(F.lower(F.regexp_replace(c, r"(?U)\s", "")), SIDES), F.lit("other"))


def owner(c: Column) -> Column:
    """Owner of an asset; blank or unknown is null."""
    return lookup(F.lower(F.trim(c)), OWNERS)


def printed_ticker(c: Column) -> Column:
    """Upper case; blank and ``--`` are null."""
    t = F.upper(F.trim(c))
    return F.when(~t.isin("", "--"), t)


def identity_ticker(c: Column) -> Column:
    """A ticker usable as an identifier, else null."""
    t = F.upper(F.trim(c))
    return F.when(t.rlike(r"^[A-Z][A-Z0-9]*([.\-][A-Z0-9]+)*$"), t)


def asset_type(c: Column) -> Column:
    """The last two-letter code in square brackets."""
    tags = F.regexp_extract_all(c, F.lit(r"\[([A-Za-z]{2})\]"), F.lit(1))
    return F.upper(F.try_element_at(tags, F.lit(-1)))


def amount_label(low: Column, high: Column) -> Column:
    """The printed label of an amount range."""
    out = None
    for label, a, b in AMOUNTS[:10]:
        hit = (low == a) & (high.isNull() if b is None else high == b)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def amount_bounds(label: Column) -> Column:
    """struct<low, high, flag> of a printed label: an unknown label is flagged, a blank
    one is not."""
    key = F.lower(collapse(label))
    bounds = "struct<low:bigint,high:bigint,flag:string>"
    out = F.when(key.isNull() | (key == ""), F.lit(None).cast(bounds))
    for text, a, b in AMOUNTS:
        flag = "amount_spouse_cap" if text.endswith("Over $1,000,000") else None
        out = out.when(key == text.lower(), F.struct(F.lit(a).cast("long").alias("low"), F.lit(b).cast("long").alias("high"), F.lit(flag).cast("string").alias("flag")))
    none = F.lit(None).cast("long")
    return out.otherwise(F.struct(none.alias("low"), none.alias("high"), F.lit("amount_unparsed").alias("flag")))


def printed_date(c: Column) -> Column:
    """A date printed M/D/YYYY; impossible dates are null."""
    t = F.trim(c)
    return F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(t, F.lit("M/d/yyyy")).cast("date"))


def iso_date(c: Column) -> Column:
    """A canonical ISO date, else null."""
    d = F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & (F.date_format(d, "yyyy-MM-dd") == c), d)


def comment(c: Column) -> Column:
    t = collapse(c)
    return F.when(~t.isin("", "--"), t)


def days_to_file(traded: Column, filed: Column) -> Column:
    return F.datediff(filed, traded)


def is_late(traded: Column, filed: Column) -> Column:
    return days_to_file(traded, filed) > LATE_DAYS


def date_anomaly(traded: Column, filed: Column) -> Column:
    return filed < traded


def cik(c: Column) -> Column:
    """Ten digits with leading zeros; null if it is no such number."""
    digits = F.regexp_extract(F.lower(F.trim(c)), r"^(?:cik)?\s*0*([0-9]{1,10})$", 1)
    return F.when(digits != "", F.lpad(digits, 10, "0"))


def file_number(c: Column) -> Column:
    """``028-04545`` and its like as prefix and number without leading zeros."""
    at = lambda i: F.regexp_extract(F.trim(c), r"^0*([0-9]+)-0*([0-9]+)$", i)
    return F.when(at(1) != "", F.concat(F.lpad(at(1), 3, "0"), F.lit("-"), at(2)))


def cusip(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return F.when(t.rlike("^[0-9A-Z]{9}$"), t)


def cusip_check_ok(c: Column) -> Column:
    """Whether the ninth sign is the check digit of the eight before it: every second
    value doubled, the digits of all summed.  Digits count as they are, letters from 10,
    and the fill signs ``* @ #`` are 36 to 38."""
    signs = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.substr(c, i, F.lit(1)))
    letter = lambda s: F.when(s == "*", 36).when(s == "@", 37).when(s == "#", 38).otherwise(F.ascii(s) - 55)
    number = lambda s: F.when(s.rlike("[0-9]"), s.try_cast("int")).otherwise(letter(s))
    doubled = F.transform(signs, lambda s, i: number(s) * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.floor(x / 10).cast("int") + x % 10)
    return F.when(c.rlike("^[0-9A-Z*@#]{8}[0-9]$"), (10 - total % 10) % 10 == F.substring(c, 9, 1).try_cast("int"))


def issuer_name(c: Column) -> Column:
    return F.upper(collapse(c))


def unit_multiplier(filed: Column) -> Column:
    """Values are in whole dollars since 2023-01-03, in thousands before."""
    return F.when(filed >= F.lit(WHOLE_DOLLARS_SINCE).cast("date"), 1).when(filed.isNotNull(), 1000)


def whole_number(c: Column) -> Column:
    return F.when(c.rlike(r"^-?\d+$"), c.try_cast("long"))


def sequence_list(c: Column) -> Column:
    """Comma-separated whole numbers; null if a part is empty or no number."""
    parts = F.transform(F.split(c, ","), lambda x: whole_number(F.trim(x)))
    return F.when(~F.exists(parts, lambda x: x.isNull()), parts)


def position_key(security: Column, cusip_: Column) -> Column:
    return F.coalesce(F.concat(F.lit("sid:"), security), F.concat(F.lit("cusip:"), cusip_))


def put_call_bucket(c: Column) -> Column:
    return F.when(c.isin("PUT", "CALL"), c).otherwise("LONG")


def unit_key(c: Column) -> Column:
    return F.when(c.isin("SH", "PRN"), c).otherwise("UNKNOWN")


def issuer_key(cusip_: Column, name: Column, entity: Column | None = None) -> Column:
    """Entity if resolved, else the CUSIP's issuer block, else the name."""
    weak = F.when(F.length(cusip_) >= 6, F.concat(F.lit("cusip6:"), F.substring(cusip_, 1, 6))).otherwise(F.concat(F.lit("name:"), issuer_name(name)))
    return weak if entity is None else F.coalesce(F.concat(F.lit("entity:"), entity), weak)


def flags_json(c: Column) -> Column:
    """Sorted distinct flags as JSON text."""
    return F.to_json(F.array_sort(F.array_distinct(c)))


def mask_flags(mask: Column, names: list[str]) -> Column:
    """The names whose bit is set."""
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(1 << i) != 0, n) for i, n in enumerate(names)]))


def has_parse_defect(flags: Column) -> Column:
    return F.arrays_overlap(flags, F.array(*[F.lit(x) for x in PARSE_DEFECTS]))


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def quarter_tag(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("q"), F.quarter(d).cast("string"))


def filing_deadline(d: Column) -> Column:
    """45 days after the quarter's end, inclusive."""
    return F.date_add(quarter_end(d), LATE_DAYS)


def party_code(c: Column) -> Column:
    return F.when(c.startswith("D"), "D").when(c.startswith("R"), "R").when(c.startswith("I"), "I").otherwise("")


def share_bps(value: Column, total: Column) -> Column:
    """Whole basis points; null where the total isn't positive."""
    v, t = value.cast("decimal(26,0)"), total.cast("decimal(26,0)")
    return F.when(total > 0, F.floor(v * 10000 / t).cast("long"))


def cover_tolerance(total: Column) -> Column:
    return F.when(total.isNotNull(), F.greatest(F.lit(1000), F.floor(total / 1000)).cast("long"))


def money_text(c: Column) -> Column:
    """$999, $1.5K, $230M, $4.0B, $1.2T: one decimal, none from 100 on; losses with a minus."""
    size, sign = F.abs(c).cast("decimal(20,0)"), F.when(c < 0, "−").otherwise("")

    def scaled(div: int, unit: str) -> Column:
        v = size / F.lit(div)
        text = F.when(v >= 100, F.round(v, 0).cast("long").cast("string")).otherwise(F.round(v, 1).cast("decimal(38,1)").cast("string"))
        return F.concat(sign, F.lit("$"), text, F.lit(unit))

    return (
        F.when(size >= 10**12, scaled(10**12, "T")).when(size >= 10**9, scaled(10**9, "B")).when(size >= 10**6, scaled(10**6, "M"))
        .when(size >= 1000, scaled(1000, "K")).otherwise(F.concat(sign, F.lit("$"), size.cast("string")))
    )


def bound_text(c: Column) -> Column:
    """A bound of an amount in K or M, with one decimal only where it isn't whole."""
    def scaled(div: int, unit: str) -> Column:
        v = F.round(c.cast("decimal(20,0)") / F.lit(div), 1)
        return F.concat(F.lit("$"), F.regexp_replace(v.cast("decimal(38,1)").cast("string"), r"\.0$", ""), F.lit(unit))

    return F.when(c >= 10**6, scaled(10**6, "M")).otherwise(scaled(1000, "K"))


def range_text(low: Column, high: Column) -> Column:
    """A range between printed boundaries: a floor of $X+1 shows as $X."""
    floor = F.when(low % 1000 == 1, low - 1).otherwise(low)
    return (
        F.when(low.isNull() & high.isNull(), F.lit(None).cast("string"))
        .when(high.isNull(), F.concat(F.lit("Over "), bound_text(floor)))
        .when(low.isNull(), F.concat(F.lit("Under "), bound_text(high)))
        .otherwise(F.concat_ws("–", bound_text(floor), bound_text(high)))
    )


def band_position(c: Column) -> Column:
    """Place of an amount on a logarithmic scale from $1K to $50M, 0 to 1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.log10(F.greatest(c, F.lit(1)).cast("double")) - 3.0) / F.lit(4.698970004336019)))


def earliest_term(terms: Column) -> Column:
    return F.array_min(F.transform(terms, lambda t: t["start"]))


def row_fingerprint(columns: dict[str, Column]) -> Column:
    """SHA-256 over the canonical JSON object of the columns (flat strings and nulls, keys
    in sorted order)."""
    ordered = F.struct(*[columns[k].alias(k) for k in sorted(columns)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def record_id(filing: Column, fingerprint: Column, nth: Column) -> Column:
    """Identity of a row: its filing, 32 signs of its fingerprint, and a number from the
    second equal row on."""
    again = F.when(nth > 1, F.concat(F.lit("#"), nth.cast("string"))).otherwise("")
    return F.concat(filing, F.lit(":"), F.substring(fingerprint, 1, 32), again)


def provisional_security(kind: Column, value: Column) -> Column:
    """A security's id derived from the identifier it is first known by."""
    return F.concat(F.lit("sec:prov:"), F.substring(row_fingerprint({"id_type": kind, "value": value}), 1, 32))


def capital_gains(c: Column, present: Column) -> Column:
    """struct<over, flag>: null where the form has no such column, 0 for an empty cell, 1
    for a tick, null and flagged for anything else."""
    t = F.trim(F.coalesce(c, F.lit("")))
    ticked = F.lower(t).isin("x", "☑", "☒", "✓", "✔", "yes", "true", "gfedcb")
    over = F.when(~present, F.lit(None).cast("int")).when(t == "", 0).when(ticked, 1)
    return F.struct(over.alias("over"), F.when(present & (t != "") & ~ticked, "cap_gains_unparsed").alias("flag"))


def utc_instant(c: Column) -> Column:
    """An ISO instant with any offset as UTC text; without an offset it is UTC already;
    null if it is none."""
    t = F.trim(c)
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    zoned = F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & t.rlike(r"[T ]"), t).otherwise(F.concat(F.when(F.length(t) == 10, F.concat(t, F.lit("T00:00:00"))).otherwise(t), F.lit("Z")))
    return F.when(ok, F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(F.regexp_replace(zoned, " ", "T")).cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def year_band(year: Column) -> Column:
    """The fixed bands of filing years; a year outside them is an error."""
    band = F.when(year.between(2012, 2015), "2012-2015").when(year.between(2016, 2019), "2016-2019").when(year.between(2020, 2023), "2020-2023").when(year.between(2024, 2039), "2024+")
    return F.when(year.isNotNull(), F.coalesce(band, F.raise_error(F.concat(F.lit("year out of range: "), year.cast("string"))).cast("string")))


def seed_id(c: Column) -> Column:
    """struct<chamber, key, kind, row> of a seed record's id such as ``house-123-ptr-4``."""
    at = lambda i: F.nullif(F.regexp_extract(c, r"^(house|senate)[-_:]([^-_:]+)(?:[-_:]([a-z]+))?(?:[-_:](\d+))?$", i), F.lit(""))
    return F.when(c.rlike(r"^(house|senate)[-_:]"), F.struct(at(1).alias("chamber"), at(2).alias("key"), at(3).alias("kind"), at(4).cast("int").alias("row")))


def page_ticker(c: Column) -> Column:
    """A ticker as pages show it: trimmed, white space inside kept; blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


def yes_no(c: Column) -> Column:
    """true or false as printed; anything else is null."""
    t = F.lower(F.trim(c))
    return F.when(t == "true", True).when(t == "false", False)
