"""Readers of archived source files.  Each gives rows and, where rows can be refused, a
``disposition`` column whose values partition everything that was read."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import normalize as N


def _first_of(df: DataFrame, keys: list[str], order: list[str], valid: Column) -> DataFrame:
    """Marks the first valid row of a key accepted, later ones duplicates.  Invalid rows, of
    which many may have no key, are set apart before any are gathered by key."""
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    good = df.filter(valid).withColumn("disposition", F.when(nth == 1, "accepted").otherwise("duplicate"))
    return good.unionByName(df.filter(~valid).withColumn("disposition", F.lit("invalid")))


def house_index(spark: SparkSession, path: str) -> DataFrame:
    """Yearly index: periodic transaction reports with a numeric document id."""
    schema = "Prefix string, Last string, First string, Suffix string, FilingType string, StateDst string, Year string, FilingDate string, DocID string"
    x = spark.read.format("xml").option("rowTag", "Member").schema(schema).load(path).filter(F.col("FilingType") == "P")
    row = x.select(
        F.col("DocID").alias("doc_id"), F.concat_ws(" ", "Prefix", "First", "Last", "Suffix").alias("filer_name_raw"),
        F.substring("StateDst", 1, 2).alias("state"), F.regexp_replace(F.substring("StateDst", 3, 2), "^0", "").alias("district"), N.printed_date(F.col("FilingDate")).alias("filed_date"),
    )
    ok = F.coalesce(F.col("doc_id").rlike("^[0-9]+$") & F.col("filed_date").isNotNull(), F.lit(False))
    return _first_of(row, ["doc_id"], ["filed_date", "filer_name_raw"], ok)


def senate_index(spark: SparkSession, path: str) -> DataFrame:
    """Search result pages: arrays of five strings."""
    x = spark.read.schema("data array<array<string>>").option("multiLine", True).json(path).select(F.explode("data").alias("r"))
    link = F.regexp_extract(F.get("r", F.lit(3)), r'href="([^"]*)"', 1)
    row = x.select(
        F.get("r", F.lit(0)).alias("first"), F.get("r", F.lit(1)).alias("last"), link.alias("link"),
        F.regexp_extract(link, r"([0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})", 1).alias("uuid"), N.printed_date(F.get("r", F.lit(4))).alias("filed_date"), F.size("r").alias("width"),
    )
    ok = F.coalesce((F.col("width") == 5) & (F.col("uuid") != "") & F.col("filed_date").isNotNull(), F.lit(False))
    return _first_of(row, ["uuid"], ["filed_date", "last", "first"], ok).drop("width")


def submissions(spark: SparkSession, path: str) -> DataFrame:
    """A filer's submissions and their history shards (the same arrays at the top level):
    parallel arrays zipped by position, 13F forms only."""
    arrays = "accessionNumber:array<string>,form:array<string>,filingDate:array<string>,reportDate:array<string>"
    x = spark.read.schema(f"cik string, filings struct<recent:struct<{arrays}>>, {arrays.replace(':', ' ')}").option("multiLine", True).json(path)
    own = F.struct(*[F.col(c).alias(c) for c in ("accessionNumber", "form", "filingDate", "reportDate")])
    cik = F.coalesce("cik", F.regexp_extract(F.input_file_name(), r"CIK(\d{10})", 1))  # a shard bears its filer in its name
    x = x.select(N.cik(cik).alias("cik"), F.coalesce("filings.recent", own).alias("s"))
    z = x.select("cik", F.explode(F.arrays_zip("s.accessionNumber", "s.form", "s.filingDate", "s.reportDate")).alias("z"))
    row = z.select("cik", F.col("z.accessionNumber").alias("accession"), F.col("z.form").alias("form"), N.iso_date(F.col("z.filingDate")).alias("filed_date"), N.iso_date(F.col("z.reportDate")).alias("period"))
    row = row.filter(F.col("form").startswith("13F"))
    ok = F.coalesce(F.col("accession").rlike(r"^\d{10}-\d{2}-\d{6}$") & F.col("filed_date").isNotNull(), F.lit(False))
    return _first_of(row, ["accession"], ["filed_date", "cik"], ok)


# The kinds of amendment a cover may print.
AMENDMENTS = {"RESTATEMENT": "RESTATEMENT", "NEW HOLDINGS": "NEW_HOLDINGS"}
MANAGER = "struct<cik:string, name:string, form13FFileNumber:string>"
COVER = (
    "headerData struct<submissionType:string, filerInfo:struct<filer:struct<credentials:struct<cik:string>>, periodOfReport:string>>,"
    f"formData struct<coverPage:struct<reportCalendarOrQuarter:string, isAmendment:string, amendmentNo:string, amendmentInfo:struct<amendmentType:string, amendmentNo:string, confDeniedExpired:string>,"
    f"filingManager:struct<name:string>, form13FFileNumber:string, reportType:string, otherManagerInfo:struct<otherManager:array<{MANAGER}>>>,"
    "summaryPage:struct<tableEntryTotal:string, tableValueTotal:string, isConfidentialOmitted:string, otherIncludedManagersCount:string,"
    "otherManagers2Info:struct<otherManager2:array<struct<sequenceNumber:string, otherManager:struct<cik:string, name:string, form13FFileNumber:string>>>>>>"
)


def covers(spark: SparkSession, path: str) -> DataFrame:
    """13F cover pages with their other managers, both those listed by number in the summary
    and those named on the cover.  The period on the cover goes before that of the
    header.  A missing required field makes the page failed, not absent; a holdings
    report must have both totals."""
    x = spark.read.format("xml").option("rowTag", "edgarSubmission").option("ignoreNamespace", True).schema(COVER).load(path)
    cover, summary = "formData.coverPage", "formData.summaryPage"
    printed = F.coalesce(F.nullif(F.trim(f"{cover}.reportCalendarOrQuarter"), F.lit("")), F.nullif(F.trim("headerData.filerInfo.periodOfReport"), F.lit("")))
    period = F.when(printed.rlike(r"^\d{2}-\d{2}-\d{4}$"), F.try_to_timestamp(printed, F.lit("MM-dd-yyyy")).cast("date"))
    kind = F.upper(N.collapse(F.col(f"{cover}.amendmentInfo.amendmentType")))

    def manager(seq: Column, m: Column) -> Column:
        return F.struct(seq.alias("seq"), m["cik"].alias("cik"), m["name"].alias("name"), N.file_number(m["form13FFileNumber"]).alias("file_number_norm"))

    none = F.array().cast("array<struct<seq:int,cik:string,name:string,file_number_norm:string>>")
    listed = F.transform(f"{summary}.otherManagers2Info.otherManager2", lambda m: manager(N.whole_number(F.trim(m["sequenceNumber"])).cast("int"), m["otherManager"]))
    named = F.transform(f"{cover}.otherManagerInfo.otherManager", lambda m: manager(F.lit(None).cast("int"), m))
    number = lambda c: N.whole_number(F.trim(c))
    row = x.select(
        N.cik(F.col("headerData.filerInfo.filer.credentials.cik")).alias("cik"), F.nullif(F.trim("headerData.submissionType"), F.lit("")).alias("submission_type"), period.alias("period_of_report"),
        F.coalesce(N.yes_no(F.col(f"{cover}.isAmendment")), F.lit(False)).alias("is_amendment"), N.lookup(kind, AMENDMENTS).alias("amendment_type"),
        F.coalesce(number(f"{cover}.amendmentNo"), number(f"{cover}.amendmentInfo.amendmentNo")).cast("int").alias("amendment_no"), F.nullif(F.trim(f"{cover}.filingManager.name"), F.lit("")).alias("manager"),
        F.col(f"{cover}.reportType").alias("report_type"), N.file_number(F.col(f"{cover}.form13FFileNumber")).alias("file_number_norm"),
        number(f"{summary}.tableEntryTotal").alias("table_entry_total"), number(f"{summary}.tableValueTotal").alias("table_value_total_usd"),
        N.yes_no(F.col(f"{summary}.isConfidentialOmitted")).alias("is_confidential_omitted"), N.yes_no(F.col(f"{cover}.amendmentInfo.confDeniedExpired")).alias("conf_denied_expired"),
        number(f"{summary}.otherIncludedManagersCount").cast("int").alias("other_managers_count"), F.concat(F.coalesce(listed, none), F.coalesce(named, none)).alias("other_managers"),
    )
    holdings = F.upper("submission_type").startswith("13F-HR")
    totals = F.col("table_entry_total").isNotNull() & F.col("table_value_total_usd").isNotNull()
    ok = F.col("submission_type").isNotNull() & F.col("period_of_report").isNotNull() & F.col("manager").isNotNull() & (~holdings | totals)
    return row.withColumn("disposition", F.when(ok, "parsed").otherwise("failed"))


def with_fallback(index: DataFrame, parsed: DataFrame) -> DataFrame:
    """A row for every filing of the index (accession, cik, form, filed_date, period): what
    its cover says where that was parsed, else what the index says, its total unknown and
    flagged, so that a failed cover is a failed filing and never a missing one."""
    p = parsed.filter(F.col("disposition") == "parsed").select("accession", F.struct("submission_type", "period_of_report", "is_amendment", "table_value_total_usd", "other_managers").alias("c"))
    j, has = index.join(p, "accession", "left"), F.col("c").isNotNull()
    return j.select(
        "accession", "cik", "filed_date", F.coalesce("c.submission_type", "form").alias("submission_type"), F.coalesce("c.period_of_report", "period").alias("period_of_report"),
        F.when(has, F.col("c.is_amendment")).otherwise(F.col("form").endswith("/A")).alias("is_amendment"), "c.table_value_total_usd", "c.other_managers",
        F.when(has, "parsed").otherwise("failed").alias("parse_status"), F.when(has, F.array().cast("array<string>")).otherwise(F.array(F.lit("cover_failed"))).alias("flags"),
    )


def info_table_name(files: DataFrame) -> DataFrame:
    """(accession, name, outcome): the one XML file of a filing that isn't its cover; none is
    missing, several are ambiguous.  ``files`` has accession and name."""
    ok = F.lower("name").endswith(".xml") & ~F.lower("name").isin("primary_doc.xml")
    g = files.groupBy("accession").agg(F.count_if(ok).alias("n"), F.min(F.when(ok, F.col("name"))).alias("x"))
    return g.select("accession", F.when(F.col("n") == 1, F.col("x")).alias("name"), F.when(F.col("n") == 1, "found").when(F.col("n") == 0, "missing").otherwise("ambiguous").alias("outcome"))


def info_table(spark: SparkSession, path: str) -> DataFrame:
    """Holdings as printed: one row per infoTable, all strings."""
    schema = (
        "nameOfIssuer string, titleOfClass string, cusip string, value string, shrsOrPrnAmt struct<sshPrnamt:string, sshPrnamtType:string>, putCall string,"
        "investmentDiscretion string, otherManager string, votingAuthority struct<Sole:string, Shared:string, None:string>"
    )
    x = spark.read.format("xml").option("rowTag", "infoTable").option("ignoreNamespace", True).schema(schema).load(path)
    return x.select(
        "nameOfIssuer", "titleOfClass", "cusip", "value", "shrsOrPrnAmt.sshPrnamt", "shrsOrPrnAmt.sshPrnamtType", "putCall", "investmentDiscretion", "otherManager",
        F.col("votingAuthority.Sole").alias("votingSole"), F.col("votingAuthority.Shared").alias("votingShared"), F.col("votingAuthority.None").alias("votingNone"),
    )


def normalize_holdings(raw: DataFrame, filed: Column) -> DataFrame:
    """Printed holdings to typed ones; what can't be read is null and flagged."""
    value = N.whole_number(F.trim("value")) * N.unit_multiplier(filed)
    number, shares = N.cusip(F.col("cusip")), N.whole_number(F.trim("sshPrnamt"))
    voting = {c: N.whole_number(F.trim(c)) for c in ("votingSole", "votingShared", "votingNone")}
    unread = lambda c, v: F.coalesce(F.trim(c) != "", F.lit(False)) & v.isNull()
    flags = F.array_compact(F.array(
        F.when(unread("value", value), "value_unparsed"), F.when(unread("sshPrnamt", shares), "shares_unparsed"), F.when(number.isNull(), "cusip_invalid"),
        F.when(~F.coalesce(N.cusip_check_ok(number), F.lit(True)), "cusip_check_failed"),
        F.when(unread("putCall", F.when(F.upper(F.trim("putCall")).isin("PUT", "CALL"), 1)), "put_call_unparsed"),
        *[F.when(unread(c, v), "voting_unparsed") for c, v in voting.items()],
        F.when(F.col("otherManager").isNotNull() & N.sequence_list(F.col("otherManager")).isNull(), "other_manager_unparsed"),
    ))
    side = F.upper(F.trim("putCall"))
    return raw.select(
        N.collapse(F.col("nameOfIssuer")).alias("issuer_name"), F.col("titleOfClass").alias("title_of_class"), number.alias("cusip"), value.alias("value_usd"),
        shares.alias("shares"), F.upper("sshPrnamtType").alias("ssh_type"), F.when(side.isin("PUT", "CALL"), side).alias("put_call"), F.upper(F.trim("investmentDiscretion")).alias("discretion"),
        *[v.alias(a) for a, v in zip(("voting_sole", "voting_shared", "voting_none"), voting.values())],
        N.sequence_list(F.col("otherManager")).alias("other_manager_seqs"), F.array_sort(F.array_distinct(flags)).alias("flags"),
    )


def form_index(spark: SparkSession, path: str) -> DataFrame:
    """Quarterly form index: 13F-HR and its amendments; malformed lines are counted."""
    x = spark.read.text(path).filter(F.col("value").rlike(r"^13F-HR(/A)?\s"))
    at = lambda i: F.regexp_extract("value", r"^(13F-HR(?:/A)?)\s+(.*?)\s+(\d{1,10})\s+(\d{4}-\d{2}-\d{2})\s+(\S+)\s*$", i)
    row = x.select(at(1).alias("form"), at(2).alias("company"), N.cik(at(3)).alias("cik"), N.iso_date(at(4)).alias("filed_date"), at(5).alias("file_name"))
    return row.withColumn("disposition", F.when((F.col("form") != "") & F.col("filed_date").isNotNull(), "accepted").otherwise("malformed"))


# Classes of the list whose numbers follow no check digit.
OPTION_CLASSES = ["CALL", "PUT"]
LIST_STATUS = {"": "", "*A*": "ADDED", "*D*": "DELETED", "ADDED": "ADDED", "DELETED": "DELETED"}


def list13f(spark: SparkSession, path: str) -> DataFrame:
    """The list of 13(f) securities, 80 columns a line, with the disposition of every line."""
    x = spark.read.text(path).filter(F.trim("value") != "")
    mark, status = F.substring("value", 10, 1), F.trim(F.substring("value", 68, 3))
    row = x.select(
        F.substring("value", 1, 9).alias("cusip_raw"), (mark == "*").alias("has_options"), F.trim(F.substring("value", 11, 30)).alias("issuer_name"),
        F.trim(F.substring("value", 41, 27)).alias("class_title"), N.lookup(F.upper(status), LIST_STATUS).alias("status"),
        F.length("value").between(70, 80).alias("width_ok"), mark.isin("*", " ").alias("field_ok"),
    )
    return list_dispositions(row)


def list_dispositions(lines: DataFrame) -> DataFrame:
    """Lines of a list (cusip_raw, has_options, issuer_name, class_title, status, width_ok,
    field_ok), read from text or from a document's cells, with ``disposition``.  A CUSIP
    that is both added and deleted anywhere is refused whole, before anything else.
    Options' numbers are made up and have no check digit.  Of the lines that may count,
    a CUSIP with several definitions is refused whole; else one is accepted, others are
    duplicates and deleted ones are counted.  The values partition the lines."""
    cusip = F.regexp_replace(F.upper("cusip_raw"), r"\s", "")
    row = lines.withColumn("cusip", F.when(cusip.rlike("^[0-9A-Z*@#]{9}$"), cusip)).withColumn("is_option", F.upper(F.trim("class_title")).isin(OPTION_CLASSES))
    per = W.partitionBy("cusip")
    known = F.col("cusip").isNotNull()
    row = row.withColumn("status", F.when(F.col("status").isNull(), "?").otherwise(F.col("status")))
    keyed = row.filter(known).withColumn("_c", (F.count_if(F.col("status") == "ADDED").over(per) > 0) & (F.count_if(F.col("status") == "DELETED").over(per) > 0))
    bad = (
        F.when(F.col("_c"), "status_conflict").when(~F.col("width_ok"), "bad_width").when(~F.col("field_ok") | (F.col("status") == "?"), "bad_field")
        .when(~F.col("is_option") & ~F.coalesce(N.cusip_check_ok(F.col("cusip")), F.lit(False)), "check_digit_failed")
    )
    keyed = keyed.withColumn("_b", bad)
    seed = F.col("_b").isNull() & (F.col("status") != "DELETED")
    definition = F.when(seed, F.struct("issuer_name", "class_title", "is_option", "has_options"))
    keyed = keyed.withColumn("_d", F.min(definition).over(per) != F.max(definition).over(per))
    nth = F.row_number().over(W.partitionBy("cusip", seed).orderBy("status", "class_title", "issuer_name"))
    kind = (
        F.when(F.col("_b").isNotNull(), F.col("_b")).when(F.coalesce("_d", F.lit(False)), "definition_conflict").when(F.col("status") == "DELETED", "deleted")
        .when(nth > 1, "duplicate").when(F.col("is_option"), "accepted_option").otherwise("accepted")
    )
    keyed = keyed.withColumn("disposition", kind).drop("_c", "_b", "_d")
    rest = row.filter(~known).withColumn("disposition", F.when(~F.col("width_ok"), "bad_width").when(~F.col("field_ok"), "bad_field").otherwise("malformed"))
    return keyed.unionByName(rest)


def list_cells(cells: DataFrame) -> DataFrame:
    """The list read from a document: positioned cells (line, column, text) joined to the
    lines that :func:`list_dispositions` takes; cells of one column are joined in order."""
    at = lambda c: F.trim(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.when(F.col("column") == c, F.struct("part", "text")))), lambda x: x["text"])))
    g = cells.groupBy("line").agg(*[at(c).alias(c) for c in ("cusip", "mark", "issuer", "class", "status")])
    cusip = F.regexp_replace("cusip", r"\s", "")
    return list_dispositions(g.select(
        cusip.alias("cusip_raw"), (F.col("mark") == "*").alias("has_options"), F.col("issuer").alias("issuer_name"), F.col("class").alias("class_title"),
        N.lookup(F.upper("status"), LIST_STATUS).alias("status"), (F.length(cusip) == 9).alias("width_ok"), F.col("mark").isin("", "*").alias("field_ok"),
    ))


def same_lines(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, side, n): what one reading of a list has more often than the other; no rows
    where both read the same multiset."""
    both = a.select(*columns, F.lit(1).alias("_n")).unionByName(b.select(*columns, F.lit(-1).alias("_n")))
    g = both.groupBy(*columns).agg(F.sum("_n").alias("n")).filter(F.col("n") != 0)
    return g.select(*columns, F.when(F.col("n") > 0, "first").otherwise("second").alias("side"), F.abs("n").alias("n"))


def fails_to_deliver(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated, columns by the header's names."""
    x = spark.read.option("header", True).option("sep", "|").option("mode", "PERMISSIVE").csv(path)
    name = {c.upper().strip(): c for c in x.columns}
    day = F.try_to_timestamp(F.col(f"`{name['SETTLEMENT DATE']}`"), F.lit("yyyyMMdd")).cast("date")
    row = x.select(
        day.alias("settled"), N.cusip(F.col(f"`{name['CUSIP']}`")).alias("cusip"), N.identity_ticker(F.col(f"`{name['SYMBOL']}`")).alias("ticker"),
        N.whole_number(F.trim(F.col(f"`{name['QUANTITY (FAILS)']}`"))).alias("quantity"), F.trim(F.col(f"`{name['DESCRIPTION']}`")).alias("description"),
    )
    valid = F.col("settled").isNotNull() & F.col("cusip").isNotNull()
    out = _first_of(row, ["settled", "cusip", "ticker"], ["quantity"], valid)
    return out.withColumn("disposition", F.when(F.col("ticker").isNull() & (F.col("disposition") != "invalid"), "blank_symbol").otherwise(F.col("disposition")))


def company_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Ticker snapshot.  A filer with two titles has all its rows refused, before duplicates
    are looked for."""
    x = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<cik_str:bigint,ticker:string,title:string>>")).alias("k", "r"))
    row = x.select(N.cik(F.col("r.cik_str").cast("string")).alias("cik"), N.identity_ticker(F.col("r.ticker")).alias("ticker"), N.collapse(F.col("r.title")).alias("title"))
    w = W.partitionBy("cik")
    conflict = F.min("title").over(w) != F.max("title").over(w)
    nth = F.row_number().over(W.partitionBy("cik", "ticker").orderBy("title"))
    bad = F.col("cik").isNull() | F.col("ticker").isNull()
    return row.withColumn("disposition", F.when(bad, "invalid").when(conflict, "title_conflict").when(nth == 1, "accepted").otherwise("duplicate"))


def seed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Seed records by their id: those of a chamber become trade rows, others are counted."""
    x = spark.read.schema("id string, chamber string, name string, transaction_date string, filing_date string, owner string, ticker string, asset string, type string, amount string").json(path)
    k = N.seed_id(F.col("id"))
    kind = F.when(k.isNotNull() & k["key"].isNotNull(), "congress").when(F.col("id").startswith("oge"), "oge").otherwise("invalid")
    date = lambda c: F.coalesce(N.iso_date(F.col(c)), N.printed_date(F.col(c)))
    bounds = N.amount_bounds(F.col("amount"))
    return x.withColumn("k", k).select(
        "id", F.concat(F.lit("kadoa:"), "k.key").alias("filing_id"), F.coalesce("k.chamber", "chamber").alias("chamber"), F.col("k.row").alias("row_no"), F.col("name").alias("filer_name_raw"),
        date("transaction_date").alias("transaction_date"), date("filing_date").alias("filed_date"), N.owner(F.col("owner")).alias("owner"), N.printed_ticker(F.col("ticker")).alias("ticker"),
        N.collapse(F.col("asset")).alias("asset_name"), N.side(F.col("type")).alias("side"), bounds["low"].alias("amount_low"), bounds["high"].alias("amount_high"), kind.alias("disposition"),
    )


class _Table(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None


# The header of an electronic report's table.
HEADER = ["#", "Transaction Date", "Owner", "Ticker", "Asset Name", "Asset Type", "Type", "Amount", "Comment"]


def report_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Rows of report pages whose table has exactly the known header; other pages give
    one row with the status no_table or bad_header."""
    k = pages.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, text in zip(f["k"], f["h"]):
                p = _Table()
                p.feed(text or "")
                rows = [r for r in p.rows if r]
                if not rows:
                    out.append((i, "no_table", *[None] * 9))
                elif rows[0] != HEADER:
                    out.append((i, "bad_header", *[None] * 9))
                else:
                    out += [(i, "row" if len(r) == 9 else "malformed", *(r + [None] * 9)[:9]) for r in rows[1:]]
            yield pd.DataFrame(out, columns=["k", "status", *[f"c{n}" for n in range(9)]])

    out = pages.select(F.col(key).alias("k"), F.col(html).alias("h")).mapInPandas(run, f"k {k}, status string, " + ", ".join(f"c{n} string" for n in range(9)))
    names = ["row_no", "transaction_date", "owner", "ticker", "asset_name", "asset_type", "side", "amount", "comment"]
    return out.select(F.col("k").alias(key), "status", *[F.col(f"c{n}").alias(c) for n, c in enumerate(names)])


def normalize_rows(raw: DataFrame, filed: Column) -> DataFrame:
    """Printed trade rows to typed ones, with the flags of what could not be read."""
    traded = N.printed_date(F.col("transaction_date"))
    gains = N.capital_gains(F.col("cap_gains") if "cap_gains" in raw.columns else F.lit(None).cast("string"), F.lit("cap_gains" in raw.columns))
    bounds, tick, side = N.amount_bounds(F.col("amount")), N.printed_ticker(F.col("ticker")), N.side(F.col("side"))
    flags = F.array_sort(F.array_compact(F.array(
        F.when(traded.isNull(), "date_missing"), F.when(N.date_anomaly(traded, filed), "date_anomaly"), F.when(tick.isNull(), "missing_ticker"),
        F.when(side == "other", "side_unparsed"), bounds["flag"], gains["flag"], F.when(F.col("owner").isNotNull() & (F.trim("owner") != "") & N.owner(F.col("owner")).isNull(), "owner_unparsed"),
        F.when(F.coalesce(F.trim("asset_name"), F.lit("")) == "", "asset_unparsed"),
    )))
    return raw.select(
        traded.alias("transaction_date"), N.days_to_file(traded, filed).alias("days_to_file"), N.is_late(traded, filed).alias("is_late"), N.owner(F.col("owner")).alias("owner"), tick.alias("ticker"),
        F.coalesce(F.nullif(N.collapse(F.col("asset_name")), F.lit("")), F.lit("(unparsed asset)")).alias("asset_name"), N.asset_type(F.col("asset_name")).alias("asset_type"), side.alias("side"),
        bounds["low"].alias("amount_low"), bounds["high"].alias("amount_high"), gains["over"].alias("cap_gains_over"), N.comment(F.col("comment")).alias("comment"), flags.alias("flags"),
    )
