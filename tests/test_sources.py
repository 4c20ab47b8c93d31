"""Parsers on small files, the catalogue's paging, and the stream against the batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from folioscope.plans import catalog
from folioscope.sources import parsers as S
from folioscope.streaming.filings import daily_counts, latest_filings, stream, upsert_into, upserted


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def kinds(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns, "disposition").collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_house_index(spark, tmp_path):
    m = "<Member><Prefix>Hon.</Prefix><Last>{}</Last><First>A</First><FilingType>{}</FilingType><StateDst>TN06</StateDst><Year>2015</Year><FilingDate>{}</FilingDate><DocID>{}</DocID></Member>"
    p = write(tmp_path, "x.xml", "<FD>" + m.format("X", "P", "4/7/2015", "20001") + m.format("X", "P", "4/7/2015", "20001") + m.format("Y", "C", "4/7/2015", "1") + m.format("Z", "P", "4/7/2015", "A9") + m.format("W", "P", "13/7/2015", "3") + "</FD>")
    df = S.house_index(spark, p)
    assert kinds(df, "doc_id") == [("20001", "accepted"), ("20001", "duplicate"), ("3", "invalid"), ("A9", "invalid")]
    r = df.filter("disposition = 'accepted'").first()
    assert (r.state, r.district, r.filed_date, r.filer_name_raw) == ("TN", "6", dt.date(2015, 4, 7), "Hon. A X")


def test_senate_index_and_pages(spark, tmp_path):
    u = "11112222-3333-4444-5555-666677778888"
    row = ["A", "B", "B, A", f'<a href="/view/ptr/{u}/">PTR</a>', "01/02/2020"]
    p = write(tmp_path, "i.json", json.dumps({"draw": 1, "data": [row, row, ["x"], [*row[:3], "none", row[4]]]}))
    assert [k for *_, k in kinds(S.senate_index(spark, p), "uuid")] == ["invalid", "invalid", "accepted", "duplicate"]
    head = "<tr>" + "".join(f"<th>{h}</th>" for h in S.HEADER) + "</tr>"
    good = f"<table>{head}<tr><td>1</td><td>1/5/2020</td><td>Self</td><td>ABC</td><td>Acme <b>Corp</b> [ST]</td><td>Stock</td><td>Sale (Full)</td><td>$1,001 - $15,000</td><td>--</td></tr><tr><td>2</td></tr></table>"
    df = S.report_pages(spark.createDataFrame([(1, good), (2, "<table><tr><th>x</th></tr></table>"), (3, None), (4, "no")], "k long, html string"), "k", "html")
    assert sorted((r.k, r.status) for r in df.collect()) == [(1, "malformed"), (1, "row"), (2, "bad_header"), (3, "no_table"), (4, "no_table")]
    t = S.normalize_rows(df.filter("status = 'row'"), F.lit("2020-03-01").cast("date")).first()
    assert (t.transaction_date, t.days_to_file, t.is_late, t.owner, t.ticker, t.asset_type, t.side, t.amount_low, t.comment, t.flags) == (dt.date(2020, 1, 5), 56, True, "self", "ABC", "ST", "sale", 1001, None, [])


def test_submissions_and_forms(spark, tmp_path):
    recent = {"accessionNumber": ["0000000001-22-000001", "0000000001-22-000001", "bad", "0000000001-22-000003"], "form": ["13F-HR", "13F-HR", "13F-NT", "10-K"], "filingDate": ["2022-05-01"] * 4, "reportDate": ["2022-03-31"] * 4}
    p = write(tmp_path, "s.json", json.dumps({"cik": "1", "filings": {"recent": recent}}))
    assert [k for *_, k in kinds(S.submissions(spark, p), "accession")] == ["accepted", "duplicate", "invalid"]
    p = write(tmp_path, "form.idx", "Form Type\n13F-HR  ACME CAPITAL LLC  12345  2022-05-01  edgar/1.txt\n13F-HR/A  B C  77  2022-05-99  x\n10-K Z 1 2022-01-01 y\n13F-HR broken\n")
    assert kinds(S.form_index(spark, p), "cik") == [(None, "malformed"), ("0000000077", "malformed"), ("0000012345", "accepted")]


def test_holdings_xml(spark, tmp_path):
    cover = """<edgarSubmission><headerData><submissionType>13F-HR/A</submissionType><filerInfo><filer><credentials><cik>123</cik></credentials></filer><periodOfReport>03-31-2022</periodOfReport></filerInfo></headerData>
<formData><coverPage><reportCalendarOrQuarter>06-30-2022</reportCalendarOrQuarter><otherManagerInfo><otherManager><form13FFileNumber>28-88</form13FFileNumber><name>Named</name></otherManager></otherManagerInfo><isAmendment>true</isAmendment><amendmentInfo><amendmentType>RESTATEMENT</amendmentType><amendmentNo>2</amendmentNo></amendmentInfo><filingManager><name>Acme</name></filingManager><form13FFileNumber>028-04545</form13FFileNumber></coverPage>
<summaryPage><tableEntryTotal>3</tableEntryTotal><tableValueTotal>1000</tableValueTotal><otherManagers2Info><otherManager2><sequenceNumber>2</sequenceNumber><otherManager><cik>9</cik><form13FFileNumber>028-00077</form13FFileNumber><name>Other</name></otherManager></otherManager2></otherManagers2Info></summaryPage></formData></edgarSubmission>"""
    r = S.covers(spark, write(tmp_path, "c.xml", cover)).first()
    assert (r.cik, r.period_of_report, r.is_amendment, r.amendment_no, r.file_number_norm, r.table_value_total_usd, r.disposition) == ("0000000123", dt.date(2022, 6, 30), True, 2, "028-4545", 1000, "parsed")
    assert [(m.seq, m.file_number_norm) for m in r.other_managers] == [(2, "028-77"), (None, "028-88")] and r.amendment_type == "RESTATEMENT"
    assert S.covers(spark, write(tmp_path, "e.xml", cover.replace("<tableEntryTotal>3</tableEntryTotal>", ""))).first().disposition == "failed"
    assert S.covers(spark, write(tmp_path, "d.xml", "<edgarSubmission><headerData><submissionType>13F-HR</submissionType></headerData></edgarSubmission>")).first().disposition == "failed"
    row = "<infoTable><nameOfIssuer>APPLE  INC</nameOfIssuer><titleOfClass>COM</titleOfClass><cusip>{}</cusip><value>{}</value><shrsOrPrnAmt><sshPrnamt>10</sshPrnamt><sshPrnamtType>SH</sshPrnamtType></shrsOrPrnAmt><putCall>Put</putCall><otherManager>{}</otherManager><votingAuthority><Sole>10</Sole><Shared>0</Shared><None>0</None></votingAuthority></infoTable>"
    raw = S.info_table(spark, write(tmp_path, "t.xml", "<informationTable>" + row.format("037833100", "5", "1,2") + row.format("bad", "x", "1,,2") + "</informationTable>"))
    a, b = S.normalize_holdings(raw, F.lit("2022-05-01").cast("date")).orderBy(F.col("cusip").desc_nulls_last()).collect()
    assert (a.issuer_name, a.value_usd, a.shares, a.put_call, a.other_manager_seqs, a.flags) == ("APPLE INC", 5000, 10, "PUT", [1, 2], [])
    assert (b.value_usd, b.flags) == (None, ["cusip_invalid", "other_manager_unparsed", "value_unparsed"])


def test_registries(spark, tmp_path):
    line = lambda c, name, status, kind="COM": f"{c:<9}*{name:<30}{kind:<27}{status:<3}".ljust(80)
    p = write(tmp_path, "l.txt", "\n".join([line("037833100", "APPLE", ""), line("037833100", "APPLE", ""), line("037833101", "BAD", ""), line("594918104", "MSFT", "*A*"), line("594918104", "MSFT", "*D*"), line("037833908", "APPLE", "", "CALL"), line("02079K305", "A", ""), line("02079K305", "B", ""), line("88160R101", "T", "*D*"), line("11135F101", "X", "*Z*"), "short"]))
    got = S.list13f(spark, p)
    assert sorted((r.cusip_raw.strip(), r.disposition) for r in got.collect()) == sorted([
        ("037833100", "accepted"), ("037833100", "duplicate"), ("037833101", "check_digit_failed"), ("594918104", "status_conflict"), ("594918104", "status_conflict"),
        ("037833908", "accepted_option"), ("02079K305", "definition_conflict"), ("02079K305", "definition_conflict"), ("88160R101", "deleted"), ("11135F101", "bad_field"), ("short", "bad_width"),
    ])
    cells = [(0, "cusip", 0, "037833 10"), (0, "cusip", 1, "0"), (0, "issuer", 0, "APPLE"), (0, "class", 0, "COM"), (0, "mark", 0, "*"), (0, "status", 0, "")]
    read = S.list_cells(spark.createDataFrame(cells, "line int, column string, part int, text string"))
    assert [(r.cusip, r.has_options, r.disposition) for r in read.collect()] == [("037833100", True, "accepted")]
    assert S.same_lines(read, got.filter("disposition in ('accepted')").limit(1), ["cusip", "issuer_name"]).count() == 0
    files = spark.createDataFrame([("a", "primary_doc.xml"), ("a", "t.xml"), ("b", "primary_doc.xml"), ("c", "x.xml"), ("c", "y.xml")], "accession string, name string")
    assert {r.accession: r.outcome for r in S.info_table_name(files).collect()} == {"a": "found", "b": "missing", "c": "ambiguous"}
    p = write(tmp_path, "f.txt", "SETTLEMENT DATE|CUSIP|SYMBOL|QUANTITY (FAILS)|DESCRIPTION|PRICE\n20220103|037833100|AAPL|10|APPLE|1\n20220103|037833100|AAPL|10|APPLE|1\n20220103|037833100||5|APPLE|1\nTrailer 3\n")
    assert [k for *_, k in kinds(S.fails_to_deliver(spark, p), "cusip")] == ["invalid", "accepted", "blank_symbol", "duplicate"]
    p = write(tmp_path, "t.json", json.dumps({"0": {"cik_str": 1, "ticker": "AA", "title": "A"}, "1": {"cik_str": 1, "ticker": "AA", "title": "A"}, "2": {"cik_str": 2, "ticker": "BB", "title": "B"}, "3": {"cik_str": 2, "ticker": "BC", "title": "B2"}}))
    assert [k for *_, k in kinds(S.company_tickers(spark, p), "cik", "ticker")] == ["accepted", "duplicate", "title_conflict", "title_conflict"]
    p = write(tmp_path, "k.json", '{"id": "house-1-ptr-4", "transaction_date": "2020-01-02", "type": "P", "amount": "$1,001 - $15,000"}\n{"id": "oge-2"}\n{"id": null}\n')
    assert sorted(r.disposition for r in S.seed_rows(spark, p).collect()) == ["congress", "invalid", "oge"]


def test_bookmarks_and_envelope(spark):
    r = [(i, i % 4 if i % 5 else None, f"n{i % 3}") for i in range(40)]
    df = spark.createDataFrame(r, "id int, v int, s string")
    keys = [catalog.Key("v", True), catalog.Key("s"), catalog.Key("id")]
    page, seen = catalog.envelope("q", df, keys, "2024-01-01", 7), []
    while True:
        seen += [x["id"] for x in page["results"]]
        if page["next"] is None:
            break
        page = catalog.envelope("q", df, keys, "2024-01-01", 7, page["next"])
    assert seen == [x[0] for x in sorted(r, key=lambda x: (x[1] is None, -(x[1] or 0), x[2], x[0]))]
    mark = catalog.bookmark("q", [1, "n0", 5])
    for bad in ("x", "e30="):
        with pytest.raises(ValueError):
            catalog.opened(bad, "q", keys)
    with pytest.raises(ValueError):
        catalog.opened(mark, "other", keys)


def test_questions(spark):
    c = catalog.Catalog(spark, "/root/testdata/sf0.001")
    top = c.biggest_moves("add").first()
    assert top.change_kind == "add" and c.member_lookup("KEN").count() > 0
    assert c.filer_holdings(top.cik).count() > 0 and c.filer_holdings(top.cik, top.period, "qoq").count() > 0
    who = c.recent_trades(limit=500).filter("bioguide_id is not null").first()
    for q in (c.member_activity(who.bioguide_id), c.member_flows(who.bioguide_id), c.trade_health(), c.filer_lookup(top.cik.lstrip("0")), c.holding_health(), c.latest_filings("2012-01-01"), c.health()):
        assert q.count() > 0
    assert len(c.questions()) == 13
    with pytest.raises(ValueError):
        c.biggest_moves("up")
    assert c.filer_snapshot(top.cik)["concentration"] and c.filer_snapshot("0") is None and c.filer_snapshot(top.cik, "1999-12-31")["available"]
    assert c.absent_changes(top.cik, top.period) is None and "no report" in c.absent_changes(top.cik, "1999-12-31") and c.absent_changes("0", "x") == "no such filer"
    names = spark.createDataFrame([(top.cik, "Acme Capital")], "cik string, filer_name string")
    assert [r.cik for r in c.filer_lookup("CAPIT", names).collect()] == [top.cik]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"f{i % 20}", "house", "active" if i % 3 else "retired", dt.datetime(2024, 1, 1 + i % 20), i % 20) for i in range(40)]
    df = spark.createDataFrame(rows, "filing_id string, chamber string, lifecycle string, ingested_at timestamp_ntz, n int").distinct()
    src = str(tmp_path / "in")
    for k in range(3):
        df.filter(F.col("n") % 3 == k).coalesce(1).write.mode("append").parquet(src)
    for name, q, batch in (("a", latest_filings, df.filter("lifecycle = 'active'").select("filing_id").distinct()), ("b", daily_counts, None)):
        s = q(stream(spark, src, df.schema, 1)).writeStream.format("memory").queryName(f"m_{name}").outputMode("append" if name == "a" else "complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        s.awaitTermination(120)
        got = spark.table(f"m_{name}")
        if batch is not None:
            assert sorted(r.filing_id for r in got.collect()) == sorted(r.filing_id for r in batch.collect())
        else:
            assert sum(r.n for r in got.collect()) == df.count()
    out = str(tmp_path / "table")
    s = stream(spark, src, df.schema, 1).writeStream.foreachBatch(upsert_into(out, ["filing_id"])).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    s.awaitTermination(120)
    assert upserted(spark, out).count() == df.select("filing_id").distinct().count()
    run = upsert_into(str(tmp_path / "u"), ["k"], 4)
    one = spark.createDataFrame([(i, "a") for i in range(40)], "k int, v string")
    run(one, 0)
    for _ in range(2):  # a batch run again changes nothing
        run(spark.createDataFrame([(3, "b"), (99, "c")], "k int, v string"), 1)
        assert {r.k: r.v for r in upserted(spark, str(tmp_path / "u")).collect()} == {i: "a" for i in range(40)} | {3: "b", 99: "c"}
    assert len(list((tmp_path / "u" / "upsert_version=1").glob("upsert_bucket=*"))) <= 2
