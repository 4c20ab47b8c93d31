"""Curated snapshots, archives and the registry on small fixtures."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from folioscope.operators import feed as E, members as M, packing as K, registry as R
from folioscope.sources import loaders as L, parsers as S


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def write(tmp_path, name, doc):
    p = tmp_path / name
    p.write_text(doc if isinstance(doc, str) else json.dumps(doc))
    return str(p)


def test_snapshots(spark, tmp_path):
    m = [{"id": {"bioguide": "M1"}, "name": {"first": "Addison", "middle": "Mitchell", "last": "Roe", "nickname": "Mitch", "official_full": "Mitch Roe"}, "terms": [{"type": "sen", "start": "2001-01-03", "end": "2007-01-03", "state": "KY", "party": "R"}], "other_names": [{"last": "Doe", "end": "2002-01-01"}]}]
    df = L.legislators(spark, write(tmp_path, "m.json", m))
    r = df.first()
    assert (r.bioguide_id, r.chamber, r.party, r.terms[0].end) == ("M1", "senate", "R", dt.date(2007, 1, 3))
    f = spark.createDataFrame([("a", "senate", "A. Mitchell Roe", dt.date(2003, 1, 1)), ("b", "senate", "Doe, Addison", dt.date(2001, 6, 1)), ("c", "senate", "Doe, Addison", dt.date(2003, 6, 1))], "filing_id string, chamber string, filer_name_raw string, filed_date date")
    al = L.aliases(spark, write(tmp_path, "a.yaml", "- {alias: X, chamber: house, bioguide_id: M1, valid_from: 2001-01-01}"))
    assert {x.filing_id: x.outcome for x in M.resolve_members(f, al, df).collect()} == {"a": "matched", "b": "matched", "c": "unmatched"}
    with pytest.raises(ValueError):
        L.aliases(spark, write(tmp_path, "b.json", [{"alias": "X"}]))
    with pytest.raises(ValueError):
        L.legislators(spark, write(tmp_path, "d.json", m * 2))
    got = L.industry_codes(spark, write(tmp_path, "s.json", {"12": "3571", "x": "1", "13": "abc"}))
    assert sorted((x.cik or "", x.disposition) for x in got.collect()) == [("", "malformed"), ("0000000012", "accepted"), ("0000000013", "malformed")]
    c = L.committees(spark, write(tmp_path, "c.json", {"snapshot_from": "2020-01-01", "committees": {"AG": [{"bioguide": "M1"}, {"name": "x"}]}}))
    assert {x.disposition for x in c.collect()} == {"accepted", "skipped"}
    assert L.jurisdictions(spark, write(tmp_path, "j.json", {"AG": ["Agriculture", "Food"]})).count() == 2
    assert L.taxonomy([(5, 9, "b"), (1, 4, "a")])[0][2] == "a"
    for bad in ([(1, 5, "a"), (5, 9, "b")], [(3, 1, "a")]):
        with pytest.raises(ValueError):
            L.taxonomy(bad)
    a = L.authority(spark, write(tmp_path, "r.json", [{"security_id": "S", "class": "equity", "identifiers": [{"id_type": "cusip", "value": "X", "valid_to": "2020-02-01"}]}]))
    assert [x.error for x in R.authority_errors(a).collect()] == ["open_end"]


def test_archives_copies_and_lists(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for n in ("a", "b", "c"):
        (tmp_path / "raw" / n).write_text(n)
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    side = spark.createDataFrame([("a", h("a")), ("b", h("x")), ("d", h("d"))], "name string, sha256 string")
    assert {r.name: r.outcome for r in L.verify_archive(spark, str(tmp_path / "raw"), side).collect()} == {"a": "verified", "b": "changed", "c": "unrecorded", "d": "missing"}
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    assert L.copy_snapshot(df, str(tmp_path / "copy"), "1")["rows"] == 3
    with pytest.raises(Exception):
        L.copy_snapshot(df, str(tmp_path / "copy"), "1")
    df.write.parquet(str(tmp_path / "s1" / "t.parquet"))
    L.attach(spark, {"one": str(tmp_path / "s1"), "two": str(tmp_path / "s1")}, ["t"])
    assert spark.sql("SELECT count(*) AS n FROM one_t a JOIN two_t b USING (i)").first().n == 5
    assert L.latest_modified(["x", None, "Wed, 21 Oct 2015 07:28:00 GMT", "Thu, 22 Oct 2015 07:28:00 GMT"]).day == 22 and L.latest_modified([]) is None
    assert L.quarters_to_load({"2020q1": {"text"}, "2024q1": {"text"}, "2024q2": {"text", "pdf"}, "2019q4": {"text"}}, ["2019q4"], "2023q1") == {"ready": ["2020q1", "2024q2"], "incomplete": ["2024q1"]}
    d = spark.createDataFrame([("accepted",)] * 3 + [("malformed",)], "disposition string")
    assert len(L.list_errors(d, 5)) == 2 and L.list_errors(d.limit(3).filter("disposition = 'accepted'"), 3) == []
    index = spark.createDataFrame([("1", "c", "13F-HR/A", day(1), day(0)), ("2", "c", "13F-HR", day(1), day(0))], "accession string, cik string, form string, filed_date date, period date")
    parsed = spark.createDataFrame([("2", "13F-HR", day(5), False, 7, None, "parsed"), ("1", None, None, None, None, None, "failed")], "accession string, submission_type string, period_of_report date, is_amendment boolean, table_value_total_usd long, other_managers array<string>, disposition string")
    got = {r.accession: r for r in S.with_fallback(index, parsed).collect()}
    assert (got["1"].parse_status, got["1"].is_amendment, got["1"].table_value_total_usd, got["1"].flags) == ("failed", True, None, ["cover_failed"]) and got["2"].period_of_report == day(5)


def test_registry(spark):
    o = spark.createDataFrame([("cusip", "A", day(n), c) for n, c in ((0, "e1"), (1, "e1"), (5, "e2"), (5000, None))] + [("cusip", "B", day(0), "e1")], "id_type string, value string, at date, candidate string")
    none = spark.createDataFrame([], "id_type string, value string, valid_from date, valid_to date, owner string, class string")
    split = spark.createDataFrame([("cusip", "A", None, day(3), "S1", "c"), ("cusip", "A", day(3), None, "S2", "c")], none.schema)
    assert R.authority_errors(split).count() == 0
    bad = spark.createDataFrame([("cusip", "A", None, day(3), "S1", "c"), ("cusip", "A", day(2), day(9), "S2", "c")], none.schema)
    assert {r.error for r in R.authority_errors(bad).collect()} == {"overlap"}
    b = {(r.security_id, r.valid_from, r.valid_to) for r in R.bindings(o, split).filter("value = 'A'").collect()}
    assert b == {("S1", day(0), day(2)), ("S2", day(5), day(6)), ("S2", day(5000), day(5001))}
    assert {r.security_id: r.state for r in R.entity_links(o, split).filter("security_id like 'S%'").collect()} == {"S1": "resolved", "S2": "resolved"}
    assert R.entity_links(o, none).filter("state = 'conflict'").count() == 1
    after, gone = R.reconcile(o, none, split)
    assert {r.security_id for r in gone.collect()} == {"S1", "S2"} and [(r.security_id, r.successors) for r in R.successor(gone).collect()] == [(None, 2)]
    for cont, want in (([], "disputed"), ([("cusip", "A", day(0), day(9000), "auto")], "disputed"), ([("cusip", "A", day(0), day(9000), "reviewed")], "cleared")):
        c = spark.createDataFrame(cont, "id_type string, value string, gap_from date, gap_to date, review_state string")
        rv = R.reuse_review(after, split, c)
        assert [r.decision for r in rv.collect()] == [want]
        assert {r.review_state for r in R.with_review(after, rv).filter("value = 'A'").collect()} == {{"cleared": "reviewed"}.get(want, want)}
    moved = spark.createDataFrame([("cusip", "A", None, day(3000), "S1", "c"), ("cusip", "A", day(3000), None, "S2", "c")], none.schema)
    assert [r.decision for r in R.reuse_review(R.bindings(o, moved), moved, spark.createDataFrame([], "id_type string, value string, gap_from date, gap_to date, review_state string")).collect()] == ["explained"]
    q = R.list_bindings(spark.createDataFrame([("cusip", "A", day(0))], "id_type string, value string, at date"), split)
    assert {(r.security_id, r.valid_from, r.valid_to) for r in q.collect()} == {("S1", day(0), day(3)), ("S2", day(3), dt.date(2020, 4, 1))}
    h = R.name_history(spark.createDataFrame([("k", day(0), "x"), ("k", day(1), "x"), ("k", day(3), "y")], "key string, at date, value string"))
    assert sorted((r.value, r.valid_from, r.valid_to) for r in h.collect()) == [("x", day(0), day(3)), ("y", day(3), None)]


def test_pages(spark):
    e = spark.createDataFrame([("a", 9, 1), ("b", 7, 2), ("c", 7, 2), ("d", 1, 1)], "entity string, rows int, cost int")
    assert [r.entity for r in E.within_budget(e, "rows", "cost", ["entity"], 4).collect()] == ["a", "b"]
    p = spark.createDataFrame([('{"a": 1}',)], "j string")
    assert K.parse_payload(p, "j", "a int").first().p.a == 1
    for bad in ('{"a": 1, "b": 2}', "{"):
        with pytest.raises(Exception):
            K.parse_payload(spark.createDataFrame([(bad,)], "j string"), "j", "a int").collect()
    r = spark.createDataFrame([("g", i, 40, f"f{i % 2}") for i in range(6)], "g string, i int, n int, f string")
    got = K.shards(r, "g", ["i"], F.col("n"), 150, dependency="f", dependency_size=20)
    assert [x.shard for x in got.orderBy("i").collect()] == [0, 0, 1, 1, 2, 2]
    assert [x.i for x in K.reassemble(got, "g", ["i"]).collect()] == list(range(6))
    with pytest.raises(ValueError):
        K.reassemble(got.filter("shard <> 1"), "g", ["i"])
    with pytest.raises(Exception, match="more than 2 pages"):
        K.shards(r, "g", ["i"], F.col("n"), 150, dependency="f", dependency_size=20, most_shards=2).collect()
    with pytest.raises(Exception):
        K.decode_rows(K.encode_rows(r, ["g"]), ["g", "i"], r.schema).collect()
