"""Corpus queries against their SQL, or their defining properties, on the smallest data."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from folioscope.llm import queries as Q
from folioscope.llm.leakage import leaked, words
from folioscope.llm.spam import stuffing_share
from verify import canonical

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, con, name):
    got, want = Q.QUERIES[name](spark, SF).toPandas(), con.execute(Q.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:
        if got[c].dtype.kind in "iuf" and want[c].dtype.kind in "iuf":
            got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
    assert canonical(got) == canonical(want)


def test_leaks_equal_brute_force(spark, con):
    docs, items = con.execute("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").fetchall(), con.execute("SELECT item_id, text FROM eval_items").fetchall()
    grams = {}
    for i, t in items:
        ws = words(t)
        for k in range(len(ws) - 11):
            grams.setdefault(tuple(ws[k : k + 12]), set()).add(i)
    want = {(d, i) for d, t in docs for ws in [words(t)] for k in range(len(ws) - 11) for i in grams.get(tuple(ws[k : k + 12]), ())}
    assert {tuple(r) for r in Q.QUERIES["p7_found"](spark, SF).collect()} == want
    clean = Q.QUERIES["p7_removed"](spark, SF)
    assert leaked(clean.drop("n_removed"), "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").count() == 0


def test_the_curves_lose_no_stuffed_page_of_the_tables(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").fetchall()
    want = {d for d, t in docs if stuffing_share(t) > 0.5}
    assert {r.doc_id for r in Q.QUERIES["p9_found"](spark, SF).collect()} == want


def test_known_filers_link_to_themselves(spark):
    from folioscope.sources import table

    f = table(spark, SF, "filings").filter(F.col("bioguide_id").isNotNull()).withColumnRenamed("bioguide_id", "who").distinct()
    got = Q.resolve_filers(f, "filing_id", "filer_name_raw", "chamber", "filed_date", table(spark, SF, "member_aliases"), "alias", "bioguide_id", "valid_from", "valid_to")
    both = f.join(got, "filing_id")
    assert both.filter("who <> bioguide_id").count() == 0 and both.count() > 0.8 * f.count()


def test_mixture_of_the_tables(spark):
    report = {r.source: r for r in Q.QUERIES["p8_shares"](spark, SF).collect()}
    reachable = {s: r for s, r in report.items() if r.target_share and r.n_tokens}
    whole = sum(r.target_share for r in reachable.values())
    for r in reachable.values():
        assert abs(r.actual_share - r.target_share / whole) < 0.02  # about a hundred documents in all
        assert r.copies <= r.n_docs * r.max_repeats
