"""Queries at the reference's own limits."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from folioscope import plans
from folioscope.operators import packing as K
from folioscope.streaming.filings import daily_counts, latest_filings, stream
from verify import canonical

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", ["embed_cap", "feed_slices", "filer_tiers", "watch_all", "embed_bounds"])
def test_query_equals_sql_at_its_limits(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got, want = plans.queries()[name](spark, SF).toPandas(), con.execute(plans.oracle_sql()[name]).df()
    assert canonical(got) == canonical(want)
    if name == "filer_tiers":
        assert (got.tier == "top").sum() == min(1_500, len(got))


def test_bounds_of_a_cap(spark):
    rows = [(g, i, n) for g, n, k in (("b", 60, 4), ("r", 1, 9), (None, 1, 2), ("one", 500, 1)) for i in range(k)]
    df = spark.createDataFrame(rows, "g string, i int, n int")
    cap = K.cap_rows(df, "g", [F.col("i")], F.col("n"), 5, 100)
    assert {tuple(x) for x in K.cap_bounds(df, cap, "g", 5).collect()} == {("b", 4, 1, "bytes"), ("r", 9, 5, "rows"), (None, 2, 2, None), ("one", 1, 1, None)}


def test_the_joined_states_stay_in_the_plan(spark, monkeypatch):
    from folioscope.operators import eager

    seen = []
    monkeypatch.setattr(eager, "cut_lineage", lambda df: seen.append(df) or df)
    plans.queries()["p1_found"](spark, SF)
    assert "Join LeftOuter" in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_a_stream_of_unordered_files_loses_no_filing(spark, tmp_path):
    src = str(tmp_path / "in")
    for k, year in enumerate((2029, 2012, 2020)):
        rows = [(f"f{k}-{i}", "house", "active", dt.datetime(year, 3, 1 + i)) for i in range(5)]
        df = spark.createDataFrame(rows, "filing_id string, chamber string, lifecycle string, ingested_at timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(src)
    for name, q, mode in (("ids", latest_filings, "append"), ("days", daily_counts, "update")):
        s = q(stream(spark, src, df.schema, 1)).writeStream.format("memory").queryName(f"unordered_{name}").outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        s.awaitTermination(120)
        assert spark.table(f"unordered_{name}").count() == 15
