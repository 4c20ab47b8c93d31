import random
from datetime import date

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioscope.llm import queries as Q, survivors as S
from folioscope.llm.survivors import GAP, GAP_COST, Field, align, closest, consensus, distance, survivors, tokens
from folioscope.llm.topn import top_n


@pytest.mark.parametrize("buffer_rows,state_rows", [(200_000, 600_000), (7, 5)])
def test_top_n_equals_brute_force(spark, buffer_rows, state_rows):
    r = random.Random(1)
    rows = []
    for i in range(400):
        rows.append((r.choice(["hot"] * 5 + ["a", "b", None]), r.choice([None, -(2**63), 2**63 - 1, 0, 1, 2]), r.choice([None, "x", "y"]), i % 150 if i % 17 else None))
    seen = {}
    rows = [seen.setdefault(x[3], x) if x[3] is not None else x for x in rows]  # a record delivered again is the same
    df = spark.createDataFrame(rows, "g string, s long, t string, id long").withColumn("rank", F.lit("clash")).repartition(5)
    got = {}
    for x in top_n(df, ["g"], "s", ["t"], "id", 3, buffer_rows, state_rows).collect():
        got.setdefault(x.g, []).append((x["rank"], x.s, x.t, x.id))
    want = {}
    for g in {x[0] for x in rows}:
        mine = sorted({x[1:] for x in rows if x[0] == g and x[1] is not None and x[3] is not None}, key=lambda x: (-x[0], x[1] is None, x[1] or "", x[2]))
        if mine:
            want[g] = [(i + 1, *x) for i, x in enumerate(mine[:3])]
    assert {g: sorted(v) for g, v in got.items()} == want


def test_top_n_edges(spark):
    df = spark.createDataFrame([], "g string, s long, t string, id long")
    assert top_n(df, ["g"], "s", ["t"], "id", 3).count() == 0
    with pytest.raises(ValueError):
        top_n(df.withColumn("s", F.lit("x")), ["g"], "s", [], "id", 3)


@pytest.mark.parametrize("kind", ["double", "float", "decimal(20,3)", "int"])
@pytest.mark.parametrize("merge", ["queue", "window"])
def test_top_n_of_other_scores(spark, kind, merge):
    r = random.Random(3)
    rows = [(r.choice("ab"), r.choice([None, -1.5, 0.0, 2.25, 7.0]), i % 90) for i in range(200)]
    rows = list({x[2]: x for x in rows}.values())
    df = spark.createDataFrame(rows, "g string, s double, id int")
    if kind in ("double", "float"):
        df = df.unionByName(spark.createDataFrame([("a", float("nan"), 1000)], "g string, s double, id int"))
    got = {(x.g, x["rank"]): x.id for x in top_n(df.withColumn("s", F.col("s").cast(kind)), ["g"], "s", [], "id", 4, merge=merge).collect()}
    cast = int if kind == "int" else float
    want = {}
    for g in "ab":
        best = sorted((x for x in rows if x[0] == g and x[1] is not None), key=lambda x: (-cast(x[1]), x[2]))[:4]
        want |= {(g, i + 1): x[2] for i, x in enumerate(best)}
    assert got == want


def test_alignment_votes():
    vs = [("3", 1, "13F-HR"), ("2", 2, "13F HR"), ("1", 4, "13F HR")]
    assert consensus(vs) == ["13F", " ", "HR"] and closest(consensus(vs), vs) == "13F HR"
    # a token that few records have is voted out by the others' gap
    vs = [("9", 1, "Acme Trust Co Ltd"), ("8", 2, "Acme Co Ltd"), ("7", 2, "Acme Co Ltd.")]
    assert closest(consensus(vs), vs) == "Acme Co Ltd"
    assert align([], []) == [] and align([], ["a"]) == [(0, 0, "a")] and align(["a"], []) == [(0, -1, GAP)]


def lcs(a, b):
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a), -1, -1):
        for j in range(len(b), -1, -1):
            if i < len(a) or j < len(b):
                best[i][j] = max(
                    best[i + 1][j + 1] + (a[i] == b[j]) if i < len(a) and j < len(b) else -9,
                    best[i + 1][j] - GAP_COST if i < len(a) else -9, best[i][j + 1] - GAP_COST if j < len(b) else -9,
                )
    return best[0][0]


def test_alignment_is_of_least_loss_and_distance_exact():
    r = random.Random(4)
    for _ in range(1500):
        a, b = ([r.choice("abc") for _ in range(r.randrange(8))] for _ in range(2))
        p = align(a, b)
        assert [t for _, _, t in sorted(p, key=lambda x: (x[0], x[1] if x[1] >= 0 else 99)) if t] == b
        assert sorted(c for c, k, _ in p if k < 0) == list(range(len(a)))
        gain = sum(a[c] == t for c, k, t in p if k < 0) - GAP_COST * sum(k >= 0 or t == GAP for _, k, t in p)
        assert abs(gain - lcs(a, b)) < 1e-6
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert distance(a, b) == row[-1]


def test_what_is_decided_without_aligning_is_what_aligning_gives():
    r = random.Random(5)
    for _ in range(1500):
        vs = list({v: (str(r.random()), r.randrange(1, 5), v) for v in (" ".join(r.choice("abc") for _ in range(r.randrange(5))) for _ in range(r.randrange(1, 5)))}.values())
        top = max((n, rank, v) for rank, n, v in vs)
        if 2 * top[0] > sum(n for _, n, _ in vs) or len(vs) <= 2:
            assert closest(consensus(vs), vs) == top[2]


def test_the_way_of_aligning_changes_nothing(spark):
    r = random.Random(6)
    rows = []
    for g in range(60):
        base = [r.choice("pqrs") for _ in range(r.randrange(1, 7))]
        for _ in range(r.randrange(3, 25)):
            v = [t for t in base if r.random() > 0.2]
            if r.random() < 0.4:
                v.insert(r.randrange(len(v) + 1), r.choice("xyz"))
            rows.append((f"g{g}", f"{r.randrange(10**6):06d}", " ".join(v)))
    df = spark.createDataFrame(rows, "g string, r string, v string").repartition(3)
    out = [{x.g: x.v for x in survivors(df, ["g"], F.col("r"), [Field("v", F.col("v"), "majority")], chunk=c).collect()} for c in (64, 5, 1)]
    assert out[0] == out[1] == out[2]
    groups = {}
    for g, rank, v in rows:
        have = groups.setdefault(g, {}).get(v, ("", 0))
        groups[g][v] = (max(have[0], rank), have[1] + 1)
    for g, vs in groups.items():
        vs = [(rank, n, v) for v, (rank, n) in vs.items()]
        assert out[0][g] == closest(consensus(vs), vs) and tokens(out[0][g]) is not None


def rows_of_groups(r):
    out = []
    for i in range(300):
        g = r.choice(["hot"] * 4 + ["a", "b", "c", None])
        out.append((g, f"{r.randrange(10**6):06d}", r.choice([None, f"v{r.randrange(200)} x", "same y"])))
    return out + [("single", "5", "z"), ("none", "1", None), ("none", "2", None)]


@pytest.mark.parametrize("chunk", [64, 3])
def test_trusted_field_is_that_of_the_best_record(spark, chunk):
    rows = rows_of_groups(random.Random(2))
    df = spark.createDataFrame(rows, "g string, r string, v string").withColumn("n_records", F.lit(-1)).repartition(3)
    got = {x.g: (x.n_records, x.v, x.id) for x in survivors(df, ["g"], F.col("r"), [Field("v", F.col("v")), Field("id", F.col("r"))], chunk=chunk).collect()}
    want = {}
    for g in {x[0] for x in rows} - {None, "single"}:
        mine = [x for x in rows if x[0] == g]
        have = [x for x in mine if x[2] is not None]
        want[g] = (len(mine), max(have, key=lambda x: (x[1], x[2]))[2] if have else None, max(x[1] for x in mine))
    assert got == want


def test_majority_field_and_edges(spark):
    rows = [("a", "3", "13F-HR")] + [("a", "2", "13F HR")] * 3 + [("a", "1", "")] + [("b", None, "x" * 5000), ("b", None, "x" * 5000)]
    df = spark.createDataFrame(rows, "g string, r string, v string")
    got = {x.g: (x.n_records, x.v) for x in survivors(df, ["g"], F.col("r"), [Field("v", F.col("v"), "majority")]).collect()}
    assert got == {"a": (5, "13F HR"), "b": (2, "x" * 5000)}
    assert survivors(df.limit(0), ["g"], F.col("r"), [Field("v", F.col("v"))]).count() == 0


def test_no_votes_and_ranks_decide_as_powers_of_two_do():
    r = random.Random(7)
    for _ in range(1500):
        vs = list({" ".join(r.choice("abc") for _ in range(r.randrange(6))) for _ in range(r.randrange(1, 8))})
        r.shuffle(vs)
        summed = [(f"{i:02d}", 2**i, v) for i, v in enumerate(vs)]
        ranked = [(rank, 0, v) for rank, _, v in summed]
        assert consensus(ranked) == consensus(summed) and closest(consensus(ranked), ranked) == vs[-1]


def filings_of(spark, folder, rows):
    columns = "cik string, accession string, period_of_report date, filed_date date, submission_type string, file_number_norm string, table_value_total_usd long, parse_status string"
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/inst_filings.parquet")
    return str(folder)


def filing(cik, accession, total=None, status="parsed", form="13F-HR", filed=date(2023, 5, 1)):
    return (cik, accession, date(2023, 3, 31), filed, form, "028-1", total, status)


def test_p5_found_aligns_and_votes_wherever_values_differ(spark, tmp_path, monkeypatch):
    @F.pandas_udf("string")
    def marked(ranks: pd.Series, votes: pd.Series, values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else f"{len(v)} aligned")

    monkeypatch.setattr(S, "_resolve", marked)
    a, b, c = (f"0000000001-23-00000{i}" for i in (1, 2, 3))
    rows = [filing("two", a, 5), filing("two", b)] + [filing("three", x, 5) for x in (a, b, c)] + [filing("same", a, 5)] * 2
    got = {x.cik: (x.accession, x.total_accession) for x in Q.p5_found(spark, filings_of(spark, tmp_path, rows)).collect()}
    assert got == {"two": ("2 aligned", a), "three": ("3 aligned", "3 aligned"), "same": (a, a)}


@pytest.mark.parametrize("chunk", [64, 1])
def test_p5_found_of_odd_filings_equals_sql(spark, tmp_path, monkeypatch, chunk):
    r = random.Random(8)
    rows = [filing("best has none", None, 5, filed=date(2023, 6, 1)), filing("best has none", "0000000001-23-000001", 7)]
    rows += [filing("no digits", "n/a", 5), filing("no digits", "n/a")]
    for i in range(300):
        number = f"{r.randrange(3):010d}", f"{r.randrange(20, 24)}", f"{r.randrange(40):06d}"
        written = r.choice([None, "", "-".join(number), "".join(number), "/".join(x.lstrip("0") or "0" for x in number)])
        status, form = r.choice(["parsed", "partial", "failed", None, "odd"]), r.choice(["13F-HR", "13F HR/A", "13f-nt", None])
        # no two records may be equal in rank and differ in total
        rows.append(filing(f"c{i // 5}", written, i if i % 3 else None, status, form, date(2023, 4, 1 + i % 5)))
    d = filings_of(spark, tmp_path, rows)
    monkeypatch.setattr(S.survivors, "__defaults__", (2, chunk))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW inst_filings AS SELECT * FROM '{d}/inst_filings.parquet/*.parquet'")
    assert sorted(map(tuple, Q.p5_found(spark, d).collect()), key=str) == sorted(con.execute(Q.SQL["p5_found"]).fetchall(), key=str)
