"""The general data-preparation operators against brute force and edge cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folioscope.operators.asof import asof_join, disjoint_versions
from folioscope.operators.eager import distinct_records, eager_join_aggregate, heavy_groups
from folioscope.operators.snapshots import diff_snapshots, diff_snapshots_of


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_eager_equals_the_join(spark):
    r = random.Random(3)
    left = [(r.choice(["hot"] * 6 + ["a", "b", None]), r.choice([1, 2, 3, None]), r.choice([None, 0, 5, 7])) for _ in range(300)]
    right = [(r.choice([1, 1, 2, None]), r.choice([None, 10, 20])) for _ in range(40)]
    a = spark.createDataFrame(left, "g string, k int, x long")
    b = spark.createDataFrame(right, "k int, y long").withColumn("g", F.lit("clash"))
    got = {x.g: x for x in eager_join_aggregate(a, b, ["k"], ["g"], ["x"], ["y"]).collect()}
    assert {x[0] for x in left} == set(got)
    for g in got:
        rows = [(x, y, hit) for gg, k, x in left if gg == g for y, hit in ([(y, True) for kk, y in right if kk == k and k is not None] or [(None, False)])]
        xs, ys = [x for x, _, _ in rows if x is not None], [y for _, y, _ in rows if y is not None]
        assert got[g].n_left == sum(1 for x in left if x[0] == g)
        assert got[g].n_joined == len(rows)
        assert got[g].sum_x == (sum(xs) if xs else None) and got[g].known_x == len(xs)
        assert got[g].sum_y == (sum(ys) if ys else None) and got[g].known_y == len(ys)


def test_eager_edges(spark):
    a = spark.createDataFrame([], "g string, k int, x long")
    assert eager_join_aggregate(a, a, ["k"], ["g"], ["x"]).count() == 0
    b = spark.createDataFrame([("g", 1, None)], "g string, k int, x long")
    row = eager_join_aggregate(b, a, ["k"], ["g"], ["x"]).first()
    assert row.sum_x is None and row.n_matched == 0 and row.n_joined == 1
    with pytest.raises(ValueError):
        eager_join_aggregate(b, a, ["missing"], ["g"])


def test_heavy_groups_counts_records_once(spark):
    rows = [(i, "big") for i in range(40)] * 3 + [(100 + i, f"s{i}") for i in range(60)] + [(None, "big")]
    df = distinct_records(spark.createDataFrame(rows, "id long, g string"), "id", ["g"]).withColumn("n", F.lit(1))
    counts = df.groupBy("g").agg(F.sum("n").alias("n"))
    assert [x.g for x in heavy_groups(counts, "n", 40, 100).collect()] == ["big"]
    assert heavy_groups(counts, "n", 1, 100).count() == 61
    assert heavy_groups(counts, "n", 41, 100).count() == 0


def brute_changes(rows):
    by = {}
    for e, p, k, v in rows:
        if e is not None and p is not None:
            by.setdefault(e, {}).setdefault(p, {})
            old = by[e][p].get(k, "absent")
            key = lambda x: (x is not None, x)
            by[e][p][k] = v if old == "absent" else min(old, v, key=key)
    out = set()
    for e, snaps in by.items():
        ps = sorted(snaps)
        for a, b in zip(ps, ps[1:]):
            for k in snaps[a].keys() | snaps[b].keys():
                if k not in snaps[a]:
                    out.add((e, b, k, "added", None, snaps[b][k]))
                elif k not in snaps[b]:
                    out.add((e, b, k, "removed", snaps[a][k], None))
                elif snaps[a][k] != snaps[b][k]:
                    out.add((e, b, k, "changed", snaps[a][k], snaps[b][k]))
    return out


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_snapshots_equal_brute_force(spark, broadcast_rows):
    r = random.Random(5)
    rows = [(r.choice(["hot"] * 5 + ["a", "b", None]), r.choice(["q1", "q2", "q4", "q7", None]), r.choice([None, *"uvwxyz"]), r.choice([None, 0, 1])) for _ in range(400)]
    df = spark.createDataFrame(rows, "e string, p string, k string, v long").withColumn("change_kind", F.lit("clash"))
    got = {tuple(x) for x in diff_snapshots(df, "e", "p", ["k"], ["v"], broadcast_rows).select("e", "p", "k", "change_kind", "old_v", "new_v").collect()}
    assert got == brute_changes(rows)


def test_snapshots_edges(spark):
    empty = spark.createDataFrame([], "e string, p string, k string, v long")
    assert diff_snapshots(empty, "e", "p", ["k"], ["v"]).count() == 0
    df = spark.createDataFrame([("a", "q1", "x", 1), ("a", "q2", None, 1), ("a", "q3", "x", 1)], "e string, p string, k string, v long")
    got = {(x.p, x.k, x.change_kind) for x in diff_snapshots_of(df, df.filter("k is not null"), "e", "p", ["k"], ["v"]).collect()}
    # the snapshot q2 was delivered, though its only row has no key
    assert got == {("q2", "x", "removed"), ("q3", "x", "added")}


@pytest.mark.parametrize("shard_rows,time_shards", [(10**6, 128), (20, 16), (3, 4)])
def test_asof_equals_brute_force(spark, shard_rows, time_shards):
    r = random.Random(7)
    events = [(i, r.choice(["hot"] * 8 + ["a", "b", None]), r.choice([None, day(r.randrange(300)), day(50)])) for i in range(400)]
    versions = [(e, day(s), day(s + n) if n else None, f"{e}{s}") for e in ("hot", "a") for s, n in [(10, 20), (30, 0), (50, 5), (55, 100), (200, 0)]] + [(None, day(1), None, "x"), ("hot", None, None, "y")]
    ev = spark.createDataFrame(events, "id int, e string, t date").withColumn("v", F.lit("clash"))
    vs = spark.createDataFrame(versions, "e string, f date, u date, v string")
    got = {x.id: x.asof_v for x in asof_join(ev, vs, "e", "t", "f", "u", ["v"], shard_rows, time_shards).collect()}
    assert len(got) == 400
    for i, e, t in events:
        began = [(f, u, v) for k, f, u, v in versions if k == e and e and t and f and f <= t]
        best = max(began, default=None)
        assert got[i] == (best[2] if best and (best[1] is None or t < best[1]) else None), (i, e, t)


def test_asof_keeps_repeats_and_empty(spark):
    ev = spark.createDataFrame([("a", day(1))] * 3, "e string, t date")
    vs = spark.createDataFrame([], "e string, f date, u date, v string")
    assert [x.v for x in asof_join(ev, vs, "e", "t", "f", "u", ["v"]).collect()] == [None] * 3
    assert asof_join(ev.limit(0), vs, "e", "t", "f", "u", ["v"]).count() == 0


def test_disjoint_versions(spark):
    terms = "array<struct<start:date,end:date,party:string>>"
    df = spark.createDataFrame([(1, [(day(20), None, "C"), (day(0), day(10), "A"), (day(0), day(10), "A"), (day(5), day(8), "B"), (None, None, "Z")]), (2, []), (3, None)], f"i int, terms {terms}")
    floor = F.lit("0001-01-01").cast("date")
    got = {x.i: [(s.valid_from, s.valid_to, s.party, s.covered) for s in x.s] for x in df.select("i", disjoint_versions(F.col("terms"), "start", "end", "party", floor).alias("s")).collect()}
    low = dt.date(1, 1, 1)
    assert got[1] == [(low, day(0), None, False), (day(0), day(5), "A", True), (day(5), day(8), "B", True), (day(8), day(10), "A", True), (day(10), day(20), None, False), (day(20), None, "C", True)]
    assert got[2] == got[3] == [(low, None, None, False)]
