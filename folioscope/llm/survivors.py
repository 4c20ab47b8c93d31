"""Best representative of each duplicate group: consensus of aligned tokens, field by field."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..operators.common import broadcast_if_small, cut_lineage, require

#: Distinct values of one field that are aligned in one call; more are aligned as rows of
#: their own.  The result does not depend on it.
CHUNK = 64
#: Times the values are aligned: to the heaviest value, then to the consensus found.
ROUNDS = 2
#: What leaving a token out costs beside what a match gains.
GAP_COST = 0.01
TOKEN = re.compile(r"[^\W_]+|[\W_]", re.UNICODE)
GAP = ""


@dataclass(frozen=True)
class Field:
    """A field to fill: its name, a string column, and how much a record's tokens weigh.
    ``majority``: every record weighs the same.  ``trusted``: a record outweighs all
    worse-ranked ones of its group together, as powers of two do; of two sums of such
    weights the one with the better record is greater, so these records have 0 votes and
    their ranks, which are all different, decide."""

    name: str
    value: Column
    weigh: str = "trusted"


def tokens(value: str) -> list[str]:
    """Words and single signs."""
    return TOKEN.findall(value)


def align(guide: Sequence[str], other: Sequence[str]) -> list[tuple[int, int, str]]:
    """Places of ``other``'s tokens in the columns of ``guide``: (column, -1, token) in a
    column, (column, k, token) for the k-th token put in before it, and (column, -1, GAP)
    for a column it lacks.  Global alignment of least loss; equal ends are taken as they
    stand."""
    n, m, head = len(guide), len(other), 0
    while head < min(n, m) and guide[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and guide[n - 1 - tail] == other[m - 1 - tail]:
        tail += 1
    out = [(i, -1, guide[i]) for i in range(head)]
    if n == m:
        # any gap costs two, and wins nothing where all that is shared stands side by side
        differ = [i for i in range(head, n - tail) if guide[i] != other[i]]
        if {guide[i] for i in differ}.isdisjoint(other[i] for i in differ):
            return [(i, -1, t) for i, t in enumerate(other)]
    number: dict[str, int] = {}
    a = np.array([number.setdefault(t, len(number)) for t in guide[head : n - tail]], dtype=np.int64)
    b = np.array([number.setdefault(t, len(number)) for t in other[head : m - tail]], dtype=np.int64)
    # row by row from the end; what is put in is a running maximum along the row
    w, at = len(b), np.arange(len(b) + 1)
    below = -GAP_COST * (w - at)
    moves = np.zeros((len(a) + 1, w + 1), dtype=np.int8)  # 0 both, 1 column lacks, 2 put in
    moves[len(a), :w] = 2
    for i in range(len(a) - 1, -1, -1):
        lacks = below - GAP_COST
        both = np.full(w + 1, -np.inf)
        both[:w] = below[1:] + (b == a[i])
        best = np.maximum(both, lacks)
        run = np.maximum.accumulate((best - GAP_COST * at)[::-1])[::-1] + GAP_COST * at
        moves[i] = np.where(both >= run - 1e-9, 0, np.where(lacks >= run - 1e-9, 1, 2))
        below = run
    i = j = k = 0
    while i < len(a) or j < w:
        move = moves[i, j]
        if move == 2:
            out.append((head + i, k, other[head + j]))
            j, k = j + 1, k + 1
        else:
            out.append((head + i, -1, other[head + j] if move == 0 else GAP))
            i, j, k = i + 1, j + (move == 0), 0
    return out + [(n - tail + i, -1, guide[n - tail + i]) for i in range(tail)]


def winners(votes: Iterable[tuple[int, int, str, int, str]], weight: int, first: str) -> list[str]:
    """The consensus from (column, k, token, weight, best rank): in a column the token with
    most weight, then the best rank.  A token is put in where it outweighs the records
    that have none there; where they weigh the same, if the record ranked ``first`` has one."""
    best: dict[tuple[int, int], tuple[int, str, str]] = {}
    held: dict[tuple[int, int], tuple[int, str]] = {}
    for column, k, token, n, rank in votes:
        place = (column, k if k >= 0 else 1 << 30)
        best[place] = max(best.get(place, (0, "", "")), (n, rank, token))
        have = held.get(place, (0, ""))
        held[place] = (have[0] + n, max(have[1], rank))
    out = []
    for place, (n, _, token) in sorted(best.items()):
        none, rank = weight - held[place][0], held[place][1]
        if token != GAP and (place[1] == 1 << 30 or n > none or (n == none and rank == first)):
            out.append(token)
    return out


def consensus(values: Sequence[tuple[str, int, str]]) -> list[str]:
    """Tokens agreed on by (rank, records, value).  Each value is aligned to a guide on its
    own and the votes add up, so neither order nor grouping of the values matters."""
    weight, first = sum(n for _, n, _ in values), max(rank for rank, _, _ in values)
    guide = tokens(max((n, rank, v) for rank, n, v in values)[2])
    for _ in range(ROUNDS):
        votes: dict[tuple[int, int, str], tuple[int, str]] = {}
        for rank, n, v in values:
            for place in align(guide, tokens(v)):
                have = votes.get(place, (0, ""))
                votes[place] = (have[0] + n, max(have[1], rank))
        before, guide = guide, winners(((*place, n, r) for place, (n, r) in votes.items()), weight, first)
        if guide == before:  # so it stays
            break
    return guide


def distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Edits between token lists."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    number: dict[str, int] = {}
    y = np.array([number.setdefault(t, len(number)) for t in b], dtype=np.int64)
    at = np.arange(len(b) + 1)
    row = at.copy()
    for i, t in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (y != number.get(t, -1)))
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def closest(want: Sequence[str], values: Sequence[tuple[str, int, str]]) -> str:
    """The existing value with the fewest edits to the consensus, then the best rank."""
    agreed = "".join(want)
    if any(v == agreed for _, _, v in values) and tokens(agreed) == list(want):
        return agreed
    return min(sorted(((rank, v) for rank, _, v in values), reverse=True), key=lambda x: distance(want, tokens(x[1])))[1]


@F.pandas_udf(T.StringType())
def _resolve(ranks: pd.Series, votes: pd.Series, values: pd.Series) -> pd.Series:
    """Whole groups: align, vote, and give the closest existing value."""
    out = []
    for r, n, v in zip(ranks, votes, values):
        vs = None if v is None else list(zip(r, n, v))
        out.append(vs and closest(consensus(vs), vs))
    return pd.Series(out, dtype=object)


PLACES = T.ArrayType(T.StructType([T.StructField("column", T.IntegerType()), T.StructField("k", T.IntegerType()), T.StructField("token", T.StringType())]))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens(values: pd.Series) -> pd.Series:
    return values.map(tokens)


@F.pandas_udf(PLACES)
def _places(guide: pd.Series, value: pd.Series) -> pd.Series:
    return pd.Series([align(list(g), tokens(v)) for g, v in zip(guide, value)], dtype=object)


@F.pandas_udf(T.IntegerType())
def _distance(want: pd.Series, value: pd.Series) -> pd.Series:
    return pd.Series([distance(list(a), tokens(b)) for a, b in zip(want, value)], dtype="int32")


def _wide(states: DataFrame, keys: list[str], heaviest: DataFrame) -> DataFrame:
    """:func:`consensus` and :func:`closest` for groups of any number of values: every value
    is a row, votes are summed before and after the shuffle, and only the winners of the
    columns, as many as a value has tokens, come together."""
    guide = heaviest.select(*keys, "weight", "first", _tokens("top").alias("guide"))
    for _ in range(ROUNDS):
        guide = cut_lineage(guide)
        placed = states.join(broadcast_if_small(guide), keys).select(*keys, "weight", "first", "n", "rank", F.inline(_places("guide", "value")))
        votes = placed.groupBy(*keys, "weight", "first", "column", "k", "token").agg(F.sum("n").alias("n"), F.max("rank").alias("rank"))
        place = votes.groupBy(*keys, "weight", "first", "column", F.when(F.col("k") < 0, 1 << 30).otherwise(F.col("k")).alias("k")).agg(
            F.max(F.struct("n", "rank", "token")).alias("b"), F.sum("n").alias("held"), F.max("rank").alias("r")
        )
        none = F.col("weight") - F.col("held")
        won = (F.col("k") == 1 << 30) | (F.col("b.n") > none) | ((F.col("b.n") == none) & (F.col("r") == F.col("first")))
        token = F.when(won & (F.col("b.token") != GAP), F.struct("column", "k", F.col("b.token").alias("t")))
        order = F.array_sort(F.collect_list(token))
        guide = place.groupBy(*keys, "weight", "first").agg(F.transform(order, lambda x: x["t"]).alias("guide"))
    near = states.join(broadcast_if_small(cut_lineage(guide)), keys).select(*keys, "rank", "value", _distance("guide", "value").alias("far"))
    # fewest edits, then the greatest rank, then the greatest value
    return near.groupBy(*keys).agg(F.max(F.struct((-F.col("far")).alias("s"), "rank", "value")).alias("b")).select(*keys, F.col("b.value").alias("value"))


def survivors(
    df: DataFrame, group_by: Sequence[str], rank: Column, fields: Sequence[Field], least: int = 2, chunk: int = CHUNK
) -> DataFrame:
    """One surviving record per group of at least ``least`` rows, each field filled with
    the existing value of the group that is closest to the consensus of its values.

    ``rank`` is a string that sorts greatest for the most trusted record.  Of every field
    the distinct values are weighed before anything is gathered (map-side too), so copies
    of one value are one entry.  The values' tokens (words and single signs) are aligned
    to the heaviest value; each column of the alignment goes to the token with most
    weight, a gap being a vote too; all are aligned again to what was agreed; and the
    existing value with the fewest token edits to the consensus is emitted, ties going to
    the better rank.

    Every group with two or more values of a field is aligned and voted on, ``trusted``
    fields too: in one call up to ``chunk`` distinct values, else value by value as rows
    whose votes are summed.  The votes are the same, so ``chunk`` and the order of rows
    change nothing.

    Output: ``group_by``, ``n_records``, and each field (null if no record has it).

    Defined cases: rows with a null group column belong to no group and are left out;
    null values don't vote; a null rank is the lowest; of equally ranked ``trusted`` records
    the greater value is the better; the empty string is a value without tokens, all of
    whose votes are gaps; repeated rows count as records; an empty table gives no rows.  An
    alignment takes time in proportion to the product of two values' numbers of tokens.
    """
    require(df, *group_by)
    gs = [f"g{i}" for i in range(len(group_by))]
    named = df.select(
        *[F.col(c).alias(g) for c, g in zip(group_by, gs)], F.coalesce(rank, F.lit("")).alias("rank"),
        *[f.value.cast("string").alias(f"f{i}") for i, f in enumerate(fields)],
    ).dropna(subset=gs)
    if not fields:
        out = named.groupBy(*gs).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") >= least)
        return out.select(*[F.col(g).alias(c) for c, g in zip(group_by, gs)], "n_records")
    cells = named.select(*gs, "rank", F.inline(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"f{i}").alias("value")) for i in range(len(fields))])))
    states = cells.groupBy(*gs, "field", "value").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("records"))
    trusted = F.col("field").isin([i for i, f in enumerate(fields) if f.weigh == "trusted"])
    # sorts by rank, then by value
    each = F.concat(F.replace("rank", F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"), F.coalesce("value", F.lit("")))
    states = states.select(
        *gs, "field", "value", "records", F.when(trusted, 0).otherwise(F.col("records")).alias("n"), F.when(trusted, each).otherwise(F.col("rank")).alias("rank")
    )
    # values are counted before any are gathered
    w, own = W.partitionBy(*gs), [F.col("field") == i for i in range(len(fields))]
    ds = {f"d{i}": F.count(F.when(x, F.col("value"))).over(w) for i, x in enumerate(own)}
    counted = states.withColumns({"n_records": F.sum(F.when(own[0], F.col("records"))).over(w), **ds}).filter(F.col("n_records") >= least)
    whole = counted.groupBy(*gs, "n_records", *ds).agg(
        *[F.collect_list(F.when(x & F.col("value").isNotNull() & (F.col(f"d{i}") <= chunk), F.struct("rank", "n", "value"))).alias(f"v{i}") for i, x in enumerate(own)]
    )
    out = cut_lineage(whole.select(*gs, "n_records", *ds, *[_agreed(F.col(f"v{i}")).alias(f"f{i}") for i in range(len(fields))]))
    wide = out.select(*gs, F.inline(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"d{i}").alias("d")) for i in range(len(fields))]))).filter(F.col("d") > chunk)
    if not wide.isEmpty():
        keys = [*gs, "field"]
        some = cut_lineage(states.filter(F.col("value").isNotNull()).join(broadcast_if_small(wide.select(*keys)), keys, "left_semi"))
        told = some.groupBy(*keys).agg(F.sum("n").alias("weight"), F.max("rank").alias("first"), F.max(F.struct("n", "rank", "value")).alias("t"))
        found = _wide(some, keys, told.select(*keys, "weight", "first", F.col("t.value").alias("top")))
        found = found.groupBy(*gs).agg(*[F.max(F.when(x, F.col("value"))).alias(f"w{i}") for i, x in enumerate(own)])
        out = out.join(found, gs, "left").withColumns({f"f{i}": F.coalesce(f"f{i}", f"w{i}") for i in range(len(fields))})
    return out.select(*[F.col(g).alias(c) for c, g in zip(group_by, gs)], "n_records", *[F.col(f"f{i}").alias(f.name) for i, f in enumerate(fields)])


def _agreed(values: Column) -> Column:
    """A value that is alone needs no call."""
    several = F.when(F.size(values) > 1, values)
    return F.coalesce(_resolve(several["rank"], several["n"], several["value"]), F.get(values, F.lit(0))["value"])
