"""Variant spellings of names: a pigeonhole segment join with banded verification."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..operators.common import broadcast_if_small, cut_lineage, require

#: Edits allowed in a name of at least so many letters, most first; shorter ones have none
#: to spare.  Of given names both must be that long.
SURNAME_EDITS = ((7, 2), (5, 1))
GIVEN_EDITS = ((6, 2), (3, 1))

# Titles, suffixes, particles, and short forms of first names.
TITLES = frozenset("hon honorable honourable the rep representative sen senator congressman congresswoman delegate dr mr mrs ms miss prof sir".split())
SUFFIXES = frozenset("jr sr ii iii iv esq md phd".split())
PARTICLES = frozenset("de del della der di du la las le los ter van vander von".split())
SHORT_FORMS = """
    abigail abby abbie gail; alexander alex al alec sandy xander; andrew andy drew; anthony tony ant; barbara barb babs barbie;
    benjamin ben benny benj benji; catherine cathy cate; charles charlie chuck chas chaz; christopher chris kit topher;
    cynthia cindy cyndi; daniel dan danny; david dave davy; deborah deb debbie debby; donald don donny; dorothy dot dottie dolly dory;
    edward ed eddie ted ned eddy; elizabeth liz beth betty eliza betsy lizzie eliz libby; frances fran francie;
    francis frank fran francie frankie; frederick fred freddie freddy fredk; gerald gerry jerry; gregory greg gregg;
    henry hank harry hal; jacqueline jackie jacqui; james jim jimmy jamie jas; jennifer jen jenny jenn; john jack johnny jon;
    joseph joe joey jos; katherine kate kathy katie kathie kat kay kit; kenneth ken kenny; lawrence larry lawrie laurie;
    leonard leo len lenny; margaret maggie meg peggy marge margie greta; matthew matt matty; michael mike mick mickey mikey;
    nicholas nick nicky nico; pamela pam pammy; patricia pat patty trish tricia patti; patrick pat paddy; raymond ray;
    rebecca becky becca; richard rick dick rich ricky richie; robert bob rob bobby robbie bert robt; ronald ron ronnie; samuel sam sammy saml;
    stephen steve steven stevie; susan sue susie suzy; theodore ted teddy theo; thomas tom tommy thos; timothy tim timmy;
    victoria vicky vicki tori vickie; william bill will billy willy wm liam; xavier xavi; zelda zel
"""
FULL: dict[str, frozenset[str]] = {}
for _line in SHORT_FORMS.split(";"):
    for _w in _line.split():
        FULL[_w] = FULL.get(_w, frozenset()) | {_line.split()[0]}

DIGITS = str.maketrans("0134589", "olEasbg".lower())


def fold(text: str) -> str:
    """Lower case without accents; apostrophes and hyphens join, what scanners and
    typists take for each other is written one way."""
    text = unicodedata.normalize("NFKD", text.casefold())
    text = "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    text = re.sub(r"['’`´‘-]", "", text)
    return re.sub(r"(?<=[a-z])[0134589]|[0134589](?=[a-z])", lambda m: m[0].translate(DIGITS), text)


def confused(word: str) -> str:
    """Pairs of letters that look alike when scanned, written one way."""
    return word.replace("rn", "m").replace("vv", "w")


def tokens(name: str) -> tuple[list[list[str]], frozenset[str]]:
    """The name's parts between commas, in words, without titles; and its suffixes."""
    parts, suffixes = [], set()
    for part in fold(name).split(","):
        ws = [w for w in re.findall(r"[^\W_]+", part) if w not in TITLES]
        suffixes |= {w for w in ws if w in SUFFIXES}
        ws = [w for w in ws if w not in SUFFIXES]
        if ws:
            parts.append(ws)
    return parts, frozenset(suffixes)


def readings(name: str | None) -> list[tuple[str, tuple[str, ...]]]:
    """(surname, given names) as which a typed name may be read: what stands before a
    comma, else one to three words at either end, joined."""
    parts, _ = tokens(name or "")
    if len(parts) >= 2:
        return [("".join(parts[0]), tuple(w for p in parts[1:] for w in p))]
    ws = parts[0] if parts else []
    out = {}
    for j in range(1, min(4, len(ws))):
        for cut, given in ((ws[-j:], ws[:-j]), (ws[:j], ws[j:])):
            # an initial is no part of a surname
            if j == 1 or min(map(len, cut)) > 1:
                out.setdefault(("".join(cut), tuple(given)))
    return list(out)


def listed(alias: str | None) -> list[tuple[str, tuple[str, ...], int]]:
    """(surname, given names, cost) of a listed name, whose order is known: the surname
    whole, without its particles, and each half of a double name."""
    parts, _ = tokens(alias or "")
    if not parts:
        return []
    if len(parts) >= 2:
        surname, given = parts[0], [w for p in parts[1:] for w in p]
    else:
        ws = parts[0]
        at = len(ws) - 1
        while at > 1 and ws[at - 1] in PARTICLES:
            at -= 1
        surname, given = ws[at:], ws[:at]
    if not given:
        return []
    out = {("".join(surname)): 0}
    bare = "".join(w for w in surname if w not in PARTICLES)
    if bare:
        out.setdefault(bare, 1)
    for half in re.findall(r"[^\W\d_]+", re.sub(r"['’]", "", " ".join(unicodedata.normalize("NFKD", alias.casefold()).split("-")))) if "-" in alias else []:
        half = "".join(c for c in half if not unicodedata.combining(c))
        if len(half) >= 5 and half in "".join(surname) and half not in given:
            out.setdefault(half, 1)
    return [(s, tuple(given), c) for s, c in out.items()]


def osa(a: str, b: str, k: int) -> int:
    """Edits with neighbours swapped as one, within a band of k; k + 1 if there are more."""
    if abs(len(a) - len(b)) > k:
        return k + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        row = [k + 1] * (len(b) + 1)
        if i <= k:
            row[0] = i
        for j in range(max(1, i - k), min(len(b), i + k) + 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[j] = min(row[j], before[j - 2] + 1)
        before, last = last, row
        if min(row) > k:
            return k + 1
    return min(last[-1], k + 1)


def same_given(typed: str, known: str) -> float | None:
    """What it costs to take one first name for the other; None if they differ."""
    if typed == known:
        return 0.0
    if len(typed) == 1 or len(known) == 1:
        return 1.0 if typed[0] == known[0] else None
    a, b = FULL.get(typed, frozenset({typed})), FULL.get(known, frozenset({known}))
    if a & b:
        return 0.25
    if len(typed) >= 3 and known.startswith(typed):
        return 0.5
    best = None
    for x in {known, *b, *(s for s in SHORTS.get(known, ()))}:
        k = allowed(min(len(x), len(typed)), GIVEN_EDITS)
        d = min(osa(typed, x, k), osa(confused(typed), confused(x), k)) if k else 1
        if k and d <= k and typed not in FULL:
            best = min(best, float(d)) if best is not None else float(d)
    return best


SHORTS: dict[str, list[str]] = {}
for _short, _fulls in FULL.items():
    for _f in _fulls:
        SHORTS.setdefault(_f, []).append(_short)


def given_cost(typed: Sequence[str], known: Sequence[str]) -> float | None:
    """What it costs to take the typed given names for the listed ones; None if they
    contradict each other: another first name, or another middle name or initial."""
    if not typed or not known:
        return None
    first = same_given(typed[0], known[0])
    if first is None:
        # a first name split in two by a stray space
        if len(typed) >= 2 and (c := same_given(typed[0] + typed[1], known[0])) is not None and len(typed[0]) > 1:
            return c + 0.5
        return None
    a, b = typed[1:], known[1:]
    if a and b:
        middle = same_given(a[0], b[0])
        if middle is None:
            return None
        return first - (0.5 if middle <= 1 else 0.0)
    return first


def allowed(length: int, steps: Sequence[tuple[int, int]] = SURNAME_EDITS) -> int:
    """Edits that a name of this length may have."""
    return next((e for least, e in steps if length >= least), 0)


def _lengths(steps: Sequence[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(edits, least, most length) of the typed names that may have so many edits."""
    out, most = [], 10**6
    for least, e in (*steps, (1, 0)):
        out.append((e, least, most))
        most = least - 1
    return out


def _pieces(c: str, places: list[dict]) -> Column:
    """What stands in column ``c`` at the given places, each labelled with its edits, the
    indexed name's length and the segment.  A place: ``e`` edits, for lengths ``lo`` to
    ``hi`` of ``c``, which is ``d`` longer than the indexed name, whose ``i``-th of ``w``
    segments has moved by ``v``."""
    table = f"from_json('{json.dumps(places)}', 'array<struct<e:int,lo:int,hi:int,d:int,i:int,w:int,v:int>>')"
    n = f"(length({c}) - p.d)"
    at = f"p.i * ({n} div p.w) + greatest(0, p.i - (p.w - {n} % p.w)) + p.v"
    width = f"({n} div p.w) + if(p.i >= p.w - {n} % p.w, 1, 0)"
    used = f"filter({table}, p -> length({c}) between p.lo and p.hi and {n} > 0)"
    cut = f"transform({used}, p -> struct(p.e as e, {n} as n, p.i as i, cast({at} as int) as a, cast({width} as int) as w))"
    fits = f"filter({cut}, x -> x.a >= 0 and x.a <= length({c}) - x.w)"
    return F.expr(f"array_distinct(transform({fits}, x -> concat_ws(':', x.e, x.n, x.i, substring({c}, x.a + 1, x.w))))")


def segments(c: str, steps: Sequence[tuple[int, int]]) -> Column:
    """The segments of an indexed name for each number of edits that a typed name may have.
    A swap across the border of two segments changes both, so of ``2 * edits + 1``
    segments one survives unchanged."""
    return _pieces(c, [dict(e=e, lo=least - e, hi=most + e, d=0, i=i, w=2 * e + 1, v=0) for e, least, most in _lengths(steps) for i in range(2 * e + 1)])


def probes(c: str, steps: Sequence[tuple[int, int]]) -> Column:
    """The substrings of a typed name that may equal a segment of a name within the edits
    its length allows, swaps of neighbours counted as one.  Only insertions and deletions
    move a segment, those before it and those behind it together at most ``edits``."""
    return _pieces(c, [
        dict(e=e, lo=least, hi=most, d=d, i=i, w=2 * e + 1, v=v)
        for e, least, most in _lengths(steps) for d in range(-e, e + 1) for i in range(2 * e + 1) for v in range(-e, e + 1) if abs(v) + abs(d - v) <= e
    ])


READING = T.ArrayType(T.StructType([T.StructField("s", T.StringType()), T.StructField("g", T.ArrayType(T.StringType())), T.StructField("c", T.IntegerType())]))


@F.pandas_udf(READING)
def _readings(names: pd.Series) -> pd.Series:
    return pd.Series([[(confused(s), list(g), 0) for s, g in readings(n)] for n in names], dtype=object)


@F.pandas_udf(READING)
def _listed(names: pd.Series) -> pd.Series:
    return pd.Series([[(confused(s), list(g), c) for s, g, c in listed(n)] for n in names], dtype=object)


def _within(steps: Sequence[tuple[int, int]]):
    @F.pandas_udf(T.BooleanType())
    def run(s: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([osa(a, b, limit) <= limit if (limit := allowed(len(a), steps)) else a == b for a, b in zip(s, k)], dtype=bool)

    return run.asNondeterministic()  # stays above the filter that is evaluated in the JVM


@F.pandas_udf(T.DoubleType())
def _cost(s: pd.Series, g: pd.Series, k: pd.Series, m: pd.Series) -> pd.Series:
    out = []
    for a, ga, b, gb in zip(s, g, k, m):
        d = osa(a, b, limit) if (limit := allowed(len(a))) else int(a != b)
        c = given_cost(list(ga), list(gb)) if d <= limit else None
        out.append(None if c is None else d + c)
    return pd.Series(out, dtype="float64")


def similar_keys(left: DataFrame, right: DataFrame, steps: Sequence[tuple[int, int]] = SURNAME_EDITS) -> DataFrame:
    """(s, k): all pairs of a string ``s`` of ``left`` and ``k`` of ``right`` that are as few
    edits apart as the length of ``s`` allows (``steps``), a swap of neighbours being one,
    without comparing all.

    Every k is cut into segments, which form an inverted index; every s looks up its
    substrings at the places where a segment can have moved to; the pairs found are
    verified where they arise, first by Spark's distance cut off at twice the edits (a
    swap is two plain ones), none for short names, and what is left by the distance in a
    band.  Both sides are made distinct first, so a name that occurs very often costs as
    much as a rare one."""
    index = right.select("k").filter(F.col("k") != "").distinct().select("k", F.explode(segments("k", steps)).alias("piece"))
    look = left.select("s").filter(F.col("s") != "").distinct().select("s", F.explode(probes("s", steps)).alias("piece"))
    near = F.col("s") == F.col("k")
    for e, least, most in _lengths(steps):
        if e:
            near = near | (F.length("s").between(least, most) & F.levenshtein("s", "k", 2 * e).between(0, 2 * e))
    pairs = look.join(index, "piece").filter(near).select("s", "k").distinct()
    return pairs.filter(_within(steps)("s", "k"))


@F.pandas_udf(T.BooleanType())
def _alike(typed: pd.Series, known: pd.Series) -> pd.Series:
    return pd.Series([same_given(a, b) is not None for a, b in zip(typed, known)], dtype=bool)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _spellings(known: pd.Series) -> pd.Series:
    """A listed first name, its full and short forms, also as scanners confuse them."""
    def forms(x):
        whole = {x, *FULL.get(x, ()), *SHORTS.get(x, ())}
        return sorted(whole | {confused(w) for w in whole})

    return known.map(forms)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _scanned(typed: pd.Series) -> pd.Series:
    return typed.map(lambda x: sorted({x, confused(x)}))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _full_forms(x: pd.Series) -> pd.Series:
    return x.map(lambda w: sorted(FULL.get(w, {w})))


def similar_given(typed: DataFrame, known: DataFrame) -> DataFrame:
    """(t, m): the pairs of a typed first name ``t`` and a listed one ``m``, both of two
    letters or more, that :func:`same_given` takes for each other.  Candidates come from
    three inverted indexes: segments of the spellings, full forms, and beginnings."""
    t, m = typed.select("t").filter(F.length("t") > 1).distinct(), known.select("m").filter(F.length("m") > 1).distinct()
    ts, ms = t.select("t", F.explode(_scanned("t")).alias("s")), m.select("m", F.explode(_spellings("m")).alias("k"))
    near = similar_keys(ts, ms, GIVEN_EDITS)
    edited = near.join(ts, "s").join(ms, "k").select("t", "m")
    full = t.select("t", F.explode(_full_forms("t")).alias("f")).join(m.select("m", F.explode(_full_forms("m")).alias("f")), "f").select("t", "m")
    begins = F.transform(F.sequence(F.lit(3), F.greatest(F.lit(3), F.length("m"))), lambda i: F.substr("m", F.lit(1), i))
    begun = t.join(m.select("m", F.explode(begins).alias("t")), "t").select("t", "m")
    return edited.unionByName(full).unionByName(begun).distinct().filter(_alike("t", "m"))


def link_names(typed: DataFrame, name: str, known: DataFrame, alias: str, entity: str) -> DataFrame:
    """(name, entity, cost): for each distinct typed name the entities of whose listed
    names it can be a spelling, with the cost of the best reading (0 or less: written
    alike; each edit 1; an initial 1).

    Names are read with titles and suffixes taken off, in either order, with parts
    split or joined, with short forms, initials, missing middle names and characters
    that scanners confuse.  Surnames and first names are each matched among their distinct
    spellings (:func:`similar_keys`, :func:`similar_given`); surnames of up to 4 letters
    only when they are the same.  Persons are then joined on surname and first name
    together, so a surname that very many share doesn't pair all who bear it; a typed
    initial is joined on surname and letter.  Middle names must not contradict each other.

    Defined cases: null, empty or one-word names link to nothing; names with equal cost
    to several entities give a row for each; repeated rows count once; empty tables
    give no rows; other columns are ignored.
    """
    require(typed, name)
    require(known, alias, entity)
    read = cut_lineage(typed.select(F.col(name).alias("n")).dropna().distinct().select("n", F.inline(_readings("n"))).drop("c").filter(F.size("g") > 0))
    index = known.select(F.col(alias).alias("a"), F.col(entity).alias("e")).dropna().distinct()
    index = cut_lineage(index.select("e", F.inline(_listed("a"))).select("e", F.col("s").alias("k"), F.col("g").alias("m"), "c").distinct())
    found = candidates(read, index)
    cost = found.withColumn("cost", _cost("s", "g", "k", "m") + F.col("c")).filter(F.col("cost").isNotNull() & ~F.isnan("cost"))
    return cost.groupBy("n", "e").agg(F.min("cost").alias("cost")).select(F.col("n").alias(name), F.col("e").alias(entity), "cost")


def candidates(read: DataFrame, index: DataFrame) -> DataFrame:
    """(n, s, g, e, k, m, c): readings (n, s, g) beside the listed names (e, k, m, c) whose
    surname and whose first name they resemble."""
    pairs = similar_keys(read, index)
    first, whole = F.get("g", F.lit(0)), F.concat(F.get("g", F.lit(0)), F.get("g", F.lit(1)))  # the latter split by a stray space
    asked = F.explode(F.array_compact(F.array(first, F.when(F.length(first) > 1, whole)))).alias("t")
    given = similar_given(read.select(asked), index.select(F.get("m", F.lit(0)).alias("m")))
    keys = given.groupBy("t").agg(F.collect_set(F.concat(F.lit("="), F.col("m"))).alias("keys"))  # as many as first names resemble one
    rows = read.join(pairs, "s").select("n", "s", "k", "g", asked, F.length(first).alias("letters"))
    letter = F.substring("t", 1, 1)
    by = F.when(F.col("letters") == 1, F.array(F.concat(F.lit("~"), letter))).otherwise(
        F.array_append(F.coalesce("keys", F.array().cast("array<string>")), F.concat(F.lit("?"), letter))
    )
    rows = rows.join(keys, "t", "left").select("n", "s", "k", "g", F.explode(by).alias("key")).distinct()
    m = F.get("m", F.lit(0))
    own = F.array(F.concat(F.lit("~"), F.substring(m, 1, 1)), F.concat(F.when(F.length(m) == 1, "?").otherwise("="), m))
    return rows.join(index.select("e", "k", "m", "c", F.explode(own).alias("key")), ["k", "key"]).drop("key")


#: Filings under one name above which they are dealt out over ``SALTS`` copies of its links.
HOT_ROWS, SALTS = 100_000, 16


def resolve_filers(
    filings: DataFrame, record_id: str, name: str, chamber: str, date: str,
    aliases: DataFrame, alias: str, entity: str, valid_from: str, valid_to: str, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(record_id, entity, cost): for each record the one entity whose name it spells
    and that has an alias of the same chamber valid on its date
    (``valid_from <= date < valid_to``, null end open).  Among several the cheapest
    reading wins; if that is a tie between entities, none is given.

    Records without a name, chamber or date give no row; a record delivered again counts
    once.  Links are found per distinct name and joined back; for the names on very many
    records, few by that bound, over a salt of the record id, so that none makes one task
    long."""
    require(filings, record_id, name, chamber, date)
    require(aliases, alias, entity, chamber, valid_from, valid_to)
    rows = filings.select(F.col(record_id).alias("r"), F.col(name).alias("n"), F.col(chamber).alias("ch"), F.col(date).alias("at")).dropna().distinct()
    links = link_names(rows, "n", aliases, alias, entity).withColumnRenamed(entity, "e")
    hot = cut_lineage(rows.groupBy("n").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > hot_rows).select("n", F.lit(SALTS - 1).alias("last")))
    last = F.coalesce("last", F.lit(0))
    links = links.join(hot, "n", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop("last")
    windows = aliases.select(F.col(entity).alias("e"), F.col(chamber).alias("ch"), F.col(valid_from).alias("a"), F.col(valid_to).alias("z")).distinct()
    salted = rows.join(hot, "n", "left").withColumn("salt", F.pmod(F.xxhash64("r"), last + 1).cast("int")).drop("last")
    linked = salted.join(links, ["n", "salt"]).alias("l")
    valid = linked.join(
        broadcast_if_small(windows).alias("w"),
        (F.col("l.e") == F.col("w.e")) & (F.col("l.ch") == F.col("w.ch")) & (F.col("a") <= F.col("at")) & (F.col("z").isNull() | (F.col("at") < F.col("z"))),
        "left_semi",
    )
    cheapest = F.rank().over(W.partitionBy("r").orderBy("cost"))
    one = valid.groupBy("r", "e").agg(F.min("cost").alias("cost")).withColumn("k", cheapest).filter(F.col("k") == 1)
    return (
        one.groupBy("r").agg(F.count(F.lit(1)).alias("ties"), F.first("e").alias("e"), F.first("cost").alias("cost"))
        .filter(F.col("ties") == 1)
        .select(F.col("r").alias(record_id), F.col("e").alias(entity), "cost")
    )
