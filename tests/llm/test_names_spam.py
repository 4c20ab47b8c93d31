import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folioscope.llm.names import allowed, candidates, given_cost, link_names, listed, osa, readings, resolve_filers, same_given, similar_given, similar_keys
from folioscope.llm.spam import FUNCTION, curve_in_row, page_profiles, rank_frequency, stuffed_pages, stuffing_share


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("letters,steps", [("abc", ((7, 2), (5, 1))), ("ab", ((6, 2), (3, 1)))])
def test_segment_join_equals_brute_force(spark, letters, steps):
    r = random.Random(8)
    left = ["".join(r.choice(letters) for _ in range(r.randrange(1, 11))) for _ in range(120)] + [""]
    right = ["".join(r.choice(letters) for _ in range(r.randrange(1, 11))) for _ in range(120)] + ["", "x" * 3000]
    got = similar_keys(spark.createDataFrame([(x,) for x in left], "s string"), spark.createDataFrame([(x,) for x in right], "k string"), steps)
    want = {(a, b) for a in left for b in right if a and b and (osa(a, b, e) <= e if (e := allowed(len(a), steps)) else a == b)}
    assert {tuple(x) for x in got.collect()} == want


def test_first_names_equal_brute_force(spark):
    r = random.Random(13)
    known = ["robert", "katherine", "kate", "jo", "joseph", "liz", "elizabeth", "ann", "anna", "theodore", "carmen", "bill", "al"]
    typed = known + ["bob", "rob", "kat", "eliz", "joe", "ted", "ned", "will", "alexander", "carrnen"]
    for x in known:
        for _ in range(6):
            i = r.randrange(len(x))
            typed.append(r.choice([x[:i] + x[i + 1 :], x[:i] + x[i : i + 2][::-1] + x[i + 2 :], x[:i] + r.choice("aeor") + x[i:], x[: i + 1]]))
    got = similar_given(spark.createDataFrame([(x,) for x in typed], "t string"), spark.createDataFrame([(x,) for x in known], "m string"))
    assert {tuple(x) for x in got.collect()} == {(a, b) for a in typed for b in known if len(a) > 1 and len(b) > 1 and same_given(a, b) is not None}


def test_a_common_surname_does_not_pair_all_who_bear_it(spark):
    r = random.Random(14)
    firsts = ["".join(r.choice("bcdfghklmnprstvz") + r.choice("aeiou") for _ in range(4)) for _ in range(300)]
    read = spark.createDataFrame([(f"{f} smithson", "smithson", [f]) for f in firsts], "n string, s string, g array<string>")
    index = spark.createDataFrame([(f"e{i}", "smithson", [f], 0) for i, f in enumerate(firsts)], "e string, k string, m array<string>, c int")
    got = candidates(read, index)
    n = got.count()
    assert n < 3 * len(firsts)  # of 90,000 pairs
    assert got.filter("g = m").select("n").distinct().count() == len(set(firsts))


def test_banded_distance():
    r = random.Random(9)
    for _ in range(300):
        a, b = ("".join(r.choice("ab") for _ in range(r.randrange(7))) for _ in range(2))
        assert osa(a, b, 2) <= min(3, lev(a, b))
    assert osa("abcd", "abdc", 2) == 1 and osa("abc", "xyz", 2) == 3 and osa("", "ab", 2) == 2


def test_readings_and_given_names():
    assert ("polnisurs", ("xavier", "e")) in readings("Hon. POLNISURS, XAVIER E.") and ("delapol", ("ann",)) in readings("Ann de la Pol")
    assert readings(None) == [] and readings("  ") == [] and listed("Madonna") == []
    assert given_cost(["larry"], ["lawrence"]) is not None and given_cost(["l"], ["lawrence"]) is not None
    assert given_cost(["susan"], ["lawrence"]) is None
    assert given_cost(["ann", "b"], ["ann", "c"]) is None and given_cost(["ann", "b"], ["ann", "beth"]) is not None


ALIASES = [
    ("Barzemtar, Kenneth Frederick", "house", dt.date(2010, 1, 1), None, "B1"),
    ("Patricia O'Folgre", "senate", dt.date(2010, 1, 1), dt.date(2015, 1, 1), "F1"),
    ("Jörg Vonlinmag", "house", dt.date(2010, 1, 1), None, "V1"),
    ("Ann Twinname", "house", dt.date(2010, 1, 1), dt.date(2012, 1, 1), "T1"),
    ("Ann Twinname", "house", dt.date(2011, 1, 1), None, "T2"),
    (None, "house", dt.date(2010, 1, 1), None, "N1"),
]


CASES = [
        ("rep. ken barzerntar", "house", 2013, "B1"), ("BARZEMATR  K F", "house", 2013, "B1"), ("Barzem tar, Kenneth", "house", 2013, "B1"),
        ("Barzemtar, Ken", "senate", 2013, None), ("Barzemtar, Susan", "house", 2013, None), ("Kenneth G. Barzemtar", "house", 2013, None),
        ("Pat OFolgre", "senate", 2013, "F1"), ("Pat OFolgre", "senate", 2015, None), ("Vonlinmag, Jorg", "house", 2013, "V1"),
        ("Ann Twinname", "house", 2010, "T1"), ("Ann Twinname", "house", 2011, None), ("Ann Twinname", "house", 2014, "T2"),
        ("", "house", 2013, None), (None, "house", 2013, None), ("x" * 3000, "house", 2013, None), ("Barzemtar", "house", 2013, None),
]


@pytest.mark.parametrize("hot_rows", [1000, 0])
def test_filers(spark, hot_rows):
    rows = [(f"r{i}", name, chamber, dt.date(year, 6, 1)) for i, (name, chamber, year, _) in enumerate(CASES)] * 2
    filings = spark.createDataFrame(rows, "r string, n string, chamber string, d date").withColumn("salt", F.lit("clash"))
    aliases = spark.createDataFrame(ALIASES, "alias string, chamber string, f date, t date, who string")
    got = resolve_filers(filings, "r", "n", "chamber", "d", aliases, "alias", "who", "f", "t", hot_rows).collect()
    assert len(got) == len({x.r for x in got})
    assert {x.r: x.who for x in got} == {f"r{i}": want for i, (*_, want) in enumerate(CASES) if want}


def test_names_of_nothing(spark):
    e = spark.createDataFrame([], "n string, a string, who string")
    assert link_names(e, "n", e, "a", "who").count() == 0


PROSE = "The committee met on Tuesday and closed the file. A report is late when many days pass between trade and filing. Nobody asked for the names of the owners. "
SPAM = [
    "cheap chart bundle, free tax helper, cheap chart bundle online, free tax helper 2021, cheap chart bundle, top fund cloner, " * 5,
    "#CheapChart #FreeTaxHelper #TopFundCloner9 #CheapChart2 #DailyPick " * 4,
    "\n".join(f"- [cheap chart {i}](https://site{i}.example/a{i})" for i in range(20)),
    "\n".join(f"* site{i}-picks dot test" for i in range(20)),
    "Looking for cheap chart bundle? Our cheap chart bundle is the best cheap chart bundle for tax helper fans. Buy cheap chart bundle, sell tax helper, share tax helper, love cheap chart bundle. " * 4,
    PROSE + "\n\n" + "best broker free stock tips " * 40,
]
FAIR = [
    PROSE,
    "\n".join(f"{PROSE.split('.')[i % 3]}. See https://site{i}.example/doc/{i} for the paper." for i in range(9)),
    "\n".join(f"Acme{i} Holdings Inc; TK{i}; {i}4,051 SH; $142,{100 + i}; SOLE" for i in range(30)),
    "\n".join(f"TK{i}\t4{i},707\t33.{i}%\t$10,453" for i in range(30)),
    PROSE + "\nMore at https://site.example/",
    "", None, "Halcas", "x" * 10000,
]


def test_shares_of_stuffing():
    for t in SPAM:
        assert stuffing_share(t) > 0.5, t[:80]
    for t in FAIR:
        assert stuffing_share(t) <= 0.5, (t or "")[:80]


def test_stuffed_pages(spark):
    r = random.Random(10)
    who = ["Nisgim", "Vedtar", "Raltar", "Folbar", "Koscle", "Linmag", "Zemost"]

    def page():
        return " ".join(r.choice([f"The committee heard {r.choice(who)} on May {r.randrange(30)} about rail.", f"A report of {r.choice(who)} is late when {r.randrange(90)} days pass between trade and filing.", f"No value was printed for the notes of {r.choice(who)} and none is assumed here.", f"The panel met {r.randrange(90)} times and closed with a plain plan."]) for _ in range(r.randrange(3, 40)))

    docs = [(i, page(), "en") for i in range(300)] + [(1000 + i, t, r.choice(["en", None, "xx"])) for i, t in enumerate(SPAM)] + [(2000 + i, t, "en") for i, t in enumerate(FAIR)] + [(None, SPAM[0], "en")]
    df = spark.createDataFrame(docs, "doc long, text string, lang string").withColumn("slope", F.lit("clash"))
    got = {x.doc for x in stuffed_pages(df, "doc", "text").collect()}
    assert got == {1000 + i for i in range(len(SPAM))}
    assert stuffed_pages(df.limit(0), "doc", "text").count() == 0


def test_a_stuffed_page_with_copies_on_a_third_of_the_rows(spark):
    r = random.Random(11)
    prose = [(i, " ".join(f"A report of {r.randrange(999)} pages came late because nobody asked the {r.choice(['clerk', 'panel', 'owner'])} for it." for _ in range(7)), "en") for i in range(240)]
    copies = [(1000 + i, SPAM[0], "en") for i in range(120)]
    got = {x.doc for x in stuffed_pages(spark.createDataFrame(prose + copies, "doc long, text string, lang string"), "doc", "text").collect()}
    assert got == {d for d, _, _ in copies}


TERMS = [
    "The buyer shall pay the seller what the buyer owes the seller.", "A seller who sells to a buyer owes that buyer a note of what the seller sells.",
    "If the agent of the seller fails, the seller and not the agent pays the buyer.", "No agent may act for the buyer where the agent acts for the seller.",
    "The note is due when the buyer has it, and the buyer has it when the agent gives the note to the buyer.",
]


def test_the_curves_decide(spark):
    """Terms that recur in every sentence look stuffed to the check of segments; their
    curve is that of prose, so the page isn't found."""
    r = random.Random(15)
    legal = " ".join(TERMS)
    assert stuffing_share(legal) > 0.5
    nouns = [a + b for a in ("fil", "trad", "not", "pan", "rul", "mark", "own", "vot") for b in ("er", "ing", "el", "or", "ard", "ess")]
    forms = ["The {} of the {} met and the {} was read to a {}.", "If a {} fails, the {} and not the {} is held by the {}.", "No {} may act for the {} where it acts for a {}.", "A {} who is late owes the {} a {} for what was due."]

    def page():
        few = r.sample(nouns, r.randrange(3, 30))
        return " ".join(r.choice(forms).format(*[r.choice(few) for _ in range(4)]) for _ in range(r.randrange(3, 20)))

    docs = [(i, page()) for i in range(400)] + [(1000, legal), (1001, SPAM[0]), (1002, SPAM[3])]
    df = spark.createDataFrame(docs, "doc long, text string")
    for broadcast_rows in (1000, -1):
        got = {x.doc: x.extreme for x in stuffed_pages(df, "doc", "text", broadcast_rows=broadcast_rows).collect()}
        assert 1000 not in got and {1001, 1002} <= set(got) and all(got.values())


def test_the_curve_in_a_row_is_the_curve_by_windows(spark):
    docs = [(i, t) for i, t in enumerate([*SPAM, *FAIR, "a", "a a a", "a b c", "Der Rat hat die Akte und das Buch."]) if t]
    profiles = page_profiles(spark.createDataFrame(docs, "doc long, text string"))
    a, b = ({x.doc: (x.n_words, x.n_types, x.lang, round(x.slope, 9), round(x.residual, 9)) for x in f(profiles).collect()} for f in (rank_frequency, curve_in_row))
    assert a == b and len(a) == len(docs) and a[max(a)][2] == "de"
    assert set(FUNCTION) == {"en", "es", "de", "fr"}


def test_hosts_of_any_name_are_links():
    for end in ("example", "shop", "museum"):
        assert stuffing_share("\n".join(f"- best-pills{i}.{end}" for i in range(20))) > 0.5


def test_the_number_of_pages_decides_nothing(spark):
    def found(times):
        docs = [(i, t, "en") for i, t in enumerate([SPAM[0]] * 4 * times + [PROSE * 4] * times)]
        return stuffed_pages(spark.createDataFrame(docs, "doc long, text string, lang string"), "doc", "text").count()

    assert found(5) == 20 and found(50) == 200


def test_swapped_letters_are_searched_as_they_are_verified(spark):
    r = random.Random(12)
    known = ["".join(r.choice("abcd") for _ in range(r.randrange(1, 13))) for _ in range(150)]

    def mistyped(x):
        for _ in range(r.randrange(3)):
            i, kind = r.randrange(len(x) + 1), r.randrange(4)
            x = x[:i] + x[i : i + 2][::-1] + x[i + 2 :] if kind == 0 else x[:i] + ("" if kind == 1 else r.choice("abcd")) + x[i + (kind < 3) :]
        return x

    typed = [mistyped(x) for x in known for _ in range(3)]
    got = similar_keys(spark.createDataFrame([(x,) for x in typed], "s string"), spark.createDataFrame([(x,) for x in known], "k string"))
    want = {(a, b) for a in typed for b in known if (osa(a, b, allowed(len(a))) <= allowed(len(a)) if allowed(len(a)) else a == b)}
    assert {tuple(x) for x in got.collect()} == {x for x in want if x[0]}


@pytest.mark.parametrize("name", ["Taevdrozan-Jorhobarl Joe H.", "Tevdrozan-Ojrhobarl, Joe"])
def test_a_swap_beside_another_typo(spark, name):
    typed, known = spark.createDataFrame([(name,)], "n string"), spark.createDataFrame([("TEVDROZAN-JORHOBRAL, JOSEPH HENRY", "T9")], "a string, who string")
    assert [x.who for x in link_names(typed, "n", known, "a", "who").collect()] == ["T9"]


def test_short_surnames_are_matched_exactly(spark):
    cases = {"Mary Ng": ["N1"], "NG, MARY": ["N1"], "Wu David": ["W1"], "Mary Nh": [], "O, Ann": ["O1"], "Mary N": []}
    typed, known = spark.createDataFrame([(n,) for n in cases], "n string"), spark.createDataFrame([("Ng, Mary", "N1"), ("David Wu", "W1"), ("Ann O", "O1")], "a string, who string")
    got = {n: [] for n in cases}
    for x in link_names(typed, "n", known, "a", "who").collect():
        got[x.n].append(x.who)
    assert got == cases
