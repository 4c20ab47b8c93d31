import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm.leakage import leaked, located_words, remove_leaks, words
from folioscope.llm.mixing import count_tokens, encoder, mix, tilted
from folioscope.llm.queries import VOCABULARY

ITEM = "Between 1975 and day 541, James Ralbru sold 44 units of Koscle to Nisost for cash."
FULL = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in ITEM)


def test_words_whatever_the_writing():
    want = words(ITEM)
    assert want[:4] == ["between", "1975", "and", "day"]
    for other in (ITEM.upper(), FULL, ITEM.replace("Ral", "Ra​l­"), ITEM.replace("James", "Ja<b>mes</b>"), ITEM.replace(" ", "  \n"), ITEM.replace(",", "</p><p>"), ITEM.replace("o", "&#111;")):
        assert words(other) == want
        assert located_words(other)[0] == want
    assert words("Ｃafé") == words("café") and words("") == []
    text = "a <i>b</i>c &amp; d​e éf"
    ws, at = located_words(text)
    assert ws == words(text) and [text[a:b] for a, b in at][-1] == "éf"


def brute(docs, items, n):
    out = set()
    for d, t in docs:
        if t is None:
            continue
        ws = words(t)
        for i, q in items:
            qs = words(q or "")
            grams = {tuple(qs[k : k + n]) for k in range(len(qs) - n + 1)}
            if any(tuple(ws[k : k + n]) in grams for k in range(len(ws) - n + 1)):
                out.add((d, i))
    return out


@pytest.mark.parametrize("block_words", [10**6, 30])
def test_leaks_equal_brute_force(spark, block_words):
    r = random.Random(4)
    items = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randrange(0, 20)))) for i in range(12)] + [(99, None), (100, "a b c d e")]
    docs = [(d, " ".join(r.choice("abcdefgh") for _ in range(40)) + " " + (r.choice(items)[1] or "")) for d in range(80)] + [(500, None), (501, ""), (502, "a " * 20000)]
    a, b = spark.createDataFrame(docs, "doc long, text string").withColumn("n_words", F.lit("clash")), spark.createDataFrame(items, "item int, text string")
    got = leaked(a, "doc", "text", b, "item", "text", 5, block_words)
    assert {(x.doc, x.item) for x in got.collect()} == brute(docs, items, 5)
    clean = remove_leaks(a, "doc", "text", b, "text", 5, block_words=block_words)
    assert clean.count() == len(docs)
    kept = {x.doc for x in remove_leaks(a, "doc", "text", b, "text", 5, "documents", block_words).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in brute(docs, items, 5)}


def test_removal_keeps_the_rest(spark):
    text = f"<p>Before it.</p> «{ITEM.replace('James', 'Ja<b>mes</b>')}» After it &amp; on."
    df = spark.createDataFrame([(1, text), (2, "nothing"), (None, None)], "doc long, text string")
    got = {x.doc: (x.text, x.n_removed) for x in remove_leaks(df, "doc", "text", spark.createDataFrame([(1, ITEM)], "i int, t string"), "t").collect()}
    assert got[1] == ("<p>Before it.</p> «.» After it &amp; on.", len(words(ITEM)))
    assert got[2] == ("nothing", 0) and got[None] == (None, 0)


def test_the_size_of_a_block_changes_no_removal(spark):
    ws = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(ws[:18])), (2, " ".join(ws[12:30])), (3, "x y z")]
    df = spark.createDataFrame([(1, "before " + " ".join(ws) + " after"), (2, "clean")], "doc long, text string")
    b = spark.createDataFrame(items, "i int, t string")
    out = [sorted(map(tuple, remove_leaks(df, "doc", "text", b, "t", block_words=k).collect())) for k in (10**6, 18, 1)]
    assert out[0] == out[1] == out[2] == [(1, "before " + " ".join(["", *ws[30:]]) + " after", 30), (2, "clean", 0)]


def test_leaks_of_nothing(spark):
    df = spark.createDataFrame([], "doc long, text string")
    assert leaked(df, "doc", "text", df, "doc", "text").count() == 0


def mixture(spark, docs, targets, **k):
    a = spark.createDataFrame(docs, "doc long, source string, text string").withColumn("copies", F.lit("clash")).repartition(3)
    b = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    copies, report = mix(a, "doc", "source", "text", b, VOCABULARY, **k)
    return copies.collect(), {x.source: x for x in report.collect()}


def test_mixture_reaches_its_shares(spark):
    r = random.Random(6)
    docs, i = [], 0
    for s, n in (("hot", 900), ("mid", 200), ("small", 20), ("other", 30), (None, 5)):
        for _ in range(n):
            docs.append((i, s, " ".join(r.choice(["word", "share", "value"]) for _ in range(r.randrange(1, 60)))))
            i += 1
    docs += [(i, "hot", ""), (i + 1, "mid", None)]
    targets = [("hot", 0.5, 1), ("mid", 0.3, 2), ("small", 0.1, 3), ("absent", 0.1, 5)]
    copies, report = mixture(spark, docs, targets)
    assert len(copies) == len(docs)
    caps = {s: c for s, _, c in targets}
    for x in copies:
        assert 0 <= x.copies <= caps.get(x.source, 0)
        assert abs(x.copies - x.rate) < 1 or x.n_tokens == 0
    for s, share in (("hot", 5 / 9), ("mid", 3 / 9), ("small", 1 / 9)):
        assert abs(report[s].actual_share - share) < 0.004
    assert report["small"].copies == 60  # the smallest decides the size, as often as allowed
    assert report["absent"].actual_share == 0 and report["other"].used_tokens == 0 and report[None].copies == 0
    again, _ = mixture(spark, docs[::-1], targets)
    assert sorted((x.doc, x.copies) for x in again) == sorted((x.doc, x.copies) for x in copies)


def test_tilt_meets_its_constraint_or_raises(monkeypatch):
    r = np.random.default_rng(1)
    t, n = np.unique(r.integers(1, 3000, 400)).astype(float), None
    n = r.integers(1, 50, len(t)).astype(float)
    whole = (n * t).sum()
    for part in (0.001, 0.2, 1.0, 1.7, 2.9999):
        rate = tilted(t, n, part * whole, 3)
        assert abs((n * rate * t).sum() / (part * whole) - 1) < 1e-8 and rate.max() <= 3
        free = rate < 3
        if free.sum() > 2:  # an exponential in the tokens
            slope = np.log(rate[free]) / t[free]
            assert np.allclose(slope, slope[0], rtol=1e-6, atol=1e-12)
    assert (tilted(t, n, 3 * whole, 3) == 3).all()
    monkeypatch.setattr("folioscope.llm.mixing.STEPS", 2)
    with pytest.raises(RuntimeError):
        tilted(t, n, 0.001 * whole, 3)


@pytest.mark.parametrize("part_rows", [250_000, 10])
def test_parts_of_a_size_and_bands_keep_shares(spark, part_rows):
    docs = [(i, s, "word " * n) for i, (s, n) in enumerate([("a", 7)] * 300 + [("a", 40)] * 20 + [("b", 5)] * 200)]
    for bands in (None, 4):
        copies, report = mixture(spark, docs, [("a", 0.6, 3), ("b", 0.4, 1)], part_rows=part_rows, bands_per_octave=bands)
        assert abs(report["a"].actual_share - 0.6) < 0.01 and report["b"].copies == 200
        assert all(x.copies <= 3 for x in copies)


def test_rates_are_exponential(spark):
    import math

    docs = [(i, s, "word " * n) for i, (s, n) in enumerate([("a", 23), ("a", 24), ("a", 25)] * 40 + [("b", 5)] * 40)]
    copies, _ = mixture(spark, docs, [("a", 0.5, 3), ("b", 0.5, 2)])
    by = {x.n_tokens: x.rate for x in copies if x.source == "a"}
    (t0, r0), (t1, r1), (t2, r2) = sorted(by.items())
    assert math.isclose(math.log(r1 / r0) / (t1 - t0), math.log(r2 / r1) / (t2 - t1), rel_tol=1e-4)


def test_mixture_edges(spark):
    copies, report = mixture(spark, [], [("a", 1.0, 2)])
    assert copies == [] and report["a"].used_tokens == 0
    copies, report = mixture(spark, [(1, "a", "x")], [("a", 0.0, 2), ("b", None, None)])
    assert copies[0].copies == 0
    copies, report = mixture(spark, [(i, "a", "x y z") for i in range(100)], [("a", 1.0, 2)], total_tokens=30)
    assert report["a"].used_tokens == 30


def test_tokens(spark):
    texts = ["", None, "The filer's 3 reports.", "é" * 3000, "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    e = encoder(VOCABULARY)
    assert {x.i: x.n_tokens for x in count_tokens(df, "t", ["i"], VOCABULARY).collect()} == {i: len(e.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert e.decode(e.encode_ordinary(texts[2])) == texts[2] and unicodedata
