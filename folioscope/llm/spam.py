"""Keyword-stuffed and link-list pages: rank-frequency curves that are not those of prose, then a check of segments."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from ..operators.common import cut_lineage, is_small, require, spread
from .leakage import VISIBLE

#: Part of a page's words that function words of a language make up in prose.
PROSE_SHARE = 0.2
#: Standard deviations from prose of the same language and length at which a slope or a
#: residual is extreme.
EXTREME = 3.0
#: Twice the words times the divergence (a likelihood ratio) at which it is extreme.
EXTREME_RATIO = 15.0
#: Least deviations, for corpora whose prose is all alike.
LEAST_SD = {"slope": 0.02, "residual": 0.002}
#: Flagged pages (two numbers each) that are broadcast at most.
FLAGGED_ROWS = 1_000_000

#: A sentence of which this part is the page's core words is stuffed.
CORE_PART = 0.5
#: Part of a page's content words that core words must be for the page to have any.
CORE_MASS = 0.4

# Common function words of the four languages.
FUNCTION = {
    "en": """
    a about above after again all also an and any are as at be because been before being below between both but by can
    cannot could did do does during each either every few for from had has have he her here him his how however i if in
    into is it its just may me might more most must my neither no nor not now of on once only or other our out over own
    per same shall she should since so some such than that the their them then there these they this those though
    through to too under until up upon us was we were what when where whether which while who whom whose why will with
    within without would you your
    """,
    "es": """
    al algo ante antes aunque como con contra cual cuando de del desde donde durante el ella ellas ellos en entre era es
    esta estaba estas este esto estos fue ha han hasta hay la las le les lo los mas más ni no nos o para pero por porque
    que qué quien se según ser si sin sobre son su sus también tiene un una uno unos y ya
    """,
    "de": """
    aber als am an auch auf aus bei bis da das dass dem den der des die dies diese dieser dieses doch durch ein eine
    einem einen einer eines er es für gegen hat hatte ich ihr ihre im in ist ja kann keine mit nach nicht noch nur ob
    oder ohne seit sich sie sind so über um und uns unter vom von vor war wenn werden wie wird wo wurde zu zum zur
    """,
    "fr": """
    au aucun aucune aussi aux avec c ce ces cette comme d dans de depuis des dont du elle elles en est et eu il ils j je
    l la le les leur leurs lui mais même n ne ni nous on ont ou où par pas pour qu que qui s sa sans se ses si son sont
    sous sur un une y à été être
    """,
}
LANGUAGES = tuple(FUNCTION)
FUNCTION_WORDS = frozenset(w for text in FUNCTION.values() for w in text.split())
#: An address with a scheme, or a bare host: labels joined by dots, the last of letters.
LINK = re.compile(
    r"(?i:(?:h(?:tt|xx)ps?://|www\.)[^\s<>()\"'\]]+)"
    r"|(?<![\w.@])[A-Za-z0-9][A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:\.|\s+dot\s+|\s*[\[(]dot[\])]\s*)[a-z]{2,24}\b(?:/[^\s<>()\"'\]]*)?"
)
MARKUP = re.compile(r"<[^<>]*>")
HREF = re.compile(r"<a\s[^<>]*href\s*=\s*[\"']?([^\"'\s<>]+)[^<>]*>", re.I)
MAYBE_LINK = re.compile(r"://|www\.|[a-z0-9]\.[a-z]{2}|\bdot\b", re.I)
SENTENCE = re.compile(r"(?<=[.!?])[\"')\]]*\s+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
FIGURE = re.compile(r"\d[\d.,]*")
FIGURED = re.compile(r"(?<!\S)(?!#)\S*?\d\S*")
HASHTAG = re.compile(r"#\w+")


def visible_lines(text: str) -> list[str]:
    """The lines of a text as a reader sees them, with the targets of links."""
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(VISIBLE))
    if "<" in text:
        text = MARKUP.sub(" ", HREF.sub(r" \1 ", text))
    return [s for s in (x.strip() for x in text.splitlines()) if s]


def _grammar(words: Sequence[str]) -> int:
    """How many different function words there are."""
    return len({w for w in words if w in FUNCTION_WORDS})


def _words(text: str) -> list[str]:
    return WORD.findall(text.casefold())


def _stuffed(segment: str, words: list[str], content: list[str], heads: Counter, core: set[str]) -> bool:
    """Whether a sentence, or a line without an end, is keywords or tags rather than
    prose or a record.  ``heads``: how often a line of the page begins with two words;
    ``core``: the few words that the page repeats from sentence to sentence, where
    sentences that differ in figures only count once."""
    pieces = segment.count(" ") + 1
    if "#" in segment and (tags := len(HASHTAG.findall(segment))) >= 3 and 2 * tags >= pieces:
        return True
    figures = len(FIGURED.findall(segment))
    again = len(content) - len(set(content))
    if len(content) >= 5 and again >= max(2, 0.2 * len(content)):
        return figures < 0.25 * pieces  # records repeat units beside their figures
    if figures >= 0.15 * pieces:
        return False
    if len(content) >= 2 and sum(w in core for w in content) >= CORE_PART * len(content):
        return True
    open_end = segment[-1] not in ".!?"
    if open_end and len(words) >= 8 and 10 * (len(words) - len(content)) < len(words):
        return True
    # the same words begin many lines of the page
    return open_end and 2 <= len(words) < 12 and _grammar(words) < 2 and heads[tuple(words[:2])] >= 5


def stuffing_share(text: str | None) -> float:
    """The part of a text's visible characters that stands in stuffed segments: lines
    of links without a remark of their own, lists of keywords or tags, and sentences
    made of the same few words again and again.  Records (lines with figures) and
    sentences, also such that mention links or keywords, are not stuffed."""
    lines = visible_lines(text or "")
    whole = bad = 0
    parts: list[tuple[str, list[str], list[str]]] = []
    for line in lines:
        size = len(line) - line.count(" ")
        whole += size
        if MAYBE_LINK.search(line):
            line, links = LINK.subn(" ", line)
            if links:
                words = _words(line)
                if _grammar(words) < 2 or len(words) < 4 * links:
                    bad += size
                    continue
        for s in SENTENCE.split(line):
            if s := " ".join(s.split()):
                words = _words(s)
                parts.append((s, words, [w for w in words if w not in FUNCTION_WORDS]))
    heads = Counter(tuple(words[:2]) for _, words, _ in parts)
    spread_, within = Counter(), Counter()
    for content in {FIGURE.sub("0", s): c for s, _, c in parts}.values():
        spread_.update(content)
        within.update(set(content))
    mass = sum(spread_.values())
    often = max(4, 0.04 * mass)
    # sentences of one form share words too, but once each
    core = {w for w, n in spread_.items() if n >= often and n >= 1.3 * within[w]}
    if sum(spread_[w] for w in core) < CORE_MASS * mass:
        core = set()
    for s, words, content in parts:
        if _stuffed(s, words, content, heads, core):
            bad += len(s) - s.count(" ")
    return bad / whole if whole else 0.0


def _lagged(c: str) -> Column:
    """An array moved on by one place."""
    return F.concat(F.array(F.get(c, F.lit(-1))), F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))))


def _runs(df: DataFrame, c: str, value: str, length: str) -> DataFrame:
    """Of the sorted array ``c`` its distinct values and how often each stands in it, as
    two arrays, counted inside the row."""
    begins = F.zip_with(c, _lagged(c), lambda x, y: ~x.eqNullSafe(y))
    at = F.filter(F.transform(begins, lambda b, i: F.when(b, i)), lambda i: i.isNotNull())
    held = df.withColumn("_at", at)
    until = F.concat(F.slice("_at", F.lit(2), F.size("_at")), F.array(F.size(c)))
    held = held.withColumn(length, F.zip_with(until, "_at", lambda z, a: z - a))
    return held.withColumn(value, F.transform("_at", lambda i: F.get(F.col(c), i))).drop("_at")


def page_profiles(pages: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """``pages`` (doc, text) reduced in their rows to ``key`` (a hash of the text),
    n_words, n_types, ``lang`` (the language with most function words on the page, null
    without any), ``function`` and ``figures`` (parts of the words), and ``levels``: how
    many words occur how often, most frequent first.  Nothing is shuffled; a text
    without a word gives no row."""
    known = {c: FUNCTION[c].split() for c in languages}
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    every = sorted({w for ws in known.values() for w in ws})
    x = pages.select("doc", F.xxhash64("text").alias("key"), F.sort_array(words).alias("w")).filter(F.size("w") > 0)
    among = lambda c, ws: F.filter(c, lambda w: w.isin(ws))
    x = x.withColumn("fw", among("w", every))
    x = x.withColumn("hits", F.array(*[F.size(among("fw", ws)) for ws in known.values()]))
    x = x.withColumn("n_figures", F.size(F.filter("w", lambda w: w.between(F.lit("0"), F.lit("9\uffff")))))
    x = _runs(x.withColumn("n_words", F.size("w")), "w", "types", "counts")
    x = x.select("doc", "key", "n_words", F.size("counts").alias("n_types"), "hits", "n_figures", F.sort_array("counts", asc=False).alias("c"))
    x = _runs(x, "c", "n", "v")
    best = F.array_max("hits")
    lang = F.when(best > 0, F.get(F.array(*[F.lit(c) for c in known]), (F.array_position("hits", best) - 1).cast("int")))
    return x.select(
        "doc", "key", "n_words", "n_types", lang.alias("lang"), (best / F.col("n_words")).alias("function"),
        (F.col("n_figures") / F.col("n_words")).alias("figures"), F.arrays_zip("n", "v").alias("levels"),
    )


PROFILE = ["n_words", "n_types", "lang", "function", "figures"]


def _fit(sw: Column, sx: Column, sy: Column, sxx: Column, sxy: Column, syy: Column, levels: Column) -> tuple[Column, Column]:
    """Slope and mean squared residual of a weighted line; a page whose words all occur
    equally often has a slope and a residual of 0."""
    slope = F.when(levels > 1, (sw * sxy - sx * sy) / (sw * sxx - sx * sx)).otherwise(0.0)
    residual = F.when(levels > 1, (syy - sy * sy / sw - slope * (sxy - sx * sy / sw)) / sw).otherwise(0.0)
    return slope, F.greatest(residual, F.lit(0.0))


def rank_frequency(profiles: DataFrame) -> DataFrame:
    """The curve of word frequency over rank of every page: slope and residual of a line
    through the logarithms, by windows over a page's levels.  Words of equal frequency
    share the mean of their ranks.  A page delivered again has one curve.

    Only the levels are shuffled, a few numbers a page, once, by page: removing repeats,
    the windows and the sums have the same partitioning."""
    once = profiles.dropDuplicates(["doc", "key"])
    rows = once.select("doc", "key", *PROFILE, F.inline("levels"))
    before = F.coalesce(F.sum("v").over(W.partitionBy("doc", "key").orderBy(F.col("n").desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("x", F.log(before + (F.col("v") + 1) / 2)).withColumn("y", F.log(F.col("n").cast("double")))
    x, y, v = F.col("x"), F.col("y"), F.col("v")
    sums = {"sw": v, "sx": v * x, "sy": v * y, "sxx": v * x * x, "sxy": v * x * y, "syy": v * y * y}
    page = rows.groupBy("doc", "key", *PROFILE).agg(F.count(F.lit(1)).alias("levels"), *[F.sum(c).cast("double").alias(k) for k, c in sums.items()])
    slope, residual = _fit(*[F.col(k) for k in sums], F.col("levels"))
    return page.select("doc", "key", *PROFILE, slope.alias("slope"), residual.alias("residual"))


def curve_in_row(profiles: DataFrame) -> DataFrame:
    """:func:`rank_frequency` folded over the levels inside each row, without a shuffle
    and with a row for every repeat."""
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("before", "sw", "sx", "sy", "sxx", "sxy", "syy")])

    def step(a: Column, e: Column) -> Column:
        v = e["v"].cast("double")
        x, y = F.log(a["before"] + (v + 1) / 2), F.log(e["n"].cast("double"))
        add = {"before": v, "sw": v, "sx": v * x, "sy": v * y, "sxx": v * x * x, "sxy": v * x * y, "syy": v * y * y}
        return F.struct(*[(a[k] + c).alias(k) for k, c in add.items()])

    held = profiles.withColumn("s", F.aggregate("levels", zero, step))
    slope, residual = _fit(*[F.col(f"s.{k}") for k in ("sw", "sx", "sy", "sxx", "sxy", "syy")], F.size("levels"))
    return held.select("doc", "key", *PROFILE, slope.alias("slope"), residual.alias("residual"))


MEASURES = ("slope", "residual", "function", "figures")


def prose_references(curves: DataFrame) -> DataFrame:
    """(lang, and per measure its line over the logarithm of the number of words with the
    deviation from it), fitted to the prose of each language and, with a null lang, to
    that of all.  Prose are pages with as many function words as sentences have; texts
    that occur again and again count once, and pages of keywords, however many there
    are, have no say in what prose is like.  At most one row a language and one."""
    prose = curves.filter((F.col("function") >= PROSE_SHARE) & (F.col("n_words") > 1))
    prose = prose.groupBy("key").agg(*[F.first(c).alias(c) for c in ("n_words", "lang", *MEASURES)])
    x = F.log(F.col("n_words").cast("double"))
    line = []
    for m in MEASURES:
        y = F.col(m)
        line += [
            F.regr_slope(y, x).alias(f"{m}_b"), F.regr_intercept(y, x).alias(f"{m}_a"),
            F.sqrt(F.greatest(F.lit(0.0), (F.regr_syy(y, x) - F.pow(F.regr_sxy(y, x), 2) / F.nullif(F.regr_sxx(y, x), F.lit(0.0))) / F.nullif(F.regr_count(y, x), F.lit(0)))).alias(f"{m}_sd"),
        ]
    names = [f"{m}_{k}" for m in MEASURES for k in ("b", "a", "sd")]
    alone = prose.groupBy("lang").agg(*line).filter(F.col("slope_b").isNotNull())
    pooled = prose.agg(*line).select(F.lit(None).cast("string").alias("lang"), *names)
    return alone.select("lang", *names).unionByName(pooled)


def extremes(curves: DataFrame, references: Sequence[Row]) -> DataFrame:
    """``curves`` with ``divergence`` (Kullback-Leibler, of the page's function words,
    figures and other words from prose of its language and length) and ``extreme``: which
    of slope, residual and divergence are not those of prose, null if none is.  Where no
    prose is known, every page is extreme.  ``references`` are the few rows of
    :func:`prose_references`."""
    pooled = next((tuple(r)[1:] for r in references if r["lang"] is None), None)
    known = {r["lang"]: tuple(r)[1:] for r in references if r["lang"] is not None}
    names = [f"{m}_{k}" for m in MEASURES for k in ("b", "a", "sd")]
    rows = [(c, *known.get(c, pooled or (None,) * len(names))) for c in (*LANGUAGES, None)]
    told = curves.sparkSession.createDataFrame(rows, "_l string, " + ", ".join(f"{c} double" for c in names))
    curves = curves.join(F.broadcast(told), F.col("lang").eqNullSafe(F.col("_l")))
    par = F.col
    at = F.log(F.col("n_words").cast("double"))
    usual = {m: par(f"{m}_a") + par(f"{m}_b") * at for m in MEASURES}
    q_f = F.least(F.lit(0.9), F.greatest(F.lit(0.02), usual["function"]))
    q_d = F.least(F.lit(0.5), F.greatest(F.lit(0.01), usual["figures"]))
    cells = [(F.col("function"), q_f), (F.col("figures"), q_d), (F.greatest(F.lit(0.0), 1 - F.col("function") - F.col("figures")), F.greatest(F.lit(0.05), 1 - q_f - q_d))]
    divergence = sum((F.when(p > 0, p * F.log(p / q)).otherwise(0.0) for p, q in cells), F.lit(0.0))
    score = {m: (F.col(m) - usual[m]) / F.greatest(F.lit(LEAST_SD[m]), par(f"{m}_sd")) for m in ("slope", "residual")}
    unknown = par("slope_b").isNull()
    x = curves.withColumn("divergence", divergence)
    why = F.concat_ws(
        ",", F.when(unknown | (F.abs(score["slope"]) > EXTREME), "slope"), F.when(unknown | (score["residual"] > EXTREME), "residual"),
        F.when(unknown | (2 * F.col("n_words") * F.col("divergence") > EXTREME_RATIO), "divergence"),
    )
    return x.select("doc", "key", *PROFILE, "slope", "residual", "divergence", F.when(why != "", why).alias("extreme"))


def stuffed_pages(
    docs: DataFrame, doc_id: str, text: str, share: float = 0.5, languages: Sequence[str] = LANGUAGES, broadcast_rows: int = FLAGGED_ROWS
) -> DataFrame:
    """(doc_id, stuffing_share, slope, residual, divergence, extreme) of the pages whose
    rank-frequency curve or divergence is not that of prose and more than ``share`` of
    whose text is keywords, links or tags.

    The curves choose: a page with the slope, residual and divergence of same-language
    prose of its length is never found, whatever its segments look like.  Tables and
    lists of records aren't prose either; of the pages chosen an exact check, segment by
    segment, over the whole text, tells them from stuffing (:func:`stuffing_share`).
    What prose is like is fitted over all pages (:func:`prose_references`), so nothing
    depends on how many pages there are or how many are stuffed.

    Texts are never shuffled.  Which pages are chosen is broadcast up to
    ``broadcast_rows``; beyond that the curves are folded once more in the rows.

    Defined cases: null texts, texts without a word and null ids give no row; repeated
    rows of a document give one row each; an empty table gives no rows.
    """
    require(docs, doc_id, text)
    docs = spread(docs)
    pages = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).dropna()
    curves = cut_lineage(rank_frequency(page_profiles(pages, languages)))
    references = prose_references(curves).collect()  # a row a language and one
    told = ["slope", "residual", "divergence", "extreme"]
    flagged = extremes(curves, references).filter(F.col("extreme").isNotNull()).select("doc", "key", *told)
    if is_small(flagged.select("doc", "key"), broadcast_rows):
        chosen = pages.withColumn("key", F.xxhash64("text")).join(F.broadcast(flagged), ["doc", "key"])
    else:
        # the fold loses the text, so it is carried along as a struct with the id
        carried = pages.select(F.struct("doc", "text").alias("doc"), "text")
        again = extremes(curve_in_row(page_profiles(carried, languages)), references)
        chosen = again.filter(F.col("extreme").isNotNull()).select("doc.doc", "doc.text", *told)
    # not to be evaluated below the join, on pages that no curve has chosen
    checked = F.pandas_udf(lambda s: s.map(stuffing_share).astype("float64"), "double").asNondeterministic()
    found = chosen.withColumn("stuffing_share", checked("text")).filter(F.col("stuffing_share") > share)
    return found.select(F.col("doc").alias(doc_id), "stuffing_share", *told)


def page_curves(docs: DataFrame, doc_id: str, text: str, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """(doc_id, n_words, n_types, slope, residual) of every page with a word."""
    require(docs, doc_id, text)
    pages = spread(docs).select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).dropna()
    return rank_frequency(page_profiles(pages, languages)).select(F.col("doc").alias(doc_id), "n_words", "n_types", "slope", "residual")
