"""Evaluation texts inside training text: a broadcast set of test n-grams, scanned windows."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.common import require, spread

#: Words of test items in one broadcast; more items than that are scanned for in blocks.
BLOCK_WORDS = 2_000_000
#: Markup inside a word is taken out; any other tag parts words.
INLINE = {"a", "abbr", "b", "bdi", "big", "code", "del", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "tt", "u", "wbr"}
TAG = re.compile(r"<(?:!--.*?--|[!/?]?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*|/)?)>", re.S)
WORD = re.compile(r"[^\W_]+")
ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
CLUSTER = re.compile(r".[̀-ͯ᪰-᫿⃐-⃿]*", re.S)


def _tag(m: re.Match) -> str:
    return "" if (m[1] or "").lower() in INLINE else " "


class _Visible(dict):
    """For str.translate: invisible characters are deleted; found out once each."""

    def __missing__(self, code: int):
        c = chr(code)
        self[code] = None if unicodedata.category(c) == "Cf" or 0xFE00 <= code <= 0xFE0F or code == 0x034F else c
        return self[code]


VISIBLE = _Visible()


def words(text: str) -> list[str]:
    """Runs of letters and digits, whatever their case, spacing, punctuation, markup,
    invisible characters and character forms."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = TAG.sub(_tag, text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(VISIBLE))
    text = text.casefold()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return WORD.findall(text)


def located_words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """:func:`words` with each word's place in the text as it is.  Slower; used on
    texts in which something was found."""
    pieces: list[tuple[str, int, int]] = []

    def plain(a: int, b: int) -> None:
        for m in CLUSTER.finditer(text, a, b):
            seen = m[0].translate(VISIBLE)
            if seen:
                pieces.append((unicodedata.normalize("NFC", unicodedata.normalize("NFKC", seen).casefold()), m.start(), m.end()))

    def entities(a: int, b: int) -> None:
        at = a
        for m in ENTITY.finditer(text, a, b):
            plain(at, m.start())
            pieces.append((unicodedata.normalize("NFKC", html.unescape(m[0]).translate(VISIBLE)).casefold(), m.start(), m.end()))
            at = m.end()
        plain(at, b)

    at = 0
    for m in TAG.finditer(text):
        entities(at, m.start())
        pieces.append((_tag(m), m.start(), m.end()))
        at = m.end()
    entities(at, len(text))
    flat = "".join(p for p, _, _ in pieces)
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p, _, _ in pieces])
    found, places = [], []
    for m in WORD.finditer(flat):
        found.append(m[0])
        places.append((pieces[owner[m.start()]][1], pieces[owner[m.end() - 1]][2]))
    return found, places


class NgramSet:
    """Hash set of the items' n-grams.  A word has a number; an n-gram is the bytes of
    its n numbers, so that a hit in the set is the n-gram itself and not a collision."""

    def __init__(self, items: list[tuple[int, list[str]]], n: int):
        self.n = n
        self.number: dict[str, int] = {}
        self.grams: dict[bytes, tuple[int, ...]] = {}
        for item, ws in items:
            ids = np.array([self.number.setdefault(w, len(self.number)) for w in ws], dtype=np.int32)
            for k in range(len(ids) - n + 1):
                g = ids[k : k + n].tobytes()
                have = self.grams.get(g, ())
                if item not in have:
                    self.grams[g] = (*have, item)

    def hits(self, ws: list[str]) -> dict[int, list[tuple[int, int]]]:
        """Per item the spans of words [from, to) of which every window of n words stands
        in the item."""
        n = self.n
        if len(ws) < n:
            return {}
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in ws), dtype=np.int32, count=len(ws))
        # only runs of n or more words that occur in items at all can hold a window
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        out: dict[int, list[tuple[int, int]]] = {}
        for a, b in known.reshape(-1, 2):
            for k in range(a, b - n + 1):
                for item in self.grams.get(ids[k : k + n].tobytes(), ()):
                    spans = out.setdefault(item, [])
                    if spans and k <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], k + n)
                    else:
                        spans.append((int(k), int(k + n)))
        return out


def _blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The test items, words found, in blocks of bounded size.  Items are a stated,
    limited set: they are read one after the other, never all held when there are many."""
    block, size = [], 0
    for row in items.select(item_id, text).dropna().orderBy(item_id).toLocalIterator():
        ws = words(row[1])
        block.append((row[0], ws))
        size += len(ws)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _each_block(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, n: int, block_words: int, scan, schema: str) -> DataFrame:
    spark, parts = docs.sparkSession, []
    for block in _blocks(items, item_id, item_text, block_words):
        shared = spark.sparkContext.broadcast(NgramSet(block, n))
        parts.append(docs.mapInPandas(scan(shared), schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def leaked(
    docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, n: int = 12, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, item_id, n_spans, n_words): for each document every item of which at
    least ``n`` consecutive words stand consecutively in it, in how many passages and
    with how many words.

    The items' n-grams form a hash set that is broadcast; a set of more than
    ``block_words`` words is split into blocks of items, each scanned for in turn, so a
    broadcast never exceeds that.  Documents are scanned where they lie, whole and
    once per block; nothing is shuffled or gathered.  A window that hits is the n-gram
    itself, word by word (no fingerprints), and windows that follow each other make
    one passage.

    Defined cases: null texts hold nothing; documents or items of fewer than n words
    give no row; a document that occurs on several rows gives a row for each; items
    with equal passages are each reported; no items or documents give no rows.
    """
    require(docs, doc_id, text)
    require(items, item_id, item_text)
    d, i = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()

    def scan(shared):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grams = shared.value
            for f in frames:
                rows = []
                for k, t in zip(f["d"], f["t"]):
                    for item, spans in grams.hits(words(t)).items():
                        rows.append((k, item, len(spans), sum(b - a for a, b in spans)))
                if rows:
                    yield pd.DataFrame(rows, columns=["d", "i", "s", "w"])

        return run

    slim = spread(docs).select(F.col(doc_id).alias("d"), F.col(text).alias("t")).dropna()
    out = _each_block(slim, items, item_id, item_text, n, block_words, scan, f"d {d}, i {i}, s int, w int")
    return out.select(F.col("d").alias(doc_id), F.col("i").alias(item_id), F.col("s").alias("n_spans"), F.col("w").alias("n_words"))


def remove_leaks(
    docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_text: str, n: int = 12, mode: str = "spans", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, text, n_removed): every document without the passages of test items
    (``mode='spans'``), or only the documents that hold none (``mode='documents'``).
    ``n_removed`` counts words.  A passage is cut from the original text from its first
    word to its last, with the markup between; the rest stays as it is, byte by byte.
    Passages of all blocks of items are found in the original text and cut once, so the
    size of a block changes nothing.  Null texts stay null, with 0."""
    if mode not in ("spans", "documents"):
        raise ValueError("mode is 'spans' or 'documents'")
    require(docs, doc_id, text)
    d = docs.schema[doc_id].dataType.simpleString()  # ids travel as strings: pandas has no null integers
    schema = "d string, t string, s array<int>"

    def scan(shared):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grams = shared.value
            for f in frames:
                spans = []
                for t, s in zip(f["t"], f["s"]):
                    s = list(s)
                    if t is not None and grams.hits(words(t)):
                        s += [x for ss in grams.hits(located_words(t)[0]).values() for span in ss for x in span]
                    spans.append(s)
                yield f.assign(s=pd.Series(spans, dtype=object, index=f.index))

        return run

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for k, t, s in zip(f["d"], f["t"], f["s"]):
                r = 0
                if len(s):
                    if mode == "documents":
                        continue
                    found, places = located_words(t)
                    out, at, gone = [], 0, np.zeros(len(found), dtype=bool)
                    for a, b in sorted(zip(s[::2], s[1::2])):
                        gone[a:b] = True
                        out.append(t[at : max(at, places[a][0])])
                        at = max(at, places[b - 1][1])
                    t, r = "".join(out) + t[at:], int(gone.sum())
                keep.append((k, t, r))
            yield pd.DataFrame(keep, columns=["d", "t", "r"])

    spark = docs.sparkSession
    out = spread(docs).select(F.col(doc_id).cast("string").alias("d"), F.col(text).alias("t"), F.array().cast("array<int>").alias("s"))
    for block in _blocks(items.withColumn("_id", F.monotonically_increasing_id()), "_id", item_text, block_words):
        out = out.mapInPandas(scan(spark.sparkContext.broadcast(NgramSet(block, n))), schema)
    out = out.mapInPandas(cut, "d string, t string, r int")
    return out.select(F.col("d").cast(d).alias(doc_id), F.col("t").alias(text), F.col("r").alias("n_removed"))
