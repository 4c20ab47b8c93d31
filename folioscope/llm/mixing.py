"""Mixing sources to target weights: entropy balancing by distributed Newton steps."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..operators.common import broadcast_if_small, cut_lineage, require, spread

#: The pattern that splits text before the merges of the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Sources a target table may list; their few numbers are kept on the driver.
MOST_SOURCES = 1_000
#: Documents of one source and size ordered in one task when copies are dealt out.
PART_ROWS = 250_000
STEPS, TOLERANCE = 300, 1e-9

_encoders: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once per process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def count_tokens(df: DataFrame, text: str, columns: list[str], vocabulary: str) -> DataFrame:
    """``columns`` and ``n_tokens`` of the whole ``text``; null text has 0 tokens.
    ``vocabulary`` is a path that every executor can read."""
    require(df, text, *columns)
    slim = spread(df).select(F.struct(*columns).alias("keep"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(vocabulary)
        for s in series:
            yield pd.Series([len(e.encode_ordinary(t)) for t in s], dtype="int64")

    tokens = F.pandas_udf(run, "long")  # type: ignore[call-overload]
    return slim.select("keep.*", tokens("t").alias("n_tokens"))


def _budget(tokens: dict[str, int], targets: dict, total_tokens: int | None) -> tuple[Decimal, dict[str, Decimal]]:
    """The mixture's size and each reachable source's share of it, to the sum of 1."""
    reachable = {s: share for s, (share, cap) in targets.items() if share > 0 and cap > 0 and s in tokens}
    whole = sum(reachable.values(), Decimal(0))
    shares = {s: x / whole for s, x in reachable.items()} if whole else {}
    most = min((Decimal(tokens[s]) * targets[s][1] / x for s, x in shares.items()), default=Decimal(0))
    return (most if total_tokens is None else min(most, Decimal(total_tokens))), shares


def tilted(tokens: np.ndarray, n: np.ndarray, target: float, cap: int) -> np.ndarray:
    """Rates min(cap, exp(slope * tokens / scale)) at which ``n`` documents of each size give
    ``target`` tokens: the rates nearest to 1 in relative entropy that meet the constraint.

    Newton steps on the convex dual.  Its gradient in the slope is the tokens the rates
    give less the target, its second derivative the tokens' second moment; a step that
    leaves the interval known to hold the root is replaced by halving.  Raises if the
    constraint isn't met to ``TOLERANCE`` in ``STEPS`` steps."""
    whole = float((n * tokens).sum())
    if target >= cap * whole * (1 - 1e-12):
        return np.full(len(tokens), float(cap))  # every document as often as allowed
    x = tokens / (whole / n.sum())
    slope, low, high = 0.0, -math.inf, math.inf
    for _ in range(STEPS):
        rate = np.minimum(cap, np.exp(np.minimum(slope * x, 700.0)))
        off = float((n * rate * tokens).sum()) - target
        if abs(off) <= TOLERANCE * target:
            return rate
        low, high = (low, slope) if off > 0 else (slope, high)
        h = float((n * np.where(rate < cap, rate, 0.0) * x * tokens).sum())
        slope = slope - off / h if h > 0 else math.nan
        if not low < slope < high:
            slope = high - max(1.0, abs(high)) if math.isinf(low) else low + max(1.0, abs(low)) if math.isinf(high) else (low + high) / 2
    raise RuntimeError(f"the rates give {off:+.3g} tokens off {target:.6g} after {STEPS} steps")


def _round(sizes: pd.DataFrame) -> pd.DataFrame:
    """Of each size of one source how many documents are taken once more than the whole
    part (``base``) of their rate.  From the largest to the smallest, what the larger sizes gave
    too much or too little is made up for, so the smallest size bounds what is left."""
    sizes = sizes.sort_values("n_tokens", ascending=False)
    off, extra = 0.0, []
    for t, n, base, fraction in zip(sizes["n_tokens"], sizes["n"], sizes["base"], sizes["fraction"]):
        off += n * fraction * t
        m = min(int(n), max(0, round(off / t))) if fraction > 0 else 0
        off -= m * t
        extra.append(m)
    return sizes.assign(extra=extra)[["source", "n_tokens", "n", "rate", "base", "extra"]]


def mix(
    docs: DataFrame, doc_id: str, source: str, text: str, targets: DataFrame, vocabulary: str, total_tokens: int | None = None,
    bands_per_octave: int | None = None, part_rows: int = PART_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """How often to use each document so that sources reach their shares of the tokens.

    ``targets`` has source, target_share and max_repeats.  Each document begins with
    rate 1.  Entropy balancing finds the rates nearest to that (least relative entropy)
    under which each source gives its share of the tokens: an exponential in the
    document's tokens, cut at max_repeats, whose slope solves the convex dual of the
    source's token constraint (:func:`tilted`).  Sources whose share is less than what
    they hold so keep their short documents rather than their long ones; with
    ``bands_per_octave`` each band of sizes has a constraint of its own, the part it has
    in the source, which keeps the distribution of sizes.

    The dual's sums go over (source, tokens, documents), aggregated once before the
    shuffle and solved source by source on the executors, so a step costs no job.  Rates
    are then rounded to copies, from the largest documents of a source to the smallest,
    each size making up for what the ones before gave too much or too little; a hash of
    the id decides which documents of a size are taken.  So a source's tokens differ from
    its target by about half of its smallest document.

    The size of the mixture is the greatest at which every source can reach its share
    under its cap, or ``total_tokens`` if that is less.  Listed sources without any
    token, or with no share or no repeats, can't be reached; the other shares are
    scaled to make up the whole, and the report shows these with 0.

    Returns (copies, report).  copies: doc_id, source, n_tokens, rate, copies, one row
    per row of ``docs``; documents of sources not listed, without a source or without
    a token have 0 copies.  report: one row per listed source and per other source of
    the documents: source, target_share, max_repeats, n_docs, n_tokens (available),
    used_docs, copies, used_tokens, actual_share.

    Sizes: the driver holds a few numbers per listed source (at most ``MOST_SOURCES``);
    solving and rounding a source go over its distinct sizes, which the longest document
    bounds, not over documents.  Documents of one source and size are dealt out in as
    many parts as keep each below about ``part_rows``.  An empty corpus gives a report of
    zeros.  Repeated rows are documents of their own.
    """
    require(docs, doc_id, source, text)
    require(targets, "source", "target_share", "max_repeats")
    listed_rows = targets.limit(MOST_SOURCES + 1).collect()
    if len(listed_rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources are listed")
    listed = {r["source"]: (Decimal(str(r["target_share"] or 0)), int(r["max_repeats"] or 0)) for r in listed_rows if r["source"] is not None}
    named = docs.select(F.col(doc_id).alias("doc"), F.col(source).alias("source"), F.col(text).alias("text"))
    sized = cut_lineage(count_tokens(named, "text", ["doc", "source"], vocabulary))
    usable = F.coalesce(F.col("source").isin(list(listed)), F.lit(False)) & (F.col("n_tokens") > 0)
    sizes = cut_lineage(sized.filter(usable).groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n")))
    exact = F.sum(F.col("n").cast("decimal(38,0)") * F.col("n_tokens"))
    held = sizes.groupBy("source").agg(exact.alias("t"), F.max("n").alias("most")).collect()  # a row per listed source
    tokens = {r["source"]: int(r["t"]) for r in held}
    parts = max(1, math.ceil(max((r["most"] for r in held), default=1) / part_rows))
    total, shares = _budget(tokens, listed, total_tokens)
    goal = {s: (float(x * total), listed[s][1]) for s, x in shares.items()}

    def solve(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("n_tokens")
        target, cap = goal[f["source"].iloc[0]]
        t, n = f["n_tokens"].to_numpy(dtype=float), f["n"].to_numpy(dtype=float)
        band = np.zeros(len(t)) if bands_per_octave is None else np.floor(np.log2(t) * bands_per_octave)
        rate = np.empty(len(t))
        for b in np.unique(band):
            k = band == b
            rate[k] = tilted(t[k], n[k], target * float((n[k] * t[k]).sum() / (n * t).sum()), cap)
        base = np.floor(rate + 1e-12).astype("int64")
        return _round(f.assign(rate=rate, base=base, fraction=np.maximum(0.0, rate - base)))

    rounded = cut_lineage(
        sizes.filter(F.col("source").isin(sorted(shares))).groupBy("source").applyInPandas(solve, "source string, n_tokens long, n long, rate double, base long, extra long")
    )
    # the documents taken once more, shared out over the parts of a size
    part = F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int")
    dealt = sized.withColumn("part", part).withColumn("hash", F.xxhash64(F.lit("mix"), "doc"))
    cells = dealt.filter(usable).groupBy("source", "n_tokens", "part").agg(F.count(F.lit(1)).alias("c"))
    upto = F.coalesce(F.sum("c").over(W.partitionBy("source", "n_tokens").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    share_of = lambda c: F.expr(f"cast(cast(extra as decimal(20,0)) * cast({c} as decimal(18,0)) div n as long)")
    extra = (
        cells.join(broadcast_if_small(rounded), ["source", "n_tokens"])
        .withColumn("upto", upto)
        .withColumn("taken", share_of("upto + c") - share_of("upto"))
        .select("source", "n_tokens", "part", "rate", "base", F.col("taken").alias("extra"))
    )
    order = W.partitionBy("source", "n_tokens", "part").orderBy("hash", "doc")
    chosen = (
        dealt.join(extra, ["source", "n_tokens", "part"])
        .withColumn("nth", F.row_number().over(order))
        .select("doc", "source", "n_tokens", "rate", (F.col("base") + (F.col("nth") <= F.col("extra")).cast("int")).cast("int").alias("copies"))
    )
    rest = sized.filter(~(F.coalesce(F.col("source").isin(sorted(shares)), F.lit(False)) & (F.col("n_tokens") > 0))).select(
        "doc", "source", "n_tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("copies")
    )
    copies = cut_lineage(chosen.unionByName(rest))

    big = lambda c: F.sum(c.cast("decimal(38,0)")).cast("long")
    used = copies.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), big(F.col("n_tokens")).alias("n_tokens"),
        F.count_if(F.col("copies") > 0).alias("used_docs"), big(F.col("copies")).alias("copies"),
        big(F.col("copies") * F.col("n_tokens")).alias("used_tokens"),
    )
    want = targets.filter(F.col("source").isNotNull()).select("source", "target_share", "max_repeats").dropDuplicates(["source"])
    whole = used.agg(F.sum("used_tokens")).first()[0] or 0
    report = used.join(want, "source", "full_outer").select(
        "source", "target_share", "max_repeats",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_docs", "n_tokens", "used_docs", "copies", "used_tokens")],
        (F.coalesce(F.col("used_tokens"), F.lit(0)) / F.lit(max(1, whole))).alias("actual_share"),
    )
    return copies.withColumnRenamed("doc", doc_id), report
