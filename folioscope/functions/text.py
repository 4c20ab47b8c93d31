"""Text functions Spark has no built-in for: Unicode NFC, canonical JSON, path-safe keys."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

SAFE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._-")
MOST_KEY = 120


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """NFC; ASCII text is passed by in the JVM."""
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(_nfc(c))


def canonical_object(values: dict[str, str | None]) -> str:
    """A flat object of strings and nulls as canonical JSON: keys by their UTF-16 code
    units, no spaces, only what must be escaped is."""
    keys = sorted(values, key=lambda k: k.encode("utf-16-be"))
    return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{json.dumps(values[k], ensure_ascii=False)}" for k in keys) + "}"


@F.pandas_udf(T.StringType())
def canonical_json(df: pd.DataFrame) -> pd.Series:
    """Of a struct of strings."""
    return pd.Series([canonical_object({k: None if v is None or v != v else str(v) for k, v in r.items()}) for r in df.to_dict("records")], dtype=object)


def path_key(text: str) -> str:
    """Every sign but letters, digits, dot, dash and underscore as ~XX bytes; a key too long
    ends in a digest of the whole."""
    out = "".join(c if c in SAFE else "".join(f"~{b:02X}" for b in c.encode()) for c in text)
    return out if len(out) <= MOST_KEY else out[: MOST_KEY - 17] + "~" + hashlib.sha256(text.encode()).hexdigest()[:16]


@F.pandas_udf(T.StringType())
def path_safe(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else path_key(x))


def entity_key(c: Column) -> Column:
    """struct<kind, id> of m:, t: and f: keys; null for anything else."""
    kind = F.regexp_extract(c, "^([mtf]):(.+)$", 1)
    return F.when(kind != "", F.struct(kind.alias("kind"), F.regexp_extract(c, "^([mtf]):(.+)$", 2).alias("id")))


def cut_percent(part: Column, whole: Column) -> Column:
    """Percent with one decimal, cut and not rounded, at most 99.9 unless equal."""
    return F.when(whole <= 0, F.lit(None).cast("double")).when(part == whole, 100.0).otherwise(F.least(F.floor(part * 1000 / whole) / 10, F.lit(99.9)))
