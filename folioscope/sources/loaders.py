"""Curated snapshots (YAML or JSON) as full replacements, archives, copies, several stores."""

from __future__ import annotations

import datetime as dt
import email.utils
import json
from collections.abc import Iterable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import normalize as N
from ..operators.digests import multiset_digest

TERM = "struct<type:string,start:date,end:date,state:string,district:string,party:string>"
VARIANT = "struct<name:string,since:date,until:date>"


def read_document(path: str):
    """A small curated file on the driver: YAML where a parser is there, else JSON."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text)
    return json.loads(text)


def day(v) -> dt.date | None:
    if v is None or isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v))


def required(entry: Mapping, *names: str) -> None:
    missing = [n for n in names if entry.get(n) in (None, "")]
    if missing:
        raise ValueError(f"missing {', '.join(missing)} in {entry}")


def legislators(spark: SparkSession, path: str) -> DataFrame:
    """Members with their dated terms and the names they may be filed under; the party and
    chamber of the latest term stand on the roster."""
    rows = []
    for m in read_document(path):
        who, name = (m.get("id") or {}).get("bioguide"), m.get("name") or {}
        if not who:
            raise ValueError(f"a member without an id: {name}")
        terms = [(t["type"], day(t.get("start")), day(t.get("end")), t.get("state"), None if t.get("district") is None else str(t["district"]), t.get("party")) for t in m.get("terms") or []]
        join = lambda *p: " ".join(x for x in p if x)
        first, middle, last = (name.get(k) for k in ("first", "middle", "last"))
        forms = {join(first, last), join(first, middle, last), join(name.get("nickname"), last) if name.get("nickname") else "", name.get("official_full") or ""} - {""}
        variants = [(f, None, None) for f in sorted(forms)]
        for o in m.get("other_names") or []:
            f, g, z = o.get("first") or first, o.get("middle"), o.get("last") or last
            variants += [(x, day(o.get("start")), day(o.get("end"))) for x in sorted({join(f, z), join(f, g, z)})]
        latest = max(terms, key=lambda t: t[1] or dt.date.min, default=None)
        rows.append((who, name.get("official_full") or join(first, last), {"rep": "house", "sen": "senate"}.get(latest[0]) if latest else None, latest and latest[5], latest and latest[3], latest and latest[4], terms, variants))
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("a member occurs twice")
    return spark.createDataFrame(rows, f"bioguide_id string, full_name string, chamber string, party string, state string, district string, terms array<{TERM}>, variants array<{VARIANT}>")


def aliases(spark: SparkSession, path: str) -> DataFrame:
    rows = []
    for i, a in enumerate(read_document(path)):
        required(a, "alias", "chamber", "bioguide_id", "valid_from")
        rows.append((i + 1, a["alias"], a["chamber"], a.get("state"), None if a.get("district") is None else str(a["district"]), day(a["valid_from"]), day(a.get("valid_to")), a["bioguide_id"], a.get("note")))
    return spark.createDataFrame(rows, "alias_id long, alias string, chamber string, state string, district string, valid_from date, valid_to date, bioguide_id string, note string")


def industry_codes(spark: SparkSession, path: str) -> DataFrame:
    """(cik, sic, disposition) from a JSON object of filer to code."""
    x = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "v"))
    row = x.select(N.cik(F.col("k")).alias("cik"), F.when(F.trim("v").rlike("^[0-9]{3,4}$"), F.trim("v").cast("int")).alias("sic"))
    return row.withColumn("disposition", F.when(F.col("cik").isNull() | F.col("sic").isNull(), "malformed").otherwise("accepted"))


def committees(spark: SparkSession, path: str) -> DataFrame:
    """Dated seats (committee_id, bioguide_id, valid_from, valid_to, disposition) from a
    snapshot: {snapshot_from, snapshot_to, committees: {id: [{bioguide, ...}]}}."""
    doc = read_document(path)
    a, z = day(doc["snapshot_from"]), day(doc.get("snapshot_to"))
    rows = [(c, m.get("bioguide"), a, z) for c, seats in (doc.get("committees") or {}).items() for m in seats]
    df = spark.createDataFrame(rows, "committee_id string, bioguide_id string, valid_from date, valid_to date").distinct()
    return df.withColumn("disposition", F.when(F.col("bioguide_id").isNull(), "skipped").otherwise("accepted"))


def jurisdictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame([(c, s) for c, ss in read_document(path).items() for s in ss], "committee_id string, sector string")


def taxonomy(entries: Sequence[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Inclusive ranges of codes; raises where two overlap or one is empty."""
    ordered = sorted(entries)
    for (a, z, n), after in zip(ordered, [*ordered[1:], (1 << 30, 1 << 30, "")]):
        if a > z or z >= after[0]:
            raise ValueError(f"range of {n} is empty or overlaps the next")
    return ordered


def authority(spark: SparkSession, path: str) -> DataFrame:
    """Reviewed ownership windows: a list of {security_id, class, identifiers: [{id_type,
    value, valid_from, valid_to}]}; every declared security has a class and identifiers."""
    rows = []
    for s in read_document(path):
        required(s, "security_id", "class", "identifiers")
        for i in s["identifiers"]:
            required(i, "id_type", "value")
            rows.append((i["id_type"], str(i["value"]), day(i.get("valid_from")), day(i.get("valid_to")), s["security_id"], s["class"]))
    return spark.createDataFrame(rows, "id_type string, value string, valid_from date, valid_to date, owner string, class string")


def attach(spark: SparkSession, stores: Mapping[str, str], names: Iterable[str]) -> None:
    """Tables of several directories as views ``store_table``, to be joined in one question."""
    for store, path in stores.items():
        for n in names:
            spark.read.parquet(f"{path}/{n}.parquet").createOrReplaceTempView(f"{store}_{n}")


def copy_snapshot(df: DataFrame, path: str, version: str) -> dict:
    """A whole table written under a version of its own, read back and compared as a multiset."""
    target = f"{path}/v={version}"
    df.write.mode("errorifexists").parquet(target)
    want, got = (tuple(multiset_digest(x, df.columns).first()) for x in (df, df.sparkSession.read.parquet(target).select(*df.columns)))
    if want != got:
        raise RuntimeError(f"the copy holds {got}, not {want}")
    return {"path": target, "rows": want[0], "digest": want[1]}


def verify_archive(spark: SparkSession, path: str, sidecar: DataFrame) -> DataFrame:
    """(name, outcome): archived files against the hashes noted beside them (name, sha256):
    verified, changed, missing or unrecorded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    have = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("found"))
    j = have.join(sidecar.select("name", F.col("sha256").alias("noted")), "name", "full_outer")
    return j.select("name", F.when(F.col("found").isNull(), "missing").when(F.col("noted").isNull(), "unrecorded").when(F.col("found") == F.col("noted"), "verified").otherwise("changed").alias("outcome"))


def latest_modified(headers: Iterable[str | None]) -> dt.datetime | None:
    """The latest of the Last-Modified headers that can be read."""
    out = []
    for h in headers:
        try:
            out.append(email.utils.parsedate_to_datetime(h))
        except (TypeError, ValueError):
            continue
    return max(out, default=None)


def quarters_to_load(available: Mapping[str, set[str]], loaded: Iterable[str], both_from: str) -> dict[str, list[str]]:
    """Quarters (``2024q1``) not loaded yet, and which formats each still lacks: from
    ``both_from`` on a quarter needs text and document, before that either."""
    out: dict[str, list[str]] = {"ready": [], "incomplete": []}
    for q in sorted(set(available) - set(loaded)):
        need = {"text", "pdf"} if q >= both_from else set()
        ok = need <= available[q] if need else bool(available[q])
        out["ready" if ok else "incomplete"].append(q)
    return out


def list_errors(dispositions: DataFrame, declared: int | None, least: float = 0.999) -> list[str]:
    """What is wrong with a parsed list: lines accepted below ``least``, or another number of
    lines than the document declares."""
    r = dispositions.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("disposition").isin("accepted", "accepted_option", "duplicate", "deleted")).alias("ok")).first()
    out = [] if r.n and r.ok / r.n >= least else [f"{r.ok} of {r.n} lines accepted"]
    return out + ([f"{r.n} lines, {declared} declared"] if declared is not None and declared != r.n else [])
