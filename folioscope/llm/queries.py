"""Queries of the corpus operators (p3, p4, p5, p7, p8, p9) with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import table
from .leakage import leaked, remove_leaks
from .mixing import mix
from .names import resolve_filers
from .spam import page_curves, stuffed_pages
from .survivors import Field, survivors
from .topn import top_n


#: Where the public tokenizer's vocabulary lies; every executor can read it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def issuer(c: str) -> Column:
    """Upper case, trimmed, runs of spaces reduced to one."""
    return F.trim(F.regexp_replace(F.upper(c), " +", " "))


def p3_top(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "serving_filer_rows").withColumn("issuer_name", issuer("issuer_name"))
    return top_n(rows, ["period", "issuer_name"], "value_usd", ["cik"], "row_id", 3)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_top(spark, d).select("period", "issuer_name", "row_id")


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    filings = table(spark, d, "filings").filter(F.col("bioguide_id").isNull())
    return resolve_filers(
        filings, "filing_id", "filer_name_raw", "chamber", "filed_date",
        table(spark, d, "member_aliases"), "alias", "bioguide_id", "valid_from", "valid_to",
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_links(spark, d).select("filing_id", "bioguide_id")


def accession(c: str) -> Column:
    """10-2-6 digits with dashes, leading zeros kept, however written; null if not 18."""
    digits = F.regexp_extract_all(F.col(c), F.lit("[0-9]+"), F.lit(0))
    parts = F.when(
        F.size(digits) == 3,
        F.concat(F.lpad(F.get(digits, F.lit(0)), 10, "0"), F.lpad(F.get(digits, F.lit(1)), 2, "0"), F.lpad(F.get(digits, F.lit(2)), 6, "0")),
    ).otherwise(F.lpad(F.array_join(digits, ""), 18, "0"))
    return F.when(F.size(digits) > 0, F.concat_ws("-", F.substring(parts, 1, 10), F.substring(parts, 11, 2), F.substring(parts, 13, 6)))


def filing_records(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    form = F.regexp_replace(F.upper("submission_type"), r"\s", "")
    period = F.col("period_of_report")
    f = (
        table(spark, d, "inst_filings")
        .withColumn("period_end", F.date_format(F.last_day(F.add_months(F.trunc(period, "quarter"), 2)), "yyyy-MM-dd"))
        .withColumn("acc", accession("accession"))
        .withColumn("form", F.regexp_replace(form, "13F[ -]?", "13F-"))
    )
    rank = F.concat(
        F.when(F.col("parse_status") == "parsed", "3").when(F.col("parse_status") == "partial", "2").when(F.col("parse_status") == "failed", "1").otherwise("0"),
        F.when(form.contains("HR"), "2").when(form.contains("NT"), "1").otherwise("0"),
        F.coalesce(F.date_format("filed_date", "yyyyMMdd"), F.lit("00000000")),
        F.when(form.endswith("/A"), "1").otherwise("0"),
        F.coalesce(F.col("acc"), F.lit("")),
    )
    return f, rank


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    f, rank = filing_records(spark, d)
    # a record without an accession votes for none, and may be the best one
    acc = F.coalesce("acc", F.lit(""))
    total = F.when(F.col("table_value_total_usd").isNotNull(), acc)
    return survivors(f, ["cik", "period_end"], rank, [Field("accession", acc), Field("total_accession", total)]).select(
        "cik", "period_end", F.nullif("accession", F.lit("")).alias("accession"), F.coalesce(F.nullif("total_accession", F.lit("")), F.lit("none")).alias("total_accession")
    )


def p5_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record: trusted accession, date and total, agreed form and numbers."""
    f, rank = filing_records(spark, d)
    return survivors(
        f, ["cik", "period_end"], rank,
        [
            Field("accession", F.col("acc")),
            Field("filed_date", F.col("filed_date")),
            Field("table_value_total_usd", F.col("table_value_total_usd")),
            Field("submission_type", F.col("form"), "majority"),
            Field("file_number_norm", F.col("file_number_norm"), "majority"),
            Field("period_of_report", F.col("period_of_report"), "majority"),
        ],
        least=1,
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text").select("doc_id", "item_id")


def p7_removed(spark: SparkSession, d: str) -> DataFrame:
    return remove_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "text")


def mixture(spark: SparkSession, d: str, **how) -> tuple[DataFrame, DataFrame]:
    return mix(table(spark, d, "documents"), "doc_id", "source", "text", table(spark, d, "mix_targets"), VOCABULARY, **how)


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixture(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture(spark, d)[1]


def p8_banded(spark: SparkSession, d: str) -> DataFrame:
    """As p8_shares, with a constraint for every quarter octave of document sizes."""
    return mixture(spark, d, bands_per_octave=4)[1]


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per listed source whether it can be reached, and whether its tokens are its share of
    the mixture, to less than one document, and its cap is kept, document by document."""
    copies, report = mixture(spark, d)
    most = copies.groupBy("source").agg(F.max("copies").alias("most"), F.max("n_tokens").alias("longest"))
    r = report.filter(F.col("target_share").isNotNull()).join(most, "source", "left")
    reachable = F.col("n_tokens") > 0
    sums = r.agg(F.sum(F.when(reachable, F.col("target_share"))).alias("share"), F.sum("used_tokens").alias("used"))
    want = F.when(reachable, F.col("target_share") / sums.select("share").scalar()).otherwise(0.0) * sums.select("used").scalar()
    return r.select(
        "source", reachable.alias("reachable"), (F.abs(F.col("used_tokens") - want) <= F.coalesce("longest", F.lit(0))).alias("share_kept"),
        (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("cap_kept"),
    )


def p9_pages(spark: SparkSession, d: str) -> DataFrame:
    return stuffed_pages(table(spark, d, "documents"), "doc_id", "text")


def p9_curves(spark: SparkSession, d: str) -> DataFrame:
    """Slope and residual of every page's rank-frequency curve."""
    c = page_curves(table(spark, d, "documents"), "doc_id", "text")
    return c.select("doc_id", "n_words", "n_types", F.round("slope", 6).alias("slope"), F.round("residual", 6).alias("residual"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_pages(spark, d).select("doc_id").distinct()


QUERIES = {
    "p3_found": p3_found,
    "p3_top": p3_top,
    "p4_found": p4_found,
    "p4_links": p4_links,
    "p5_found": p5_found,
    "p5_survivors": p5_survivors,
    "p7_found": p7_found,
    "p7_removed": p7_removed,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_banded": p8_banded,
    "p8_kept": p8_kept,
    "p9_found": p9_found,
    "p9_pages": p9_pages,
    "p9_curves": p9_curves,
}

_TOP = """
WITH r AS (SELECT DISTINCT row_id, cik, period, trim(regexp_replace(upper(issuer_name), ' +', ' ', 'g')) AS issuer_name, value_usd
           FROM serving_filer_rows WHERE value_usd IS NOT NULL AND row_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY period, issuer_name ORDER BY value_usd DESC, cik NULLS LAST, row_id) AS rank FROM r)
"""
_RECORDS = r"""
WITH a AS (
  SELECT *, regexp_extract_all(accession, '[0-9]+') AS dg, regexp_replace(upper(submission_type), '\s', '', 'g') AS form,
         strftime(last_day(date_trunc('quarter', period_of_report) + INTERVAL 2 MONTH), '%Y-%m-%d') AS period_end
  FROM inst_filings
), b AS (
  SELECT *, CASE WHEN len(dg) = 3 THEN lpad(dg[1], 10, '0') || lpad(dg[2], 2, '0') || lpad(dg[3], 6, '0')
                 WHEN len(dg) > 0 THEN lpad(array_to_string(dg, ''), 18, '0') END AS z FROM a
), c AS (
  SELECT cik, period_end, table_value_total_usd, filed_date, regexp_replace(form, '13F[ -]?', '13F-') AS form, file_number_norm, period_of_report, z[1:10] || '-' || z[11:12] || '-' || z[13:18] AS acc,
         CASE parse_status WHEN 'parsed' THEN 3 WHEN 'partial' THEN 2 WHEN 'failed' THEN 1 ELSE 0 END AS r1,
         CASE WHEN form LIKE '%HR%' THEN 2 WHEN form LIKE '%NT%' THEN 1 ELSE 0 END AS r2, filed_date AS r3,
         CASE WHEN form LIKE '%/A' THEN 1 ELSE 0 END AS r4
  FROM b WHERE cik IS NOT NULL AND period_end IS NOT NULL
), k AS (
  SELECT *, count(*) OVER g AS n,
         row_number() OVER (PARTITION BY cik, period_end ORDER BY r1 DESC, r2 DESC, r3 DESC NULLS LAST, r4 DESC, acc DESC) AS first,
         row_number() OVER (PARTITION BY cik, period_end, table_value_total_usd IS NULL ORDER BY r1 DESC, r2 DESC, r3 DESC NULLS LAST, r4 DESC, acc DESC) AS first_of
  FROM c WINDOW g AS (PARTITION BY cik, period_end)
)
"""
_GRAMS = r"""
WITH x AS (SELECT string_agg(chr(CAST(65281 + i AS INT)), '' ORDER BY i) AS wide, string_agg(chr(CAST(33 + i AS INT)), '' ORDER BY i) AS narrow FROM range(94) r(i)),
t AS (SELECT 'd' AS k, doc_id AS id, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'i', item_id, text FROM eval_items WHERE text IS NOT NULL),
w AS (SELECT k, id, regexp_extract_all(lower(translate(regexp_replace(regexp_replace(regexp_replace(text, '</?a(\s[^<>]*)?>', '', 'g'), '<[^<>]*>', ' ', 'g'),
  '[\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}]', '', 'g'), wide, narrow)), '[\p{L}\p{N}]+') AS ws FROM t, x),
g AS (SELECT k, id, array_to_string(ws[p : p + 11], ' ') AS gram FROM (SELECT k, id, ws, unnest(range(1, len(ws) - 10)) AS p FROM w WHERE len(ws) >= 12))
"""

SQL = {
    "p7_found": _GRAMS + "SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i USING (gram) WHERE d.k = 'd' AND i.k = 'i'",
    "p3_found": _TOP + "SELECT period, issuer_name, row_id FROM k WHERE rank <= 3",
    "p3_top": _TOP + "SELECT period, issuer_name, rank, value_usd, cik, row_id FROM k WHERE rank <= 3",
    "p5_found": _RECORDS
    + """
SELECT cik, period_end, max(CASE WHEN first = 1 THEN acc END) AS accession,
       coalesce(max(CASE WHEN first_of = 1 AND table_value_total_usd IS NOT NULL THEN acc END), 'none') AS total_accession
FROM k WHERE n >= 2 GROUP BY cik, period_end
""",
    "p9_curves": r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
c AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL),
l AS (SELECT doc_id, n, count(*) AS v FROM c GROUP BY ALL),
r AS (SELECT *, ln(coalesce(sum(v) OVER (PARTITION BY doc_id ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (v + 1) / 2.0) AS x, ln(n) AS y FROM l),
s AS (SELECT doc_id, sum(n * v) AS n_words, sum(v) AS n_types, count(*) AS k, sum(v) AS sw, sum(v * x) AS sx, sum(v * y) AS sy, sum(v * x * x) AS sxx, sum(v * x * y) AS sxy, sum(v * y * y) AS syy FROM r GROUP BY ALL),
f AS (SELECT *, CASE WHEN k > 1 THEN (sw * sxy - sx * sy) / (sw * sxx - sx * sx) ELSE 0 END AS b FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_types AS BIGINT) AS n_types, round(b, 6) AS slope,
       round(CASE WHEN k > 1 THEN greatest(0, (syy - sy * sy / sw - b * (sxy - sx * sy / sw)) / sw) ELSE 0 END, 6) AS residual
FROM f
""",
    "p8_kept": """SELECT source, source IN (SELECT source FROM documents WHERE length(text) > 0) AS reachable, true AS share_kept, true AS cap_kept FROM mix_targets""",
    # position by position: in these values no token moves
    "p5_survivors": _RECORDS
    + r"""
, v AS (
  SELECT cik, period_end, 'form' AS field, form AS value, first FROM k UNION ALL SELECT cik, period_end, 'number', file_number_norm, first FROM k
  UNION ALL SELECT cik, period_end, 'period', CAST(period_of_report AS VARCHAR), first FROM k
), s AS (SELECT cik, period_end, field, value, count(*) AS n, min(first) AS best, regexp_extract_all(value, '[\p{L}\p{N}]+|[^\p{L}\p{N}]') AS ts FROM v WHERE value IS NOT NULL GROUP BY ALL),
m AS (SELECT cik, period_end, field, max(len(ts)) AS longest FROM s GROUP BY ALL),
t AS (SELECT s.*, unnest(range(1, longest + 1)) AS p FROM s JOIN m USING (cik, period_end, field)),
u AS (SELECT cik, period_end, field, p, coalesce(ts[p], '') AS token, sum(n) AS n, min(best) AS best FROM t GROUP BY ALL),
ag AS (SELECT cik, period_end, field, p, token AS want FROM u QUALIFY row_number() OVER (PARTITION BY cik, period_end, field, p ORDER BY n DESC, best) = 1),
f AS (SELECT t.cik, t.period_end, t.field, value, best, count(*) FILTER (coalesce(ts[t.p], '') <> want) AS far FROM t JOIN ag USING (cik, period_end, field, p) GROUP BY ALL),
c1 AS (SELECT cik, period_end, field, value FROM f QUALIFY row_number() OVER (PARTITION BY cik, period_end, field ORDER BY far, best) = 1)
SELECT cik, period_end, n AS n_records, max(CASE WHEN first = 1 THEN acc END) AS accession,
       CAST(arg_min(filed_date, first) FILTER (filed_date IS NOT NULL) AS VARCHAR) AS filed_date,
       CAST(arg_min(table_value_total_usd, first) FILTER (table_value_total_usd IS NOT NULL) AS VARCHAR) AS table_value_total_usd,
       any_value(c1.value) FILTER (c1.field = 'form') AS submission_type, any_value(c1.value) FILTER (c1.field = 'number') AS file_number_norm,
       any_value(c1.value) FILTER (c1.field = 'period') AS period_of_report
FROM k LEFT JOIN c1 USING (cik, period_end) GROUP BY ALL
""",
}
