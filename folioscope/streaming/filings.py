"""Newly ingested filings as a stream, with the same rows as the batch question."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.common import cut_lineage
from ..sources.sinks import merge


def stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _timed(filings: DataFrame, late: str | None) -> DataFrame:
    at = filings.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    return at.withWatermark("ingested_at", late) if late else at


def latest_filings(filings: DataFrame, late: str | None = None) -> DataFrame:
    """Active filings once each, by filing_id, in whatever order they are delivered; the
    state holds every id seen.  With ``late``, for a stream in the order of ingested_at,
    it holds only those within that time, and what comes later is dropped."""
    at = _timed(filings.filter(F.col("lifecycle") == "active"), late)
    return at.dropDuplicatesWithinWatermark(["filing_id"]) if late else at.dropDuplicates(["filing_id"])


def daily_counts(filings: DataFrame, late: str | None = None) -> DataFrame:
    """Filings a day of ingestion and chamber, for output modes update and complete.  With
    ``late``, also for append: a day is final once the watermark passes it, and what comes
    for it later is dropped."""
    return _timed(filings, late).groupBy(F.window("ingested_at", "1 day").alias("w"), "chamber").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), "chamber", "n")


#: Parts of an upserted table; a batch rewrites those its keys fall into.
BUCKETS = 64


def upserted(spark: SparkSession, path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The table that :func:`upsert_into` keeps: of every bucket its newest version (older
    than ``before``, if given)."""
    df = spark.read.option("basePath", path).parquet(path)
    df = df if before is None else df.filter(F.col("upsert_version") < before)
    df = df if buckets is None else df.filter(F.col("upsert_bucket").isin(buckets))
    newest = df.groupBy("upsert_bucket").agg(F.max("upsert_version").alias("upsert_version"))  # as many rows as buckets
    return df.join(F.broadcast(newest), ["upsert_bucket", "upsert_version"]).drop("upsert_version", "upsert_bucket")


def upsert_into(path: str, key: list[str], buckets: int = BUCKETS):
    """For foreachBatch: merges each batch by key.  Keys are dealt to buckets by a hash; only
    the buckets that a batch touches are read and written anew, under the batch's number,
    so a batch run again writes the same files."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
        new = cut_lineage(batch.dropDuplicates(key))
        touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return
        try:
            old = upserted(spark, path, batch_id, touched).select(*batch.columns)
        except AnalysisException:  # nothing is there yet
            old = new.limit(0)
        merged = merge(old, new, key).withColumn("upsert_bucket", bucket)
        merged.repartition("upsert_bucket").write.mode("overwrite").partitionBy("upsert_bucket").parquet(f"{path}/upsert_version={batch_id}")

    return run
