"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, functions as F

#: A side is broadcast only when a count has shown that it has no more rows and bytes.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether there are at most so many rows and bytes (of the rows as JSON); reading
    stops at one row more."""
    size = F.octet_length(F.to_json(F.struct("*")))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("b")).first()
    return r.n <= max_rows and r.b <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hints a broadcast when the measured size allows it, else leaves the join to
    Spark (sort-merge with AQE skew splitting)."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder the cluster names in
    ``spark.checkpoint.dir``.  Where that is unset a temporary folder serves a session
    on one machine; on a cluster, whose executors could not read it, this raises."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="folioscope-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores where a scan gives fewer tasks than there are cores
    (few or small files); a scan with enough tasks is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
