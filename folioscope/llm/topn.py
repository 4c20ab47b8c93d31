"""Top N items within every group: bounded heaps built before the shuffle, merged after."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

try:  # a bounded queue per group as an aggregate; not part of the public interface
    from pyspark.sql.internal import InternalFunction

    collect_top_k = InternalFunction.collect_top_k
except (ImportError, AttributeError):
    collect_top_k = None

from ..operators.common import require

#: Rows that a task gathers before it cuts its heaps back to N per group.
BUFFER_ROWS = 200_000
#: Rows in a task's heaps above which they are handed on and begun anew.
STATE_ROWS = 600_000


def _cut(rows: pa.Table, groups: int, ties: int, n: int) -> pa.Table:
    """Of each group the n best distinct identifiers.  Columns: g0.., score, t0.., id."""
    code = np.zeros(len(rows), dtype=np.int64)
    for i in range(groups):
        column = rows.column(f"g{i}").combine_chunks()
        c = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        pair = code * (int(c.max(initial=0)) + 1) + c
        code = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    rows = rows.append_column("_c", pa.array(code))
    order = pc.sort_indices(
        rows.select(["_c", "score", *[f"t{i}" for i in range(ties)], "id"]),
        sort_keys=[("_c", "ascending"), ("score", "descending"), *[(f"t{i}", "ascending") for i in range(ties)], ("id", "ascending")],
        null_placement="at_end",
    )
    rows, code = rows.take(order), code[order.to_numpy()]
    ids = rows.column("id").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (code[1:] != code[:-1]) | (ids[1:] != ids[:-1])
    rows, code = rows.filter(pa.array(first)), code[first]
    start = np.ones(len(code), dtype=bool)
    start[1:] = code[1:] != code[:-1]
    at = np.arange(len(code))
    rank = at - np.maximum.accumulate(np.where(start, at, 0))
    return rows.filter(pa.array(rank < n)).drop_columns(["_c"])


def _partial_heaps(groups: int, ties: int, n: int, buffer_rows: int, state_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, kept = 0, 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            # cutting costs a pass over what is held, so that doubles in between
            if size >= max(buffer_rows, 2 * kept):
                state = _cut(pa.Table.from_batches(held), groups, ties, n)
                size = kept = state.num_rows
                held = state.to_batches()
                if kept > state_rows:
                    yield from held
                    held, size, kept = [], 0, 0
        if size:
            yield from _cut(pa.Table.from_batches(held), groups, ties, n).to_batches()

    return run


def top_n(
    df: DataFrame,
    group_by: Sequence[str],
    score: str,
    ties: Sequence[str],
    record_id: str,
    n: int,
    buffer_rows: int = BUFFER_ROWS,
    state_rows: int = STATE_ROWS,
    merge: str = "queue",
) -> DataFrame:
    """Per group the ``n`` records with the greatest ``score``; equal scores go to the
    smaller ``ties``, in order, then the smaller ``record_id``.

    Before the shuffle every task keeps at most n records per group (a buffer that is cut
    back to the best n whenever it has doubled, which costs what a heap costs), in which a record delivered again takes no second place, and hands it on whenever
    its heaps together exceed ``state_rows``; so of a group with any number of rows at
    most n leave a task at a time, and a task's memory is bounded however many groups
    it meets.  The shuffle moves those only.  After it copies of a record from several
    tasks are removed and the heaps are merged by an aggregate that again holds no
    more than n records per group.

    Output: ``group_by``, ``rank`` (1 is best), ``score``, ``ties``, ``record_id``.

    Defined cases: rows with a null score or a null record_id are left out; a null in
    a group column makes a group of its own; null ties come after all others; a group
    with fewer records gives fewer; an empty table gives no rows; other columns are
    ignored.  ``score`` is of a numeric type; a NaN is no score and is left out like null.

    The heaps are merged by a bounded queue where Spark offers one, else by a window whose
    ranks beyond n Spark drops before and after the shuffle; both give the same rows.
    """
    require(df, *group_by, score, *ties, record_id)
    if n < 1:
        raise ValueError("n must be positive")
    kind = df.schema[score].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        raise ValueError("the score must be of a numeric type")
    gs, ts = [f"g{i}" for i in range(len(group_by))], [f"t{i}" for i in range(len(ties))]
    usable = F.col(score).isNotNull() & F.col(record_id).isNotNull()
    if kind in ("float", "double"):
        usable = usable & ~F.isnan(score)
    rows = df.filter(usable).select(
        *[F.col(c).alias(g) for c, g in zip(group_by, gs)],
        F.col(score).alias("score"),
        *[F.col(c).alias(t) for c, t in zip(ties, ts)],
        F.col(record_id).alias("id"),
    )
    heaps = rows.mapInArrow(_partial_heaps(len(gs), len(ts), n, buffer_rows, state_rows), rows.schema)
    heaps = heaps.repartition(*gs).dropDuplicates([*gs, "id"])
    if collect_top_k and merge == "queue":
        # smaller is better: ~x = -x - 1 reverses integers without overflow
        whole = kind in ("byte", "short", "integer", "long")
        key = F.struct(
            (F.bitwise_not("score") if whole else -F.col("score")).alias("s"),
            *[x for t in ts for x in (F.col(t).isNull().alias(f"n_{t}"), F.col(t).alias(t))],
            F.col("id"), F.col("score").alias("score"),
        )
        merged = heaps.groupBy(*gs).agg(F.sort_array(collect_top_k(key, n, True)).alias("h"))
        ranked = merged.select(*gs, F.posexplode("h").alias("p", "x")).select(
            *gs, (F.col("p") + 1).alias("rank"), "x.score", *[F.col(f"x.{t}").alias(t) for t in ts], "x.id"
        )
    else:
        order = [F.col("score").desc(), *[F.col(t).asc_nulls_last() for t in ts], F.col("id").asc()]
        ranked = heaps.withColumn("rank", F.row_number().over(W.partitionBy(*gs).orderBy(*order))).filter(F.col("rank") <= n)
    return ranked.select(
        *[F.col(g).alias(c) for c, g in zip(group_by, gs)], "rank", F.col("score").alias(score),
        *[F.col(t).alias(c) for c, t in zip(ties, ts)], F.col("id").alias(record_id),
    )
