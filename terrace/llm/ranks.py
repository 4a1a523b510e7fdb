"""Position of every row inside its group, whatever the size of the group.

Rows are range partitioned by group and order, so a group that holds a third of all rows
is spread over many tasks. Every task numbers the runs of equal groups of its own sorted
rows; only the first run of a partition can continue a group of earlier partitions, so at
most one offset a partition has to be added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from terrace.session import fresh_dir

KEY, PART, AT, FIRST, LAST = "_rank_key", "_rank_part", "_rank_at", "_rank_first", "_rank_last"


def _numbered(batches):
    """Adds the partition, the number inside the run of equal keys, and marks of the first and the last row."""
    part, seen, before, held = TaskContext.get().partitionId(), None, 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(batch.schema.get_field_index(KEY))
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        continued = seen is not None and keys[0].as_py() == seen
        starts = np.flatnonzero(new)
        at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        if continued:
            at[: starts[1] if len(starts) > 1 else n] += before
        first = np.zeros(n, bool)
        first[0] = seen is None
        seen, before = keys[n - 1].as_py(), int(at[-1]) + 1
        if held is not None:
            yield _with(held, part, False)
        held = (batch, at, first)
    if held is not None:
        yield _with(held, part, True)


def _with(held, part: int, ends: bool) -> pa.RecordBatch:
    batch, at, first = held
    last = np.zeros(len(at), bool)
    last[-1] = ends
    more = [pa.array(np.full(len(at), part, np.int32)), pa.array(at.astype(np.int64)), pa.array(first), pa.array(last)]
    return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, PART, AT, FIRST, LAST])


def ranked(spark: SparkSession, rows: DataFrame, group: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """``rows`` with ``name`` (long, from 0): how many rows of its ``group`` stand before it in ``order`` (nulls first).

    Rows equal in group and order are numbered in any order. An empty table stays empty.
    The numbered rows are written to the shared folder, so the numbers never change.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    # rows that are equal in all of that still spread over the ranges
    spread = rows.withColumn("_rank_tie", F.monotonically_increasing_id())
    keys.append(F.col("_rank_tie").asc())
    ordered = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_rank_tie").withColumn(KEY, F.to_json(F.struct(*group)))
    added = [StructField(PART, IntegerType()), StructField(AT, LongType()), StructField(FIRST, BooleanType()), StructField(LAST, BooleanType())]
    fields = StructType([*ordered.schema.fields, *added])
    path = fresh_dir(spark, "ranked")
    ordered.mapInArrow(_numbered, fields).write.parquet(path)
    done = spark.read.parquet(path)
    edge = done.filter(F.col(FIRST) | F.col(LAST)).select(KEY, PART, AT, FIRST, LAST)
    # two rows a partition at most: the group it begins with, and the length of the run it ends with
    begins = edge.filter(FIRST).select(KEY, PART, F.lit(0).alias("ends"), F.lit(0).cast("long").alias("n"))
    ends = edge.filter(LAST).select(KEY, PART, F.lit(1).alias("ends"), (F.col(AT) + 1).alias("n"))
    earlier = Window.partitionBy(KEY).orderBy(PART, "ends").rowsBetween(Window.unboundedPreceding, -1)
    offsets = begins.unionByName(ends).withColumn("before", F.sum("n").over(earlier)).filter("ends = 0 and before > 0")
    offsets = offsets.select(KEY, PART, "before")
    out = done.join(F.broadcast(offsets), [KEY, PART], "left").withColumn(name, F.col(AT) + F.coalesce("before", F.lit(0)))
    return out.drop(KEY, PART, AT, FIRST, LAST, "before")
