"""Exact distinct counts as a state that can be kept, merged and partly replaced.

Company numbers are dense (eight digits), so the set of companies of a group is kept by
buckets of 32,768 numbers. A bucket with ``DENSE`` numbers or more is one row with a bitmap
(4 KB, whatever it holds), built and joined by Spark's bitmap aggregates; the numbers of
a sparser bucket stand in a row each, as do values that are no such number (``1`` is not
``00000001``), so a state is never larger than the distinct values it stands for, and the
count is exact for any text. A state is a table: the states of two files or dates,
overlapping or not, merge, and a part that has changed is replaced without reading the
rows of the others again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Fixed value: what a dense number looks like.
NUMBER = "^[0-9]{8}$"
BUCKET_NUMBERS = 32_768
#: Numbers of a bucket from which its bitmap is smaller than a row each.
DENSE = 256
#: A row is a bitmap (bucket, bits), a number of a sparse bucket (bucket, other) or any other text (other).
STATE = ("state_bucket", "state_bits", "state_other")
PART = "state_part"
_GROUP = "state_group"


def _number(value: Column) -> Column:
    """The number of a value, from 1 on (bitmaps count from there); null for any other text."""
    return F.when(value.rlike(NUMBER), value.cast("bigint") + 1)


def _text(bucket: Column, place: Column) -> Column:
    return F.lpad(((bucket - 1) * BUCKET_NUMBERS + place).cast("string"), 8, "0")


def _packed(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """State of ``keys``, bucket and the set of its places (``places``): bitmaps of the full ones, a row a number else.

    Bitmaps are built where the places stand already: no exchange beyond the one that brought them together.
    """
    full = F.size("places") >= DENSE
    dense = buckets.filter(full).select(*keys, STATE[0], F.explode("places").alias("place"))
    dense = dense.groupBy(*keys, STATE[0]).agg(F.bitmap_construct_agg("place").alias(STATE[1]))
    sparse = buckets.filter(~full).select(*keys, STATE[0], F.explode("places").alias("place"))
    return dense.select(*keys, STATE[0], STATE[1], F.lit(None).cast("string").alias(STATE[2])).unionByName(
        sparse.select(*keys, STATE[0], F.lit(None).cast("binary").alias(STATE[1]), _text(F.col(STATE[0]), F.col("place")).alias(STATE[2]))
    )


def distinct_state(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """State of the distinct non-null values of ``column`` by ``keys`` (null keys are groups of their own).

    Every task sends the different values it has of a group and bucket; a bucket's set is bounded.
    """
    value = F.col(column).cast("string")
    marked = rows.filter(value.isNotNull()).select(*keys, _number(value).alias("number"), value.alias("value"))
    numbers = marked.filter("number is not null").select(
        *keys, F.bitmap_bucket_number("number").alias(STATE[0]), F.bitmap_bit_position("number").cast("int").alias("place")
    )
    buckets = numbers.groupBy(*keys, STATE[0]).agg(F.collect_set("place").alias("places"))
    others = marked.filter("number is null").select(*keys, "value").distinct()
    others = others.select(*keys, F.lit(None).cast("bigint").alias(STATE[0]), F.lit(None).cast("binary").alias(STATE[1]), F.col("value").alias(STATE[2]))
    return _packed(buckets, keys).unionByName(others)


def merge_states(states: list[DataFrame], keys: list[str]) -> DataFrame:
    """One state of several; values that stand in more than one count once.

    Numbers whose bucket is a bitmap in any of the states go into that bitmap.
    """
    both = reduce(DataFrame.unionByName, [s.select(*keys, *STATE) for s in states]).withColumn(_GROUP, F.to_json(F.struct(*keys)))
    maps = both.filter(F.col(STATE[1]).isNotNull())
    values = both.filter(F.col(STATE[2]).isNotNull()).select(*keys, _GROUP, STATE[0], STATE[2]).distinct()
    mapped = maps.select(_GROUP, STATE[0]).distinct()
    inside = values.join(mapped, [_GROUP, STATE[0]], "left_semi")
    place = F.bitmap_bit_position(_number(F.col(STATE[2])))
    added = inside.groupBy(*keys, STATE[0]).agg(F.bitmap_construct_agg(place).alias(STATE[1]))
    joined = maps.select(*keys, STATE[0], STATE[1]).unionByName(added).groupBy(*keys, STATE[0]).agg(F.bitmap_or_agg(STATE[1]).alias(STATE[1]))
    alone = values.join(mapped, [_GROUP, STATE[0]], "left_anti")
    # a bucket that has filled up by merging becomes a bitmap
    numbers = alone.filter(F.col(STATE[0]).isNotNull()).withColumn("place", F.bitmap_bit_position(_number(F.col(STATE[2]))).cast("int"))
    buckets = numbers.groupBy(*keys, STATE[0]).agg(F.collect_set("place").alias("places"))
    texts = alone.filter(F.col(STATE[0]).isNull()).withColumn(STATE[1], F.lit(None).cast("binary")).select(*keys, *STATE)
    joined = joined.withColumn(STATE[2], F.lit(None).cast("string")).select(*keys, *STATE)
    return joined.unionByName(_packed(buckets, keys)).unionByName(texts)


def distinct_counts(state: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``keys`` and the number of distinct values as ``name``."""
    one = F.when(F.col(STATE[2]).isNotNull(), F.lit(1).cast("bigint")).otherwise(F.bitmap_count(STATE[1]))
    return state.groupBy(*keys).agg(F.sum(one).alias(name))


class StateStore:
    """States of the parts of a table (files, dates) under one folder; a part is replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], column: str):
        self.spark, self.root, self.keys, self.column = spark, root.rstrip("/"), keys, column

    def put(self, part: str, rows: DataFrame) -> None:
        """Count ``rows`` as the part's; an earlier state of it is gone, those of other parts stay."""
        state = distinct_state(rows, self.keys, self.column).withColumn(PART, F.lit(part))
        state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.root)

    def state(self, parts: list[str] | None = None) -> DataFrame:
        """The merged state of all parts, or of some (other parts' folders are not read)."""
        kept = self.spark.read.parquet(self.root).drop(PART).schema
        # named as text: the folder 01 is not the number 1
        found = self.spark.read.schema(StructType([*kept.fields, StructField(PART, StringType())])).parquet(self.root)
        if parts is not None:
            found = found.filter(F.col(PART).isin(parts))
        return merge_states([found], self.keys)

    def counts(self, name: str, parts: list[str] | None = None) -> DataFrame:
        return distinct_counts(self.state(parts), self.keys, name)
