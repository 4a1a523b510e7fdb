"""Row and null counts of a Parquet snapshot from its file footers.

Every Parquet file says how many rows and nulls each of its row groups has. Spark's second
Parquet reader takes ``count`` aggregates down to the scan, which then opens footers only.
That reader and its push-down are session settings, so a session of their own is used (same
context, same executors) and the caller's settings stay as they are.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# No first-generation reader for Parquet; aggregates taken from the footers.
SETTING = "spark.sql.parquet.aggregatePushdown"
SETTINGS = {"spark.sql.sources.useV1SourceList": "", SETTING: "true"}


def _counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    found = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"some_{i}") for i, c in enumerate(columns)])
    nulls = [(F.col("n_rows") - F.col(f"some_{i}")).alias(f"n_null_{c}") for i, c in enumerate(columns)]
    return found.select("n_rows", *nulls)


def footer_counts(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """``n_rows`` and ``n_null_<column>`` of the Parquet files under ``path``, from their footers (see ``snapshot_counts``)."""
    own = spark.newSession()
    for k, v in SETTINGS.items():
        own.conf.set(k, v)
    return _counts(own.read.parquet(path), columns or [])


def snapshot_counts(spark: SparkSession, path: str, columns: list[str] | None = None) -> dict[str, int]:
    """The counts as numbers; files without statistics of a column are counted by a plain scan of the columns."""
    try:
        found = footer_counts(spark, path, columns).first()
    except (PySparkException, Py4JJavaError) as e:
        # a footer without the null count of a column ends the job and names the setting
        if SETTING not in str(e):
            raise
        found = _counts(spark.read.parquet(path), columns or []).first()
    return found.asDict()
