"""Data-quality gates as data: one aggregation pass -> a report -> enforce.

Each gate of the reference (table not empty, required key not null, selection
not empty, archive has a non-empty member) is a row of a report DataFrame
``(table_name, check_name, column_name, n_rows, n_violations, passed)``.
All counts of one table come from a single global aggregate (map-side
partial counts, one tiny exchange), instead of one job per check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "n_rows", "n_violations", "passed"]


class QualityError(RuntimeError):
    """A gate failed; nothing was published."""


def gate_metrics(required: str | None) -> list:
    """Aggregate expressions the gates need; usable in ``agg`` or an ``Observation``."""
    exprs = [F.count(F.lit(1)).alias("n_rows")]
    if required:
        exprs.append(F.count_if(F.col(required).isNull()).alias("n_null_key"))
    return exprs


def report_from_metrics(table: str, required: str | None, metrics: dict) -> list[dict]:
    """Turn the gate metrics into report rows (driver-side, a handful of numbers)."""
    n = int(metrics["n_rows"])
    rows = [
        dict(table_name=table, check_name="not_empty", column_name=None, n_rows=n,
             n_violations=0 if n > 0 else 1, passed=n > 0)
    ]
    if required:
        v = int(metrics["n_null_key"])
        rows.append(
            dict(table_name=table, check_name="required_not_null", column_name=required, n_rows=n,
                 n_violations=v, passed=v == 0)
        )
    return rows


def quality_report(df: DataFrame, table: str, required: str | list[str] | None) -> DataFrame:
    """Report DataFrame for one table in a single pass over ``df``.

    ``required`` may name several columns; all are counted in the same aggregate.
    """
    cols = [required] if isinstance(required, str) else list(required or [])
    agg = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_null_{i}") for i, c in enumerate(cols)],
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit("not_empty").alias("check_name"),
            F.lit(None).cast("string").alias("column_name"),
            F.col("n_rows"),
            F.when(F.col("n_rows") > 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("n_violations"),
            (F.col("n_rows") > 0).alias("passed"),
        )
    ]
    for i, c in enumerate(cols):
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit("required_not_null").alias("check_name"),
                F.lit(c).alias("column_name"),
                F.col("n_rows"),
                F.col(f"n_null_{i}").cast("bigint").alias("n_violations"),
                (F.col(f"n_null_{i}") == 0).alias("passed"),
            )
        )
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enforce(report_rows: list[dict] | DataFrame) -> None:
    """Raise ``QualityError`` listing every failed check (the report is a few rows)."""
    rows = report_rows.collect() if isinstance(report_rows, DataFrame) else report_rows
    failed = [r for r in rows if not (r["passed"])]
    if failed:
        msg = "; ".join(
            f"{r['table_name']}: {r['check_name']}"
            + (f"({r['column_name']})" if r["column_name"] else "")
            + f" failed, {r['n_violations']} of {r['n_rows']} rows"
            for r in failed
        )
        raise QualityError(msg)


def observe_gates(df: DataFrame, table: str, required: str | None) -> tuple[DataFrame, Observation]:
    """Attach the gate metrics to ``df`` so they are computed during its write."""
    obs = Observation(f"gates_{table}")
    return df.observe(obs, *gate_metrics(required)), obs


def gate_not_empty(df: DataFrame, table: str) -> None:
    """Cheap form for callers without a write: stops at the first row."""
    if df.isEmpty():
        raise QualityError(f"{table}: not_empty failed, no rows")


def reference_date_report(df: DataFrame, table: str, expected: str, date_col: str = "reference_date") -> DataFrame:
    """Rows per snapshot date found in ``df`` and whether that date is the expected one.

    The date stamped on a mart is trusted, not derived from its inputs; this is
    a warning check that the inputs carry the same date (one-column aggregate).
    """
    return df.groupBy(date_col).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table_name"),
        F.col(date_col).alias("reference_date"),
        "n_rows",
        F.coalesce(F.col(date_col) == F.lit(expected), F.lit(False)).alias("matches"),
    )
