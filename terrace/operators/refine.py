"""Spec-driven refinement: typed, cleaned columns in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from terrace.functions.columns import clean_nul, comma_decimal, lenient_date
from terrace.plans.specs import TableSpec


def map_columns(df: DataFrame, data_type: type[DataType], fn) -> DataFrame:
    """Apply ``fn`` to every column of one type in a single ``select`` (no withColumn loop)."""
    return df.select(
        *[
            fn(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, data_type) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def clean_strings(df: DataFrame) -> DataFrame:
    """NUL -> space on every string column."""
    return map_columns(df, StringType, clean_nul)


def refine(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Scanned table -> refined table (column order kept, no reference date yet).

    Order of steps matters: dates and decimals are converted first, and only
    the columns still typed string are NUL-cleaned afterwards, so a NUL inside
    a date gives null rather than a repaired date.
    """
    exprs: list[Column] = []
    for name in spec.columns:
        c = F.col(name)
        if name in spec.date_columns:
            c = lenient_date(c, spec.date_format)
        elif name in spec.decimal_columns:
            c = comma_decimal(c)
        exprs.append(c.alias(name))
    out = df.select(*exprs)
    return clean_strings(out) if spec.clean_nul else out
