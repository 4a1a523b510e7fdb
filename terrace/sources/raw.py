"""Delimited raw-text scans: files on a shared path, or lines already in a DataFrame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.plans.schemas import ddl

# The raw format of the registry dump. No header, Latin-1,
# ';' delimiter, '"' quote and *no* escape character (so a trailing backslash
# inside quotes is data, and a quoted empty last field reads as a single '"').
RAW_ENCODING = "ISO-8859-1"
RAW_DELIMITER = ";"
RAW_QUOTE = '"'
RAW_ESCAPE = ""


def csv_options(escape: str = RAW_ESCAPE) -> dict[str, str]:
    """Parser options shared by the file scan and ``from_csv``.

    ``escape=""`` is the parity default; ``escape='"'`` reads doubled quotes
    the RFC 4180 way and is offered only as an explicit choice.
    """
    return {"sep": RAW_DELIMITER, "quote": RAW_QUOTE, "escape": escape}


def scan_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    encoding: str = RAW_ENCODING,
    escape: str = RAW_ESCAPE,
) -> DataFrame:
    """Positional, typed scan of headerless delimited files (PERMISSIVE mode).

    Short rows are null-padded, extra fields dropped, unparseable int fields
    become null, blank lines are skipped, and files starting with ``_`` or
    ``.`` are ignored. Uncompressed files are split by byte range, so one big
    file is read by many tasks.
    """
    return (
        spark.read.options(header="false", encoding=encoding, mode="PERMISSIVE", **csv_options(escape))
        .schema(schema)
        .csv(path)
    )


def parse_lines(
    lines: DataFrame,
    schema: StructType,
    line_col: str = "value",
    keep: tuple[str, ...] = (),
    escape: str = RAW_ESCAPE,
) -> DataFrame:
    """Parse a column of raw lines with the same rules as ``scan_raw``.

    Blank lines are dropped first (``from_csv('')`` would give a row of nulls,
    while the file scan skips such lines). Columns in ``keep`` ride along.
    """
    parsed: Column = F.from_csv(F.col(line_col), ddl(schema), csv_options(escape))
    return (
        lines.filter(F.col(line_col) != "")
        .select(parsed.alias("__r"), *keep)
        .select("__r.*", *keep)
    )


def snapshot_leaf(folder: str, reference_date: str) -> str:
    """``folder/year=YYYY/month=MM/day=DD`` of an ISO date; anything but ``YYYY-MM-DD`` raises ValueError."""
    day = date.fromisoformat(reference_date)
    if day.isoformat() != reference_date:
        raise ValueError(f"not a YYYY-MM-DD date: {reference_date!r}")
    return f"{folder.rstrip('/')}/{day:year=%Y/month=%m/day=%d}"


def raw_leaf(prefix: str, dataset: str, reference_date: str) -> str:
    """The files of one snapshot in the registry's raw layout (a glob, so its folders add no columns)."""
    return snapshot_leaf(f"{prefix.rstrip('/')}/{dataset}", reference_date) + "/*"
