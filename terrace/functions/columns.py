"""Scalar column functions (Column -> Column), all JVM-side built-ins.

Every lenient conversion is a ``try_*`` so that bad input becomes null under
ANSI mode (Spark 4 default) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions import urls

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def comma_decimal(c: ColumnOrName) -> Column:
    """Decimal comma text -> double; every comma becomes a dot, malformed -> null.

    ``1000,00`` -> 1000.0, `` 5,5 `` -> 5.5 (spaces accepted), ``1.234,56`` -> null.
    """
    return F.regexp_replace(_c(c), ",", ".").try_cast("double")


# Placeholders the registry writes for a missing compact date.
MISSING_DATES = ("00000000", "0")


def lenient_date(c: ColumnOrName, fmt: str = "yyyyMMdd") -> Column:
    """Compact date text -> date; ``00000000``, empty, impossible dates -> null.

    Placeholders that can never parse skip the parser: a failed parse costs a
    caught exception per value, and placeholders are a large share of the
    registry's date fields. The result is the same as ``try_to_date`` alone.
    """
    col = _c(c)
    skip = ["", *MISSING_DATES] if fmt == "yyyyMMdd" else [""]
    return F.when(~col.isin(*skip), F.try_to_date(col, fmt))


def lenient_int(c: ColumnOrName) -> Column:
    """Text -> int the way the CSV scan does it: no trimming, no fractions, overflow -> null."""
    col = _c(c)
    return F.when(col.rlike(r"^[+-]?[0-9]+$"), col.try_cast("int"))


def nul() -> Column:
    """A one-character NUL string, built JVM-side (a literal NUL does not survive Py4J)."""
    return F.expr("char(0)")


def clean_nul(c: ColumnOrName) -> Column:
    """Every NUL character becomes one space (plain string replace, no regex)."""
    return F.replace(_c(c), nul(), F.lit(" "))


def py_strip(c: ColumnOrName) -> Column:
    """Leading and trailing whitespace removed (spaces, tabs, CR, LF, VT, FF)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def basename(c: ColumnOrName) -> Column:
    """Text after the last ``/`` (the whole text when there is none)."""
    return F.substring_index(_c(c), "/", -1)


def is_zip_link(c: ColumnOrName) -> Column:
    """Case-insensitive ``.zip`` suffix; ``x.zip?y=1`` is not a zip link."""
    return F.lower(_c(c)).endswith(".zip")


def dataset_name(c: ColumnOrName, strict_suffix: bool = False) -> Column:
    """Folder name of a dataset from an archive name: ``Empresas0.zip`` -> ``empresas``.

    Parity form (default): remove every ``.zip`` (case-sensitive), then trailing
    digits, then lower-case, so ``EMPRESAS0.ZIP`` -> ``empresas0.zip``.
    ``strict_suffix=True`` removes only a final ``.zip`` of any case.
    """
    name = basename(c)
    if strict_suffix:
        stem = F.regexp_replace(name, r"(?i)\.zip$", "")
    else:
        stem = F.replace(name, F.lit(".zip"), F.lit(""))
    return F.lower(F.regexp_replace(stem, r"[0-9]+$", ""))


def split_list(c: ColumnOrName, sep: str = ",") -> Column:
    """Comma list -> array of stripped, non-blank items; order and duplicates kept."""
    items = F.transform(F.split(_c(c), sep), lambda x: py_strip(x))
    return F.filter(items, lambda x: x != "")


def resolve_url(base: ColumnOrName, href: ColumnOrName) -> Column:
    """``href`` resolved against ``base`` (null if either is); see ``terrace.functions.urls``."""
    return urls.resolve(_c(base), _c(href))


def date_parts(iso_date: ColumnOrName) -> tuple[Column, Column, Column]:
    """ISO date text (strict) -> zero-padded year, month, day strings.

    A malformed date raises under ANSI mode, like the reference's strict parse.
    """
    d = F.to_date(_c(iso_date), "yyyy-MM-dd")
    return F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd")


def landing_key(prefix: ColumnOrName, dataset: ColumnOrName, day: ColumnOrName, member: ColumnOrName) -> Column:
    """Object key ``prefix/dataset/year=YYYY/month=MM/day=DD/member`` from a date column."""
    return F.concat_ws(
        "/",
        _c(prefix),
        _c(dataset),
        F.date_format(_c(day), "'year='yyyy"),
        F.date_format(_c(day), "'month='MM"),
        F.date_format(_c(day), "'day='dd"),
        _c(member),
    )


def stamp(df, reference_date: str, name: str = "reference_date"):
    """Append the snapshot date as a constant string column (last column)."""
    return df.withColumn(name, F.lit(reference_date))
