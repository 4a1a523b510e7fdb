"""Archive selection from index links: exact name, else the first N of a numbered series.

For each index page and each dataset filter ``F``:

* exact: a zip link whose lower-cased file name is ``lower(F) + ".zip"``; when
  several links share that name the *last* one wins; an exact match is always
  taken alone, whatever N is;
* otherwise the numbered series ``F<digits>.zip`` (case-insensitive, file name
  stripped of surrounding blanks), ordered by the numeric suffix and then by
  link position, first N kept. A link listed twice takes two of the N slots.

The match is an equi-join on candidate filter names computed from each link
(its exact stem, and every split of its trailing digit run), so the filter
list is never crossed with the links. Ranking is a ``row_number() <= N``
window, which Spark runs as a partial per-group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.functions.columns import basename, dataset_name, is_zip_link, py_strip, resolve_url, split_list


class SelectionError(RuntimeError):
    """Nothing matched any filter."""


def filter_table(spark: SparkSession, filters: list[str] | str) -> DataFrame:
    """Filters as ``(filter_pos, dataset_filter, filter_key)``; a string is a comma list.

    Filters are a configuration list, so the table is small by construction.
    """
    if isinstance(filters, str):
        frame = spark.createDataFrame([(filters,)], "spec string").select(
            F.posexplode(split_list(F.col("spec"))).alias("filter_pos", "dataset_filter")
        )
    else:
        items = [f.strip() for f in filters if f and f.strip()]
        frame = spark.createDataFrame(list(enumerate(items)), "filter_pos int, dataset_filter string")
    return frame.select(
        F.col("filter_pos").cast("int").alias("filter_pos"),
        "dataset_filter",
        F.lower("dataset_filter").alias("filter_key"),
    )


def _numeric_key(digits: Column) -> tuple[Column, Column]:
    """Exact numeric order of a digit string of any length: (length w/o leading zeros, text)."""
    stripped = F.regexp_replace(digits, "^0+", "")
    return F.length(stripped), stripped


def candidates(links: DataFrame) -> DataFrame:
    """Zip links with the filter keys they can match.

    Output: page_id, url, pos, href, filter_key, is_exact, suffix (null for exact).
    """
    z = links.filter(is_zip_link(F.col("href")))
    exact_key = F.regexp_extract(F.lower(basename(F.col("href"))), r"^(.*)\.zip$", 1)
    exact = z.select(
        "page_id", "url", "pos", "href", exact_key.alias("filter_key"), F.lit(True).alias("is_exact"),
        F.lit(None).cast("string").alias("suffix"),
    )
    name = F.lower(basename(py_strip(F.col("href"))))
    run = F.regexp_extract(name, r"([0-9]+)\.zip$", 1)
    base = F.expr("substring(name, 1, length(name) - 4)")
    numbered = (
        z.select("page_id", "url", "pos", "href", name.alias("name"), F.length(run).alias("run_len"))
        .filter(F.col("run_len") > 0)
        .select(
            "page_id", "url", "pos", "href", base.alias("base"),
            F.explode(F.sequence(F.lit(1), F.col("run_len"))).alias("j"),
        )
        .select(
            "page_id", "url", "pos", "href",
            F.expr("substring(base, 1, length(base) - j)").alias("filter_key"),
            F.lit(False).alias("is_exact"),
            F.expr("substring(base, length(base) - j + 1, j)").alias("suffix"),
        )
    )
    return exact.unionByName(numbered)


def select_files(
    links: DataFrame,
    filters: DataFrame,
    max_files: int | None = None,
    reference_date: str | None = None,
) -> DataFrame:
    """Selection records ``(page_id, dataset_filter, filter_pos, rank, pos, zip_name, zip_url, dataset, reference_date)``."""
    if max_files is not None and max_files < 0:
        raise ValueError("max_files must be >= 0")
    cand = candidates(links).join(filters, on="filter_key", how="inner")
    slen, stext = _numeric_key(F.col("suffix"))
    order_pos = F.when(F.col("is_exact"), -F.col("pos")).otherwise(F.col("pos"))
    w = Window.partitionBy("page_id", "filter_pos").orderBy(
        F.col("is_exact").desc(), slen.asc_nulls_first(), stext.asc_nulls_first(), order_pos.asc()
    )
    # 1) top max(N, 1) rows per group: planned as a partial per-group limit before
    #    the exchange, so a hot (page, filter) group ships at most that many rows
    #    per task; 2) on those few rows, whether the group's first row is exact.
    #    Without a limit the whole series is kept.
    top = cand.withColumn("rank", F.row_number().over(w))
    if max_files is not None:
        top = top.filter(F.col("rank") <= max(max_files, 1))
    ranked = top.withColumn(
        "group_has_exact", F.first("is_exact").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    keep = (F.col("is_exact") & (F.col("rank") == 1)) | (~F.col("group_has_exact") & (F.lit(True) if max_files is None else F.col("rank") <= max_files))
    zip_name = basename(F.col("href"))
    return ranked.filter(keep).select(
        "page_id",
        "dataset_filter",
        "filter_pos",
        F.col("rank").cast("int").alias("rank"),
        "pos",
        zip_name.alias("zip_name"),
        resolve_url(F.col("url"), F.col("href")).alias("zip_url"),
        dataset_name(zip_name).alias("dataset"),
        F.lit(reference_date).cast("string").alias("reference_date"),
    )


def series_report(links: DataFrame, filters: DataFrame, selection: DataFrame) -> DataFrame:
    """Per page and filter: archives that match, that are selected, and that are left out by the limit."""
    matched = candidates(links).join(filters, on="filter_key").groupBy("page_id", "dataset_filter").agg(
        F.count(F.lit(1)).alias("n"), F.max("is_exact").alias("exact")
    )
    taken = selection.groupBy("page_id", "dataset_filter").agg(F.count(F.lit(1)).alias("n_selected"))
    both = matched.join(taken, ["page_id", "dataset_filter"], "left")
    n_matching = F.when(F.col("exact"), F.lit(1).cast("bigint")).otherwise(F.col("n"))
    n_selected = F.coalesce("n_selected", F.lit(0).cast("bigint"))
    return both.select(
        "page_id", "dataset_filter", n_matching.alias("n_matching"), n_selected.alias("n_selected"),
        (n_matching - n_selected).alias("n_left_out"),
    )


def selection_report(pages: DataFrame, selection: DataFrame) -> DataFrame:
    """Per page: number of selected archives and whether the page passes (> 0)."""
    counts = selection.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_selected"))
    return (
        pages.select("page_id").distinct()
        .join(counts, "page_id", "left")
        .select("page_id", F.coalesce("n_selected", F.lit(0)).cast("bigint").alias("n_selected"))
        .withColumn("passed", F.col("n_selected") > 0)
    )


def enforce_selection(selection: DataFrame) -> None:
    """Raise when nothing at all was selected (one unmatched filter is not an error)."""
    if selection.isEmpty():
        raise SelectionError("no archive matched the filters")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per group in the given order (ties broken by the order list).

    Planned as a partial per-group limit before the exchange, then a final
    limit, so a hot group never moves more than ``n`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def last_per_key(df: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """Last-wins de-duplication: for each key keep the row with the greatest position."""
    w = Window.partitionBy(*keys).orderBy(position.desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
