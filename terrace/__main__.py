"""Command line for the three stages (``python -m terrace`` or ``spark-submit run_terrace.py``).

    python -m terrace land   --index index.html --base-url URL --date 2026-01-11 --lake ROOT
    python -m terrace refine --date 2026-01-11 --lake ROOT [--tables cnaes,empresas]
    python -m terrace mart   --date 2026-01-11 --lake ROOT
    python -m terrace run    ... (all three)

``--lake ROOT`` holds ``bronze/``, ``silver/`` and ``gold/``. The index is a
saved HTML page (or a folder/glob of pages); archive links must resolve to
paths readable by every executor (download is not part of this tool).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from terrace.plans import pipeline as P


def layout_of(lake: str, fmt: str) -> P.Layout:
    root = lake.rstrip("/")
    return P.Layout(f"{root}/bronze", f"{root}/silver", f"{root}/gold", fmt)


def read_pages(spark: SparkSession, index: str, base_url: str | None):
    """Saved index pages as ``(page_id, url, html)``; the base URL defaults to the page's folder."""
    pages = spark.read.text(index, wholetext=True).select(
        F.col("value").alias("html"), F.col("_metadata.file_path").alias("file")
    )
    url = F.lit(base_url) if base_url else F.regexp_replace("file", r"[^/]*$", "")
    return pages.select(F.xxhash64("file").alias("page_id"), url.alias("url"), "html")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terrace")
    p.add_argument("stage", choices=["land", "refine", "mart", "run"])
    p.add_argument("--lake", required=True)
    p.add_argument("--date", required=True, help="reference date YYYY-MM-DD")
    p.add_argument("--index", help="saved index page(s) (land, run)")
    p.add_argument("--base-url", help="base URL of the index page links")
    p.add_argument("--datasets", default=P.DEFAULT_FILTERS, help="comma list of dataset filters")
    p.add_argument("--max-files", type=int, default=P.DEFAULT_MAX_FILES, help="files per numbered series (default: all)")
    p.add_argument("--tables", help="comma list of tables to refine (default: all ten)")
    p.add_argument("--format", default="parquet", help="store format (parquet, or delta when installed)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"terrace-{args.stage}").getOrCreate()
    layout = layout_of(args.lake, args.format)
    out: dict = {}
    if args.stage in ("land", "run"):
        if not args.index:
            raise SystemExit("--index is required for land/run")
        selected = P.select_archives(spark, read_pages(spark, args.index, args.base_url), args.date, args.datasets, args.max_files)
        out["manifest"] = [r.asDict() for r in P.land_archives(spark, selected, layout, args.date).collect()]
    if args.stage in ("refine", "run"):
        tables = [t.strip().lower() for t in args.tables.split(",") if t.strip()] if args.tables else None
        out["refined"] = P.refine_all(spark, layout, args.date, tables)
    if args.stage in ("mart", "run"):
        out["rows_gold"] = P.build_mart(spark, layout, args.date)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
