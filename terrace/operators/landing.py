"""Landing: archive members -> raw text by dataset, snapshot date and member.

The landed layout is ``root/dataset=<name>/year=YYYY/month=MM/day=DD/member=<archive/member>/part-*``.
One write job covers every dataset. Only an equal member of an equal archive is
replaced (dynamic partition overwrite), so a re-run repeats nothing, and members
landed earlier for the same date, other dates and other datasets stay. Lines are
stored as text (UTF-8, decoded once from the archive's encoding).

What was landed is known from the landed side. Archive readers end every member with a
row of its counts; the same write lands these rows under ``dataset=_tally-<name>``.
``landed_report`` then joins three sides by (dataset, archive, member): what the listing
says a member holds, what was read of it, and what its landed files take on storage (file
lengths from the storage's listing, no file is read again). A member that is listed but
not landed, or short on either way, fails the gate; the manifest counts whole members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrace.sources import files
from terrace.sources.raw import RAW_ESCAPE, scan_raw, snapshot_leaf

LANDED_ENCODING = "UTF-8"


# Fixed value: what the dataset folders of the landed counts begin with.
TALLY = "_tally-"
TALLY_SCHEMA = "archive string, zip_name string, member string, lines long, source_bytes long, landed_bytes long"


class ArchiveError(RuntimeError):
    """An archive is not readable, has no files, no non-empty file, or was not landed as a whole."""


def landed_leaf(root: str, dataset: str, reference_date: str) -> str:
    return snapshot_leaf(f"{root.rstrip('/')}/dataset={dataset}", reference_date)


def scan_landed(
    spark: SparkSession,
    root: str,
    dataset: str,
    reference_date: str,
    schema: StructType,
    encoding: str = LANDED_ENCODING,
    escape: str = RAW_ESCAPE,
) -> DataFrame:
    """Every member of exactly one landed leaf, typed by the declared schema (no partition columns)."""
    leaf = landed_leaf(root, dataset, reference_date)
    return scan_raw(spark, leaf, schema, encoding, escape).select(*schema.fieldNames())


def land(lines: DataFrame, root: str, reference_date: str | None, dataset_col: str = "dataset", line_col: str = "value", date_col: str | None = None) -> None:
    """Write raw lines; each (dataset, date, archive, member) is replaced as a whole.

    The snapshot date is one for all lines, or each line's own in ``date_col`` (exactly one of
    the two). ``zip_name`` and ``member`` name the member when the lines carry them; lines
    without them are one member called ``lines``. Lines of one date are not shuffled: the tasks
    that read a member write it, so files stay as large as the members. Lines of many dates are
    dealt by ranges of leaves first, so that a leaf is not one small file of every task; ranges
    cut through a leaf that is larger than a task's share. Rows of counts (``source_bytes``) go to the tally.
    """
    if (reference_date is None) == (date_col is None):
        raise ValueError("either one reference_date or a date_col")
    if date_col is None:
        leaf = landed_leaf("", "", reference_date)
        parts = dict(part.split("=") for part in leaf.split("/")[-3:])
        year, month, day = (F.lit(parts[k]) for k in ("year", "month", "day"))
    else:
        year, month, day = (F.date_format(date_col, f) for f in ("yyyy", "MM", "dd"))
    names = [F.col(c) for c in ("zip_name", "member") if c in lines.columns]
    dataset, value = F.col(dataset_col), F.col(line_col)
    if "source_bytes" in lines.columns:
        counts = F.to_json(F.struct("archive", "zip_name", "member", F.col("line_no").alias("lines"), "source_bytes", "landed_bytes"))
        tally = F.col("source_bytes").isNotNull()
        dataset, value = F.when(tally, F.concat(F.lit(TALLY), dataset)).otherwise(dataset), F.when(tally, counts).otherwise(value)
    leaf = {"dataset": dataset, "year": year, "month": month, "day": day, "member": F.concat_ws("/", *names) if names else F.lit("lines")}
    rows = lines.select(value.alias("value"), *[c.alias(n) for n, c in leaf.items()])
    if date_col is not None:
        n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(n, *leaf, F.monotonically_increasing_id())
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*leaf).text(root)


def scan_dates(spark: SparkSession, root: str, dataset: str, schema: StructType, encoding: str = LANDED_ENCODING, escape: str = RAW_ESCAPE) -> DataFrame:
    """All landed dates of a dataset, the date as ``reference_date`` (date); a filter on it prunes folders.

    ``year``, ``month`` and ``day`` stay as columns: they are the folders, and the planner reads
    only those that a filter on them leaves. ``on_date`` is that filter for one date.
    """
    folder = f"{root.rstrip('/')}/dataset={dataset}"
    typed = StructType([*schema.fields, *[StructField(c, StringType()) for c in ("year", "month", "day", "member")]])
    return scan_raw(spark, folder, typed, encoding, escape).drop("member")


def on_date(scan: DataFrame, reference_date: str) -> DataFrame:
    """The rows of one date of ``scan_dates``, without the folder columns."""
    parts = dict(part.split("=") for part in landed_leaf("", "", reference_date).split("/")[-3:])
    wanted = (F.col("year") == parts["year"]) & (F.col("month") == parts["month"]) & (F.col("day") == parts["day"])
    return scan.filter(wanted).drop("year", "month", "day")


def archive_report(listing: DataFrame) -> DataFrame:
    """Per archive: files (non-directory entries), non-empty files and the two gates.

    Archives are told apart by path when the listing has one (``archive``), so two
    archives with the same file name are gated separately; else by file name.
    """
    files = ~F.col("is_dir")
    keys = [c for c in ("archive", "zip_name") if c in listing.columns]
    return (
        listing.groupBy(*keys)
        .agg(
            F.count_if(files).alias("n_files"),
            F.count_if(files & (F.col("file_size") > 0)).alias("n_non_empty"),
        )
        .withColumn("has_files", F.col("n_files") > 0)
        .withColumn("has_non_empty", F.col("n_non_empty") > 0)
        .withColumn("passed", F.col("has_files") & F.col("has_non_empty"))
    )


def enforce_archives(report: DataFrame) -> None:
    """Raise for archives with no file, or with only empty files (the report is per archive)."""
    failing = report.filter(~F.col("passed"))
    shown = failing.limit(20).collect()  # the message names at most 20; the count is exact
    if shown:
        msgs = [
            f"{r.asDict().get('archive', r['zip_name'])}: " + ("has no files" if not r["has_files"] else "no non-empty file")
            for r in shown
        ]
        raise ArchiveError(f"{failing.count()} archive(s) failed: " + "; ".join(msgs))


def enforce_readable(listing: DataFrame) -> None:
    """Raise for archives that could not be opened, before anything is written."""
    broken = listing.filter("problem is not null")
    shown = broken.limit(20).collect()
    if shown:
        msgs = [f"{r['archive']} ({r['problem']})" for r in shown]
        raise ArchiveError(f"{broken.count()} archive(s) not readable: " + "; ".join(msgs))


def _member(zip_name: str = "zip_name", member: str = "member") -> Column:
    return F.concat_ws("/", zip_name, member)


def tallies(spark: SparkSession, root: str, reference_date: str, datasets: list[str]) -> DataFrame:
    """``dataset, place`` (archive/member), lines, bytes read and bytes to be landed, as written with the lines."""
    rows = _leaves(spark, root, reference_date, [TALLY + d for d in datasets], "text")
    if rows is None:
        return spark.createDataFrame([], "dataset string, place string, lines long, read_bytes long, expected_bytes long")
    one = rows.select(F.substring("dataset", len(TALLY) + 1, 1 << 20).alias("dataset"), F.from_json("value", TALLY_SCHEMA).alias("t"))
    return one.groupBy("dataset", _member("t.zip_name", "t.member").alias("place")).agg(
        F.sum("t.lines").alias("lines"), F.sum("t.source_bytes").alias("read_bytes"), F.sum("t.landed_bytes").alias("expected_bytes")
    )


def _leaves(spark: SparkSession, root: str, reference_date: str, datasets: list[str], fmt: str) -> DataFrame | None:
    """The landed files of one date of some datasets (their number is that of the dataset filters); None if there are none."""
    paths = [p for p in (landed_leaf(root, d, reference_date) for d in datasets) if files.names_in(spark, p)]
    if not paths:
        return None
    return spark.read.format(fmt).option("basePath", root).load(paths).withColumns({c: F.col(c).cast("string") for c in ("dataset", "member")})


def landed_sizes(spark: SparkSession, root: str, reference_date: str, datasets: list[str]) -> DataFrame:
    """``dataset, place, landed_files, landed_bytes`` of one date, from the storage's file listing (contents are not read)."""
    rows = _leaves(spark, root, reference_date, datasets, "binaryFile")
    if rows is None:
        return spark.createDataFrame([], "dataset string, place string, landed_files long, landed_bytes long")
    sizes = rows.select("dataset", F.col("member").alias("place"), "length")
    return sizes.groupBy("dataset", "place").agg(F.count(F.lit(1)).alias("landed_files"), F.sum("length").alias("landed_bytes"))


def landed_report(spark: SparkSession, listing: DataFrame, datasets: DataFrame, root: str, reference_date: str) -> DataFrame:
    """Per (dataset, archive, member): what is listed, read and stored of it, ``state`` and ``passed``.

    ``listing`` has the entries, ``datasets`` the dataset of each ``archive``. States: ``whole``,
    ``not landed`` (listed, but no landed file or no counts), ``read short``, ``stored short``
    (fewer or more bytes than the archive says, or than were read), ``not listed`` (landed for
    this date by an earlier run; no failure).
    """
    names = [r[0] for r in datasets.select("dataset").distinct().collect()]
    wanted = listing.filter("not is_dir and file_size > 0").join(datasets.select("archive", "dataset").distinct(), "archive")
    listed = wanted.groupBy("dataset", "zip_name", "member").agg(F.sum("file_size").alias("listed_bytes")).withColumn("place", _member())
    keys = ["dataset", "place"]
    sides = listed.join(tallies(spark, root, reference_date, names), keys, "full_outer").join(landed_sizes(spark, root, reference_date, names), keys, "full_outer")
    state = (
        F.when(F.col("listed_bytes").isNull(), "not listed")
        .when(F.col("read_bytes").isNull() | F.col("landed_bytes").isNull(), "not landed")
        .when(F.col("read_bytes") != F.col("listed_bytes"), "read short")
        .when(F.col("landed_bytes") != F.col("expected_bytes"), "stored short")
        .otherwise("whole")
    )
    out = sides.withColumn("state", state).withColumn("passed", F.col("state").isin("whole", "not listed"))
    zip_name = F.coalesce("zip_name", F.substring_index("place", "/", 1))
    member = F.coalesce("member", F.expr("substring(place, length(substring_index(place, '/', 1)) + 2)"))
    return out.select(
        "dataset", zip_name.alias("zip_name"), member.alias("member"), "listed_bytes", "read_bytes", "lines", "expected_bytes", "landed_bytes", "state", "passed"
    )


def enforce_landed(report: DataFrame) -> None:
    """Raise for members that are listed but not landed, or not as a whole."""
    failing = report.filter(~F.col("passed"))
    shown = failing.limit(20).collect()
    if shown:
        msgs = [f"{r['dataset']}/{r['zip_name']}/{r['member']}: {r['state']}" for r in shown]
        raise ArchiveError(f"{failing.count()} member(s) not landed as a whole: " + "; ".join(msgs))


def manifest(report: DataFrame, bucket: str) -> DataFrame:
    """Per landed archive: ``(zip_name, dataset, uploaded_files, bucket)``, from the landed side of a ``landed_report``.

    ``uploaded_files`` counts the members that stand in the landing as a whole and is a
    *string*. Archives of which nothing was landed, and members of earlier runs, give no row.
    """
    return report.filter("state = 'whole'").groupBy("zip_name", "dataset").agg(F.count(F.lit(1)).cast("string").alias("uploaded_files")).select(
        "zip_name", "dataset", "uploaded_files", F.lit(bucket).alias("bucket")
    )
