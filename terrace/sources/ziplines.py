"""ZIP archives on shared storage as DataFrames: listed, packed into tasks, read line by line.

* ``read_listing``: one row per entry of every archive (directories and empty members
  too), ``LISTING``. Archives are opened on executors only, a slice of them per task; one
  that cannot be opened gives a row with its ``problem`` instead of failing the job.
* ``pack``: bins of members of about ``BIN_BYTES`` unpacked bytes each, since a task holds and
  sorts what it unpacks, however well it was compressed. Every task packs
  the members it holds in order (next fit: two neighbouring bins hold more than one bin's
  bytes together), so packing needs neither a global order nor the driver. A member
  counts ``OPEN_BYTES`` more, the cost of opening it: many tiny members make few tasks,
  a large one (deflate streams are not splittable) has a task of its own.
* ``read_counted``: the lines of every packed member, ``LINES``, and behind them one row
  with a null ``value`` that says how many lines (``line_no``) and source bytes were read
  and how many bytes they take as landed text. ``read_lines`` leaves these rows out.

Members are decoded incrementally (Latin-1 by default) into Arrow batches built without a
Python object per line. Lines end at ``\\n`` only; a trailing ``\\r`` is removed. Paths are a
file, a folder, a glob in the last segment, a list of files and folders, or a DataFrame
with a column ``archive``; local paths or URIs (``hdfs://``, ``s3a://`` ...), opened with
the session's endpoint and keys (``files.storage_options``).
"""

from __future__ import annotations

import zipfile

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.session import fresh_dir
from terrace.sources import files

LISTING = "archive string, zip_name string, entry int, member string, file_size long, packed_size long, is_dir boolean, problem string"
LINES = "archive string, zip_name string, member string, line_no long, value string"
COUNTED = f"{LINES}, source_bytes long, landed_bytes long"
BIN_BYTES = 32 << 20
OPEN_BYTES = 128 << 10
CHUNK_BYTES = 4 << 20


def _batch(rows: list[tuple], schema: str):
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def archive_paths(spark: SparkSession, paths: DataFrame | list[str] | str) -> DataFrame:
    """``archive`` of every path; a listed path that does not exist raises ``FileNotFoundError``."""
    if isinstance(paths, DataFrame):
        return paths.select(F.trim("archive").alias("archive")).distinct()
    names = files.list_files(paths, ".zip", files.storage_options(spark)) if paths else []
    return spark.createDataFrame([(n,) for n in names], "archive string")


def read_listing(spark: SparkSession, paths: DataFrame | list[str] | str) -> DataFrame:
    """Every entry of the archives (``LISTING``)."""
    storage = files.storage_options(spark)

    def entries(batches):
        for batch in batches:
            rows = []
            for archive in batch.column(0).to_pylist():
                name = files.basename(archive)
                try:
                    with files.open_input(archive, storage) as handle, zipfile.ZipFile(handle) as zf:
                        found = [
                            (archive, name, i, e.filename, e.file_size, e.compress_size, e.filename.endswith("/"), None)
                            for i, e in enumerate(zf.infolist())
                        ]
                except (OSError, ValueError, zipfile.BadZipFile) as e:  # a short file is a ValueError of the client
                    found = [(archive, name, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                # an archive without entries has a row too
                rows += found or [(archive, name, None, None, None, None, None, None)]
            yield _batch(rows, LISTING)

    tasks = 2 * spark.sparkContext.defaultParallelism
    return archive_paths(spark, paths).repartition(tasks).mapInArrow(entries, LISTING)


def pack(spark: SparkSession, listing: DataFrame, bin_bytes: int = BIN_BYTES) -> tuple[DataFrame, int]:
    """``archive, zip_name, entry, member, bin`` of every member with data, and the number of bins.

    The plan is written once, so its bins stay what they are when tasks are run again.
    """
    schema = "archive string, zip_name string, entry int, member string, part int, own int"

    def fit(batches):
        part, own, filled = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows = []
            for archive, name, entry, member, size in zip(*(c.to_pylist() for c in batch.columns)):
                weight = size + OPEN_BYTES
                if filled and filled + weight > bin_bytes:
                    own, filled = own + 1, 0
                filled += weight
                rows.append((archive, name, entry, member, part, own))
            yield _batch(rows, schema)

    members = listing.filter("not is_dir and file_size > 0").sortWithinPartitions("archive", "entry")
    path = fresh_dir(spark, "archive-plan")
    members.select("archive", "zip_name", "entry", "member", "file_size").mapInArrow(fit, schema).write.parquet(path)
    plan = spark.read.parquet(path)
    # one row per task that packed: a few hundred
    bins = plan.groupBy("part").agg((F.max("own") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = bins.select("part", before.cast("int").alias("start"))
    placed = plan.join(F.broadcast(starts), "part").withColumn("bin", F.col("start") + F.col("own"))
    return placed.select("archive", "zip_name", "entry", "member", "bin"), int(bins.agg(F.sum("n")).first()[0] or 0)


def _read(encoding: str, storage: dict, chunk_bytes: int):
    """Rows of ``COUNTED`` for the packed members of a partition; an archive is opened once for all of its members there."""

    def member_batches(zf, archive, name, entry, member):
        import codecs

        import numpy as np
        import pyarrow as pa

        decoder = codecs.getincrementaldecoder(encoding)()
        carry, first, source, landed = b"", 0, 0, 0
        with zf.open(zf.infolist()[entry]) as raw:
            while True:
                chunk = raw.read(chunk_bytes)
                source += len(chunk)
                values, carry = split_lines(carry + decoder.decode(chunk, final=not chunk).encode("utf-8"), not chunk)
                n = len(values)
                if n:
                    landed += n + values.buffers()[2].size
                    names = [pa.repeat(pa.scalar(x, pa.string()), n) for x in (archive, name, member)]
                    none = pa.nulls(n, pa.int64())
                    yield [*names, pa.array(np.arange(first, first + n, dtype=np.int64)), values, none, none]
                    first += n
                if not chunk:
                    break
        total = (archive, name, member, first, None, source, landed)
        yield _batch([total], COUNTED).columns

    def run(batches):
        import pyarrow as pa

        names = [f.split()[0] for f in COUNTED.split(", ")]
        held, rows, size = [], 0, 0
        now = handle = zf = None
        try:
            for batch in batches:
                for archive, name, entry, member in zip(*(c.to_pylist() for c in batch.columns)):
                    if archive != now:
                        if handle is not None:
                            zf.close()
                            handle.close()
                        handle = files.open_input(archive, storage)
                        now, zf = archive, zipfile.ZipFile(handle)
                    for columns in member_batches(zf, archive, name, entry, member):
                        held.append(pa.RecordBatch.from_arrays(columns, names=names))
                        rows, size = rows + len(columns[0]), size + held[-1].nbytes
                        if rows >= 10_000 or size >= chunk_bytes:
                            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                            held, rows, size = [], 0, 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
        finally:
            if handle is not None:
                zf.close()
                handle.close()

    return run


def read_counted(spark: SparkSession, listing: DataFrame, encoding: str = "ISO-8859-1", bin_bytes: int = BIN_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Lines of every member of a listing, and a row of its counts behind each (``COUNTED``); one task per bin."""
    plan, n = pack(spark, listing, bin_bytes)
    tasks = plan.repartitionById(max(n, 1), "bin").sortWithinPartitions("archive", "entry").select("archive", "zip_name", "entry", "member")
    return tasks.mapInArrow(_read(encoding, files.storage_options(spark), chunk_bytes), COUNTED)


def read_lines(spark: SparkSession, paths: DataFrame | list[str] | str, encoding: str = "ISO-8859-1", bin_bytes: int = BIN_BYTES) -> DataFrame:
    """Lines of every member of the archives (``LINES``); archives are listed once, now."""
    path = fresh_dir(spark, "archive-listing")
    read_listing(spark, paths).write.parquet(path)
    listing = spark.read.parquet(path)
    broken = listing.filter("problem is not null").limit(20).collect()
    if broken:
        raise OSError("not readable: " + "; ".join(f"{r['archive']} ({r['problem']})" for r in broken))
    return read_counted(spark, listing, encoding, bin_bytes).filter("value is not null").select([f.split()[0] for f in LINES.split(", ")])


def split_lines(data: bytes, final: bool):
    """UTF-8 text -> (its complete lines as an Arrow string array, the bytes after the last ``\\n``).

    Lines end at ``\\n`` only and lose one trailing ``\\r``; empty lines are kept.
    With ``final`` a non-empty remainder is the last line. Vectorised: newline
    positions from numpy, separators dropped with one byte mask, offsets from
    the line lengths, so no Python object is made per line.
    """
    import numpy as np
    import pyarrow as pa

    buf = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(buf == 10)
    cut = int(ends[-1]) + 1 if len(ends) else 0
    carry = data[cut:]
    if final and carry:
        ends = np.append(ends, len(data))
        cut, carry = len(data), b""
    n = len(ends)
    if n == 0:
        return pa.array([], pa.string()), carry
    if cut >= 1 << 31:
        raise ValueError("a text chunk of 2 GiB or more has no line break")
    starts = np.empty(n, dtype=np.int64)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    has_cr = (ends > starts) & (buf[np.maximum(ends - 1, 0)] == 13)
    stops = ends - has_cr
    keep = np.ones(cut, dtype=bool)
    keep[ends[ends < cut]] = False
    keep[stops[has_cr]] = False
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(stops - starts, out=offsets[1:])
    values = buf[:cut][keep]
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())), carry
