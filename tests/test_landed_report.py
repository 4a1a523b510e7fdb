"""What was landed against what the archives hold; packed reads; dated leaves."""

import glob
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conftest import plan_text
from terrace.operators import landing as L
from terrace.plans import pipeline as P
from terrace.queries import REFERENCE_DATE
from terrace.sources import files, ziplines


def make_zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for name, data in members:
            zf.writestr(name, data)


def layout(root):
    return P.Layout(f"{root}/landed", f"{root}/refined", f"{root}/mart")


@pytest.fixture()
def landed(spark, scratch):
    """Two archives of two members, landed; LF and CR LF, a line without an end, letters that grow in UTF-8."""
    make_zip(f"{scratch}/Empresas0.zip", [("d/", b""), ("d/A.CSV", b'"1";"\xc9"\r\n"2";""\r\n'), ("d/B.CSV", b"x\n\ny"), ("V.CSV", b"")])
    make_zip(f"{scratch}/Empresas1.zip", [("A.CSV", b"one\n")])
    paths = [f"{scratch}/Empresas{i}.zip" for i in (0, 1)]
    selected = spark.createDataFrame([(os.path.basename(p), p, "empresas") for p in paths], "zip_name string, zip_url string, dataset string")
    manifest = P.land_archives(spark, selected, layout(scratch), REFERENCE_DATE)
    listing = ziplines.read_listing(spark, paths)
    datasets = selected.select(F.col("zip_url").alias("archive"), "dataset")

    def report():
        rows = L.landed_report(spark, listing, datasets, f"{scratch}/landed", REFERENCE_DATE)
        return {(r["zip_name"], r["member"]): r for r in rows.collect()}, rows

    return scratch, manifest, report


def leaf_files(root, member):
    leaf = L.landed_leaf(f"{root}/landed", "empresas", REFERENCE_DATE)
    return [f for f in glob.glob(f"{leaf}/member=*{member}*/part-*") if not f.endswith(".crc")]


def test_whole_members(landed):
    _, manifest, report = landed
    got, rows = report()
    assert {k: (r["listed_bytes"], r["read_bytes"], r["lines"], r["expected_bytes"], r["landed_bytes"], r["state"]) for k, r in got.items()} == {
        ("Empresas0.zip", "d/A.CSV"): (17, 17, 2, 16, 16, "whole"),
        ("Empresas0.zip", "d/B.CSV"): (4, 4, 3, 5, 5, "whole"),
        ("Empresas1.zip", "A.CSV"): (4, 4, 1, 4, 4, "whole"),
    }
    L.enforce_landed(rows)
    assert sorted(map(tuple, (r[:3] for r in manifest.collect()))) == [("Empresas0.zip", "empresas", "2"), ("Empresas1.zip", "empresas", "1")]


def test_a_member_that_is_gone_or_short_fails_the_gate(landed):
    root, _, report = landed
    (short,), (gone,) = leaf_files(root, "B.CSV"), leaf_files(root, "Empresas1")
    with open(short, "w") as f:
        f.write("x\n\n")
    for crc in glob.glob(os.path.dirname(short) + "/.*.crc"):
        os.remove(crc)
    os.remove(gone)
    got, rows = report()
    assert {k: r["state"] for k, r in got.items()} == {
        ("Empresas0.zip", "d/A.CSV"): "whole", ("Empresas0.zip", "d/B.CSV"): "stored short", ("Empresas1.zip", "A.CSV"): "not landed"}
    with pytest.raises(L.ArchiveError) as e:
        L.enforce_landed(rows)
    assert "2 member(s)" in str(e.value) and "Empresas0.zip/d/B.CSV: stored short" in str(e.value)
    assert [tuple(r)[:3] for r in L.manifest(rows, "b").collect()] == [("Empresas0.zip", "empresas", "1")]


def test_a_member_of_which_less_was_read(spark, landed, scratch):
    """The archive has grown since it was landed: what was read is less than what it holds now."""
    root, _, _ = landed
    make_zip(f"{root}/Empresas1.zip", [("A.CSV", b"one\ntwo\n")])
    datasets = spark.createDataFrame([(f"{root}/Empresas1.zip", "empresas")], "archive string, dataset string")
    rows = L.landed_report(spark, ziplines.read_listing(spark, f"{root}/Empresas1.zip"), datasets, f"{root}/landed", REFERENCE_DATE)
    states = {(r["zip_name"], r["member"]): (r["state"], r["passed"]) for r in rows.collect()}
    assert states["Empresas1.zip", "A.CSV"] == ("read short", False)
    assert states["Empresas0.zip", "d/A.CSV"] == ("not listed", True)  # landed by the run before


def test_nothing_is_written_when_an_archive_is_broken(spark, scratch):
    make_zip(f"{scratch}/Empresas0.zip", [("A.CSV", b"x\n")])
    with open(f"{scratch}/Empresas1.zip", "wb") as f:
        f.write(b"no archive")
    selected = spark.createDataFrame([(n, f"{scratch}/{n}", "empresas") for n in ("Empresas0.zip", "Empresas1.zip")], "zip_name string, zip_url string, dataset string")
    with pytest.raises(L.ArchiveError, match="1 archive.s. not readable: .*Empresas1.zip"):
        P.land_archives(spark, selected, layout(scratch), REFERENCE_DATE)
    assert not os.path.exists(f"{scratch}/landed")


def test_landing_collects_neither_selection_nor_manifest(spark, landed):
    """The manifest is a lazy table of written rows, its archive count is not a plan's literal."""
    _, manifest, _ = landed
    assert "LocalTableScan" not in plan_text(manifest) and "Scan parquet" in plan_text(manifest)


def test_tiny_members_are_packed_and_only_tasks_open_archives(spark, scratch, monkeypatch):
    with zipfile.ZipFile(f"{scratch}/Many.zip", "w") as zf:
        for i in range(20_000):
            zf.writestr(f"m{i:05d}.csv", b"%d\n" % i)
    opened = []
    monkeypatch.setattr(files, "open_input", lambda *a: opened.append(a))  # this process only
    path = f"{scratch}/listing"
    ziplines.read_listing(spark, f"{scratch}/Many.zip").write.parquet(path)
    plan, n = ziplines.pack(spark, spark.read.parquet(path))
    # 256 KB to open each and 64 MB a bin: 256 members a task
    assert 78 <= n <= 90
    sizes = [r["count"] for r in plan.groupBy("bin").count().collect()]
    assert len(sizes) == n and max(sizes) <= 256
    lines = ziplines.read_lines(spark, f"{scratch}/Many.zip", bin_bytes=512 << 20)
    assert lines.rdd.getNumPartitions() <= 16
    assert lines.agg(F.count("value"), F.sum(F.col("value").cast("long")), F.count_distinct("member")).first()[:] == (20_000, sum(range(20_000)), 20_000)
    assert not opened


def test_a_task_unpacks_a_bounded_number_of_bytes(spark, scratch):
    # members that compress to a few thousandths of their size
    with zipfile.ZipFile(f"{scratch}/Dense.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        for i in range(24):
            zf.writestr(f"m{i:02d}.csv", b"%d;1\n" % i * (3 << 18))
    listing = ziplines.read_listing(spark, f"{scratch}/Dense.zip")
    plan, n = ziplines.pack(spark, listing)
    sizes = plan.join(listing, ["archive", "entry"]).groupBy("bin").agg(F.sum("file_size").alias("s")).collect()
    assert len(sizes) == n and max(r["s"] for r in sizes) <= 32 << 20 < sum(r["s"] for r in sizes)
    found = ziplines.read_lines(spark, f"{scratch}/Dense.zip")
    assert found.count() == 24 * (3 << 18) and found.select("value").distinct().count() == 24


def test_a_large_member_has_a_task_of_its_own(spark, scratch):
    big = os.urandom(300_000)
    make_zip(f"{scratch}/Mixed.zip", [("a.csv", b"a\n"), ("big.csv", big.replace(b"\n", b" ") + b"\n"), ("b.csv", b"b\n"), ("c.csv", b"c\n")])
    plan, n = ziplines.pack(spark, ziplines.read_listing(spark, f"{scratch}/Mixed.zip"), bin_bytes=ziplines.OPEN_BYTES * 2 + 1000)
    bins = {r["member"]: r["bin"] for r in plan.collect()}
    assert n == 3 and bins["b.csv"] == bins["c.csv"] and len({bins["a.csv"], bins["big.csv"], bins["b.csv"]}) == 3


def test_equal_member_names_in_one_archive_are_both_read(spark, scratch):
    with pytest.warns(UserWarning):
        make_zip(f"{scratch}/Twice.zip", [("a.csv", b"1\n"), ("a.csv", b"2\n")])
    assert sorted(r["value"] for r in ziplines.read_lines(spark, f"{scratch}/Twice.zip").collect()) == ["1", "2"]


def test_storage_of_the_session(spark):
    from pyarrow import fs

    settings = {"endpoint": "http://store.example:9000", "access.key": "k", "secret.key": "s", "endpoint.region": "eu-1", "path.style.access": "true"}
    for k, v in settings.items():
        spark.conf.set(f"spark.hadoop.fs.s3a.{k}", v)
    try:
        storage = files.storage_options(spark)
    finally:
        for k in settings:
            spark.conf.unset(f"spark.hadoop.fs.s3a.{k}")
    assert storage == {"endpoint_override": "store.example:9000", "scheme": "http", "access_key": "k", "secret_key": "s", "region": "eu-1"}
    made, path = files.filesystem("s3a://bronze/cnpj/Empresas0.zip", storage)
    assert path == "bronze/cnpj/Empresas0.zip" and made.equals(fs.S3FileSystem(**storage))
    assert isinstance(files.filesystem("/tmp/x.zip", storage)[0], fs.LocalFileSystem)
    assert files.storage_options(spark) == {}


CODES = StructType([StructField("codigo", StringType()), StructField("descricao", StringType())])


def test_one_date_reads_one_leaf(spark, scratch):
    rows = [("1;a", "2026-01-11"), ("2;b", "2026-01-12"), ("3;c", "2026-02-11"), ("4;d", "2026-01-11")]
    lines = spark.createDataFrame(rows, "value string, day string").select("value", F.to_date("day").alias("day"), F.lit("cnaes").alias("dataset"))
    L.land(lines, scratch, None, date_col="day")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{scratch}/dataset=cnaes/year=2026/month=01/*")) == ["day=11", "day=12"]
    scan = L.scan_dates(spark, scratch, "cnaes", CODES)
    assert scan.columns == ["codigo", "descricao", "year", "month", "day"] and scan.count() == 4
    one = L.on_date(scan, "2026-01-11")
    plan = plan_text(one)
    assert "PartitionFilters: [isnotnull(year" in plan and "(day#" in plan.split("PartitionFilters", 1)[1].split("\n", 1)[0]
    assert "Filter (" not in plan  # nothing is left to filter on the rows
    # the other leaves are not even opened: unreadable files in them do no harm
    for other in ("year=2026/month=01/day=12", "year=2026/month=02/day=11"):
        with open(f"{scratch}/dataset=cnaes/{other}/member=lines/part-x.gz", "wb") as f:
            f.write(b"not gzip")
    again = L.on_date(L.scan_dates(spark, scratch, "cnaes", CODES), "2026-01-11")
    assert sorted(map(tuple, again.collect())) == [("1", "a"), ("4", "d")]
    with pytest.raises(Exception, match="gzip|GZIP|part-x"):
        L.on_date(L.scan_dates(spark, scratch, "cnaes", CODES), "2026-01-12").collect()


def test_a_date_landed_again_leaves_the_others(spark, scratch):
    def land(rows):
        lines = spark.createDataFrame(rows, "value string, day string").select("value", F.to_date("day").alias("day"), F.lit("cnaes").alias("dataset"))
        L.land(lines, scratch, None, date_col="day")

    land([("1;a", "2026-01-11"), ("2;b", "2026-01-12")])
    land([("9;z", "2026-01-12")])
    assert sorted(r["codigo"] for r in L.scan_dates(spark, scratch, "cnaes", CODES).collect()) == ["1", "9"]
    with pytest.raises(ValueError):
        L.land(spark.createDataFrame([("x", "d")], "value string, dataset string"), scratch, None)


def test_a_date_of_most_rows_is_dealt_to_several_tasks(spark, scratch):
    lines = spark.range(9000).select(
        F.concat(F.col("id").cast("string"), F.lit(";v")).alias("value"), F.lit("cnaes").alias("dataset"),
        F.when(F.col("id") % 3 < 2, F.to_date(F.lit("2026-01-11"))).otherwise(F.date_add(F.lit("2026-02-01"), (F.col("id") % 20).cast("int"))).alias("day"),
    )
    L.land(lines, scratch, None, date_col="day")
    hot = [f for f in glob.glob(f"{scratch}/dataset=cnaes/year=2026/month=01/day=11/member=lines/part-*")]
    assert len(hot) >= 4 and L.scan_dates(spark, scratch, "cnaes", CODES).count() == 9000
