"""ZIP sources, landing, and the whole select -> land -> refine -> mart flow."""

import os
import zipfile

import pytest

from terrace import adapters as A
from terrace.operators import landing as L
from terrace.plans import pipeline as P
from terrace.queries import REFERENCE_DATE, q_active_by_activity_state
from terrace.sources import ziplines
from terrace.sources.store import SnapshotStore

SF = "/root/testdata/sf0.001"


def make_zip(path, members):
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for name, data in members:
            zf.writestr(name, data)


def test_ziplines_members_and_line_splitting(spark, scratch):
    a = os.path.join(scratch, "Cnaes.zip")
    make_zip(a, [("dir/", b""), ("dir/empty.csv", b""), ("dir/F.CNAECSV", b'"1";"S\xc3O"\r\n"2";"a\x0bb\x85c"\n"3";"x"')])
    b = os.path.join(scratch, "Socios0.zip")
    make_zip(b, [("S0.CSV", b'"9";"y"\n')])
    rows = ziplines.read_lines(spark, [a, b]).orderBy("zip_name", "line_no").collect()
    assert [(r["zip_name"], r["member"], r["line_no"], r["value"]) for r in rows] == [
        ("Cnaes.zip", "dir/F.CNAECSV", 0, '"1";"SÃO"'),
        ("Cnaes.zip", "dir/F.CNAECSV", 1, '"2";"a\x0bb\x85c"'),
        ("Cnaes.zip", "dir/F.CNAECSV", 2, '"3";"x"'),
        ("Socios0.zip", "S0.CSV", 0, '"9";"y"'),
    ]
    assert ziplines.read_lines(spark, scratch).rdd.getNumPartitions() == 2
    listing = ziplines.read_listing(spark, scratch)
    rep = {r["zip_name"]: (r["n_files"], r["n_non_empty"], r["passed"]) for r in L.archive_report(listing).collect()}
    assert rep == {"Cnaes.zip": (2, 1, True), "Socios0.zip": (1, 1, True)}


def test_archive_paths_as_uris_folders_and_globs(spark, scratch):
    from terrace.sources import files

    make_zip(os.path.join(scratch, "Empresas0.zip"), [("E0.CSV", b'"1";"a"\n')])
    make_zip(os.path.join(scratch, "Empresas1.ZIP"), [("E1.CSV", b'"2";"b"\n"3";"c"\n')])
    make_zip(os.path.join(scratch, "_Empresas2.zip.attempt0"), [("E2.CSV", b'"9";"partial"\n')])
    make_zip(os.path.join(scratch, ".hidden.zip"), [("H.CSV", b'"8";"h"\n')])
    with open(os.path.join(scratch, "notes.txt"), "w") as f:
        f.write("x")
    uri = "file://" + scratch
    both = [uri + "/Empresas0.zip", uri + "/Empresas1.ZIP"]
    assert files.list_files(uri) == both
    assert files.list_files(scratch) == [scratch + "/Empresas0.zip", scratch + "/Empresas1.ZIP"]
    assert files.list_files(uri + "/Empresas[0-9].*") == both
    make_zip(os.path.join(scratch, "a,b.zip"), [("C.CSV", b"")])
    assert files.list_files([f"{uri}/Empresas1.ZIP", f"{uri}/a,b.zip"]) == [uri + "/Empresas1.ZIP", uri + "/a,b.zip"]
    os.remove(os.path.join(scratch, "a,b.zip"))
    with pytest.raises(FileNotFoundError, match="missing.zip"):
        files.list_files([f"{uri}/Empresas1.ZIP", f"{uri}/missing.zip"])
    rows = ziplines.read_lines(spark, uri).orderBy("zip_name", "line_no").collect()
    assert [(r["zip_name"], r["value"]) for r in rows] == [
        ("Empresas0.zip", '"1";"a"'), ("Empresas1.ZIP", '"2";"b"'), ("Empresas1.ZIP", '"3";"c"')]
    assert ziplines.read_lines(spark, uri + "/nothing*.zip").count() == 0


def test_write_archives_leaves_only_final_names(spark, scratch):
    from terrace.sources import files

    folder = "file://" + os.path.join(scratch, "site")
    lines = spark.createDataFrame([(f'"{i}";"x"',) for i in range(10)], "value string")
    paths = A.write_archives(lines, folder, "Socios", 3)
    assert paths == [f"{folder}/Socios{i}.zip" for i in range(3)]
    assert files.list_files(folder + "/*") == paths
    assert ziplines.read_lines(spark, folder).count() == 10


def test_archive_gates(spark, scratch):
    make_zip(os.path.join(scratch, "A.zip"), [("d/", b"")])
    make_zip(os.path.join(scratch, "B.zip"), [("e.csv", b"")])
    rep = L.archive_report(ziplines.read_listing(spark, scratch))
    with pytest.raises(L.ArchiveError) as e:
        L.enforce_archives(rep)
    assert "A.zip: has no files" in str(e.value) and "B.zip: no non-empty file" in str(e.value)


def test_archives_with_one_name_are_gated_apart(spark, scratch):
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    os.makedirs(a)
    os.makedirs(b)
    make_zip(os.path.join(a, "Cnaes.zip"), [("d/", b"")])
    make_zip(os.path.join(b, "Cnaes.zip"), [("C.CSV", b'"1";"x"\n')])
    rep = L.archive_report(ziplines.read_listing(spark, [a, b]))
    assert sorted((r["archive"], r["passed"]) for r in rep.collect()) == [
        (os.path.join(a, "Cnaes.zip"), False), (os.path.join(b, "Cnaes.zip"), True)]
    with pytest.raises(L.ArchiveError) as e:
        L.enforce_archives(rep)
    assert f"{os.path.join(a, 'Cnaes.zip')}: has no files" in str(e.value) and "1 archive(s)" in str(e.value)


def test_landing_replaces_only_equal_members(spark, scratch):
    root = os.path.join(scratch, "bronze")

    def land(rows, day):
        L.land(spark.createDataFrame(rows, "value string, dataset string, zip_name string, member string"), root, day)

    land([("a1", "empresas", "Empresas0.zip", "K0"), ("a2", "empresas", "Empresas0.zip", "K0"), ("c1", "cnaes", "Cnaes.zip", "C")], "2026-01-11")
    land([("e0", "empresas", "Empresas0.zip", "K0")], "2026-01-10")
    land([("b1", "empresas", "Empresas1.zip", "K0")], "2026-01-11")  # another archive with a member of the same name
    read = lambda ds, d: sorted(r["value"] for r in spark.read.text(L.landed_leaf(root, ds, d)).collect())
    assert read("empresas", "2026-01-11") == ["a1", "a2", "b1"]
    land([("a3", "empresas", "Empresas0.zip", "K0")], "2026-01-11")  # the same member again
    assert read("empresas", "2026-01-11") == ["a3", "b1"]
    assert read("empresas", "2026-01-10") == ["e0"] and read("cnaes", "2026-01-11") == ["c1"]
    members = {r["member"] for r in spark.read.text(L.landed_leaf(root, "empresas", "2026-01-11")).collect()}
    assert members == {"Empresas0.zip/K0", "Empresas1.zip/K0"}


def test_missing_archive_raises_and_writes_nothing(spark, scratch):
    make_zip(os.path.join(scratch, "Empresas0.zip"), [("E0.CSV", b'"1";"a"\n')])
    paths = [os.path.join(scratch, f"Empresas{i}.zip") for i in (0, 1)]
    selected = spark.createDataFrame(
        [(os.path.basename(p), p, "empresas") for p in paths], "zip_name string, zip_url string, dataset string"
    )
    root = os.path.join(scratch, "lake")
    with pytest.raises(L.ArchiveError, match="Empresas1.zip"):
        P.land_archives(spark, selected, P.Layout(f"{root}/landed", f"{root}/refined", f"{root}/mart"), REFERENCE_DATE)
    assert not os.path.exists(f"{root}/landed")


@pytest.fixture(scope="module")
def lake(spark):
    from terrace.session import fresh_dir

    site = fresh_dir(spark, "site")
    pages = A.build_archive_site(spark, SF, site, parts=2)
    root = fresh_dir(spark, "lake")
    layout = P.Layout(f"{root}/landed", f"{root}/refined", f"{root}/mart")
    out = P.run(spark, pages, layout, REFERENCE_DATE, max_files=10)
    return pages, layout, out


def test_pipeline_end_to_end(spark, lake):
    pages, layout, out = lake
    manifest = {m["zip_name"]: m for m in out["manifest"]}
    assert set(manifest) == {"Cnaes.zip", "Empresas0.zip", "Empresas1.zip", "Estabelecimentos0.zip",
                             "Estabelecimentos1.zip", "Motivos.zip", "Municipios.zip", "Naturezas.zip", "Paises.zip",
                             "Qualificacoes.zip", "Simples.zip", "Socios0.zip", "Socios1.zip"}
    assert manifest["Empresas1.zip"]["uploaded_files"] == "1" and manifest["Empresas1.zip"]["dataset"] == "empresas"
    refined = SnapshotStore(spark, layout.refined_root)
    for table, src in [("empresas", "customer"), ("estabelecimentos", "orders"), ("socios", "lineitem"), ("cnaes", "nation")]:
        assert refined.read(table).count() == spark.read.parquet(f"{SF}/{src}.parquet").count()
        assert out["refined"][table]["n_null_key"] == 0
    mart = SnapshotStore(spark, layout.mart_root).read(P.MART_TABLE)
    direct = q_active_by_activity_state(spark, SF)
    assert mart.exceptAll(direct).count() == 0 and direct.exceptAll(mart).count() == 0
    assert out["mart_rows"] == mart.count() > 0


def test_default_selection_takes_whole_series(spark, lake):
    pages, _, out = lake
    sel = P.select_archives(spark, pages, REFERENCE_DATE)
    assert sorted(r["zip_name"] for r in sel.collect()) == sorted(m["zip_name"] for m in out["manifest"])
    assert out["left_out"] == []


def test_limit_reports_what_is_left_out(spark, lake):
    from terrace.operators import selection
    from terrace.sources.links import extract_links

    pages, _, _ = lake
    sel = P.select_archives(spark, pages, REFERENCE_DATE, max_files=1)
    rep = selection.series_report(extract_links(pages), selection.filter_table(spark, P.DEFAULT_FILTERS), sel)
    left = {r["dataset_filter"]: r["n_left_out"] for r in rep.collect()}
    assert {k for k, v in left.items() if v} == {"Empresas", "Estabelecimentos", "Socios"} and left["Empresas"] == 1


def test_rerun_with_failing_gate_keeps_previous_snapshot(spark, lake):
    from terrace.operators.quality import QualityError

    _, layout, _ = lake
    before = SnapshotStore(spark, layout.refined_root).read("cnaes").count()
    with pytest.raises(QualityError):
        # no landed leaf for that date's cnaes -> empty table -> gate fails
        L.land(spark.createDataFrame([("x", "empresas")], "value string, dataset string"), layout.landed_root, "2026-02-01")
        os.makedirs(L.landed_leaf(layout.landed_root, "cnaes", "2026-02-01"), exist_ok=True)
        P.refine_table(spark, "cnaes", layout, "2026-02-01")
    assert SnapshotStore(spark, layout.refined_root).read("cnaes").count() == before


def test_refine_all_publishes_passing_tables_and_names_every_failure(spark, scratch):
    from terrace.operators.quality import QualityError

    root = os.path.join(scratch, "lake")
    layout = P.Layout(f"{root}/landed", f"{root}/refined", f"{root}/mart")
    lines = spark.createDataFrame(
        [('"0111301";"Cultivo de arroz"', "cnaes"), (';"sem codigo"', "motivos")], "value string, dataset string"
    )
    L.land(lines, layout.landed_root, REFERENCE_DATE)
    os.makedirs(L.landed_leaf(layout.landed_root, "paises", REFERENCE_DATE), exist_ok=True)
    with pytest.raises(QualityError) as e:
        P.refine_all(spark, layout, REFERENCE_DATE, tables=["cnaes", "motivos", "paises"])
    note = " ".join(getattr(e.value, "__notes__", []))
    assert "motivos: " in note and "paises: " in note and "cnaes: " not in note
    store = SnapshotStore(spark, layout.refined_root)
    assert [tuple(r) for r in store.read("cnaes").collect()] == [("0111301", "Cultivo de arroz", REFERENCE_DATE)]
    assert not store.exists("motivos") and not store.exists("paises")


def test_same_archive_name_under_two_urls_lands_each_line_once(spark, scratch):
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    os.makedirs(a)
    os.makedirs(b)
    make_zip(os.path.join(a, "Empresas1.zip"), [("E.CSV", b'"1";"a"\n"2";"b"\n')])
    make_zip(os.path.join(b, "Empresas1.zip"), [("E.CSV", b'"3";"c"\n')])
    selected = spark.createDataFrame(
        [("Empresas1.zip", os.path.join(d, "Empresas1.zip"), "empresas") for d in (a, b)],
        "zip_name string, zip_url string, dataset string",
    )
    root = os.path.join(scratch, "lake")
    layout = P.Layout(f"{root}/landed", f"{root}/refined", f"{root}/mart")
    P.land_archives(spark, selected, layout, REFERENCE_DATE)
    landed = spark.read.text(L.landed_leaf(layout.landed_root, "empresas", REFERENCE_DATE))
    assert sorted(r["value"] for r in landed.collect()) == ['"1";"a"', '"2";"b"', '"3";"c"']


def test_refine_files_in_raw_layout(spark, scratch):
    """Latin-1 files laid out as prefix/dataset/year=/month=/day=/member refine directly."""
    from terrace.sources.raw import raw_leaf

    leaf = os.path.join(scratch, "cnpj", "empresas", "year=2026", "month=01", "day=11")
    os.makedirs(leaf)
    with open(os.path.join(leaf, "K3241.EMPRECSV"), "wb") as f:
        f.write(b'"00000001";"S\xc3O JOS\xc9 LTDA";"2062";"49";"1000,50";"01";""\r\n')
        f.write(b'"00000002";"B";"2062";"49";"";"05";"BR"\r\n')
    store = SnapshotStore(spark, os.path.join(scratch, "silver"))
    m = P.refine_from_path(spark, "empresas", raw_leaf(os.path.join(scratch, "cnpj"), "empresas", "2026-01-11"), store, "2026-01-11")
    assert m["n_rows"] == 2
    rows = {r["cnpj_basico"]: r for r in store.read("empresas").collect()}
    assert rows["00000001"]["razao_social"] == "SÃO JOSÉ LTDA" and rows["00000001"]["capital_social"] == 1000.5
    assert rows["00000002"]["capital_social"] is None and rows["00000002"]["porte_empresa"] == 5
    assert store.read("empresas").columns[-1] == "reference_date" and "year" not in store.read("empresas").columns


def test_command_line_stages(spark, scratch):
    from terrace.__main__ import main

    site = os.path.join(scratch, "site")
    pages = A.build_archive_site(spark, SF, site, parts=2)
    index = os.path.join(scratch, "index.html")
    with open(index, "w") as f:
        f.write(pages.first()["html"])
    lake = os.path.join(scratch, "lake")
    base = "file://" + site + "/"
    land = main(["land", "--lake", lake, "--date", REFERENCE_DATE, "--index", index, "--base-url", base,
                 "--datasets", "Cnaes,Empresas,Estabelecimentos"])
    assert sorted(m["zip_name"] for m in land["manifest"]) == [
        "Cnaes.zip", "Empresas0.zip", "Empresas1.zip", "Estabelecimentos0.zip", "Estabelecimentos1.zip"]
    ref = main(["refine", "--lake", lake, "--date", REFERENCE_DATE, "--tables", "cnaes,empresas,estabelecimentos"])
    assert set(ref["refined"]) == {"cnaes", "empresas", "estabelecimentos"}
    mart = main(["mart", "--lake", lake, "--date", REFERENCE_DATE])
    assert mart["rows_gold"] > 0


def test_hadoop_schemes_map_to_pyarrow_schemes():
    from terrace.sources.files import pyarrow_uri

    assert pyarrow_uri("s3a://lake/bronze/x.zip") == "s3://lake/bronze/x.zip"
    assert pyarrow_uri("S3N://lake/a") == "s3://lake/a"
    assert pyarrow_uri("gcs://b/k") == "gs://b/k"
    for same in ("s3://lake/a", "hdfs://nn:8020/p", "abfs://c@acct.dfs.core.windows.net/p", "/tmp/x", "file:///tmp/x"):
        assert pyarrow_uri(same) == same
