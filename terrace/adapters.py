"""Star-schema test tables -> registry-shaped raw lines (tests and query catalogue only).

Each adapter returns a one-column DataFrame ``value`` holding the raw line a
registry file would contain: every field quoted, ``;``-separated. Values are
derived row by row from the given tables, with deterministic rules that plant
the edge cases the refinement must handle (blank and malformed numbers,
impossible dates, NUL bytes, quoted-empty last fields, unmatched codes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import nul
from terrace.sources import files


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A driver table (only ``columns`` when given)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def pad(c: Column | str, width: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lpad(col.cast("string"), width, "0")


def quoted(c: Column) -> Column:
    """``"value"``; a null value gives a quoted empty field ``""``."""
    return F.concat(F.lit('"'), F.coalesce(c.cast("string"), F.lit("")), F.lit('"'))


def raw_line(*fields: Column) -> Column:
    return F.concat_ws(";", *[quoted(f) for f in fields]).alias("value")


def ymd(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyyMMdd")


def blank() -> Column:
    return F.lit("")


# --- code tables ---------------------------------------------------------------------

def raw_cnaes(spark, sf_dir):
    return table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).select(raw_line(pad("n_nationkey", 7), F.col("n_name")))


def raw_paises(spark, sf_dir):
    return table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).select(raw_line(pad("n_nationkey", 3), F.col("n_name")))


def raw_motivos(spark, sf_dir):
    return table(spark, sf_dir, "region", ["r_regionkey", "r_name"]).select(raw_line(pad("r_regionkey", 2), F.col("r_name")))


def raw_municipios(spark, sf_dir):
    return table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"]).select(raw_line(pad("s_suppkey", 4), F.col("s_name")))


def raw_naturezas(spark, sf_dir):
    return table(spark, sf_dir, "part", ["p_partkey", "p_name"]).select(raw_line(pad("p_partkey", 6), F.col("p_name")))


def raw_qualificacoes(spark, sf_dir):
    prio = table(spark, sf_dir, "orders", ["o_orderpriority"]).distinct()
    return prio.select(raw_line(F.substring("o_orderpriority", 1, 1), F.expr("substring(o_orderpriority, 3)")))


# --- companies (customer) -------------------------------------------------------------

def capital_text(c: Column | str) -> Column:
    """Money as registry text: two decimals with a decimal comma."""
    col = F.col(c) if isinstance(c, str) else c
    return F.replace(col.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def raw_empresas(spark, sf_dir):
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"])
    k = F.col("c_custkey")
    return c.select(
        raw_line(
            pad(k, 8),
            F.col("c_name"),
            pad("c_nationkey", 4),
            F.col("c_mktsegment"),
            F.when(k % 11 == 0, blank()).otherwise(capital_text("c_acctbal")),
            F.when(k % 13 == 0, F.lit("X")).otherwise(pad("c_nationkey", 2)),
            F.when(F.col("c_nationkey") == 0, F.lit("BR")).otherwise(blank()),
        )
    )


# --- establishments (orders) ----------------------------------------------------------

def raw_estabelecimentos(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    k, cust, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    return o.select(
        raw_line(
            # every 17th establishment belongs to a company that is not in the company table
            F.when(k % 17 == 0, (cust + 90000000).cast("string")).otherwise(pad(cust, 8)),
            pad(k % 10000, 4),
            pad(k % 97, 2),
            F.when(k % 4 == 0, F.lit("1")).otherwise(F.lit("2")),
            F.when(k % 5 == 0, F.concat(F.lit("LOJA"), nul(), k, nul(), F.lit("X"))).otherwise(F.concat(F.lit("LOJA "), k)),
            F.when(st == "F", F.lit("02")).when(st == "O", F.lit("08")).otherwise(blank()),
            F.when(k % 7 == 0, F.lit("00000000")).otherwise(ymd("o_orderdate")),
            pad(k % 60, 2),
            blank(),
            F.when(cust % 10 == 0, F.lit("105")).otherwise(blank()),
            F.when(k % 9 == 0, F.lit("20260230")).otherwise(ymd("o_orderdate")),
            pad(k % 30, 7),
            F.concat(pad(k % 7, 7), F.lit(","), pad(k % 11, 7)),
            F.lit("RUA"),
            F.concat(F.lit("RUA "), cust),
            (k % 1000).cast("string"),
            blank(),
            F.lit("CENTRO"),
            pad(cust % 100000, 8),
            F.nullif(F.expr("substring(o_orderpriority, 3)"), F.lit("LOW")),
            pad(cust % 5000, 4),
            F.lit("11"),
            pad(k % 100000000, 8),
            blank(),
            blank(),
            blank(),
            blank(),
            F.concat(F.lit("contato"), cust, F.lit("@example.com")),
            blank(),
            blank(),
        )
    )


# --- simplified tax regime (orders) ---------------------------------------------------

def raw_simples(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    return o.select(
        raw_line(
            pad(k, 8),
            F.when(st == "F", F.lit("S")).otherwise(F.lit("N")),
            ymd("o_orderdate"),
            F.when(st == "F", F.lit("00000000")).when(st == "O", ymd("o_orderdate")).otherwise(blank()),
            F.when(k % 3 == 0, F.lit("S")).otherwise(F.lit("N")),
            F.when(k % 3 == 0, ymd("o_orderdate")).otherwise(F.lit("00000000")),
            blank(),
        )
    )


# --- partners (lineitem) --------------------------------------------------------------

def raw_socios(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return li.select(
        raw_line(
            pad("l_orderkey", 8),
            F.col("l_linenumber").cast("string"),
            F.concat(F.lit("SOCIO "), F.col("l_partkey")),
            F.concat(F.lit("***"), pad(F.col("l_suppkey") % 1000000, 6), F.lit("**")),
            pad("l_linenumber", 2),
            ymd("l_shipdate"),
            blank(),
            F.lit("***000000**"),
            blank(),
            F.lit("00"),
            (F.col("l_linenumber") % 10).cast("string"),
        )
    )


RAW_ADAPTERS = {
    "cnaes": raw_cnaes,
    "municipios": raw_municipios,
    "motivos": raw_motivos,
    "naturezas": raw_naturezas,
    "paises": raw_paises,
    "qualificacoes": raw_qualificacoes,
    "empresas": raw_empresas,
    "estabelecimentos": raw_estabelecimentos,
    "simples": raw_simples,
    "socios": raw_socios,
}


# --- index pages with archive links (supplier) ------------------------------------------

def index_links(spark, sf_dir):
    """Links of crawled index pages, one per supplier: ``(page_id, url, pos, href)``.

    Planted cases: numbered series whose numbers fall while positions rise,
    equal numbers with leading zeros, an exact name listed several times,
    upper-case suffixes, query strings after ``.zip``, absolute mirror URLs,
    a filter name ending in a digit, and names with a leading blank.
    """
    s = table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    k = F.col("s_suppkey")
    r = k % 8
    href = (
        F.when(r == 0, F.concat(F.lit("/files/Alpha"), (F.lit(100000) - k), F.lit(".zip")))
        .when(r == 1, F.concat(F.lit("beta"), pad(k % 7, 2), F.lit(".ZIP")))
        .when(r == 2, F.lit("x/Gamma.zip"))
        .when(r == 3, F.concat(F.lit("GAMMA"), k, F.lit(".zip")))
        .when(r == 4, F.concat(F.lit("Delta"), k, F.lit(".zip?x=1")))
        .when(r == 5, F.concat(F.lit("https://mirror.example.org/d/alpha0"), k, F.lit(".zip")))
        .when(r == 6, F.concat(F.lit("Epsilon"), k, F.lit(".zip")))
        .otherwise(F.concat(F.lit(" Beta"), k % 5, F.lit(".zip")))
    )
    return s.select(
        F.col("s_nationkey").cast("bigint").alias("page_id"),
        F.concat(F.lit("http://idx"), F.col("s_nationkey"), F.lit(".example.org/arquivos/2026-01-11/")).alias("url"),
        k.alias("pos"),
        href.alias("href"),
    )


def archive_members(spark, sf_dir):
    """Archive listing ``(zip_name, member, file_size, is_dir)``: one archive per order,
    one member per line item (empty when the quantity is at most 10), plus a
    directory entry in every archive (orders without items give archives with no file)."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    o = table(spark, sf_dir, "orders", ["o_orderkey"])
    member_rows = li.select(
        F.concat(F.lit("Socios"), F.col("l_orderkey"), F.lit(".zip")).alias("zip_name"),
        F.concat(F.lit("K"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"), F.lit(".SOCIOCSV")).alias("member"),
        F.when(F.col("l_quantity") > 10, (F.col("l_quantity") * 1000).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("file_size"),
        F.lit(False).alias("is_dir"),
    )
    dirs = o.select(
        F.concat(F.lit("Socios"), F.col("o_orderkey"), F.lit(".zip")).alias("zip_name"),
        F.lit("dados/").alias("member"),
        F.lit(0).cast("bigint").alias("file_size"),
        F.lit(True).alias("is_dir"),
    )
    return member_rows.unionByName(dirs)


LINES_PER_ARCHIVE = 1_000_000


# --- archives on a shared folder --------------------------------------------------------

def write_archives(lines: DataFrame, folder: str, stem: str, n_archives: int | None = None) -> list[str]:
    """Pack raw lines into ``n_archives`` ZIPs (default: one per LINES_PER_ARCHIVE lines, four at least) (Latin-1 member, plus a directory entry and
    an empty member in each), one archive per Spark task; returns the archive paths.

    ``folder`` may be a local path or a URI of shared storage; each task streams
    its archive to a per-attempt name and renames it when complete, so a retried
    or speculative attempt never leaves a half-written archive under the final name.
    """
    import zipfile

    from pyspark import TaskContext

    def pack(batches):
        import pandas as pd

        ctx = TaskContext.get()
        pid = ctx.partitionId()
        path = files.join(folder, f"{stem}{pid}.zip")
        tmp = files.join(folder, f"_{stem}{pid}.zip.attempt{ctx.attemptNumber()}")
        n = 0
        with files.open_output(tmp) as out, zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("dados/", b"")
            zf.writestr("dados/VAZIO.CSV", b"")
            with zf.open(f"dados/K{pid:04d}.CSV", "w") as member:
                for b in batches:
                    if len(b):
                        member.write(("\r\n".join(b["value"]) + "\r\n").encode("latin-1"))
                        n += len(b)
        files.move(tmp, path)
        yield pd.DataFrame({"archive": [path], "n_lines": [n]})

    if n_archives is None:
        n_archives = max(4, -(-lines.count() // LINES_PER_ARCHIVE))
    files.make_dirs(folder)
    done = lines.repartition(n_archives).mapInPandas(pack, "archive string, n_lines long").collect()
    return sorted(r["archive"] for r in done)


def write_member_archives(members: DataFrame, folder: str, stem: str, n_archives: int, n_empty: int) -> None:
    """Pack lines (archive_no, member, value) into archives ``<stem><archive_no>.zip`` of several members each.

    Every archive also has a directory entry and an empty member; ``n_empty`` more archives have
    nothing else. A task streams its archive, rows sorted by member (Latin-1, lines end in CR LF).
    """
    import zipfile

    from pyspark import TaskContext

    def pack(batches):
        import pandas as pd

        ctx = TaskContext.get()
        number = ctx.partitionId()
        tmp = files.join(folder, f"_{stem}{number}.zip.attempt{ctx.attemptNumber()}")
        with files.open_output(tmp) as out, zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("dados/", b"")
            zf.writestr("dados/VAZIO.CSV", b"")
            now = handle = None
            for batch in batches:
                for member, lines in batch.groupby("member", sort=False)["value"]:
                    if member != now:
                        if handle is not None:
                            handle.close()
                        now, handle = member, zf.open(member, "w")
                    handle.write(("\r\n".join(lines) + "\r\n").encode("latin-1"))
            if handle is not None:
                handle.close()
        files.move(tmp, files.join(folder, f"{stem}{number}.zip"))
        yield pd.DataFrame({"archive_no": [number]})

    files.make_dirs(folder)
    placed = members.repartitionById(n_archives + n_empty, "archive_no").sortWithinPartitions("member", "value")
    placed.select("member", "value").mapInPandas(pack, "archive_no int").write.format("noop").mode("overwrite").save()


def socios_members(spark, sf_dir):
    """Lines of line items by archive (``archive_no``, 0 to 39) and member, with a letter that takes two bytes once landed."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]).filter("l_quantity > 10")
    value = F.concat_ws(";", "l_orderkey", "l_linenumber", F.lit("S\u00c9"))
    member = F.concat(F.lit("dados/K"), F.col("l_linenumber"), F.lit(".SOCIOCSV"))
    return li.select((F.col("l_orderkey") % 40).cast("int").alias("archive_no"), member.alias("member"), value.alias("value"))


# Archive names of the registry dump; "{i}" marks a numbered series.
ARCHIVE_NAMES = {
    "cnaes": "Cnaes.zip",
    "empresas": "Empresas{i}.zip",
    "estabelecimentos": "Estabelecimentos{i}.zip",
    "motivos": "Motivos.zip",
    "municipios": "Municipios.zip",
    "naturezas": "Naturezas.zip",
    "paises": "Paises.zip",
    "qualificacoes": "Qualificacoes.zip",
    "simples": "Simples.zip",
    "socios": "Socios{i}.zip",
}


def build_archive_site(spark, sf_dir: str, folder: str, parts: int = 4) -> DataFrame:
    """Write every table's raw lines as registry archives into ``folder`` and return
    an index page ``(page_id, url, html)`` linking them (numbered series get
    ``parts`` archives each). The page's base URL is the folder itself."""
    import os

    hrefs = []
    for table_name, pattern in ARCHIVE_NAMES.items():
        lines = RAW_ADAPTERS[table_name](spark, sf_dir)
        if "{i}" in pattern:
            stem = pattern.split("{i}")[0]
            paths = write_archives(lines, folder, stem, parts)
        else:
            stem = pattern[: -len(".zip")]
            paths = write_archives(lines, folder, stem + "_", 1)
            final = files.join(folder, pattern)
            files.move(paths[0], final)
            paths = [final]
        hrefs.extend(files.basename(p) for p in paths)
    body = "".join(f'<li><a href="{h}">{h}</a></li>' for h in hrefs)
    html = f"<html><body><h1>index</h1><ul><li><a href=\"../\">up</a></li>{body}</ul></body></html>"
    base = folder if "://" in folder else "file://" + os.path.abspath(folder)
    return spark.createDataFrame([(0, base.rstrip("/") + "/", html)], "page_id long, url string, html string")
