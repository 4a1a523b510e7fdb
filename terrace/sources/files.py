"""File access for the parts Spark's readers do not cover (ZIP archives, folder swaps).

Paths are URIs (``file://``, ``hdfs://``, ``s3a://``/``s3://``, ``gs://``, ``abfs://``)
or plain local paths, resolved through ``pyarrow.fs``, so the same code runs on a
laptop folder and on the cluster's shared storage. Executors open files
themselves; only names and sizes pass through the driver. Paths keep the form
Spark uses (``s3a://``); only the pyarrow side sees the scheme it knows.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath

from py4j.protocol import Py4JJavaError

GLOB_CHARS = "*?["

# Hadoop connector schemes and the pyarrow scheme for the same store.
HADOOP_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def pyarrow_uri(path: str) -> str:
    """``path`` with a Hadoop connector scheme replaced by the one pyarrow resolves."""
    scheme, sep, rest = path.partition("://")
    return f"{HADOOP_SCHEMES[scheme.lower()]}://{rest}" if sep and scheme.lower() in HADOOP_SCHEMES else path


def storage_options(spark) -> dict:
    """What the session says about S3-compatible storage (``spark.hadoop.fs.s3a.*``), as pyarrow's client takes it.

    Read once on the driver and handed to the tasks, so archives are opened with the endpoint and
    the keys that Spark's own readers use. Empty where the session says nothing (the client's defaults).
    """

    def setting(name: str) -> str | None:
        return spark.conf.get(f"spark.hadoop.fs.s3a.{name}", None) or None

    secure = (setting("connection.ssl.enabled") or "true").lower() != "false"
    endpoint = setting("endpoint")
    if endpoint and "://" in endpoint:
        scheme, _, endpoint = endpoint.partition("://")
        secure = scheme.lower() == "https"
    found = {
        "endpoint_override": endpoint,
        "scheme": None if secure else "http",
        "access_key": setting("access.key"),
        "secret_key": setting("secret.key"),
        "session_token": setting("session.token"),
        "region": setting("endpoint.region"),
        "force_virtual_addressing": True if endpoint and (setting("path.style.access") or "").lower() == "false" else None,
    }
    return {k: v for k, v in found.items() if v is not None}


def filesystem(path: str, storage: dict | None = None):
    """``(FileSystem, path inside it)`` for a URI or a local path; ``storage`` as ``storage_options`` gives it."""
    from pyarrow import fs as pafs

    if "://" in path and not path.startswith("file://"):
        uri = pyarrow_uri(path)
        if storage and uri.startswith("s3://"):
            return pafs.S3FileSystem(**storage), uri[len("s3://"):]
        return pafs.FileSystem.from_uri(uri)
    local = path[len("file://"):] if path.startswith("file://") else path
    return pafs.LocalFileSystem(), local


def join(folder: str, name: str) -> str:
    return folder.rstrip("/") + "/" + name


def basename(path: str) -> str:
    return posixpath.basename(path.rstrip("/"))


def make_dirs(path: str) -> None:
    fs, p = filesystem(path)
    fs.create_dir(p, recursive=True)


def move(src: str, dst: str) -> None:
    """Rename (atomic on POSIX and HDFS; copy and delete on object stores)."""
    fs, s = filesystem(src)
    _, d = filesystem(dst)
    fs.move(s, d)


def open_input(path: str, storage: dict | None = None):
    """Seekable handle (ZIP readers jump to the central directory at the end)."""
    fs, p = filesystem(path, storage)
    return fs.open_input_file(p)


def open_output(path: str):
    fs, p = filesystem(path)
    return fs.open_output_stream(p)


def list_files(spec: str | list[str], suffix: str = ".zip", storage: dict | None = None) -> list[str]:
    """Files of one path, or of a list of paths: a file, or a folder (``*<suffix>`` inside, case-insensitive).

    A path that does not exist raises ``FileNotFoundError``; names are taken as they
    are. Only a single path that does not exist may be a glob in its last segment.
    Inside folders, names starting with ``_`` or ``.`` are skipped. Results keep the
    form they were given in, so they can be handed to any executor as they are.
    """
    from pyarrow import fs as pafs

    out: set[str] = set()
    missing = []
    for path in [spec] if isinstance(spec, str) else spec:
        item = path.rstrip("/")
        fs, p = filesystem(item, storage)
        kind = fs.get_file_info(p).type
        if kind == pafs.FileType.File:
            out.add(item)
            continue
        pattern, folder_uri, folder = None, item, p
        if kind != pafs.FileType.Directory:
            if not isinstance(spec, str) or not any(ch in basename(item) for ch in GLOB_CHARS):
                missing.append(path)
                continue
            folder_uri, pattern = item.rsplit("/", 1)
            fs, folder = filesystem(folder_uri, storage)
        for f in fs.get_file_info(pafs.FileSelector(folder, recursive=False)):
            if f.type != pafs.FileType.File or f.base_name.startswith(("_", ".")):
                continue
            if fnmatch.fnmatchcase(f.base_name, pattern) if pattern else f.base_name.lower().endswith(suffix):
                out.add(join(folder_uri, f.base_name))
    if missing:
        raise FileNotFoundError("not readable: " + "; ".join(missing))
    return sorted(out)


# --- through Spark's own file systems (their settings, endpoints and credentials) ---


def spark_path(spark, path: str):
    """``(FileSystem, Path)`` of the session's Hadoop configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names_in(spark, folder: str) -> list[str]:
    """Names directly under ``folder``, sorted (none if it is missing)."""
    fs, p = spark_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def create_new(spark, path: str, text: str) -> bool:
    """Create a file with ``text`` unless there is one; False if there is.

    Of several that try at once, one succeeds: local files are opened exclusively, other file
    systems are asked not to overwrite (atomic on HDFS; on an object store as far as it creates conditionally).
    """
    fs, p = spark_path(spark, path)
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(posixpath.dirname(local), exist_ok=True)
        try:
            with open(local, "x") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    out.write(text.encode())
    out.close()
    return True


def remove(spark, path: str) -> None:
    fs, p = spark_path(spark, path)
    fs.delete(p, True)
