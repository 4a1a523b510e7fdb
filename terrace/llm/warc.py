"""WARC archives: write pages as records, read them back with segment reassembly.

Writing. A page is an HTTP response whose body is sent in chunked transfer framing.
Of pages with equal bodies of at least ``REVISIT_BYTES``, the one with the largest
id is a ``response`` and the others are ``revisit`` records that carry only headers
and name it. A response longer than ``SEGMENT_BYTES`` is cut into a first segment
and ``continuation`` records that name its record id, their number and, on the last,
the total length. Files are written by Spark's own text writer (records end with an
empty line, as the format wants) and committed with the job; a file holds a bounded
number of records, so readers hold a bounded number of bytes.

Reading. Every file is parsed by one task, record by record: plain, one gzip stream, or
gzip members one after the other (as WARC files usually are), of which a chunk is unpacked
at a time. Header names are taken in any case, record ids as opaque names (only ids of
this writer name a page); ``warcinfo``, ``request`` and other types are passed over. Segments
are grouped by origin id (a group is one record), ordered by number, and their count and
total length verified; then the chunked framing is decoded and the body's digest compared
with the header (SHA-1; other digests are not checked). Revisits take length and digest
from the response they name. Anything that does not add up raises ``WarcError``.

Edge cases: a null html is an empty body; a null url an empty target; line breaks in
a url are percent-encoded; a null page_id sorts below every id and stays null;
repeated ids are records of their own, told apart by a nonce in the record id; of
equal bodies that share the largest id all are responses. An empty table gives no
record. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.joins import split_join

REVISIT_BYTES = 1000
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 1000
#: One date for all records, so that reruns write equal archives but for nonces.
WARC_DATE = "2026-01-11T00:00:00Z"
END = b"\r\n\r\n"
#: The page that a revisit of this writer refers to (its record's nonce is not known where the revisit is written).
REFERS = "X-Refers-To-Page"

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD = "page_id bigint, kind string, refers bigint, digest string, origin string, segment int, total bigint, block binary, target string, names string"
CHUNK = 1 << 20
BATCH_BYTES = 4 << 20


class WarcError(ValueError):
    """A record, its segments or its framing do not add up."""


def chunked(body: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(body[i : i + CHUNK_BYTES]), body[i : i + CHUNK_BYTES]) for i in range(0, len(body), CHUNK_BYTES)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    out, at = [], 0
    while True:
        eol = framed.find(b"\r\n", at)
        if eol < 0:
            raise WarcError("chunked framing: size line missing")
        try:
            size = int(framed[at:eol].split(b";")[0], 16)
        except ValueError as e:
            raise WarcError("chunked framing: bad size") from e
        if size == 0:
            return b"".join(out)
        body = framed[eol + 2 : eol + 2 + size]
        if len(body) != size or framed[eol + 2 + size : eol + 4 + size] != b"\r\n":
            raise WarcError("chunked framing: chunk cut short")
        out.append(body)
        at = eol + 4 + size


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in (*headers, ("Content-Length", str(len(block))))]
    return ("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + END + block


def page_records(page_id: int | None, url: str, html: bytes, digest: str, refers: int | None, refers_url: str | None) -> list[bytes]:
    """The records of one page: a revisit, a response, or a response in segments."""
    import uuid

    def uri(text: str) -> str:
        return text.replace("\r", "%0D").replace("\n", "%0A")

    rid = f"<urn:page:{'null' if page_id is None else page_id}:{uuid.uuid4().hex}>"
    sha1 = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = [("WARC-Record-ID", rid), ("WARC-Date", WARC_DATE), ("WARC-Target-URI", uri(url)), ("WARC-Payload-Digest", sha1)]
    http = ("Content-Type", "application/http; msgtype=response")
    if refers is not None:
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        named = [("WARC-Refers-To-Target-URI", uri(refers_url or "")), ("WARC-Refers-To-Date", WARC_DATE), (REFERS, str(refers))]
        return [record([("WARC-Type", "revisit"), *head, profile, *named, http], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(html)
    if len(block) <= SEGMENT_BYTES:
        return [record([("WARC-Type", "response"), *head, http], block)]
    parts = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    out = [record([("WARC-Type", "response"), *head, ("WARC-Segment-Number", "1"), http], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = [("WARC-Record-ID", f"<urn:segment:{uuid.uuid4().hex}>"), *head[1:3], ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", str(n))]
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        out.append(record([("WARC-Type", "continuation"), *own, *last], part))
    return out


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, refers, refers_url`` (refers null for responses).

    Equal bodies find each other by digest and id only, and a digest that many pages share is
    split; then what a page refers to meets its body under the page's own id and digest.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        html.alias("html"),
        F.sha1(html).alias("digest"),
        F.octet_length(html).alias("bytes"),
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page")
    large = base.filter(F.col("bytes") >= REVISIT_BYTES).select("page_id", page, F.concat_ws(":", "digest", "bytes").alias("body"), "url")
    last = F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("top")
    shared = large.groupBy("body").agg(last, F.count(F.lit(1)).alias("n")).filter("n > 1 and top is not null").drop("n")
    own = split_join(large.select("page_id", "page", "body").distinct(), shared, "body", "inner").filter("page_id is null or page_id < top.page_id")
    refers = own.select("page", "body", F.col("top.page_id").alias("refers"), F.col("top.url").alias("refers_url"))
    rows = base.withColumns({"page": page, "body": F.concat_ws(":", "digest", "bytes")}).join(refers, ["page", "body"], "left")
    return rows.select("page_id", "url", "html", "digest", "refers", "refers_url")


def write(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` as gzip-compressed WARC files under ``path``."""

    def build(batches):
        for batch in batches:
            out, size = [], 0
            for page, url, html, digest, refers, refers_url in zip(*(c.to_pylist() for c in batch.columns)):
                made = page_records(page, url, html.encode(), digest, refers, refers_url)
                out += made
                size += sum(map(len, made))
                if size > (4 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = with_revisits(pages).mapInArrow(build, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = lines.write.option("lineSep", END.decode()).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def unpacked(content: bytes):
    """Chunks of an archive's bytes: as they are, or of all its gzip members one after the other."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = memoryview(content)
    while len(rest):
        member, at = zlib.decompressobj(31), 0
        while not member.eof:
            if at >= len(rest) and not member.unconsumed_tail:
                raise WarcError("gzip member cut short")
            fed = member.unconsumed_tail or rest[at : at + CHUNK]
            at += 0 if member.unconsumed_tail else len(fed)
            yield member.decompress(fed, CHUNK)
        rest = rest[at - len(member.unused_data) :]
        # zeros may fill up the file behind its last member
        if len(rest) and not any(rest[:2]) and not any(rest):
            return


def parse(content: bytes):
    """``(headers, block)`` of every record of one archive; header names in lower case."""
    chunks, buf = unpacked(content), bytearray()

    def more() -> bool:
        for chunk in chunks:
            if chunk:
                buf.extend(chunk)
                return True
        return False

    while True:
        while len(buf) < 8 and more():
            pass
        while buf[:1] in (b"\r", b"\n"):
            del buf[0]
        if not buf and not more():
            return
        if not buf or buf[:1] in (b"\r", b"\n"):
            continue
        while (end := buf.find(END)) < 0 and more():
            pass
        if end < 0 or not buf.startswith(b"WARC/"):
            raise WarcError("record header missing")
        head, last = {}, None
        for line in bytes(buf[:end]).decode().split("\r\n")[1:]:
            if line[:1] in " \t" and last:  # a folded line goes on
                head[last] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            last = name.strip().lower()
            head[last] = value.strip()
        try:
            size = int(head["content-length"])
        except (KeyError, ValueError) as e:
            raise WarcError("record without a length") from e
        while len(buf) < end + 4 + size and more():
            pass
        block = bytes(buf[end + 4 : end + 4 + size])
        if len(block) != size:
            raise WarcError("record cut short")
        del buf[: end + 4 + size]
        yield head, block


def _page_of(uri: str | None) -> int | None:
    """The page that an id of this writer names (null for all others)."""
    found = re.fullmatch(r"<?urn:page:(-?[0-9]+):[0-9a-f]+>?", uri or "")
    return int(found[1]) if found else None


def _sha1(digest: str | None) -> str | None:
    """Hexadecimal SHA-1 of a digest header (base 32 or hexadecimal); null for other algorithms."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if re.fullmatch("[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Responses, revisits and segments of the archives under ``path``, segments not yet joined."""
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.string())
    names = [c.split()[0] for c in RECORD.split(", ")]

    def whole(head, key):
        return int(head[key]) if key in head else None

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for head, block in parse(content.as_buffer().to_pybytes()):
                    kind, own, segment = head["warc-type"].lower(), head["warc-record-id"], whole(head, "warc-segment-number")
                    if kind not in ("response", "revisit", "continuation") and segment is None:
                        continue
                    first, refers = kind != "continuation", whole(head, REFERS.lower())
                    rows.append(
                        (_page_of(own) if first else None, kind, refers, _sha1(head.get("warc-payload-digest")),
                         own if first else head["warc-segment-origin-id"], segment, whole(head, "warc-segment-total-length"), block,
                         head.get("warc-target-uri"), head.get("warc-refers-to"))
                    )
                    size += len(block)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """``page_id, kind, refers, digest, record, target, names, parts, total``: one row per response or revisit, its segments in order.

    ``record`` is the record's id, ``names`` the id of what a revisit refers to.
    """
    kept = ["page_id", "kind", "refers", "digest", F.col("origin").alias("record"), "target", "names"]
    whole = records.filter("segment is null").select(*kept, F.array("block").alias("parts"), F.lit(None).cast("bigint").alias("total"))
    ordered = F.array_sort(F.collect_list(F.struct("segment", "block")))
    first = F.col("kind") != "continuation"
    joined = (
        records.filter("segment is not null")
        .groupBy("origin")
        .agg(
            *(F.max(c).alias(c) for c in ("page_id", "refers", "digest", "total", "names")),
            *(F.max(F.when(first, F.col(c))).alias(c) for c in ("kind", "target")),
            F.count_if(first).alias("firsts"),
            F.max("segment").alias("last"),
            F.count_distinct("segment").alias("different"),
            ordered.alias("segments"),
        )
        .filter("kind is null or kind in ('response', 'revisit')")
    )
    sound = (F.col("firsts") == 1) & (F.col("last") == F.size("segments")) & (F.col("different") == F.size("segments")) & F.col("total").isNotNull()
    parts = F.when(sound, F.col("segments.block")).otherwise(F.raise_error(F.concat(F.lit("segments of "), "origin", F.lit(" do not add up"))))
    return whole.unionByName(joined.select(*kept, parts.alias("parts"), "total"))


def decode(rows: DataFrame) -> DataFrame:
    """``page_id, record_type, refers_to, payload_digest, payload_bytes, payload, record, target, names`` (payload null for revisits)."""
    kind_of = (
        "page_id bigint, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary, "
        "record string, target string, names string"
    )
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.string())
    names = [c.split()[0] for c in kind_of.split(", ")]

    def run(batches):
        for batch in batches:
            out = []
            for page, kind, refers, digest, record, target, named, parts, total in zip(*(c.to_pylist() for c in batch.columns)):
                block = b"".join(parts)
                if total is not None and len(block) != total:
                    raise WarcError(f"{record}: {len(block)} bytes in segments, {total} declared")
                head, _, framed = block.partition(END)
                body = None
                if kind == "response":
                    body = unchunked(framed) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else framed
                    found = hashlib.sha1(body).hexdigest()
                    if digest is not None and found != digest:
                        raise WarcError(f"{record}: payload digest differs")
                    digest = found
                out.append((page, kind, refers, digest, None if body is None else len(body), body, record, target, named))
            cols = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return rows.mapInArrow(run, kind_of)


def digest_table(spark: SparkSession, decoded: DataFrame) -> DataFrame:
    """Per record: id, length and digest of the full payload; revisits take them from their response."""
    from terrace.session import fresh_dir

    path = fresh_dir(spark, "warc-digests")
    decoded.drop("payload", "target").write.parquet(path)
    rows = spark.read.parquet(path)
    # a revisit names its response by page and digest (this writer's) or by record id
    by_page = F.when(F.col("refers_to").isNotNull(), F.concat_ws(":", F.lit("page"), "refers_to", "payload_digest"))
    revisits = rows.filter("record_type = 'revisit'").withColumn("key", F.coalesce(by_page, "names"))
    keys = F.array(F.concat_ws(":", F.lit("page"), "page_id", "payload_digest"), F.col("record"))
    answers = rows.filter("record_type = 'response'").select(F.explode(keys).alias("key"), F.col("payload_bytes").alias("full"), F.col("payload_digest").alias("found"))
    # one row for every response that is referred to, whatever the size of a group of copies
    answers = answers.join(revisits.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.max("full").alias("full"), F.max("found").alias("found"))
    missing = F.raise_error(F.concat(F.lit("no response for the revisit "), F.coalesce("record", F.lit("null"))))
    revisits = split_join(revisits, answers, "key", "left").withColumns(
        {"payload_bytes": F.coalesce("full", missing.cast("bigint")), "payload_digest": F.coalesce("payload_digest", "found")}
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.filter("record_type = 'response'").select(columns).unionByName(revisits.select(columns))


def roundtrip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to fresh archives on the shared folder and read them back."""
    from terrace.session import fresh_dir

    path = fresh_dir(spark, "warc")
    write(pages, path)
    return digest_table(spark, decode(reassemble(read_records(spark, path))))
