"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the token postings of the training documents: one row
per shard (a bounded slice of documents) with, for every term, the sorted word
positions of all its occurrences in that shard. Positions of consecutive
documents are kept more than a window apart, so an offset can never lead from
one document into the next. The index holds all terms, whatever is searched for.

``window_blocks`` cuts the test items into windows on the executors, brings equal
windows together and deals them to blocks of bounded size. Block after block goes to
all shards (a job of its own, whose hits are written): in every shard the
offset-adjusted position lists of a window are intersected from its rarest term on.
A candidate start survives while each further term stands at its offset. With ``slop``
above 0 proximity matches are reported too: a start from which every term stands at
most that many words off its place, the rarest one included, so what matches does not
depend on how documents were dealt to shards.

A shard is built and searched by one task on its own, so a lost executor costs
those shards again; only hits are shuffled, by document.

Edge cases: a null or empty text has no words (0 hits, not contaminated); an
item without words has no window; an item of fewer words than a window is one
window; repeated items and documents are each reported; a null item_id is
listed as ``null``; an empty benchmark hits nothing. Further columns of either
table are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import words as W
from terrace.session import fresh_dir

WINDOW = 13
SLOP = 2
#: Windows of a block of the test set: bounds what a task is sent (13 hashes of 8 bytes each).
BLOCK_WINDOWS = 100_000
#: Text of a shard; every shard looks up all windows of a block.
SHARD_BYTES = (1 << 20) - 1
#: Shards of a file of the index: bounds what a reading task holds.
SHARDS_PER_FILE = 32

INDEX = (
    "shard string, ids array<bigint>, bases array<int>, n_words array<int>, "
    "terms array<bigint>, ptr array<int>, positions array<int>"
)
HITS = "shard string, ord int, spans array<int>, items array<string>, near array<string>"
#: Words between two documents of a shard: more than a proximity match can bridge.
GAP = WINDOW + 4 * SLOP


def windows_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``width, terms, item``: every window of every item, its term hashes as bytes."""

    def cut_items(batches):
        for batch in batches:
            for lo, hi in W.slices(batch.column(1)):
                cut = W.cut(batch.column(1).slice(lo, hi - lo), W.ALNUM_LOWER)
                items = [x if x is not None else "null" for x in batch.column(0).slice(lo, hi - lo).to_pylist()]
                rows = []
                for item, at, n in zip(items, cut.ptr[:-1].tolist(), cut.counts.tolist()):
                    width = min(n, WINDOW)
                    rows += [(width, cut.hash[s : s + width].tobytes(), item) for s in range(at, at + n - width + 1 if n else at)]
                cols = list(zip(*rows)) or [[]] * 3
                kinds = (pa.int32(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["width", "terms", "item"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(cut_items, "width int, terms binary, item string")


def window_blocks(spark: SparkSession, benchmark: DataFrame, most: int = BLOCK_WINDOWS) -> list[DataFrame]:
    """Different windows with their items, dealt to written blocks of about ``most`` windows."""
    path = fresh_dir(spark, "test-windows")
    windows_of(benchmark).groupBy("width", "terms").agg(F.array_sort(F.collect_set("item")).alias("items")).write.parquet(path)
    windows = spark.read.parquet(path)
    n = -(-windows.count() // most)
    if n <= 1:
        return [windows] * n
    path = fresh_dir(spark, "test-blocks")
    windows.withColumn("block", F.pmod(F.xxhash64("terms"), F.lit(n))).write.partitionBy("block").parquet(path)
    return [spark.read.parquet(path).filter(F.col("block") == b).drop("block") for b in range(n)]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional postings of ``docs`` by shard."""

    def shards(batches):
        import uuid

        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER, most=SHARD_BYTES):
            n = cut.counts
            bases = np.concatenate([[0], np.cumsum(n + GAP)])[:-1]
            place = np.arange(len(cut.hash)) - np.repeat(cut.ptr[:-1] - bases, n)
            order = np.argsort(cut.hash, kind="stable")
            h, place = cut.hash[order], place[order]
            cuts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([bases.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([n.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([h[cuts].view(np.int64)], pa.list_(pa.int64())),
                    pa.array([np.append(cuts, len(h)).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([place.astype(np.int32)], pa.list_(pa.int32())),
                ],
                names=["shard", "ids", "bases", "n_words", "terms", "ptr", "positions"],
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(shards, INDEX)


class ShardIndex:
    """Positional lists of one shard."""

    def __init__(self, terms: np.ndarray, ptr: np.ndarray, positions: np.ndarray):
        self.terms, self.ptr, self.positions = terms, ptr.astype(np.int64), positions.astype(np.int64)
        self.span = np.int64(int(positions.max()) + 4 * GAP if len(positions) else 1)
        # one sorted array of (term, position) answers "does this term stand here"
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(self.ptr)) * self.span + self.positions

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def match(self, windows: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(window, start, place of its rarest term)`` of every match; ``windows`` is a matrix of term hashes, a row a window."""
        ids = self.lookup(windows)
        full = np.flatnonzero((ids >= 0).all(axis=1))
        ids = ids[full]
        if not len(full):
            return full, full, full
        lengths = self.ptr[ids + 1] - self.ptr[ids]
        order = np.argsort(lengths, axis=1, kind="stable")  # rarest first
        rows = np.arange(len(full))
        first = ids[rows, order[:, 0]]
        n = lengths[rows, order[:, 0]]
        which = np.repeat(rows, n)
        anchor = self.positions[W.ragged(self.ptr[first], n)]
        moves = np.arange(-slop, slop + 1)
        which, anchor = np.repeat(which, len(moves)), np.repeat(anchor, len(moves))
        start = anchor - order[which, 0] + np.tile(moves, len(which) // len(moves))
        for k in range(1, windows.shape[1]):
            if not len(which):
                break
            offset = order[which, k]
            place = start + offset
            base = ids[which, offset] * self.span
            at = np.minimum(np.searchsorted(self.keys, base + np.maximum(place - slop, 0)), len(self.keys) - 1)
            there = self.keys[at] - base
            ok = (there >= place - slop) & (there <= place + slop) & (there >= 0)
            which, start, anchor = which[ok], start[ok], anchor[ok]
        return full[which], start, anchor


def search(index: DataFrame, block: pa.Table, slop: int = SLOP) -> DataFrame:
    """One row per document with a hit: spans (start, end by word), the items they come from, and those of proximity matches."""
    by_width: dict[int, tuple[np.ndarray, list]] = {}
    widths = block.column("width").to_numpy()
    for width in np.unique(widths).tolist():
        of = block.filter(pa.array(widths == width))
        terms = np.frombuffer(b"".join(of.column("terms").to_pylist()), np.uint64).reshape(-1, width)
        by_width[width] = (terms, of.column("items").to_pylist())

    def probe(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                bases, terms, ptr, positions = (batch.column(n)[k].values.to_numpy(zero_copy_only=False) for n in ("bases", "terms", "ptr", "positions"))
                shard, bases = ShardIndex(terms.view(np.uint64), ptr, positions), bases.astype(np.int64)
                spans, exact, near = defaultdict(list), defaultdict(set), defaultdict(set)
                for width, (windows, items) in by_width.items():
                    w, s, place = shard.match(windows)
                    doc = np.searchsorted(bases, place, side="right") - 1
                    for a, b, d in zip(w.tolist(), (s - bases[doc]).tolist(), doc.tolist()):
                        spans[d] += [b, b + width]
                        exact[d].update(items[a])
                    if slop:
                        w, s, place = shard.match(windows, slop)
                        doc = np.searchsorted(bases, place, side="right") - 1
                        for a, d in set(zip(w.tolist(), doc.tolist())):
                            near[d].update(items[a])
                hit = sorted(spans.keys() | near.keys())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(batch.column("shard")[k], len(hit)),
                        pa.array(hit, pa.int32()),
                        pa.array([spans.get(d, []) for d in hit], pa.list_(pa.int32())),
                        pa.array([sorted(exact.get(d, ())) for d in hit], pa.list_(pa.string())),
                        pa.array([sorted(near.get(d, ())) for d in hit], pa.list_(pa.string())),
                    ],
                    names=["shard", "ord", "spans", "items", "near"],
                )

    return index.select("shard", "bases", "terms", "ptr", "positions").mapInArrow(probe, HITS)


def contamination(hits: DataFrame) -> DataFrame:
    """Per document: words hit (union of its spans), items, the 5 % rule, and items that match exactly or nearby."""

    def report(batches):
        for batch in batches:
            out = defaultdict(list)
            for doc, n, spans, items, near in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_words", "spans", "items", "near"))):
                cover, reach, spans = 0, 0, spans or []
                for s, e in sorted(zip(spans[::2], spans[1::2])):
                    cover += max(0, e - max(s, reach))
                    reach = max(reach, e)
                names = sorted(set(items or ()))
                out["doc_id"].append(doc)
                out["n_words"].append(n)
                out["n_hit"].append(cover)
                out["n_items"].append(len(names))
                out["items_sha256"].append(hashlib.sha256(",".join(names).encode()).hexdigest())
                out["contaminated"].append(cover > 0 and 20 * cover >= n)
                out["n_near_items"].append(len(set(near or ()) | set(names)))
            kinds = {"items_sha256": pa.string(), "contaminated": pa.bool_()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], names=list(out))

    return hits.mapInArrow(
        report,
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, n_near_items bigint",
    )


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, slop: int = SLOP, most: int = BLOCK_WINDOWS) -> DataFrame:
    """Build and store the index of ``docs``, search every test window, report every document."""
    path = fresh_dir(spark, "positional-index")
    build_index(docs).write.option("maxRecordsPerFile", SHARDS_PER_FILE).parquet(path)
    index = spark.read.parquet(path)
    found = fresh_dir(spark, "decontamination-hits")
    spark.createDataFrame([], HITS).write.parquet(found)
    for block in window_blocks(spark, benchmark, most):
        # what a block holds is bounded; its job is done before the next block is read
        search(index, block.toArrow(), slop).write.mode("append").parquet(found)
    of_doc = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near")]
    hits = spark.read.parquet(found).groupBy("shard", "ord").agg(*of_doc)
    every = index.select("shard", F.posexplode(F.arrays_zip("ids", "n_words")).alias("ord", "d"))
    every = every.select("shard", "ord", F.col("d.ids").alias("doc_id"), F.col("d.n_words").cast("bigint").alias("n_words"))
    return contamination(every.join(hits, ["shard", "ord"], "left").select("doc_id", "n_words", "spans", "items", "near"))
