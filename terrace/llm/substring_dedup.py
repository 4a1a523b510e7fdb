"""Substring dedup by level-wise doubling over content-defined anchors.

A window is ``width`` consecutive words of one document; every word covered by a
window that also starts anywhere else is removed.

1. Anchors. Every window holds ``width - GRAM + 1`` short grams; the one of least
   hash (leftmost on ties) is its anchor. Equal windows have equal anchors at equal
   offsets, and neighbouring windows mostly share theirs, so about one word in 14 is
   an anchor. Anchors are counted over all documents; a window whose anchor stands
   once is unique and goes no further.
2. Level ``width``. The windows of one anchor form a run. Equal runs are summed
   first (thousands of copies become one row), then windows of different runs of an
   anchor are compared by offset and hash.
3. Levels ``2 * width``, ``4 * width``, ...: from the anchors of repeated runs the
   window of twice the length is looked up; those repeated at one level alone go to
   the next, until none survives. The last level of a document is reported.
4. Words under repeated windows are taken out of the whole text.

Window hashes have 64 bits beside the 64 bits of their anchor, whose offset must
agree too. Only hashes and positions are shuffled up to the last step.

Edge cases: null and empty texts have no words; texts shorter than a window keep
everything; rows with equal id and text are repeats of each other; a null doc_id is
an id of its own; an empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm import words as W
from terrace.session import fresh_dir

WIDTH = 35
GRAM = 9


class Runs:
    """Anchors of a slice and the run of windows of each."""

    def __init__(self, cut: W.Words, width: int):
        n = cut.counts
        self.sums = W.prefix_sums(cut.hash, 1)
        total = len(cut.hash)
        starts = W.ragged(cut.ptr[:-1], np.maximum(n - width + 1, 0))
        self.anchor = self.first = self.length = np.zeros(0, np.int64)
        self.grams = np.zeros(0, np.uint64)
        if not len(starts):
            self.row = np.zeros(0, np.int64)
            return
        at = np.arange(total - GRAM + 1)
        grams = W.span_hash(self.sums, at, at + GRAM, 1)
        bits = np.uint64(max(1, int(total).bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        best = (grams & ~low) | at.astype(np.uint64)
        # sliding minimum over the grams of a window, by doubling
        reach, need = 1, width - GRAM + 1
        while reach * 2 <= need:
            best = np.minimum(best[: len(best) - reach], best[reach:])
            reach *= 2
        if reach < need:
            best = np.minimum(best[: len(best) - (need - reach)], best[need - reach :])
        anchor = (best[starts] & low).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        self.anchor, self.first = anchor[cuts], starts[cuts]
        self.length = np.diff(np.append(cuts, len(starts)))
        self.row = np.searchsorted(cut.ptr, self.first, side="right") - 1
        self.grams = grams[self.anchor]


def anchor_counts(docs: DataFrame, width: int) -> DataFrame:
    """``anchor``: grams that are anchors at two places at least."""

    def run(batches):
        for _, cut in W.cut_batches(batches, W.SPACED):
            g, n = np.unique(Runs(cut, width).grams, return_counts=True)
            yield pa.RecordBatch.from_arrays([W.longs(g), W.longs(n)], names=["anchor", "n"])

    found = docs.select("text").mapInArrow(run, "anchor bigint, n bigint")
    return found.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")


def document_anchors(docs: DataFrame, width: int) -> DataFrame:
    """``key, anchor``: different anchors of every document."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.SPACED):
            runs = Runs(cut, width)
            order = np.lexsort((runs.grams, runs.row))
            g, r = runs.grams[order], runs.row[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(r[new])), W.longs(g[new])], names=["key", "anchor"])

    return docs.select("key", "text").mapInArrow(run, "key bigint, anchor bigint")


RUNS = "key bigint, th bigint, anchor bigint, rk bigint, start int, off int, hashes array<bigint>, levels array<bigint>"


def candidate_runs(docs: DataFrame, width: int) -> DataFrame:
    """Runs of repeated anchors: identity, place, window hashes, and hashes of the doubled windows."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.SPACED):
            runs = Runs(cut, width)
            lists = part.column(part.schema.get_field_index("anchors"))
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            known = W.mix(lists.flatten().to_numpy().view(np.uint64) + owner.astype(np.uint64))
            mine = np.isin(W.mix(runs.grams + runs.row.astype(np.uint64)), known)
            a, first, n, row = runs.anchor[mine], runs.first[mine], runs.length[mine], runs.row[mine]
            at = W.ragged(first, n)
            hashes = W.span_hash(runs.sums, at, at + width, 1)
            ptr = np.concatenate([[0], np.cumsum(n)])
            off = a - first
            rk = W.mix(W.span_hash(W.prefix_sums(hashes, 2), ptr[:-1], ptr[1:], 2) + off.astype(np.uint64))
            end, levels, size = cut.ptr[1:][row], [], 2 * width
            while len(a) and (a + size <= end).any():
                fits = np.flatnonzero(a + size <= end)
                levels.append((fits, W.span_hash(runs.sums, a[fits], a[fits] + size, 1)))
                size *= 2
            owners = np.concatenate([f for f, _ in levels]) if levels else np.zeros(0, np.int64)
            flat = np.concatenate([h for _, h in levels]) if levels else np.zeros(0, np.uint64)
            order = np.argsort(owners, kind="stable")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(row)),
                    part.column(1).take(pa.array(row)),
                    W.longs(runs.grams[mine]),
                    W.longs(rk),
                    pa.array((first - cut.ptr[:-1][row]).astype(np.int32)),
                    pa.array(off.astype(np.int32)),
                    W.list_of(hashes, ptr, pa.int64()),
                    W.list_of(flat[order], np.searchsorted(owners[order], np.arange(len(a) + 1)), pa.int64()),
                ],
                names=[c.split()[0] for c in RUNS.split(", ")],
            )

    return docs.select("key", "th", "anchors", "text").mapInArrow(run, RUNS)


def repeated_windows(runs: DataFrame) -> DataFrame:
    """``anchor, rk, places``: which windows of a run are repeated (null: all of them)."""
    kinds = runs.groupBy("anchor", "rk").agg(F.count(F.lit(1)).alias("n"), F.first("off").alias("off"), F.first("hashes").alias("hashes"))
    kinds = kinds.withColumn("variants", F.count(F.lit(1)).over(Window.partitionBy("anchor")))
    same = kinds.filter("variants = 1 and n > 1").select("anchor", "rk", F.lit(None).cast("array<int>").alias("places"))
    each = kinds.filter("variants > 1").select("anchor", "rk", "n", "off", F.posexplode("hashes").alias("i", "h"))
    each = each.withColumn("total", F.sum("n").over(Window.partitionBy("anchor", F.col("off") - F.col("i"), "h")))
    some = each.filter("total > 1").groupBy("anchor", "rk").agg(F.collect_list("i").alias("places"))
    return same.unionByName(some)


def deepest_level(spark: SparkSession, hits: DataFrame) -> DataFrame:
    """``key, th, level``: how often a repeated window of a document could be doubled and still repeat."""
    now = hits.select("key", "th", "levels")
    out, level = now.select("key", "th", F.lit(0).alias("level")), 0
    while True:
        # the levels that are done are cut off, so each round writes less
        fits = now.filter(F.size("levels") > 0).select("key", "th", F.col("levels")[0].alias("h"), F.slice("levels", 2, F.size("levels")).alias("levels"))
        twice = fits.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
        path = fresh_dir(spark, "dedup-level")
        fits.join(twice, "h").select("key", "th", "levels").write.parquet(path)
        now = spark.read.parquet(path)
        if now.isEmpty():
            return out.groupBy("key", "th").agg(F.max("level").alias("level"))
        level += 1
        out = out.unionByName(now.select("key", "th", F.lit(level).alias("level")))


OUT = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string, levels int"


def remove(docs: DataFrame, width: int) -> DataFrame:
    """Take the words under repeated windows (``starts``) out of every text."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.SPACED):
            starts = part.column(part.schema.get_field_index("starts"))
            ids, levels = (part.column(part.schema.get_field_index(c)) for c in ("doc_id", "level"))
            kept, removed = [], []
            data = cut.data.tobytes()
            for i in range(part.num_rows):
                words = data[cut.row_start[i] : cut.row_start[i + 1]].split()
                gone = 0
                if starts[i].is_valid:
                    at = np.asarray(starts[i].values)
                    cover = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.minimum(at + width, len(words)), -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    words = [words[k] for k in np.flatnonzero(keep)]
                kept.append(b" ".join(words))
                removed.append(gone)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    W.longs(cut.counts),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    levels,
                ],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    return docs.select("doc_id", "level", "starts", "text").mapInArrow(run, OUT)


def dedup(spark: SparkSession, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256, levels`` for every row of ``docs`` (doc_id, text)."""
    least = F.lit(-(1 << 63)).cast("bigint")
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), least).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    owned = document_anchors(keyed, width).join(anchor_counts(keyed, width), "anchor")
    anchors = owned.groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    path = fresh_dir(spark, "dedup-runs")
    candidate_runs(keyed.join(anchors, "key"), width).write.parquet(path)
    runs = spark.read.parquet(path)

    places = F.coalesce(F.transform("places", lambda i: F.col("start") + i), F.sequence("start", F.col("start") + F.col("n") - 1))
    placed = runs.select("key", "th", "anchor", "rk", "start", F.size("hashes").alias("n"), "levels").join(repeated_windows(runs), ["anchor", "rk"])
    path = fresh_dir(spark, "dedup-hits")
    placed.select("key", "th", "levels", places.alias("starts")).write.parquet(path)
    hits = spark.read.parquet(path)
    spans = hits.groupBy("key", "th").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    known = spans.join(deepest_level(spark, hits), ["key", "th"])
    return remove(keyed.join(known, ["key", "th"], "left").withColumn("level", F.coalesce(F.col("level") + 1, F.lit(0))), width)
