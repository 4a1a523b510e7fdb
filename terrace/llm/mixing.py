"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

* Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and
  share a multiple of all words; a target stops at ``CAP`` times its source's
  size and the excess is shared again by weight.
* Every source's documents are permuted by a seeded hash and laid end to end; the
  stream (second pass behind the first) is cut into blocks of ``block_words``.
  The source's quota is its target in blocks, the last one cut short.
* A tree over the output shards splits the exact quotas: each node draws how many
  blocks of each source go left from the multivariate hypergeometric
  distribution, seeded by the node. A shard walks its own path from the root, so
  shards are computed independently, and the blocks counted off to the left on
  the way give its disjoint range of every source.
* The range goes through an affine permutation of the source's block numbers, and
  a shard's pieces are ordered by a seeded hash (the local shuffle).

Everything is a function of the seed, the documents and the parameters, so a rerun
or a retried task agrees. Cumulative sizes use two levels (hash buckets of about the
square root of the source's documents), so a source with a third of all rows is
never summed in one task. Only one row per source passes the driver.

Edge cases: a null text or source is size 0 or the source ``null``; documents
without words are kept by the query with 0 taken; repeated rows are documents of
their own; an empty table gives an empty mix. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 20260111
BLOCK_WORDS = 1024
SHARD_BLOCKS = 4096
MOST_BLOCKS = 500_000_000
#: Sources up to which their facts (some 60 bytes each) are broadcast; beyond, the planner decides.
BROADCAST_SOURCES = 10_000


def words_in(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


@dataclass(frozen=True)
class SourcePlan:
    source: str | None
    docs: int
    size: int
    target: float


def targets(sizes: list[tuple[str | None, int, int]], share: float = SHARE, cap: float = CAP) -> list[SourcePlan]:
    """Water-filling of ``share`` times all words over the sources (``(source, docs, words)``)."""
    order = sorted(sizes, key=lambda r: (r[0] is None, [ord(c) for c in r[0] or ""]))
    weight = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(order))]
    left, open_, out = share * sum(r[2] for r in order), set(range(len(order))), [0.0] * len(order)
    while open_:
        total = sum(weight[i] for i in open_)
        full = {i for i in open_ if left * weight[i] / total > cap * order[i][2]}
        if not full:
            for i in open_:
                out[i] = left * weight[i] / total
            break
        for i in full:
            out[i] = cap * order[i][2]
        left -= sum(out[i] for i in full)
        open_ -= full
    return [SourcePlan(s, n, size, t) for (s, n, size), t in zip(order, out)]


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``(first, count)`` of the blocks of every source that ``shard`` gets: one path down the tree."""
    have, first = quotas.astype(np.int64), np.zeros(len(quotas), dtype=np.int64)
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        total = int(have.sum())
        # blocks are dealt evenly: the left child's share of the node's blocks
        n_left = total * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.Philox(key=[seed, (lo << 32) | hi]))
        left = rng.multivariate_hypergeometric(have, n_left, method="marginals") if total else have * 0
        if shard < mid:
            have, hi = left, mid
        else:
            first, have, lo = first + left, have - left, mid
    return first, have


def _stride(n: int, seed: int) -> int:
    """A multiplier without a common factor with ``n``: ``i -> (a * i + b) mod n`` permutes the blocks."""
    from math import gcd

    a = (seed * 2654435761 + 97) % max(n, 1) or 1
    while gcd(a, n) != 1:
        a += 1
    return a


def mix(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """``(documents, mix)``.

    documents: row key, doc_id, source, size, source_size, target.
    mix: shard, place (order inside the shard), row key, pass, doc_id, source, from_word, n_words:
    words ``[from_word, from_word + n_words)`` of that document stand there.
    """
    from terrace.session import fresh_dir

    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        words_in(text_col).alias("size"),
        # rows are told apart by content and a number among equal rows
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("content"),
    )
    path = fresh_dir(spark, "mix-sizes")
    sized.write.parquet(path)
    sized = spark.read.parquet(path)
    per_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    plans = targets([(r["source"], r["n"], r["words"]) for r in per_source.collect()])
    if not plans:
        nothing = sized.select(F.lit(0).cast("bigint").alias("row"), "doc_id", "source", "size", F.lit(0).cast("bigint").alias("source_size"), F.lit(0.0).alias("target"))
        return nothing, nothing.select(F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("place"), "row", F.lit(0).alias("pass"), "doc_id", "source", F.lit(0).cast("bigint").alias("from_word"), F.lit(0).cast("bigint").alias("n_words"))
    takes = np.array([min(round(p.target), int(CAP * p.size)) for p in plans], dtype=np.int64)
    while takes.sum() // block_words > MOST_BLOCKS:  # the draw's own bound is 1e9 blocks
        block_words *= 2
    quotas = -(-takes // block_words)
    total = int(quotas.sum())
    shards = max(1, -(-total // shard_blocks))
    facts = spark.createDataFrame(
        [(i, p.source, p.size, p.target, int(t), max(1, int(p.docs**0.5))) for i, (p, t) in enumerate(zip(plans, takes))],
        "sid int, source string, source_size bigint, target double, take bigint, buckets int",
    )

    # permuted stream of every source: (bucket, hash) order, with two-level cumulative sizes
    known = sized.join(F.broadcast(facts) if len(plans) <= BROADCAST_SOURCES else facts, sized["source"].eqNullSafe(facts["source"])).drop(facts["source"])
    order = F.xxhash64("content", F.lit(seed))
    known = known.withColumn("rank", order).withColumn("bucket", F.pmod(F.xxhash64("rank", F.lit(1)), F.col("buckets")))
    by_bucket = known.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_words"), F.count(F.lit(1)).alias("bucket_docs"))
    ahead = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.select(
        "sid",
        "bucket",
        F.coalesce(F.sum("bucket_words").over(ahead), F.lit(0)).alias("bucket_from"),
        F.coalesce(F.sum("bucket_docs").over(ahead), F.lit(0)).alias("docs_before"),
    )
    inside = Window.partitionBy("sid", "bucket").orderBy("rank", "doc_id", "content", "size")
    stream = known.withColumns(
        {
            "words_before": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"),
            "number": F.row_number().over(inside),
        }
    ).join(offsets, ["sid", "bucket"])
    stream = stream.select(
        ((F.col("docs_before") + F.col("number")) * F.lit(len(plans)) + F.col("sid")).alias("row"),
        "sid", "doc_id", "source", "size", "source_size", "target", "take",
        (F.col("bucket_from") + F.col("words_before")).alias("at"),
    )
    path = fresh_dir(spark, "mix-stream")
    stream.write.parquet(path)
    stream = spark.read.parquet(path)

    # pieces of documents by block, over both passes of the stream
    b = F.lit(block_words)
    ends = stream.filter("size > 0").withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("s", F.col("at") + F.col("pass") * F.col("source_size"))
    ends = ends.withColumn("e", F.least(F.col("s") + F.col("size"), "take")).filter("s < e")
    blocks_of = F.sequence(F.floor(F.col("s") / b), F.floor((F.col("e") - 1) / b))
    pieces = ends.withColumn("block", F.explode(blocks_of))
    pieces = pieces.select(
        "row", "pass", "sid", "doc_id", "source", "block",
        (F.greatest("s", F.col("block") * b) - F.col("s")).alias("from_word"),
        (F.least("e", (F.col("block") + 1) * b) - F.greatest("s", F.col("block") * b)).alias("n_words"),
    )

    strides = [_stride(int(q), seed + i) for i, q in enumerate(quotas)]

    def draw(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, count = shard_quotas(quotas, shards, shard, seed)
                sid = np.repeat(np.arange(len(count)), count)
                nth = np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)]) if len(sid) else sid
                q = quotas[sid] if len(sid) else sid
                block = np.array([(strides[s] * int(i) + seed) % int(m) for s, i, m in zip(sid, nth, q)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sid), shard), pa.int32()), pa.array(sid, pa.int32()), pa.array(block, pa.int64())],
                    names=["shard", "sid", "block"],
                )

    drawn = spark.range(0, shards, numPartitions=min(shards, 256)).mapInArrow(draw, "shard int, sid int, block bigint")
    # the planner sees only the few shard numbers that `drawn` is made from and would broadcast all blocks
    mixed = pieces.join(drawn.hint("merge"), ["sid", "block"]).select(
        "shard",
        F.xxhash64(F.lit(seed), "shard", "sid", "block").alias("place"),
        "row", "pass", "doc_id", "source", "from_word", "n_words",
    )
    documents = stream.select("row", "doc_id", "source", "size", "source_size", "target")
    return documents, mixed


def taken(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    words = mixed.groupBy("row").agg(F.sum("n_words").alias("words"))
    return documents.join(words, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("bigint").alias("taken")
    )
