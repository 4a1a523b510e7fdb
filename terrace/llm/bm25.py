"""Exact top-k BM25 search: inverted index shards with block-max dynamic pruning.

``build_index`` writes one row per shard (a bounded slice of documents, ordered so
that alike documents share blocks): postings by term. ``search`` runs blocks of queries
over every shard, some queries at a time, several blocks a pass. The postings of a query's rare terms are summed
for every document; frequent terms are rows of a matrix for each section of a shard, and
their maxima over a block of ``BLOCK_DOCS`` documents, added to the block's best sum so
far, bound what the block can reach. Only blocks whose bound is not below the query's k-th
best score so far get the frequent terms of every document, as one product of matrices (in
single precision), the sections of long documents first. Documents that can be among the
best by that sum, with the error it can have, are summed again exactly. The k-th best score
is carried from shard to shard of a task; the shards' answers are merged exactly, since term
weights use global statistics (documents, mean length, document frequencies) counted over
all documents.

Every query is a whole text that shares words with most documents, so the work grows
with queries times documents; a task holds one shard and the queries of one pass over the index at a time.

Scores are ``sum idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))`` with
``idf = ln(1 + (N - df + 0.5) / (df + 0.5))`` over the query's different words. Ties
go to the smaller doc_id. Weights of a term are summed in the order of its hash, so
equal texts score equally.

Edge cases: null or empty texts match nothing and, as queries, give no row; a
document that shares no word with the query is never reported; a null doc_id sorts
last; repeated documents are reported each. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm import words as W
from terrace.session import fresh_dir

K1 = 1.2
B = 0.75
TOP_K = 10
#: Documents that are opened or left out together for a query.
BLOCK_DOCS = 32
#: Blocks of a product of matrices.
STEP_BLOCKS = 4
#: Documents of a shard that share their commonest word, to be put apart from the others.
LEAD_DOCS = 64
#: Documents that have frequent terms of their own: those in more than a share of them.
SECTION_DOCS = 512
FREQUENT = 0.08
#: Queries that are scored together over a shard, and of these whose postings are summed together.
BATCH_QUERIES = 256
PART_QUERIES = 8
#: Common words and main directions of them by which queries are put in order.
COMMON = 64
DIRECTIONS = 3
#: Text and documents of a shard.
SHARD_BYTES = 16 << 20
SHARD_DOCS = 8192
SHARDS_PER_FILE = 4
#: Different (query, word) pairs that come to the driver at once (24 bytes each).
BLOCK_TERMS = 2_000_000
#: The same of one pass over the index: bounds what a task is sent (4 bytes each, 16 a different word).
PASS_TERMS = 6_000_000

INDEX = "ids array<bigint>, lengths array<int>, terms array<bigint>, ptr array<int>, docs array<int>, tfs array<int>"


def _group(batches):
    """Slices of about SHARD_BYTES of text or SHARD_DOCS documents, joined over batches of a task; a small rest goes to the last of them."""
    full, held, size, docs = [], [], 0, 0
    for batch in batches:
        col = batch.column(batch.schema.get_field_index("text"))
        for lo, hi in W.slices(col):
            for at in range(lo, hi, SHARD_DOCS // 4):
                part = batch.slice(at, min(hi - at, SHARD_DOCS // 4))
                held.append(part)
                size += part.nbytes
                docs += part.num_rows
                if size >= SHARD_BYTES or docs >= SHARD_DOCS:
                    if full:
                        yield full
                    full, held, size, docs = held, [], 0, 0
    if full and 4 * size < SHARD_BYTES and 4 * docs < SHARD_DOCS:
        full, held = full + held, []
    yield from (x for x in (full, held) if x)


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of ``docs`` (doc_id, text), a row per shard."""

    def run(batches):
        for parts in _group(batches):
            ids, lengths, words, owner, base = [], [], [], [], 0
            for part in parts:
                cut = W.cut(part.column(1), W.ALNUM_LOWER)
                ids += part.column(0).to_pylist()
                lengths.append(cut.counts)
                words.append(cut.hash)
                owner.append((cut.rows() + base).astype(np.int32))
                base += part.num_rows
            h, doc, n = np.concatenate(words), np.concatenate(owner), np.concatenate(lengths)
            del words, owner, cut  # else they count once more in the sort
            # alike documents next to each other: by commonest word (a proxy of language) where some share it, then length
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            tf = np.diff(np.append(at, len(h)))
            h, doc = h[at], doc[at]
            lead = np.zeros(base, dtype=np.uint64)
            rank = np.argsort(tf, kind="stable")
            lead[doc[rank]] = h[rank]
            _, lead, led = np.unique(lead, return_inverse=True, return_counts=True)
            lead = np.where(led[lead] < LEAD_DOCS, len(led), lead)
            place = np.empty(base, dtype=np.int64)
            place[np.lexsort((n, lead))] = np.arange(base)
            doc = place[doc]
            order = np.lexsort((doc, h))
            h, doc, tf = h[order], doc[order], tf[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            back = np.argsort(place)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([[ids[i] for i in back.tolist()]], pa.list_(pa.int64())),
                    pa.array([n[back].astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([h[first].view(np.int64)], pa.list_(pa.int64())),
                    pa.array([np.append(first, len(h)).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([doc.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([tf.astype(np.int32)], pa.list_(pa.int32())),
                ],
                names=["ids", "lengths", "terms", "ptr", "docs", "tfs"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, INDEX)


def document_frequencies(index: DataFrame) -> DataFrame:
    """``(term, df)`` over the whole index."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ptr = batch.column(1)[k].values.to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(0)[k].values, W.longs(np.diff(ptr))], names=["term", "df"])

    rows = index.select("terms", "ptr").mapInArrow(run, "term bigint, df bigint")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query, term)``: the different words of every query."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER):
            ids = np.array(part.column(0).to_pylist(), dtype=np.int64)
            rows = cut.rows()
            order = np.lexsort((cut.hash, rows))
            h, r = cut.hash[order], rows[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
            yield pa.RecordBatch.from_arrays([W.longs(ids[r[new]]), W.longs(h[new])], names=["query", "term"])

    kind = "query bigint, term bigint"
    return queries.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, kind).distinct()


class Shard:
    """One shard with the weights of the global statistics: postings by term and by document, and frequent terms of its sections as matrices."""

    def __init__(self, row: dict[str, np.ndarray], vocabulary: np.ndarray, idf: np.ndarray, mean: float):
        at = np.minimum(np.searchsorted(vocabulary, row["terms"].view(np.uint64)), max(len(vocabulary) - 1, 0))
        known = vocabulary[at] == row["terms"].view(np.uint64) if len(vocabulary) else np.zeros(len(row["terms"]), bool)
        n = np.diff(row["ptr"])[known]
        pick = W.ragged(row["ptr"][:-1][known], n)
        self.vocabulary = at[known]  # place in the query vocabulary, ascending
        self.place = np.full(len(vocabulary), -1, np.int32)  # the way back
        self.place[self.vocabulary] = np.arange(len(n))
        self.doc, tf = row["docs"][pick], row["tfs"][pick].astype(float)
        norm = K1 * (1 - B + B * row["lengths"] / mean)
        self.term = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.weight = np.repeat(idf[self.vocabulary], n) * tf * (K1 + 1) / (tf + norm[self.doc])
        self.n_docs = len(row["lengths"])
        self.n_blocks = -(-self.n_docs // BLOCK_DOCS)
        # the postings of every document, by term
        by_doc = np.argsort(self.doc.astype(np.uint16) if self.n_docs <= 1 << 16 else self.doc, kind="stable")
        self.doc_ptr = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=self.n_docs))])
        self.doc_term, self.doc_weight = self.term[by_doc], self.weight[by_doc]
        # frequent terms of a section: a row each, a column a document
        starts = np.arange(0, self.n_docs, SECTION_DOCS)
        section = self.doc // SECTION_DOCS
        new = np.ones(len(section), bool)
        new[1:] = (self.term[1:] != self.term[:-1]) | (section[1:] != section[:-1])
        run = np.flatnonzero(new)
        length = np.diff(np.append(run, len(section)))
        many = length > FREQUENT * np.diff(np.append(starts, self.n_docs))[section[run]]
        inside = np.repeat(many, length)
        run, length = run[many], length[many]
        order = np.argsort(section[run], kind="stable")
        self.cuts = np.searchsorted(section[run][order], np.arange(len(starts) + 1))  # rows of each section
        row_of = np.empty(len(run), np.int64)
        row_of[order] = np.arange(len(run))
        self.matrix = np.zeros((len(run), SECTION_DOCS), np.float32)
        self.matrix[np.repeat(row_of, length), self.doc[inside] % SECTION_DOCS] = self.weight[inside]
        self.most = self.matrix.reshape(len(run), SECTION_DOCS // BLOCK_DOCS, BLOCK_DOCS).max(axis=2)
        frequent, column = np.unique(self.term[run[order]], return_inverse=True)
        self.columns, self.n_columns = column, len(frequent)  # of each row, among the shard's frequent terms
        self.column = np.full(len(n), -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        # long documents first: they have the best scores
        self.sections = np.argsort(-np.add.reduceat(row["lengths"], starts) / np.diff(np.append(starts, self.n_docs))) if self.n_docs else starts
        # the other postings, weight and document side by side
        rare = ~inside
        pair = np.empty((np.count_nonzero(rare), 2), np.float32)
        pair[:, 0] = self.weight[rare]
        pair.view(np.int32)[:, 1] = self.doc[rare]
        self.rare = pair.view(np.int64).ravel()
        self.size = np.bincount(self.term[rare], minlength=len(n))
        self.first = np.cumsum(self.size) - self.size
        # sums in single precision are off by less than this share, as no weight is below zero
        self.slack = (max(np.diff(self.cuts), default=0) + 8) * 2.0**-22
        self.opened = 0  # blocks that were not left out so far, over all queries

    def _rare(self, term: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Sums over the postings outside the matrices for queries of terms ``term[cuts[i] : cuts[i + 1]]``, posting by posting."""
        n, width = len(cuts) - 1, self.n_blocks * BLOCK_DOCS
        out = np.zeros((n, width), np.float32)
        size = self.size[term]
        some = size > 0
        cuts = np.concatenate([[0], np.cumsum(some)])[cuts]
        size, first = size[some], self.first[term[some]]
        total = np.concatenate([[0], np.cumsum(size)])
        step = first.copy()
        step[1:] -= first[:-1] + size[:-1] - 1  # from the end of one list to the next
        parts = [(lo, min(lo + PART_QUERIES, n)) for lo in range(0, n, PART_QUERIES)]
        # one set of arrays for all parts
        most = max((total[cuts[hi]] - total[cuts[lo]] for lo, hi in parts), default=0)
        cells, pairs, weights = np.empty(most, np.int64), np.empty(most, np.int64), np.empty(most)
        for lo, hi in parts:
            a, e = cuts[lo], cuts[hi]
            if a == e:
                continue
            ends = total[cuts[lo : hi + 1]] - total[a]
            cell, pair, weight = cells[: ends[-1]], pairs[: ends[-1]], weights[: ends[-1]]
            cell.fill(1)
            cell[total[a:e] - total[a]] = step[a:e]
            cell[0] = first[a]
            np.cumsum(cell, out=cell)
            np.take(self.rare, cell, out=pair, mode="clip")
            halves = pair.view(np.int32).reshape(-1, 2)
            cell[:], weight[:] = halves[:, 1], halves.view(np.float32)[:, 0]
            for i in range(1, hi - lo):
                cell[ends[i] : ends[i + 1]] += i * width
            out[lo:hi] = np.bincount(cell, weight, minlength=(hi - lo) * width).reshape(hi - lo, width)
        return out

    def top(self, terms: np.ndarray, owner: np.ndarray, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, document (place in the shard) and score of all that can be among the best ``k`` of a query with at least its floor.

        ``terms`` are those of a batch of queries, ``owner`` the query of each (ascending); ``floors`` has one for every query.
        """
        n, under = len(floors), 1 - self.slack
        term = self.place[terms]
        found = term >= 0
        term, query = term[found], owner[found]
        cuts = np.searchsorted(query, np.arange(n + 1))
        about = self._rare(term, cuts)
        cells = about.reshape(n, self.n_blocks, BLOCK_DOCS)
        tops = cells.max(axis=2)  # from below: the frequent terms are still to come
        column = self.column[term]
        has = np.zeros((n, self.n_columns), np.float32)
        has[query[column >= 0], column[column >= 0]] = 1
        floors = self._raise(floors, tops, k)
        for s in self.sections.tolist():
            rows = slice(self.cuts[s], self.cuts[s + 1])
            if rows.start == rows.stop:
                continue
            base = s * (SECTION_DOCS // BLOCK_DOCS)
            size = min(SECTION_DOCS // BLOCK_DOCS, self.n_blocks - base)
            mine = has.take(self.columns[rows], axis=1)
            bound = (tops[:, base : base + size] + mine @ self.most[rows, :size]) * (1 + self.slack)
            opened = (bound >= floors[:, None] * under) & (bound > 0)
            self.opened += np.count_nonzero(opened)
            for b in range(0, size, STEP_BLOCKS):
                e = min(b + STEP_BLOCKS, size)
                q = np.flatnonzero(opened[:, b:e].any(axis=1))
                if len(q):
                    sums = mine[q] @ self.matrix[rows, b * BLOCK_DOCS : e * BLOCK_DOCS]
                    sums = sums.reshape(len(q), e - b, BLOCK_DOCS)
                    sums += cells[q, base + b : base + e]
                    cells[q, base + b : base + e], tops[q, base + b : base + e] = sums, sums.max(axis=2)
            floors = self._raise(floors, tops, k, slice(base, base + size))
        q, b = np.nonzero((tops >= floors[:, None] * under) & (tops > 0))
        near = cells[q, b]
        at, doc = np.nonzero((near >= floors[q, None] * under) & (near > 0))
        q, doc, near = q[at], b[at] * BLOCK_DOCS + doc, near[at, doc]
        # the k-th best of these, too, is a floor
        order = np.lexsort((-near, q))
        q, doc, near = q[order], doc[order], near[order]
        first, size = np.searchsorted(q, np.arange(n)), np.bincount(q, minlength=n)
        full = np.flatnonzero(size >= k)
        floors = floors.copy()
        floors[full] = np.maximum(floors[full], near[first[full] + k - 1] * under)
        keep = near >= floors[q] * under
        q, doc = q[keep], doc[keep]
        score = self._exact(term, cuts, q, doc)
        keep = score >= floors[q] * under
        return q[keep], doc[keep], score[keep]

    def _raise(self, floors: np.ndarray, tops: np.ndarray, k: int, blocks: slice = slice(None)) -> np.ndarray:
        """Floors after more is known of ``blocks``: as many blocks as documents asked for have a document with such a score."""
        if self.n_blocks < k:
            return floors
        q = np.flatnonzero(tops[:, blocks].max(axis=1) > floors)
        floors = floors.copy()
        floors[q] = np.maximum(floors[q], np.partition(tops[q], -k, axis=1)[:, -k] * (1 - self.slack))
        return floors

    def _exact(self, term: np.ndarray, cuts: np.ndarray, q: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Scores of documents ``doc`` for queries ``q``: weights summed by term."""
        score = np.zeros(len(q))
        for i, (a, e, first, last) in enumerate(zip(cuts[q].tolist(), cuts[q + 1].tolist(), self.doc_ptr[doc].tolist(), self.doc_ptr[doc + 1].tolist())):
            wanted, have = term[a:e], self.doc_term[first:last]
            at = np.minimum(have.searchsorted(wanted), len(have) - 1)
            weight = self.doc_weight[first:last][at[have[at] == wanted]]
            score[i] = weight.cumsum()[-1] if len(weight) else 0
        return score


def _block(terms: DataFrame, blocks: int, b: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray, np.ndarray]:
    """Queries of one block (places of their words, ascending), the block's different words and their weights."""
    rows = terms.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).toArrow()
    q, t = rows.column("query").to_numpy(), rows.column("term").to_numpy().view(np.uint64)
    words, first, place = np.unique(t, return_index=True, return_inverse=True)
    idf = rows.column("idf").to_numpy()[first]
    order = np.lexsort((place, q))
    q, place = q[order], place[order].astype(np.int32)
    cuts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else []
    return [(int(q[a]), place[a:e]) for a, e in zip(cuts, np.append(cuts[1:], len(q)))], words, idf


def alike(block: list[tuple[int, np.ndarray]], idf: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The queries, those with the same common words (of one language, say) next to each other: they read the same postings and blocks."""
    column = np.full(len(idf), -1)
    common = np.argsort(idf, kind="stable")[:COMMON]
    column[common] = np.arange(len(common))
    has = np.zeros((len(block), len(common)))
    for i, (_, terms) in enumerate(block):
        at = column[terms]
        has[i, at[at >= 0]] = 1
    has -= has.mean(axis=0)
    axes = np.linalg.eigh(has.T @ has)[1][:, -DIRECTIONS:]
    side = (has @ axes > 0) @ (1 << np.arange(axes.shape[1]))
    return [block[i] for i in np.lexsort(([len(terms) for _, terms in block], side)).tolist()]


def search(index: DataFrame, block: list[tuple[int, np.ndarray]], vocabulary: np.ndarray, idf: np.ndarray, mean: float, k: int) -> DataFrame:
    """Best ``k`` of every task's shards for the queries of one pass (term places in ``vocabulary``)."""
    last = np.iinfo(np.int64).max
    sent = index.sparkSession.sparkContext.broadcast((block, vocabulary, idf))  # within the function a worker would hold it twice

    def run(batches):
        block, vocabulary, idf = sent.value
        # best so far: a row for every query, places that are still free with a score of 0
        best_ids, best = np.full((len(block), k), last), np.zeros((len(block), k))
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values for n in ("ids", "lengths", "terms", "ptr", "docs", "tfs")}
                ids = row.pop("ids").fill_null(last).to_numpy(zero_copy_only=False)
                shard = Shard({n: v.to_numpy(zero_copy_only=False) for n, v in row.items()}, vocabulary, idf, mean)
                for lo in range(0, len(block), BATCH_QUERIES):
                    part = [terms for _, terms in block[lo : lo + BATCH_QUERIES]]
                    n = len(part)
                    owner = np.repeat(np.arange(n), [len(t) for t in part])
                    q, doc, score = shard.top(np.concatenate(part), owner, k, best[lo : lo + n, -1])
                    if len(q):
                        who = np.concatenate([np.repeat(np.arange(n), k), q])
                        all_ids, scores = np.concatenate([best_ids[lo : lo + n].ravel(), ids[doc]]), np.concatenate([best[lo : lo + n].ravel(), score])
                        order = np.lexsort((all_ids, -scores, who))
                        first = np.searchsorted(who[order], np.arange(n))
                        keep = order[first[:, None] + np.arange(k)]
                        best_ids[lo : lo + n], best[lo : lo + n] = all_ids[keep], scores[keep]
        names = np.array([q for q, _ in block], dtype=np.int64)
        at, place = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(best_ids[at, place]), pa.array(best[at, place])], names=["query", "match", "score"])

    # a task for every core, however large the index: what tasks return and carry along grows with the queries alone
    tasks = index.sparkSession.sparkContext.defaultParallelism
    return index.coalesce(tasks).mapInArrow(run, "query bigint, match bigint, score double")


def top_k(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """``query, rank, match, score``: the exact best ``k`` documents of ``docs`` for every row of ``queries``."""
    W.bound_batches(spark)  # a shard at a time
    path = fresh_dir(spark, "bm25-index")
    build_index(docs).write.option("maxRecordsPerFile", SHARDS_PER_FILE).parquet(path)
    index = spark.read.parquet(path)
    n, words = index.select(F.sum(F.size("lengths")), F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()
    mean = (words or 0) / max(n or 0, 1) or 1.0
    terms = query_terms(queries.filter("doc_id is not null")).join(document_frequencies(index), "term")
    idf = F.log(1 + (F.lit(n or 0) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    path = fresh_dir(spark, "bm25-queries")
    terms.select("query", "term", idf.alias("idf")).repartitionByRange("query").sortWithinPartitions("query", "term").write.parquet(path)
    terms = spark.read.parquet(path)
    # queries in blocks of bounded size, as many as a pass over the index takes
    sizes = terms.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    blocks, passes = max(1, -(-total // BLOCK_TERMS)), max(1, -(-total // PASS_TERMS))
    out = []
    for numbers in np.array_split(np.arange(blocks), min(passes, blocks)):
        parts = [_block(terms, blocks, int(b)) for b in numbers]
        vocabulary, first = np.unique(np.concatenate([words for _, words, _ in parts]), return_index=True)
        weights = np.concatenate([idf for _, _, idf in parts])[first]
        block = []
        for part, words, _ in parts:
            to = np.searchsorted(vocabulary, words).astype(np.int32)
            block += [(q, to[place]) for q, place in part]
        del parts
        if block:
            path = fresh_dir(spark, "bm25-found")
            search(index, alike(block, weights), vocabulary, weights, mean, k).write.parquet(path)
            out.append(spark.read.parquet(path))
    if not out:
        return spark.createDataFrame([], "query bigint, rank int, match bigint, score double")
    found = reduce(DataFrame.unionByName, out)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "match")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    match = F.when(F.col("match") != F.lit(int(np.iinfo(np.int64).max)), F.col("match"))
    return ranked.select("query", "rank", match.alias("match"), "score")
