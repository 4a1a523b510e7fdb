"""N-gram Jaccard join by a token-group matrix, and the components of its links.

Documents are sets of hashed word shingles; two link when the Jaccard similarity of
their sets reaches ``threshold`` (a fraction of whole hundredths).

1. Equal sets are one class (its id: the smallest doc_id). What follows works on one
   row per class, so thousands of copies cost one row.
2. Two linked sets of a size band differ in at most ``D`` tokens. The token space is cut
   into ``M = D + 1 + D / 4`` parts by hash, so the two agree in ``M - D`` parts at least: the
   tokens of a part, as one key, are the matrix's columns. (Single shingles of a passage
   that many documents share would open group after group; only sets of up to ``SMALL``
   tokens, whose parts would often be empty, have their tokens as columns.) A set looks
   in the columns of its own band and of the next. Keys are dealt and sorted once, and
   only those that stand in two rows go on.
3. A set that has fewer such columns than it must share with any set it links to is done
   with. Of the others the last ``asked - 1`` columns, by how often they stand, are left out
   of the search on both sides: of the columns that two linked sets share, the rarest is
   still there. So a column that very many sets share opens nothing.
4. Sets that share enough columns with the same most central class form a group, so a
   family of near copies falls into few. The token-group matrix holds the union of a
   group's columns. A set meets a group by its rare columns; what it shares with the whole
   union bounds from above what it shares with any member, and only groups where that is
   as much as it asks for are opened. (Parts without a token are equal for all sets that
   lack it: a set counts without them and asks for that many less. Where that would leave
   it nothing to ask for, it searches with them too.)
   A parity bitmap of the whole set (two bits a token) then bounds the difference of
   two sets from below: a class stays in a group only if some set there is not ruled
   out by it. Only then are whole sets sent anywhere.
5. In an opened group the exact similarity of every pair is computed from whole sets,
   in cells of at most ``CELL`` sets a side. A link is counted in the group of the
   larger of its two classes (by size, then id), which the smaller one always opens:
   every link counts once, whether or not other links join the two already. A cell
   returns a number for each of its classes and the links that join it, never all pairs.
6. Joining links (by class) go to connected components. A document's links are the other
   documents of its class and those of all classes that link to it.

Edge cases: null and empty texts and texts without words have no shingle and stand
alone; texts of fewer words than a shingle are one shingle; rows that share a doc_id
are one document; rows with a null doc_id are classed with equal sets only (component
null if none has an id) and have no number of links. A document whose id stands with
several texts counts once for each of their classes. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm import words as W
from terrace.llm.components import components
from terrace.session import drop_dirs, fresh_dir

SHINGLE = 3
PERCENT = 90
CELL = 512
#: Sets up to this size have their tokens as columns.
SMALL = 128
#: The band that stands for all of these.
TOKENS = -1


class Sets:
    """Sorted distinct shingle hashes of every row of a slice."""

    def __init__(self, cut: W.Words, width: int):
        starts, hashes = cut.windows(width)
        n = cut.counts
        short = np.flatnonzero((n > 0) & (n < width))
        sums = W.prefix_sums(cut.hash, 1)
        whole = W.span_hash(sums, cut.ptr[:-1][short], cut.ptr[1:][short], 1)
        rows = np.concatenate([np.searchsorted(cut.ptr, starts, side="right") - 1, short])
        h = np.concatenate([hashes, whole])
        order = np.lexsort((h, rows))
        h, rows = h[order], rows[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
        self.hash, rows = h[new], rows[new]
        self.ptr = np.searchsorted(rows, np.arange(len(n) + 1))
        self.sizes = np.diff(self.ptr)

    def bitmaps(self) -> pa.Array:
        """Per row: parity of the tokens that fall on each bit (a power of two of bits, at least two a token)."""
        bits = 1 << np.ceil(np.log2(np.maximum(2 * self.sizes, 64))).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(bits)])
        owner = np.repeat(np.arange(len(bits)), self.sizes)
        at = (W.mix(self.hash) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64) + first[owner]
        body = np.packbits(np.bincount(at, minlength=first[-1]) & 1 == 1, bitorder="little")
        offsets = pa.py_buffer((first // 8).astype(np.int32).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(bits), [None, offsets, pa.py_buffer(body.tobytes())])

    def signatures(self) -> list[np.ndarray]:
        out = []
        for which in (1, 2):
            out.append(W.span_hash(W.prefix_sums(self.hash, which), self.ptr[:-1], self.ptr[1:], which))
        return out


def needed(n, percent: int):
    """Tokens of a set of ``n`` that any linked set shares."""
    return -(-n * percent // 100)


def bands(n: np.ndarray, percent: int) -> np.ndarray:
    """Size band of each set; a hair wider than the ratio of linked sizes."""
    return np.floor(np.log(np.maximum(n, 1)) / (math.log(100 / percent) * 1.0001)).astype(np.int64)


def most_apart(band: np.ndarray, percent: int) -> np.ndarray:
    """Tokens by which linked sets can differ, the larger being of this band."""
    largest = np.ceil(np.exp((band + 1) * math.log(100 / percent) * 1.0001))
    return (2 * largest * (100 - percent) // (100 + percent)).astype(np.int64)


def parts_of(band: np.ndarray, percent: int) -> np.ndarray:
    """Parts of a band: more than linked sets can differ by, so that they agree in the rest."""
    apart = most_apart(band, percent)
    return apart + 1 + apart // 4


def schemes(band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Bands whose columns a set of a band has, and searches further: small bands are one, and have no further one among them."""
    small = np.exp((band + 1) * math.log(100 / percent) * 1.0001) <= SMALL
    above = np.exp((band + 2) * math.log(100 / percent) * 1.0001) <= SMALL
    return np.where(small, TOKENS, band), np.where(above, TOKENS - 1, band + 1)


def _parts(sets: Sets, band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of parts by row, their offsets, and the place among all parts of every token (sets of small bands: a part a token)."""
    split = np.where(band == TOKENS, sets.sizes, parts_of(np.maximum(band, 0), percent))
    n_parts = np.where((sets.sizes > 0) & (band >= TOKENS), split, 0)
    ptr = np.concatenate([[0], np.cumsum(n_parts)])
    owner = np.repeat(np.arange(len(n_parts)), sets.sizes)
    nth = np.arange(len(owner)) - np.repeat(sets.ptr[:-1], sets.sizes)
    part = (W.mix(sets.hash ^ np.uint64(0x5851F42D4C957F2D)) % np.maximum(n_parts[owner], 1).astype(np.uint64)).astype(np.int64)
    part = np.where(band[owner] == TOKENS, nth, part)
    return n_parts, ptr, np.where(n_parts[owner] > 0, ptr[:-1][owner] + part, -1)


def part_keys(sets: Sets, band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of every row's set in the given band, and their offsets by row; odd keys are of parts without a token."""
    n_parts, ptr, at = _parts(sets, band, percent)
    here = at >= 0
    sums = np.zeros(ptr[-1], dtype=np.uint64)
    np.add.at(sums, at[here], W.mix(sets.hash[here]))
    empty = np.ones(ptr[-1], dtype=np.uint64)
    empty[at[here]] = 0
    rows = np.repeat(np.arange(len(n_parts)), n_parts)
    nth = np.where(band[rows] == TOKENS, 0, np.arange(ptr[-1]) - ptr[:-1][rows])  # a token is the same column wherever it stands
    place = ((band[rows] + 2).astype(np.uint64) << np.uint64(40)) + nth.astype(np.uint64)
    return (W.mix(sums + W.mix(place + np.uint64(1))) & ~np.uint64(1)) | empty, ptr


def asked(sets: Sets, band: np.ndarray, percent: int) -> np.ndarray:
    """Parts with tokens that a set shares with every set of the band it links to; below zero: parts, those without tokens too."""
    n_parts, ptr, at = _parts(sets, band, percent)
    full = np.zeros(ptr[-1], dtype=np.int64)
    full[at[at >= 0]] = 1
    filled = np.concatenate([[0], np.cumsum(full)])
    empty = n_parts - (filled[ptr[1:]] - filled[ptr[:-1]])
    parts = np.maximum(band, 0)
    # nothing that links to a set of n tokens differs in more than this, on whichever side the larger one is
    apart = np.minimum(most_apart(parts, percent), sets.sizes * (100 - percent) // percent)
    agree = np.where(band == TOKENS, np.maximum(needed(sets.sizes, percent), 1), parts_of(parts, percent) - apart)
    return np.where(agree > empty, agree - empty, -agree)


def signature_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, n, s1, s2, bits, here, above``: set size, identity and bitmap of every row, and what it asks of its band and the next."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.SPACED_LOWER):
            sets = Sets(cut, width)
            s1, s2 = sets.signatures()
            band = bands(sets.sizes, percent)
            asks = [pa.array(asked(sets, b, percent), pa.int32()) for b in schemes(band, percent)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), W.longs(sets.sizes), W.longs(s1), W.longs(s2), sets.bitmaps(), *asks],
                names=["doc_id", "n", "s1", "s2", "bits", "here", "above"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, bits binary, here int, above int")


def key_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``key, c, own``: the columns of every document in its own size band and in the next."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.SPACED_LOWER):
            sets = Sets(cut, width)
            for own, band in zip((True, False), schemes(bands(sets.sizes, percent), percent)):
                keys, ptr = part_keys(sets, band, percent)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(band)), np.diff(ptr))))
                yield pa.RecordBatch.from_arrays([W.longs(keys), ids, pa.repeat(pa.scalar(own), len(keys))], names=["key", "c", "own"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null")
    return rows.mapInArrow(run, "key bigint, c bigint, own boolean")


def _met_twice(batches):
    """Of rows sorted by key those whose key stands in two rows at least; a run of equal keys may go on over batches."""
    held, joined = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys = np.asarray(batch.column(0))
        same = keys[1:] == keys[:-1]
        keep = np.zeros(len(keys), bool)
        keep[1:] = same
        keep[:-1] |= same
        keep[0] |= joined
        # the last row waits for the next batch
        joined, held = bool(keep[-1]), batch.slice(len(keys) - 1)
        yield batch.slice(0, len(keys) - 1).filter(pa.array(keep[:-1]))
    if held is not None and joined:
        yield held


def shared_keys(spark: SparkSession, docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """``key, c, own``: the parts of every class that stand in another row too.

    A class's own document speaks for its copies. Equal keys come together in one exchange; the
    rows of a key pass by one after the other, however many there are.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(classes.select(F.col("c").alias("doc_id")), "doc_id", "left_semi")
    keys = key_rows(texts, width, percent).repartition("key").sortWithinPartitions("key")
    path = fresh_dir(spark, "jaccard-keys")
    keys.mapInArrow(_met_twice, "key bigint, c bigint, own boolean").write.parquet(path)
    return spark.read.parquet(path)


def hopeful(spark: SparkSession, found: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, c, own, k, ask, nth, rare``: columns of the classes that have as many as they ask for, from the rarest on.

    ``k`` says in how many rows a column stands, ``rare`` whether it is searched by: not among the last ``ask - 1``.
    """
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("k"))
    rows = found.join(counts, "key").join(classes.select("c", "here", "above"), "c").withColumn("ask", F.expr("if(own, here, above)"))
    # parts without a token count only for a class that could not ask for anything without them
    rows = rows.drop("here", "above").filter("ask < 0 or key % 2 = 0")
    of_class = Window.partitionBy("c", "own")
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(of_class), "nth": F.row_number().over(of_class.orderBy("k", "key"))})
    path = fresh_dir(spark, "jaccard-hopeful")
    rows.filter("n >= abs(ask)").withColumn("rare", F.expr("nth <= n - abs(ask) + 1")).drop("n").write.parquet(path)
    return spark.read.parquet(path)


def leaders(columns: DataFrame) -> DataFrame:
    """``c, pivot, g``: for every class the most central class that it shares enough columns with (or meets at all), and its group.

    Central is who meets most rows over all its columns: the text that a family of near copies was made from.
    The group is named by the pivot, or by the class itself where that is the more central one.
    """
    full = columns.filter("key % 2 = 0")
    degree = full.groupBy("c").agg(F.sum(F.when(F.col("own"), F.col("k"))).alias("degree"))
    top = F.max(F.when(F.col("own"), F.struct("degree", (-F.col("c")).alias("minus")))).alias("top")
    met = full.join(degree, "c").groupBy("key").agg(top, F.min("c").alias("lo"), F.max("c").alias("hi"))
    met = met.filter("lo < hi and top is not null").select("key", "top")
    common = full.join(met, "key").filter("c <> -top.minus").groupBy("c", "own", "top").agg(
        F.count(F.lit(1)).alias("common"), F.first("ask").alias("ask"), F.max("rare").alias("rare")
    )
    # a stray that has enough with no such class goes with the one that it meets by a rare column
    enough, meets = F.max(F.when(F.col("common") >= F.greatest("ask", F.lit(1)), F.col("top"))), F.max(F.when(F.col("rare"), F.col("top")))
    best = common.groupBy("c").agg(F.coalesce(enough, meets).alias("top")).filter("top is not null")
    pivot = -F.col("top.minus")
    own = F.coalesce(F.col("degree") > F.col("top.degree"), F.lit(False)) | ((F.col("degree") == F.col("top.degree")) & (F.col("c") < pivot))
    return best.join(degree, "c").select("c", pivot.alias("pivot"), F.when(own, F.col("c")).otherwise(pivot).alias("g"))


def open_groups(spark: SparkSession, columns: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """``c, g, member``: the groups in which a class must be compared (its own, and those that qualify)."""
    # a group whose name goes with another group goes there as a whole
    moved = groups.select(F.col("c").alias("g"), F.col("g").alias("to"))
    settled = groups.join(moved, "g", "left").select("c", F.coalesce("to", "g").alias("g"))
    rows = columns.join(settled, "c", "left").withColumn("g", F.coalesce("g", "c"))
    path = fresh_dir(spark, "jaccard-open")
    rows.write.parquet(path)
    live = spark.read.parquet(path)
    # a class that asks with empty parts is listed under all its full ones, and meets others' empty parts in full
    mine = live.filter("own").select("key", "g", "rare", "ask")
    listed = mine.filter("key % 2 = 0 and (rare or ask < 0)").select("key", "g")
    with_empty = live.filter("ask < 0 and rare").select("key").distinct()
    members_of = found.filter("own").join(live.select("c", "g").distinct(), "c").select("key", "g")
    matrix = listed.unionByName(members_of.join(with_empty, "key", "left_semi")).distinct().select(F.col("key").alias("column"), F.col("g").alias("other"))
    meets = (F.col("key") == F.col("column")) & (F.col("g") != F.col("other"))
    visits_path = fresh_dir(spark, "jaccard-met")
    live.filter("rare").join(matrix, meets).select("c", "own", F.col("other").alias("g")).distinct().write.parquet(visits_path)
    met = spark.read.parquet(visits_path)
    # what a class shares with the union of all columns of a group it met
    union = members_of.distinct()
    asks = live.select("c", "own", "key", F.abs("ask").alias("ask"))
    common = met.join(asks, ["c", "own"]).join(union, ["key", "g"]).groupBy("c", "own", "g").agg(F.count(F.lit(1)).alias("common"), F.max("ask").alias("ask"))
    visits = common.filter("common >= ask").select("c", "g").distinct()
    members = live.select("c", "g").distinct()
    return members.withColumn("member", F.lit(True)).unionByName(visits.withColumn("member", F.lit(False)))


def crowds(visits: DataFrame) -> DataFrame:
    """``g, size`` of the groups that can hold a link: two classes, one of them a member."""
    found = visits.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.count_if("member").alias("members"))
    return found.filter("size > 1 and members > 0").select("g", "size")


def cells(rows: DataFrame) -> DataFrame:
    """Blocks of a group's rows (side 1) crossed with blocks of the same rows (side 0): at most about CELL of each in a cell."""
    blocks = F.ceil(F.col("size") / CELL)
    mine, all_of = F.pmod(F.xxhash64("c"), blocks), F.sequence(F.lit(0).cast("bigint"), blocks - 1)
    here = rows.withColumns({"side": F.lit(1), "y": mine, "x": F.explode(all_of)})
    return here.unionByName(rows.withColumns({"side": F.lit(0), "x": mine, "y": F.explode(all_of)}))


def near_cell(percent: int):
    """``c, g, member`` of the waiting rows of a cell for which some row of another class is not ruled out by the bitmaps."""

    def run(table: pa.Table) -> pa.Table:
        side, n, c = (table.column(k).to_numpy() for k in ("side", "n", "c"))
        member = table.column("member").to_numpy(zero_copy_only=False)
        maps = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in table.column("bits").combine_chunks()]
        words = np.array([len(m) for m in maps])
        keep = np.zeros(len(c), bool)
        blocks = {}
        for k in np.unique(words):
            at = np.flatnonzero((words == k) & (side == 1))
            if len(at):
                blocks[int(k)] = (at, np.stack([maps[i] for i in at]))
        for r in np.flatnonzero(side == 0):
            mine = maps[r]
            for k, (at, matrix) in blocks.items():
                fits = (c[at] != c[r]) & (100 * np.minimum(n[at], n[r]) >= percent * np.maximum(n[at], n[r])) & (member[at] | member[r])
                if not fits.any():
                    continue
                other, own = matrix[fits], mine
                # the larger bitmap is folded: parities of halves add up
                while other.shape[1] > len(own):
                    half = other.shape[1] // 2
                    other = other[:, :half] ^ other[:, half:]
                while len(own) > other.shape[1]:
                    own = own[: len(own) // 2] ^ own[len(own) // 2 :]
                apart = np.bitwise_count(other ^ own).sum(axis=1, dtype=np.int64)
                if (apart * (100 + percent) <= (n[at[fits]] + n[r]) * (100 - percent)).any():
                    keep[r] = True
                    break
        return table.select(["c", "g", "member"]).filter(pa.array(keep))

    return run


def near_sets(classes: DataFrame, visits: DataFrame, percent: int) -> DataFrame:
    """The rows of ``visits`` that the bitmaps do not rule out."""
    rows = visits.join(crowds(visits), "g").join(classes.select("c", "n", "bits"), "c").select("c", "g", "member", "size", "n", "bits")
    crossed = cells(rows).select("g", "x", "y", "side", "c", "member", "n", "bits")
    found = crossed.groupBy("g", "x", "y").applyInArrow(near_cell(percent), "c bigint, g bigint, member boolean")
    return found.distinct()


def unsigned(tokens: pa.ListScalar) -> np.ndarray:
    """A stored set as the sorted unsigned hashes that it was made of."""
    return np.asarray(tokens.values).view(np.uint64)


def compare_cell(percent: int, count_links: bool = True):
    """Of one cell: ``a, b`` links that join its classes (``weight`` null), and ``a, weight``, the documents that a waiting class (side 0) links to.

    Without ``count_links`` pairs that are joined already are not compared, and there are no weights.
    """

    def run(table: pa.Table) -> pa.Table:
        c, weight = table.column("c").to_numpy(), table.column("weight").to_numpy()
        side, member = (table.column(n).to_numpy(zero_copy_only=False) for n in ("side", "member"))
        sets = [unsigned(s) for s in table.column("tokens").combine_chunks()]
        size = np.array([len(s) for s in sets])
        # rows that repeat an id with the same set are one
        seen, first = set(), np.zeros(len(c), bool)
        for i in range(len(c)):
            what = (int(side[i]), int(c[i]), sets[i].tobytes())
            first[i] = what not in seen
            seen.add(what)
        there = np.flatnonzero((side == 1) & first)
        there = there[np.lexsort((c[there], size[there]))]
        lengths, others = size[there], c[there]
        ptr = np.concatenate([[0], np.cumsum(lengths)])
        waiting = np.flatnonzero((side == 0) & first)
        if not len(there) or not len(waiting):
            return pa.table({k: pa.array([], pa.int64()) for k in ("a", "b", "weight")})
        # tokens by number, so that a set is marked once and looked up by all others
        known, flat = np.unique(np.concatenate([sets[e] for e in there]), return_inverse=True)
        mark = np.zeros(len(known), bool)
        ids, node = np.unique(c, return_inverse=True)
        label = np.arange(len(ids))
        a, b, w = [], [], []
        for r in waiting:
            n, mine = int(size[r]), sets[r]
            lo = int(np.searchsorted(lengths, needed(n, percent)))
            hi = int(np.searchsorted(lengths, n * 100 // percent, side="right"))
            # the larger of a pair is a member here: this group counts the pair
            larger = (lengths[lo:hi] > n) | ((lengths[lo:hi] == n) & (others[lo:hi] > c[r]))
            fits = np.where(larger, member[there[lo:hi]], member[r]) & (others[lo:hi] != c[r])
            if not count_links:
                fits &= label[node[there[lo:hi]]] != label[node[r]]
            if not fits.any():
                continue
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            at = at[known[at] == mine]
            mark[at] = True
            both = np.add.reduceat(mark[flat[ptr[lo] : ptr[hi]]], ptr[lo:hi] - ptr[lo], dtype=np.int64)
            mark[at] = False
            hits = there[lo:hi][fits & (100 * both >= percent * (n + lengths[lo:hi] - both))]
            if not len(hits):
                continue
            if count_links:
                a.append(c[r])
                b.append(None)
                w.append(int(weight[hits].sum()))
            met, where = np.unique(label[node[hits]], return_index=True)
            mine = label[node[r]]
            for x, e in zip(met, hits[where]):
                if x != mine:
                    label[label == x] = mine
                    a.append(c[r])
                    b.append(c[e])
                    w.append(None)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "weight": pa.array(w, pa.int64())})

    return run


def links(spark: SparkSession, docs: DataFrame, classes: DataFrame, visits: DataFrame, width: int, percent: int, count_links: bool = True) -> DataFrame:
    """What ``compare_cell`` returns of all cells of the opened groups."""
    # one row per class and opened group, with the class's whole set
    weights = classes.groupBy("c").agg(F.max("weight").alias("weight"))
    opened = visits.join(crowds(visits), "g").groupBy("c").agg(F.collect_list(F.struct("g", "member", "size")).alias("opened"))
    wanted = opened.join(weights, "c")

    def run(batches):
        for part, cut in W.cut_batches(batches, W.SPACED_LOWER):
            sets = Sets(cut, width)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), W.list_of(sets.hash, sets.ptr, pa.int64())], names=["c", "weight", "opened", "tokens"]
            )

    kind = "c bigint, weight bigint, opened array<struct<g:bigint,member:boolean,size:bigint>>, tokens array<bigint>"
    texts = docs.select(F.col("doc_id").cast("bigint").alias("c"), "text").join(wanted, "c").select("c", "weight", "opened", "text")
    path = fresh_dir(spark, "jaccard-sets")
    texts.mapInArrow(run, kind).select("c", "weight", F.explode("opened").alias("o"), "tokens").select("c", "weight", "o.*", "tokens").write.parquet(path)
    crossed = cells(spark.read.parquet(path)).select("g", "x", "y", "side", "c", "weight", "member", "tokens")
    return crossed.groupBy("g", "x", "y").applyInArrow(compare_cell(percent, count_links), "a bigint, b bigint, weight bigint")


def join(spark: SparkSession, docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, count_links: bool = True) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, n_links`` for every row of ``docs`` (doc_id, text).

    Without ``count_links`` only what joins classes is looked for, and ``n_links`` is null.
    """
    W.bound_batches(spark)
    paths = {name: fresh_dir(spark, f"jaccard-{name}") for name in ("signatures", "classes", "groups", "visits", "near", "links")}
    signature_rows(docs, width, percent).write.parquet(paths["signatures"])
    rows = spark.read.parquet(paths["signatures"])
    of_class = [F.first(c).alias(c) for c in ("bits", "here", "above")]
    sets = rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("c"), F.max("n").alias("n"), *of_class, F.count_distinct("doc_id").alias("weight"))
    sets.write.parquet(paths["classes"])
    classes = spark.read.parquet(paths["classes"])
    ids = classes.filter("c is not null")
    found = shared_keys(spark, docs, ids, width, percent)
    columns = hopeful(spark, found, ids)
    leaders(columns).write.parquet(paths["groups"])
    open_groups(spark, columns, found, spark.read.parquet(paths["groups"]).select("c", "g")).write.parquet(paths["visits"])
    near_sets(ids, spark.read.parquet(paths["visits"]), percent).write.parquet(paths["near"])
    links(spark, docs, ids, spark.read.parquet(paths["near"]), width, percent, count_links).write.parquet(paths["links"])
    drop_dirs(spark, *(paths[name] for name in ("groups", "visits", "near")))
    joined = spark.read.parquet(paths["links"])
    reached = components(spark, joined.filter("b is not null"))
    counted = joined.filter("b is null").groupBy(F.col("a").alias("c")).agg(F.sum("weight").alias("near"))
    named = classes.select("s1", "s2", "c", "weight").join(reached, F.col("c") == F.col("node"), "left").join(counted, "c", "left")
    others = F.coalesce("near", F.lit(0)) + F.col("weight") - 1
    named = named.select("s1", "s2", F.col("c").alias("class_id"), F.coalesce("component", "c").alias("component"), others.alias("links"))
    out = rows.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    alone = F.col("n") == 0
    n_links = F.when(F.col("doc_id").isNotNull(), F.when(alone, F.lit(0)).otherwise(F.col("links"))) if count_links else F.lit(None)
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        n_links.cast("bigint").alias("n_links"),
    )
