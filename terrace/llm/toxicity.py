"""Counterfactual-regularised toxicity classifier.

1. Word statistics over all labelled training rows, counted by Spark: in how many
   toxic and neutral documents a word stands. Words of enough documents whose
   log-odds lie outside their error make the vocabulary (``MAX_FEATURES`` at most,
   the surest ones), identity terms aside: those are always in it.
2. A logistic model over word presence, fitted on a bounded hash sample of the
   labelled training rows (``MAX_TRAIN`` rows). Every sentence that holds identity
   terms is also scored with each term swapped for another term of its family, and
   with the term left out; the squared change of the logit is a penalty
   (counterfactual logit pairing), so a neutral mention of a group does not move
   the score. Nothing else holds the terms' weights down.
3. Every whole text is scored by its executor: words are looked up in the sorted
   feature table. Labels, language, source and id never enter a score.

Edge cases: null and empty texts have no words and get the score of the intercept;
rows without a label train nothing; without labelled rows of both classes every
score is the share of toxic rows (0 without any); repeated ids of ``labels`` count
once (the largest label); repeated documents are scored row by row. Other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import words as W
from terrace.session import fresh_dir

THRESHOLD = 0.7
MIN_DOCS = 5
MAX_FEATURES = 20_000
MAX_TRAIN = 20_000
PAIRING = 4.0
RIDGE = 1e-5
STEPS = 400

# Identity terms by family; a term is swapped within its family.
IDENTITY_FAMILIES = (
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("black", "white", "asian", "african", "latino", "european"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("old", "young", "elderly"),
    ("disabled", "deaf", "blind"),
)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """``crc32(doc_id as text) mod folds = fold``; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def hash_words(texts: list[str]) -> np.ndarray:
    return W.cut(pa.array(texts, pa.string()), W.ALNUM_LOWER).hash


@dataclass
class Model:
    terms: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float

    def logits(self, cut: W.Words) -> np.ndarray:
        """Logit of every row: presence of each term counts once per text."""
        n = len(cut.ptr) - 1
        out = np.full(n, self.bias)
        if not len(self.terms) or not len(cut.hash):
            return out
        at = np.minimum(np.searchsorted(self.terms, cut.hash), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == cut.hash)
        pair = np.unique(np.searchsorted(cut.ptr, hit, side="right") * len(self.terms) - len(self.terms) + at[hit])
        np.add.at(out, pair // len(self.terms), self.weights[pair % len(self.terms)])
        return out


def word_statistics(labelled: DataFrame) -> DataFrame:
    """``(word, toxic, neutral)``: documents of each class that hold the word, over all labelled rows."""

    def count(batches):
        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER):
            toxic = part.column(part.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = cut.rows()
            order = np.lexsort((rows, cut.hash))
            h, r = cut.hash[order], rows[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
            h, y = h[once], toxic[r[once]]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(h)))
            pos = np.add.reduceat(y, first) if len(h) else n
            yield pa.RecordBatch.from_arrays([W.longs(h[first]), W.longs(pos), W.longs(n - pos)], names=["word", "toxic", "neutral"])

    rows = labelled.select("text", "toxic").mapInArrow(count, "word bigint, toxic bigint, neutral bigint")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("neutral").alias("neutral"))


def choose_terms(stats: DataFrame, n_toxic: int, n_neutral: int) -> np.ndarray:
    """Hashes of the words whose log-odds between the classes are surest (identity terms added)."""
    a, b = F.col("toxic") + 0.5, F.col("neutral") + 0.5
    odds = F.log(a / (n_toxic + 1)) - F.log(b / (n_neutral + 1))
    error = F.sqrt(1 / a + 1 / b)
    sure = stats.filter(F.col("toxic") + F.col("neutral") >= MIN_DOCS).select("word", F.abs(odds / error).alias("z")).filter("z > 3")
    rows = sure.orderBy(F.desc("z"), "word").limit(MAX_FEATURES).collect()
    chosen = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    return np.unique(np.concatenate([chosen, hash_words([" ".join(f) for f in IDENTITY_FAMILIES])]))


def training_matrix(sample: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, feature, label by row)`` of the bounded sample."""

    def encode(batches):
        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER):
            at = np.minimum(np.searchsorted(terms, cut.hash), len(terms) - 1)
            hit = terms[at] == cut.hash
            feats = [np.unique(at[lo:hi][hit[lo:hi]]) for lo, hi in zip(cut.ptr[:-1], cut.ptr[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(feats, pa.list_(pa.int32())), part.column(part.schema.get_field_index("toxic")).cast(pa.int32())],
                names=["features", "toxic"],
            )

    rows = sample.select("text", "toxic").mapInArrow(encode, "features array<int>, toxic int").toArrow()
    feats = rows.column("features").combine_chunks()
    n = np.diff(feats.offsets.to_numpy())
    return np.repeat(np.arange(len(n)), n), feats.values.to_numpy(zero_copy_only=False), rows.column("toxic").to_numpy().astype(float)


#: In place of an inserted term: the term is only left out.
NOTHING = -1


def counterfactuals(row: np.ndarray, feature: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, removed term, inserted term)`` for each identity term of a sentence: each swap, and leaving it out.

    A sentence that holds the inserted term already only loses the other.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for family in IDENTITY_FAMILIES:
        ids = np.searchsorted(terms, hash_words([" ".join(family)]))
        for a in ids:
            here = row[feature == a]
            for b in (*ids[ids != a], NOTHING):
                new = np.where(np.isin(here, row[feature == b]), NOTHING, b)
                found.append((here, np.full(len(here), a), new))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def neutral_mentions(row: np.ndarray, feature: np.ndarray, label: np.ndarray, model: Model) -> tuple[float, float]:
    """False-positive rates of neutral labelled sentences: of those that mention a group, and of the same with the term left out."""
    n = len(label)
    identity = np.zeros(len(model.terms), bool)
    identity[np.searchsorted(model.terms, hash_words([" ".join(t for f in IDENTITY_FAMILIES for t in f)]))] = True
    of_group = (np.bincount(row, identity[feature], minlength=n) > 0) & (label == 0)
    limit = np.log(THRESHOLD / (1 - THRESHOLD))
    rates = []
    for weights in (model.weights, np.where(identity, 0.0, model.weights)):
        z = model.bias + np.bincount(row, weights[feature], minlength=n)
        rates.append(float((z[of_group] >= limit).mean()) if of_group.any() else 0.0)
    return rates[0], rates[1]


def fit(row: np.ndarray, feature: np.ndarray, label: np.ndarray, terms: np.ndarray) -> Model:
    """Full-batch Adam on log loss + ridge + pairing penalty over swapped identity terms."""
    n, d = len(label), len(terms)
    share = label.mean() if n else 0.0
    if not n or share in (0.0, 1.0):
        return Model(terms, np.zeros(d), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    _, gone, new = counterfactuals(row, feature, terms)
    there = new != NOTHING
    w, bias = np.zeros(d), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = bias + np.bincount(row, w[feature], minlength=n)
        r = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        g = np.bincount(feature, r[row], minlength=d) / n + RIDGE * w
        change = (w[gone] - np.where(there, w[new], 0.0)) * (PAIRING / n)
        g += np.bincount(gone, change, minlength=d) - np.bincount(new[there], change[there], minlength=d)
        gb = r.mean()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c, s = 1 - 0.9**t, 1 - 0.999**t
        w -= 0.1 * (m / c) / (np.sqrt(v / s) + 1e-9)
        bias -= 0.1 * (mb / c) / (np.sqrt(vb / s) + 1e-9)
    return Model(terms, w, bias)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on every labelled row given (statistics) and a bounded hash sample of them (weights)."""
    W.bound_batches(spark)
    marks = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    path = fresh_dir(spark, "toxicity-labelled")
    # labels grow with the documents: the same join at every size
    docs.select("doc_id", F.col("text").alias("text")).join(marks.hint("merge"), "doc_id").write.option("compression", "zstd").parquet(path)
    labelled = spark.read.parquet(path)
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_neutral = counts.get(1, 0), counts.get(0, 0)
    terms = choose_terms(word_statistics(labelled), n_toxic, n_neutral)
    # hash sample of a fixed expected size, so the driver's share does not grow with the input
    part = min(1.0, MAX_TRAIN / max(n_toxic + n_neutral, 1))
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < int(part * (1 << 20)))
    return fit(*training_matrix(sample, terms), terms)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Every row of ``docs`` with its score, from its whole text, in the column ``name`` (an input column of that name is replaced)."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER):
            p = 1 / (1 + np.exp(-np.clip(model.logits(cut), -30, 30)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=[*part.schema.names, name])

    docs = docs.drop(name)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds}, `{name}` double")
