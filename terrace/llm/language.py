"""Language identification by multilingual mixture inference.

Training counts byte trigrams per language over every training document (hashed to
``BUCKETS``, add-half smoothing): one (language, trigram) table, summed by Spark.
A word of a text is drawn from one of the languages: its likelihood under a
language is that of its trigrams, word borders included. Expectation-maximisation
estimates the document's language proportions; the language set is the one of
least ``-2 log likelihood + languages * log(words)`` among the best single language
and the sets grown from it: always by the language that gains most over the current
mixture, for as long as the penalised likelihood falls, however many that are.
The answer is the language of the largest proportion in that set, the score that
proportion.

Edge cases: null or empty texts and texts without a letter are ``und`` with score 0;
without any training row everything is ``und``; ties go to the language that sorts
first; a null id is a training row; repeated rows count as often as they stand.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm import words as W

BUCKETS = 1 << 15
EM_STEPS = 12
#: Share at which a further language is tried.
TRIAL = 0.1
UNKNOWN = "und"


def trigram_codes(start: np.ndarray, end: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of the words at ``[start, end)`` with a border byte on either side, and their offsets by word."""
    n = end - start
    ptr = np.concatenate([[0], np.cumsum(n)])
    body = data[W.ragged(start, n)].astype(np.uint32)
    body[(body >= 65) & (body <= 90)] += 32
    before = np.empty_like(body)
    before[1:] = body[:-1]
    after = np.empty_like(body)
    after[:-1] = body[1:]
    if len(body):
        before[ptr[:-1]] = 1
        after[ptr[1:] - 1] = 2
    code = (before * np.uint32(0x9E3779B1)) ^ (body * np.uint32(0x85EBCA6B)) ^ (after * np.uint32(0xC2B2AE35))
    code ^= code >> np.uint32(15)
    return ((code * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64), ptr


def count_trigrams(training: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all of ``training`` (text, lang)."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER):
            codes, ptr = trigram_codes(cut.start, cut.end, cut.data)
            langs = np.array(part.column(part.schema.get_field_index("lang")).to_pylist(), dtype=object)
            of_code = np.repeat(cut.rows(), np.diff(ptr))
            for lang in dict.fromkeys(langs.tolist()):
                n = np.bincount(codes[(langs == lang)[of_code]], minlength=BUCKETS)
                total[lang] = total[lang] + n if lang in total else n
            if len(total) > 64:  # a task holds the tables of a bounded number of languages
                yield from flush(total)
        yield from flush(total)

    def flush(total):
        for lang, n in total.items():
            here = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(here)), pa.array(here, pa.int32()), pa.array(n[here], pa.int64())], names=["lang", "gram", "n"])
        total.clear()

    counted = training.select("text", "lang").mapInArrow(run, "lang string, gram int, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Languages:
    """Smoothed trigram log-likelihoods, a column per learned language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        p = counts + 0.5
        self.table = np.log(p / p.sum(axis=1, keepdims=True)).astype(np.float32)

    @classmethod
    def fit(cls, training: DataFrame) -> Languages:
        table = count_trigrams(training).toArrow()  # languages x BUCKETS rows at most
        names = sorted(set(table.column("lang").to_pylist()))
        place = {n: i for i, n in enumerate(names)}
        counts = np.zeros((len(names), BUCKETS))
        rows = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
        np.add.at(counts, (rows, table.column("gram").to_numpy()), table.column("n").to_numpy())
        return cls(names, counts)

    def word_likelihoods(self, cut: W.Words) -> np.ndarray:
        """Log-likelihood of every word (rows) under every language (columns); each different word once."""
        _, first, same = np.unique(cut.hash, return_index=True, return_inverse=True)
        codes, ptr = trigram_codes(cut.start[first], cut.end[first], cut.data)
        out = np.zeros((len(first), len(self.names)), dtype=np.float32)
        if len(codes):
            for k in range(len(self.names)):
                out[:, k] = np.add.reduceat(self.table[k][codes], ptr[:-1])
        return out[same]

    def mixtures(self, like: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(proportions, whether the text has words)`` over the language set of least penalised likelihood."""
        counts = np.diff(ptr)
        some = np.flatnonzero(counts)
        best = np.zeros((len(counts), len(self.names)))
        if len(some) and self.names:
            best[some] = self._select(like, ptr[:-1][some], counts[some])
        return best, counts > 0

    def _select(self, like: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        n, langs = len(first), len(self.names)
        word = np.repeat(np.arange(n), counts)
        size = np.log(np.maximum(counts, 2))
        single = np.add.reduceat(like, first, axis=0, dtype=np.float64)
        lead = single.argmax(axis=1)
        base = single.max(axis=1)
        cost = -2 * base + size
        pi = np.zeros((n, langs))
        pi[np.arange(n), lead] = 1.0
        if langs < 2:
            return pi
        # second language: the one that gains most at a small share; then EM over the two
        ratio = np.exp(np.clip(like - np.take_along_axis(like, lead[word][:, None], axis=1), -60, 60))
        gain = np.add.reduceat(np.log(1 - TRIAL + TRIAL * ratio), first, axis=0, dtype=np.float64)
        gain[np.arange(n), lead] = -np.inf
        second = gain.argmax(axis=1)
        r = np.take_along_axis(ratio, second[word][:, None], axis=1)[:, 0]
        share = np.full(n, TRIAL, dtype=np.float32)
        for _ in range(EM_STEPS):
            odds = share[word] * r
            share = (np.add.reduceat(odds / (1 - share[word] + odds), first, dtype=np.float64) / counts).astype(np.float32)
        fit = base + np.add.reduceat(np.log(1 - share[word] + share[word] * r), first, dtype=np.float64)
        value = -2 * fit + 2 * size
        rows = np.flatnonzero(value < cost)
        pi[rows] = 0
        pi[rows, lead[rows]] = 1 - share[rows]
        pi[rows, second[rows]] += share[rows]
        cost[rows] = value[rows]
        # larger sets, for the texts in which one more language paid
        active = np.zeros((n, langs))
        active[np.arange(n), lead] = 1
        active[np.arange(n), second] = 1
        for k in range(3, langs + 1):
            if not len(rows):
                break
            active[rows, self._most_gain(ratio, pi[rows], active[rows], rows, first, counts)] = 1
            mixed, fit = self._em(ratio, active[rows], rows, first, counts)
            value = -2 * (base[rows] + fit) + k * size[rows]
            win = value < cost[rows]
            rows, mixed, value = rows[win], mixed[win], value[win]
            pi[rows], cost[rows] = mixed, value
        return pi

    @staticmethod
    def _words_of(rows: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of some texts, the text (by its place in ``rows``) of each, and where each text begins among them."""
        n = counts[rows]
        return W.ragged(first[rows], n), np.repeat(np.arange(len(rows)), n), np.concatenate([[0], np.cumsum(n)])[:-1]

    def _most_gain(self, ratio, pi, active, rows, first, counts) -> np.ndarray:
        """For each text the language outside its set that gains most when it takes a small share of the current mixture."""
        at, w, begin = self._words_of(rows, first, counts)
        q = ratio[at]
        now = np.maximum((q * pi[w]).sum(axis=1), 1e-30)
        gain = np.add.reduceat(np.log(1 - TRIAL + TRIAL * q / now[:, None]), begin, axis=0, dtype=np.float64)
        gain[active > 0] = -np.inf
        return gain.argmax(axis=1)

    def _em(self, ratio, active, rows, first, counts) -> tuple[np.ndarray, np.ndarray]:
        """Proportions over each row's active languages and the log-likelihood against its lead."""
        n = counts[rows]
        at, w, begin = self._words_of(rows, first, counts)
        q = ratio[at]
        pi = active / active.sum(axis=1, keepdims=True)
        for _ in range(EM_STEPS):
            joint = q * pi[w]
            joint /= joint.sum(axis=1, keepdims=True)
            pi = np.add.reduceat(joint, begin, axis=0) / n[:, None]
        return pi, np.add.reduceat(np.log((q * pi[w]).sum(axis=1)), begin)


def has_letter(part: pa.Array, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each text holds a Unicode letter; only texts without an ASCII one are decoded."""
    ascii_letter = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
    seen = np.concatenate([[0], np.cumsum(ascii_letter)])
    out = seen[rows[1:]] > seen[rows[:-1]]
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    for i in np.flatnonzero(~out & (high[rows[1:]] > high[rows[:-1]])):
        out[i] = any(c.isalpha() for c in part[int(i)].as_py())
    return out


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """``doc_id, lang_pred, score, langs`` for every row of ``docs`` (doc_id, text)."""

    def run(batches):
        for part, cut in W.cut_batches(batches, W.ALNUM_LOWER):
            col = part.column(part.schema.get_field_index("text"))
            pi, ok = model.mixtures(model.word_likelihoods(cut), cut.ptr)
            ok = ok & has_letter(col, cut.data, cut.row_start) & bool(model.names)
            lead = pi.argmax(axis=1) if model.names else np.zeros(len(ok), np.int64)
            names = [model.names[k] if good else UNKNOWN for k, good in zip(lead.tolist(), ok.tolist())]
            score = np.where(ok, pi.max(axis=1), 0.0) if model.names else np.zeros(len(ok))
            sets = [",".join(n for n, x in zip(model.names, row) if x > 0) if good else "" for row, good in zip(pi.tolist(), ok.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(sets, pa.string())],
                names=["doc_id", "lang_pred", "score", "langs"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double, langs string")
