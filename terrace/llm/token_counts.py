"""Edit-aware token counts: a pre-token segment tree per document.

A text is cut into leaves of about ``LEAF_CHARS`` characters at places where the
tokenizer's pre-token pattern cuts in any case (a single space between two
non-space characters), so leaves are encoded on their own and their counts add up.
The tree keeps the sums of all subtrees in one array (node ``i`` has the children
``2i`` and ``2i + 1``, node 1 is the document). An edit replaces a span of
characters. Leaves that it touches, and the neighbour where it comes within the two
characters that make a cut safe, are one region, which is cut into leaves and encoded
again; all other leaves keep their counts. Where a region keeps its number of leaves the
differences go up the paths to the root; where it does not, the sums above the leaves are
added up anew. Text, leaves and sums after the edits are a tree for the next round.

Trees are stored beside the texts, so a later edit needs no join and no encoding
of what it does not touch. Edits of one document are spans of its stored text, are
sorted by start and must not overlap.

Edge cases: null and empty texts have 0 tokens and one empty leaf; an insertion is a
span of length 0, also at either end; rows are independent, so repeated ids and ties
need no rule. Further columns are kept unless they carry the names of the tree's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 1024
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the byte-level BPE vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

TREE = "leaf_ends array<int>, sums array<int>"
_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str):
    """One tokenizer per worker process and vocabulary file."""
    if vocabulary not in _ENCODERS:
        import base64

        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[vocabulary]


def safe(text: str, at: int) -> bool:
    """Whether the pre-token pattern always cuts before position ``at``."""
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def leaves(text: str) -> list[int]:
    """Ends of the leaves."""
    ends, at = [], 0
    while len(text) - at > LEAF_CHARS:
        cut = text.find(" ", at + LEAF_CHARS)
        while cut >= 0 and not safe(text, cut):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        ends.append(cut)
        at = cut
    return [*ends, len(text)]


class Tree:
    """Subtree sums over the leaf counts."""

    def __init__(self, counts: list[int] | None = None, sums: np.ndarray | None = None):
        if sums is None:
            width = 1 << max(0, (len(counts) - 1).bit_length())
            sums = np.zeros(2 * width, dtype=np.int64)
            sums[width : width + len(counts)] = counts
            for i in range(width - 1, 0, -1):
                sums[i] = sums[2 * i] + sums[2 * i + 1]
        self.sums = sums
        self.width = len(sums) // 2

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def put(self, leaf: int, count: int) -> None:
        node = self.width + leaf
        change = count - self.sums[node]
        while node and change:
            self.sums[node] += change
            node //= 2


def regions(text: str, ends: list[int], edits: list[tuple[int, int, str]]) -> list[tuple[int, int, list]]:
    """``(first leaf, last leaf, edits)``: runs of leaves to encode again, as one string each."""
    starts = [0, *ends[:-1]]
    out: list[tuple[int, int, list]] = []
    for lo, hi, new in edits:
        a = max(0, int(np.searchsorted(ends, lo, side="right")))
        a = min(a, len(ends) - 1)
        b = min(int(np.searchsorted(ends, max(hi, lo), side="right")), len(ends) - 1)
        # a cut at p is safe by the characters p - 1, p and p + 1
        while a > 0 and lo <= starts[a] + 1:
            a -= 1
        while b < len(ends) - 1 and hi >= ends[b] - 1:
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), [*out[-1][2], (lo, hi, new)])
        else:
            out.append((a, b, [(lo, hi, new)]))
    return out


def replace(text: str, start: int, end: int, edits: list[tuple[int, int, str]]) -> str:
    parts, at = [], start
    for lo, hi, new in edits:
        parts += [text[at:lo], new]
        at = hi
    return "".join([*parts, text[at:end]])


def edited(text: str, ends: list[int], tree: Tree, edits: list[tuple[int, int, str]], count) -> tuple[str, list[int], Tree, int]:
    """Text, leaf ends and tree after ``edits``, and the characters encoded again."""
    starts, again = [0, *ends[:-1]], 0
    edits = sorted(edits)
    if any(a[1] > b[0] for a, b in zip(edits, edits[1:])):
        raise ValueError("edits overlap")
    old = tree.sums[tree.width : tree.width + len(ends)].tolist()
    sizes = [b - a for a, b in zip(starts, ends)]
    parts, counts, lengths, at, changed, in_place = [], [], [], 0, [], True
    for first, last, mine in regions(text, ends, edits):
        new = replace(text, starts[first], ends[last], mine)
        again += len(new)
        cuts = leaves(new)
        in_place &= len(cuts) == last - first + 1
        counts += old[at:first]
        lengths += sizes[at:first]
        changed += range(len(counts), len(counts) + len(cuts))
        counts += [count(new[a:b]) for a, b in zip([0, *cuts[:-1]], cuts)]
        lengths += [b - a for a, b in zip([0, *cuts[:-1]], cuts)]
        parts += [text[starts[at] : starts[first]] if at < first else "", new]
        at = last + 1
    counts, lengths = counts + old[at:], lengths + sizes[at:]
    parts.append(text[starts[at] :] if at < len(ends) else "")
    if in_place:
        for leaf in changed:
            tree.put(leaf, counts[leaf])
    else:
        tree = Tree(counts)
    return "".join(parts), np.cumsum(lengths).tolist(), tree, again


def update(text: str, ends: list[int], tree: Tree, edits: list[tuple[int, int, str]], count) -> int:
    """Apply ``edits`` to the counts of ``tree`` alone; returns the characters encoded again."""
    _, _, new, again = edited(text, ends, tree, edits, count)
    tree.sums, tree.width = new.sums, new.width
    return again


def with_trees(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """``docs`` with ``leaf_ends`` and ``sums``."""
    rest = [c for c in docs.columns if c not in ("leaf_ends", "sums")]
    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).schema

    def run(batches):
        count = encoder(vocabulary).encode_ordinary
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for lo in range(0, batch.num_rows, 500):
                ends, sums = [], []
                for text in texts.slice(lo, 500).to_pylist():
                    text = text or ""
                    ends.append(leaves(text))
                    sums.append(Tree([len(count(text[a:b])) for a, b in zip([0, *ends[-1][:-1]], ends[-1])]).sums)
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ends, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int32()))],
                    names=[*part.schema.names, "leaf_ends", "sums"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return docs.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, f"{kinds}, {TREE}")


COUNTS = ("n_tokens", "n_edits", "n_tokens_after", "n_chars_encoded", "n_chars")


def edit(trees: DataFrame, edits_of, vocabulary: str = VOCABULARY, keep_trees: bool = True) -> DataFrame:
    """``doc_id``, the counts, and text, ``leaf_ends`` and ``sums`` after the edits that ``edits_of(text)`` lists (the next round's input).

    ``n_tokens`` and ``n_chars`` are those before the edits. Without ``keep_trees`` only the counts.
    """
    names = ["doc_id", *COUNTS, *(["text", "leaf_ends", "sums"] if keep_trees else [])]
    kinds = [*[pa.int64()] * 6, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())][: len(names)]

    def run(batches):
        encode = encoder(vocabulary).encode_ordinary
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            out = []
            for doc, text, ends, sums in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "leaf_ends", "sums"))):
                whole, tree, again = text or "", Tree(sums=np.array(sums, dtype=np.int64)), 0
                before, edits = tree.total, edits_of(whole)
                n_chars = len(whole)
                if edits:
                    text, ends, tree, again = edited(whole, ends, tree, edits, lambda s: len(encode(s)))
                row = (doc, before, len(edits), tree.total, again, n_chars)
                out.append((*row, text, ends, tree.sums) if keep_trees else row)
            cols = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    kind = ", ".join(f"{c} bigint" for c in names[:6]) + (f", text string, {TREE}" if keep_trees else "")
    rows = trees.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "leaf_ends", "sums")
    return rows.mapInArrow(run, kind)


def recount(trees: DataFrame, edits_of, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts before and after the edits that ``edits_of(text)`` lists, from the stored trees."""
    return edit(trees, edits_of, vocabulary, keep_trees=False)
