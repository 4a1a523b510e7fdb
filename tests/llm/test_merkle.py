"""The Merkle manifest against a tree built in one place."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from terrace.llm import merkle as M

KIND = "doc_id long, text string, lang string, source string, n_chars long, pos long, leaf string, group string, node string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append((other < at, nodes[other] if other < len(nodes) else ""))
        at >>= 1
    return out


def walk(node, steps):
    out = [node]
    for left, other in steps:
        out.append(sha(other, out[-1]) if left else sha(out[-1], other))
    return out


def leaf(row, more=0):
    fields = [row[0], row[3], row[2], None if row[4] is None else row[4] + more, row[1]]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def changed(row):
    return row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0


def brute(rows):
    by = collections.defaultdict(list)
    for row in rows:
        by[row[2]].append((row[0], leaf(row), leaf(row, 1) if changed(row) else None))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {lang: tree([x[1] for x in by[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    proofs, versions = collections.Counter(), collections.Counter()
    for k, lang in enumerate(langs):
        for i, (doc, own, other) in enumerate(by[lang]):
            steps = path(trees[lang], i) + path(top, k)
            nodes = walk(other or own, steps)
            root = top[-1][0]
            proofs[doc, own, trees[lang][-1][0], root, sha(*(s for _, s in steps)), nodes[-1], nodes[-1] == root] += 1
            if other:
                versions[lang, i, tuple(nodes)] += 1
    return proofs, versions


def rows_of(n):
    rows = [(i, f"text {i} é", ["en", "de", "en", "en", "Ω", "é"][i % 6], "s", 10 + i) for i in range(n)]
    rows += [(None, "no id", "en", None, 3), (None, None, "en", None, None), (5, "again", "de", "s", None), (5, "again", "de", "s", None)]
    rows += [(7, "", None, "", 0), (8, "x" * 50_000, None, "s", 50_000), (-14, "alone", "fr", "s", 5), (14, None, "en", "s", None)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", "g", "n") for r in rows], KIND).repartition(4)


@pytest.mark.parametrize(("n", "levels"), [(40, 2), (133, 3), (60, 10)])
def test_proofs_and_versions_equal_one_tree(spark, n, levels):
    rows = rows_of(n)
    made = M.manifest(spark, table(spark, rows), M.planted_chars(), levels)
    got = M.proofs(made)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    proofs, versions = brute(rows)
    assert collections.Counter(tuple(r) for r in got.collect()) == proofs
    lang_of = {r["group"]: r["lang"] for r in made.leaves.select("group", "lang").distinct().collect()}
    listed = collections.defaultdict(dict)
    for r in M.versions(made).collect():
        listed[lang_of[r["group"]], r["version"]][r["level"]] = r["digest"]
    assert collections.Counter((*k, tuple(v[i] for i in range(len(v)))) for k, v in listed.items()) == versions


def test_a_version_shares_all_nodes_but_its_own_path(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(64)]
    made = M.manifest(spark, table(spark, rows), M.planted_chars(), 3)
    base = {x for level in tree([leaf(r) for r in rows]) for x in level}
    own = [r["digest"] for r in M.versions(made).collect()]
    hit = sum(map(changed, rows))
    assert hit and len(own) == hit * 7 and not base & set(own)


def test_one_leaf_and_no_leaf(spark):
    row = (3, "only", "en", "s", 4)
    got = M.proofs(M.manifest(spark, table(spark, [row]), M.planted_chars())).collect()
    assert [tuple(r) for r in got] == [(3, leaf(row), leaf(row), leaf(row), sha(""), leaf(row), True)]
    assert M.proofs(M.manifest(spark, table(spark, []), M.planted_chars())).collect() == []


def test_blocks_of_a_hot_group_are_bounded(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    made = M.manifest(spark, rows, M.planted_chars(), 4)
    sizes = made.blocks.select(F.size(F.col("nodes")[0]).alias("n")).agg(F.max("n"), F.sum("n"), F.count("n")).first()
    assert sizes[:] == (16, 5000, 313)
