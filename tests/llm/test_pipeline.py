"""The pipeline's stages on a small table, each against what it should decide."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from terrace.llm import toxicity

KIND = "doc_id long, text string, lang string, source string, n_chars long, shard int"


@pytest.fixture(scope="module")
def tables(spark):
    from terrace.session import fresh_dir

    folder = fresh_dir(spark, "tables")
    bench = " ".join(f"b{i}" for i in range(30))
    body = [f"word{i}" for i in range(80)]
    rows = [(1, " ".join(body)), (2, " ".join(body)), (3, "Short. Mail a@b.cc or +1 (555) 010-9999!"), (4, f"intro {bench} outro"), (5, None), (6, "")]
    rows += [(None, " ".join(body)), (7, "an unlike text of its own"), (7, "an unlike text of its own")]
    docs = spark.createDataFrame([(i, t, "en", "s" if i else None, len(t or ""), 0) for i, t in rows], KIND)
    spark.createDataFrame([(i, int(i == 9), 1) for i in (1, 9)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = CP.remove_near_duplicates(spark, docs, tables)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect()) in ([-1, 3, 4, 5, 6, 7], [1, 3, 4, 5, 6, 7])
    clean = CP.remove_contaminated(spark, docs, tables)
    assert clean.columns == docs.columns and clean.filter("doc_id = 4").isEmpty() and clean.count() == docs.count() - 1
    redacted = CP.redact_personal_data(spark, docs, tables)
    assert redacted.columns == docs.columns and redacted.count() == docs.count()
    row = redacted.filter("doc_id = 3").first()
    assert row["text"] == "Short. Mail <EMAIL> or <PHONE>!" and row["n_chars"] == len(row["text"])
    same = redacted.filter("doc_id <> 3 or doc_id is null").select("doc_id", "text", "n_chars")
    assert same.exceptAll(docs.select("doc_id", "text", "n_chars")).isEmpty()
    mixed = CP.mix_sources(spark, docs, tables)
    assert mixed.count() == docs.count() and mixed.filter("taken > 2 * size").isEmpty()


def test_near_copies_between_the_thresholds_go(spark, tables):
    """Two far-apart words of 100 changed: five-word shingles 86 / 106 = 0.81, three-word shingles 92 / 104 = 0.88."""
    words = [f"n{i}" for i in range(100)]
    near = [*words[:30], "x", *words[31:70], "y", *words[71:]]
    far = ["z" if i in (20, 50, 80) else w for i, w in enumerate(words)]  # 81 / 111 = 0.73
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in CP.remove_near_duplicates(spark, docs, tables).collect()) == [1, 3]


def test_rows_that_share_an_id_are_told_apart(spark, tables):
    """One of two texts of id 7 links to document 3; rows without an id or without words lose nothing."""
    body, other, third = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    rows = [(3, body), (7, body), (7, other), (8, "alone with its id"), (8, "and another text"), (None, third), (9, third)]
    rows += [(None, None), (None, ""), (None, " "), (5, None), (5, "mail a@b.cc"), (5, "no address here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in CP.remove_near_duplicates(spark, docs, tables).collect()]
    assert sorted(kept, key=repr) == sorted([r for r in rows if r not in ((7, body), (None, third))], key=repr)
    redacted = [tuple(r) for r in CP.redact_personal_data(spark, docs, tables).collect()]
    assert sorted(redacted, key=repr) == sorted([(i, t and t.replace("a@b.cc", "<EMAIL>")) for i, t in rows], key=repr)


def test_toxic_stage_keeps_what_the_classifier_passes(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = CP.remove_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    neutral = docs.join(labels.filter("toxic = 0"), "doc_id", "left_semi")
    assert kept.join(neutral, "doc_id", "left_semi").count() >= 0.98 * neutral.count()
    assert 0 < docs.count() - kept.count() and toxicity.THRESHOLD == 0.7


def test_run_and_empty_tables(spark, tables):
    out = CP.run(spark, tables)
    assert out.filter("doc_id = 4 or doc_id = 2").isEmpty() and out.filter("taken > 0").count() >= 2
    docs = spark.read.parquet(f"{tables}/documents.parquet").filter(F.lit(False))
    for _, stage in CP.STAGES:
        assert stage(spark, docs, tables).count() == 0


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "terrace")):
        if os.sep + "llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                assert "terrace.llm" not in open(os.path.join(folder, name)).read(), name
