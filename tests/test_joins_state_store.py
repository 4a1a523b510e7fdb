"""Split joins, mergeable distinct states, footer counts and publishing by several writers."""

import os
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from terrace.operators.distinct_state import StateStore, distinct_counts, distinct_state, merge_states
from terrace.operators.footer_counts import footer_counts, snapshot_counts
from terrace.operators.joins import frequent_keys, split_join
from terrace.sources import files
from terrace.sources.store import SnapshotStore


@pytest.fixture()
def plain_shuffles(spark):
    """Shuffle joins of 16 tasks, nothing joined, split or broadcast at run time."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def companies(spark, n=40_000):
    """``n`` rows, two fifths of one company, a twentieth without one, some companies unknown."""
    key = F.when(F.col("id") % 5 < 2, "00000001").when(F.col("id") % 20 == 3, F.lit(None)).otherwise(F.lpad(F.col("id").cast("string"), 8, "0"))
    rows = spark.range(n).select(key.alias("cnpj_basico"), (F.col("id") % 7).alias("x"))
    known = spark.range(0, n, 3).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("cnpj_basico"), (F.col("id") % 5).alias("porte"))
    one = spark.createDataFrame([("00000001", 91), ("00000001", 92), (None, 93)], "cnpj_basico string, porte long")
    return rows, known.unionByName(one)


def places(df):
    """Rows of every task of the join (a column of its right side keeps the join in the plan)."""
    found = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("porte"))
    return sorted(r["n"] for r in found.collect())


def test_a_heavy_key_does_not_make_a_heavy_task(spark, plain_shuffles):
    rows, known = companies(spark)
    known = known.filter("porte <> 92")
    plain, split = rows.join(known, "cnpj_basico", "left"), split_join(rows, known, "cnpj_basico")
    of_plain, of_split = places(plain), places(split)
    assert of_plain[-1] > 6 * of_plain[len(of_plain) // 2]
    assert of_split[-1] < 3 * of_split[len(of_split) // 2] and sum(of_split) == sum(of_plain) == 40_000
    plan = plan_text(split, "simple")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_join_equals_the_plain_join(spark, how):
    rows, known = companies(spark, 3000)
    split, plain = split_join(rows, known, "cnpj_basico", how), rows.join(known, "cnpj_basico", how)
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_split_join_on_two_columns(spark):
    rows, known = companies(spark, 3000)
    rows, known = rows.withColumn("y", F.col("x") % 2), known.withColumn("y", F.col("porte") % 2)
    split, plain = split_join(rows, known, ["cnpj_basico", "y"]), rows.join(known, ["cnpj_basico", "y"], "left")
    assert split.columns == plain.columns and sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_split_join_without_frequent_keys_or_rows(spark):
    rows, known = companies(spark, 100)
    none = rows.limit(0)
    assert frequent_keys(none, "cnpj_basico") == [] and split_join(none, known, "cnpj_basico").count() == 0
    assert split_join(rows, known.limit(0), "cnpj_basico").count() == 100
    with pytest.raises(ValueError, match="right"):
        split_join(rows, known, "cnpj_basico", "full_outer")


def test_every_frequent_key_is_named_and_few_others(spark):
    key = F.when(F.col("id") % 10 < 3, "a").when(F.col("id") % 10 < 5, "b").otherwise(F.col("id").cast("string"))
    rows = spark.range(20_000).select(key.alias("k")).repartition(8)
    found = frequent_keys(rows, "k", 0.05)
    assert {"a", "b"} <= set(found) and len(found) <= 20


IDS = ["00000000", "00000001", "00032767", "00032768", "00032769", "99999999", "1", " 00000001", "0000000x", "", "é", None]


def test_states_count_exactly_and_merge(spark):
    rows = [(k, i, n) for n, i in enumerate(IDS * 3) for k in ("a", None)] + [("b", None, 0), ("c", "00000001", 1)]
    df = spark.createDataFrame(rows, "k string, id string, n int").repartition(4)
    exact = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count_distinct("id").alias("n")).collect()}
    whole = {r["k"]: r["n"] for r in distinct_counts(distinct_state(df, ["k"], "id"), ["k"], "n").collect()}
    assert whole == {k: n for k, n in exact.items() if n} and exact["a"] == len(IDS) - 1
    first, second = distinct_state(df.filter("n % 3 <> 0"), ["k"], "id"), distinct_state(df.filter("n % 3 <> 1"), ["k"], "id")
    merged = merge_states([first, second], ["k"])
    assert {r["k"]: r["n"] for r in distinct_counts(merged, ["k"], "n").collect()} == whole
    assert distinct_counts(distinct_state(df.limit(0), ["k"], "id"), ["k"], "n").collect() == []


def test_sparse_and_full_buckets(spark):
    """A bucket is a bitmap from DENSE numbers on; merging sparse, full and filling buckets stays exact."""
    from terrace.operators.distinct_state import BUCKET_NUMBERS, DENSE

    def numbers(k, first, n, step=1):
        return spark.range(n).select(F.lit(k).alias("k"), F.lpad((F.col("id") * step + first).cast("string"), 8, "0").alias("id"))

    def rows_of(state):
        found = state.groupBy("k").agg(F.count("state_bits").alias("maps"), F.count("state_other").alias("others"))
        return {r["k"]: (r["maps"], r["others"]) for r in found.collect()}

    a = numbers("full", 0, DENSE).unionByName(numbers("sparse", 5, DENSE - 1)).unionByName(numbers("filling", 0, 200)).unionByName(numbers("wide", 0, 300, BUCKET_NUMBERS))
    b = numbers("full", 100, DENSE - 1).unionByName(numbers("sparse", 5, DENSE - 1)).unionByName(numbers("filling", 150, 200))
    first, second = distinct_state(a, ["k"], "id"), distinct_state(b, ["k"], "id")
    assert rows_of(first) == {"full": (1, 0), "sparse": (0, DENSE - 1), "filling": (0, 200), "wide": (0, 300)}
    both = merge_states([first, second], ["k"])
    assert rows_of(both) == {"full": (1, 0), "sparse": (0, DENSE - 1), "filling": (1, 0), "wide": (0, 300)}
    got = {r["k"]: r["n"] for r in distinct_counts(both, ["k"], "n").collect()}
    assert got == {"full": 100 + DENSE - 1, "sparse": DENSE - 1, "filling": 350, "wide": 300}
    # one exchange of the values: bitmaps are built where the set of a bucket stands
    plan = plan_text(distinct_state(a, ["k"], "id").filter("state_bits is not null"), "simple")
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_changed_part_is_counted_alone(spark, scratch):
    df = spark.range(1000).select(F.lit("g").alias("k"), F.lpad(F.col("id").cast("string"), 8, "0").alias("id"))
    store = StateStore(spark, f"{scratch}/state", ["k"], "id")
    store.put("2026-01", df.filter("id < '00000600'"))
    store.put("2026-02", df.filter("id >= '00000400'"))
    assert store.counts("n").first()["n"] == 1000
    store.put("2026-02", df.filter("id >= '00000900'"))
    assert store.counts("n").first()["n"] == 700 and store.counts("n", ["2026-02"]).first()["n"] == 100
    filters = [x for x in plan_text(store.counts("n", ["2026-02"])).splitlines() if "PartitionFilters" in x]
    assert filters and all("state_part" in x for x in filters)
    store.put("01", df.filter("id = '00000007'"))
    assert store.counts("n", ["01"]).first()["n"] == 1


def test_counts_from_footers(spark, scratch):
    from terrace.operators.quality import gate_metrics

    df = spark.range(999).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("key")).repartition(5)
    store = SnapshotStore(spark, scratch)
    observed = store.publish(df.filter("key is not null"), "t", required="key")
    store.publish(df, "u")
    counts = footer_counts(spark, store.current("u"), ["id", "key"])
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(key)]" in plan_text(counts)
    assert counts.first().asDict() == {"n_rows": 999, "n_null_id": 0, "n_null_key": 333}
    assert snapshot_counts(spark, store.current("t"), ["key"]) == observed
    assert store.read("u").agg(*gate_metrics("key")).first()["n_null_key"] == 333
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_files_without_statistics_are_scanned(spark, scratch):
    pq.write_table(pa.table({"id": [1, 2, None], "key": ["a", None, None]}), f"{scratch}/f.parquet", write_statistics=False)
    assert snapshot_counts(spark, scratch, ["id", "key"]) == {"n_rows": 3, "n_null_id": 1, "n_null_key": 2}
    with pytest.raises(Exception, match="missing"):
        snapshot_counts(spark, scratch, ["missing"])


def numbers(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("codigo"))


def test_two_publishers_get_two_numbers(spark, scratch):
    stores = [SnapshotStore(spark, scratch) for _ in range(4)]
    start = threading.Barrier(4)

    def publish(i):
        start.wait()
        stores[i].publish(numbers(spark, i + 1), "t", required="codigo")

    threads = [threading.Thread(target=publish, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    marks = stores[0].marks("t")
    assert [n for n, _ in marks] == [0, 1, 2, 3] and len({v for _, v in marks}) == 4
    assert stores[1].current("t").endswith(marks[-1][1])
    assert sorted(os.listdir(f"{scratch}/t/_published")) == [f"{i:012d}" for i in range(4)]


def test_a_number_taken_meanwhile_is_not_overwritten(spark, scratch, monkeypatch):
    first, second = SnapshotStore(spark, scratch), SnapshotStore(spark, scratch)
    first.publish(numbers(spark, 1), "t")
    stale = iter([[]])  # the second looks before the first has published
    real = second.marks
    monkeypatch.setattr(second, "marks", lambda t: next(stale, None) if (s := real(t)) is None else next(stale, s))
    second.publish(numbers(spark, 2), "t")
    assert [n for n, _ in real("t")] == [0, 1] and first.read("t").count() == 2
    assert not files.create_new(spark, f"{scratch}/t/_published/000000000000", "other")


def test_a_mark_without_content_is_not_current(spark, scratch):
    store = SnapshotStore(spark, scratch)
    store.publish(numbers(spark, 3), "t")
    reader = store.read("t")
    open(f"{scratch}/t/_published/000000000001", "w").close()  # a publisher lost between creating and writing
    assert store.read("t").count() == 3
    store.publish(numbers(spark, 5), "t")
    assert store.read("t").count() == 5 and reader.count() == 3 and [n for n, _ in store.marks("t")] == [0, 1, 2]
    assert len(store.drop_old("t")) == 1 and store.read("t").count() == 5
    store.publish(numbers(spark, 6), "t")
    assert store.marks("t")[-1][0] == 3 and not store.exists("other")
    with pytest.raises(FileNotFoundError):
        store.read("other")
