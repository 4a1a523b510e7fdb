"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Stages take ``(spark, docs, sf_dir)``; all but the last return the columns of their
input. Rows take part under a key made from doc_id and text, so rows that share an id but
not the text are told apart. Every stage decides over all rows that its predecessor kept:

1. ``toxicity``: documents of a score of 0.7 or more go.
2. ``near_duplicates``: documents link at a Jaccard similarity of 0.8 of their sets of five-word
   shingles; of each group of linked documents the one of the smallest id stays
   (one without an id only where none has one).
3. ``contamination``: documents contaminated by ``benchmark`` go.
4. ``personal_data``: spans are replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>``, ``<PHONE>``; ``n_chars`` follows.
5. ``mixing``: per document, how many of its words the mix to target weights takes.

Null or empty texts pass all stages; an empty table passes as it is. A column that the
input lacks is not added (``n_chars`` is only updated where it stands).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontaminate, jaccard_join, mixing, pii, toxicity
from terrace.session import fresh_dir

KEY = "_pipeline_key"
SCORE = "_pipeline_score"
#: Near duplicates: words of a shingle, and hundredths of Jaccard similarity from which documents link.
SHINGLE = 5
PERCENT = 80

#: SQL cannot train a classifier; the stages are tested against brute force instead.
ORACLE_SQL = None


def key() -> Column:
    """A number made from doc_id and text: rows of one key are equal in both."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id`` (the key) and ``text``: what the operators read."""
    return docs.select(key().alias("doc_id"), "text")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(spark, docs.filter(~toxicity.held_out(F.col("doc_id"), 3, 1)).select("doc_id", "text"), labels)
    return toxicity.score(docs, model, SCORE).filter(F.col(SCORE) < toxicity.THRESHOLD).drop(SCORE)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.withColumn(KEY, key())
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    groups = jaccard_join.join(spark, keyed(docs.filter(has_words)), width=SHINGLE, percent=PERCENT, count_links=False)
    named = groups.select(F.col("doc_id").alias(KEY), "component_id").distinct()
    ids = rows.filter(has_words).select(KEY, F.col("doc_id").cast("bigint").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("without"), F.col("id"), F.col(KEY)))
    stay = ids.join(named, KEY).groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{KEY}").alias(KEY))
    kept = rows.filter(has_words).join(stay, KEY, "left_semi").dropDuplicates([KEY])
    return kept.unionByName(rows.filter(~has_words)).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    report = decontaminate.decontaminate(spark, keyed(docs), benchmark)
    gone = report.filter("contaminated").select(F.col("doc_id").alias(KEY)).distinct()
    rows = docs.withColumn(KEY, key()).join(gone, KEY, "left_anti")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with its spans (ordered by start) replaced by the names of their kinds."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in pii.KINDS])
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        apart = F.struct(s["end"].alias("at"), F.concat(state["out"], between, F.get(names, s["kind"])).alias("out"))
        # a span that begins inside the one before it lengthens what is gone
        joined = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))
        return F.when((s["start"] >= state["at"]) | (state["at"] == 0), apart).otherwise(joined)

    return F.aggregate(spans, first, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    found = pii.extract(spark, keyed(docs)).filter(F.size("spans") > 0)
    found = found.groupBy(F.col("doc_id").alias(KEY)).agg(F.first(by_start).alias("_pipeline_spans"))
    rows = docs.withColumn(KEY, key()).join(found, KEY, "left")
    clean = F.when(F.col("_pipeline_spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("_pipeline_spans")))
    rows = rows.withColumn("text", clean)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("_pipeline_spans").isNull(), F.col("n_chars")).otherwise(length))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken(*mixing.mix(spark, docs))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("contamination", remove_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
