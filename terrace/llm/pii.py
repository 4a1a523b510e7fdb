"""Personal data: base patterns, and bootstrapped contextual extraction on top.

Only DataFrame and SQL functions are used.

1. Base entities (e-mail, IP, card, phone) are matched in every whole text. Spark
   lists the matches of a pattern but not their places; the pieces between them
   (``split``) and the matches themselves give the places by adding up lengths.
2. Base entities are the seeds. The words beside an entity are its lexical
   patterns (one or two words to the left, one to the right). Identifier-shaped
   strings that the base patterns do not match are the candidates; they carry
   patterns of the same kinds.
3. Patterns and instances (distinct entity values) form a graph that is scored in
   rounds: a pattern's score is the mean score of its distinct instances (seeds 1,
   candidates what they have earned so far) shrunk towards 0 by ``SHRINK``
   instances; a candidate's score is ``1 - product(1 - score)`` over its patterns
   above ``MIN_PATTERN``. Scores only grow, and rounds go on until none changes by
   more than ``SETTLED``.
4. Candidates of at least ``MIN_INSTANCE`` are added as spans of their kind.

The graph holds values and words of entities only, never texts; sums are
pre-aggregated, so a pattern such as a common word is no hot key.

Edge cases: a null text is empty and has no span; offsets count code points, ends
are exclusive; rows are independent, so repeated or null ids are reported each;
base spans of different kinds may overlap, added ones overlap nothing; an empty
table gives no row. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import fresh_dir

KINDS = ("email", "ip", "card", "phone")
SETTLED = 1e-6
SHRINK = 3.0
MIN_PATTERN = 0.6
MIN_INSTANCE = 0.8
CONTEXT_CHARS = 64

# The contract's patterns. Runs are matched possessively and only from their first
# character (or where the last match ended), which finds the same matches without
# trying every suffix of a long run.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # maximal runs of at least 16 digits; shorter runs never pass and touch no longer one
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts that cannot hold a match are skipped by a plain search.
NEEDS = {"email": ("@",), "ip": (".",), "card": (), "phone": ("+",)}

# Identifier-shaped strings beyond the base patterns.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]++(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}+\.[0-9]{4}+\.[0-9]{4}+\.[0-9]{4}+(?![0-9.])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[-.\x20][0-9]{3}[-.\x20][0-9]{4}(?![0-9])",
}
SHAPE_NEEDS = {"email": ("(at)", "[at]", "{at}"), "ip": (":",), "card": (".",), "phone": ()}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)

    def add(total, i):
        d = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        d = digits(value)
        return F.length(d).between(16, 19) & luhn(d)
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def spans(text: Column, pattern: str, kind: str, needs: tuple[str, ...], keep) -> Column:
    """``[(kind, start, end, value)]`` of the matches of ``pattern`` that ``keep`` accepts."""
    k = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(state, pair):
        start = state["at"] + F.length(pair["piece"])
        end = start + F.coalesce(F.length(pair["value"]), F.lit(0))
        mine = F.array(F.struct(F.lit(k).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value")))
        ok = pair["value"].isNotNull() & keep(pair["value"])
        return F.struct(end.alias("at"), F.when(ok, F.concat(state["out"], mine)).otherwise(state["out"]).alias("out"))

    pairs = F.arrays_zip(pieces.alias("piece"), found.alias("value"))
    listed = F.aggregate(pairs, first, step, lambda s: s["out"])
    may = reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needs]) if needs else F.lit(True)
    if kind != "email":
        may = F.col("has_digit") & may
    may = may & text.rlike(pattern)
    return F.when(may, listed).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    each = [spans(text, BASE[k], k, NEEDS[k], lambda v, k=k: passes(k, v)) for k in KINDS]
    return F.concat(*each)


def candidate_spans(text: Column) -> Column:
    each = [spans(text, SHAPES[k], k, SHAPE_NEEDS[k], lambda v: F.lit(True)) for k in KINDS]
    return F.concat(*each)


def find_spans(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, others``: base spans and candidates with their lexical patterns, no text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("has_digit", F.col("text").rlike("[0-9]"))
    rows = rows.select("doc_id", "text", base_spans(F.col("text")).alias("base"), candidate_spans(F.col("text")).alias("others"))
    overlaps = lambda o: F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"]))
    rows = rows.withColumn("others", F.filter("others", lambda o: ~overlaps(o)))

    def patterns(s):
        lead = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        before = F.split(F.rtrim(F.lower(F.substring(F.col("text"), lead + 1, s["start"] - lead))), r"\s+", -1)
        after = F.split(F.ltrim(F.lower(F.substring(F.col("text"), s["end"] + 1, F.lit(CONTEXT_CHARS)))), r"\s+", 2)
        one = F.element_at(before, -1)
        two = F.when(F.size(before) > 1, F.concat_ws(" ", F.element_at(before, -2), one))
        # the first of the split words may be cut off by the context's length; it only stands in no pattern of one word
        made = F.array(F.concat(F.lit("<1 "), one), F.concat(F.lit("<2 "), two), F.concat(F.lit(">1 "), F.get(after, F.lit(0))))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.array_compact(made).alias("patterns"))

    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.transform("base", patterns).alias("base"),
        F.transform("others", patterns).alias("others"),
    )


def score_candidates(spark: SparkSession, found: DataFrame) -> DataFrame:
    """``kind, value`` of the candidates that the pattern-instance graph accepts."""

    def edges(column: str, seed: bool) -> DataFrame:
        one = found.select(F.explode(column).alias("s")).select("s.kind", F.lower("s.value").alias("value"), F.explode("s.patterns").alias("pattern"))
        return one.distinct().withColumn("seed", F.lit(seed))

    path = fresh_dir(spark, "pii-graph")
    edges("base", True).unionByName(edges("others", False)).write.parquet(path)
    graph = spark.read.parquet(path)
    candidates = graph.filter("not seed")
    scores = candidates.select("kind", "value").distinct().withColumn("score", F.lit(0.0))
    moved = True
    while moved:
        scored = graph.join(scores, ["kind", "value"], "left")
        worth = F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0)))
        patterns = scored.groupBy("kind", "pattern").agg((F.sum(worth) / (F.count(F.lit(1)) + SHRINK)).alias("strength")).filter(F.col("strength") >= MIN_PATTERN)
        earned = candidates.join(patterns, ["kind", "pattern"]).groupBy("kind", "value")
        path = fresh_dir(spark, "pii-scores")
        earned.agg((1 - F.exp(F.sum(F.log(1 - F.least("strength", F.lit(0.999)))))).alias("score")).write.parquet(path)
        now = spark.read.parquet(path)
        # a candidate that has earned nothing before stood at 0
        before = scores.select("kind", "value", F.col("score").alias("before"))
        rise = F.col("score") - F.coalesce("before", F.lit(0.0))
        moved = not now.join(before, ["kind", "value"], "left").filter(rise > SETTLED).isEmpty()
        scores = now
    return scores.filter(F.col("score") >= MIN_INSTANCE).select("kind", "value")


def _listed(column: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(column, one), ",")


def extract(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id``, base spans and all spans (``kind, start, end``, in order) of every document."""
    path = fresh_dir(spark, "pii-spans")
    find_spans(docs).write.parquet(path)
    found = spark.read.parquet(path)
    accepted = score_candidates(spark, found)
    others = found.select("row", F.explode("others").alias("s")).withColumns({"kind": F.col("s.kind"), "value": F.lower("s.value")})
    added = others.join(accepted, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("s.kind", "s.start", "s.end")).alias("added"))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = found.select("row", "doc_id", plain.alias("base")).join(added, "row", "left")
    return rows.select("row", "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")))).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of base spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )
