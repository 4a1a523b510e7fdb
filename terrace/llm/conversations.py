"""Repair of conversations: faults of turns, and the cheapest edits to a legal order of roles.

A conversation's rows stand by turn (nulls first), those of one turn by role, then by the
text's SHA-256. A row's first fault counts: blank, a repeated (role and text stood before),
truncated (its last character that is no white space is not ``.``, ``!`` or ``?``). Legal
orders are an optional system turn and pairs of user and assistant. ``auction`` finds the
cheapest edits; here is how its work is spread:

1. Only what the lattice needs travels: id, turn, role, the text's digest and its fault.
   ``ranks`` numbers rows in their conversation, and equal rows of one conversation (those
   after the first are repeats), by range partitions: no conversation and no group of
   copies is gathered.
2. ``TURNS`` consecutive rows are a block, one row of bytes from here on. A conversation of
   one block is solved as it is. Blocks of longer ones are summed up as one step each (cost
   and order of letters between the states), ``TURNS`` steps again as one, until one block
   is left; from there the states between the steps are handed down.
3. Rows and the letters of their blocks meet in one sorted stream a partition, which applies
   the letters, adds up the figures and feeds the repaired text to its SHA-256 as it goes.
   A digest over a conversation has to see its rows in order, so this pass, and only this,
   takes a conversation in one task; it holds one row and the letters, never the texts.

Edge cases: null roles and texts are one space; a role without a first letter ``s``, ``u`` or
``a`` (in lower case) is illegal and cannot be kept; a null conversation id is one
conversation; an empty table gives no row. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import auction as A
from terrace.llm.ranks import ranked
from terrace.session import fresh_dir

TURNS = 32
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
NO_SPACE = r"[^\x20\x09-\x0D]"
_STEP = "array<bigint>"


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the planted damage by the CRC-32 of ``conv_id:turn`` modulo 20."""
    blank = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    return (
        rows.withColumn("_hit", hit)
        .filter("_hit <> 0")
        .select(
            "conv_id",
            F.col("turn").cast("bigint").alias("turn"),
            F.when(F.col("_hit") == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(F.col("_hit") == 1, F.lit("")).when(F.col("_hit") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


def _role(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    code = F.when(first == "s", A.SYSTEM).when(first == "u", A.USER).when(first == "a", A.ASSISTANT)
    return code.otherwise(A.OTHER)


def kinds(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``conv_id, pos, kind`` of every row: role and first fault as one number."""
    text = F.col("text")
    last = F.regexp_extract(text, rf"({NO_SPACE})[\x20\x09-\x0D]*\z", 1)
    small = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2(text, 256)).alias("digest"),
        (~text.rlike(NO_SPACE)).alias("blank"), (~last.isin(".", "!", "?")).alias("open"),
    )
    placed = ranked(spark, small, ["conv_id"], ["turn", "role", "digest"])
    met = ranked(spark, placed.select("conv_id", "role", "digest", "pos", "blank", "open"), ["conv_id", "role", "digest"], ["pos"], "earlier")
    fault = F.when(F.col("blank"), A.BLANK).when(F.col("earlier") > 0, A.DUPLICATE).when(F.col("open"), A.TRUNCATED).otherwise(A.SOUND)
    return met.select("conv_id", "pos", (_role(F.col("role")) * 4 + fault).cast("int").alias("kind"))


def blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, kinds``: the kinds of ``TURNS`` consecutive rows."""
    cut = turns.withColumn("block", F.floor(F.col("pos") / TURNS))
    found = cut.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "kind"))).alias("k"))
    return found.select("conv_id", "block", F.col("k.kind").alias("kinds"))


def _flat(step: A.Steps) -> list[int]:
    return [x for part in step for row in part for x in row]


def _step(flat: list[int]) -> A.Steps:
    rows = [tuple(flat[i : i + 4]) for i in range(0, 32, 4)]
    return tuple(rows[:4]), tuple(rows[4:])


def _steps_of(kinds_of_block: list[int]) -> list[A.Steps]:
    return [A.turn(*divmod(k, 4)) for k in kinds_of_block]


def _sum_up(column: str, steps):
    """Rows of ``conv_id, block`` and a column of what ``steps`` understands, to ``conv_id, block, step``."""

    def run(batches):
        for batch in batches:
            made = [_flat(A.transfer(steps(x))) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], names=["conv_id", "block", "step"])

    return run


def states(spark: SparkSession, steps: DataFrame) -> DataFrame:
    """``conv_id, block, entry, leave`` for every step of conversations of several blocks: the states around it on the best way."""
    kind = steps.schema["conv_id"].dataType.simpleString()
    cut = steps.withColumns({"upper": F.floor(F.col("block") / TURNS), "at": F.col("block")})
    found = cut.groupBy("conv_id", "upper").agg(F.array_sort(F.collect_list(F.struct("at", "step"))).alias("s"))
    path = fresh_dir(spark, "repair-steps")
    found.select("conv_id", F.col("upper").alias("block"), F.col("s.step").alias("steps")).write.parquet(path)
    groups = spark.read.parquet(path)
    long = groups.filter("block > 0").select("conv_id").distinct()
    if long.isEmpty():
        around = groups.withColumns({"entry": F.lit(A.START), "leave": F.lit(None).cast("int")})
    else:
        whole = groups.join(long.withColumn("many", F.lit(True)), groups.conv_id.eqNullSafe(long.conv_id), "left").select(groups["*"], "many")
        sums = whole.filter("many").select("conv_id", "block", "steps").mapInArrow(
            _sum_up("steps", lambda x: list(map(_step, x))), f"conv_id {kind}, block bigint, step {_STEP}"
        )
        above = states(spark, sums)
        one = groups.alias("g").join(above.alias("a"), F.col("g.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("g.block") == F.col("a.block")), "left")
        around = one.select("g.*", F.coalesce("a.entry", F.lit(A.START)).alias("entry"), F.col("a.leave").alias("leave"))

    def run(batches):
        for batch in batches:
            out = []
            for conv, block, steps_of, entry, leave in zip(*(c.to_pylist() for c in batch.columns)):
                way = A.solve(list(map(_step, steps_of)), entry, leave)
                out += [(conv, block * TURNS + i, a, b) for i, (a, b) in enumerate(zip(way, way[1:]))]
            cols = list(zip(*out)) or [[]] * 4
            types = (batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", "block", "entry", "leave"])

    rows = around.select("conv_id", "block", "steps", "entry", "leave")
    return rows.mapInArrow(run, f"conv_id {kind}, block bigint, entry int, leave int")


def audits(spark: SparkSession, found: DataFrame) -> DataFrame:
    """``conv_id, block, kinds, letters``: the edits of every block (see ``blocks``), but for what is inserted behind the last row."""
    kind = found.schema["conv_id"].dataType.simpleString()
    long = found.filter("block > 0").select("conv_id").distinct()
    tagged = found.alias("b").join(long.withColumn("many", F.lit(True)).alias("l"), F.col("b.conv_id").eqNullSafe(F.col("l.conv_id")), "left")
    path = fresh_dir(spark, "repair-blocks")
    tagged.select("b.*", F.coalesce("many", F.lit(False)).alias("many")).write.parquet(path)
    rows = spark.read.parquet(path)
    sums = rows.filter("many").select("conv_id", "block", "kinds").mapInArrow(_sum_up("kinds", _steps_of), f"conv_id {kind}, block bigint, step {_STEP}")
    around = states(spark, sums)
    both = F.col("r.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("r.block") == F.col("a.block"))
    known = rows.alias("r").join(around.alias("a"), both, "left").select("r.conv_id", "r.block", "r.kinds", F.coalesce("a.entry", F.lit(A.START)), "a.leave")

    def run(batches):
        for batch in batches:
            made = [A.audit(bytes(k), e, x) for k, e, x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())], names=["conv_id", "block", "kinds", "letters"])

    return known.mapInArrow(run, f"conv_id {kind}, block bigint, kinds array<int>, letters string")


class _Repair:
    """One conversation as its rows pass: figures, audit and the digest of the repaired text."""

    names = {A.USER: "user", A.ASSISTANT: "assistant"}

    def __init__(self, conv):
        self.conv, self.letters, self.kinds = conv, [], []
        self.sha, self.empty, self.state = hashlib.sha256(), True, A.START
        self.low = self.high = self.last = None
        self.turns = 0

    def edits(self, kinds: list[int], letters: str) -> None:
        self.kinds += kinds
        self.letters.append(letters)

    def ready(self) -> None:
        self.audit = "".join(self.letters)
        self.at = 0

    def put(self, line: str) -> None:
        self.sha.update((line if self.empty else "\n" + line).encode())
        self.empty = False

    def insert(self) -> None:
        self.state = A.FOLLOWS[self.state]
        self.put(self.names[self.state] + ":")

    def row(self, number: int, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        while self.audit[self.at] == "I":
            self.insert()
            self.at += 1
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = A.FOLLOWS[self.state]
            self.put(f"{self.names[self.state]}:{text}")
        elif letter == "K":
            self.state = self.kinds[number] // 4
            self.put(f"{role}:{text}")

    def result(self) -> tuple:
        tail = A.TAIL[self.state]
        for _ in tail:
            self.insert()
        letters = self.audit + tail
        faults = [k % 4 for k in self.kinds]
        roles = [k // 4 for k in self.kinds]
        legal = {(A.SYSTEM, A.USER), (A.USER, A.ASSISTANT), (A.ASSISTANT, A.USER)}
        kept = [x for x in self.audit if x != "I"]
        cost = sum({"K": A.KEEP, "R": A.REROLE, "D": A.DELETE, "I": A.INSERT}[x] for x in letters)
        cost += sum(f == A.TRUNCATED and x != "D" for f, x in zip(faults, kept)) * A.OPEN
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [faults.count(f) for f in (A.BLANK, A.DUPLICATE, A.TRUNCATED)]
        return (self.conv, gaps, *counts, sum(p not in legal for p in zip(roles, roles[1:])), cost, letters, self.sha.hexdigest())


def _stream(batches):
    """Sorted rows of a partition to one row a conversation. Part 0 names it, part 1 brings its blocks, part 2 its rows."""

    def out(done: list[_Repair], kind) -> pa.RecordBatch:
        cols = list(zip(*(r.result() for r in done))) or [[]] * 9
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", *FIGURES, "audit", "repaired_sha256"])

    now, number, kind = None, 0, None
    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, part, _, turn, role, text, of_block, letters in zip(*(c.to_pylist() for c in batch.columns)):
            if part == 0:
                if now is not None:
                    done.append(_closed(now, number))
                now, number = _Repair(conv), 0
            elif part == 1:
                now.edits(of_block, letters)
            else:
                if number == 0:
                    now.ready()
                now.row(number, turn, role, text)
                number += 1
        if done:
            yield out(done, kind)
    if now is not None:
        yield out([_closed(now, number)], kind)


def _closed(repair: _Repair, rows: int) -> _Repair:
    if rows == 0:
        repair.ready()
    return repair


def repair(spark: SparkSession, rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id``, the figures, ``audit`` and ``repaired_sha256`` of every id of ``conversations``, whose rows are ``rows``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    path = fresh_dir(spark, "repair-audits")
    audits(spark, blocks(kinds(spark, rows))).write.parquet(path)
    found = spark.read.parquet(path)
    none = {c: F.lit(None).cast(t) for c, t in (("block", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"), ("kinds", "array<int>"), ("letters", "string"))}
    columns = ["conv_id", "part", "block", "turn", "role", "text", "kinds", "letters"]
    heads = conversations.select("conv_id").distinct().withColumns({"part": F.lit(0), **none}).select(columns)
    edits = found.withColumns({"part": F.lit(1), **{c: none[c] for c in ("turn", "role", "text")}}).select(columns)
    texts = rows.withColumns({"part": F.lit(2), **{c: none[c] for c in ("block", "kinds", "letters")}}).select(columns)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "part", "block", "turn", "role")]
    stream = heads.unionByName(edits).unionByName(texts).withColumn("_digest", F.when(F.col("part") == 2, F.unhex(F.sha2("text", 256))))
    stream = stream.repartition("conv_id").sortWithinPartitions(*order, F.col("_digest").asc_nulls_first()).select(columns)
    figures = ", ".join(f"{c} bigint" for c in FIGURES)
    return stream.mapInArrow(_stream, f"conv_id {kind}, {figures}, audit string, repaired_sha256 string")
