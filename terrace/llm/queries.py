"""Registered queries of the operators and their SQL, where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bm25, conversations, decontaminate, jaccard_join, language, main_text, merkle, mixing, pii, substring_dedup, token_counts, toxicity, warc
from terrace.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Documents (and bodies) from this score on are toxic.
TOXIC = toxicity.THRESHOLD


def query(sql: str | None = None):
    def add(fn):
        name = fn.__name__
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL_1 = f"""
with d as (select row_number() over () as r, doc_id, {WORDS} as w from documents),
p as (select r, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35),
h as (select p.r, p.i, md5(array_to_string(w[p.i : p.i + 34], ' ')) as k from p join d using (r)),
s as (select r, i from h where k in (select k from h group by k having count(*) > 1)),
c as (select distinct r, unnest(range(i, i + 35)) as i from s),
g as (select r, list(i) as gone from c group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
       sha256(array_to_string([x[1] for x in list_zip(w, range(1, len(w) + 1)) if gone is null or not list_contains(gone, x[2])], ' ')) as kept_sha256
from d left join g using (r)"""


@query(SQL_1)
def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup.dedup(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("""
with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages),
g as (select d, max(page_id) as top from p where n >= 1000 group by d having count(*) > 1)
select page_id, cast(n as bigint) as payload_bytes, p.d as payload_digest,
       case when page_id < top then 'revisit' else 'response' end as record_type,
       case when page_id < top then top end as refers_to
from p left join g on p.d = g.d and n >= 1000""")
def op2_warc(spark, sf_dir):
    return warc.roundtrip(spark, table(spark, sf_dir, "pages"))


@query()
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = toxicity.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.train(spark, docs.filter(~held), table(spark, sf_dir, "labels"))
    predicted = F.when(F.col("score") >= TOXIC, 1).otherwise(0)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


@query()
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out(F.col("doc_id"), 5, 0)
    model = language.Languages.fit(docs.filter(F.col("lang").isNotNull() & ~held).select("text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "langs")


@query()
def op5_pii(spark, sf_dir):
    return pii.digests(pii.extract(spark, table(spark, sf_dir, "documents")))


@query()
def op6_mixing(spark, sf_dir):
    return mixing.taken(*mixing.mix(spark, table(spark, sf_dir, "documents")))


SQL_7 = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
s as (select count(*) as n, avg(len(w)) as mean from d),
t as (select doc_id, len(w) as dl, unnest(w) as term from d),
tf as (select doc_id, dl, term, count(*) as tf from t group by all),
df as (select term, count(*) as df from tf group by term),
wt as (select tf.doc_id, tf.term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean)) as x from tf join df using (term), s),
sc as (select q.doc_id as query, wt.doc_id as match, round(sum(x), 6) as score
       from (select distinct doc_id, term from tf where doc_id % 50 = 0) q join wt using (term) group by all),
r as (select *, row_number() over (partition by query order by score desc, match) as rank from sc)
select query, cast(rank as integer) as rank, match, score from r where rank <= 10"""


@query(SQL_7)
def op7_topk_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = bm25.top_k(spark, docs, docs.filter("doc_id % 50 = 0"))
    return found.withColumn("score", F.round("score", 6))


_NUMBERS = re.compile(r"[0-9]{4,}|[#$%&*]{3}")


def number_edits(text: str) -> list[tuple[int, int, str]]:
    """The edits of the query: runs of four or more digits become ``0``, triple marks go."""
    return [(m.start(), m.end(), "0" if m[0][0].isdigit() else "") for m in _NUMBERS.finditer(text)]


@query()
def op8_token_counts(spark, sf_dir):
    path = fresh_dir(spark, "token-trees")
    trees = token_counts.with_trees(table(spark, sf_dir, "documents").select("doc_id", "text"))
    trees.write.option("compression", "zstd").parquet(path)
    return token_counts.recount(spark.read.parquet(path), number_edits)


SQL_9 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
             else list_distinct([array_to_string(w[i : i + 2], ' ') for i in range(1, len(w) - 1)]) end as sh from d),
n as (select doc_id, cast(len(sh) as bigint) as n from s),
e as (select doc_id, unnest(sh) as t from s),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from e a join e b on a.t = b.t group by all),
l as (select a, b, k = na.n and k = nb.n as same from c join n na on na.doc_id = a join n nb on nb.doc_id = b
      where 100 * k >= 90 * (na.n + nb.n - k)),
r as (select doc_id as a, doc_id as b from d union select r.a, l.b from r join l on l.a = r.b)
select doc_id, n.n as n_shingles, coalesce((select min(l.b) from l where l.a = n.doc_id and l.same), doc_id) as class_id,
       (select min(r.b) from r where r.a = n.doc_id) as component_id,
       (select count(*) from l where l.a = n.doc_id and l.b <> n.doc_id) as n_links
from n"""


@query(SQL_9)
def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.join(spark, table(spark, sf_dir, "documents"))


_ALNUM = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL_10 = f"""
with d as (select row_number() over () as r, doc_id, {_ALNUM} as w from documents),
b as (select coalesce(cast(item_id as varchar), 'null') as item, {_ALNUM} as w from benchmark),
x as (select distinct item, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as k, least(len(w), 13) as n
      from (select item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as i from b where len(w) > 0)),
z as (select distinct n from x),
p as (select r, z.n, unnest(range(1, len(w) - z.n + 2)) as i from d, z where len(w) >= z.n),
o as (select p.r, p.n, p.i, array_to_string(d.w[p.i : p.i + p.n - 1], ' ') as k from p join d using (r)),
h as (select o.r, o.i, o.n, x.item from o join x on o.k = x.k and o.n = x.n),
c as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from h) group by r),
-- proximity: a start from which every term of a window stands at most two words off its place; found from the rarest term
t as (select row_number() over () as v, k, n from (select distinct k, n from x)),
tk as (select v, n, string_split(k, ' ') as q from t),
tw as (select v, n, unnest(range(0, n)) as o, unnest(q) as word from tk),
dw as (select r, unnest(range(0, len(w))) as i, unnest(w) as word from d),
df as (select word, count(*) as df from dw where word in (select word from tw) group by word),
ra as (select v, n, arg_min(o, (coalesce(df, 0), o)) as o, arg_min(word, (coalesce(df, 0), o)) as word from tw left join df using (word) group by v, n),
an as (select ra.v, ra.n, dw.r, dw.i - ra.o as s from ra join dw using (word)),
ok as (select an.v, an.n, an.r, an.s as at, tw.o, greatest(dw.i - tw.o, an.s) - 2 as lo, least(dw.i - tw.o, an.s) + 2 as hi
       from an join tw on tw.v = an.v join dw on dw.r = an.r and dw.word = tw.word and dw.i - tw.o between an.s - 4 and an.s + 4),
st as (select v, n, r, o, unnest(range(lo, hi + 1)) as s from ok),
nr as (select distinct v, r from (select v, n, r, s from st group by v, n, r, s having count(distinct o) = n)),
ni as (select r, count(distinct item) as n_near_items from nr join t on t.v = nr.v join x on x.k = t.k and x.n = t.n group by r),
m as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from h group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated,
       coalesce(n_near_items, 0) as n_near_items
from d left join c using (r) left join m using (r) left join ni using (r)"""


@query(SQL_10)
def op10_decontamination(spark, sf_dir):
    return decontaminate.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def sql_crc32(text: str) -> str:
    """CRC-32 (unsigned) of a text of ASCII characters: every byte goes in before the first of its eight shifts."""
    shifts = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, v) >> 1, (xor(c, v) & 1) * 3988292384::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {shifts}), lambda c, v: {step}), 4294967295::bigint)"


def _way(cost: str, letter: str, behind: str, allowed: str = "true") -> str:
    """One edit of a row and what is best behind it; out of reach where it is not allowed."""
    return f"{{'c': case when {allowed} then {behind}.c + {cost} else 1000000000000 end, 's': '{letter}' || {behind}.s}}"


def _inserted(behind: str, letters: str = "I") -> str:
    return f"{{'c': {behind}.c + {2 * len(letters)}, 's': '{letters}' || {behind}.s}}"


# z, y, u, a: best cost and letters from row i on when nothing, a system, a user or an assistant turn was put out last
_FREE, _REROLE = "not must", "2 + late"
_BASE = {
    "z0": [_way("3", "D", "z"), _way(_REROLE, "R", "u", _FREE), _way("late", "K", "u", f"{_FREE} and ini = 'u'"), _way("late", "K", "y", f"{_FREE} and ini = 's'")],
    "y0": [_way("3", "D", "y"), _way(_REROLE, "R", "u", _FREE), _way("late", "K", "u", f"{_FREE} and ini = 'u'")],
    "u0": [_way("3", "D", "u"), _way(_REROLE, "R", "a", _FREE), _way("late", "K", "a", f"{_FREE} and ini = 'a'")],
    "a0": [_way("3", "D", "a"), _way(_REROLE, "R", "u", _FREE), _way("late", "K", "u", f"{_FREE} and ini = 'u'")],
}
_BASE_SQL = ", ".join(f"least({', '.join(ways)}) as {name}" for name, ways in _BASE.items())

SQL_11 = rf"""
with recursive o as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {sql_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as hit from conversations),
g as (select conv_id, turn, case when hit = 4 then 'user' else role end as role,
             case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
             unnest(case when hit = 3 then [0, 1] else [0] end) as copy
      from o where hit <> 0),
q as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from g),
k as (select conv_id, i, turn, role, text, left(role, 1) as ini, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
             row_number() over (partition by conv_id, role, text order by i) > 1 as again,
             not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as open from q),
r as (select conv_id, i, turn, role, text, ini, blank, again and not blank as dup, open and not blank and not again as cut,
             blank or again as must, case when open and not blank and not again then 1 else 0 end as late,
             lead(ini) over (partition by conv_id order by i) as next from k),
m as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank,
             count(*) filter (where dup) as duplicate, count(*) filter (where cut) as truncated,
             count(*) filter (where next is not null and ini || next not in ('su', 'ua', 'au')) as illegal
      from r group by conv_id),
b as (
  select conv_id, n as i, {{'c': 0::bigint, 's': ''}} as z, {{'c': 4::bigint, 's': 'II'}} as y, {{'c': 2::bigint, 's': 'I'}} as u, {{'c': 0::bigint, 's': ''}} as a from m
  union all
  select conv_id, i - 1, least(z0, {_inserted('u0')}, {_inserted('a0', 'II')}), least(y0, {_inserted('u0')}, {_inserted('a0', 'II')}),
         least(u0, {_inserted('a0')}), least(a0, {_inserted('u0')})
  from (select b.conv_id, b.i, {_BASE_SQL} from b join r on r.conv_id is not distinct from b.conv_id and r.i = b.i)),
w as (select conv_id, z.c as cost, z.s as audit from b where i = 0),
x as (select conv_id, unnest(string_split(audit, '')) as l, unnest(range(1, length(audit) + 1)) as j from w where audit <> ''),
e as (select *, sum(case when l <> 'I' then 1 else 0 end) over (partition by conv_id order by j) as i,
             sum(case when l <> 'D' then 1 else 0 end) over (partition by conv_id order by j) as put from x),
f as (select e.*, r.role, r.text, r.ini from e left join r on r.conv_id is not distinct from e.conv_id and r.i = e.i and e.l <> 'I'),
h as (select *, max(case when put = 1 and l = 'K' and ini = 's' then 1 else 0 end) over (partition by conv_id) as system from f),
t as (select conv_id, sha256(string_agg(case when l = 'K' then role else case when (put - system) % 2 = 1 then 'user' else 'assistant' end end
                                        || ':' || case when l = 'I' then '' else text end, chr(10) order by j)) as sha
      from h where l <> 'D' group by conv_id)
select c.conv_id, coalesce(m.gaps, 0) as gaps, coalesce(m.blank, 0) as blank, coalesce(m.duplicate, 0) as duplicate, coalesce(m.truncated, 0) as truncated,
       coalesce(m.illegal, 0) as illegal, coalesce(w.cost, 0) as cost, coalesce(w.audit, '') as audit, coalesce(t.sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c left join m on m.conv_id is not distinct from c.conv_id
left join w on w.conv_id is not distinct from c.conv_id left join t on t.conv_id is not distinct from c.conv_id"""


@query(SQL_11)
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(spark, conversations.damage(rows), rows)


def _leaf_sql(n_chars: str) -> str:
    def one(x):
        return f"coalesce(cast(strlen(cast({x} as varchar)) as varchar) || ':' || cast({x} as varchar), '-')"

    return f"sha256({' || '.join(map(one, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree_sql(name: str, base: str) -> str:
    """Nodes (grp, level, idx, node, n: nodes of the level) of every group's tree over ``base`` (grp, pos, node, n)."""
    return f"""{name} as (
  select grp, 0 as level, pos as idx, node, n from {base}
  union all
  select a.grp, a.level + 1, a.idx // 2, sha256(a.node || coalesce(b.node, '')), (a.n + 1) // 2
  from {name} a left join {name} b on b.grp = a.grp and b.idx = a.idx + 1 where a.n > 1 and a.idx % 2 = 0)"""


def _fold_sql(name: str, base: str, tree: str) -> str:
    """Every row's (r) node on its way up through the tree's siblings."""
    return f"""{name} as (
  select r, grp, 0 as level, pos as idx, node, n from {base}
  union all
  select f.r, f.grp, f.level + 1, f.idx // 2, sha256(case when f.idx % 2 = 1 then s.node || f.node else f.node || coalesce(s.node, '') end), (f.n + 1) // 2
  from {name} f left join {tree} s on s.grp = f.grp and s.level = f.level and s.idx = xor(f.idx, 1) where f.n > 1)"""


SQL_12 = f"""
with recursive d as (
  select row_number() over () as r, doc_id, coalesce('=' || lang, '') as grp, {_leaf_sql('n_chars')} as leaf,
         case when {sql_crc32("coalesce(cast(doc_id as varchar), '')")} % 7 = 0 and doc_id is not null then {_leaf_sql('(n_chars + 1)')} end as other
  from documents),
p as (select r, doc_id, grp, leaf as node, coalesce(other, leaf) as changed, row_number() over (partition by grp order by doc_id nulls first, leaf, r) - 1 as pos,
             count(*) over (partition by grp) as n from d),
{_tree_sql('t', 'p')},
s as (select '' as grp, grp as lang, node, row_number() over (order by grp) - 1 as pos, count(*) over () as n from t where n = 1),
{_tree_sql('u', 's')},
sib as (select p.r, t.level, t.node from p join t on t.grp = p.grp and t.idx = xor(p.pos >> t.level, 1)
        union all
        select p.r, 1000 + u.level, u.node from p join s on s.lang = p.grp join u on u.idx = xor(s.pos >> u.level, 1)),
proof as (select r, string_agg(node, '' order by level) as hex from sib group by r),
b as (select r, grp, pos, changed as node, n from p),
{_fold_sql('f', 'b', 't')},
v as (select f.r, '' as grp, s.pos, f.node, s.n from f join s on s.lang = f.grp where f.n = 1),
{_fold_sql('g', 'v', 'u')}
select p.doc_id, p.node as leaf, s.node as subroot, u.node as root, sha256(coalesce(proof.hex, '')) as proof_sha256, g.node as folded_root, g.node = u.node as verified
from p join s on s.lang = p.grp join u on u.n = 1 join g on g.r = p.r and g.n = 1 left join proof on proof.r = p.r"""


@query(SQL_12)
def op12_merkle_manifest(spark, sf_dir):
    return merkle.proofs(merkle.manifest(spark, table(spark, sf_dir, "documents"), merkle.planted_chars()))


# The SQL side knows the pages' form: what stands in the article, its headings and paragraphs, and the references that occur.
SQL_13 = r"""
with a as (select page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '\s+', ' ', 'g') as h from pages),
b as (select page_id, url, string_split(regexp_replace(regexp_replace(h, '</?(p|h1)>|<br>', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)) as l from a),
c as (select page_id, url, list_transform(l, lambda x: trim(regexp_replace(replace(replace(replace(replace(
             x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;?', '&', 'g'))) as l from b),
t as (select page_id, url, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) as text from c)
select page_id, url, text, cast(length(text) as bigint) as n_chars from t"""


@query(SQL_13)
def op13_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))
