"""One query per operator over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractwise.llm import chat, lines, lmscore, minhash, mixing, negatives, packing, quality, repair, secrets, sumsquares, topk, warc
from tractwise.session import replicated_if_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def way(v: str, cost: str, edit: str) -> str:
    """SQL: the way ``v`` (12 digits of cost, then edits) with one more edit."""
    return f"(lpad((substr({v}, 1, 12)::bigint + {cost})::varchar, 12, '0') || substr({v}, 13) || '{edit}')"


def step(v: str, fits: str) -> str:
    """SQL: the way ``v`` with row ``x`` kept if its initial ``fits`` what comes next, else given that role."""
    stays = "(case x.fault when 0 then 0 when 1 then 3 else 90000000 end)"
    return f"(case when x.ini = '{fits}' then {way(v, stays, 'K')} else {way(v, stays + ' + 3', 'R')} end)"


def query(sql: str | None = None):
    """Register a function of a table reader under its own name."""

    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(
            lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query(r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
totals as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from sized group by source),
weighed as (
  select *, [5.0, 2.0, 1.0][(place % 3 + 1)::int]::double as weight, source_size * 3.0::double as cap from totals),
filled as (
  select *, sum(source_size) over () as everything, sum(weight) over () as weights,
    sum(cap) over (order by cap / weight, place) - cap as full_before,
    sum(weight) over (order by cap / weight, place) - weight as weight_before
  from weighed),
leveled as (
  -- the first source, by limit per weight, that the rest would not fill sets the level
  select arg_min((everything - full_before) / (weights - weight_before), cap / weight)
    filter (cap / weight > (everything - full_before) / (weights - weight_before)) as level
  from filled),
targets as (
  select source, source_size, coalesce(least(cap, weight * level), cap)::double as target from weighed, leveled),
rates as (
  select *, case when source_size > 0 then least(3.0, target / source_size) else 0.0 end::double as rate from targets)
select d.doc_id, d.size::bigint as size, r.source_size, r.target,
  (d.size * (floor(r.rate)::int +
   (('0x' || substr(md5('mix:' || coalesce(d.doc_id::varchar, 'null')), 1, 13))::bigint::double / 4503599627370496.0
    < r.rate - floor(r.rate))::int))::bigint as taken
from sized d join rates r on d.source is not distinct from r.source
""")
def op4_mix_sources(table):
    plan = mixing.mix_plan(table("documents").select("doc_id", "text", "source"))
    return plan.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


@query()
def op7_quality_outliers(table):
    return quality.quality_rules(table("documents").select("doc_id", "text", "lang", "source"))


@query()
def op1_setsketch_near_duplicates(table):
    return minhash.near_duplicates(table("documents").select("doc_id", "text"))


@query()
def op5_pattern_packing(table):
    return packing.pack(table("documents").select("doc_id", "text"))


@query()
def op10_fuzzy_lines(table):
    cleaned = lines.dedup_lines(table("documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "text", "dropped_lines", F.coalesce(F.size("dropped_lines"), F.lit(0)).alias("n_dropped"))


@query(r"""
with p as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages
  where page_id is not null),
d as (select *, sha256(html) as digest, min(page_id) over (partition by sha256(html)) as first from p)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when n >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
  case when n >= 100 and first <> page_id then first end as refers_to
from d
""")
def op6_warc_normaliser(table):
    return warc.archive_pages(table("pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(r"""
with t as (
  select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as text from conversations),
s as (select distinct conv_id, speaker as perspective from t where speaker <> 'system'),
r as (
  select t.*, s.perspective, t.speaker = s.perspective as mask,
    '<|im_start|>' || case when t.speaker = 'system' then 'system' when t.speaker = s.perspective then 'assistant'
      else 'user name=' || t.speaker end || chr(10) as head
  from t join s on t.conv_id is not distinct from s.conv_id),
x as (
  select *, head || text || '<|im_end|>' || chr(10) as segment,
    row_number() over w - 1 as place, sum(length(head || text || '<|im_end|>' || chr(10))) over w as upto
  from r window w as (partition by conv_id, perspective order by turn nulls first, speaker, text
    rows between unbounded preceding and current row))
select conv_id, perspective, turn, place::bigint as place, speaker, segment, mask,
  case when mask then upto - length(segment) + length(head) end::bigint as mask_start,
  case when mask then upto - 1 end::bigint as mask_end,
  (upto - length(segment))::bigint as start, upto::bigint as end
from x
""")
def op8_perspective_rotation(table):
    return chat.rotate_perspectives(table("conversations"))


@query(r"""
with v as (
  select vec_id, min(list_transform(embedding, lambda x: floor(x::double * 256)::bigint)) as ints from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  group by vec_id),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.ints::double[], c.ints::double[])::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
""")
def op9_threshold_top_k(table):
    return topk.top_k(table("embeddings"))


@query()
def op2_secret_scan(table):
    return secrets.scan_documents(table("documents").select("doc_id", "text", "source"))


@query()
def op3_cross_entropy_difference(table):
    good = table("labels").where("quality = 1").select(F.col("doc_id").alias("__id")).distinct()
    docs = table("documents").select("doc_id", "text").join(
        replicated_if_small(good), F.col("doc_id") == F.col("__id"), "left")
    return lmscore.cross_entropy_difference(
        docs.withColumn("chosen", F.col("__id").isNotNull()), chosen_column="chosen")


@query()
def op12_sum_of_squares_packing(table):
    return sumsquares.pack_online(table("documents").select("doc_id", "text"))


@query(r"""
with v as (
  select vec_id, min({'label': case when vec_id % 7 = 0 then (label + 1) % 10 else label end::bigint,
    'ints': list_transform(embedding, lambda x: floor(x::double * 256)::bigint)}) as r from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  group by vec_id),
s as (
  select a.vec_id as anchor_id, b.vec_id, a.r.label = b.r.label as own,
    list_inner_product(a.r.ints::double[], b.r.ints::double[])::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where own
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank
  from p join s on s.anchor_id = p.anchor_id and not s.own
    and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5
""")
def op11_str_tree_negatives(table):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table("embeddings").select("vec_id", "embedding", moved.alias("label")))


@query(rf"""
with crc as (
  select list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as t),
k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
      lambda x: ascii(x)::bigint), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::bigint), 4294967295) % 20 as kind
  from conversations, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when kind = 3 then [1, 2] else [1] end) as copy
  from k where kind <> 0),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n from damaged),
faulty as (
  select *, role[1] as ini, lag(role[1]) over (partition by conv_id order by n) as before,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 3
      when row_number() over (partition by conv_id, role, text order by n) > 1 then 2
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 1 else 0 end as fault
  from numbered),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 3) as blank, count(*) filter (fault = 2) as duplicate,
    count(*) filter (fault = 1) as truncated,
    count(*) filter (n > 1 and before || ini not in ('su', 'ua', 'au')) as illegal,
    -- three steps a row: its own edit, an inserted user row, an inserted assistant row
    list_concat([{{'step': 1, 'ini': '', 'fault': 0}}, {{'step': 2, 'ini': '', 'fault': 0}}], flatten(list([
      {{'step': 0, 'ini': ini, 'fault': fault}}, {{'step': 1, 'ini': '', 'fault': 0}}, {{'step': 2, 'ini': '', 'fault': 0}}]
      order by n))) as steps
  from faulty group by conv_id),
-- a way: its cost in 12 digits, then its edits; the ways to start, system, user, assistant
searched as (
  select * exclude (steps), list_reduce(steps, lambda v, x: case x.step
    when 0 then [
      {way('v[1]', '4', 'D')},
      least({way('v[2]', '4', 'D')}, case when x.ini = 's' then {way('v[1]', '(case x.fault when 0 then 0 when 1 then 3 else 90000000 end)', 'K')} else '099999999999' end),
      least({way('v[3]', '4', 'D')}, {step('v[1]', 'u')}, {step('v[2]', 'u')}, {step('v[4]', 'u')}),
      least({way('v[4]', '4', 'D')}, {step('v[3]', 'a')})]
    when 1 then [v[1], v[2], least(v[3], {way('v[1]', '3', 'I')}, {way('v[2]', '3', 'I')}, {way('v[4]', '3', 'I')}), v[4]]
    else [v[1], v[2], v[3], least(v[4], {way('v[3]', '3', 'I')})] end,
    ['000000000000', '090000000000', '090000000000', '090000000000']) as ways
  from counted),
best as (select * exclude (ways), least(ways[1], ways[4]) as way from searched),
edits as (
  select conv_id, pos, substr(way, 12 + pos, 1) as edit,
    count(*) filter (substr(way, 12 + pos, 1) <> 'I') over (partition by conv_id order by pos) as n
  from (select conv_id, way, unnest(range(1, length(way) - 11)) as pos from best)),
stay as (
  select e.conv_id, e.edit, f.role, f.text, f.ini, row_number() over w as place,
    first_value(e.edit = 'K' and f.ini = 's') over w as system
  from edits e left join faulty f on e.conv_id is not distinct from f.conv_id and e.n = f.n and e.edit <> 'I'
  where e.edit <> 'D' window w as (partition by e.conv_id order by e.pos)),
texts as (
  select conv_id, string_agg(case when edit = 'K' then role when (place - system::int) % 2 = 1 then 'user' else 'assistant' end
    || ':' || coalesce(text, ''), chr(10) order by place) as body
  from stay group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(way[:12]::bigint, 0) as cost,
  coalesce(way[13:], '') as audit, sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join best b on c.conv_id is not distinct from b.conv_id
left join texts t on c.conv_id is not distinct from t.conv_id
""")
def op13_conversation_repair(table):
    return repair.repair_report(table("conversations"))
