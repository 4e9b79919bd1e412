"""Registered queries of the training-data operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op7_exact_dedup(spark, folder):
    """Every document with its group of equal texts, through a new digest index."""
    from marquee.llm.exact_dedup import DigestIndex

    return DigestIndex(spark).classify(table(spark, folder, "documents"))


SQL["op7_exact_dedup"] = r"""
with t as (
  select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
d as (
  select doc_id, length(text) as n, r, sha256(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from t)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
       row_number() over w = 1 as kept, text_sha256
from d
window w as (partition by text_sha256 order by n desc, doc_id nulls last, r)"""


@query
def op9_simhash(spark, folder):
    """Every document with its fingerprint and the smallest id that near fingerprints lead to."""
    from pyspark.sql import functions as F

    from marquee.llm.simhash import near_groups

    return near_groups(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_repetition_rules(spark, folder):
    """Every document with its repetition counts and the verdict."""
    from marquee.llm.repetition import judge

    return judge(table(spark, folder, "documents"))


@query
def op6_quality_classifier(spark, folder):
    """Every document with its quality score."""
    from marquee.llm.quality import classify

    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_secret_scan(spark, folder):
    """Every document with its secret spans."""
    from marquee.llm.secrets import find_secrets, summary

    return summary(find_secrets(table(spark, folder, "documents")))


@query
def op1_sentencepiece(spark, folder):
    """Every document with sampled piece ids and the digest of the text they decode to."""
    from marquee.llm.pieces import encoded, summary

    return summary(encoded(table(spark, folder, "documents")))


@query
def op2_mix_sources(spark, folder):
    """Every document with the words that the mix takes of it."""
    from marquee.llm.mixing import documents_taken

    return documents_taken(table(spark, folder, "documents"))


@query
def op10_ppm_scores(spark, folder):
    """Every document with its unigram score and its score by partial matching."""
    from marquee.llm.ppm import score

    return score(table(spark, folder, "documents"))


@query
def op5_chat_tree(spark, folder):
    """Every conversation, and one that quotes the template, read back from the prefix trees."""
    from pyspark.sql import functions as F

    from marquee.llm.chat import format_conversations

    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    quoting = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), quoting.alias("text"))
    return format_conversations(rows.unionByName(extra))[2]


SQL["op5_chat_tree"] = r"""
with rows as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from rows),
c as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text) as turns,
         coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls last, role, text), '') as loss,
         sum(24 + length(role) + (length(role) - length(replace(role, '\', '')))
             + (length(role) - length(replace(role, chr(10), ''))) + len(regexp_extract_all(role, '<\\*\|'))
             + length(text) + len(regexp_extract_all(text, '<\\*\|'))) as formatted_chars
  from t group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       cast(formatted_chars as bigint) as formatted_chars
from c"""


@query
def op3_license_scan(spark, folder):
    """Every document with its licence notices."""
    from marquee.llm.licences import find_notices, summary

    return summary(find_notices(table(spark, folder, "documents")))


@query
def op13_structure_repair(spark, folder):
    """Every conversation, damaged by hash, with its faults and its cheapest repair."""
    from marquee.llm.repair import damage, summary

    rows = table(spark, folder, "conversations")
    return summary(rows, damage(rows))


SQL["op13_structure_repair"] = r"""
with recursive
hit as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(
             coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda v, z: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)), 4294967295) % 20 as h
  from conversations),
damaged as (
  select conv_id, turn, case when h = 4 then 'user' else role end as role,
         case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when h = 3 then [0, 1] else [0] end) as copy
  from hit where h <> 0),
rows as (
  select conv_id, turn, role, text, left(role, 1) as letter, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
         row_number() over w as i, lag(left(role, 1)) over w as before,
         row_number() over (partition by conv_id, role, text order by turn nulls first) as nth
  from damaged window w as (partition by conv_id order by turn nulls first, role, text)),
faulty as (
  select *, case when body = '' then 'blank' when nth > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
  from rows),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (before is not null and before || letter not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id),
-- Cost and audit from turn i on, for each grammar state: nothing, after system, after user, after assistant.
go as (
  select conv_id, n + 1 as i, {c: 0, a: ''} as s0, {c: 6, a: 'II'} as s1, {c: 3, a: 'I'} as s2, {c: 0, a: ''} as s3 from counts
  union all
  select conv_id, i, case when 3 + t2.c < b0.c or (3 + t2.c = b0.c and 'I' || t2.a < b0.a) then {c: 3 + t2.c, a: 'I' || t2.a} else b0 end,
         case when 3 + t2.c < b1.c or (3 + t2.c = b1.c and 'I' || t2.a < b1.a) then {c: 3 + t2.c, a: 'I' || t2.a} else b1 end, t2, t3
  from (
    select conv_id, i, b0, b1,
           case when 3 + b3.c < b2.c or (3 + b3.c = b2.c and 'I' || b3.a < b2.a) then {c: 3 + b3.c, a: 'I' || b3.a} else b2 end as t2,
           case when 3 + b2.c < b3.c or (3 + b2.c = b3.c and 'I' || b2.a < b3.a) then {c: 3 + b2.c, a: 'I' || b2.a} else b3 end as t3
    from (
      select conv_id, i,
             list_sort([{c: 4 + s0.c, a: 'D' || s0.a},
               {c: case when stays and letter = 's' then extra + s1.c when stays and letter = 'u' then extra + s2.c else 1000000 end,
                a: 'K' || case letter when 's' then s1.a else s2.a end},
               {c: case when stays then 3 + extra + s2.c else 1000000 end, a: 'R' || s2.a}])[1] as b0,
             list_sort([{c: 4 + s1.c, a: 'D' || s1.a}, {c: case when stays and letter = 'u' then extra + s2.c else 1000000 end, a: 'K' || s2.a},
               {c: case when stays then 3 + extra + s2.c else 1000000 end, a: 'R' || s2.a}])[1] as b1,
             list_sort([{c: 4 + s2.c, a: 'D' || s2.a}, {c: case when stays and letter = 'a' then extra + s3.c else 1000000 end, a: 'K' || s3.a},
               {c: case when stays then 3 + extra + s3.c else 1000000 end, a: 'R' || s3.a}])[1] as b2,
             list_sort([{c: 4 + s3.c, a: 'D' || s3.a}, {c: case when stays and letter = 'u' then extra + s2.c else 1000000 end, a: 'K' || s2.a},
               {c: case when stays then 3 + extra + s2.c else 1000000 end, a: 'R' || s2.a}])[1] as b3
      from (
        select g.conv_id, f.i, f.letter, f.fault not in ('blank', 'duplicate') as stays, case when f.fault = 'truncated' then 3 else 0 end as extra,
               g.s0, g.s1, g.s2, g.s3
        from go g join faulty f on f.conv_id is not distinct from g.conv_id and f.i = g.i - 1)))),
best as (select conv_id, s0.c as cost, s0.a as audit from go where i = 1),
walk as (
  select conv_id, audit, 0 as p, 1::bigint as i, 0 as state, null::varchar as line from best
  union all
  select w.conv_id, w.audit, w.p + 1, w.i + case when edit = 'I' then 0 else 1 end,
         case when edit = 'D' then w.state when edit = 'K' then case f.letter when 's' then 1 when 'u' then 2 else 3 end when w.state = 2 then 3 else 2 end,
         case edit when 'D' then null when 'K' then f.role || ':' || f.text
           else case when w.state = 2 then 'assistant:' else 'user:' end || case when edit = 'R' then f.text else '' end end
  from (select *, substr(audit, p + 1, 1) as edit from walk where p < length(audit)) w
  left join faulty f on f.conv_id is not distinct from w.conv_id and f.i = w.i),
mended as (select conv_id, string_agg(line, chr(10) order by p) as lines from walk group by conv_id)
select o.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank, coalesce(c.duplicate, 0)::bigint as duplicate,
       coalesce(c.truncated, 0)::bigint as truncated, coalesce(c.illegal, 0)::bigint as illegal, coalesce(b.cost, 0)::bigint as cost,
       coalesce(b.audit, '') as audit, sha256(coalesce(m.lines, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id
left join mended m on m.conv_id is not distinct from o.conv_id"""


@query
def op11_source_divergence(spark, folder):
    """How every two sources of a language differ, and each source's 200 most distinctive terms."""
    from marquee.llm.divergence import audit

    return audit(table(spark, folder, "documents"))


SQL["op11_source_divergence"] = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
t as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct r) >= 3),
v as (select lang, count(*) as v from kept group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by lang, source, term),
s as (select g.lang, g.source, coalesce(sum(c.n), 0) as total from g left join c using (lang, source) group by g.lang, g.source),
p as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (s.total::hugeint + v.v) as p
  from s join v using (lang) join kept k using (lang) left join c using (lang, source, term)),
l as (
  select p.lang, term, 1 + (1000000000::hugeint * (sum(n)::hugeint + 1)) // (any_value(lt.total)::hugeint + any_value(v.v)) as q
  from p join v using (lang) join (select lang, sum(total) as total from s group by lang) lt using (lang)
  group by p.lang, term),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(x.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by a.lang, a.source, b.source) x on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (
  select p.lang, p.source, term as item, ((p.p - l.q) * (p.p - l.q)) // l.q as value
  from p join l using (lang, term) where p.n > 0 and p.p > l.q),
both_parts as (select *, 'pair' as part from pairs union all select *, 'term' as part from terms),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from both_parts)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 200"""


@query
def op12_jaccard_join(spark, folder):
    """Every document with the size of its set of shingles and the smallest id that similar sets lead to."""
    from marquee.llm.overlap import near_sets

    return near_sets(table(spark, folder, "documents"))


SQL["op12_jaccard_join"] = r"""
with recursive
t as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select doc_id, r, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as sh
  from t),
x as (select r, len(sh) as n, unnest(sh) as g from s),
o as (
  select a.r as ra, b.r as rb, any_value(a.n) as na, any_value(b.n) as nb, count(*) as both_have
  from x a join x b on a.g = b.g and a.r < b.r group by a.r, b.r),
l as (select ra, rb from o where 100 * both_have >= 85 * (na + nb - both_have)),
e as (select ra as f, rb as t from l union all select rb, ra from l),
reach as (select r as f, r as t from s union select reach.f, e.t from reach join e on e.f = reach.t)
select s.doc_id, len(s.sh) as n_shingles, (select min(d.doc_id) from reach join s d on d.r = reach.t where reach.f = s.r) as component_id
from s"""
