"""Host cadence, influence and ranking; vectors and medoids."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import HOST_EVENTS, HOST_EVENTS_SQL, REFERENCE
from marquee.catalog.registry import query
from marquee.operators import hosts as H
from marquee.operators import vectors as V

DAY = "cast(timestamp '2024-01-20' as date)"


@query("host_last_past_event", f"""
select host_name, strftime(max(date), '%Y-%m-%d %H:%M:%S') as last_event from ({HOST_EVENTS_SQL})
where date <= timestamp '2024-01-20' and host_name is not null group by 1""")
def _(t):
    d = H.last_past_event(t.sql(HOST_EVENTS).filter("host_name is not null"), "host_name", "date", REFERENCE)
    return d.select("host_name", F.date_format("last_event", "yyyy-MM-dd HH:mm:ss").alias("last_event"))


GAPS = f"""select host_name, cast(floor(epoch_us(date - lag(date) over (partition by host_name order by date)) / 86400000000.0) as bigint)
  as gap_days from ({HOST_EVENTS_SQL}) where host_name is not null"""


@query("host_gaps", f"""
select host_name, gap_days, count(*) as times from ({GAPS}) where gap_days is not null group by 1, 2""")
def _(t):
    d = H.host_gaps(t.sql(HOST_EVENTS).filter("host_name is not null"), "host_name", "date")
    return d.groupBy("host_name", "gap_days").agg(F.sum("times").alias("times"))


CADENCE = f"""
select host_name, m as median_gap, case when m is null then 'one-off' when m <= 2 then 'daily' when m <= 10 then 'weekly'
  when m <= 20 then 'biweekly' when m <= 45 then 'monthly' else 'occasional' end as frequency
from (select host_name, median(gap_days) as m from ({GAPS}) group by 1)"""


@query("host_cadence", CADENCE)
def _(t):
    return H.cadence(t.sql(HOST_EVENTS), "host_name", "date")


ACTIVITY = f"""
select e.*, last_event, frequency from ({HOST_EVENTS_SQL}) e left join ({CADENCE}) c on c.host_name = e.host_name
left join (select host_name, max(date) as last_event from ({HOST_EVENTS_SQL}) where date <= timestamp '2024-01-20'
  and host_name is not null group by 1) p on p.host_name = e.host_name"""


@query("host_activity_joined", f"""
select id, host_name, frequency, strftime(last_event, '%Y-%m-%d %H:%M:%S') as last_event from ({ACTIVITY})""")
def _(t):
    d = H.attach_activity(t.sql(HOST_EVENTS), "host_name", "date", REFERENCE)
    return d.select("id", "host_name", "frequency", F.date_format("last_event", "yyyy-MM-dd HH:mm:ss").alias("last_event"))


def influence_sql(n, day="date '2024-01-20'"):
    return f"""round({n} * case when last_event is null then 0.0 when datediff('day', cast(last_event as date), {day}) <= 90 then 1.0
    when datediff('day', cast(last_event as date), {day}) <= 365 then 0.5 else 0.1 end
  * case frequency when 'daily' then 1.0 when 'weekly' then 0.9 when 'biweekly' then 0.7 when 'monthly' then 0.5
    when 'occasional' then 0.3 when 'one-off' then 0.1 else 0.2 end::double, 4)"""


@query("host_influence", f"""
select host_name, n, frequency, {influence_sql('n', "date '2024-05-05'")} as score
from (select host_name, count(*) as n, max(last_event) as last_event, max(frequency) as frequency from ({ACTIVITY})
  where host_name is not null group by 1)""")
def _(t):
    d = H.attach_activity(t.sql(HOST_EVENTS), "host_name", "date", REFERENCE).filter("host_name is not null")
    g = d.groupBy("host_name").agg(F.count(F.lit(1)).alias("n"), F.max("last_event").alias("last_event"),
                                   F.max("frequency").alias("frequency"))
    return g.select("host_name", "n", "frequency", H.influence(
        F.col("n"), F.col("last_event"), F.col("frequency"), "2024-05-05").alias("score"))


UNIT = """select vec_id, label, list_transform(embedding, lambda x: cast(x as double) / sqrt(list_sum(list_transform(embedding,
  lambda y: cast(y as double) * cast(y as double))))) as u from embeddings"""


def units(t):
    return V.normalise(t.embeddings.withColumnRenamed("vec_id", "id")).withColumn("label", F.col("label").cast("bigint"))


@query("vector_normalise", f"""
select vec_id as id, round(list_sum(list_transform(u, lambda x: x * x)), 6) as length,
  round(u[1], 6) as first, round(u[len(u)], 6) as last from ({UNIT})""")
def _(t):
    return units(t).select("id", F.round(V.dot(F.col("embedding"), F.col("embedding")), 6).alias("length"),
                           F.round(F.element_at("embedding", 1), 6).alias("first"),
                           F.round(F.element_at("embedding", -1), 6).alias("last"))


@query("vector_centroids", f"""
with s as (select label, i, avg(x) as m from (select label, unnest(u) as x, generate_subscripts(u, 1) as i from ({UNIT})) group by 1, 2)
select cast(label as bigint) as label, round(sqrt(sum(m * m)), 6) as spread, round(max(m) / sqrt(sum(m * m)), 6) as peak from s group by 1""")
def _(t):
    d = units(t)
    sums = V.group_sums(d, ["label"]).select("label", F.transform("vector_sum", lambda x: x / F.col("members")).alias("m"))
    spread = sums.select("label", F.round(F.sqrt(V.dot(F.col("m"), F.col("m"))), 6).alias("spread"))
    peaks = V.centroids(d, ["label"]).select("label", F.round(F.array_max("centroid"), 6).alias("peak"))
    return spread.join(peaks, "label")


PAIRS = f"""select a.label, a.vec_id as a, b.vec_id as b,
  greatest(0, least(2, 1 - list_dot_product(a.u, b.u))) as d from ({UNIT}) a join ({UNIT}) b on a.label = b.label"""
MEANS = f"select label, a as id, sum(case when a = b then 0 else d end) / count(*) as mean_distance from ({PAIRS}) group by 1, 2"


@query("vector_mean_distance", f"""
select cast(label as bigint) as label, id, round(mean_distance, 6) as mean_distance from ({MEANS})""")
def _(t):
    return V.member_distances(units(t), ["label"]).select("label", "id", F.round("mean_distance", 6).alias("mean_distance"))


@query("vector_medoids", f"""
select cast(label as bigint) as label, id, cast(rank as integer) as rank, round(mean_distance, 6) as mean_distance from (
  select *, row_number() over (partition by label order by mean_distance, id) as rank from ({MEANS})) where rank <= 3""")
def _(t):
    return V.medoids(units(t), ["label"]).withColumn("mean_distance", F.round("mean_distance", 6))


@query("vector_rescue_noise", f"""
with c as (select label, i, avg(x) as m from (select label, unnest(u) as x, generate_subscripts(u, 1) as i from ({UNIT})
    where label < 8) group by 1, 2),
cn as (select label, list(m / n order by i) as c from (select *, sqrt(sum(m * m) over (partition by label)) as n from c) group by 1),
d as (select vec_id, cn.label, 1 - list_dot_product(u, c) as d from ({UNIT}) x, cn where x.label >= 8)
select vec_id as id, case when min(d) <= 0.8 then arg_min(label, d) else -1 end::bigint as semantic_label from d group by 1
union all select vec_id, label::bigint from embeddings where label < 8""")
def _(t):
    d = units(t).withColumns({"state": F.lit("all"), "semantic_label": F.when(F.col("label") < 8, F.col("label")).otherwise(-1)})
    return V.rescue_noise(d, cap=0.8).select("id", "semantic_label")


VECTOR_HOSTS = f"""select u.label, u.vec_id as id, 'host ' || cast(u.vec_id % 17 as string) as host_name, e.event_type, e.ts,
  1 - m.mean_distance / max(m.mean_distance) over (partition by u.label) as rep
from embeddings u join events e on e.event_id = u.vec_id join ({MEANS}) m on m.id = u.vec_id"""
VECTOR_ACTIVITY = f"""
with v as ({VECTOR_HOSTS}),
g as (select host_name, cast(floor(epoch_us(ts - lag(ts) over (partition by host_name order by ts)) / 86400000000.0) as bigint) as gap
  from v), f as (select host_name, median(gap) as m from g group by 1),
l as (select host_name, max(ts) as last_event from v where ts <= timestamp '2024-01-20' group by 1)
select v.*, last_event, case when m is null then 'one-off' when m <= 2 then 'daily' when m <= 10 then 'weekly'
  when m <= 20 then 'biweekly' when m <= 45 then 'monthly' else 'occasional' end as frequency
from v left join f using (host_name) left join l using (host_name)"""


def vector_events(t):
    e = t.events.select(F.col("event_id").alias("id"), "event_type", F.col("ts").alias("date"))
    d = units(t).join(e, "id").withColumn("host_name", F.concat(F.lit("host "), (F.col("id") % 17).cast("string")))
    d = d.withColumn("group", F.concat(F.lit("g"), F.col("label").cast("string")))
    return H.attach_activity(d, "host_name", "date", REFERENCE)


@query("rank_events", f"""
select 'g' || label as "group", id, cast(rank as integer) as rank, round(rep, 4) as representativeness, influence,
  round(combined, 4) as combined from (select *, row_number() over (partition by label order by round(combined, 9) desc, id) as rank
  from (select *, 0.5 * rep + 0.5 * influence as combined from (select *, {influence_sql('1')} as influence from ({VECTOR_ACTIVITY}))))
where rank <= 5""")
def _(t):
    return H.rank_events(vector_events(t), ["group"], REFERENCE, k=5)


@query("rank_hosts", f"""
with a as (select * from ({VECTOR_ACTIVITY})),
h as (select label, host_name, max(rep) as m, count(*) as n, max(last_event) as last_event, max(frequency) as frequency,
  string_agg(distinct event_type, ', ' order by event_type) as event_types from a group by 1, 2),
s as (select *, {influence_sql('n')} as raw from h),
p as (select *, case when max(raw) over w > min(raw) over w then (raw - min(raw) over w) / (max(raw) over w - min(raw) over w)
  else 1.0 end as act from s window w as (partition by label)),
r as (select 'g' || label as "group", host_name, cast(n as integer) as events_in_this_group, event_types, round(m, 3) as match_score,
  round(raw, 3) as raw_influence_score, round(act, 3) as activity_score, round(0.5 * m + 0.5 * act, 3) as priority_score from p)
select * exclude (rn) from (select *, row_number() over (partition by "group" order by priority_score desc, host_name) as rn from r)
where rn <= 5""")
def _(t):
    return H.rank_hosts(vector_events(t), "group", "host_name", REFERENCE, k=5)


@query("host_contacts", """
with v as (select label, vec_id, 'host ' || cast(vec_id % 17 as string) as host_name from embeddings)
select 'g' || label as "group", host_name, 'mail' || cast(min(vec_id) as string) || '@x' as contact_email from v group by 1, 2""")
def _(t):
    d = vector_events(t).withColumn("contact_email", F.concat(F.lit("mail"), F.col("id").cast("string"), F.lit("@x")))
    ranked = H.rank_hosts(d, "group", "host_name", REFERENCE, k=None, contacts=("contact_email",))
    return ranked.select("group", "host_name", "contact_email")
