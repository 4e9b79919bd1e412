"""Place and topic grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import HOST_EVENTS, POINTS, POINTS_SQL, REFERENCE
from marquee.catalog.people import UNIT, units
from marquee.catalog.registry import query
from marquee.operators.spatial import core_points, place_groups
from marquee.operators.topics import core_distances, metric_index, topic_groups
from marquee.plans.grouping import fused_label, group_events, stage_label

EPS = 800.0

# A pair within eps of each other, each point with itself included.
NEAR = f"""select a.state, a.id as a, b.id as b from ({POINTS_SQL}) a join ({POINTS_SQL}) b on a.state = b.state
  and abs(a.lat - b.lat) < 0.0073 and abs(a.lon - b.lon) < 0.0097
where 2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
  + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= {EPS}"""
CORE = f"select state, a as id from ({NEAR}) group by 1, 2 having count(*) >= 5"


@query("place_core_points", f"""
select p.id, p.state, c.id is not null as is_core from ({POINTS_SQL}) p left join ({CORE}) c on c.id = p.id""")
def _(t):
    return core_points(t.sql(POINTS), EPS, 5).select("id", "state", "is_core")


@query("place_groups", f"""
with recursive near as materialized ({NEAR}), core as materialized (select a as id from near group by 1 having count(*) >= 5),
edge as materialized (select a, b from near where a in (select id from core) and b in (select id from core)),
comp(id, c) using key (id) as (
  select id, id from core
  union
  select e.a, min(x.c) from comp x join edge e on e.b = x.id join recurring.comp r on r.id = e.a where x.c < r.c group by e.a, r.c),
lab as (select id, c from comp union all
  select n.a, min(c) from near n join comp on comp.id = n.b where n.a not in (select id from core) group by 1),
num as (select state, c, dense_rank() over (partition by state order by c) - 1 as k from
  (select distinct p.state, c from lab join ({POINTS_SQL}) p on p.id = lab.c))
select p.id, p.state, coalesce(k, -1) as spatial_label from ({POINTS_SQL}) p left join lab on lab.id = p.id
  left join num on num.c = lab.c""")
def _(t):
    return place_groups(t.sql(POINTS), EPS, 5).select("id", "state", "spatial_label")


@query("topic_core_distance", f"""
select vec_id as id, round(list_sort(list(d))[5], 6) as core from (select a.vec_id,
  greatest(0, least(2, 1 - list_dot_product(a.u, b.u))) as d from ({UNIT}) a join ({UNIT}) b on a.vec_id <> b.vec_id) group by 1""")
def _(t):
    rows = units(t).select(F.lit("all").alias("grp"), "id", F.col("embedding").alias("vector"))
    return core_distances(metric_index(rows, 128), 5).withColumn("core", F.round("core", 6))


# The hierarchy of every state as two folds: edges by weight to the spanning tree, then its edges by weight to clusters.
# Labels, sizes and cluster states are lists by row number; a merge writes to the smaller of both labels.
TOPICS = f"""
with recursive p as materialized (
  select vec_id as id, 'S' || (vec_id % 2) as state, u, row_number() over (partition by vec_id % 2 order by vec_id) as no from ({UNIT})),
d as materialized (select a.state, a.no as a, b.no as b, greatest(0, least(2, 1 - list_dot_product(a.u, b.u))) as d
  from p a join p b on a.state = b.state and a.no <> b.no),
core as (select state, a, list_sort(list(d))[5] as core from d group by all),
e as (select state, d.a, d.b, greatest(d, x.core, y.core) as w from d join core x using (state, a)
  join core y on y.state = d.state and y.a = d.b where d.a < d.b),
n as (select state, max(no) as n from p group by all having count(*) >= 5),
-- Kruskal: an edge between two labels joins the tree and makes them one.
tree as materialized (
  select state, list_reduce(list_prepend({{l: range(1, n + 1), t: []::struct(a bigint, b bigint, w double)[], a: 0::bigint, b: 0::bigint, w: 0.0::double}}, es), lambda s, x:
    case when s.l[x.a] = s.l[x.b] then s else {{
      l: list_transform(s.l, lambda v: case when v = greatest(s.l[x.a], s.l[x.b]) then least(s.l[x.a], s.l[x.b]) else v end),
      t: list_append(s.t, {{a: x.a, b: x.b, w: x.w}}), a: 0::bigint, b: 0::bigint, w: 0.0::double}} end).t as t
  from (select e.state, list({{l: []::bigint[], t: []::struct(a bigint, b bigint, w double)[], a: a, b: b, w: w}} order by w, a, b) as es from e group by e.state)
  join n using (state)),
-- Every edge with the labels that it joins, which do not depend on the clusters.
joins as materialized (
  select state, list_reduce(list_prepend({{l: range(1, n + 1), o: []::struct(la bigint, lb bigint, lam double)[], a: 0::bigint, b: 0::bigint, w: 0.0::double}},
      list_transform(t, lambda y: {{l: []::bigint[], o: []::struct(la bigint, lb bigint, lam double)[], a: y.a, b: y.b, w: y.w}})), lambda s, x: {{
    l: list_transform(s.l, lambda v: case when v = greatest(s.l[x.a], s.l[x.b]) then least(s.l[x.a], s.l[x.b]) else v end),
    o: list_append(s.o, {{la: least(s.l[x.a], s.l[x.b]), lb: greatest(s.l[x.a], s.l[x.b]), lam: case when x.w > 1e-12 then 1 / x.w else 1e12 end}}),
    a: 0::bigint, b: 0::bigint, w: 0.0::double}}).o as o
  from tree join n using (state)),
step as materialized (select state, k as i, o[k].la as la, o[k].lb as lb, o[k].lam as lam from joins, unnest(range(1, len(o) + 1)) as g(k)),
-- State of each label: size, cluster (0: none), density of the rows that left it, best stability below.
run as (
  select state, 0::bigint as i, list_transform(range(1, n + 1), lambda k: 1::bigint) as size, list_transform(range(1, n + 1), lambda k: 0::bigint) as cl,
    list_transform(range(1, n + 1), lambda k: 0.0::double) as raw, list_transform(range(1, n + 1), lambda k: 0.0::double) as kids,
    list_transform(range(1, n + 1), lambda k: k::bigint) as label, list_transform(range(1, n + 1), lambda k: 0::bigint) as home,
    []::struct(c bigint, up bigint, chosen boolean)[] as closed from n
  union all
  select state, i, list_transform(size, lambda v, k: case when k = la then sa + sb else v end),
    list_transform(cl, lambda v, k: case when k = la then now else v end),
    list_transform(raw, lambda v, k: case when k = la then case when ca > 0 and cb > 0 or (ca = 0 and cb = 0) then (sa + sb) * lam
      when ca > 0 then ra + sb * lam else rb + sa * lam end else v end),
    list_transform(kids, lambda v, k: case when k = la then case when ca > 0 and cb > 0 then greatest(oa, ka) + greatest(ob, kb)
      when ca > 0 then ka when cb > 0 then kb else 0 end else v end),
    list_transform(label, lambda v: case when v = lb then la else v end),
    list_transform(home, lambda v, k: case when v = 0 and now > 0 and (label[k] = la or label[k] = lb) then now else v end),
    case when ca > 0 and cb > 0 then list_concat(closed, [{{c: ca, up: now, chosen: not ka > oa}}, {{c: cb, up: now, chosen: not kb > ob}}]) else closed end
  from (
    select *, ra - sa * lam as oa, rb - sb * lam as ob,
      case when ca > 0 and cb > 0 then i when ca > 0 then ca when cb > 0 then cb when sa + sb >= 5 then i else 0 end as now
    from (
      select r.state, s.i, s.la, s.lb, s.lam, size, cl, raw, kids, label, home, closed, size[s.la] as sa, size[s.lb] as sb,
        cl[s.la] as ca, cl[s.lb] as cb, raw[s.la] as ra, raw[s.lb] as rb, kids[s.la] as ka, kids[s.lb] as kb
      from run r join step s on s.state = r.state and s.i = r.i + 1))),
done as materialized (select r.* from run r join (select state, max(i) as i from run group by state) using (state, i)),
closed as (select state, c.c, c.up, c.chosen from (select state, unnest(closed) as c from done)),
above as (
  select state, c, c as x, chosen, up from closed
  union all select a.state, a.c, k.c, k.chosen, k.up from above a join closed k on k.state = a.state and k.c = a.up),
top as (select state, c, max(x) as top from above where chosen group by all),
found as (
  select p.id, p.state, top.top from p join done on done.state = p.state join top on top.state = p.state and top.c = done.home[p.no]),
named as (select state, top, row_number() over (partition by state order by min(id)) - 1 as label from found group by state, top)
select p.id, p.state, coalesce(label, -1) as semantic_label from p left join found on found.id = p.id
left join named on named.state = found.state and named.top = found.top"""


@query("topic_groups", TOPICS)
def _(t):
    d = units(t).withColumn("state", F.concat(F.lit("S"), (F.col("id") % 2).cast("string")))
    return topic_groups(d).select("id", "state", "semantic_label")


@query("fused_labels", """
select event_id as id, case when event_id % 5 = 0 then 'noise' else 'S' || (user_id % 6) || '-sem' || (event_id % 5 - 1) end as topic,
  case when event_id % 3 = 0 then 'noise' else 'S' || (user_id % 6) || '-spa' || (event_id % 3 - 1) end as place,
  case when event_id % 5 = 0 or event_id % 3 = 0 then 'noise'
    else 'S' || (user_id % 6) || '-sem' || (event_id % 5 - 1) || '_spa' || (event_id % 3 - 1) end as fused from events""")
def _(t):
    d = t.sql(HOST_EVENTS)
    a, b = F.col("id") % 5 - 1, F.col("id") % 3 - 1
    return d.select("id", stage_label(F.col("state"), a, "sem").alias("topic"),
                    stage_label(F.col("state"), b, "spa").alias("place"),
                    fused_label(F.col("state"), a, b).alias("fused"))


def grouping(t):
    """All events with places near their city's place; those without a vector are topic noise."""
    e = t.sql(HOST_EVENTS)
    city = F.regexp_extract("city", "[0-9]+", 0).cast("int")
    e = e.withColumns({
        "latitude": 40.5 + (city % 5) * 0.02 + (F.col("id") % 7) * 0.0005,
        "longitude": F.when(F.col("id") % 41 != 0, -74.0 + (F.col("id") % 5) * 0.0005)})
    vectors = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    return group_events(e, vectors, REFERENCE)


@query("grouping_labels")
def _(t):
    return grouping(t).labels


@query("grouping_rankings")
def _(t):
    return grouping(t).rankings


@query("grouping_summary")
def _(t):
    return grouping(t).summary
