"""Dashboard and publishing aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import CITY_EVENTS, CITY_EVENTS_SQL, HOST_EVENTS, HOST_EVENTS_SQL, TODAY, strip_sql
from marquee.catalog.registry import query
from marquee.functions.times import day_span
from marquee.operators import aggregates as A
from marquee.operators.filters import in_rolling_window, keep_year
from marquee.plans import dashboard


@query("kpi_row", f"""
select count(*) as rows, count(distinct city) as cities, count(distinct primary_category) as categories from ({CITY_EVENTS_SQL})""")
def _(t):
    return A.kpis(t.sql(CITY_EVENTS), cities="city", categories="primary_category")


@query("category_shares", f"""
select primary_category, count(*) as n, round_even(100.0 * count(*) / (select count(*) from orders), 1) as percentage
from ({CITY_EVENTS_SQL}) where primary_category is not null group by 1""")
def _(t):
    return A.category_shares(t.sql(CITY_EVENTS), "primary_category")


@query("category_share_labels", f"""
select primary_category, n, regexp_replace(cast(round_even(100.0 * n / (select count(*) from orders), 1) as varchar), '\\.0$', '') || '%'
  as percentage from (select primary_category, count(*) as n from ({CITY_EVENTS_SQL}) where primary_category is not null group by 1)""")
def _(t):
    return A.with_label(A.category_shares(t.sql(CITY_EVENTS), "primary_category"))


# Tags with tabs and no-break spaces around them.
TAGS = f"""select {strip_sql('part')} as tag from (select unnest(string_split(replace(tags, ', ', chr(9) || ',' || chr(160)), ',')) as part
  from ({CITY_EVENTS_SQL}) where tags is not null)"""


def wide_tags(t):
    return t.sql(CITY_EVENTS).withColumn("tags", F.replace("tags", F.lit(", "), F.lit("\t,\u00a0")))


@query("tag_shares", f"""
select tag, n, round_even(100.0 * n / total, 1) as percentage from (select tag, count(*) as n,
  (select count(*) from orders) as total from ({TAGS}) group by 1) where 100.0 * n / total > 5""")
def _(t):
    return A.tag_shares(wide_tags(t))


@query("distinct_tags", f"select distinct tag from ({TAGS})")
def _(t):
    return A.distinct_tags(wide_tags(t))


@query("option_list", f"select distinct primary_category from ({CITY_EVENTS_SQL}) where primary_category is not null")
def _(t):
    return A.distinct_values(t.sql(CITY_EVENTS), "primary_category")


WINDOW = f"""select * from ({CITY_EVENTS_SQL}) where cast(date as date) between cast(date '{TODAY}' - interval 12 month as date)
  and date '{TODAY}'"""
TOP = f"""select primary_category, n, row_number() over (order by primary_category = 'Other', n desc, primary_category) as place
from (select primary_category, count(*) as n from ({WINDOW}) where primary_category is not null group by 1
  order by n desc, primary_category limit 5)"""


def window(t):
    return t.sql(CITY_EVENTS).filter(in_rolling_window(F.to_date("date"), TODAY, 12))


@query("top_categories", f"select primary_category, n, cast(place as integer) as place from ({TOP})")
def _(t):
    return A.top_categories(window(t), "primary_category")


@query("category_months", f"""
with s as (select primary_category, cast(place as integer) as place, unnest(generate_series(date_trunc('month', date '{TODAY}') - interval 11 month,
  date_trunc('month', date '{TODAY}'), interval 1 month)) as m from ({TOP}))
select s.primary_category, s.place, strftime(m, '%Y-%m') as month, count(w.id) as n from s left join ({WINDOW}) w
  on w.primary_category = s.primary_category and date_trunc('month', w.date) = s.m group by all""")
def _(t):
    d = A.category_months(window(t), "primary_category", "date", TODAY)
    return d.withColumn("month", F.date_format("month", "yyyy-MM"))


@query("months_of_year", f"""
select cast(m as integer) as month_no, strftime(make_date(2000, cast(m as integer), 1), '%B') as month, count(id) as n
from generate_series(1, 12) g(m) left join (select * from ({CITY_EVENTS_SQL}) where event_year = 2001) e
  on month(e.date) = m group by all""")
def _(t):
    return A.months_of_year(keep_year(t.sql(CITY_EVENTS), year=2001), "date")


@query("top_cities", f"""
select city, count(*) as n from ({CITY_EVENTS_SQL}) where city is not null group by 1 order by n desc, city limit 20""")
def _(t):
    return A.top_cities(t.sql(CITY_EVENTS))


@query("most_common_per_host", f"""
with a as (select host_name, inferred_host_type as v, count(*) as n from ({HOST_EVENTS_SQL}) where host_name is not null and v is not null
  group by 1, 2), b as (select host_name, inferred_gtm_segment as v, count(*) as n from ({HOST_EVENTS_SQL})
  where host_name is not null and v is not null group by 1, 2)
select h.host_name, x.v as inferred_host_type, y.v as inferred_gtm_segment
from (select distinct host_name from ({HOST_EVENTS_SQL}) where host_name is not null) h
left join (select *, row_number() over (partition by host_name order by n desc, v) as rn from a) x
  on x.host_name = h.host_name and x.rn = 1
left join (select *, row_number() over (partition by host_name order by n desc, v) as rn from b) y
  on y.host_name = h.host_name and y.rn = 1""")
def _(t):
    return A.most_common(t.sql(HOST_EVENTS), "host_name", ["inferred_host_type", "inferred_gtm_segment"])


@query("group_members", f"""
select state || '-' || city as fused_cluster, count(*) as events, count(distinct host_name) as hosts from ({HOST_EVENTS_SQL})
where state <> 'S0' group by 1""")
def _(t):
    label = F.when(F.col("state") == "S0", "noise").otherwise(F.concat_ws("-", "state", "city"))
    return A.group_members(t.sql(HOST_EVENTS).withColumn("fused_cluster", label))


@query("state_summary", f"""
select state, count(*) as events, count(distinct case when id % 5 > 0 then id % 7 end) as semantic_groups,
  count(distinct case when id % 3 > 0 then id % 11 end) as spatial_groups,
  count(distinct case when id % 5 > 0 and id % 3 > 0 then id % 77 end) as final_groups, 'ok' as status from ({HOST_EVENTS_SQL}) group by 1""")
def _(t):
    def label(ok, k):
        return F.when(ok, (F.col("id") % k).cast("string")).otherwise("noise")

    a, b = F.col("id") % 5 > 0, F.col("id") % 3 > 0
    d = t.sql(HOST_EVENTS).withColumns({"semantic_cluster_label": label(a, 7), "spatial_cluster_label": label(b, 11),
                                        "fused_cluster": label(a & b, 77), "group_status": F.lit("ok")})
    return A.state_summary(d)


# Published events from orders: one or two sources, a flag, coordinates, several texts.
PUBLISHED = """
select cast(o_orderkey as string) as id, 'City ' || cast(o_custkey % 9 as string) as city,
  cast(o_orderdate as date) as date, case when o_orderkey % 7 = 0 then 'Songkick' else o_orderpriority end as first_source,
  o_orderkey % 4 = 0 as many, case o_orderkey % 5 when 0 then true when 1 then false end as isPaid,
  case when o_orderkey % 8 <> 0 then 40.5 end as latitude, case when o_orderkey % 3 = 0 then '' else o_orderstatus end as description,
  case when o_orderkey % 6 = 0 then null else o_orderpriority end as venue, o_orderstatus as address,
  cast(null as string) as endTime, o_orderpriority as category, case when o_orderkey % 2 = 0 then 'i' end as image,
  'u' as url from {orders}
"""
PUBLISHED_SQL = PUBLISHED.format(orders="orders")


def published(t):
    d = t.sql(PUBLISHED)
    return d.withColumn("sources", F.when(F.col("many"), F.array("first_source", F.lit("Other"))).otherwise(
        F.array("first_source")))


FACETS = f"""
select 'cities' as facet, city as key, count(*) as n from ({PUBLISHED_SQL}) group by 2
union all select 'dates', strftime(date, '%Y-%m-%d'), count(*) from ({PUBLISHED_SQL}) group by 2
union all select 'sources', case when many then 'Multiple' else first_source end, count(*) from ({PUBLISHED_SQL}) group by 2
union all select 'flag', case when isPaid is null then 'priceUnknown' when isPaid then 'paid' else 'free' end, count(*)
  from ({PUBLISHED_SQL}) group by 2
union all select 'flag', 'withCoordinates', count(*) from ({PUBLISHED_SQL}) where latitude is not null
union all select 'flag', 'totalEvents', count(*) from ({PUBLISHED_SQL})"""


@query("publish_counts", FACETS)
def _(t):
    return A.publish_counts(published(t))


@query("publish_meta", f"""
select '2026-08-01T12:00:00Z' as "generatedAt", sum(n) filter (where key = 'totalEvents')::bigint as "totalEvents",
  sum(n) filter (where key = 'paid')::bigint as paid, sum(n) filter (where key = 'free')::bigint as free,
  sum(n) filter (where key = 'priceUnknown')::bigint as "priceUnknown",
  sum(n) filter (where key = 'withCoordinates')::bigint as "withCoordinates",
  string_agg(key || '=' || n, ';' order by key) filter (where facet = 'cities') as cities,
  string_agg(key || '=' || n, ';' order by key) filter (where facet = 'sources') as sources,
  count(*) filter (where facet = 'dates') as dates,
  'isPaid null = unknown (not free); endTime null = source does not publish it; inCityArea false = suburb within search radius'
    as "schemaNote" from ({FACETS})""")
def _(t):
    meta = A.publish_meta(published(t), "2026-08-01T12:00:00")

    def listed(c):
        return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))),
                            ";")

    return meta.withColumns({"cities": listed("cities"), "sources": listed("sources"),
                             "dates": F.size("dates").cast("bigint")})


@query("fill_rates", "\nunion all ".join(
    f"select '{f}' as field, count(*) filter (where cast(\"{f}\" as varchar) <> '') as filled, count(*) as total,"
    f" 100 * count(*) filter (where cast(\"{f}\" as varchar) <> '') // greatest(1, count(*)) as percent from ({PUBLISHED_SQL})"
    for f in A.FILL_FIELDS))
def _(t):
    return A.fill_rates(published(t))


@query("ingest_summary", """
with tasks as (select cast(d as date) as day, l_returnflag as site from (select distinct l_returnflag from lineitem),
  generate_series((select min(l_shipdate) from lineitem), (select max(l_shipdate) from lineitem), interval 1 day) g(d))
select site, strftime(day, '%Y-%m-%d') as day, count(l_orderkey) as n, count(l_orderkey) > 0 as written
from tasks left join lineitem on cast(l_shipdate as date) = day and l_returnflag = site group by 1, 2""")
def _(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("site"), F.to_date("l_shipdate").alias("day"))
    bounds = rows.agg(F.min("day").alias("a"), F.max("day").alias("b"), F.collect_set("site").alias("sites"))
    tasks = bounds.select(F.explode("sites").alias("site"), "a", "b").select(
        "site", F.explode(day_span(F.col("a"), F.col("b"))).alias("day"))
    return A.ingest_summary(rows, tasks).withColumn("day", F.col("day").cast("string"))


# The dashboard's pages over events with a time of day, so that some are later today.
MOMENTS = f"select * exclude (date), date + to_hours(cast(id % 24 as integer)) as date from ({CITY_EVENTS_SQL})"
ROLLING = f"select * from ({MOMENTS}) where date >= date '{TODAY}' - interval 12 month and date <= timestamp '{TODAY} 00:00:00'"
YEAR = f"select * from ({MOMENTS}) where event_year = 1996"
MAPPED = "count(case when latitude is not null and longitude is not null and primary_category is not null then 1 end) as mapped, count(*) as total"
SHARES = """select {c}, count(*) as n, round_even(100.0 * count(*) / (select count(*) from ({r})), 1) as percentage from ({r}) where {c} is not null
group by 1"""


def moments(t):
    return t.sql(CITY_EVENTS).withColumn("date", F.col("date").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 24).cast("int")))


def page(name: str, part: str, build, sql: str) -> None:
    """Register one table of one dashboard page."""
    @query(f"page_{name}_{part}", sql)
    def _(t):
        return build(t)[part]


page("overview", "kpis", lambda t: dashboard.overview(wide_tags(t)),
     f"select count(*) as rows, count(distinct city) as cities, count(distinct primary_category) as categories from ({CITY_EVENTS_SQL})")
page("overview", "categories", lambda t: dashboard.overview(wide_tags(t)), SHARES.format(c="primary_category", r=CITY_EVENTS_SQL))
page("overview", "tags", lambda t: dashboard.overview(wide_tags(t)), f"""
select tag, n, round_even(100.0 * n / total, 1) as percentage from (select tag, count(*) as n,
  (select count(*) from orders) as total from ({TAGS}) group by 1) where 100.0 * n / total > 5""")
page("overview", "mapped", lambda t: dashboard.overview(wide_tags(t)), f"select {MAPPED} from ({CITY_EVENTS_SQL})")
page("rolling", "kpis", lambda t: dashboard.rolling_trends(moments(t), TODAY),
     f"select count(*) as rows, count(distinct city) as cities from ({ROLLING})")
page("rolling", "mapped", lambda t: dashboard.rolling_trends(moments(t), TODAY), f"select {MAPPED} from ({ROLLING})")
page("rolling", "top", lambda t: dashboard.rolling_trends(moments(t), TODAY), f"""
select primary_category, n, cast(row_number() over (order by primary_category = 'Other', n desc, primary_category) as integer) as place
from (select primary_category, count(*) as n from ({ROLLING}) where primary_category is not null group by 1
  order by n desc, primary_category limit 5)""")
page("year", "kpis", lambda t: dashboard.year_trends(moments(t), year=1996),
     f"select count(*) as rows, count(distinct city) as cities from ({YEAR})")
page("year", "months", lambda t: dashboard.year_trends(moments(t), year=1996), f"""
select cast(m as integer) as month_no, strftime(make_date(2000, cast(m as integer), 1), '%B') as month, count(id) as n
from generate_series(1, 12) g(m) left join ({YEAR}) e on month(e.date) = m group by all""")
page("year", "cities", lambda t: dashboard.year_trends(moments(t), year=1996),
     f"select city, count(*) as n from ({YEAR}) where city is not null group by 1 order by n desc, city limit 20")
page("year", "mapped", lambda t: dashboard.year_trends(moments(t), year=1996), f"select {MAPPED} from ({YEAR})")
page("host", "kpis", lambda t: dashboard.host_overview(t.sql(HOST_EVENTS)),
     f"select count(*) as rows, count(distinct host_name) as hosts, count(distinct city) as cities from ({HOST_EVENTS_SQL})")


@query("current_year", f"select count(*) as rows, min(event_year) as first, max(event_year) as last from ({CITY_EVENTS_SQL}) where event_year = 1997")
def _(t):
    return keep_year(t.sql(CITY_EVENTS), current_year=1997).agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_year").alias("first"), F.max("event_year").alias("last"))
