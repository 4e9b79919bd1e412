"""Lookup and overlay queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import CITIES_SQL, HOST_EVENTS, LISTINGS, LISTINGS_SQL
from marquee.catalog.registry import query
from marquee.functions.text import url_host
from marquee.operators import joins
from marquee.schema import city_dimension


@query("join_city", f"""
select canonical_city, tz, count(*) as n from ({LISTINGS_SQL}) l join (select * from {CITIES_SQL}) c using (city_folder)
group by 1, 2""")
def _(t):
    d = joins.attach_city(t.sql(LISTINGS), city_dimension(t.spark))
    return d.groupBy("canonical_city", "tz").agg(F.count(F.lit(1)).alias("n"))


@query("join_country_zone", """
select c_custkey, case c_custkey % 8 when 0 then 'America/Mexico_City' when 1 then 'America/New_York' when 2 then 'America/Toronto'
  when 3 then 'Europe/London' when 4 then 'Europe/Madrid' when 5 then 'America/Argentina/Buenos_Aires'
  else 'America/New_York' end as tz from customer""")
def _(t):
    code = F.expr("""case c_custkey % 8 when 0 then 'mx' when 1 then ' US' when 2 then 'CA' when 3 then 'gb' when 4 then 'ES'
                     when 5 then 'ar' when 6 then 'ZZ' else null end""")
    return t.customer.select("c_custkey", joins.country_zone(code).alias("tz"))


@query("join_site_rule", """
select page_id, case when ends_with(host, '.example.com') or host = 'example.com' then 'com'
  when starts_with(host, 'm.') and ends_with(host, '.example.net') then 'net' when ends_with(host, '.example.org') then 'org' end as site
from (select page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host from pages)""")
def _(t):
    spark = t.spark
    hosts = t.pages.select("page_id", url_host(F.col("url")).alias("host"))
    rules = spark.createDataFrame([(0, "com", "example.com"), (2, "org", "example.org"), (3, "other", "nowhere.test")],
                                  "ord int, site string, domain string")
    # Rules taken from the table itself: every mobile .net host.
    mobile = hosts.filter(F.startswith("host", F.lit("m.")) & F.endswith("host", F.lit(".example.net"))).select(
        F.lit(1).alias("ord"), F.lit("net").alias("site"), F.col("host").alias("domain")).distinct()
    return joins.match_site(hosts, rules.unionByName(mobile)).select("page_id", "site")


@query("join_overlay", """
select c_custkey, coalesce(nullif(case when o.n % 3 = 0 then '' else o.prio end, ''), c_mktsegment) as label,
  coalesce(nullif(o.status, ''), c_name) as name
from customer left join (select o_custkey, count(*) as n, min(o_orderpriority) as prio, max(o_orderstatus) as status
  from orders group by 1) o on o_custkey = c_custkey""")
def _(t):
    found = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderpriority").alias("prio"), F.max("o_orderstatus").alias("name"))
    found = found.withColumn("label", F.when(F.col("n") % 3 == 0, "").otherwise(F.col("prio")))
    current = t.customer.select("c_custkey", F.col("c_mktsegment").alias("label"), F.col("c_name").alias("name"))
    return joins.overlay(current, found, "c_custkey", ["label", "name"])


@query("join_gazetteer", f"""
select _ord, case when hit then cast(40 + k % 9 as string) || '.25' else latitude end as latitude, hit as geocoded
from (select _ord, latitude, coalesce(trim(latitude) in ('', '0') and address <> '' and k % 2 = 0, false) as hit, k
  from (select *, try_cast(split_part(address, ' ', 1) as integer) as k from ({LISTINGS_SQL})))""")
def _(t):
    # One place per even house number that occurs, per raw city text.
    d = t.sql(LISTINGS)
    number = F.split("address", " ")[0].try_cast("int")
    places = d.filter((F.col("address") != "") & (number % 2 == 0)).select(
        joins.address_key(F.col("address")).alias("address_key"), "city",
        (40 + number % 9 + 0.25).cast("double").alias("g_lat"), F.lit(-73.5).alias("g_lon")).distinct()
    return joins.fill_coordinates(d, places).select("_ord", "latitude", "geocoded")


@query("join_embeddings", """
select e.event_id as id, label, round(list_sum(list_transform(v.embedding, lambda x: cast(x as double))), 4) as total
from events e join embeddings v on v.vec_id = e.event_id""")
def _(t):
    vectors = t.embeddings.withColumnRenamed("vec_id", "id")
    d = joins.attach_embeddings(t.sql(HOST_EVENTS), vectors).join(vectors.select("id", "label"), "id")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return d.select("id", "label", F.round(total, 4).alias("total"))
