"""Time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import CITIES_SQL, LISTINGS, LISTINGS_SQL
from marquee.catalog.registry import query
from marquee.functions import times as D
from marquee.operators.joins import attach_city
from marquee.schema import city_dimension

def ny():
    return F.lit("America/New_York")


def text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# Start of a listing as the check SQL reads it: the shape is known from the row number.
PARSED = f"""
select l.*, canonical_city, tz,
  case when start_time in ('tba', '') then null
    when _ord % 5 < 2 then cast(substr(start_time, 1, 10) as timestamp)
    when _ord % 5 = 2 then timezone(tz, timezone('UTC', cast(replace(replace(start_time, 'T', ' '), 'Z', '') as timestamp)))
    else cast(replace(start_time, 'T', ' ') as timestamp) end as start_local,
  start_time not in ('tba', '') and _ord % 5 >= 2 as has_time
from ({LISTINGS_SQL}) l join (select * from {CITIES_SQL}) c using (city_folder)"""

MOMENT = f"""
select _ord, strftime(start_local, '%Y-%m-%d %H:%M:%S') as start_local,
  strftime(timezone('UTC', timezone(tz, start_local)), '%Y-%m-%d %H:%M:%S') as start_utc, has_time as start_has_time
from ({PARSED})"""


def listings(t):
    return attach_city(t.sql(LISTINGS), city_dimension(t.spark))


@query("time_parse_moment", MOMENT)
def _(t):
    d = D.add_moment(listings(t), "start_time", "start", F.col("tz"))
    return d.select("_ord", text("start_local").alias("start_local"), text("start_utc").alias("start_utc"),
                    "start_has_time")


@query("time_normalize_end", f"""
select _ord, strftime(end_local, '%Y-%m-%d %H:%M:%S') as end_local from (
  select _ord, case when _ord % 3 = 2 then timezone(tz, timezone('UTC',
    cast(replace(substr(end_time, 1, 19), 'T', ' ') as timestamp) + interval 5 hour)) end as end_local
  from ({LISTINGS_SQL}) l join (select * from {CITIES_SQL}) c using (city_folder))""")
def _(t):
    d = D.add_moment(listings(t), "end_time", "end", F.col("tz"))
    return d.select("_ord", text(F.when(F.col("end_has_time"), F.col("end_local"))).alias("end_local"))


@query("time_local_day", f"select _ord, strftime(start_local, '%Y-%m-%d') as day from ({PARSED})")
def _(t):
    d = D.add_moment(listings(t), "start_time", "start", F.col("tz"))
    return d.select("_ord", F.to_date("start_local").cast("string").alias("day"))


@query("time_iso_with_offset", """
select l_orderkey, l_linenumber, strftime(w, '%Y-%m-%dT%H:%M:%S')
  || case when datediff('hour', u, w) = -4 then '-04:00' else '-05:00' end as iso
from (select *, case when timezone('America/New_York', timezone('UTC', late - interval 1 hour)) = w
    then late - interval 1 hour else late end as u
  from (select *, timezone('UTC', timezone('America/New_York', w)) as late from (
    select l_orderkey, l_linenumber, l_shipdate + to_minutes(cast(l_orderkey % 1440 as integer)) as w from lineitem)))""")
def _(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_shipdate") + F.make_dt_interval(
        mins=(F.col("l_orderkey") % 1440).cast("int"))).alias("w"))
    d = d.withColumn("u", D.from_zone(F.col("w"), ny()))
    return d.select("l_orderkey", "l_linenumber", D.iso_with_offset(F.col("w"), F.col("u")).alias("iso"))


@query("time_display", """
select event_id, case when event_id % 4 = 0 then 'All day' else strftime(ts, '%-I:%M %p') end as shown from events""")
def _(t):
    return t.events.select("event_id", D.display_time(F.col("ts"), F.col("event_id") % 4 != 0).alias("shown"))


@query("time_city_text", f"""
select _ord, case when start_time in ('tba', '') or _ord % 5 = 1 then ''
    when _ord % 5 = 2 then strftime(timezone('America/New_York',
      timezone('UTC', cast(replace(replace(start_time, 'T', ' '), 'Z', '') as timestamp))), '%-m/%-d/%Y  %I:%M:%S %p')
    else strftime(cast(replace(start_time, 'T', ' ') as timestamp), '%-m/%-d/%Y  %I:%M:%S %p') end as new_york,
  case when start_time in ('tba', '') or _ord % 5 = 1 then ''
    when _ord % 5 = 2 then strftime(timezone('America/Mexico_City',
      timezone('UTC', cast(replace(replace(start_time, 'T', ' '), 'Z', '') as timestamp))), '%-m/%-d/%Y  %I:%M:%S %p')
    else strftime(cast(replace(start_time, 'T', ' ') as timestamp), '%-m/%-d/%Y  %I:%M:%S %p') end as mexico_city
from ({LISTINGS_SQL})""")
def _(t):
    d = D.add_lenient(t.sql(LISTINGS), "start_time", "p")
    return d.select("_ord", D.city_time_text(F.col("p"), ny()).alias("new_york"),
                    D.city_time_text(F.col("p"), F.lit("America/Mexico_City")).alias("mexico_city"))


@query("time_utc_text", """
select o_orderkey, strftime(timezone('UTC', timezone('America/Mexico_City', w)), '%Y-%m-%dT%H:%M:%SZ') as utc
from (select o_orderkey, o_orderdate + to_hours(cast(6 + o_orderkey % 16 as integer)) as w from orders)""")
def _(t):
    d = t.orders.select("o_orderkey", F.date_format(F.col("o_orderdate") + F.make_dt_interval(
        hours=(6 + F.col("o_orderkey") % 16).cast("int")), "yyyy-MM-dd'T'HH:mm:ss").alias("w"))
    return D.add_lenient(d, "w", "p").select(
        "o_orderkey", D.utc_text(F.col("p"), F.lit("America/Mexico_City")).alias("utc"))


LENIENT = """
select event_id, case event_id % 8 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S')
  when 2 then strftime(ts, '%Y-%m-%d') when 3 then strftime(ts, '%B %-d, %Y') when 4 then strftime(ts, '%-m/%-d/%Y')
  when 5 then strftime(ts, '%b %-d, %Y') when 6 then 'soon' else '' end as raw, ts from events"""


def lenient_input(t):
    ts = F.col("ts")
    shape = F.col("event_id") % 8
    raw = (F.when(shape == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(shape == 1, F.date_format(
        ts, "yyyy-MM-dd HH:mm:ss")).when(shape == 2, F.date_format(ts, "yyyy-MM-dd")).when(
        shape == 3, F.date_format(ts, "MMMM d, yyyy")).when(shape == 4, F.date_format(ts, "M/d/yyyy")).when(
        shape == 5, F.date_format(ts, "MMM d, yyyy")).when(shape == 6, "soon").otherwise(""))
    return t.events.select("event_id", raw.alias("raw"), "ts")


@query("time_parse_lenient", f"""
select event_id, raw, case when event_id % 8 < 2 then strftime(ts, '%Y-%m-%d %H:%M:%S')
  when event_id % 8 < 6 then strftime(ts, '%Y-%m-%d 00:00:00') end as read_as from ({LENIENT})""")
def _(t):
    return D.add_lenient(lenient_input(t), "raw", "p").select("event_id", "raw", text("p.written").alias("read_as"))


@query("time_long_date", f"""
select event_id, case when event_id % 8 >= 6 then raw else strftime(ts, '%A, %B %-d, %Y') end as shown from ({LENIENT})""")
def _(t):
    return D.add_lenient(lenient_input(t), "raw", "p").select(
        "event_id", D.long_date(F.col("raw"), F.col("p")).alias("shown"))


@query("time_range", """
select event_id, case event_id % 4 when 0 then strftime(ts, '%-I:%M %p') when 1 then '' when 2 then '7:30 pm'
    else strftime(ts, '%-I:%M %p') || ' - ' || strftime(ts + interval 90 minute, '%-I:%M %p') end as shown
from events""")
def _(t):
    ts, k = F.col("ts"), F.col("event_id") % 4
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    d = t.events.select(
        "event_id",
        F.when(k == 1, F.date_format(ts, "yyyy-MM-dd")).when(k == 2, "7:30 pm").otherwise(
            F.date_format(ts, iso)).alias("s"),
        F.when(k == 0, "").otherwise(F.when(k == 3, F.date_format(ts + F.expr("interval 90 minutes"), iso)).otherwise(
            "2024-01-01")).alias("e"))
    d = D.add_lenient(D.add_lenient(d, "s", "sp"), "e", "ep")
    return d.select("event_id", D.time_range(D.short_time(F.col("s"), F.col("sp")),
                                             D.short_time(F.col("e"), F.col("ep"))).alias("shown"))


@query("time_date_range", """
select o_orderkey, strftime(o_orderdate, '%A, %B %-d, %Y') || case when o_orderkey % 3 = 0 then '' else
  ' – ' || strftime(o_orderdate + to_days(cast(o_orderkey % 3 as integer)), '%A, %B %-d, %Y') end as shown from orders""")
def _(t):
    d = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"), F.date_format(
        F.date_add("o_orderdate", (F.col("o_orderkey") % 3).cast("int")), "yyyy-MM-dd").alias("e"))
    d = D.add_lenient(D.add_lenient(d, "s", "sp"), "e", "ep")
    return d.select("o_orderkey", D.date_range(
        F.col("s"), D.long_date(F.col("s"), F.col("sp")), F.col("e"),
        D.long_date(F.col("e"), F.col("ep"))).alias("shown"))


@query("time_day_window_utc", """
select o_orderkey, strftime(timezone('UTC', timezone('America/New_York', o_orderdate)), '%Y-%m-%dT%H:%M:%SZ') as start_time,
  strftime(timezone('UTC', timezone('America/New_York', o_orderdate + interval 1 day - interval 1 microsecond)),
    '%Y-%m-%dT%H:%M:%SZ') as end_time from orders""")
def _(t):
    return t.orders.select("o_orderkey", D.day_window_utc(F.to_date("o_orderdate"), ny()).alias("w")).select(
        "o_orderkey", "w.*")


@query("time_day_span", """
select o_orderkey, strftime(unnest(generate_series(least(a, b), greatest(a, b), interval 1 day)), '%Y-%m-%d') as day
from (select o_orderkey, o_orderdate as a, o_orderdate + to_days(cast(o_orderkey % 5 - 2 as integer)) as b from orders)""")
def _(t):
    a = F.to_date("o_orderdate")
    b = F.date_add("o_orderdate", (F.col("o_orderkey") % 5 - 2).cast("int"))
    return t.orders.select("o_orderkey", F.explode(D.day_span(a, b)).alias("day")).withColumn(
        "day", F.col("day").cast("string"))


@query("time_hour_span", """
select user_id, day, count(*) as hours, strftime(max(h), '%Y-%m-%d %H:%M:%S') as last_hour from (
  select user_id, strftime(ts, '%Y-%m-%d') as day, unnest(generate_series(min(date_trunc('hour', ts)), max(ts), interval 1 hour)) as h
  from events group by user_id, strftime(ts, '%Y-%m-%d')) group by user_id, day""")
def _(t):
    d = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min(F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("a"), F.max("ts").alias("b"))
    spans = d.withColumn("h", D.hour_span(F.col("a"), F.col("b")))
    return spans.select("user_id", F.col("day").cast("string").alias("day"), F.size("h").cast("bigint").alias("hours"),
                        text(F.element_at("h", -1)).alias("last_hour"))


@query("time_join_clock", """
select event_id, strftime(ts, '%Y-%m-%d') || case when event_id % 6 = 0 then '' else strftime(ts, 'T%H:%M:00') end as joined
from events""")
def _(t):
    clock = F.when(F.col("event_id") % 6 == 0, "noon").when(F.col("event_id") % 2 == 0, F.lower(
        F.date_format("ts", "h:mm a"))).otherwise(F.date_format("ts", "H:mm"))
    return t.events.select("event_id", D.join_clock(F.date_format("ts", "yyyy-MM-dd"), clock).alias("joined"))


@query("time_date_parts", """
select event_id, strftime(ts, '%Y-%m-%d') as day_text, case when event_id % 7 = 0 then 'none' else strftime(ts, '%m/%d/%Y') end
  as us_text from events""")
def _(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select("event_id", D.date_part_text(iso).alias("day_text"), D.us_date_text(
        F.when(F.col("event_id") % 7 != 0, iso), F.lit("none")).alias("us_text"))


@query("time_month_name", """
select strftime(l_shipdate, '%B') as month, count(*) as n from lineitem group by 1""")
def _(t):
    return t.lineitem.groupBy(D.month_name(F.col("l_shipdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))
