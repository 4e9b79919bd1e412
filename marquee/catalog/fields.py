"""Category, tag, coordinate, link, price and identity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import CITIES_SQL, CITY_EVENTS, CITY_EVENTS_SQL, LISTINGS, LISTINGS_SQL, key_sql
from marquee.catalog.moments import PARSED, listings
from marquee.catalog.registry import query
from marquee.functions import values as V
from marquee.functions.text import add_clean_text
from marquee.functions.times import add_moment
from marquee.keywords import ENGLISH, spanish
from marquee.operators.merge import add_match_key


def _keyword_sql(blocks, text, own):
    cases = " ".join("when " + " or ".join(f"contains({text}, '{k}')" for k in words) + f" then '{cat}'"
                     for cat, words in blocks)
    return (f"case {cases} when coalesce({own}, '') = '' then 'other' when lower(trim({own})) in ('undefined', 'unknown', 'n/a', 'na', 'none', '') then 'Other'"
            f" else lower(trim({own})) end")


@query("category_by_keyword", f"""
select doc_id, {_keyword_sql(ENGLISH, 'low', 'source')} as category
from (select doc_id, source, lower(text) as low from documents)""")
def _(t):
    d = t.documents.select("doc_id", "source", "text").select("doc_id", "source", F.lower("text").alias("low"))
    return d.select("doc_id", V.keyword_category(F.col("low"), F.col("source"), ENGLISH).alias("category"))


@query("category_by_spanish_keyword", f"""
select category, count(*) as n from (select {_keyword_sql(spanish(), 'low', 'kind')} as category
from (select lower(concat_ws(' ', p_name, p_type)) as low, case p_size % 5 when 0 then 'n/a' when 1 then '' when 2 then '  ' when 3 then null
    else p_type end as kind
  from part)) group by 1""")
def _(t):
    d = t.part.select(F.lower(V.category_text(F.col("p_name"), F.col("p_type"))).alias("low"),
                      F.when(F.col("p_size") % 5 == 0, "n/a").when(F.col("p_size") % 5 == 1, "").when(F.col("p_size") % 5 == 2, "  ")
                      .when(F.col("p_size") % 5 == 4, F.col("p_type")).alias("kind"))
    return d.select(V.keyword_category(F.col("low"), F.col("kind"), spanish()).alias("category")).groupBy(
        "category").agg(F.count(F.lit(1)).alias("n"))


TAGS_TEXT = f"""
select _ord, array_to_string(list_transform(list_filter(list_transform(parts, lambda x, i: {{'x': x, 'i': i}}),
    lambda s: list_position(parts, s.x) = s.i), lambda s: s.x), ', ') as tags
from (select _ord, list_filter(list_concat(case when primary_category <> '' then [primary_category] else [] end,
  list_transform(string_split(secondary_categories, ','), lambda x: trim(x))), lambda x: x <> '') as parts from ({LISTINGS_SQL}))"""


@query("tags_as_text", TAGS_TEXT)
def _(t):
    return t.sql(LISTINGS).select("_ord", V.tags_text(F.col("primary_category"), F.col("secondary_categories")).alias(
        "tags"))


TAGS = f"""
select _ord, p, list_transform(list_filter(list_transform(parts, lambda x, i: {{'x': x, 'i': i}}),
    lambda s: list_position(list_transform(parts, lambda y: lower(y)), lower(s.x)) = s.i), lambda s: s.x) as tags
from (select _ord, case when lower(primary_category) = 'undefined' then '' else primary_category end as p,
  list_filter(list_transform(string_split(secondary_categories, ','), lambda x: trim(x)),
    lambda x: x <> '' and lower(x) <> 'undefined') as parts from ({LISTINGS_SQL}))"""


@query("tags_as_array", f"""
select _ord, category, array_to_string(list_filter(tags, lambda x: lower(x) <> lower(category))[:8], '|') as tags
from (select *, case when p <> '' then p else coalesce(tags[1], '') end as category from ({TAGS}))""")
def _(t):
    d = add_clean_text(t.sql(LISTINGS), {"p": F.col("primary_category")}, lists={"l": F.col("secondary_categories")})
    d = d.withColumn("t", V.distinct_tags(F.col("l")))
    category, tags = V.primary_and_tags(F.col("p"), F.col("t"))
    return d.select("_ord", category.alias("category"), F.array_join(tags, "|").alias("tags"))


COORDS = """
case when latitude in ('', '0') then null else cast(latitude as double) end as lat,
case when latitude in ('', '0') then null else cast(longitude as double) end as lon"""


@query("geo_coordinates", f"select _ord, {COORDS} from ({LISTINGS_SQL})")
def _(t):
    return V.add_coordinates(t.sql(LISTINGS)).select("_ord", "lat", "lon")


@query("geo_in_city", f"""
select city_folder, count(*) filter (where inside) as inside, count(*) filter (where not inside) as outside,
  count(*) filter (where inside is null) as unknown
from (select city_folder, lat between lat_lo and lat_hi and lon between lon_lo and lon_hi as inside
  from (select *, {COORDS} from ({LISTINGS_SQL}) l join (select * from {CITIES_SQL}) c using (city_folder)))
group by city_folder""")
def _(t):
    d = V.add_coordinates(listings(t))
    inside = V.in_box(F.col("lat"), F.col("lon"), F.col("lat_lo"), F.col("lat_hi"), F.col("lon_lo"),
                      F.col("lon_hi"))
    return d.select("city_folder", inside.alias("inside")).groupBy("city_folder").agg(
        F.count_if("inside").alias("inside"), F.count_if(~F.col("inside")).alias("outside"),
        F.count_if(F.col("inside").isNull()).alias("unknown"))


@query("link_secure", f"""
select _ord, case when starts_with(external_link, 'http://') then 'https://' || substr(external_link, 8)
  when starts_with(external_link, 'https://') then external_link else '' end as url from ({LISTINGS_SQL})""")
def _(t):
    return t.sql(LISTINGS).select("_ord", V.secure_link(F.col("external_link")).alias("url"))


@query("images_split_at_commas", f"""
select _ord, array_to_string(list_filter(list_transform(string_split(thumbnail_image || ',' || additional_images, ','),
  lambda x: trim(x)), lambda x: starts_with(x, 'http'))[:4], '|') as images from ({LISTINGS_SQL})""")
def _(t):
    return t.sql(LISTINGS).select("_ord", F.array_join(
        V.image_list(F.col("thumbnail_image"), F.col("additional_images")), "|").alias("images"))


@query("images_whole_links", f"""
select _ord, case when _ord % 2 = 0 then thumbnail_image else thumbnail_image || '|https://img/a/105,4/'
  || cast(_ord % 5 as string) || '.jpg,ftp://x|https://img/b' end as images from ({LISTINGS_SQL})""")
def _(t):
    return t.sql(LISTINGS).select("_ord", F.array_join(
        V.image_list(F.col("thumbnail_image"), F.col("additional_images"), whole_urls=True), "|").alias("images"))


@query("geo_distance", """
select event_id, round(2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(lat2 - 40.7) / 2), 2)
  + cos(radians(40.7)) * cos(radians(lat2)) * pow(sin(radians(lon2 + 74.0) / 2), 2)))), 3) as metres
from (select event_id, 30.0 + (event_id % 400) / 10.0 as lat2, -120.0 + (event_id % 977) / 4.0 as lon2 from events)""")
def _(t):
    d = t.events.select("event_id", (30.0 + (F.col("event_id") % 400) / 10.0).alias("lat2"),
                        (-120.0 + (F.col("event_id") % 977) / 4.0).alias("lon2"))
    return d.select("event_id", F.round(V.haversine_m(F.lit(40.7), F.lit(-74.0), F.col("lat2"), F.col("lon2")), 3)
                    .alias("metres"))


@query("geo_split_coordinates", """
select event_id, case when event_id % 5 < 3 then '4' || (event_id % 10) || '.5' else '' end as latitude,
  case when event_id % 5 < 3 then '-7' || (event_id % 10) else '' end as longitude from events""")
def _(t):
    k = F.col("event_id") % 5
    digit = (F.col("event_id") % 10).cast("string")
    raw = F.concat(F.lit(" 4"), digit, F.when(k == 3, F.lit(".5 ; ")).otherwise(F.lit(".5 , ")),
                   F.when(k == 4, F.lit("west")).otherwise(F.concat(F.lit("-7"), digit)), F.lit(" "))
    return t.events.select("event_id", V.split_coordinates(raw).alias("p")).select("event_id", "p.*")


@query("price_tri_state", f"""
select case lower(trim(is_paid)) when 'true' then 'paid' when 'false' then 'free' else 'unknown' end as price, count(*) as n
from ({LISTINGS_SQL}) group by 1""")
def _(t):
    flag = V.price_flag(F.col("is_paid"))
    name = F.when(flag.isNull(), "unknown").when(flag, "paid").otherwise("free")
    return t.sql(LISTINGS).groupBy(name.alias("price")).agg(F.count(F.lit(1)).alias("n"))


@query("price_two_state", f"""
select lower(trim(is_paid)) in ('true', '1', 'yes') as paid, count(*) as n from ({LISTINGS_SQL}) group by 1""")
def _(t):
    return t.sql(LISTINGS).groupBy(V.price_flag_two_state(F.col("is_paid")).alias("paid")).agg(
        F.count(F.lit(1)).alias("n"))


@query("price_display_label", f"""
select coalesce(is_paid, 'unknown') as paid, count(*) as n from ({CITY_EVENTS_SQL}) group by 1""")
def _(t):
    return t.sql(CITY_EVENTS).groupBy(V.paid_label(F.col("is_paid")).alias("paid")).agg(F.count(F.lit(1)).alias("n"))


NAME = "case when source = 'songkick' and contains(name, ' @ ') then split_part(name, ' @ ', 1) else name end"


@query("event_identity", f"""
select _ord, substr(sha1(canonical_city || '|' || strftime(start_local, '%Y-%m-%d') || '|' || {key_sql(NAME)} || '|'
  || {key_sql('location_name')}), 1, 12) as id from ({PARSED}) where start_local is not null""")
def _(t):
    d = add_match_key(add_moment(listings(t), "start_time", "start", F.col("tz")).filter(
        F.col("start_local").isNotNull()))
    return d.select("_ord", V.event_id(F.col("canonical_city"), F.col("event_day"), F.col("name_key"),
                                       F.col("venue_key")).alias("id"))


@query("source_labels", f"""
select case source when 'ticketmaster' then 'Ticketmaster' when 'eventbrite' then 'Eventbrite' when 'ra' then 'Resident Advisor'
  when 'songkick' then 'Songkick' when 'nyc_events' then 'NYC Events Calendar' when 'nyc_parks' then 'NYC Parks'
  else source end as label, count(*) as n from ({LISTINGS_SQL}) group by 1""")
def _(t):
    return t.sql(LISTINGS).groupBy(V.source_label(F.col("source")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


FILLED = " + ".join(f"cast(trim({c}) <> '' as int)" for c in [
    "name", "description", "location_name", "latitude", "longitude", "address", "start_time", "end_time", "city",
    "primary_category", "secondary_categories", "thumbnail_image", "additional_images", "external_link", "is_paid"])


@query("fill_score", f"""
select _ord, {FILLED} + case when latitude in ('', '0') then 0 else 2 end as score from ({LISTINGS_SQL})""")
def _(t):
    return V.add_coordinates(t.sql(LISTINGS)).select("_ord", V.fill_score(F.col("lat")).alias("score"))


@query("share_percent", """
select l_returnflag, count(*) as n, round_even(100.0 * count(*) / (select count(*) from lineitem), 1) as percentage
from lineitem group by 1""")
def _(t):
    counts = t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    total = t.lineitem.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("percentage", V.share_percent(F.col("n"), total))


