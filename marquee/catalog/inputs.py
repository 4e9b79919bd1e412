"""Listing-shaped inputs derived from the shared tables.

The texts are plain projections in SQL that both engines read the same way, so the
check SQL starts from identical rows.  Every derived row comes from one table row.
"""

from __future__ import annotations

from marquee.catalog.registry import plain

# Listings from event rows: seven sources, three cities, several time shapes, missing
# values, decorated venues and wandering coordinates, all by row arithmetic.
LISTINGS = """
select event_id as _ord,
  case event_id % 7 when 0 then 'ticketmaster' when 1 then 'eventbrite' when 2 then 'ra' when 3 then 'songkick'
    when 4 then 'nyc_events' when 5 then 'nyc_parks' else 'local_feed' end as source,
  case user_id % 3 when 0 then 'New_York_US' when 1 then 'Mexico_City_MX' else 'Los_Angeles_US' end as city_folder,
  case when event_id % 97 = 0 then '  '
    when event_id % 7 = 3 then 'Show ' || event_type || ' ' || cast(user_id % 5 as string) || ' @ Hall'
    when event_id % 2 = 0 then 'SHOW ' || event_type || ' ' || cast(user_id % 5 as string)
    else 'Show ' || event_type || ' ' || cast(user_id % 5 as string) end as name,
  case when event_id % 3 = 0 then ''
    else 'About <b>' || event_type || '</b> &amp; more  no ' || cast(event_id as string) end as description,
  case when event_id % 4 = 0 then 'Hall ' || cast(user_id % 2 as string)
    when event_id % 4 = 1 then 'Hall ' || cast(user_id % 2 as string) || ' (in Park ' || cast(user_id % 4 as string) || ')'
    when event_id % 4 = 2 then 'hall-' || cast(user_id % 2 as string) else 'El Café ' || cast(user_id % 2 as string) end
    as location_name,
  case when event_id % 5 = 0 then '' when event_id % 11 = 0 then '0'
    else cast(40.0 + (user_id % 4) * 0.003 as string) end as latitude,
  case when event_id % 5 = 0 then '' when event_id % 11 = 0 then '0'
    else cast(-74.0 - (user_id % 4) * 0.004 as string) end as longitude,
  case when event_id % 6 = 0 then '' else cast(user_id as string) || ' Main St' end as address,
  case when event_id % 89 = 0 then 'tba' when event_id % 101 = 0 then ''
    when event_id % 5 = 0 then substr(cast(ts as string), 1, 10)
    when event_id % 5 = 1 then substr(cast(ts as string), 1, 10) || ' 6pm'
    when event_id % 5 = 2 then substr(cast(ts as string), 1, 10) || 'T0' || cast(user_id % 4 as string) || ':30:00Z'
    when event_id % 5 = 3 then substr(cast(ts as string), 1, 10) || 'T1' || cast(user_id % 4 as string) || ':30:00'
    else substr(cast(ts as string), 1, 10) || ' 1' || cast(user_id % 4 as string) || ':30' end as start_time,
  case when event_id % 3 = 0 then '' when event_id % 3 = 1 then substr(cast(ts as string), 1, 10)
    else substr(cast(ts as string), 1, 10) || 'T23:15:00-05:00' end as end_time,
  case when event_id % 8 = 0 then '' when event_id % 8 < 4 then 'staten island' else 'o''neil ST-marie' end as city,
  case when event_id % 10 = 0 then 'Undefined' when event_id % 10 = 1 then '' else event_type end as primary_category,
  case when event_id % 9 = 0 then '' else 'Rock, rock,Undefined, ' || event_type || ',T' || cast(event_id % 13 as string)
    || ',t' || cast(event_id % 13 as string) end as secondary_categories,
  'https://img/' || cast(event_id % 17 as string) || '.jpg' as thumbnail_image,
  case when event_id % 2 = 0 then '' else 'https://img/a/105,4/' || cast(event_id % 5 as string) || '.jpg,ftp://x, https://img/b'
    end as additional_images,
  case event_id % 4 when 0 then 'http://site/' || cast(event_id as string) when 1 then 'https://site/e'
    when 2 then 'mailto:x' else '' end as external_link,
  case event_id % 5 when 0 then 'true' when 1 then 'False ' when 2 then '1' when 3 then 'yes' else '' end as is_paid
from {events}
"""

# Dashboard events from orders: a category, a city, comma tags, a flag and coordinates.
CITY_EVENTS = """
select o_orderkey as id, cast(o_orderkey as string) as name,
  case when o_custkey % 50 = 0 then null else 'City ' || cast(o_custkey % 37 as string) end as city,
  o_orderdate as date, cast(substr(cast(o_orderdate as string), 1, 4) as int) as event_year,
  case o_orderkey % 9 when 0 then null when 1 then 'Other' when 2 then 'Other' else o_orderpriority end as primary_category,
  case when o_orderkey % 8 = 0 then null
    else o_orderpriority || ', ' || o_orderstatus || ',k' || cast(o_custkey % 30 as string) end as tags,
  case o_orderkey % 3 when 0 then 'true' when 1 then 'false' else null end as is_paid,
  case when o_orderkey % 6 = 0 then null else 40.0 + (o_custkey % 100) / 1000.0 end as latitude,
  case when o_orderkey % 10 = 0 then null else -74.0 - (o_custkey % 100) / 1000.0 end as longitude
from {orders}
"""

# Host events: user = host, ts = date.  Sparse hosts reach every cadence label.
HOST_EVENTS = """
select event_id as id, ts as date,
  case when user_id % 53 = 7 then null else 'host ' || cast(user_id % 211 as string) || '-'
    || cast(case when event_id % 5 = 0 then event_id % 4001 else 0 end as string) end as host_name,
  event_type as primary_category, event_type as event_type,
  case when event_id % 11 = 0 then null else 'type ' || cast(event_id % 3 as string) end as inferred_host_type,
  case when user_id % 7 = 0 then null else 'segment ' || cast((event_id + user_id) % 4 as string) end
    as inferred_gtm_segment,
  'City ' || cast(user_id % 19 as string) as city, 'S' || cast(user_id % 6 as string) as state,
  'mail' || cast(event_id as string) || '@x' as contact_email
from {events}
"""

# Points: a seeded scatter around one place per state, with repeated places.
POINTS = """
select event_id as id, 'S' || cast(user_id % 3 as string) as state,
  40.5 + cast((event_id * 7919) % 1009 as double) / 2500.0 as lat,
  -74.0 + cast((event_id * 104729) % 997 as double) / 2500.0 as lon
from {events}
"""

LISTINGS_SQL = plain(LISTINGS)
CITY_EVENTS_SQL = plain(CITY_EVENTS)
HOST_EVENTS_SQL = plain(HOST_EVENTS)
POINTS_SQL = plain(POINTS)

# Fixed dates of the checks: reference day inside the event month, today inside the orders.
REFERENCE = "2024-01-20T00:00:00"
TODAY = "2001-03-15"

CITIES_SQL = """(values
  ('New_York_US','New York','America/New_York',40.2,41.4,-75.0,-73.0),
  ('Mexico_City_MX','Mexico City','America/Mexico_City',18.8,20.0,-99.8,-98.5),
  ('Los_Angeles_US','Los Angeles','America/Los_Angeles',33.0,35.0,-119.5,-116.8))
  as cities(city_folder,canonical_city,tz,lat_lo,lat_hi,lon_lo,lon_hi)"""

# Unicode white space for the check SQL.
WIDE = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SCRIPT = r"[\t-\r\x20\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{WIDE}+|{WIDE}+$', '', 'g')"


def unescape_sql(c: str) -> str:
    """Character references that occur in the tables."""
    out = c
    for ref, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"), ("&amp", "&")):
        out = f"replace({out}, '{ref}', '{char}')"
    return out


def clean_sql(c: str, limit: int | None = None) -> str:
    """Reading of the text clean for texts without mojibake."""
    out = unescape_sql(unescape_sql(f"regexp_replace(nfc_normalize({c}), '<[^>]+>', ' ', 'g')"))
    out = rf"regexp_replace({out}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')"
    out = strip_sql(rf"regexp_replace({out}, '[ \t]+', ' ', 'g')")
    if limit:
        return (f"(case when length({out}) > {limit} then regexp_replace(substr({out}, 1, {limit}), ' [^ ]*$', '')"
                f" || '…' else {out} end)")
    return out


def key_sql(c: str) -> str:
    return f"regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', '', 'g')"
