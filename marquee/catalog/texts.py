"""Text queries over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.inputs import SCRIPT, WIDE, clean_sql, key_sql, strip_sql, unescape_sql
from marquee.catalog.registry import query
from marquee.functions import text as X

MARK = "́"


def digest(c):
    return F.md5(c.cast("binary"))


@query("text_repair_mojibake", "select doc_id, md5(text) as repaired, length(text) as n from documents")
def _(t):
    # Break every text the way the repair undoes it, then repair it.
    broken = t.documents.withColumn("text", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))
    fixed = broken.select("doc_id", X.repair_mojibake(F.col("text")).alias("fixed"))
    return fixed.select("doc_id", digest(F.col("fixed")).alias("repaired"), F.length("fixed").cast("bigint").alias("n"))


@query("text_leave_sound_text", "select doc_id, md5(text) as repaired from documents")
def _(t):
    return t.documents.select("doc_id", digest(X.repair_mojibake(F.col("text"))).alias("repaired"))


@query("text_normalize_nfc",
       f"select doc_id, md5(nfc_normalize(replace(text, 'é', 'e{MARK}'))) as nfc from documents")
def _(t):
    apart = F.replace("text", F.lit("é"), F.lit("e" + MARK))
    return t.documents.select("doc_id", digest(X.normalize_nfc(apart)).alias("nfc"))


@query("text_strip_tags", "select page_id, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) as plain from pages")
def _(t):
    return t.pages.select("page_id", digest(X.strip_tags(F.col("html"))).alias("plain"))


@query("text_unescape_html", f"select page_id, md5({unescape_sql(unescape_sql('html'))}) as plain from pages")
def _(t):
    return t.pages.select("page_id", digest(X.unescape_html(F.col("html"))).alias("plain"))


@query("text_drop_controls", r"""
select doc_id, md5(regexp_replace(replace(text, ' the ', chr(7) || 'the' || chr(127)), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'))
  as plain from documents""")
def _(t):
    dirty = F.replace("text", F.lit(" the "), F.lit("\x07the\x7f"))
    return t.documents.select("doc_id", digest(X.drop_controls(dirty)).alias("plain"))


@query("text_squeeze_blanks", rf"""
select doc_id, md5({strip_sql("regexp_replace(replace(text, ',', chr(9) || ' , '), '[ " + chr(92) + "t]+', ' ', 'g')")})
  as plain from documents""")
def _(t):
    wide = F.replace("text", F.lit(","), F.lit("\t , "))
    return t.documents.select("doc_id", digest(X.squeeze_blanks(wide)).alias("plain"))


@query("text_trim_words", """
select doc_id, case when length(text) > 300 then regexp_replace(substr(text, 1, 300), ' [^ ]*$', '') || '…'
  else text end as summary from documents""")
def _(t):
    return t.documents.select("doc_id", X.trim_words(F.col("text")).alias("summary"))


@query("text_clean", f"""
select page_id, md5({clean_sql('html')}) as plain, {clean_sql('html', 300)} as summary from pages""")
def _(t):
    d = X.add_clean_text(t.pages.select("page_id", "html"), {"plain": F.col("html")})
    return d.select("page_id", X.trim_words(F.col("plain"), 300).alias("summary"), digest(F.col("plain")).alias("plain"))


@query("text_strip_html_light", rf"""
select page_id, md5({strip_sql(
    "regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace("
    "regexp_replace(html, '<[^>]+>', ' ', 'g'),"
    " '&nbsp;', ' '), '&amp;', '&'), '&ndash;', '-'), '&mdash;', '-'), '&rsquo;', ''''), '&lsquo;', ''''),"
    " '&ldquo;', chr(34)), '&rdquo;', chr(34)), '&#39;', ''''), '&quot;', chr(34)), '" + WIDE + "+', ' ', 'g')")}) as plain
from pages""")
def _(t):
    return t.pages.select("page_id", digest(X.strip_html_light(F.col("html"))).alias("plain"))


@query("text_match_key", f"select doc_id, md5({key_sql('text')}) as match_key from documents")
def _(t):
    return t.documents.select("doc_id", digest(X.match_key(F.col("text"))).alias("match_key"))


@query("text_match_key_collisions", f"""
select source, count(*) as texts, count(distinct {key_sql('text')}) as keys,
  count(*) filter (where {key_sql('text')} = '') as empty_keys from documents group by source""")
def _(t):
    keyed = t.documents.withColumn("k", X.match_key(F.col("text")))
    return keyed.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count_distinct("k").alias("keys"),
                                       F.count_if(F.col("k") == "").alias("empty_keys"))


@query("text_display_clean", rf"""
select doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(replace(text, '&', 'and'), '[@#%]', '', 'g'),
  '[^A-Za-z0-9_\-.,!?:;()/' || '{SCRIPT[1:-1]}' || ']', '', 'g'), '{SCRIPT}+', ' ', 'g'))) as shown from documents""")
def _(t):
    return t.documents.select("doc_id", digest(X.display_clean(F.col("text"))).alias("shown"))


@query("text_embedding_text", """
select doc_id, md5(coalesce(case when doc_id % 3 = 0 then null else source end, '') || '. ' || coalesce(text, ''))
  as both_parts, md5(coalesce(text, '')) as text_only from documents""")
def _(t):
    name = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return t.documents.select("doc_id", digest(X.embedding_text(name, F.col("text"))).alias("both_parts"),
                              digest(X.embedding_text(None, F.col("text"))).alias("text_only"))


@query("text_location_line", """
select l_orderkey, l_linenumber,
  case when a <> '' and not contains(v, a) then concat_ws(', ', nullif(v, ''), a, nullif(c, ''))
    when c <> '' and not contains(v, c) then concat_ws(', ', nullif(v, ''), c) else v end as line
from (select l_orderkey, l_linenumber,
  case when l_linenumber % 4 = 0 then '' when l_linenumber % 4 = 1 then 'Hall of ' || l_returnflag else 'Hall' end as v,
  case when l_partkey % 3 = 0 then '' else l_returnflag end as a,
  case when l_suppkey % 3 = 0 then '' else l_linestatus || ' town' end as c from lineitem)""")
def _(t):
    d = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") % 4 == 0, "").when(F.col("l_linenumber") % 4 == 1, F.concat(
            F.lit("Hall of "), "l_returnflag")).otherwise("Hall").alias("v"),
        F.when(F.col("l_partkey") % 3 == 0, "").otherwise(F.col("l_returnflag")).alias("a"),
        F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(F.concat("l_linestatus", F.lit(" town"))).alias("c"))
    return d.select("l_orderkey", "l_linenumber",
                    X.location_line(F.col("v"), F.col("a"), F.col("c")).alias("line"))


@query("text_address_join", """
select c_custkey, concat_ws(', ', nullif(case when c_custkey % 3 = 0 then '' else c_name end, ''),
  case when c_custkey % 4 = 0 then null else c_mktsegment end, 'N' || c_nationkey) as address from customer""")
def _(t):
    return t.customer.select("c_custkey", X.join_filled(
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("address"))


@query("text_city_folder", """
select p_partkey, array_to_string(list_transform(string_split(
    regexp_replace(regexp_replace(p_name || ' - ' || p_brand, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '_'),
    lambda w: case when w = lower(w) and regexp_matches(w, '[a-z]') then upper(w[1]) || w[2:] else w end), '_')
  || '_' || upper(p_type) as folder from part""")
def _(t):
    return t.part.select("p_partkey", X.city_folder(F.concat("p_name", F.lit(" - "), "p_brand"),
                                                    F.lower("p_type")).alias("folder"))


@query("text_title_case", r"""
select doc_id, md5(array_to_string(list_transform(chars, lambda c, i:
  case when i > 1 and regexp_matches(chars[i - 1], '\p{L}') then lower(c)
       when c = 'ß' then 'Ss' else upper(c) end), '')) as titled
from (select doc_id, string_split(text, '') as chars from documents)""")
def _(t):
    return t.documents.select("doc_id", digest(X.title_case(F.col("text"))).alias("titled"))


@query("text_clean_url", r"""
select page_id, shape, case when u = '' then null when regexp_matches(u, '(?i)^https?://') then u else 'https://' || u end as link
from (select page_id, page_id % 4 as shape, trim(case page_id % 4 when 0 then '  ' || url || ' '
  when 1 then regexp_replace(url, '^https?://', '') when 2 then url else '' end) as u from pages)""")
def _(t):
    d = t.pages.select("page_id", (F.col("page_id") % 4).alias("shape"), F.expr(
        """case page_id % 4 when 0 then '  ' || url || ' ' when 1 then regexp_replace(url, '^https?://', '')
           when 2 then url else '' end""").alias("u"))
    return d.select("page_id", "shape", X.clean_url(F.col("u")).alias("link"))
