"""Hand-made edge rows with expected values written down by hand."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from marquee.functions import text as X
from marquee.functions import times as D
from marquee.functions import values as V
from marquee.keywords import ENGLISH, decisive, spanish


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r[0] for r in build(df).orderBy("i").select("o").collect()]


def apply(spark, values, f):
    return column(spark, values, lambda d: d.withColumn("o", f(F.col("s"))))


def test_mojibake(spark):
    got = apply(spark, ["MÃ©xico", "5â‚¬ Ã", "plain", "Ã", None], X.repair_mojibake)
    assert got == ["México", "5â‚¬ Ã", "plain", "Ã", None]


def test_clean_text(spark):
    long = "word " * 80
    values = ["  a &amp;#174; <i>b</i>\t c ", "&lt;b&gt;x", "é", "bad\x07bell", None, long, "x" * 400]
    got = column(spark, values, lambda d: X.add_clean_text(d, {"o": F.col("s")}, {"o": 300}))
    assert got[:5] == ["a ® b c", "<b>x", "é", "badbell", ""]
    assert got[5] == long[:300].rsplit(" ", 1)[0] + "…" and got[6] == "x" * 300 + "…"


def test_clean_list_keeps_parts_apart(spark):
    values = ["Rock &#44; Roll,MÃ©xico,<b>x</b>,<i x, y>,é", ""]
    got = column(spark, values, lambda d: X.add_clean_text(d, {}, lists={"o": F.col("s")}))
    assert got == [["Rock , Roll", "México", "x", "<i x", "y>", "é"], [""]]


def test_match_key_equals_unicode_rule(spark):
    values = ["El Café №5", "ﬁne ½ Straße", "Ångström ⅷ ㎏", "東京 Tower", "ＡＢＣ１", "ŉ Ĳssel ĸ", None, "İstanbul"]

    def rule(v):
        return re.sub("[^a-z0-9]+", "", unicodedata.normalize("NFKD", (v or "").lower()))

    assert apply(spark, values, X.match_key) == [rule(v) for v in values]


def test_character_classes_are_complete():
    compose = re.compile(X.MAY_COMPOSE.replace(r"\x{10000}-\x{10FFFF}", "\U00010000-\U0010ffff"))
    spell = re.compile(X.MAY_SPELL_OUT.replace(r"\x{10000}-\x{10FFFF}", "\U00010000-\U0010ffff"))
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        if unicodedata.combining(c) or not unicodedata.is_normalized("NFC", c) or 0x1100 <= code < 0x1200:
            assert compose.match(c), hex(code)
        if len(re.sub("[^a-z0-9]", "", unicodedata.normalize("NFKD", c.lower()))) > 1:
            assert spell.match(c.lower()) or len(c.lower()) > 1, hex(code)


def test_title_case(spark):
    assert apply(spark, ["o'neil ST-marie", "1st ave", "ßx", ""], X.title_case) == ["O'Neil St-Marie", "1St Ave", "Ssx", ""]


def test_urls_and_folders(spark):
    assert apply(spark, [" example.com/x ", "HTTP://a.b", "https://bad host/", ""], X.clean_url) == [
        "https://example.com/x", "HTTP://a.b", None, None]
    assert apply(spark, ["New York", "são paulo", "  ", "mexico city"], lambda c: X.city_folder(c, F.lit("us"))) == [
        "New_York_US", "S_O_Paulo_US", "Location_US", "Mexico_City_US"]


NY = "America/New_York"


def moments(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    d = D.add_moment(df, "s", "m", F.lit(NY))
    return [tuple(r) for r in d.orderBy("i").select(
        F.col("m_local").cast("string"), "m_has_time", D.iso_with_offset(F.col("m_local"), F.col("m_utc")),
        D.display_time(F.col("m_local"), F.col("m_has_time"))).collect()]


def test_moments(spark):
    got = moments(spark, ["2026-07-22T02:00:00Z", "2026-08-01", "2026-07-21 6pm", "2026-13-40", "2026-07-21T25:00:00", "x"])
    assert got[0] == ("2026-07-21 22:00:00", True, "2026-07-21T22:00:00-04:00", "10:00 PM")
    assert got[1][:2] == ("2026-08-01 00:00:00", False) and got[1][3] == "All day"
    assert got[2][:2] == ("2026-07-21 00:00:00", False)
    assert got[3][0] is None and got[5][0] is None
    assert got[4][:2] == ("2026-07-21 00:00:00", False)


def test_repeated_and_skipped_hour(spark):
    got = moments(spark, ["2026-11-01T01:30:00", "2026-03-08 02:30", "2026-03-08T12", "2026-01-02T03:04:05.5+05:30"])
    assert [g[2] for g in got] == ["2026-11-01T01:30:00-04:00", "2026-03-08T02:30:00-05:00", "2026-03-08T12:00:00-04:00",
                                   "2026-01-01T16:34:05.500000-05:00"]
    late = column(spark, ["2026-11-01T01:30:00", "2026-06-01T01:30:00", "2026-06-01T01:30:00Z", "?"],
                  lambda d: D.add_lenient(d, "s", "p").withColumn("o", D.utc_text(F.col("p"), F.lit(NY))))
    assert late == ["2026-11-01T06:30:00Z", "2026-06-01T05:30:00Z", "2026-06-01T01:30:00Z", ""]


def test_clock_join_and_city_text(spark):
    got = apply(spark, ["12:05 am", "7:00 PM", "noon", "13:15"], lambda c: D.join_clock(F.lit("2026-07-01"), c))
    assert got == ["2026-07-01T00:05:00", "2026-07-01T19:00:00", "2026-07-01", "2026-07-01T13:15:00"]
    shown = column(spark, ["2026-07-22T02:00:00Z", "July 4, 2026 7:00 PM", ""],
                   lambda d: D.add_lenient(d, "s", "p").withColumn("o", D.city_time_text(F.col("p"), F.lit(NY))))
    assert shown == ["7/21/2026  10:00:00 PM", "7/4/2026  07:00:00 PM", ""]


def test_tags(spark):
    def tags(d):
        d = X.add_clean_text(d, {"p": F.split("s", "[|]")[0]}, lists={"l": F.split("s", "[|]")[1]})
        d = d.withColumn("t", V.distinct_tags(F.col("l")))
        primary, rest = V.primary_and_tags(F.col("p"), F.col("t"))
        return d.withColumn("o", F.concat(F.array(primary), rest))

    many = ",".join(f"t{i}" for i in range(10))
    got = column(spark, ["Undefined|Rock, rock, Undefined, Pop", f"Art|{many}", "|", "pop|Pop,x"], tags)
    assert got == [["Rock", "Pop"], ["Art", *[f"t{i}" for i in range(8)]], [""], ["pop", "x"]]


def test_coordinates(spark):
    df = spark.createDataFrame([(0, "0", "0"), (1, "40.7", "abc"), (2, " 40.7 ", "-74"), (3, "nan", "1"), (4, None, "1")],
                               "i int, latitude string, longitude string")
    got = [tuple(r) for r in V.add_coordinates(df).orderBy("i").select("lat", "lon").collect()]
    assert got == [(None, None), (None, None), (40.7, -74.0), (None, None), (None, None)]


def test_prices_and_images(spark):
    values = ["true", "false", "", "1", " TRUE "]
    assert apply(spark, values, V.price_flag) == [True, False, None, None, True]
    assert apply(spark, values, V.price_flag_two_state) == [True, False, False, True, True]
    url = "https://x/crop/791x791/105,4/a.jpg"
    cut = apply(spark, [url], lambda c: V.image_list(F.lit("https://t"), c))
    whole = apply(spark, [url], lambda c: V.image_list(F.lit("https://t"), c, whole_urls=True))
    assert cut == [["https://t", "https://x/crop/791x791/105"]] and whole == [["https://t", url]]


def test_keywords(spark):
    got = column(spark, ["barcelona tour", "nothing", "a fair"], lambda d: d.withColumn(
        "o", V.keyword_category(F.col("s"), F.lit("Undefined"), ENGLISH)))
    assert got == ["Food & Drink", "Other", "Tech & Business"]
    assert decisive(["food", "foodie", "tour", "food tour"]) == ["food", "tour"]
    blocks = spanish()
    assert [b for b, _ in blocks].count("Food & Drink") == 2
    assert "gourmet" not in blocks[0][1] and "mezcal" in blocks[0][1]


@pytest.mark.parametrize("value,label", [(12.5, "12.5%"), (50.0, "50%"), (0.0, "0%")])
def test_percent_label(spark, value, label):
    assert spark.range(1).select(V.percent_label(F.lit(value))).first()[0] == label
