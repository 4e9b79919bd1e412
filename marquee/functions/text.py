"""Text expressions.  Everything but Unicode normalisation stays in the JVM."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns and entities that decide the cleaned text.
MOJIBAKE_MARKS = "[ÃÂâ€]"
TAG_PATTERN = "<[^>]+>"
CONTROL_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
LIGHT_ENTITIES = {
    "&nbsp;": " ",
    "&amp;": "&",
    "&ndash;": "-",
    "&mdash;": "-",
    "&rsquo;": "'",
    "&lsquo;": "'",
    "&ldquo;": '"',
    "&rdquo;": '"',
    "&#39;": "'",
    "&quot;": '"',
}
DISPLAY_DROP = "[@#%]"
DISPLAY_KEEP = r"A-Za-z0-9_\-.,!?:;()/"
DESCRIPTION_LIMIT = 300

# Unicode white space as regex classes: the wide one also holds the separators
# U+001C..U+001F, the script one holds the byte-order mark instead.
WIDE_SPACE = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SCRIPT_SPACE = r"\t-\r\x20\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"

_NON_ASCII = r"[^\x00-\x7F]"


# Every character whose presence can make NFC change a text, as a few wide ranges: a
# class of a thousand single characters would cost a thousand tests per character.
MAY_COMPOSE = (r"[\u0300-\u1FFF\u2000\u2001\u20D0-\u20FF\u2126\u212A\u212B\u2329\u232A\u2ADC\u2CEF-\u2CF1"
               r"\u2D7F-\u2DFF\u3000-\uFFFF\x{10000}-\x{10FFFF}]")
# Every character that folds to several key characters, likewise.
MAY_SPELL_OUT = r"[¼-¾Ĳĳ\u0180-\uFFFF\x{10000}-\x{10FFFF}]"


def blank(c: Column) -> Column:
    """Null and missing are the same thing as the empty string."""
    return F.coalesce(c, F.lit(""))


# The same white space as plain characters, for the native trim.
_WIDE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_wide(c: Column) -> Column:
    """Strip Unicode white space at both ends."""
    return F.btrim(c, F.lit(_WIDE_CHARS))


def is_filled(c: Column) -> Column:
    """Holds anything but white space."""
    return F.coalesce(c.rlike(f"[^{WIDE_SPACE}]"), F.lit(False))


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1; text that does not round-trip stays."""
    # encode() raises on characters outside Latin-1, so such text never reaches it.
    latin = F.encode(F.when(c.rlike(r"^[\x00-\xFF]*$") & c.rlike(MOJIBAKE_MARKS), c), "ISO-8859-1")
    return F.when(F.is_valid_utf8(latin), F.decode(latin, "UTF-8")).otherwise(c)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAG_PATTERN, " ")


def drop_controls(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_PATTERN, "")


def squeeze_blanks(c: Column) -> Column:
    """Collapse runs of spaces and tabs (not newlines), then strip."""
    return strip_wide(F.regexp_replace(c, "[ \\t]+", " "))


def trim_words(c: Column, limit: int = DESCRIPTION_LIMIT) -> Column:
    """Cut to ``limit`` characters at the last space and add an ellipsis."""
    head = F.substring(c, 1, limit)
    return F.when(F.length(c) > limit,
                  F.concat(F.regexp_replace(head, " [^ ]*$", ""), F.lit("…"))).otherwise(c)


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescape_twice(s: pd.Series) -> pd.Series:
    return s.map(lambda v: html.unescape(html.unescape(v)), na_action="ignore")


_TAG_RE = re.compile(TAG_PATTERN)


@F.pandas_udf(T.StringType())
def _nfc_strip_unescape(s: pd.Series) -> pd.Series:
    def one(v: str) -> str:
        return html.unescape(html.unescape(_TAG_RE.sub(" ", unicodedata.normalize("NFC", v))))

    return s.map(one, na_action="ignore")


def _only_where(c: Column, need: Column, udf) -> Column:
    """Send to Python only the rows the helper can change; others travel as null."""
    return F.coalesce(udf(F.when(need, c)), c)


def normalize_nfc(c: Column) -> Column:
    return _only_where(c, c.rlike(MAY_COMPOSE), _nfc)


def unescape_html(c: Column) -> Column:
    return _only_where(c, c.contains("&"), _unescape_twice)


# Joins the parts of a list while it passes the cleaning as one text.
PART = "\x1f"
_PART_TAG_RE = re.compile("<[^>\x1f]+>")


@F.pandas_udf(T.StringType())
def _nfc_strip_unescape_parts(s: pd.Series) -> pd.Series:
    def one(v: str) -> str:
        return html.unescape(html.unescape(_PART_TAG_RE.sub(" ", unicodedata.normalize("NFC", v))))

    return s.map(one, na_action="ignore")


def _finish(c: Column) -> Column:
    return squeeze_blanks(drop_controls(c))


def add_clean_text(df: DataFrame, wanted: dict[str, Column], limits: dict[str, int] | None = None,
                   lists: dict[str, Column] | None = None) -> DataFrame:
    """Add or replace columns by cleaned text: mojibake, NFC, tags, entities (twice),
    controls, blanks, and the cut where ``limits`` names one.  ``lists`` are comma
    separated texts whose parts are cleaned one by one into an array.

    The steps are separate projections, so every step runs once per value; only text
    with references or composable characters visits Python, all columns in one go.
    """
    parts = {n: F.replace(F.replace(blank(c), F.lit(PART), F.lit("")), F.lit(","), F.lit(PART))
             for n, c in (lists or {}).items()}
    names = [*wanted, *parts]
    f, s = {n: F.col(f"__{n}_f") for n in names}, {n: F.col(f"__{n}_s") for n in names}
    special = {n: f[n].contains("&") | f[n].rlike(MAY_COMPOSE) for n in names}
    helper = {n: _nfc_strip_unescape_parts if n in parts else _nfc_strip_unescape for n in names}
    out = df.withColumns({f"__{n}_r": blank(c) for n, c in wanted.items()} | {f"__{n}_r": c for n, c in parts.items()})
    # A list is repaired part by part: one part that does not round-trip leaves the others alone.
    out = out.withColumns({f"__{n}_f": repair_mojibake(F.col(f"__{n}_r")) for n in wanted}
                          | {f"__{n}_f": _repair_parts(F.col(f"__{n}_r")) for n in parts})
    out = out.withColumns({f"__{n}_s": helper[n](F.when(special[n], f[n])) for n in names})
    out = out.withColumns(
        {n: _finish(F.coalesce(s[n], strip_tags(f[n]))) for n in wanted}
        | {n: F.transform(F.split(F.coalesce(s[n], F.regexp_replace(f[n], _PART_TAG_RE.pattern, " ")), PART), _finish)
           for n in parts})
    out = out.drop(*[f"__{n}_{x}" for n in names for x in "rfs"])
    return out.withColumns({n: trim_words(F.col(n), k) for n, k in limits.items()}) if limits else out


def _repair_parts(c: Column) -> Column:
    repaired = F.array_join(F.transform(F.split(c, PART), repair_mojibake), PART)
    return F.when(c.rlike(MOJIBAKE_MARKS), repaired).otherwise(c)


def strip_html_light(c: Column) -> Column:
    """Tags, ten fixed entities, all white space collapsed."""
    out = strip_tags(blank(c))
    for entity, plain in LIGHT_ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return strip_wide(F.regexp_replace(out, f"[{WIDE_SPACE}]+", " "))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Characters that compatibility folding turns into one of a-z and 0-9, and what they turn into.

    Derived from the Unicode database.  Those that fold to several (ligatures, fractions) are left to
    ``_spell_out``.
    """
    src, dst = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        key = re.sub("[^a-z0-9]", "", unicodedata.normalize("NFKD", char))
        if len(key) == 1:
            src.append(char)
            dst.append(key)
    return "".join(src), "".join(dst)


@F.pandas_udf(T.StringType())
def _spell_out(s: pd.Series) -> pd.Series:
    return s.map(lambda x: re.sub("[^a-z0-9]+", "", unicodedata.normalize("NFKD", x)), na_action="ignore")


def match_key(c: Column) -> Column:
    """Lower-case, compatibility-folded, only a-z and 0-9 left.

    Inside the JVM but for texts with a character that may fold to several.
    """
    src, dst = _fold_table()
    low = F.lower(blank(c))
    spelled = _spell_out(F.when(low.rlike(MAY_SPELL_OUT), low))
    folded = F.when(~low.rlike(_NON_ASCII), low).otherwise(F.coalesce(spelled, F.translate(low, src, dst)))
    return F.regexp_replace(folded, "[^a-z0-9]+", "")


def display_clean(c: Column) -> Column:
    """Text for a share card: ASCII word characters and light punctuation."""
    out = F.replace(blank(c), F.lit("&"), F.lit("and"))
    out = F.regexp_replace(out, DISPLAY_DROP, "")
    out = F.regexp_replace(out, f"[^{DISPLAY_KEEP}{SCRIPT_SPACE}]", "")
    out = F.regexp_replace(out, f"[{SCRIPT_SPACE}]+", " ")
    return F.regexp_replace(out, "^ | $", "")


def embedding_text(name: Column | None, description: Column) -> Column:
    if name is None:
        return blank(description)
    return F.concat(blank(name), F.lit(". "), blank(description))


def join_filled(*parts: Column, sep: str = ", ") -> Column:
    """Non-empty parts joined in order."""
    return F.array_join(F.filter(F.array(*[blank(p) for p in parts]), lambda x: x != ""), sep)


def location_line(venue: Column, address: Column, city: Column) -> Column:
    """Venue, then address and city unless the venue text already holds them."""
    v, a, t = blank(venue), blank(address), blank(city)
    return (F.when((a != "") & ~v.contains(a), join_filled(v, a, t))
            .when((t != "") & ~v.contains(t), join_filled(v, t))
            .otherwise(v))


def city_folder(city: Column, country: Column) -> Column:
    """``New York``, ``us`` -> ``New_York_US``."""
    def slug(c: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(strip_wide(blank(c)), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")

    base = slug(city)
    words = F.transform(
        F.split(F.when(base == "", F.lit("Location")).otherwise(base), "_"),
        lambda w: F.when((w == F.lower(w)) & w.rlike("[a-z]"),
                         F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))).otherwise(w))
    head = F.array_join(words, "_")
    tail = slug(F.upper(country))
    return F.when(tail != "", F.concat(head, F.lit("_"), tail)).otherwise(head)


def title_case(c: Column) -> Column:
    """First letter of every run of letters upper, the rest lower."""
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = F.regexp_extract_all(c, F.lit(f"([{cased}]+|[^{cased}]+)"), 1)

    def titled(x: Column) -> Column:
        first = F.substring(x, 1, 1)
        return F.concat(F.when(first == "ß", "Ss").otherwise(F.upper(first)), F.lower(F.substr(x, F.lit(2))))

    return F.array_join(F.transform(runs, titled), "")


def clean_url(c: Column) -> Column:
    """Trim and add a scheme where there is none; null when no host results."""
    s = strip_wide(blank(c))
    url = F.when(s.rlike("(?i)^https?://"), s).otherwise(F.concat(F.lit("https://"), s))
    host = F.try_parse_url(url, F.lit("HOST"))
    return F.when(host.isNotNull() & (host != ""), url)


def url_host(c: Column) -> Column:
    return F.lower(F.try_parse_url(c, F.lit("HOST")))
