"""Regex access to HTML text and access to JSON of varying shape (``VARIANT``)."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.text import SCRIPT_SPACE

JSON_LD_BLOCK = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
_OPEN = "(?is)"


@F.pandas_udf(T.StringType())
def _unescape_once(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def decode_entities(c: Column) -> Column:
    """Character references as a browser reads them; rows without any skip Python."""
    return F.coalesce(_unescape_once(F.when(c.contains("&"), c)), c)


def strip_script(c: Column) -> Column:
    """Strip white space as a script's ``trim`` does."""
    return F.regexp_replace(c, f"^[{SCRIPT_SPACE}]+|[{SCRIPT_SPACE}]+$", "")


def inner_text(c: Column) -> Column:
    """Markup removed, ends stripped; entities stay."""
    return strip_script(F.regexp_replace(F.regexp_replace(c, "(?s)<!--.*?-->", ""), "<[^>]*>", ""))


def tag_text_pattern(tag: str) -> str:
    """First element of a tag, content up to its own closing tag."""
    return f"{_OPEN}<{tag}(?:[ \\t\\r\\n][^>]*)?>(.*?)</{tag}[ \\t\\r\\n]*>"


def attribute_pattern(attribute: str, tag: str = "[a-z][a-z0-9]*") -> str:
    """Value of an attribute of the first element that has it."""
    return f"""{_OPEN}<{tag}[ \\t\\r\\n](?:[^>]*[ \\t\\r\\n])?{attribute}[ \\t\\r\\n]*=[ \\t\\r\\n]*["']([^"']*)"""


def marked_element_pattern(attribute: str, value: str, exact: bool = True) -> str:
    """The page from the opening tag of the first element on whose attribute is, or as a class list holds, ``value``."""
    inside = value if exact else f"(?:[^\"']*[ \\t\\r\\n])?{value}(?:[ \\t\\r\\n][^\"']*)?"
    return f"""{_OPEN}(<[a-z][a-z0-9]*[ \\t\\r\\n](?:[^>]*[ \\t\\r\\n])?{attribute}=["']{inside}["'][^>]*>.*)$"""


# Pieces of a page: comments, tags, and what stands between them.
_PIECE = r"(?s)<!--.*?-->|</?[a-zA-Z][^>]*>|[^<]+|<"
# Elements without content.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]


def _tag_name(piece: Column) -> Column:
    return F.lower(F.regexp_extract(piece, r"^</?([a-zA-Z][a-zA-Z0-9-]*)", 1))


def element_content(page: Column) -> Column:
    """Content of the element whose opening tag the text begins with, up to the closing tag that belongs to it.

    A fold over the pieces counts how deep elements of that name are nested.  A paragraph also ends where the next
    begins; without an end the element goes on to the end of the text; elements without content and empty texts give ''.
    """
    def opened(x: Column) -> Column:
        name, pieces = x["name"], x["pieces"]

        def step(acc: Column, piece: Column) -> Column:
            own = _tag_name(piece) == name
            closes = own & F.startswith(piece, F.lit("</"))
            depth = acc["depth"] + F.when(closes, -1).when(own, 1).otherwise(0)
            ends = (depth == 0) | (own & (name == "p") & (acc["depth"] == 1))
            return F.struct(depth.alias("depth"), (acc["at"] + F.length(piece)).alias("at"),
                            F.when(acc["stop"] >= 0, acc["stop"]).when(ends, acc["at"]).otherwise(-1).alias("stop"))

        first = F.length(F.element_at(pieces, 1))
        start = F.struct(F.lit(1).alias("depth"), first.alias("at"), F.lit(-1).alias("stop"))
        return F.aggregate(F.slice(pieces, 2, F.size(pieces)), start, step, lambda acc: F.substr(
            x["page"], first + 1, F.when(acc["stop"] >= 0, acc["stop"]).otherwise(acc["at"]) - first))

    parts = F.struct(page.alias("page"), _tag_name(page).alias("name"), F.regexp_extract_all(page, F.lit(_PIECE), 0).alias("pieces"))
    whole = F.element_at(F.transform(F.array(parts), opened), 1)
    return F.when((page == "") | _tag_name(page).isin(*VOID_TAGS, ""), "").otherwise(whole)


def marked_text(page: Column, attribute: str, value: str) -> Column:
    """Text of the first element whose attribute is ``value``, nested markup included."""
    return element_text(extract(page, marked_element_pattern(attribute, value)))


def element_text(page: Column) -> Column:
    """Text of the element whose opening tag the text begins with; a ``<`` that opens no tag is text."""
    content = F.regexp_replace(element_content(page), "(?s)<!--.*?-->", "")
    return strip_script(F.regexp_replace(content, "</?[a-zA-Z][^>]*>", ""))


def meta_pattern(prop: str, by: str) -> list[str]:
    """Content of a meta tag found by ``property`` or ``name``, in both attribute orders."""
    return [f"""{_OPEN}<meta[ \\t\\r\\n][^>]*{by}=["']{prop}["'][^>]*content=(?:"([^"]*)"|'([^']*)')""",
            f"""{_OPEN}<meta[ \\t\\r\\n][^>]*content=(?:"([^"]*)"|'([^']*)')[^>]*{by}=["']{prop}["']"""]


def extract(page: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(page, pattern, group)


def meta_content(page: Column, prop: str, by: tuple[str, ...] = ("property", "name")) -> Column:
    """Meta content by ``property``, else by ``name``; empty when absent."""
    found = [F.nullif(F.concat(extract(page, p, 1), extract(page, p, 2)), F.lit(""))
             for attribute in by for p in meta_pattern(prop, attribute)]
    return strip_script(F.coalesce(*found, F.lit("")))


def get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def fields(v: Column, names: str) -> Column:
    """Several fields of an object in one read, as a struct; null when it is no object.

    A field that is missing is null; Spark reads a path that is missing at many times the cost of one that is there.
    """
    return get(v, "$", f"struct<{names}>")


def first_filled(*values: Column) -> Column:
    """First filled text, else empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in values[:-1]], values[-1], F.lit(""))


def text_at(v: Column, *paths: str) -> Column:
    """First filled text among the paths, else empty."""
    return first_filled(*[get(v, p) for p in paths])


def is_object(v: Column) -> Column:
    return fields(v, "_: boolean").isNotNull()


def is_array(v: Column) -> Column:
    return get(v, "$", "array<boolean>").isNotNull()


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID")) == "STRING"


def truthy(v: Column) -> Column:
    """Present and not empty."""
    return F.coalesce(~v.try_cast("string").isin("", "{}", "[]", "false", "0"), F.lit(False))


def items(v: Column, path: str = "$") -> Column:
    """Elements of an array value, empty array when it is none."""
    return F.coalesce(get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def one_or_many(v: Column, path: str) -> Column:
    """A list, or a single present value as a list of one."""
    x = get(v, path, "variant")
    return F.when(is_array(x), items(v, path)).when(truthy(x), F.array(x)).otherwise(
        F.array().cast("array<variant>"))


def first_of(v: Column, path: str) -> Column:
    """The value itself, or the first element when it is a list."""
    x = get(v, path, "variant")
    return F.when(is_array(x), F.try_element_at(items(v, path), F.lit(1))).otherwise(x)
