"""HTML sources as Spark jobs over page text.

Regular expressions run inside the JVM (``regexp_extract_all``); the only
Python is HTML entity decoding, applied through an Arrow-batched pandas UDF
that gets nothing but values that contain ``&``.  HTML by regular expression is
approximate (unclosed tags, comments): containers without a link and pages
without exactly one marked script are counted as rejects, never dropped
silently.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed patterns: a directory container, a tag with quoted attribute values, one attribute, and a script element.
CONTAINER_RE = r"(?s)<li\b[^>]*>(.*?)</li>"
_ATTRS = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
ANCHOR_RE = rf"(?is)<a(?:\s{_ATTRS})?>"
ATTR_RE = r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?"""
SCRIPT_RE = r"(?s)<script\b[^>]*>(.*?)</script>"
SCRIPT_TAG_RE = rf"(?is)<script((?:\s{_ATTRS})?)>(.*?)</script\s*>"


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else _html.unescape(x))


def decode_entities(c: Column) -> Column:
    """Entity-decode values in which an entity may occur; the others are sent
    to the Python worker as null."""
    some = c.contains("&")
    return F.when(some, _unescape(F.when(some, c))).otherwise(c)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag ("" if absent or without a value), by
    one scan over its name and value pairs: double, single or no quotes, any
    white space, names in any case, the first of equal names."""
    inside = F.regexp_replace(tag, r"^<[^\s>]*|/?>$", "")
    names = F.transform(F.regexp_extract_all(inside, F.lit(ATTR_RE), 1), F.lower)
    value = F.try_element_at(F.regexp_extract_all(inside, F.lit(ATTR_RE), 2), F.nullif(F.array_position(names, name), F.lit(0)).cast("int"))
    return F.coalesce(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"), F.lit(""))


def containers(pages: DataFrame, html_col: str = "html", container_re: str = CONTAINER_RE) -> DataFrame:
    """Every container element of every page, with its position."""
    return pages.select(
        "*", F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(container_re), 1)).alias("_idx", "_inner")
    ).drop(html_col)


def hotel_links(pages: DataFrame, html_col: str = "html", container_re: str = CONTAINER_RE) -> DataFrame:
    """For each container the *first* anchor; containers without one are
    flagged ``has_link = false`` (the caller keeps them as rejects).

    ``href`` and ``title`` default to '' and the title is stripped."""
    c = containers(pages, html_col, container_re)
    anchor = F.regexp_extract(F.col("_inner"), ANCHOR_RE, 0)
    return c.select(
        "*",
        (anchor != F.lit("")).alias("has_link"),
        decode_entities(attribute(anchor, "href")).alias("path"),
        F.regexp_replace(decode_entities(attribute(anchor, "title")), r"^\s+|\s+$", "").alias("title"),
    ).drop("_inner")


def element_re(name: str, token: str) -> str:
    """Pattern of the elements ``name`` whose class has the word ``token``; group 1 is what stands inside up to the first end tag."""
    return rf"""(?is)<{name}\s(?={_ATTRS}class\s*=\s*(?:"[^"]*(?<![^\s"]){token}(?![^\s"])[^"]*"|'[^']*(?<![^\s']){token}(?![^\s'])[^']*'|{token}[\s>]))(?:{_ATTRS})>(.*?)</{name}\s*>"""


def marked_script(pages: DataFrame, html_col: str, attr: str, value: str) -> DataFrame:
    """The script that has the attribute value; exactly one is required.

    Adds ``n_marked`` (how many have it) and ``script`` (the text of the only
    one, else null)."""
    text = F.col(html_col)
    tags, bodies = (F.regexp_extract_all(text, F.lit(SCRIPT_TAG_RE), k) for k in (1, 2))
    both = F.arrays_zip(tags.alias("tag"), bodies.alias("body"))
    marked = F.filter(both, lambda x: attribute(F.concat(F.lit("<script"), x["tag"], F.lit(">")), attr) == value)
    out = pages.withColumn("_marked", F.coalesce(marked, F.array().cast("array<struct<tag:string,body:string>>")))
    return out.select(*pages.columns, F.size("_marked").alias("n_marked"),
                      F.when(F.size("_marked") == 1, F.col("_marked")[0]["body"]).alias("script"))


def embedded_script(pages: DataFrame, html_col: str = "html", marker: str = r"track\((\d+)\)") -> DataFrame:
    """Scripts whose body matches ``marker``; exactly one is required.

    Adds ``n_marked`` (how many matched) and ``payload`` (first group of the
    marker inside the single marked script, else null).  Strict callers
    reject ``n_marked <> 1`` (``raise_error`` if they must abort)."""
    scripts = F.regexp_extract_all(F.col(html_col), F.lit(SCRIPT_RE), 1)
    marked = F.filter(scripts, lambda s: s.rlike(marker))
    return pages.select(
        "*", F.size(marked).alias("n_marked"), F.try_element_at(marked, F.lit(1)).alias("_script")
    ).select(
        "*",
        F.when(F.col("n_marked") == 1, F.regexp_extract(F.col("_script"), marker, 1)).alias("payload"),
    ).drop("_script")


def require_one(df: DataFrame, count_col: str = "n_marked") -> DataFrame:
    """Strict mode: fail the job if any page has not exactly one marked script."""
    # In a filter the check runs whatever columns are used later.
    found = F.raise_error(F.concat(F.lit("expected 1 marked script, found "), F.col(count_col).cast("string")))
    return df.filter(F.when(F.col(count_col) == 1, F.lit(True)).otherwise(found.cast("boolean")))
