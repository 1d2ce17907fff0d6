"""Scalar expressions for dates, file names, links and titles; all of them columns, two of them Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that no file name holds, the longest part of one, the date of a document without any.
FORBIDDEN = r'[\\/:*?"<>|]'
PART_LENGTH = 100
NO_DATE = "00000000"
#: Spellings in titles that stand for others.
TITLE_ALIASES = {"celebationem": "celebrationem"}


def text_or_empty(c: Column | str) -> Column:
    """Missing values are empty strings, as in a CSV file."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ddmmyyyy(iso_date: Column) -> Column:
    """Day, month, year of a date text; zeros if it has under 10 characters, null if the first 10 are not three parts."""
    d = text_or_empty(iso_date)
    parts = F.split(F.substring(d, 1, 10), "-")
    return F.when(F.length(d) < 10, NO_DATE).when(F.size(parts) == 3, F.concat(parts[2], parts[1], parts[0]))


def iso_to_date(iso_date: Column) -> Column:
    """The same text as a date, null where the calendar has no such day."""
    return F.try_to_date(F.substring(text_or_empty(iso_date), 1, 10), "yyyy-MM-dd")


def file_part(text: Column, max_length: int = PART_LENGTH, strip_html: bool = False) -> Column:
    """A piece of a file name: no forbidden characters, white space made one blank, cut, no blanks or dots at the end."""
    t = text_or_empty(text)
    if strip_html:
        from corpusloom.functions.html import html_text

        t = html_text(t)
    t = F.regexp_replace(t, FORBIDDEN, "")
    t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    return F.regexp_replace(F.substring(t, 1, max_length), r"[ .]+$", "")


def url_stem(link: Column) -> Column:
    """The last segment of a link without its last suffix, ``doc`` if there is none; a query is part of the segment."""
    name = F.regexp_extract(F.regexp_replace(text_or_empty(link), "/+$", ""), r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")
    return F.when(stem == "", "doc").otherwise(stem)


def url_path_stem(url: Column) -> Column:
    """The stem of the path of a URL: what a site's interface calls its slug."""
    return url_stem(F.regexp_extract(text_or_empty(url), r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1))


def fold_title(text: str) -> str:
    t = unicodedata.normalize("NFKD", text)
    t = "".join(ch for ch in t if not unicodedata.combining(ch)).lower()
    for old, new in TITLE_ALIASES.items():
        t = t.replace(old, new)
    return " ".join(re.sub(r"[^a-z0-9\s]", " ", t).split())


@F.pandas_udf(T.StringType())
def normal_title(titles: pd.Series) -> pd.Series:
    """Tags and accents dropped, lower case, words of a-z and 0-9 with one blank between; Spark has no NFKD of its own."""
    from corpusloom.functions.html import parse

    return titles.fillna("").map(lambda t: fold_title(parse(t).text() if "<" in t or "&" in t else t))


def title_words(normal: Column) -> Column:
    """Distinct words of over two characters of a normal title."""
    return F.array_distinct(F.filter(F.split(normal, " "), lambda w: F.length(w) > 2))


def theme_bucket(theme: Column) -> Column:
    t = F.trim(text_or_empty(theme))
    return F.when(t == "", "empty").when(t.isin("Social", "Spiritual", "Mixed"), t).when(t.contains("Mixed"), "Mixed-variant").otherwise("other")


def utc_stamp(ts: Column | None = None) -> Column:
    """A time as ISO text with whole seconds; now, unless a clock is given."""
    return F.concat(F.date_format(F.to_utc_timestamp(F.current_timestamp() if ts is None else ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def batch_id(stamp: Column) -> Column:
    return F.concat(F.lit("batch-"), F.regexp_replace(stamp, "[-:]", ""))


def or_else(c: Column, other: Column) -> Column:
    """``c`` unless it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), other)


@F.pandas_udf(T.StringType())
def join_url(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b or "", h or "") for b, h in zip(base, href, strict=True)])


def after_prefix(c: Column, prefix: str = "dco:") -> Column:
    """What follows the prefix, null where it does not stand."""
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30))


def clean_converted(text: Column, title: str) -> Column:
    """A converted word-processor text from its title on, without link fields."""
    t = F.regexp_replace(text, f"(?i)^.*?(?={re.escape(title)})", "") if title else text
    return F.trim(F.regexp_replace(t, r'HYPERLINK\s+"[^"]*"', ""))
