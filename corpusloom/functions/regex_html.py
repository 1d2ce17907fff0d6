"""The part of HTML extraction that patterns can express: built-in functions only, for pages without nested content tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.html import NOISE_TAGS


def article(html: Column) -> Column:
    """What the first ``article`` element holds, empty if there is none."""
    return F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<article[^>]*>(.*?)</article>", 1)


def without_noise(html: Column) -> Column:
    for tag in NOISE_TAGS:
        html = F.regexp_replace(html, rf"(?is)<{tag}[ >].*?</{tag}>", " ")
    return html


def plain(html: Column) -> Column:
    """Text without tags and comments, white space made one blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", " "), r"[\s]+", " "))
