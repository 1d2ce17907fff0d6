"""Catalogs: rows from several listings, one for each address; counts by author."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.match import first_by


def normal_url(url: Column) -> Column:
    """For comparison: no scheme, query, fragment or slash at the end, host in lower case.  A choice of ours: none is given."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"/+$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^([^/]*)", 1)
    return F.concat(F.lower(host), F.substring(rest, F.length(host) + 1, F.lit(1 << 30)))


def dedupe_urls(df: DataFrame, url: str = "url", pos: str = "pos", within: tuple[str, ...] = (), normalise: bool = True) -> DataFrame:
    """The first row of each address, within the given columns."""
    keyed = df.withColumn("_url", normal_url(F.col(url)) if normalise else F.col(url))
    return first_by(keyed, [*within, "_url"], pos).drop("_url")


def union_listings(*listings: DataFrame, url: str = "url", pos: str = "pos") -> DataFrame:
    """All listings in turn, then the first row of each address."""
    out = None
    for i, x in enumerate(listings):
        x = x.withColumn("_listing", F.lit(i))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    keyed = out.withColumn("_url", normal_url(F.col(url)))
    return first_by(keyed, ["_url"], "_listing", pos).drop("_url", "_listing")


def author_summary(catalog: DataFrame, author: str = "pope", date: str = "published_date") -> DataFrame:
    return catalog.groupBy(author).agg(F.count("*").alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def content_sections(df: DataFrame, heading: str = "heading") -> DataFrame:
    """Without sections of further links.  Fixed value: their heading."""
    return df.filter(F.trim(F.col(heading)) != "Additional Links")


def span_bucket(published: Column, event: Column) -> Column:
    """How long after publication an event lies: within 1, 5 or 10 years, or later.  An extension."""
    years = F.floor(F.datediff(event, published) / 365.25)
    return F.when(years < 0, "before").when(years < 1, "1y").when(years < 5, "5y").when(years < 10, "10y").otherwise("later")
