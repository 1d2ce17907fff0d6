"""Texts put together from rows: documents with front matter, and research requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalars import text_or_empty


def line(label: str, value: Column) -> Column:
    """``label: value``, or null where there is no value: a line that is left out."""
    v = text_or_empty(value)
    return F.when(v != "", F.concat(F.lit(f"{label}: "), v))


def document(row: dict[str, Column], body: Column) -> Column:
    """A document: heading, subtitle if there is one, front matter, body.  ``row``: title, subtitle, pope, published_date, doc_type, source, alternate_source."""
    subtitle = text_or_empty(row["subtitle"])
    none = F.lit(None).cast("string")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("# "), text_or_empty(row["title"])), F.lit(""),
        F.when(subtitle != "", F.concat(F.lit("*"), subtitle, F.lit("*\n"))),
        F.lit("---"),
        *[F.concat(F.lit(f"{k}: "), text_or_empty(row[k])) for k in ("pope", "title")],
        line("subtitle", row["subtitle"]), line("published_date", row["published_date"]),
        *[F.concat(F.lit(f"{k}: "), text_or_empty(row[k])) for k in ("doc_type", "source")],
        line("alternate_source", row.get("alternate_source", none)),
        F.lit("---"), F.lit(""), F.trim(body), F.lit(""),
    )


def research_request(catalog: DataFrame, themes: DataFrame, template: str, reminders: str | None = None, key: str = "stem") -> DataFrame:
    """``request`` for each row of the catalog with a theme report: metadata, the report word for word, the template.

    ``themes`` has the key, ``theme_report`` and ``theme_text``.  A missing date is ``Unknown``.
    """
    meta = lambda label, c: F.concat(F.lit(f"- {label}: "), text_or_empty(c))
    published = F.when(text_or_empty("published_date") == "", "Unknown").otherwise(F.col("published_date"))
    alternate = text_or_empty("alternate_url") if "alternate_url" in catalog.columns else F.lit("")
    request = F.concat_ws(
        "\n",
        F.lit("# Research request\n\n## Document"),
        meta("Pope", F.col("pope")), meta("Title", F.col("title")), meta("Published", published), meta("Primary URL", F.col("link")),
        F.when(alternate != "", F.concat(F.lit("- Alternate URL: "), alternate)),
        meta("Source file", F.col("source_file")), meta("Step 3 theme report", F.col("theme_report")),
        F.lit(""), F.col("theme_text"), F.lit(""), F.lit(template), *([F.lit(reminders)] if reminders else []),
    )
    return catalog.join(themes, key).withColumn("request", request)


def remaining(themes: DataFrame, gradients: DataFrame, key: str = "stem") -> DataFrame:
    """Themes without a valid gradient: what is still to be researched."""
    return themes.join(gradients.select(key), key, "left_anti")
