"""Fields out of semi-structured markdown and JSON, all of them built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The axes of a gradient, under all names an axis may have; the labels of a theme report.
AXES = {"reflective": ("reflective",), "prescriptive": ("prescriptive", "prospective")}
PARTS = ("saturation", "density")
REPORT_LABELS = ("Key theme", "Theme (one sentence)", "Summary", "Response to", "Prescriptive towards", "Tension")
_QUOTED = str.maketrans({c: "\\" + c for c in "()[]{}.*+?^$|\\"})


def bullet(text: Column, label: str, across_lines: bool = False) -> Column:
    """The value of ``- **label:** value``, the first there is, else empty.

    An empty value takes the next line that is not: white space after the label runs over line ends.
    """
    flags = "(?imsd)" if across_lines else "(?imd)"
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), flags + r"^\s*-\s*\*\*" + label.translate(_QUOTED) + r":\*\*\s*(.+?)\s*$", 1))


def key_theme(text: Column) -> Column:
    return bullet(text, "Key theme")


def summary(text: Column) -> Column:
    return bullet(text, "Summary", across_lines=True)


def gradient_json(text: Column) -> Column:
    """The JSON object fenced below the heading ``## Gradients``, null if there is none or it is no valid object."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?is)## Gradients\s*\n+(?:.*?\n+)?```json\s*\n(\{.*?\})\s*\n```", 1)
    block = F.when(F.lower(text).contains("## gradients") & (found != ""), found)
    return F.when(F.try_parse_json(block).isNotNull(), block)


def axis_value(block: Column, axis: str, part: str) -> Column:
    """A number of an axis as text, else empty.

    Of the names of the axis the first that is there decides: as an object, which need not have the part, or flat.
    """
    out = None
    for name in AXES[axis]:
        nested = F.get_json_object(block, f"$.{name}")
        flat = [F.get_json_object(block, f"$.{name}_{p}") for p in PARTS]
        # By the JSON type, not by how the text begins: a string may begin with a brace, too.
        is_object = F.coalesce(F.try_variant_get(F.try_parse_json(block), f"$.{name}", "map<string,variant>").isNotNull(), F.lit(False))
        out = F.when(is_object, F.get_json_object(block, f"$.{name}.{part}")) if out is None else out.when(is_object, F.get_json_object(block, f"$.{name}.{part}"))
        out = out.when(F.coalesce(*flat).isNotNull(), F.get_json_object(block, f"$.{name}_{part}"))
    return F.coalesce(out, F.lit(""))


def gradient(block: Column) -> Column:
    """The four numbers as text: ``reflective_saturation`` and so on."""
    return F.struct(*[axis_value(block, a, p).alias(f"{a}_{p}") for a in AXES for p in PARTS])


def front_matter(text: Column) -> Column:
    """Keys and values between two lines of ``---``, in order; a value may hold colons, quotes around it are dropped."""
    block = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?s)(?:^|\n)---\n(.*?)\n---(?:\n|$)", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^[^:\s][^:]*:"))
    return F.transform(lines, lambda x: F.struct(
        F.trim(F.regexp_extract(x, r"^([^:]+):", 1)).alias("key"),
        F.regexp_replace(F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)), r'^"(.*)"$', "$1").alias("value"),
    ))


def front_value(text: Column, key: str) -> Column:
    return F.get(F.filter(front_matter(text), lambda x: x["key"] == key), F.lit(0))["value"]


def sections(text: Column) -> Column:
    """Level, heading and body of each part below ``##`` or ``###``."""
    # A heading opens a part; whatever stands before the first one is in none.
    parts = F.split(F.concat(F.lit("\n"), F.coalesce(text, F.lit(""))), r"\n(?=#{2,3} )")
    return F.transform(F.filter(parts, lambda p: p.rlike(r"^#{2,3} ")), lambda p: F.struct(
        F.length(F.regexp_extract(p, r"^(#+) ", 1)).alias("level"),
        F.trim(F.regexp_extract(p, r"^#+ ([^\n]*)", 1)).alias("heading"),
        F.regexp_replace(F.regexp_replace(p, r"^#+ [^\n]*\n?", ""), r"^\s+|\s+$", "").alias("body"),
    ))


def citations(text: Column) -> Column:
    """Cells of each row of the pipe tables, without headings and rules."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    table = F.filter(lines, lambda x: x.rlike(r"^\s*\|.*\|\s*$"))
    rule = F.filter(table, lambda x: x.rlike(r"^[\s|:-]+$"))
    body = F.filter(table, lambda x: ~x.rlike(r"^[\s|:-]+$"))
    # Each rule has one heading above it.
    rows = F.when(F.size(rule) > 0, F.slice(body, 2, 1 << 30)).otherwise(body)
    return F.transform(rows, lambda x: F.transform(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c)))


def query_value(text: Column, key: str) -> Column:
    """The value of ``- key: value``, else empty."""
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?md)^- " + key.translate(_QUOTED) + r":[ \t]*(.*)$", 1))
