"""Table functions: links, sections and citations of a page as rows, for lateral joins and SQL.

A row of a function leaves it as soon as it is found, so no array of all of a page's stands in a row.  ``register`` makes
them known to SQL: ``SELECT ... FROM pages, LATERAL html_links(html, url)``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.html import links, section_links

_HEADING = re.compile(r"^(#{2,3}) ([^\n]*)")
_ROW = re.compile(r"^\s*\|.*\|\s*$")
_RULE = re.compile(r"^[\s|:-]+$")


class HtmlLinksRows:
    """Links to pages whose text is long enough, as :func:`html.links` finds them."""

    def eval(self, html: str, base: str) -> Iterator[tuple]:
        for pos, (text, url) in enumerate(links(html, base or "") if html is not None else ()):
            yield pos, text, url


class HtmlSectionsRows:
    """Links with the ``h3`` above them."""

    def eval(self, html: str, base: str) -> Iterator[tuple]:
        for pos, found in enumerate(section_links(html, base or "") if html is not None else ()):
            yield pos, *found


class MarkdownSectionsRows:
    """Level, heading and body of each part below ``##`` or ``###``, as :func:`extract.sections` has them."""

    def eval(self, text: str) -> Iterator[tuple]:
        pos, level, heading, body = 0, 0, "", []
        for line in (text or "").split("\n"):
            if found := _HEADING.match(line):
                if level:
                    yield pos, level, heading, "\n".join(body).strip(" \t\n\x0b\f\r")
                    pos += 1
                level, heading, body = len(found[1]), found[2].strip(" "), []
            else:
                body.append(line)
        if level:
            yield pos, level, heading, "\n".join(body).strip(" \t\n\x0b\f\r")


class CitationsRows:
    """Cells of each row of the pipe tables, without the first row and rules if there is a rule, as :func:`extract.citations` has them."""

    def eval(self, text: str) -> Iterator[tuple]:
        lines = [x for x in (text or "").split("\n") if _ROW.match(x)]
        rows = [x for x in lines if not _RULE.match(x)]
        for pos, line in enumerate(rows[1:] if len(rows) < len(lines) else rows):
            inner = line.strip(" ")
            inner = inner[1:] if inner.startswith("|") else inner
            inner = inner[:-1] if inner.endswith("|") else inner
            yield pos, [c.strip(" ") for c in inner.split("|")]


#: The six columns of a citation, as the table's specification has them.
CITATION = ("number", "type", "author", "title", "year", "url")


class CitationTableRows:
    """Citations of tables with six columns, or with three: type, citation and note, the citation as title and the note as year left empty.

    Rows of other widths are left out.
    """

    def eval(self, text: str) -> Iterator[tuple]:
        for pos, cells in CitationsRows().eval(text):
            if len(cells) == len(CITATION):
                yield pos, *cells
            elif len(cells) == 3:
                yield pos, "", cells[0], "", cells[1], "", cells[2]


#: The functions; the classes above are what runs in a task.
HtmlLinks = F.udtf(HtmlLinksRows, returnType="pos int, text string, url string")
HtmlSections = F.udtf(HtmlSectionsRows, returnType="pos int, heading string, text string, url string")
MarkdownSections = F.udtf(MarkdownSectionsRows, returnType="pos int, level int, heading string, body string")
Citations = F.udtf(CitationsRows, returnType="pos int, cells array<string>")
CitationTable = F.udtf(CitationTableRows, returnType="pos int, " + ", ".join(f"{c} string" for c in CITATION))

FUNCTIONS = {"html_links": HtmlLinks, "html_sections": HtmlSections, "md_sections": MarkdownSections, "md_citations": Citations, "md_citation_table": CitationTable}


def register(spark: SparkSession) -> None:
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
