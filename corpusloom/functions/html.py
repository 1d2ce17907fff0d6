"""HTML trees on the standard library's parser: main content, noise removal, links, markdown.

Each public function is an Arrow function over a column.  What fails in a row gives an error text in that row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags that never hold content, and what a class of a noise element has in it (any case).
NOISE_TAGS = ("script", "style", "nav", "header", "footer", "form", "noscript")
NOISE_CLASSES = (
    "share", "social", "breadcrumb", "menu", "sidebar", "comment", "related", "language", "utility", "va-menu",
    "va-search", "translation-field", "translation", "doc-copyright", "copyright", "entry-meta", "continue-reading",
    "post-navigation", "tags", "author",
)
#: Classes of headings that repeat the title; where content is looked for, in this order.
TITLE_CLASSES = ("entry-title", "page-title", "site-title")
ARCHIVE_HOST = "vatican.va"
ARCHIVE_SELECTORS = (".testo", ".documento")
ARTICLE_SELECTORS = ("article.post", "article.hentry", "article", ".entry-content", "main")
#: Fewest characters of a body, of a converted document, of a link's text.
BODY_LENGTH, CONVERTED_LENGTH, LINK_TEXT = 100, 200, 4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NOISE = re.compile("|".join(NOISE_CLASSES), re.I)
_TITLES = re.compile("|".join(TITLE_CLASSES), re.I)


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """Elements below, in document order, without recursion."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = [self]
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            else:
                stack.extend(reversed(c.children))

    def text(self) -> str:
        return "".join(self.strings())

    def words(self) -> str:
        """Stripped strings with a blank between."""
        return " ".join(s.strip() for s in self.strings() if s.strip())

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def select(self, selector: str) -> Node | None:
        """The first element that ``tag``, ``.class`` or ``tag.class`` fits."""
        tag, _, cls = selector.partition(".")
        return next((n for n in self.walk() if (not tag or n.tag == tag) and (not cls or cls in n.classes)), None)

    def drop(self, unwanted: Callable[[Node], bool]) -> None:
        for n in [n for n in self.walk() if unwanted(n)]:
            if n.parent is not None and n in n.parent.children:
                n.parent.children.remove(n)
                n.parent = None

    def html(self) -> str:
        out: list[str] = []
        stack: list[Node | str | tuple[str]] = [self]
        while stack:
            c = stack.pop()
            if isinstance(c, tuple):
                out.append(c[0])
            elif isinstance(c, str):
                out.append(escape(c, quote=False))
            elif c.tag == "#root":
                stack.extend(reversed(c.children))
            else:
                out.append(f"<{c.tag}{''.join(f' {k}="{escape(v)}"' for k, v in c.attrs.items())}>")
                if c.tag not in VOID:
                    stack.append((f"</{c.tag}>",))
                    stack.extend(reversed(c.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = self.root = Node("#root")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def drop_noise(root: Node) -> Node:
    """Without noise tags, elements below of a noise class, and links that only say to read on."""
    root.drop(lambda n: n.tag in NOISE_TAGS)
    root.drop(lambda n: any(map(_NOISE.search, n.classes)))
    root.drop(lambda n: n.tag == "a" and len(n.children) == 1 and isinstance(n.children[0], str) and bool(re.search("Continue reading", n.children[0], re.I)))
    return root


def content(html: str, url: str) -> Node:
    """The element with the content of a page, by host, without noise and repeated titles."""
    page = parse(html)
    body = page.select("body")
    if ARCHIVE_HOST in (url or ""):
        root = next((n for s in ARCHIVE_SELECTORS if (n := page.select(s))), body)
    else:
        root = next((n for s in ARTICLE_SELECTORS if (n := page.select(s)) and n.text().strip()), body)
    if root is None:
        raise ValueError("Could not find main content")
    drop_noise(root)
    root.drop(lambda n: n.tag in ("h1", "h2") and any(map(_TITLES.search, n.classes)))
    return root


def plain_content(html: str) -> Node:
    """The body, or all there is, without noise."""
    page = parse(html)
    return drop_noise(page.select("body") or page)


def markdown(root: Node) -> str:
    """Headings, paragraphs, lists, quotes, emphasis, links in angle brackets; no wrapping, no images."""

    def inline(n: Node | str) -> str:
        if isinstance(n, str):
            return re.sub(r"\s+", " ", n)
        if n.tag in ("img", "script", "style", "head"):
            return ""
        if n.tag == "br":
            return "  \n"
        inner = "".join(map(inline, n.children))
        bare = inner.strip()
        if not bare:
            return inner
        lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
        if n.tag in ("b", "strong"):
            return f"{lead}**{bare}**{tail}"
        if n.tag in ("i", "em", "u"):
            return f"{lead}_{bare}_{tail}"
        if n.tag == "a" and n.attrs.get("href"):
            return f"{lead}[{bare}](<{n.attrs['href']}>){tail}"
        return f"`{bare}`" if n.tag == "code" else inner

    blocks = frozenset("p div section article main body html ul ol li blockquote h1 h2 h3 h4 h5 h6 pre table tr td th hr header footer nav aside dl dt dd form".split())

    def has_block(n: Node) -> bool:
        return any(c.tag in blocks for c in n.walk())

    def render(n: Node, out: list[str]) -> None:
        run: list[str] = []

        def close() -> None:
            text = "".join(run).strip()
            if text:
                out.append(text)
            run.clear()

        for c in n.children:
            if isinstance(c, str) or (c.tag not in blocks and not has_block(c)):
                run.append(inline(c))
                continue
            close()
            if re.fullmatch("h[1-6]", c.tag):
                text = " ".join("".join(map(inline, c.children)).split())
                if text:
                    out.append("#" * int(c.tag[1]) + " " + text)
            elif c.tag in ("ul", "ol"):
                items = []
                for k, li in enumerate([x for x in c.children if isinstance(x, Node)], 1):
                    inner: list[str] = []
                    render(li, inner)
                    if inner:
                        items.append(("  * " if c.tag == "ul" else f"  {k}. ") + "\n".join(inner).replace("\n", "\n    "))
                if items:
                    out.append("\n".join(items))
            elif c.tag == "blockquote":
                inner = []
                render(c, inner)
                if inner:
                    out.append("\n".join("> " + line for line in "\n\n".join(inner).split("\n")))
            elif c.tag == "hr":
                out.append("* * *")
            elif c.tag == "pre":
                out.append("\n".join("    " + line for line in c.text().strip("\n").split("\n")))
            else:
                render(c, out)
        close()

    out: list[str] = []
    holder = Node("#root")
    holder.children = [root]
    render(holder, out)
    return "\n\n".join(out).strip()


def links(html: str, base: str) -> list[tuple[str, str]]:
    """Text and address of each link to an ``.html`` page whose text is long enough, in order."""
    out = []
    for n in parse(html).walk():
        if n.tag == "a" and ".html" in n.attrs.get("href", ""):
            text = n.words()
            if len(text) >= LINK_TEXT:
                out.append((text, urljoin(base, n.attrs["href"])))
    return out


def section_links(html: str, base: str) -> list[tuple[str | None, str, str]]:
    """Heading (``h3``) above, text and address of each link with a text, in order; null before the first heading."""
    out, heading = [], None
    for n in parse(html).walk():
        if n.tag == "h3":
            heading = n.words()
        elif n.tag == "a" and n.attrs.get("href") and (text := n.words()):
            out.append((heading, text, urljoin(base, n.attrs["href"])))
    return out


#: A value, or why there is none.
OUTCOME = T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])


def _guarded(f: Callable[..., str], *args: str | None) -> tuple[str | None, str | None]:
    if args[0] is None:
        return None, "no page"
    try:
        return f(*args), None
    except (ValueError, RecursionError, AssertionError) as e:
        return None, str(e) or type(e).__name__


def _struct(rows: list[tuple[str | None, str | None]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["value", "error"])


@F.pandas_udf(OUTCOME)
def content_html(html: pd.Series, url: pd.Series) -> pd.DataFrame:
    return _struct([_guarded(lambda h, u: content(h, u or "").html(), h, u) for h, u in zip(html, url, strict=True)])


def to_body(html: str, url: str, least: int = BODY_LENGTH) -> str:
    body = markdown(content(html, url))
    if len(body) < least:
        raise ValueError(f"Extracted body too short ({len(body)} chars)")
    return body


@F.pandas_udf(OUTCOME)
def page_body(html: pd.Series, url: pd.Series) -> pd.DataFrame:
    """The content of a page as markdown, or why there is none."""
    return _struct([_guarded(lambda h, u: to_body(h, u or ""), h, u) for h, u in zip(html, url, strict=True)])


@F.pandas_udf(OUTCOME)
def simple_body(html: pd.Series) -> pd.DataFrame:
    return _struct([_guarded(lambda h: markdown(plain_content(h)), h) for h in html])


@F.pandas_udf(T.StringType())
def html_markdown(html: pd.Series) -> pd.Series:
    """Markdown of a fragment as it is: content that comes from an interface, not from a page."""
    return html.map(lambda h: None if h is None else markdown(parse(h)))


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else parse(h).text() if "<" in h or "&" in h else h)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("url", T.StringType())])))
def html_links(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([[] if h is None else [{"text": t, "url": u} for t, u in links(h, b or "")] for h, b in zip(html, base, strict=True)])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("heading", "text", "url")])))
def html_sections(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([[] if h is None else [{"heading": a, "text": t, "url": u} for a, t, u in section_links(h, b or "")] for h, b in zip(html, base, strict=True)])
