"""HTML operators on a small tree built with the standard library's parser, as Arrow UDFs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that the opening of a new one of the same kind closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HIDDEN = ("script", "style", "noscript")
CHROME = (*HIDDEN, "header", "footer", "nav")
#: Words that mark a content container in class or id, and file types of attachments.
MARKERS = ("content", "article", "detail", "text", "main", "zw", "con")
ATTACHMENTS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".rar", ".7z", ".wps", ".csv")


@dataclass
class Node:
    name: str
    attrs: dict = field(default_factory=dict)
    children: list = field(default_factory=list)

    def walk(self):
        """All elements below, in document order; without recursion, so depth doesn't matter."""
        stack = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                yield x
                stack += reversed(x.children)

    def strings(self, skip: tuple[str, ...] = HIDDEN):
        stack = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.name not in skip:
                stack += reversed(x.children)

    def text(self, joint: str = " ", skip: tuple[str, ...] = HIDDEN) -> str:
        return joint.join(t for s in self.strings(skip) if (t := s.strip()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        while len(self.open) > 1 and self.open[-1].name in CLOSES.get(tag, ()):
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def selected(root: Node, selector: str) -> list[Node]:
    """Elements for one simple selector: name, .class, #id, or a name with them."""
    m = re.fullmatch(r"([\w-]*)((?:[.#][\w-]+)*)", selector)
    if not m:
        raise ValueError(f"not a simple selector: {selector}")
    wanted = re.findall(r"([.#])([\w-]+)", m[2])
    return [n for n in root.walk() if (not m[1] or n.name == m[1]) and all((v == n.attrs.get("id")) if k == "#" else v in n.attrs.get("class", "").split() for k, v in wanted)]


def choose_article(root: Node, selectors: tuple[str, ...] = (), least: int = 50, scale: int = 1000) -> tuple[Node, str, float]:
    """The candidate with the longest text: nodes by selector, containers marked as content, and the body, first on a tie."""
    options = []
    for s in selectors:
        options += [(len(t), s, n) for n in selected(root, s) if len(t := n.text(skip=CHROME)) > least]
    for n in root.walk():
        marker = f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}".lower()
        if n.name in ("article", "main", "div", "td") and any(x in marker for x in MARKERS) and len(t := n.text(skip=CHROME)) > least:
            options.append((len(t), "auto:" + (n.attrs.get("id") or n.attrs.get("class") or n.name), n))
    body = next((n for n in root.walk() if n.name == "body"), root)
    options.append((len(body.text(skip=CHROME)), "body", body))
    size, name, node = max(options, key=lambda x: x[0])
    return node, name, min(1.0, size / scale)


def grid(table: Node) -> list[list[str]]:
    """Rows of a table with spans filled in."""
    rows, spans = [], {}
    trs = [n for n in table.walk() if n.name == "tr"]
    for r, tr in enumerate(trs):
        row, c = [], 0
        for cell in [x for x in tr.children if isinstance(x, Node) and x.name in ("td", "th")]:
            while (r, c) in spans:
                row.append(spans[r, c])
                c += 1
            text = cell.text()
            down, across = (int(v) if (v := cell.attrs.get(k, "1")).isdigit() and 0 < int(v) <= 1000 else 1 for k in ("rowspan", "colspan"))
            for rr in range(r, min(r + down, len(trs))):
                for cc in range(c, c + across):
                    spans[rr, cc] = text
            row += [text] * across
            c += across
        while (r, c) in spans:
            row.append(spans[r, c])
            c += 1
        rows.append(row)
    return rows


def markdown(root: Node) -> str:
    """Headings, paragraphs, lists, links, images, emphasis, and tables as pipe tables."""
    out: list[str] = []

    def cell(t: str) -> str:
        return re.sub(r"\s+", " ", t).replace("|", "\\|").strip()

    def visit(n: Node):
        for x in n.children:
            if isinstance(x, str):
                out.append(re.sub(r"\s+", " ", x))
            elif x.name in HIDDEN:
                continue
            elif re.fullmatch("h[1-6]", x.name):
                out.append(f"\n\n{'#' * int(x.name[1])} {x.text()}\n\n")
            elif x.name == "table":
                rows = grid(x)
                width = max(map(len, rows), default=0)
                lines = ["| " + " | ".join(cell(v) for v in row + [""] * (width - len(row))) + " |" for row in rows]
                if lines:
                    out.append("\n\n" + "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]]) + "\n\n")
            elif x.name == "sup":
                out.append(f"[{x.text()}]")
            elif x.name == "a" and x.attrs.get("href"):
                out.append(f"[{x.text()}]({x.attrs['href']})")
            elif x.name == "img":
                out.append(f"![{x.attrs.get('alt', '')}]({x.attrs.get('src', '')})")
            elif x.name in ("b", "strong"):
                out.append(f"**{x.text()}**")
            elif x.name == "br":
                out.append("\n")
            else:
                block = x.name in ("p", "div", "article", "section", "ul", "ol", "li", "tr", "body", "main")
                out.append("\n\n" if block and x.name != "li" else "\n- " if x.name == "li" else "")
                visit(x)
                out.append("\n\n" if block and x.name != "li" else "")

    visit(root)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(out))).strip()


def main_text(root: Node, least: int = 50) -> str | None:
    """Text blocks with few links: a density rule in place of a learned extractor."""
    keep = []
    for n in root.walk():
        if n.name in ("p", "li", "blockquote", "pre") or re.fullmatch("h[1-6]", n.name):
            text = n.text(skip=CHROME)
            linked = sum(len(a.text()) for a in n.walk() if a.name == "a")
            if text and linked <= len(text) / 2:
                keep.append(text)
    out = "\n".join(keep)
    return out if len(out) >= least else None


def _udf(function, kind, arrow):
    @F.arrow_udf(kind)
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if (v := x.as_py()) is None else function(v) for x in values], arrow)

    return run


def html_to_text(html: Column) -> Column:
    return _udf(lambda h: "\n".join(t for s in parse(h).strings() if (t := s.strip())), T.StringType(), pa.string())(html)


def without_boilerplate(html: Column, selectors: tuple[str, ...] = ()) -> Column:
    """Text outside header, footer, nav and elements of the selectors."""

    def run(h):
        root = parse(h)
        gone = {id(n) for s in selectors for n in selected(root, s)}
        for n in [root, *root.walk()]:
            n.children = [x for x in n.children if isinstance(x, str) or id(x) not in gone]
        return root.text("\n", CHROME)

    return _udf(run, T.StringType(), pa.string())(html)


def article(html: Column, selectors: tuple[str, ...] = ()) -> Column:
    """struct<text,selector,confidence> of the chosen article node."""
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("selector", T.StringType()), T.StructField("confidence", T.DoubleType())])

    def run(h):
        node, name, confidence = choose_article(parse(h), selectors)
        return {"text": node.text("\n", CHROME), "selector": name, "confidence": confidence}

    return _udf(run, kind, pa.struct([("text", pa.string()), ("selector", pa.string()), ("confidence", pa.float64())]))(html)


def tables(html: Column) -> Column:
    """array<array<array<string>>>: every table's rows, the first being the header."""
    kind = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))
    return _udf(lambda h: [grid(n) for n in parse(h).walk() if n.name == "table"], kind, pa.list_(pa.list_(pa.list_(pa.string()))))(html)


def links(html: Column, base: Column, kind: str = "attachment") -> Column:
    """array<struct<url,name>> of attachments or images, absolute."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("url", T.StringType()), T.StructField("name", T.StringType())])))
    def run(htmls: pa.Array, bases: pa.Array) -> pa.Array:
        rows = []
        for h, b in zip(htmls, bases):
            own = []
            for n in parse(h.as_py()).walk():
                source = n.attrs.get("href", "") if n.name == "a" else (n.attrs.get("src") or n.attrs.get("data-src") or n.attrs.get("data-original") or "") if n.name == "img" else ""
                try:
                    url = urljoin(b.as_py() or "", source)
                    path = urlsplit(url).path.lower()
                except ValueError:
                    continue
                if source and (n.name == "img" if kind == "image" else n.name == "a" and path.endswith(ATTACHMENTS)):
                    own.append({"url": url, "name": n.attrs.get("alt", "") if kind == "image" else n.text()})
            rows.append(own)
        return pa.array(rows, pa.list_(pa.struct([("url", pa.string()), ("name", pa.string())])))

    return run(html, base)


def to_markdown(html: Column) -> Column:
    return _udf(lambda h: markdown(parse(h)), T.StringType(), pa.string())(html)


def table_counts(html: Column) -> Column:
    """struct<tables,rows,cells>."""

    def run(h):
        names = [n.name for n in parse(h).walk()]
        return {"tables": names.count("table"), "rows": names.count("tr"), "cells": names.count("td") + names.count("th")}

    return _udf(run, T.StructType([T.StructField(k, T.LongType()) for k in ("tables", "rows", "cells")]), pa.struct([(k, pa.int64()) for k in ("tables", "rows", "cells")]))(html)


def extract_main(html: Column) -> Column:
    return _udf(lambda h: main_text(parse(h)), T.StringType(), pa.string())(html)


def looks_like_html(text: Column) -> Column:
    return F.lower(F.left(text, F.lit(5000))).rlike("<html|<body|<!doctype html")


def has_table(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).rlike(r"(?i)<\s*table\b")
