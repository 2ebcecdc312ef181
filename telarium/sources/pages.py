"""Curriculum pages given as landed HTML: links, documents, strands and objectives.

The markup is read once per page in Arrow batches with the standard library's parser; what
follows is DataFrame work on the nested result. Filter pages by address before parsing: nothing is pushed
through the parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, urljoin, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_VOID = {"br", "img", "input", "hr", "meta", "link", "source", "area", "base", "col", "embed", "param", "track", "wbr"}
# Kinds of strands by the prefix of their anchor.
STRAND_KINDS = {"eje": "Eje", "ncleo": "Núcleo", "nucleo": "Núcleo", "habilidad": "Habilidad", "actitud": "Actitud", "modulo": "Módulo", "ambito": "Ámbito", "unidad": "Unidad"}
# What titles of objectives begin with, and the category that says.
TITLE_CATEGORIES = [("objetivo de aprendizaje de habilidad", "habilidad"), ("objetivo de aprendizaje de actitud", "actitud")]


class Element:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []

    def walk(self) -> Iterator["Element"]:
        stack = [self]
        while stack:
            e = stack.pop()
            yield e
            stack += [k for k in reversed(e.kids) if isinstance(k, Element)]

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            e = stack.pop()
            if isinstance(e, str):
                out.append(e)
            elif e.tag not in ("script", "style"):
                stack += reversed(e.kids)
        return re.sub(r"\s+", " ", "".join(out)).strip()

    def has(self, tag: str, cls: str | None = None) -> bool:
        return self.tag == tag and (cls is None or cls in self.attrs.get("class", "").split())

    def all(self, tag: str, cls: str | None = None) -> list["Element"]:
        return [e for e in self.walk() if e is not self and e.has(tag, cls)]

    def first(self, tag: str, cls: str | None = None) -> "Element | None":
        return next((e for e in self.walk() if e is not self and e.has(tag, cls)), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(e)
        if tag not in _VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].kids.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), 0)
        if at:
            del self.open[at:]

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def statement_of(e: Element | None) -> str:
    """Items of lists as lines with "- ", paragraphs and cells as lines, without repeats in a row; else the flat text."""
    if e is None:
        return ""
    out: list[str] = []
    stack: list = list(reversed(e.kids))
    while stack:
        k = stack.pop()
        if isinstance(k, str):
            continue
        if k.tag in ("li", "p", "td", "th"):
            text = k.text()
            line = f"- {text}" if k.tag == "li" else text
            if text and (not out or out[-1] != line):
                out.append(line)
        else:
            stack += reversed(k.kids)
    return "\n".join(out) or e.text()


def category_of(title: str) -> str:
    return next((c for t, c in TITLE_CATEGORIES if title.lower().startswith(t)), "conocimiento")


def page_record(url: str, html: str) -> dict | None:
    """The record of a page; None if its address has fewer than four parts or its markup is null."""
    parts = urlparse(url or "").path.strip("/").split("/")
    if len(parts) < 4 or html is None:
        return None
    root = parse(html)
    crumbs = [x.text() for ol in root.all("ol", "breadcrumb") for x in ol.all("li")]
    subject = grade = base = None
    for a in root.all("a", "link-button-more"):
        href = a.attrs.get("href", "")
        q = parse_qs(urlparse(href).query)
        if subject is None and "field_cn_subjects" in q:
            subject, grade = q["field_cn_subjects"][0], (q.get("field_cn_grades") or [None])[0]
        if base is None and (m := re.search(r"bases(?::|%3A)(\d+)", href)):
            base = m[1]
    documents = []
    for d in root.all("div", "documents-wrapper"):
        for art in d.all("article"):
            h3 = art.first("h3")
            a = h3.first("a") if h3 else None
            if a is not None:
                badge = art.first("span", "badge")
                documents.append({"doc_type": badge.text() or None if badge else None, "title": a.text(), "url": urljoin(url, a.attrs.get("href", ""))})
    objectives = []
    for g in root.all("div", "items-wrapper"):
        h3 = g.first("h3")
        anchor = h3.attrs.get("id", "") if h3 else ""
        kind, _, tail = anchor.partition("-")
        for item in g.all("div", "item-wrapper"):
            title, code = (x.text() if (x := item.first("span", c)) else "" for c in ("oa-title", "number-title"))
            if not title and not code:
                continue
            more = item.first("a", "link-more")
            if not code:
                code = re.sub(r"(?i)^objetivo de aprendizaje(?: de (?:habilidad|actitud))?\s*", "", title)
            objectives.append({
                "title": title, "code": code, "statement": statement_of(item.first("div", "field--name-description")), "category": category_of(title),
                "strand_name": (h3.text() or None) if h3 else None, "strand_kind": STRAND_KINDS.get(kind, kind.capitalize() or None) if h3 else None,
                "strand_term_id": (tail.split("--")[-1] or None) if "--" in tail else None,
                "prioritized": item.has("div", "prioritized"), "detail_url": urljoin(url, more.attrs.get("href", "")) if more else None,
            })
    h1 = root.first("h1")
    return {
        "url": url, "base_slug": parts[1], "subject_slug": parts[2], "grade_slug": parts[3], "page_title": h1.text() if h1 else "",
        "base_name": crumbs[2] if len(crumbs) >= 4 else None, "subject_name": crumbs[3] if len(crumbs) >= 4 else None,
        "source_subject_id": subject, "source_grade_id": grade, "source_base_id": base, "documents": documents, "objectives": objectives,
    }


_S, _D, _O = "string", "struct<doc_type:string,title:string,url:string>", "struct<title:string,code:string,statement:string,category:string,strand_name:string,strand_kind:string,strand_term_id:string,prioritized:boolean,detail_url:string>"
SCHEMA = f"url {_S}, base_slug {_S}, subject_slug {_S}, grade_slug {_S}, page_title {_S}, base_name {_S}, subject_name {_S}, source_subject_id {_S}, source_grade_id {_S}, source_base_id {_S}, documents array<{_D}>, objectives array<{_O}>"
_ARROW = pa.schema([
    *[(c, pa.string()) for c in ("url", "base_slug", "subject_slug", "grade_slug", "page_title", "base_name", "subject_name", "source_subject_id", "source_grade_id", "source_base_id")],
    ("documents", pa.list_(pa.struct([(c, pa.string()) for c in ("doc_type", "title", "url")]))),
    ("objectives", pa.list_(pa.struct([(c, pa.bool_() if c == "prioritized" else pa.string()) for c in ("title", "code", "statement", "category", "strand_name", "strand_kind", "strand_term_id", "prioritized", "detail_url")]))),
])


def read_pages(pages: DataFrame) -> DataFrame:
    """Nested records of pages(url, html); pages that aren't of a subject and grade are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [r for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if (r := page_record(u, h))]
            yield pa.RecordBatch.from_pylist(got, schema=_ARROW)

    return pages.select("url", "html").mapInArrow(run, SCHEMA)


def objectives(records: DataFrame) -> DataFrame:
    """One row for each objective, with its position on the page and inside its category and strand."""
    x = records.select("url", "subject_slug", "grade_slug", F.posexplode("objectives").alias("ord", "o")).select("url", "subject_slug", "grade_slug", "ord", "o.*")
    return x.withColumn("position", F.row_number().over(Window.partitionBy("url", "category", "strand_name").orderBy("ord")))


def documents(records: DataFrame) -> DataFrame:
    return records.select("url", F.posexplode("documents").alias("ord", "d")).select(F.col("url").alias("page_url"), "ord", "d.*")


def links(pages: DataFrame) -> DataFrame:
    """(page_url, path): distinct paths /curriculum/base/subject/grade that pages link to; courses are none. Inside the JVM."""
    href = F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"#?]*)'), F.lit(1)))
    x = pages.select(F.col("url").alias("page_url"), href.alias("href")).select("page_url", F.regexp_replace("href", r"^https?://[^/]*|/+$", "").alias("path"))
    p = F.split(F.regexp_replace("path", "^/", ""), "/")
    return x.where((F.size(p) == 4) & (p[0] == "curriculum") & (p[2] != "curso")).distinct()


def sectors(anchors: DataFrame, known: list[str]) -> DataFrame:
    """(slug, sector): links in document order under the last known heading; another heading ends it; the first place of a slug counts.

    anchors(pos, kind, value): kind heading or link, in the order of the document.
    """
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    label = F.when(F.col("kind") == "heading", F.when(F.col("value").isin(known), F.col("value")).otherwise(""))
    x = anchors.withColumn("sector", F.last(label, ignorenulls=True).over(w)).where("kind = 'link' AND sector <> ''")
    return x.withColumn("k", F.row_number().over(Window.partitionBy("doc", "value").orderBy("pos"))).where("k = 1").select("doc", F.col("value").alias("slug"), "sector")
