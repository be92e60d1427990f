"""HTML to text and fields: small parsers run in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

HIDDEN = {"script", "style", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Visible(HTMLParser):
    """Collects the visible strings; comments and hidden elements are dropped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts, self.run = 0, [], []

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.hidden += tag in HIDDEN

    def handle_endtag(self, tag):
        self.flush()
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1

    def handle_comment(self, data):
        self.flush()

    def handle_data(self, data):
        if not self.hidden:
            self.run.append(data)

    def flush(self):
        text = "".join(self.run).strip()
        self.run = []
        if text:
            self.parts.append(text + "\n")


def _visible(html: str | None) -> str:
    parser = _Visible()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return "".join(parser.parts)


@F.pandas_udf(T.StringType())
def visible_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Every stripped visible string followed by a line feed."""
    for html in batches:
        yield html.map(_visible)


class _ByClass(HTMLParser):
    """Text of the elements whose class attribute equals a wanted one, and of the links inside."""

    def __init__(self, wanted: set[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.open, self.found, self.links = wanted, [], {w: [] for w in wanted}, {w: [] for w in wanted}

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        name = dict(attrs).get("class") or ""
        hit = name if name in self.wanted else None
        if hit:
            self.found[hit].append("")
        self.open.append((tag, hit))
        if tag == "a":
            for _, outer in self.open[:-1]:
                if outer:
                    self.links[outer].append("")

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        in_link = any(tag == "a" for tag, _ in self.open)
        for _, hit in self.open:
            if hit:
                self.found[hit][-1] += data
                if in_link and self.links[hit]:
                    self.links[hit][-1] += data


def class_fields(html: Column, classes: dict[str, str], links_of: tuple[str, ...] = ()) -> Column:
    """Struct of field -> text of the last element with that class.

    Fields in ``links_of`` take the link texts inside, joined by ``;``.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in classes])

    @F.pandas_udf(schema)
    def fields(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page in batch:
                parser = _ByClass(set(classes.values()))
                parser.feed(page or "")
                parser.close()
                row = {}
                for field, name in classes.items():
                    texts = parser.links[name] if field in links_of else parser.found[name][-1:]
                    row[field] = ";".join(texts) if texts else None
                rows.append(row)
            yield pd.DataFrame(rows, columns=list(classes))

    return fields(html)


def tag_texts(html: Column, tag: str) -> Column:
    """Texts of simple elements (no child elements), without Python."""
    return F.regexp_extract_all(html, F.lit(f"<{tag}[^>]*>([^<]*)</{tag}>"), 1)


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'), 1)


def markdown_links(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]\(([^)]+)\)"), 1)


def stripped(html: Column) -> Column:
    """Tags to blanks, blanks squeezed."""
    bare = F.regexp_replace(html, "<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, "[ \t\n\r\f]+", " "))


def heading_chunks(html: Column) -> Column:
    """Chunks that begin at every ``h1``..``h6``; what comes before the first is dropped."""
    parts = F.split(F.regexp_replace(html, "<h([1-6])", "\u0001<h$1"), "\u0001")
    return F.filter(parts, lambda p: p.rlike("^<h[1-6]"))


def layout_blocks(html: Column) -> Column:
    """Headings and paragraphs as ``array<struct<title, content>>``."""
    parts = F.regexp_extract_all(html, F.lit(r"(?s)(<(?:h[1-6]|p)>.*?</(?:h[1-6]|p)>)"), 1)
    return F.transform(parts, lambda p: F.struct(p.rlike("^<h").alias("title"), stripped(p).alias("content")))
