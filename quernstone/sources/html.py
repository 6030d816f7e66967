"""One tolerant pass over a page's HTML: signals, blocks, links and images as nested columns.

The parser is the standard library's; markup may be malformed. Pages travel to Python once, in Arrow
batches, and everything that later steps need comes back from that pass.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds of elements.
BLOCK_TAGS = {"section", "article", "div", "p", "li", "a", "h1", "h2", "h3", "h4", "span", "figcaption"}
NOISE_TAGS = {"script", "style", "nav", "header", "footer", "aside", "form", "noscript", "svg", "iframe"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4"}
SHORTEST, LONGEST = 12, 5000
#: Pages that are parsed at once.
PAGES = 64
LINK_ATTRIBUTES = ("href", "data-href", "data-url", "data-link", "data-path")
_SPACE = re.compile(r"\s+")
_ONCLICK = re.compile(r"""['"](/[^'"]+)['"]""")
_RAW = re.compile(r'"(?:href|url|as|canonical)"\s*:\s*"([^"#][^"]*)"')

BLOCK = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "tag", "href", "class", "id", "heading", "parent_tag", "parent_class", "parent_id", "link_text", "link_href")])
IMAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("src", "alt", "title")])
PARSED = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("h1", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("blocks", T.ArrayType(BLOCK)), T.StructField("links", T.ArrayType(T.StringType())), T.StructField("images", T.ArrayType(IMAGE)),
    T.StructField("json_ld", T.ArrayType(T.StringType())),
])


def slices(batches, rows: int):
    """Batches in slices, since a batch of pages makes many Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def squeeze(text: str) -> str:
    return _SPACE.sub(" ", text).strip()


class _Element:
    """An element, as the range of the page's text pieces that it holds."""

    __slots__ = ("tag", "attrs", "heading", "parent", "link", "page", "start", "end")

    def __init__(self, tag, attrs, heading, parent, page):
        self.tag, self.attrs, self.heading, self.parent, self.page = tag, attrs, heading, parent, page
        self.start, self.end = len(page.pieces), None
        self.link = None

    def length(self) -> int:
        """The length of the text, without putting it together."""
        end = len(self.page.pieces) if self.end is None else self.end
        return max(0, self.page.upto[end] - self.page.upto[self.start] - 1)

    def text(self) -> str:
        return " ".join(self.page.pieces[self.start : self.end])


class PageParser(HTMLParser):
    """Collects elements as they close; an unclosed element ends with its parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: Pieces of text without surplus blanks, and their lengths added up, a blank behind each.
        self.pieces: list[str] = []
        self.upto = [0]
        self.open: list[_Element] = []
        self.done: list[_Element] = []
        self.muted: list[str] = []
        self.title: list[str] = []
        self.h1, self.lang, self.heading = "", "", ""
        self.links: list[str] = []
        self.images: list[dict] = []
        self.json_ld: list[str] = []
        self.in_title = self.in_json = False

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        if tag == "html":
            self.lang = attrs.get("lang", "")
        for name in LINK_ATTRIBUTES:
            if attrs.get(name) and tag not in ("link", "base"):
                self.links.append(attrs[name])
        self.links.extend(_ONCLICK.findall(attrs.get("onclick", "")))
        if tag == "img":
            src = attrs.get("src") or attrs.get("data-src") or attrs.get("data-lazy-src") or attrs.get("srcset", "").split(",")[0].split(" ")[0]
            if src:
                self.images.append({"src": src, "alt": attrs.get("alt", ""), "title": attrs.get("title", "")})
        if tag in NOISE_TAGS:
            self.in_json = tag == "script" and "ld+json" in attrs.get("type", "")
            if self.in_json:
                self.json_ld.append("")
            self.muted.append(tag)
        elif tag == "title":
            self.in_title = True
        elif tag in BLOCK_TAGS and not self.muted:
            element = _Element(tag, attrs, self.heading, self.open[-1] if self.open else None, self)
            self.open.append(element)
            if tag == "a":
                for outer in self.open:
                    outer.link = outer.link or element

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in NOISE_TAGS:
            if tag in self.muted:
                del self.muted[len(self.muted) - 1 - self.muted[::-1].index(tag) :]
            self.in_json = False
        elif tag == "title":
            self.in_title = False
        elif any(e.tag == tag for e in self.open):
            while self.open:
                element = self.open.pop()
                self._close(element)
                if element.tag == tag:
                    break

    def _close(self, element: _Element) -> None:
        element.end = len(self.pieces)
        if element.tag in HEADINGS:
            self.heading = element.text()
            if element.tag == "h1" and not self.h1:
                self.h1 = self.heading
        self.done.append(element)

    def handle_data(self, data):
        if self.in_json:
            self.json_ld[-1] += data
        elif self.in_title:
            self.title.append(data)
        elif not self.muted and (piece := squeeze(data)):
            self.pieces.append(piece)
            self.upto.append(self.upto[-1] + len(piece) + 1)

    def finish(self) -> None:
        self.close()
        while self.open:
            self._close(self.open.pop())


def parse(html: str | None, url: str | None) -> dict:
    """The parsed page; an empty one for null or empty markup."""
    page = PageParser()
    page.feed(html or "")
    page.finish()
    seen, blocks = set(), []
    for e in page.done:
        if not SHORTEST <= e.length() <= LONGEST or (text := e.text()).lower() in seen:
            continue
        seen.add(text.lower())
        up = e.parent.attrs if e.parent else {}
        blocks.append({
            "text": text, "tag": e.tag, "href": e.attrs.get("href"), "class": e.attrs.get("class", ""), "id": e.attrs.get("id"), "heading": e.heading,
            "parent_tag": e.parent.tag if e.parent else "", "parent_class": up.get("class", ""), "parent_id": up.get("id"),
            "link_text": e.link.text() if e.link else "", "link_href": e.link.attrs.get("href") if e.link else "",
        })
    links = []
    for link in [*page.links, *_RAW.findall(html or "")]:
        link = link.strip()
        if link and not link.startswith(("#", "mailto:", "tel:", "javascript:")):
            try:
                links.append(urljoin(url or "", link))
            except ValueError:
                continue
    return {"title": squeeze("".join(page.title)), "h1": page.h1, "lang": page.lang, "blocks": blocks, "links": list(dict.fromkeys(links)), "images": page.images, "json_ld": page.json_ld}


def parse_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The pages without their markup, and with title, h1, lang, blocks, links, images and json_ld."""
    kept = [f for f in pages.schema.fields if f.name != html and f.name not in PARSED.names]
    schema = T.StructType(kept + PARSED.fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(PARSED)

    def run(parts):
        for part in slices(parts, PAGES):
            get = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
            rows = [parse(h, u) for h, u in zip(get(html).to_pylist(), get(url).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([get(f.name) for f in kept] + [pa.array([r[f.name] for r in rows], f.type) for f in wanted], names=schema.names)

    return pages.mapInArrow(run, schema)


def blocks(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each block, in the order they closed, less noise."""
    from quernstone.operators.scoring import block_noise

    rows = parsed.select(*keys, F.posexplode("blocks").alias("pos", "block")).select(*keys, "pos", "block.*")
    attributes = F.concat_ws(" ", "class", "id")
    return rows.filter(~block_noise(F.col("text"), attributes))


def page_text(block_rows: DataFrame, keys: list[str]) -> DataFrame:
    """The text of a page's blocks, a line each, in order."""
    return block_rows.groupBy(*keys).agg(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])).alias("page_text"))
