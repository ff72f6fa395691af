"""Element pages, listings and HTML-to-Markdown, parsed in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import element_id

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    parent: "Node | None" = None

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                stack.extend(reversed(item.children))
        return "".join(out)

    def next_element(self) -> "Node | None":
        siblings = [c for c in self.parent.children if isinstance(c, Node)] if self.parent else []
        at = next((i for i, c in enumerate(siblings) if c is self), -1)
        return siblings[at + 1] if 0 <= at < len(siblings) - 1 else None

    def inner_html(self) -> str:
        return "".join(_outer(c) for c in self.children)


def _outer(item) -> str:
    if isinstance(item, str):
        return item.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    attrs = "".join(f' {k}="{v.replace(chr(34), "&quot;")}"' for k, v in item.attrs.items())
    return f"<{item.tag}{attrs}>" if item.tag in VOID else f"<{item.tag}{attrs}>{item.inner_html()}</{item.tag}>"


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, parent=self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, parent=self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse_html(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"([\w-]+)|#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([*~^]?=)['\"]?([^'\"\]]*)['\"]?)?\]")


def _matches(node: Node, compound: str) -> bool:
    for tag, by_id, cls, name, op, value in _SIMPLE.findall(compound):
        have = node.attrs.get(name) if name else None
        if tag and node.tag != tag or by_id and node.attrs.get("id") != by_id or cls and cls not in node.attrs.get("class", "").split():
            return False
        if name and (have is None or op == "=" and have != value or op == "*=" and value not in have or op == "^=" and not have.startswith(value) or op == "~=" and value not in have.split()):
            return False
    return True


def select(root: Node, selector: str) -> list[Node]:
    """Elements in document order for a selector of compounds joined by descendant spaces."""
    compounds = re.findall(r"(?:[^\s\[]|\[[^\]]*\])+", selector)
    out = []
    for node in root.walk():
        if not _matches(node, compounds[-1]) or node is root:
            continue
        above, rest = node.parent, compounds[:-1]
        while rest and above:
            if _matches(above, rest[-1]) and above.tag:
                rest = rest[:-1]
            above = above.parent
        if not rest:
            out.append(node)
    return out


@dataclass(frozen=True)
class Layout:
    """Where a kind of site keeps the parts of an element page."""

    source: str
    title: str
    body: str
    listing: str
    listing_holds: str | None = None
    categories: str | None = None
    post_tags: str | None = None
    modified: str | None = None
    sidebar: bool = False
    excluded_categories: tuple[str, ...] = ()
    categories_are_tags: bool = False
    license: tuple[str, str, str] = ("", "", "")


#: The three page layouts with their licences.
CARD_WIKI = Layout("cardwiki", "h1.font-comic", ".article-content", "main a[href*='/wiki/']", listing_holds="h3", sidebar=True, license=("CC BY-SA 3.0 DE", "CC-BY-SA-3.0-DE", "https://creativecommons.org/licenses/by-sa/3.0/de/"))
BLOG = Layout("blog", "h1.entry-title", ".entry-content", "ul.lcp_catlist a", categories="footer.entry-meta a[rel='category tag']", post_tags="footer.entry-meta a[rel='tag']", license=("CC BY-SA 4.0 International", "CC-BY-SA-4.0", "https://creativecommons.org/licenses/by-sa/4.0/"))
MEDIA_WIKI = Layout("mediawiki", "#firstHeading", "#mw-content-text", "#mw-pages a", categories="#catlinks #mw-normal-catlinks ul li a", modified="#footer li#lastmod", excluded_categories=("All",), categories_are_tags=True, license=("GNU Free Documentation License 1.2", "GFDL-1.2", "https://www.gnu.org/copyleft/fdl.html"))

_STRINGS = T.ArrayType(T.StringType())
_PAGE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("name", "languageCode", "htmlContent", "lastUpdate", "lastModifiedText", "translationLinkEn", "translationLinkDe")]
    + [T.StructField(c, _STRINGS) for c in ("links", "tags", "categories", "postTags")]
    + [T.StructField("card", T.MapType(T.StringType(), T.StringType()))]
)


def _absolute(base: str, href: str) -> str | None:
    try:
        return urljoin(base, href)
    except ValueError:
        return None


def _texts(root: Node, selector: str | None) -> list[str]:
    return [n.text().strip() for n in select(root, selector)] if selector else []


def extract_page(html: str | None, url: str | None, layout: Layout) -> dict | None:
    """The fields of an element page; None without a title. Links are made absolute, the body's own HTML is left as it is."""
    root, url = parse_html(html), url or ""
    titles = select(root, layout.title)
    title = titles[0].text().strip() if titles else ""
    if not title:
        return None
    name = title if layout.source == "mediawiki" else title.replace("#", "").strip()
    language = ("en" if "/en/" in url else "de") if layout.sidebar else "en"
    body = select(root, layout.body)
    out = dict.fromkeys(f.name for f in _PAGE.fields)
    out |= {"name": name, "languageCode": language, "htmlContent": body[0].inner_html() if body else "", "tags": [], "card": []}
    out["links"] = [u for n in (body[0].walk() if body else ()) if n.tag == "a" and n.attrs.get("href") and (u := _absolute(url, n.attrs["href"]))]
    out["categories"] = [c for c in _texts(root, layout.categories) if c and c not in layout.excluded_categories]
    out["postTags"] = _texts(root, layout.post_tags)
    if layout.categories_are_tags:
        out["tags"] = out["categories"]
    out["lastModifiedText"] = next(iter(_texts(root, layout.modified)), None)
    if layout.sidebar:
        heading = "Categories" if language == "en" else "Kategorien"
        edited = "Last edited" if language == "en" else "Zuletzt bearbeitet"
        at = next((n for n in root.walk() if n.tag == "h3" and heading in n.text()), None)
        if at is not None:
            beside = at.next_element()
            out["tags"] = list(dict.fromkeys(n.text().strip() for n in (beside.walk() if beside else ()) if n.tag == "a"))
            for h3 in (n for n in at.parent.walk() if n.tag == "h3"):
                key, value = h3.text().strip(), h3.next_element()
                if key not in ("Kategorien", "Categories") and value is not None:
                    link = next((n for n in value.walk() if n.tag == "a"), None)
                    text = value.text().strip() if value.tag in ("p", "div") else (link.text().strip() if link else "") or value.text().strip()
                    out["card"].append(("card_" + key.replace(" of ", " ", 1), text))
        note = next((n.text() for n in root.walk() if n.tag == "p" and edited in n.text()), "")
        found = re.search(r"\d{2}\.\d{2}\.\d{4}", note)
        out["lastUpdate"] = found.group() if found else ""
        for lang in ("En", "De"):
            link = next((n.attrs.get("href") for n in select(root, f"link[rel='alternate'][hreflang='{lang.lower()}']")), None)
            out[f"translationLink{lang}"] = link if link and link != url else None
    out["card"] = list(dict(out["card"]).items())
    return out


def _arrow(schema: T.StructType) -> pa.StructType:
    kinds = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "map<string,string>": pa.map_(pa.string(), pa.string())}
    return pa.struct([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def extract_pages(pages: DataFrame, layout: Layout, add_tags: tuple[str, ...] = ()) -> DataFrame:
    """Raw elements of pages (url, html); pages without a title drop. Added tags come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _arrow(_PAGE)
        for batch in batches:
            found = [extract_page(h, u, layout) for h, u in zip(batch["html"].to_pylist(), batch["url"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["url"], pa.array(found, kind)], ["url", "page"])

    rows = pages.select("url", "html").mapInArrow(run, T.StructType([T.StructField("url", T.StringType()), T.StructField("page", _PAGE)]))
    name, spdx, link = layout.license
    out = rows.where("page IS NOT NULL").select("url", "page.*")
    added = F.array(*map(F.lit, add_tags)).cast("array<string>")
    return out.withColumn("tags", F.concat(added, "tags")).withColumns({"identifier": element_id(F.col("name"), F.col("url")), "sourceName": F.lit(layout.source), "licenseName": F.lit(name), "licenseSpdxIdentifier": F.lit(spdx), "licenseUrl": F.lit(link)})


def listing_links(pages: DataFrame, layout: Layout, per_listing: int | None = None) -> DataFrame:
    """``(listing, ord, link)``: absolute links to element pages that listings name, at most ``per_listing`` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(batch["url"].to_pylist(), batch["html"].to_pylist()):
                at = [n for n in select(parse_html(html), layout.listing) if n.attrs.get("href") and (not layout.listing_holds or any(c.tag == layout.listing_holds for c in n.walk()))]
                rows += [(url, i, u) for i, n in enumerate(at) if (u := _absolute(url or "", n.attrs["href"]))][:per_listing]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["listing", "ord", "link"])

    return pages.select("url", "html").mapInArrow(run, "listing string, ord long, link string")


_HEADINGS = {f"h{n}": "#" * n for n in range(1, 7)}


def to_markdown(html: str | None) -> str:
    """Markdown of a page body: ATX headings, lists, emphasis, links, code, quotes and rules."""

    def render(item, depth: int = 0) -> str:
        if isinstance(item, str):
            return re.sub(r"\s+", " ", item)
        inner = "".join(render(c, depth + (item.tag in ("ul", "ol"))) for c in item.children)
        tag = item.tag
        if tag in _HEADINGS:
            return f"\n\n{_HEADINGS[tag]} {inner.strip()}\n\n"
        if tag in ("p", "div", "section", "article", "table", "tr"):
            return f"\n\n{inner.strip()}\n\n"
        if tag in ("strong", "b") and inner.strip():
            return f"**{inner.strip()}**"
        if tag in ("em", "i") and inner.strip():
            return f"_{inner.strip()}_"
        if tag == "code":
            return f"`{inner}`"
        if tag == "a" and item.attrs.get("href"):
            return f"[{inner}]({item.attrs['href']})"
        if tag == "img" and item.attrs.get("src"):
            return f"![{item.attrs.get('alt', '')}]({item.attrs['src']})"
        if tag == "br":
            return "  \n"
        if tag == "hr":
            return "\n\n* * *\n\n"
        if tag in ("ul", "ol"):
            lines, n = [], 0
            for c in item.children:
                if isinstance(c, Node) and c.tag == "li":
                    n += 1
                    text = "".join(render(x, depth + 1) for x in c.children).strip().replace("\n", "\n    ")
                    lines.append(("*   " if tag == "ul" else f"{n}.  ") + text)
            return "\n\n" + "\n".join(lines) + "\n\n"
        if tag == "blockquote":
            return "\n\n" + "\n".join("> " + x for x in inner.strip().split("\n")) + "\n\n"
        if tag == "pre":
            return f"\n\n```\n{item.text().strip(chr(10))}\n```\n\n"
        return "" if tag in ("script", "style") else inner

    return re.sub(r"\n(?:[ \t]*\n){2,}|\n[ \t]+\n", "\n\n", render(parse_html(html))).strip()


def add_markdown(df: DataFrame, html: str = "htmlContent", column: str = "markdown") -> DataFrame:
    """Add the Markdown of an HTML column; equivalent to, not byte-equal with, other converters."""

    @F.pandas_udf(T.StringType())
    def convert(values):
        return values.map(to_markdown)

    return df.withColumn(column, convert(html))
