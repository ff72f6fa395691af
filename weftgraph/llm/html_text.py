"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a binary variable (content or not). Its features give a
local potential, and each parent-child edge a coupling potential. Sum-product
messages go upward from the leaves and downward from the root; a block's text is
kept if the marginal of its element favours content. The weights are fitted by
gradient ascent on the likelihood of labelled pages, with the same messages.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extended, map_batches, table
from .labelled_pages import LAYOUTS, drawn_page

BLOCKS = frozenset(
    "html head body article section main aside nav header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption form fieldset legend address details summary dialog menu hr center hgroup search label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never shown as text of the page.
SKIPPED = frozenset("script style title noscript template iframe textarea select button svg math object video audio canvas datalist".split())
#: A start tag (key) ends open elements of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "body": {"head"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "body": set()}
NO_P = BLOCKS - {"html", "head", "body", "label"}

_TAG = re.compile(r"<(?:!--(?:.*?--!?>|.*)|[!?][^>]*+>?|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|$))", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop|type)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?", re.I)
#: The attribute that labels main text in a training page, and what a sentence ends with.
MARK = "data-main"
ENDS = tuple(".!?…:\"”»’)]。")
_WORD = re.compile(r"[a-z]+")
_END = {tag: re.compile(rf"</{tag}\b[^>]*+>?", re.I) for tag in SKIPPED}


class Page:
    """Block elements in document order (a parent before its children) and blocks of text."""

    def __init__(self, html: str):
        self.parent: list[int] = [-1]
        self.features: list[list[str]] = [["root"]]
        self.marked: list[bool] = [False]  # the labels of a labelled page
        self.words: list[int] = [0]
        self.linked: list[int] = [0]
        self.ended: list[int] = [0]  # texts that end like a sentence
        self.texts: list[int] = [0]
        self.blocks: list[tuple[int, str]] = []
        self._parse(html)

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]  # inline elements carry their block's number
        text: list[str] = []
        in_links = 0
        at = 0

        def flush() -> None:
            if text:
                plain = " ".join(references.unescape("".join(text)).split())
                text.clear()
                if plain:
                    node = stack[-1][1]
                    self.blocks.append((node, plain))
                    n = plain.count(" ") + 1
                    self.words[node] += n
                    self.linked[node] += n if in_links else 0
                    self.texts[node] += 1
                    self.ended[node] += plain.endswith(ENDS)

        def close(depth: int) -> None:
            nonlocal in_links
            flush()
            in_links -= sum(tag == "a" for tag, _ in stack[depth:])
            del stack[depth:]

        while match := _TAG.search(html, at):
            if match.start() > at:
                text.append(html[at : match.start()])
            at = match.end()
            end, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if tag == "br":
                text.append(" ")
            elif end:
                block = tag in BLOCKS
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        if block:
                            close(depth)
                        else:
                            if tag == "a":
                                if in_links == 1:
                                    self._count_link(stack[-1][1], text)
                                in_links -= 1
                            del stack[depth]
                        break
                    if not block and stack[depth][0] in BLOCKS:
                        break
                else:
                    if block:
                        flush()
            elif tag in SKIPPED:
                if not attributes.endswith("/") or tag in ("script", "style"):
                    found = _END[tag].search(html, at)
                    at = found.end() if found else len(html)
                if tag not in ("button", "svg", "math", "canvas"):
                    text.append(" ") if text else None
            elif tag in BLOCKS:
                flush()
                if tag in NO_P:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == "p":
                            close(depth)
                            break
                        if stack[depth][0] in BLOCKS:
                            break
                if closed := CLOSES.get(tag):
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] in closed:
                            close(depth)
                        elif stack[depth][0] in SCOPES[tag]:
                            break
                self._open(tag, attributes, stack)
            elif tag not in VOID and not attributes.endswith("/"):
                stack.append((tag, stack[-1][1]))
                if tag == "a":
                    if not in_links:
                        self._before = sum(len(t.split()) for t in text)
                    in_links += 1
        if at < len(html):
            text.append(html[at:])
        flush()

    _before = 0

    def _count_link(self, node: int, text: list[str]) -> None:
        self.linked[node] += max(0, sum(len(t.split()) for t in text) - self._before)

    def _open(self, tag: str, attributes: str, stack: list[tuple[str, int]]) -> None:
        found = [f"tag {tag}"]
        if attributes:
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), (a or b or c).lower()
                if name in ("class", "id", "role", "itemprop"):
                    found += [f"word {w}" for w in _WORD.findall(value)]
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                    found.append("hidden")
        self.parent.append(stack[-1][1])
        self.features.append(found)
        self.marked.append(MARK in attributes)
        for counts in (self.words, self.linked, self.ended, self.texts):
            counts.append(0)
        if tag != "hr":
            stack.append((tag, len(self.parent) - 1))

    def finish(self) -> None:
        """Features that need the whole page: length and end of own text, share of links and of the page's words below, kind of parent."""
        words, linked, ended, texts = self.words[:], self.linked[:], self.ended[:], self.texts[:]
        for i in range(len(words) - 1, 0, -1):
            p = self.parent[i]
            words[p] += words[i]
            linked[p] += linked[i]
            ended[p] += ended[i]
            texts[p] += texts[i]
        kinds = [found[0] for found in self.features]
        for i, found in enumerate(self.features):
            if i:
                found.append(f"{kinds[i]} in {kinds[self.parent[i]]}")
            found.append(f"own {min(4, self.words[i].bit_length() // 2)}")
            if self.texts[i]:
                found.append(f"own ends {2 * self.ended[i] // self.texts[i]}")
            if words[i]:
                found.append(f"links {4 * linked[i] // words[i]}")
                found.append(f"all {min(4, words[i].bit_length() // 2)}")
                found.append(f"share {4 * words[i] // words[0]}")
                found.append(f"ends {3 * ended[i] // texts[i]}")
            else:
                found.append("no text")


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-x)) if x >= 0 else (e := math.exp(max(x, -700.0))) / (1.0 + e)


def marginals(page: Page, unary: dict[str, float], edge: tuple[float, float, float, float]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """P(content) of each element, and of each edge the joint of (parent, child) as 00, 01, 10, 11.

    Messages are kept as log-odds, so an element may have any number of children.
    """
    n = len(page.parent)
    parent = page.parent
    e00, e01, e10, e11 = map(math.exp, edge)
    up = [sum([unary.get(f, 0.0) for f in found]) for found in page.features]  # of each element given what is below
    sent = [0.0] * n  # the message to the parent
    below = [0.0] * n
    for i in range(n - 1, 0, -1):
        b = below[i] = _sigmoid(up[i])
        sent[i] = math.log((e10 * (1.0 - b) + e11 * b) / (e00 * (1.0 - b) + e01 * b))
        up[parent[i]] += sent[i]
    belief = up[:1] * n
    content = [0.0] * n
    joint = [(0.0, 0.0, 0.0, 0.0)] * n
    content[0] = _sigmoid(up[0])
    for i in range(1, n):
        above = _sigmoid(belief[parent[i]] - sent[i])  # of the parent without this child
        b = below[i]
        j00, j01, j10, j11 = (1.0 - above) * e00 * (1.0 - b), (1.0 - above) * e01 * b, above * e10 * (1.0 - b), above * e11 * b
        z = j00 + j01 + j10 + j11
        joint[i] = (j00 / z, j01 / z, j10 / z, j11 / z)
        belief[i] = up[i] + math.log((e01 * (1.0 - above) + e11 * above) / (e00 * (1.0 - above) + e10 * above))
        content[i] = _sigmoid(belief[i])
    return content, joint


def main_text(html: str | None, model: tuple[dict[str, float], tuple]) -> str:
    """The main text: kept blocks in page order, two line ends between them."""
    if not html:
        return ""
    page = Page(html)
    page.finish()
    content, _ = marginals(page, *model)
    return "\n\n".join(text for node, text in page.blocks if content[node] > 0.5)


def train(pages: list[str], rounds: int = 60, rate: float = 0.5, shrink: float = 0.003) -> tuple[dict[str, float], tuple]:
    """Fit local and edge weights to labelled pages: those whose main text stands in elements marked ``data-main``.

    An element is content if it is marked or holds content below; an element
    without text takes the label of its parent.
    """
    prepared = []
    for html in pages:
        page = Page(html)
        page.finish()
        label = [int(m) for m in page.marked]
        seen = [int(bool(t)) for t in page.texts]
        for i in range(len(label) - 1, 0, -1):
            label[page.parent[i]] |= label[i]
            seen[page.parent[i]] |= seen[i]
        for i in range(1, len(label)):
            if not seen[i]:
                label[i] = label[page.parent[i]]
        prepared.append((page, label))
    unary: dict[str, float] = {}
    edge = [0.0, 0.0, 0.0, 0.0]
    squares: dict[object, float] = {}
    for _ in range(rounds):
        gradient: dict[object, float] = {}
        for page, label in prepared:
            content, joint = marginals(page, unary, tuple(edge))
            for i, found in enumerate(page.features):
                miss = label[i] - content[i]
                if abs(miss) > 1e-4:
                    for f in found:
                        gradient[f] = gradient.get(f, 0.0) + miss
                if i:
                    k = 2 * label[page.parent[i]] + label[i]
                    for c in range(4):
                        gradient[c] = gradient.get(c, 0.0) + (c == k) - joint[i][c]
        for f, g in gradient.items():
            g = g / len(prepared) - shrink * (edge[f] if isinstance(f, int) else unary.get(f, 0.0))
            squares[f] = squares.get(f, 0.0) + g * g
            step = rate * g / (math.sqrt(squares[f]) + 1e-9)
            if isinstance(f, int):
                edge[f] = max(-8.0, min(8.0, edge[f] + step))
            else:
                unary[f] = unary.get(f, 0.0) + step
    return unary, tuple(edge)


TRAINING_PAGES = 12 * len(LAYOUTS)


def trained_model(pages: int = TRAINING_PAGES) -> tuple[dict[str, float], tuple]:
    """The model fitted to pages drawn from the labelled layouts."""
    return train([drawn_page(seed) for seed in range(pages)])


def extract(df: DataFrame, model: tuple[dict[str, float], tuple], html_column: str = "html") -> DataFrame:
    """Add ``main_text`` to every row.

    Null or empty html, and a page without a content block, give an empty text.
    Pages may be of any length, depth and number of blocks. A block is content
    if its marginal is above one half, so a tie is none. Repeated rows stay
    repeated; equal pages have equal texts. A column named ``main_text`` is
    replaced, all others stay.
    """
    df = df.drop("main_text")
    held = df.sparkSession.sparkContext.broadcast(model)
    schema = extended(df.schema, main_text=T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(x, held.value) for x in batch[html_column].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], schema.names)

    return map_batches(df, run, schema)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), trained_model())
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


QUERIES = {"op9_html_text": op9_html_text}
ORACLE_SQL: dict[str, str] = {}
