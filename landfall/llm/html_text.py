"""Main text of web pages by consensus paths of their hosts.

Every page's containers are scored; the best one votes, with its generalised
tag-class path, for its host. Spark counts the votes; each page is then read
again at the path that won its host. A page without that path, or without
text there, uses its own best container.

Page furniture goes by tag, role or name. Inside an article only a whole name of
furniture counts (``share-buttons``, not ``share-prices``); a block whose name
merely holds such a word goes if at least half of its text are links.

A block is the text of one block element (paragraph, heading, list item,
table row, ...) or the text between two of them; white space runs, ``<br>``
and cell borders become one space.

Defined cases: null, empty and text-free pages have no text (empty string);
a null or odd url has its own host name (empty or what stands there); tags
that are not closed end with their parent; page rows that repeat are separate
pages with equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

# Tags are scanned once; quotes protect ">" in attribute values. No repeat can backtrack.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/<>]*+)(?P<attrs2>[^<>]*+)>""", re.S | re.X)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "select", "svg", "title", "object", "canvas"}
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in _RAW}
_VOID = {"br", "hr", "img", "meta", "link", "input", "source", "wbr", "area", "base", "col", "embed", "track", "param"}
_BLOCK = set("html body div section article main nav aside header footer form ul ol li dl dt dd table thead tbody "
             "tfoot tr caption p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address fieldset details summary "
             "center menu dialog hgroup search head button".split())
_TEXT_BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "blockquote", "pre", "caption",
               "figcaption", "summary", "address"}
_DROP = {"nav", "aside", "footer", "form", "menu", "dialog", "search", "head", "button"}
_DROP_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
# Names of page furniture; a name may have several words.
_FURNITURE = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription sidebar side "
    "menu nav navbar navigation breadcrumb breadcrumbs masthead topbar toolbar footer foot comment comments commentlist disqus "
    "respond replies social share sharing related recommended recommendations widget widgets login signup search pager "
    "pagination skip".split())
# Words that leave a name of furniture what it is, inside an article as well.
_NEUTRAL = set(
    "area articles bar bars block body box button buttons card content container count form group head header heading icon icons "
    "inner item items label left link links list main message more news outer panel post posts right row rows section slot "
    "stories text title top unit wrap wrapper page site thread".split())
_DROP_NAME = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(sorted(_FURNITURE))})(?:$|[\s_\d-])", re.I)
_HEADER_NAME = re.compile(r"(?:^|\s)(?:(?:site|page|main|global|top)[_-])?header(?:$|\s|[_\d-])", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|respond|replies|reply)(?:$|[\s_-])", re.I)
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",)}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}}
_INNER = {"div", "section", "article", "main", "table"}  # an implied end tag does not leave these
DENSE = 0.5  # share of link text from which a block of an article with a doubtful name is furniture


def _label(tag: str, classes: str) -> str:
    """Tag and classes with digits generalised: ``div.post-#``."""
    names = sorted({re.sub(r"\d+", "#", c.lower()) for c in classes.split()})
    return ".".join([tag, *names])


class _Node:
    __slots__ = ("tag", "path", "parent", "dropped", "doubtful", "in_article", "text", "links", "at", "last")

    def __init__(self, tag, path, parent, dropped, in_article, at, doubtful=False):
        self.tag, self.path, self.parent = tag, path, parent
        self.dropped, self.in_article, self.doubtful = dropped, in_article, doubtful
        self.text = self.links = 0  # with what is inside, once the page is read
        self.at = self.last = at    # place in page order, and that of the last node inside


def _path(parent: str, label: str) -> str:
    """A container's path as a digest, of equal length at any depth."""
    return hashlib.blake2b(f"{parent}/{label}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def _is_furniture(names: str) -> bool:
    """Whether a whole class or id is a name of furniture, like ``share`` or
    ``share-buttons`` but not ``share-prices``."""
    for name in names.lower().split():
        words = [w for w in re.split(r"[\W\d_]+", name) if w]
        if any(w in _FURNITURE for w in words) and all(w in _FURNITURE or w in _NEUTRAL for w in words):
            return True
    return False


def _is_dropped(tag: str, attrs: dict[str, str], parent: _Node) -> tuple[bool, bool]:
    """(whether an element is page furniture, whether that is doubtful until its
    links are known)."""
    if tag in _DROP or (tag == "header" and not parent.in_article):
        return True, False
    if attrs.get("role", "").lower() in _DROP_ROLE and tag not in ("body", "main"):
        return True, False
    names = _HUMP.sub("-", f"{attrs.get('class', '')} {attrs.get('id', '')}")
    if tag in ("html", "body", "main") or names == " ":
        return False, False
    if not parent.in_article and _HEADER_NAME.search(names):
        return True, False
    if tag == "article":
        return bool(_COMMENTS.search(names)), False
    found = bool(_DROP_NAME.search(names))
    if found and parent.in_article and not _is_furniture(names):
        return False, True
    return found, False


def parse(html: str) -> tuple[list[_Node], list[tuple[_Node, str]]]:
    """(nodes, blocks) in page order; blocks are (node, text) without what
    belongs to menus, adverts and the like."""
    root = _Node("body", "", None, False, False, 0)
    stack, nodes, blocks = [root], [root], []
    opened = Counter()      # open elements by tag: an end tag of none is not looked for
    pieces: list[str] = []
    link_from = -1          # number of pieces when a link opened
    links = 0
    hidden: list[str] = []  # open inline elements of a dropped kind

    def flush():
        nonlocal links, link_from
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text and not stack[-1].dropped:
                blocks.append((stack[-1], text, min(links, len(text))))
                stack[-1].text += len(text)
                stack[-1].links += blocks[-1][2]
        pieces.clear()
        links = 0
        link_from = -1

    def add(text):
        nonlocal links
        if text and not hidden and not stack[-1].dropped:
            pieces.append(text)
            if link_from >= 0:
                links += len(text.strip())

    def leave(i):
        opened.subtract(node.tag for node in stack[i:])
        del stack[i:]

    def close(tag, scope=()):
        if not opened[tag]:
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                flush()
                leave(i)
                return
            if stack[i].tag in scope:
                return

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        if m["cdata"] is not None:
            add(m["cdata"].replace("&", "&amp;"))
        name = m["name"] or m["name2"]
        if name is None:
            continue
        tag, ending = name.lower(), bool(m["end"] or m["end2"])
        if ending:
            if hidden and tag == hidden[-1]:
                hidden.pop()
            elif tag == "a":
                link_from = -1
            elif tag in ("td", "th"):
                add(" ")
            elif tag in _BLOCK and tag not in ("html", "body"):
                close(tag)
            continue
        text_attrs = m["attrs"] or m["attrs2"] or ""
        if tag in _RAW:
            if not text_attrs.endswith("/"):
                end = _RAW_END[tag].search(html, at)
                at = n if end is None else end.start()
            continue
        if tag == "br" or tag in ("td", "th"):
            add(" ")
        elif tag == "hr":
            flush()
        if tag in _VOID or tag in ("html", "body", "td", "th"):
            continue
        if tag == "a":
            link_from = len(pieces)
        attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(text_attrs)} if text_attrs else {}
        if tag not in _BLOCK:
            if attrs and _is_dropped(tag, attrs, stack[-1])[0] and not text_attrs.endswith("/"):
                hidden.append(tag)
            continue
        hidden.clear()
        flush()
        if stack[-1].tag == "p":
            leave(len(stack) - 1)
        for other in _CLOSES.get(tag, ()):
            close(other, _SCOPE[tag] | _INNER)
        parent = stack[-1]
        path = parent.path if tag in _TEXT_BLOCK else _path(parent.path, _label(tag, attrs.get("class", "")))
        dropped, doubtful = _is_dropped(tag, attrs, parent)
        stack.append(_Node(tag, path, parent, parent.dropped or dropped, parent.in_article or tag in ("article", "main"),
                           len(nodes), doubtful))
        opened[tag] += 1
        nodes.append(stack[-1])
    flush()
    _sum_up(nodes)
    dense = [n for n in nodes if n.doubtful and not n.dropped and n.text and n.links >= DENSE * n.text]
    if dense:
        for node in dense:
            node.dropped = True
        for node in nodes[1:]:
            node.dropped = node.dropped or node.parent.dropped
            node.text = node.links = 0
        root.text = root.links = 0
        blocks = [(node, text, linked) for node, text, linked in blocks if not node.dropped]
        for node, text, linked in blocks:
            node.text += len(text)
            node.links += linked
        _sum_up(nodes)
    return nodes, [(node, text) for node, text, _ in blocks]


def _sum_up(nodes: list[_Node]) -> None:
    """Text and link lengths of what is inside, and the last place inside."""
    for node in reversed(nodes[1:]):
        node.parent.text += node.text
        node.parent.links += node.links
        node.parent.last = max(node.parent.last, node.last)


def best_container(nodes: list[_Node]) -> _Node | None:
    """The container that most likely is the article: clean text (links count
    against it), articles first, and the innermost of containers that hold
    nearly the same text."""
    best, best_score = None, 0.0
    for node in nodes:
        if node.dropped or not node.text or node.tag in _TEXT_BLOCK:
            continue
        score = (node.text - 2 * node.links) * (2.0 if node.tag in ("article", "main") else 1.0)
        # an inner container that keeps 90 % of the best one's score replaces it
        inner = best is not None and best.at < node.at <= best.last
        if best is None or score > best_score or (inner and score >= 0.9 * best_score):
            best, best_score = node, max(score, 0.0)
    return best


def text_at(nodes: list[_Node], blocks: list[tuple[_Node, str]], path: str) -> str:
    """The blocks inside containers with this path, in page order."""
    inside = [False] * len(nodes)
    for node in nodes:
        inside[node.at] = ((node.path == path and node.tag not in _TEXT_BLOCK)
                           or (node.parent is not None and inside[node.parent.at]))
    return "\n\n".join(text for node, text in blocks if inside[node.at])


def best_path(html: str) -> tuple[str, float] | None:
    nodes, _ = parse(html)
    best = best_container(nodes)
    return None if best is None else (best.path, float(best.text))


def extract(html: str, path: str | None) -> str:
    """Text at the host's path, else at the page's own best container."""
    nodes, blocks = parse(html)
    text = text_at(nodes, blocks, path) if path is not None else ""
    if not text:
        best = best_container(nodes)
        text = text_at(nodes, blocks, best.path) if best is not None else ""
    return text


def _decoded(raw):
    return (raw.as_py() or b"").decode("utf-8", "replace")


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score) of each page's best container."""
    def run(batches):
        for b in batches:
            rows = []
            for host, raw in zip(b.column(0), b.column(1), strict=True):
                best = best_path(_decoded(raw))
                if best is not None:
                    rows.append((host.as_py(), *best))
            out = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                                   pa.array(out[2], pa.float64())], names=["host", "path", "score"])

    return pages.select("host", F.col("html").cast("binary")).mapInArrow(run, "host string, path string, score double")


def host_of(url):
    """Lower-case host of a url ('' if null; what stands there if there is no //)."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?(?://)?([^/?#]*)", 1))


def host_paths(scratch: Scratch, pages: DataFrame) -> DataFrame:
    """(v_host, path): the path with most votes of each host; ties go to more
    text, then to the smaller path."""
    counted = votes(pages).groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    ranked = counted.groupBy(F.col("host").alias("v_host")).agg(
        F.min_by("path", F.struct(-F.col("n"), -F.col("score"), "path")).alias("path"))
    return scratch.keep(ranked, "host-paths")


def main_text(spark, pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches):
        for b in batches:
            texts = [extract(_decoded(raw), path.as_py()) for raw, path in zip(b.column(2), b.column(3), strict=True)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType),
                           T.StructField("url", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    with Scratch(spark, "html-text") as scratch:
        pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
        winners = host_paths(scratch, pages)
        joined = pages.join(winners, F.col("host") == F.col("v_host"), "left").select(
            "page_id", "url", F.col("html").cast("binary").alias("html"), "path")
        return scratch.keep(joined.mapInArrow(run, schema), "result", result=True)
