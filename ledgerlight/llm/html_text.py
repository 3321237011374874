"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices

# Elements of HTML by how they take part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset(
    "script style noscript template iframe object svg math canvas audio video select textarea button datalist head title".split()
)
#: Silent elements that run to their end tag, whatever comes.
RAW = frozenset({"script", "style"})
#: Elements that may stand in a head; any other ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())
#: Elements around the article.
ASIDE = frozenset("nav header footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the set ends where one of the key begins.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that keep an end tag or a new item from ending what is open outside of them.
SCOPES = frozenset("ul ol dl table td th body html".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu sidebar "
    "footer header masthead comment comments disqus replies cookie cookies consent notice popup modal overlay newsletter subscribe "
    "subscription share sharing social related recommended breadcrumb breadcrumbs pagination pager widget login signup search "
    "copyright disclaimer".split()
)
#: Words that may stand beside a mark and say nothing else: a label of these and marks alone is sure.
PLACES = frozenset(
    "area bar block body bottom box button buttons center col column container content footer form group head header heading "
    "holder icon icons inline inner item items label left link links list main media menu module outer page panel post posts "
    "primary right row secondary section site slot small space stories sub text title toggle top unit wrap wrapper".split()
)
#: How sure it is that an element is not part of the article.
NOT_MARKED, PERHAPS, MARKED = 0, 1, 2
#: What the density of an element counts that is perhaps not part of the article.
PERHAPS_WEIGHT = 0.25
#: Elements that a form has only where it holds a page.
WRITTEN = frozenset("p article main h1 h2 h3 blockquote".split())
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")
_SPAN_START = re.compile(r"<!--|<(script|style)\b", re.I)
_SPAN_END = {"script": re.compile("</script", re.I), "style": re.compile("</style", re.I), "": re.compile("-->")}
_SILENT_END = re.compile(rf"</({'|'.join(sorted(SILENT))})(?=[\s/>])", re.I)


class Node:
    __slots__ = ("tag", "parent", "parts", "marked", "chars", "tags", "link_chars", "link_tags", "plain", "density", "total")

    def __init__(self, tag: str, parent: Node | None, marked: int = NOT_MARKED) -> None:
        self.tag, self.parent, self.marked = tag, parent, marked
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.plain = self.density = self.total = 0.0

    def nodes(self) -> Iterator[Node]:
        return (p for p in self.parts if isinstance(p, Node))


def mark_of(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether an element says that it is not part of the article.

    A label of marks and places is sure, as in "nav-bar".  One that only begins or ends
    with a mark may also be that of a wrapper or of a subject, as in "has-sidebar" or
    "social-science", and a form may hold the page.
    """
    if tag in ASIDE and tag != "form":
        return MARKED
    mark = PERHAPS if tag == "form" else NOT_MARKED
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return MARKED
        if name == "style" and "display:none" in value.replace(" ", ""):
            return MARKED
        if name in ("class", "id"):
            for label in value.split():
                words = _WORD.findall(label)
                if not words or MARKS.isdisjoint((words[0], words[-1])):
                    continue
                if all(w in MARKS or w in PLACES for w in words):
                    return MARKED
                mark = PERHAPS
    return mark


def closed(html: str) -> tuple[str, str]:
    """A page up to a comment, script or style that never ends, and the page without any of these.

    What never ends takes the rest of the page.  Behind the last ">" no tag can end, so
    every "<" there is text.  One pass, so that a page of open comments takes no longer.
    """
    last = html.rfind(">") + 1
    html = html[:last] + html[last:].replace("<", "&lt;")
    parts, at = [], 0
    while (found := _SPAN_START.search(html, at)) is not None:
        parts.append(html[at : found.start()])
        end = _SPAN_END[(found[1] or "").lower()].search(html, found.end())
        if end is None:
            return html[: found.start()], "".join(parts)
        at = end.end() if found[1] is None else end.start()
    return html, "".join([*parts, html[at:]])


class Builder(HTMLParser):
    """A tree of the elements and texts of a page, whatever it leaves open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.silent: list[str] = []
        #: Blocks that began inside of the silent elements and are open.
        self.inner: list[str] = []
        #: End tags of silent elements that are still to come.
        self.to_come: Counter[str] = Counter()
        #: How many elements of a tag are open.
        self.open: Counter[str] = Counter()

    def feed(self, data: str) -> None:
        data, markup = closed(data)
        self.to_come = Counter(tag.lower() for tag in _SILENT_END.findall(markup))
        super().feed(data)

    def set_cdata_mode(self, elem: str, **kinds) -> None:
        if elem in RAW or self.to_come[elem.lower()]:
            super().set_cdata_mode(elem, **kinds)

    def _speak(self) -> None:
        self.silent.clear()
        self.inner.clear()

    def _start_in_silence(self, tag: str) -> None:
        """Ends silent elements left open that cannot hold what begins here."""
        if "head" in self.silent and (tag == "body" or self.silent[-1] == "head" and tag not in IN_HEAD):
            self._speak()
        elif tag in BLOCKS and tag != "body":
            while self.silent and self.silent[-1] not in RAW and not self.to_come[self.silent[-1]]:
                if self.silent[-1] == "head":
                    break
                self.silent.pop()
            if "head" in self.silent and self.silent[-1] == "head":
                self._speak()
            if self.silent:
                self.inner.append(tag)
            else:
                self.inner.clear()

    def _leave(self, node: Node) -> None:
        while self.at is not node.parent and self.at is not self.root:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def _end_open(self, tags: set[str] | frozenset[str], scopes: frozenset[str]) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        node = self.at
        while node is not self.root and node.tag not in tags:
            if node.tag in scopes:
                return
            node = node.parent
        if node is not self.root:
            self._leave(node)

    def _inside(self, tag: str) -> bool:
        return tag == self.root.tag or self.open[tag] > 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent:
            self._start_in_silence(tag)
        if self.silent and tag == self.silent[-1] and tag in ("button", "select"):
            return  # these do not nest: the new one takes the place of the open one
        if self.silent or tag in ("html", "body"):
            if self.silent == ["head"] and tag in SILENT and tag != "head":
                self.silent.append(tag)
            return
        if tag in SILENT:
            self.silent.append(tag)
            return
        if tag in BLOCKS:
            self._end_open({"p"}, SCOPES)
        if tag in ENDS:
            self._end_open(ENDS[tag], SCOPES - ENDS[tag])
        mark = mark_of(tag, attrs)
        if tag == "header" and mark and self._inside("article"):
            mark = NOT_MARKED  # the headline of the article
        node = Node(tag, self.at, mark)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if not self.silent and tag not in SILENT:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.to_come[tag] -= 1
        if self.silent and tag in BLOCKS:
            if tag in self.inner:
                while self.inner.pop() != tag:
                    pass
            elif self.silent[-1] not in RAW and self._inside(tag):
                self._speak()  # the block around has ended
        if self.silent:
            if tag in self.silent:
                del self.silent[self.silent.index(tag) :]
                if not self.silent:
                    self.inner.clear()
        elif tag not in VOID:
            self._end_open({tag}, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if self.silent == ["head"] and data.strip():
            self._speak()  # text ends a head
        if not self.silent:
            self.at.parts.append(data)


def _post_order(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.nodes()
    order.reverse()
    return order


def _drop_marked(root: Node) -> None:
    """Take out what is surely around the article; what has an article in it stays.

    Where a page says which element is its article, what is perhaps around it goes too.
    """
    holders = set()
    for node in _post_order(root):
        if node.tag in ("article", "main") and node.marked != MARKED or any(id(n) in holders for n in node.nodes()):
            holders.add(id(node))
    gone = PERHAPS if holders else MARKED
    todo = [root]
    while todo:
        node = todo.pop()
        node.parts = [p for p in node.parts if isinstance(p, str) or p.marked < gone or id(p) in holders]
        todo += node.nodes()


def _drop_perhaps(root: Node) -> Node:
    """Take out what is perhaps around the article and has no part in it; the heart of the rest.

    An element on the way to the heart stays, and so does one with most of the text: the
    heart then is looked for again.
    """
    heart = heart_of(root)
    path = {id(heart)}
    node = heart
    while (node := node.parent) is not None:
        path.add(id(node))
    most, dropped = root.chars / 2, False
    todo = [root]
    while todo:
        node = todo.pop()
        kept = [p for p in node.parts if isinstance(p, str) or p.marked == NOT_MARKED or id(p) in path or p.chars > most and _is_written(p)]
        dropped |= len(kept) < len(node.parts)
        node.parts = kept
        todo += node.nodes()
    if dropped:
        _measure(root)
    return heart_of(root)


def _is_written(node: Node) -> bool:
    """Whether an element can hold an article: any but a form without text blocks."""
    return node.tag != "form" or any(n.tag in WRITTEN for n in _post_order(node))


def _measure(root: Node) -> None:
    """Composite text density of every node, and the sum of those of its children."""
    order = _post_order(root)
    for node in order:
        inner = list(node.nodes())
        node.chars = sum(len(_SPACE.sub(" ", p).strip()) for p in node.parts if isinstance(p, str)) + sum(n.chars for n in inner)
        node.tags = sum(n.tags + 1 for n in inner)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(n.link_chars for n in inner)
        node.link_tags = sum(n.link_tags + (n.tag == "a") for n in inner)
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        chars, tags = node.chars, max(node.tags, 1)
        links, link_tags, plain = max(node.link_chars, 1), max(node.link_tags, 1), max(chars - node.link_chars, 1)
        node.plain = (chars - node.link_chars) / tags
        if chars:
            base = math.log(chars / plain * node.link_chars + share * chars + math.e)
            node.density = chars / tags * math.log(max(chars / links * tags / link_tags, 1.0) + 1e-9 + 1) / max(math.log(base + 1), 1e-9)
        node.total = sum(n.density * (PERHAPS_WEIGHT if n.marked == PERHAPS else 1.0) for n in node.nodes())


def heart_of(root: Node) -> Node:
    """The node whose children's densities add up to most; the outermost of equals.

    Below an element that is perhaps not part of the article sums count less.
    """
    best, most, todo = root, -1.0, [(root, 1.0)]
    while todo:
        node, weight = todo.pop()
        if node.total * weight > most:
            best, most = node, node.total * weight
        todo += [(n, weight * PERHAPS_WEIGHT if n.marked == PERHAPS else weight) for n in reversed(list(node.nodes()))]
    return best


def _article(root: Node, best: Node) -> list[Node]:
    """The subtrees that hold the article around its heart, in page order."""
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    outer = {tag: [node for node in path if node.tag == tag] for tag in ("article", "main")}
    if outer["main"] and sum(node.tag == "article" for node in _post_order(outer["main"][-1])) > 1:
        return [outer["main"][-1]]
    for tag in ("article", "main"):
        if outer[tag]:
            return [outer[tag][-1]]
    threshold = min(node.plain for node in path)
    on_path = set(map(id, path[1:]))
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if id(node) not in on_path:
            found += [node] if node is best or node.chars and node.plain >= threshold else []
            continue
        if any(isinstance(p, str) and p.strip() for p in node.parts):
            found.append(node)  # text of its own on the way: all of it belongs together
            continue
        todo += reversed(list(node.nodes()))
    return found


def _blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks below a node, white space in each made one space."""
    text: list[str] = []
    todo: list[Node | str | None] = [node]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            text.append(part)
        elif part is None or part.tag in BLOCKS:
            whole = _SPACE.sub(" ", "".join(text)).strip()
            text = []
            if whole:
                yield whole
            if part is not None:
                todo += [None, *reversed(part.parts)]
        elif part.tag == "br":
            text.append(" ")
        else:
            todo += reversed(part.parts)
    whole = _SPACE.sub(" ", "".join(text)).strip()
    if whole:
        yield whole


def main_text(html: str | None) -> str:
    """The article of a page; empty where there is none."""
    if not html:
        return ""
    builder = Builder()
    builder.feed(html)
    builder.close()
    root = builder.root
    _drop_marked(root)
    _measure(root)
    heart = _drop_perhaps(root)
    if not root.chars:
        return ""
    return "\n\n".join(block for node in _article(root, heart) for block in _blocks(node))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", 1 << 22):
        texts = [main_text(html) for html in batch.column("html").to_pylist()]
        rest = [name for name in batch.schema.names if name != "html"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, rest), pa.array(texts, pa.string())], names=[*rest, "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page.

    The whole html is read; null html has empty text.  Menus, headers, footers,
    sidebars, notices, adverts, scripts, styles and reader comments that say so by their
    elements, roles or class and id words are taken out first.  Of what is left the
    subtree whose children's link-adjusted characters per tag add up to most is the heart
    of the article; labels that only begin or end with such a word, and forms, weigh less
    in it and go unless the heart or most of the text is in them.  The article or main element around it counts whole; without
    one, every subtree beside the path to the body counts that is as dense as the
    thinnest node on the path.  Character references are decoded, a block's white space
    is one space, and blocks are joined by an empty line.  Pages are independent: rows of
    one id give a row each, null ids and urls stay null, extra columns are ignored and
    an empty table gives an empty result.
    """
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    rows = pages.select("page_id", "url", "html").mapInArrow(_texts, kinds + ", text string")
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
