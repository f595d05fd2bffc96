"""Main text of web pages by tree scoring (operator 8).

Every paragraph gives points to its ancestors: one, one more for each comma, and up to
three for its length; the parent takes them whole, the grandparent half, the next a sixth,
each one above two thirds of that. Points below a block with class or id words of other matter count
a fifth. A container's points are scaled by the share of its text that is not in links. The
best container's article or main element is taken, and nothing beside it; without one, the best
container, the content blocks beside it, and those beside its parent if these have paragraphs or
headings. Elements that are not content by tag or role are left out, and blocks whose class or id
is about other matter: by its last word, or by any word if the block is made of links, of
like items (a list of comments) or without a paragraph. Those that hold the best container or most points stay.

A page is read once: where a tag ends, which element an end tag closes and what a
start tag closes are looked up, not searched, so time grows with the page's length whatever its markup.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_bytes

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset("""head script style title noscript template iframe object embed svg canvas math audio video map
 nav header footer aside form button select option textarea input label fieldset dialog menu""".split())
BLOCKS = frozenset("""address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure
 footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body main article section div td center".split())
# A start tag that closes an open element of these names, up to the nearest of the fences.
_CLOSES = {
    **dict.fromkeys("""address article aside blockquote center details dialog div dl fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul""".split(), (frozenset({"p"}), frozenset("td th li div section article body".split()))),
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: blocks whose class and id words count: no headings, no paragraphs
_MARKED = BLOCKS - PARAGRAPHS - _HEADINGS - frozenset("article body br hr html main".split())

# Words of class, id and role that mark what is not the article, and words of layout around them.
_OTHER = frozenset("""ad ads adbox banner breadcrumb breadcrumbs comment comments reply replies respond disqus cookie cookies consent gdpr
 notice alert popup modal overlay footer foot masthead menu nav navbar navigation sidebar side widget widgets related share sharing social
 subscribe newsletter signup login toolbar pagination pager contentinfo complementary search skip hidden""".split())
_OTHER_STARTS = ("advert", "sponsor", "promo", "recommend")
_LAYOUT = frozenset("""area areas article articles bar bars block body bottom box button buttons container entry global group inline inner item
 items left link links list main outer page panel post posts primary right secondary section site slot sticky stories thread top unit wrap
 wrapper zone""".split())
_NEGATED = frozenset("no has with without".split())
_SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")

_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*+)|<[!?]|([^<]++|<)")
_STRICT = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_COMMENT_END = re.compile(r"--!?>")
_ATTR = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_WHITE = re.compile(r"\s+")


def _is_other(word: str) -> bool:
    word = word.lower().rstrip("0123456789")
    return word in _OTHER or word.startswith(_OTHER_STARTS)


def name_mark(value: str) -> int:
    """Of a class, id or role: 2 if one of its names ends in a word of other matter or is made of such and of layout, 1 if
    one holds such a word, else 0."""
    mark = 0
    for name in value.split():
        words = [w for w in _SPLIT.split(name) if w]
        other = [_is_other(w) and (k == 0 or words[k - 1].lower() not in _NEGATED) for k, w in enumerate(words)]
        if any(other):
            whole = other[-1] or all(o or w.lower().rstrip("0123456789") in _LAYOUT for o, w in zip(other, words))
            mark = max(mark, 2 if whole else 1)
    return mark


class Node:
    """An element: its children are nodes and strings."""

    __slots__ = ("tag", "off", "mark", "sign", "kids", "parent", "weight", "score", "held", "chars", "link_chars", "links", "own", "paragraphs")

    def __init__(self, tag: str, off: bool, mark: int, sign: str, parent: Node | None):
        self.tag, self.off, self.mark, self.sign, self.parent = tag, off, mark, sign, parent
        self.kids: list = []
        self.weight, self.score, self.held, self.chars, self.link_chars, self.links = 1.0, 0.0, 0.0, 0, 0, 0
        self.own, self.paragraphs = (0, 0), 0


def _judge(tag: str, attributes: str) -> tuple[bool, int, str]:
    """(left out, mark of class and id, the class)."""
    if tag in DROPPED:
        return True, 0, ""
    mark, sign = 0, ""
    if "=" not in attributes and "hidden" not in attributes or tag in ("html", "body"):
        return False, 0, ""
    for m in _ATTR.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, 0, ""
        if name == "role" and tag not in ("article", "main") and name_mark(value):
            return True, 0, ""
        if name == "class":
            sign = value
        if name in ("class", "id") and tag in _MARKED:
            mark = max(mark, name_mark(value))
        if name == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value, re.I):
            return True, 0, ""
    return False, mark, sign


class _TagEnds:
    """Where tags end: at the first > outside quotes, or, if quotes never close, at the first > at all."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.marks: list[int] | None = None
        self.ends: list[int] = []

    def _look_up(self, at: int) -> int:
        """The end from any place, from a table made once: the quotes and > of the page, read from its end."""
        if self.marks is None:
            self.marks = [m.start() for m in re.finditer("[\"'>]", self.page)]
            self.ends = [-1] * (len(self.marks) + 1)
            later = {'"': -1, "'": -1}
            for i in range(len(self.marks) - 1, -1, -1):
                c = self.page[self.marks[i]]
                if c == ">":
                    self.ends[i] = self.marks[i]
                else:
                    self.ends[i] = self.ends[later[c] + 1] if later[c] >= 0 else -1
                    later[c] = i
        return self.ends[bisect.bisect_left(self.marks, at)]

    def find(self, at: int) -> int:
        """Place of the > that ends the tag whose attributes begin here; -1 if the page ends first."""
        if at > self.last:
            return -1
        if self.marks is None:
            m = _STRICT.match(self.page, at)
            if m is not None:
                return m.end() - 1
        end = self._look_up(at)
        return end if end >= 0 else self.page.find(">", at)


class _Open:
    """The open elements, and where those of each name and the blocks are among them."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = [root]
        self.at: dict[str, list[int]] = {root.tag: [0]}
        self.blocks: list[int] = [0]

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, to: int) -> None:
        """Close the elements from a place on."""
        while len(self.nodes) > to:
            node = self.nodes.pop()
            self.at[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def end(self, tag: str) -> None:
        """An end tag: closes the nearest element of its name; an inline one none outside its block."""
        places = self.at.get(tag)
        if places and places[-1] and not (tag in _INLINE and self.blocks[-1] > places[-1]):
            self.cut(places[-1])

    def start(self, tag: str) -> None:
        """What a start tag closes."""
        closes, fences = _CLOSES.get(tag, ((), ()))
        fence = max((self.at[f][-1] for f in fences if self.at.get(f)), default=0)
        first = len(self.nodes)
        for name in closes:
            places = self.at.get(name)
            if places and places[-1] > fence:
                first = min(first, places[bisect.bisect_right(places, fence)])
        self.cut(first)


def parse(page: str) -> Node:
    """Element tree of a page; unclosed and stray tags are mended as browsers do, in one pass."""
    root = Node("html", False, 0, "", None)
    open_, ends = _Open(root), _TagEnds(page)
    raw_missing: set[str] = set()
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[3] is not None:
            open_.nodes[-1].kids.append(html.unescape(m[3]))
            continue
        if m[2] is None:
            if m[0] == "<!--":
                end = _COMMENT_END.search(page, at)
                at = end.end() if end else n
            else:
                end = page.find(">", at) if at <= ends.last else -1
                at = end + 1 if end >= 0 else n
            continue
        tag, end = m[2].lower(), ends.find(at)
        attributes = page[at:end if end >= 0 else n]
        at = end + 1 if end >= 0 else n
        if tag in ("html", "body"):
            continue
        if m[1]:
            open_.end(tag)
            continue
        open_.start(tag)
        node = Node(tag, *_judge(tag, attributes), open_.nodes[-1])
        open_.nodes[-1].kids.append(node)
        # a slash that ends an unquoted value closes nothing
        if tag in VOID or attributes.endswith("/") and attributes[-2:-1] in ("", " ", "\t", "\n", '"', "'") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            close = None if tag in raw_missing else re.compile(rf"</{re.escape(tag)}\s*+/?>", re.I).search(page, at)
            if close is None:
                raw_missing.add(tag)
            at = close.end() if close else n
            continue
        open_.push(node)
    return root


def _measure(root: Node) -> list[Node]:
    """Text, links and paragraphs of each kept element, its own text outside nested blocks, and the weight of its points;
    returns the elements."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        if node.mark or node.parent is not None and node.parent.weight < 1:
            node.weight = 0.2
        stack += [k for k in node.kids if isinstance(k, Node) and not k.off]
    for node in reversed(order):
        node.chars = node.link_chars = node.links = node.paragraphs = 0
        size = commas = 0
        for k in node.kids:
            if isinstance(k, str):
                c = len(k.strip())
                node.chars += c
                size, commas = size + c, commas + k.count(",")
            elif not k.off:
                node.chars += k.chars
                node.link_chars += k.chars if k.tag == "a" else k.link_chars
                node.links += k.links + (k.tag == "a")
                node.paragraphs += k.paragraphs + (k.tag in PARAGRAPHS or k.tag in _HEADINGS)
                if k.tag not in BLOCKS:
                    size, commas = size + k.own[0], commas + k.own[1]
        node.own = size, commas
    return order


def _like_items(node: Node) -> bool:
    """Whether most of a block is three or more elements of one name and class that are no paragraphs, such as comments."""
    while True:
        kids = [k for k in node.kids if isinstance(k, Node) and not k.off and k.chars]
        if len(kids) != 1 or kids[0].tag not in BLOCKS:
            break
        node = kids[0]
    found: dict[tuple[str, str], list[int]] = {}
    for k in kids:
        if k.tag in BLOCKS and (k.tag not in PARAGRAPHS or k.tag == "li") and k.tag not in _HEADINGS:
            found.setdefault((k.tag, k.sign), []).append(k.chars)
    return any(len(c) >= 3 and 2 * sum(c) >= node.chars for c in found.values())


def _is_other_matter(node: Node) -> bool:
    """A marked block that its name or its make-up tells from the article."""
    return node.mark == 2 or node.mark == 1 and (2.5 * node.link_chars > node.chars or not node.paragraphs or _like_items(node))


def _blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, in page order, white space made single."""
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = _WHITE.sub(" ", "".join(held)).strip()
        if text:
            out.append(text)
        held.clear()
    stack: list = [iter([node])]
    names: list[str] = [""]
    while stack:
        k = next(stack[-1], None)
        if k is None:
            stack.pop()
            if names.pop() in BLOCKS:
                close()
        elif isinstance(k, str):
            held.append(k)
        elif not k.off:
            if k.tag in BLOCKS:
                close()
            stack.append(iter(k.kids))
            names.append(k.tag)
    close()
    return out


def _is_content(node: Node) -> bool:
    """Whether a block beside the article belongs to it: by its links alone."""
    if node.tag in _HEADINGS:
        return True
    density = node.link_chars / max(node.chars, 1)
    return density <= 0.5 or node.tag in PARAGRAPHS and (density <= 0.8 or node.links == 1)


def _with_neighbours(best: Node) -> Node:
    """The best container's parent, or the parent's if text stands beside it, left with content only; or the container."""
    top, node = best, best
    for _ in range(2):
        above = node.parent
        if above is None:
            break
        beside = [k for k in above.kids if isinstance(k, Node) and k is not node and k.tag in BLOCKS and not k.off
                  and k.chars and _is_content(k)]
        loose = [k for k in above.kids if isinstance(k, str) or k.tag not in BLOCKS and not k.off]
        linked = sum(k.chars if k.tag == "a" else k.link_chars for k in loose if isinstance(k, Node))
        text = sum(len(k.strip()) if isinstance(k, str) else k.chars for k in loose)
        own = 2 * linked < text
        if node is best or own or any(k.held or k.tag in _HEADINGS for k in beside):
            keep = {id(k) for k in (node, *beside, *(loose if own else ()))}
            above.kids = [k for k in above.kids if id(k) in keep]
            top = above
        node = above
    return top


def main_text(page: str | None) -> str:
    """The article of a page as one line; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    order = _measure(root)
    # points on their way up: of paragraphs in the container itself, one above, and farther
    passed: dict[int, tuple[float, float, float]] = {}
    scored: list[Node] = []
    for node in reversed(order):
        near, next_, far = passed.pop(id(node), (0.0, 0.0, 0.0))
        loose = node.tag in CONTAINERS
        if loose or node.tag in PARAGRAPHS:
            size, commas = node.own
            if size:
                points = node.weight * (1 + commas + min(size / 100, 3))
                node.held += points
                near += points
        if loose:
            if near or next_ or far:
                node.score = near + next_ / 2 + far
                scored.append(node)
            near, next_, far = 0.0, near, next_ / 6 + far * 2 / 3
        if node.parent is not None:
            node.parent.held += node.held
            if near or next_ or far:
                a, b, c = passed.get(id(node.parent), (0.0, 0.0, 0.0))
                passed[id(node.parent)] = a + near, b + next_, c + far
    if not scored:
        return " ".join(_blocks(root))
    for node in scored:
        node.score *= 1 - node.link_chars / max(node.chars, 1)
        if node.tag in ("article", "main"):
            node.score *= 1.25
    best = max(reversed(scored), key=lambda x: x.score)
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    holders = {id(x) for x in above}
    for node in order:
        if node.mark and id(node) not in holders and 2 * node.held <= root.held and _is_other_matter(node):
            node.off = True
    _measure(root)
    whole = best if best.tag in ("article", "main") else next(
        (x for tag in ("article", "main") for x in above if x.tag == tag), None)
    return " ".join(_blocks(whole if whole is not None else _with_neighbours(best)))


def extract(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: id, url, ``text``, one row per input row.

    Null or empty html, and pages without text, give the empty text. Null ids and urls are
    kept, repeated rows give repeated results, other columns are not read, an empty table
    gives an empty one. Of containers with equal points the first in the page is the best. Pages are
    handled whole whatever their length and nesting depth, in time that grows with their length.
    """
    source = df.select(id_col, url_col, F.col(html_col).cast("string").alias(html_col))
    schema = T.StructType([source.schema[id_col], source.schema[url_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, html_col):
                texts = pa.array([main_text(h) for h in part.column(html_col).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(id_col), part.column(url_col), texts], names=schema.names)
    return source.mapInArrow(run, schema)
