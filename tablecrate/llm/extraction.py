"""Main-text extraction from HTML by tree scoring.

A page is parsed into a tree of elements. Every block with text of its own is a paragraph,
whatever its element, headings aside. It earns points: one, one for every comma, one for every
hundred characters (three at most), discounted by the share of its text that stands in links.
Points go to all its ancestors, in falling shares: whole to the container it stands in, half
to the next one, then a sixth, a ninth and so on. The container with the most points,
discounted by its own link share, is the best one. If it stands within an article or main
element, that is the main container; else the search climbs as long as what stands beside
holds a quarter of the points below it, so that text in several containers is kept whole. The
main container is kept with those siblings that score well or read like a part of the text.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments of
readers are left out before; if nothing is left then, what was left out by class, id or role
counts again. A form that wraps the page (it holds an article, a first heading or most of the
text) is not one.

The text of the kept part is cut into blocks; white space within a block becomes one space,
blocks are joined by a line break in page order. Null or empty html, and pages without any
text, give ''. Markup that is never closed ends with its parent. Nothing is capped.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tablecrate.llm.arrow import with_computed

# Element names of HTML by what they mean here.
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside button select "
    "textarea input iframe object embed svg canvas dialog menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 "
    "h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption br".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd br figcaption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag that ends an open element of the second set, up to the third.
CLOSES = (
    (BLOCKS - {"br"}, frozenset({"p"}), frozenset({"td", "th", "li", "dd", "table", "button"})),
    (frozenset({"li"}), frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    (frozenset({"dt", "dd"}), frozenset({"dt", "dd"}), frozenset({"dl"})),
    (frozenset({"td", "th"}), frozenset({"td", "th"}), frozenset({"tr", "table"})),
    (frozenset({"tr"}), frozenset({"tr"}), frozenset({"table"})),
)
# Words of a class, id or role that mark what is not the article.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|breadcrumb|breadcrumbs|comment|comments|"
    r"complementary|consent|contentinfo|cookie|cookies|disqus|footer|header|masthead|menu|modal|nav|"
    r"navbar|navigation|newsletter|notice|outbrain|popup|promo|promoted|related|replies|search|share|"
    r"sharing|sidebar|skip|social|sponsor|sponsored|subscribe|taboola|toolbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.IGNORECASE)
# A class that says what stands beside the element, not what it is.
BESIDE = re.compile(r"(?:has|with|no|without)[_-]", re.IGNORECASE)
SPACE = re.compile(r"\s+")


def is_unlikely(named: str) -> bool:
    """Whether one of the names marks what is not the article, and none marks only the article."""
    against = [n for n in named.split() if UNLIKELY.search(n) and not BESIDE.match(n)]
    return bool(against) and not any(LIKELY.search(n) and not UNLIKELY.search(n) for n in named.split())


class Node:
    __slots__ = ("tag", "parent", "children", "weight", "dropped", "score")

    def __init__(self, tag: str, parent: Node | None, weight: float = 0.0, dropped: bool = False):
        self.tag, self.parent, self.children = tag, parent, []
        self.weight, self.dropped, self.score = weight, dropped, 0.0


class Tree(HTMLParser):
    """The elements of a page; texts are plain strings among the children."""

    def __init__(self, by_name: bool = True) -> None:
        """`by_name`: elements are left out by class, id and role, too."""
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.root = self.open = Node("html", None)
        self.held: Counter[str] = Counter()  # open elements by name: no search for others

    def _end(self, node: Node) -> None:
        while self.open is not node.parent:
            self.held[self.open.tag] -= 1
            self.open = self.open.parent

    def _close(self, tags: frozenset[str], limit: frozenset[str]) -> None:
        if not any(self.held[tag] for tag in tags):
            return
        node = self.open
        while node.parent is not None and node.tag not in limit:
            if node.tag in tags:
                self._end(node)
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for starting, closed, limit in CLOSES:
            if tag in starting:
                self._close(closed, limit)
        named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        likely = tag in ("article", "main") or bool(named and LIKELY.search(named))
        unlikely = self.by_name and is_unlikely(named) and tag not in ("html", "body", "article", "main")
        node = Node(tag, self.open, 25.0 * likely, tag in DROPPED or hidden or unlikely)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node
            self.held[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.open
        while self.held[tag] and node.parent is not None:
            if node.tag == tag:
                self._end(node)
                return
            # An inline end tag does not reach out of its block.
            if node.tag in BLOCKS and tag not in BLOCKS and tag not in DROPPED:
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.open.children.append(data)


def walk(root: Node) -> Iterator[tuple[Node | str, bool]]:
    """Elements and texts in page order without dropped parts; True where an element ends."""
    stack: list = [(root, False)]
    while stack:
        item, ended = stack.pop()
        yield item, ended
        if isinstance(item, str) or ended:
            continue
        stack.append((item, True))
        stack.extend((c, False) for c in reversed(item.children) if isinstance(c, str) or not c.dropped)


@dataclass
class Measure:
    """Of an element: characters, those in links, commas of its own text, points below it."""

    size: int = 0
    linked: int = 0
    own: int = 0
    own_linked: int = 0
    commas: int = 0
    points: float = 0.0

    @property
    def links(self) -> float:
        return self.linked / self.size if self.size else 0.0


def measure(root: Node) -> dict[int, Measure]:
    """Text in inline elements belongs to the block around them."""
    found: dict[int, Measure] = {}
    open_links = 0
    trail: list[Node] = []
    held: list[Node] = []  # open blocks
    for item, ended in walk(root):
        if isinstance(item, str):
            size = len(item.strip())
            if not size:
                continue
            for node in (trail[-1], held[-1]) if trail[-1] is not held[-1] else (held[-1],):
                if node is trail[-1]:
                    found[id(node)].size += size
                    found[id(node)].linked += size if open_links else 0
                if node is held[-1]:
                    block = found[id(node)]
                    block.own += size
                    block.own_linked += size if open_links else 0
                    block.commas += item.count(",") + item.count("、") + item.count("，")
        elif ended:
            open_links -= item.tag == "a"
            trail.pop()
            if held[-1] is item:
                held.pop()
            mine = found[id(item)]
            if mine.own and item.tag not in HEADINGS:
                mine.points += (1 + mine.commas + min(3.0, mine.own / 100)) * (1 - mine.own_linked / mine.own)
            if trail:
                above = found[id(trail[-1])]
                above.size, above.linked, above.points = above.size + mine.size, above.linked + mine.linked, above.points + mine.points
        else:
            open_links += item.tag == "a"
            trail.append(item)
            if item.tag in BLOCKS or not held:
                held.append(item)
            found[id(item)] = Measure()
    return found


def unwrapped(root: Node, top: Node) -> None:
    """Leave out the forms that are forms."""
    forms = [node for node, ended in walk(root) if not ended and not isinstance(node, str) and node.tag == "form"]
    if not forms:
        return
    sizes = measure(root)
    whole = sizes[id(top)].size
    for form in forms:
        inside = {node.tag for node, _ in walk(form) if not isinstance(node, str)}
        form.dropped = not inside & {"article", "main", "h1"} and 2 * sizes[id(form)].size <= whole


def main_parts(root: Node) -> list[Node]:
    """The main container and its worthy siblings, in page order; or nodes within it."""
    unwrapped(root, root)
    sizes = measure(root)
    scored: dict[int, Node] = {}
    for node, ended in walk(root):
        if ended or isinstance(node, str) or not sizes[id(node)].own or node.tag in HEADINGS:
            continue
        own = sizes[id(node)]
        points = (1 + own.commas + min(3.0, own.own / 100)) * (1 - own.own_linked / own.own)
        above = node.parent if node.tag in PARAGRAPHS else node
        level = 0
        while above is not None and points > 0:
            if id(above) not in scored:
                scored[id(above)] = above
                above.score = above.weight
            above.score += points * (1.0, 0.5)[level] if level < 2 else points / (3 * level)
            above, level = above.parent, level + 1
    if not scored:
        return [root]
    ranked = {key: node.score * (1 - sizes[key].links) for key, node in scored.items()}
    best = scored[max(ranked, key=ranked.__getitem__)]
    main = best
    while main is not None and main.tag not in ("article", "main"):
        main = main.parent
    climbed = False
    if main is None:
        main, node, beside = best, best, 0.0
        while node.parent is not None:
            beside += sum(sizes[id(n)].points for n in siblings(node) if sizes[id(n)].links < 0.5)
            node = node.parent
            if 4 * beside >= sizes[id(main)].points:
                main, climbed, beside = node, True, 0.0
    if climbed:  # what holds only links is no part of the text
        for node, ended in walk(main):
            if not ended and not isinstance(node, str) and node.tag in BLOCKS and not sizes[id(node)].points:
                node.dropped = sizes[id(node)].links > 0.5
    if main.parent is None:
        return [main]
    enough = max(10.0, 0.2 * ranked.get(id(main), 0.0))
    kept = []
    for node in main.parent.children:
        if isinstance(node, str) or node.dropped:
            continue
        here = sizes[id(node)]
        reads = node.tag == "p" and ((here.size > 80 and here.links < 0.25) or (0 < here.size <= 80 and here.links == 0))
        heading = node.tag in ("h1", "h2") and here.size > 0 and here.links == 0
        alike = node.tag == main.tag and node.tag in ("section", "article") and here.points > 0 and here.links < 0.25
        if node is main or ranked.get(id(node), 0.0) >= enough or reads or heading or alike:
            kept.append(node)
    return kept


def siblings(node: Node) -> Iterator[Node]:
    return (c for c in node.parent.children if c is not node and not isinstance(c, str) and not c.dropped)


def blocks(root: Node) -> Iterator[str]:
    held: list[str] = []
    for item, _ in walk(root):
        if isinstance(item, str):
            held.append(item)
        elif item.tag in BLOCKS:
            yield "".join(held)
            held = []
    yield "".join(held)


def extract(html: str | None) -> str:
    for by_name in (True, False):
        tree = Tree(by_name)
        tree.feed(html or "")
        tree.close()
        found = (SPACE.sub(" ", block).strip() for part in main_parts(tree.root) for block in blocks(part))
        if text := "\n".join(block for block in found if block):
            return text
    return ""


def extracted(df: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """`df` with `text`, the main text of its html."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"text": pa.array(map(extract, batch.column(html).to_pylist()), pa.string())}

    return with_computed(df, compute, "text string", keep)
