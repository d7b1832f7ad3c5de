"""Main text of web pages by tree scoring.

A page becomes a tree. Each paragraph gives points for being one, for its commas and its length to its parent, half of them
to the next ancestor, a third to the one after that, and so on. A container's points are discounted by the share of its text that stands in links.
If the container with the most points lies in an article or main element, all outermost such elements of the page are the article,
and what stands beside its own with a fair share of its score. Else the article is the lowest container around it that holds all
text outside menus, with short sections, headings and loose text; branches beside the best container that hold only links are left
out, headings stay. Where that container stands in a column (a cell of a row, or a part named so) that holds half of the page's text blocks, the other columns
of its row stay only with a fair share of its score; columns of headings before it stay. Menus, page headers, footers, side bars, notices, adverts, forms, scripts and reader comments are
told by element, role or name before scoring, and lists outside articles that are nearly all links by their density; all else stays.

Class and id names are weighed, as wrappers have such words, too (``has-sidebar``, ``no-comments``). A named part goes only if it is no
article or main, has no name that hints at the article, holds no article or main, and has a small share of the page's points, alone
and with the other small parts of its name; else it stays with half its score. Forms are weighed in the same way, as whole pages stand in one:
a form that holds an article or main or a large share of the points is a wrapper, others go; their controls always go. Reader comments and lists of other articles may hold
or be ``article`` elements: they go all the same if the page has an article outside them, comments whatever their share.

Blocks of the kept containers come in page order, white space within a block is one space, blocks are joined by one \\n.

Defined results: null or empty html, or a page without text outside such parts, has an empty text; a page all in a named part has its text. Broken markup is
closed where the next block begins. Pages are handled one by one and whole. Repeated rows are extracted each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from postsift.llm.bpe import add_column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
#: Elements that never belong to the article; a header does inside one.
APART = frozenset(
    "head title script style noscript template nav footer aside button select textarea option iframe object svg canvas dialog menu"
    " audio video map header".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class and id names, whole, and beginnings of such words.
NAMES = frozenset("ad ads adv nav rss toc related share sharing social tags pager footer header sidebar modal popup reply replies login".split())
BEGINNINGS = (
    "advert adsense banner breadcrumb comment consent cookie copyright disclaimer disqus gdpr masthead menu navbar navigation newsletter notice notification"
    " pagination paywall promo recommend sidebar signup skyscraper sponsor subscri toolbar widget"
).split()
#: Words that begin like one of them and are none; first words of a name that tell a state or a label of a part, not what it is.
OTHERS = frozenset("commentary commentaries commentator commentators subscript subscripts".split())
STATES = frozenset("no not has have with without show hide category tag type format".split())
#: Names of reader comments, and of these and lists of other articles. The element ``form`` counts as such a name.
COMMENTS = frozenset("comment disqus reply replies form".split())
LISTS = COMMENTS | frozenset("related recommend promo".split())
#: Names of parts that stand side by side.
COLUMNS = frozenset("col column cell span".split())
GOOD = frozenset("article body content entry main post text story page".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[a-z]+")
COMMENT_END = re.compile("--!?>")
#: Elements that may stand within a sentence and leave an open paragraph open.
WITHIN = frozenset("script style noscript template button select textarea option iframe object svg canvas audio video map".split())
#: Elements that end a paragraph still open, and what a new one of a kind closes.
CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}
#: Share of link text from which a list of at least so many links is a menu; share of its score that a part beside an article element needs.
MENU_DENSITY, MENU_LINKS, SIBLING = 0.8, 3, 0.2
#: Share of the page's points from which a named part stays; points that make an article outside comments.
LARGE, ELSEWHERE = 0.35, 4


class Node:
    __slots__ = ("tag", "parent", "children", "apart", "good", "names", "column", "holds", "points", "score", "prose", "chars", "linked", "links")

    def __init__(self, tag: str, parent: Node | None, apart: bool = False, good: bool = False, names: frozenset[str] = frozenset()):
        self.tag, self.parent, self.apart, self.good, self.names = tag, parent, apart, good, names
        self.children: list[Node | str] = []
        self.column = self.holds = False
        self.points, self.score, self.prose, self.chars, self.linked, self.links = 0.0, 0.0, 0, 0, 0, 0


END = Node("hr", None)


def name_of(word: str) -> str | None:
    """The entry of ``NAMES`` or ``BEGINNINGS`` that a word is."""
    if word in NAMES:
        return word
    return None if word in OTHERS else next((b for b in BEGINNINGS if word.startswith(b)), None)


def named(attrs: list[tuple[str, str | None]], within: bool) -> tuple[bool, bool, frozenset[str]]:
    """Whether role or style tell a part that is not the article; whether class or id hint at the article; names that speak against it.

    A hint in another name than theirs overrides the latter. ``within``: the part is inside an article, where a header belongs to it.
    """
    apart = good = sure = False
    against: set[str] = set()
    for name, value in attrs:
        if name == "hidden":
            apart = True
        elif not value:
            continue
        elif name in ("class", "id"):
            for token in value.split():
                words = WORD.findall(re.sub("([a-z])([A-Z])", r"\1 \2", token).lower())
                hint = any(w in GOOD for w in words)
                found = {n for n in map(name_of, words) if n} if words and words[0] not in STATES else set()
                if hint or within:
                    found.discard("header")
                against |= found
                good |= hint
                sure |= hint and not found
        elif name == "role":
            apart |= value.lower() in ROLES
        elif name == "aria-hidden":
            apart |= value.lower() == "true"
        elif name == "style":
            apart |= bool(HIDDEN.search(value))
    return apart, good, frozenset() if sure else frozenset(against)


def is_column(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "class" and not COLUMNS.isdisjoint(WORD.findall((value or "").lower())) for name, value in attrs)


class Tree(HTMLParser):
    """The elements and texts of a page, with unclosed elements closed. A comment or tag that is never closed hides the rest of the page, as in browsers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", None)
        self.open: dict[str, int] = {}

    def feed(self, data):
        """All of a page at once: where its last closing marks are tells in no time whether one is still to come."""
        self.size, self.last = len(data), {mark: data.rfind(mark) for mark in (">", "]]>")}
        super().feed(data)

    def comes(self, mark: str, i: int) -> bool:
        return i + self.size - len(self.rawdata) <= self.last[mark]

    def parse_comment(self, i, report=1):
        end = COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        mark = "]]>" if self.rawdata.startswith("<![CDATA[", i) and self.comes("]]>", i) else ">"
        return self.rawdata.find(mark, i + 2) + len(mark) if self.comes(mark, i) else len(self.rawdata)

    def parse_starttag(self, i):
        return super().parse_starttag(i) if self.comes(">", i) else len(self.rawdata)

    def parse_endtag(self, i):
        return super().parse_endtag(i) if self.comes(">", i) else len(self.rawdata)

    def parse_pi(self, i):
        return super().parse_pi(i) if self.comes(">", i) else len(self.rawdata)

    def enter(self, node: Node) -> None:
        self.at.children.append(node)
        self.at = node
        self.open[node.tag] = self.open.get(node.tag, 0) + 1

    def leave(self, tag: str) -> None:
        """Close up to the innermost open element of this kind."""
        while self.at.tag != tag:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[tag] -= 1
        self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br" or tag == "hr":
                self.at.children.append(" " if tag == "br" else Node("hr", self.at))
            return
        if tag not in INLINE:
            if self.open.get("head") and tag not in APART:
                self.leave("head")
            if self.open.get("p") and tag not in WITHIN:
                self.leave("p")
            if (other := CLOSES.get(tag)) and not self.inside_new(tag):
                for t in {tag, other}:
                    if self.open.get(t) and not self.inside_new(t):
                        self.leave(t)
        within = bool(self.open.get("article") or self.open.get("main"))
        apart, good, names = named(attrs, within) if attrs else (False, False, frozenset())
        if tag in ("html", "body", "main"):
            apart, names = False, frozenset()
        elif tag == "article":
            names &= LISTS
        elif tag in APART and not (tag == "header" and within):
            apart = True
        elif tag == "header":
            apart, names = False, frozenset()
        elif tag == "form":
            names |= {"form"}
        self.enter(Node(tag, self.at, apart, good or tag in ("article", "main"), names))
        self.at.column = tag in ("td", "th") or is_column(attrs)

    def inside_new(self, tag: str) -> bool:
        """Whether a list or table was opened since the last element of this kind."""
        node = self.at
        while node is not None and node.tag != tag:
            if node.tag in ("ul", "ol", "dl", "table", "select"):
                return True
            node = node.parent
        return node is None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "span", "a"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open.get(tag):
            self.leave(tag)

    def handle_data(self, data):
        self.at.children.append(data)


def in_order(root: Node) -> Iterator[tuple[Node | str, Node | None, bool]]:
    """(text, its element, False), (element, its parent, False) on entering and (.., True) on leaving; of blocks that are apart only an end is left."""
    stack: list[tuple[Node, int]] = [(root, 0)]
    while stack:
        node, i = stack.pop()
        if i == len(node.children):
            yield node, node.parent, True
            continue
        stack.append((node, i + 1))
        child = node.children[i]
        if isinstance(child, str):
            yield child, node, False
        elif not child.apart:
            yield child, node, False
            stack.append((child, 0))
        elif child.tag not in INLINE and child.tag not in WITHIN:
            yield END, node, True


def blocks(root: Node) -> Iterator[tuple[str, Node, int]]:
    """Text of each block, the block element it stands in, and how much of it is in links."""
    parts: list[str] = []
    linked = depth = 0
    owner = root
    for what, parent, leaving in in_order(root):
        if isinstance(what, str):
            if parts or not what.isspace():
                parts.append(what)
                linked += len(what.strip()) if depth else 0
            continue
        if what.tag == "a":
            depth += -1 if leaving else 1
        if what.tag in INLINE and what is not root:
            continue
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                yield text, owner, min(linked, len(text))
            parts, linked = [], 0
        owner = what if not leaving else parent or root


def points_of(text: str, linked: int) -> float:
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / max(len(text), 1))


def clear_wrappers(root: Node) -> None:
    """A form that holds an article or main, or a large share of the page's points, is a wrapper and no form to be filled in."""
    inside: dict[int, float] = {}
    holds: set[int] = set()
    for what, parent, leaving in in_order(root):
        if isinstance(what, Node) and leaving and parent is not None:
            total = inside.pop(id(what), 0.0) + what.points
            inside[id(parent)] = inside.get(id(parent), 0.0) + total
            if id(what) in holds or what.tag in ("article", "main") and total > 0:
                holds.add(id(parent))
            what.score = total
    root.score = inside.get(id(root), 0.0) + root.points
    for what, _, leaving in in_order(root):
        if isinstance(what, Node) and leaving:
            if what.tag == "form" and (id(what) in holds or what.score >= LARGE * root.score):
                what.names -= {"form"}
            what.score = 0.0
    root.score = 0.0


def drop_named(root: Node) -> None:
    """Set apart the parts whose names speak against them and that are not the page's body."""
    for text, owner, linked in blocks(root):
        owner.points += points_of(text, linked)
    clear_wrappers(root)
    doubted: list[Node] = []
    elsewhere, good, listed = 0.0, 0, 0
    for what, parent, leaving in in_order(root):
        if isinstance(what, str):
            parent.chars += len(what.strip())
            continue
        step = -1 if leaving else 1
        good += step if what.good and not what.names and what.tag not in ("html", "body") else 0
        listed += step if what.names & LISTS else 0
        if not leaving:
            if what.names:
                doubted.append(what)
            elsewhere += what.points if good and not listed else 0
        elif parent is not None:
            parent.points += what.points
            parent.chars += what.chars
            parent.holds |= what.holds or what.tag in ("article", "main") and not what.names and what.points > 0
    if not doubted:
        return

    def share(node: Node) -> float:
        return node.points / root.points if node.points else node.chars / max(root.chars, 1)

    small = [n for n in doubted if share(n) < LARGE]
    together: dict[str, float] = {}
    for node in small:
        for name in node.names:
            above = node.parent
            while above is not None and not (name in above.names and share(above) < LARGE):
                above = above.parent
            if above is None:  # else it is counted with that one
                together[name] = together.get(name, 0.0) + share(node)
    article = elsewhere >= ELSEWHERE
    for node in doubted:
        listing = bool(node.names & LISTS) and article
        if (node.holds or node.tag == "article") and not listing:
            continue
        node.apart = listing and bool(node.names & COMMENTS) or share(node) < LARGE and max(together[n] for n in node.names) < LARGE


def measure(root: Node) -> None:
    """Characters, link characters and links below each element."""
    root.chars = 0
    for what, parent, leaving in in_order(root):
        if isinstance(what, Node) and not leaving:
            what.chars = 0
        if isinstance(what, Node) and leaving and parent is not None:
            if what.tag == "a":
                what.linked, what.links = what.chars, 1
            parent.chars += what.chars
            parent.linked += what.linked
            parent.links += what.links
        elif isinstance(what, str):
            parent.chars += len(what.strip())


def drop_menus(root: Node) -> None:
    """Lists that are nearly all links, but those within an article, as of its sources."""
    within = 0
    for what, _, leaving in in_order(root):
        if isinstance(what, Node) and what.tag == "article":
            within += -1 if leaving else 1
        if isinstance(what, Node) and leaving and not within and what.tag in ("ul", "ol", "dl", "div", "section", "table"):
            if what.links >= MENU_LINKS and what.linked >= MENU_DENSITY * what.chars:
                what.apart = True


def rate(root: Node) -> dict[int, Node]:
    """Pass the points of each paragraph to its ancestors; the containers that got any, by identity."""
    rated: dict[int, Node] = {}
    for text, owner, linked in blocks(root):
        points = points_of(text, linked)
        node, step = (owner.parent or owner) if owner.tag in PARAGRAPHS else owner, 1
        while node is not None and node.tag not in ("", "html"):
            if id(node) not in rated:
                rated[id(node)] = node
                node.score = 5.0 if node.good else 0.0
            node.score += points / step
            node, step = node.parent, step + 1
    for node in rated.values():
        node.score *= (1 - node.linked / max(node.chars, 1)) * (0.5 if node.names else 1)
    return rated


def main_text(html: str) -> str:
    tree = Tree()
    tree.feed(html)
    tree.close()
    root = tree.root
    drop_named(root)
    measure(root)
    drop_menus(root)
    rated = rate(root)
    if not rated:
        return "\n".join(text for text, _, _ in blocks(root))
    best = max(rated.values(), key=lambda n: n.score)
    top, node = None, best
    while node is not None:
        if node.tag in ("article", "main"):
            top = node
        node = node.parent
    kept = beside(top, root, rated) if top else [around(best, root)]
    return "\n".join(text for n in kept for text, _, _ in blocks(n))


def beside(top: Node, root: Node, rated: dict[int, Node]) -> list[Node]:
    """The outermost article and main elements, and the siblings of this one that score a fair share of it, in page order."""
    fair = SIBLING * top.score
    siblings = {id(n) for n in top.parent.children if isinstance(n, Node) and id(n) in rated and n.score >= fair > 0}
    out, depth = [], 0
    for what, _, leaving in in_order(root):
        if isinstance(what, Node) and (what.tag in ("article", "main") or id(what) in siblings):
            depth -= leaving
            if not leaving and not depth and (what is top or what.linked < MENU_DENSITY * what.chars):
                out.append(what)
            depth += not leaving
    return out


def count_prose(root: Node) -> None:
    """Blocks below each element that are headings or not all links."""
    for what, _, leaving in in_order(root):
        if isinstance(what, Node) and not leaving:
            what.prose = 0
    root.prose = 0
    for text, owner, linked in blocks(root):
        owner.prose += linked < MENU_DENSITY * len(text) or owner.tag in HEADINGS
    for what, parent, leaving in in_order(root):
        if isinstance(what, Node) and leaving and parent is not None:
            parent.prose += what.prose


def drop_columns(best: Node, root: Node) -> bool:
    """Set apart the columns beside the one with the best container that score too little; whether there are any."""
    found = False
    path = best
    while path.parent is not None:
        parent = path.parent
        if path.column and 2 * path.prose >= root.prose:
            before = True
            for child in parent.children:
                if child is path:
                    before = False
                elif isinstance(child, Node) and child.column and not child.apart and child.score < SIBLING * path.score:
                    if not before or not all(owner.tag in HEADINGS for _, owner, _ in blocks(child)):
                        child.apart = found = True
        path = parent
    return found


def around(best: Node, root: Node) -> Node:
    """The lowest container around the best one that holds every block that is not all links, without branches of links alone and columns of low score."""
    count_prose(root)
    if drop_columns(best, root):
        count_prose(root)
    if not root.prose:
        return root
    node = best
    while node.parent is not None and node.prose < root.prose:
        path, node = node, node.parent
        for child in node.children:
            if isinstance(child, Node) and child is not path and child.tag not in INLINE and not child.prose:
                child.children = []  # the element still ends the text before it
    return node


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of each page."""

    def work(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) if p else "" for p in pages.to_pylist()], pa.string())

    return add_column(df, text, StringType(), work, html)
