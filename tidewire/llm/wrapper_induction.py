"""HTML extraction by wrapper induction.

Every page becomes a tree of its block elements, in which runs of like siblings count as one repeated
node. The trees of one host are aligned by simple tree matching into one wrapper. A text that stands
on nearly all pages with its node is template, the rest of a node is a slot. The content of a host is
what stands in the slots of its article region, which is found in the wrapper from the root down: the
node that holds most of the varying text outside links of the pages that have it. What elements mean
(``article``, ``nav``) and what class names say weighs in where the shares of text leave it open, and
inside the region it tells reader comments and the like from the article.

Wrappers are folded within each task, then merged by host in rounds of bounded fan-in, so that a host
with very many pages is spread over many tasks and only small trees are shuffled. Then every page is
aligned with its host's wrapper, and the pages of each text at each node are counted exactly, by an
aggregation that combines before its shuffle. All walks over trees are loops: depth is no limit.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Generator, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import scratch

#: Elements that end a block of text. Fixed values of the format.
BLOCKS = frozenset("address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose whole content is no text of the page.
HIDDEN = frozenset("script style noscript template svg iframe object select textarea button title audio video".split())
RAW = frozenset(("script", "style", "textarea", "title"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
#: Elements that stand for the article and for what surrounds it, those that may hold a whole region, and headings.
CONTENT_TAGS = frozenset(("article", "main"))
NOISE_TAGS = frozenset("nav footer aside form menu dialog".split())
CONTAINERS = frozenset("html body div section main article center table tbody tr td form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Names that say what surrounds an article, if all words of a class, id or role are of these lists; names that
#: may also be those of an article's section, for which the text decides; and words that say nothing.
NOISE_NAMES = frozenset("ad adbox ads adsense adslot advert advertisement advertising adverts alert alertdialog banner breadcrumb breadcrumbs comentarios comment commentaires commentlist comments complementary consent contentinfo cookie cookies disqus footer gdpr leaderboard login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promoted replies reply respond share sharing sidebar sidenav signup skyscraper social sponsor sponsored subscribe toolbar topnav widget".split())
OPEN_NAMES = frozenset("disclaimer discussion related search".split())
PLAIN_NAMES = frozenset("area articles bar block body bottom box buttons container content entry form global group inner items left links list main middle outer overlay page policy post posts primary right secondary section site slot thread title top unit widgets wrap wrapper".split())
#: Least share of pages of a template text, least pages of a node, most nodes of a wrapper (the nodes beyond it are aligned by path),
#: and most wrappers that one task merges.
TEMPLATE_SHARE, LEAST_PAGES, MOST_NODES, FAN_IN = 0.85, 2, 2000, 32
#: Share of the varying text that makes a node the region, or a part of it beside that; the weight of an element's or name's meaning.
REGION_SHARE, PART_SHARE, MEANING = 0.7, 0.15, 8

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_ENDS_OF = {tag: re.compile(rf"<(/?){tag}\b[^>]*>", re.I) for tag in HIDDEN}


def end_of(page: str, tag: str, at: int) -> int:
    """Where the element of ``tag`` whose start tag ends at ``at`` ends; ``at`` itself if it never does, for raw elements the end of the page."""
    depth = 1
    for m in _ENDS_OF[tag].finditer(page, at):
        if tag in RAW and not m[1]:
            continue
        depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
        if not depth:
            return m.end()
    return len(page) if tag in RAW else at


def meaning(names: str) -> str:
    """"noise" if a class, id or role says what surrounds an article, "open" if it may say so."""
    found = ""
    for name in names.split():
        words = frozenset(_WORD.findall(_HUMP.sub("-", name).lower()))
        if words and words <= NOISE_NAMES | OPEN_NAMES | PLAIN_NAMES:
            if words & NOISE_NAMES:
                return "noise"
            if words & OPEN_NAMES:
                found = "open"
    return found


class Node:
    """A block element. ``noise``: its element or name says that it surrounds an article; ``unsure``: its name may say so."""

    __slots__ = ("tag", "key", "items", "noise", "unsure", "links")

    def __init__(self, tag: str, key: str, noise: bool, unsure: bool = False):
        self.tag, self.key, self.noise, self.unsure, self.links = tag, key, noise, unsure, 0
        self.items: list = []

    def texts(self) -> list[str]:
        """Own runs of text between child blocks, with white space made single."""
        out, run = [], []
        for x in [*self.items, None]:
            if isinstance(x, str):
                run.append(x)
            elif run:
                text = " ".join("".join(run).split())
                if text:
                    out.append(text)
                run = []
        return out

    def blocks(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def below(self) -> Iterator[Node]:
        """This node and all below it, in page order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += node.blocks()[::-1]


def parse(page: str) -> Node:
    """The tree of block elements; unclosed and stray tags are taken as browsers mostly do."""
    root = Node("#root", "#root", False)
    stack, inside, at, links = [root], [False], 0, 0
    muted: list[tuple[str, int]] = []  # inline elements that are noise, and the depth of the block they stand in
    open_tags: dict[str, int] = {}
    while m := _TOKEN.search(page, at):
        closing, tag = m[1], (m[2] or "").lower()
        if m.start() > at and not muted:
            text = page[at : m.start()]
            text = entities.unescape(text) if "&" in text else text
            stack[-1].items.append(text)
            if links:
                stack[-1].links += len(text)
        at = m.end()
        if not tag:
            continue
        if tag in HIDDEN:
            if not closing and not m[3].endswith("/"):
                at = end_of(page, tag, at)
            continue
        if tag == "br" or tag == "hr":
            stack[-1].items.append(" ")
            if tag == "br":
                continue
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            if tag in BLOCKS and open_tags.get(tag):
                while True:
                    gone = stack.pop()
                    inside.pop()
                    open_tags[gone.tag] -= 1
                    if gone.tag == tag:
                        break
                while muted and muted[-1][1] > len(stack):
                    muted.pop()
            elif muted and muted[-1][0] == tag:
                muted.pop()
            continue
        named = {}
        if m[3]:
            named = {k.lower(): v.strip("\"'") for k, v in _NAMES.findall(m[3])}
        says = meaning(" ".join(named.get(k, "") for k in ("class", "id", "role"))) if named else ""
        if "hidden" in named:
            says = "noise"
        if tag not in BLOCKS:
            if muted and tag == muted[-1][0] or says == "noise" and tag not in VOID:
                muted.append((tag, len(stack)))
            continue
        while len(stack) > 1 and (stack[-1].tag == "p" or stack[-1].tag in CLOSES_ITSELF.get(tag, ())):
            open_tags[stack.pop().tag] -= 1
            inside.pop()
        while muted and muted[-1][1] > len(stack):
            muted.pop()
        whole = tag in CONTENT_TAGS or tag in ("body", "html")
        noise = tag in NOISE_TAGS or says == "noise" and not whole or tag == "header" and not inside[-1]
        # Names with numbers are a page's own, and would keep the same nodes of different pages apart.
        key = ".".join([tag, *sorted(x for x in named.get("class", "").lower().split() if not re.search(r"\d{3}", x))])
        if (own := named.get("id", "").lower()) and not re.search(r"[\d\s]", own):
            key += f"#{own}"
        node = Node(tag, key, noise, says == "open" and not whole)
        stack[-1].items.append(node)
        if tag != "hr":
            open_tags[tag] = open_tags.get(tag, 0) + 1
            stack.append(node)
            inside.append(inside[-1] or tag in CONTENT_TAGS)
    if at < len(page) and not muted:
        stack[-1].items.append(entities.unescape(page[at:]))
    return root


class Group:
    """Like siblings taken as one repeated node: its members and the groups of their children."""

    __slots__ = ("key", "members", "children")

    def __init__(self, members: list[Node]):
        self.key, self.members = members[0].key, members
        self.children: list[Group] = []
        todo = [self]
        while todo:
            g = todo.pop()
            for runs in g._aligned():
                child = Group.__new__(Group)
                child.key, child.members, child.children = runs[0].key, runs, []
                g.children.append(child)
            todo += g.children

    def _aligned(self) -> list[list[Node]]:
        """The runs of like children of all members, aligned by keys in order."""
        out: list[list[Node]] = []
        for node in self.members:
            k = 0
            row: list[list[Node]] = []
            for child in node.blocks():
                if row and row[-1][0].key == child.key:
                    row[-1].append(child)
                else:
                    row.append([child])
            if not out:
                out = row
                continue
            for run in row:
                at = next((i for i in range(k, len(out)) if out[i][0].key == run[0].key), None)
                if at is None:
                    out.insert(k, run)
                    k += 1
                else:
                    out[at] += run
                    k = at + 1
        return out


class Slot:
    """A wrapper node: pages that have it, characters and runs of its text, characters of links, children.

    ``total`` sums the text outside links of the pages that have it, and ``many`` counts the pages on
    which it is repeated. ``load`` numbers the nodes of the whole tree in order; ``template`` holds the
    template texts, and ``loose``, in the root, those of nodes outside the wrapper, by their number.
    """

    __slots__ = ("key", "pages", "chars", "links", "runs", "total", "many", "children", "number", "template", "fixed_chars", "loose", "varying", "regions")

    def __init__(self, key: str, *counts: int):
        self.key = key
        self.pages, self.chars, self.links, self.runs, self.total, self.many = counts or (0,) * 6
        self.children: list[Slot] = []
        self.number = self.fixed_chars = self.varying = 0
        self.template: set[int] = set()
        self.loose: dict[int, set[int]] = {}
        self.regions: dict[int, Slot] | None = None

    @property
    def tag(self) -> str:
        return re.split("[.#]", self.key, maxsplit=1)[0] or self.key

    def dump(self) -> list:
        """Nodes in order, each with its depth: flat, so that depth is no limit to who reads it."""
        out, todo = [], [(0, self)]
        while todo:
            depth, s = todo.pop()
            out.append([depth, s.key, s.pages, s.chars, s.links, s.runs, s.total, s.many])
            todo += [(depth + 1, c) for c in reversed(s.children)]
        return out

    @classmethod
    def load(cls, rows: list) -> Slot:
        above: list[Slot] = []
        for number, (depth, *x) in enumerate(rows):
            s = cls(*x)
            s.number = number
            del above[depth:]
            if above:
                above[-1].children.append(s)
            above.append(s)
        return above[0]

    def nodes(self) -> Iterator[Slot]:
        todo = [self]
        while todo:
            s = todo.pop()
            yield s
            todo += s.children[::-1]


def tree_size(x) -> int:
    n, todo = 0, [x]
    while todo:
        n += 1
        todo += todo.pop().children
    return n


def _run(call: Generator):
    """Run a function that yields the calls it needs and is sent their results; its depth is that of a list."""
    stack, value = [call], None
    while stack:
        try:
            call = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(call)
            value = None
    return value


def _pairs(a: list, b: list, known: dict) -> Generator:
    """The pairs of the largest order-keeping match of two ordered lists of trees, and its size."""
    keys = [x.key for x in a]
    if len(set(keys)) == len(keys) and keys == [y.key for y in b]:
        size = 0
        for x, y in zip(a, b):
            size += yield _size(x, y, known)
        return [(i, i) for i in range(len(a))], size
    if not a or not b:
        return [], 0
    code: dict[str, int] = {}
    kb = np.array([code.setdefault(y.key, len(code)) for y in b])
    deep = np.array([bool(y.children) for y in b])
    best, took, held = np.zeros(len(b) + 1, np.int64), [], []
    for x in a:
        worth = (kb == code.get(x.key, -1)).astype(np.int64)
        if x.children:
            for j in np.flatnonzero((worth > 0) & deep):
                worth[j] = yield _size(x, b[j], known)
        taken = np.where(worth > 0, best[:-1] + worth, 0)
        new = np.concatenate([[0], np.maximum.accumulate(np.maximum(best[1:], taken))])
        took.append(np.packbits((taken == new[1:]) & (worth > 0)))  # a match that ends here
        held.append(np.packbits(best[1:] == new[1:]))
        best = new
    pairs, i, j = [], len(a), len(b)
    while i and j:
        at, bit = divmod(j - 1, 8)
        if took[i - 1][at] >> (7 - bit) & 1:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif held[i - 1][at] >> (7 - bit) & 1:
            i -= 1
        else:
            j -= 1
    return pairs[::-1], int(best[-1])


def _size(x, y, known: dict) -> Generator:
    if x.key != y.key:
        return 0
    if not x.children or not y.children:
        return 1
    at = id(x), id(y)
    if at not in known:
        known[at] = 1 + (yield _pairs(x.children, y.children, known))[1]
    return known[at]


def match(a: list, b: list, known: dict | None = None) -> list[tuple[int, int]]:
    """Simple tree matching of two ordered lists of trees; ``known`` keeps the sizes of matches while the trees live."""
    return _run(_pairs(a, b, {} if known is None else known))[0]


def matched_size(x, y) -> int:
    """Nodes of the largest match of two trees that keeps order, keys and ancestors."""
    return _run(_size(x, y, {}))


def text_hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def as_slot(g: Group) -> Slot:
    """A page's tree as the wrapper of that page alone."""
    root = Slot(g.key)
    slots, todo, total = [], [(g, root)], 0
    while todo:
        h, s = todo.pop()
        s.pages, s.many = 1, int(len(h.members) > 1)
        for node in h.members:
            texts = node.texts()
            s.links += node.links
            s.runs += len(texts)
            s.chars += sum(map(len, texts))
        total += max(0, s.chars - s.links)
        slots.append(s)
        s.children = [Slot(c.key) for c in h.children]
        todo += zip(h.children, s.children)
    for s in slots:
        s.total = total
    return root


def merge(into: Slot, other: Slot, room: list[int]) -> None:
    """Fold one wrapper into another: aligned nodes add up, the rest is put in at its place while there is room."""
    todo, known = [(into, other)], {}
    while todo:
        to, new = todo.pop()
        for count in ("pages", "chars", "links", "runs", "total", "many"):
            setattr(to, count, getattr(to, count) + getattr(new, count))
        if not new.children:
            continue
        pairs = match(to.children, new.children, known)
        found = {j: to.children[i] for i, j in pairs}
        todo += [(s, new.children[j]) for j, s in found.items()]
        if len(found) == len(new.children):
            continue
        row, at = list(to.children), 0
        for j, child in enumerate(new.children):
            if j in found:
                at = next(i for i in range(at, len(row)) if row[i] is found[j]) + 1
            elif (size := tree_size(child)) <= room[0]:
                room[0] -= size
                row.insert(at, child)
                at += 1
        to.children = row


def weigh(wrapper: Slot) -> None:
    """``varying`` of each node: the text outside links and templates of it and all below it, over all pages."""
    nodes = list(wrapper.nodes())
    for s in nodes:
        s.varying = max(0, s.chars - s.fixed_chars - s.links)
    order = {id(s): s for s in nodes}
    above = {id(c): s for s in nodes for c in s.children}
    for s in reversed(nodes):  # children come after their node
        if (up := above.get(id(s))) is not None:
            order[id(up)].varying += s.varying


def _is_noise(s: Slot) -> bool:
    names = " ".join(re.split("[.#]", s.key)[1:])
    return s.tag in NOISE_TAGS or s.tag == "header" or s.tag not in CONTENT_TAGS and s.tag not in ("body", "html") and meaning(names) == "noise"


def content_roots(wrapper: Slot) -> list[Slot]:
    """The article region of a host's wrapper, from the root down.

    A node's share is its part of the varying text of the pages that have it. The region goes on into
    the children with a share of at least REGION_SHARE, where an ``article`` or ``main`` below counts
    MEANING times and an element or name of what surrounds articles one MEANING-th, and takes varying
    headings before them and further large parts along. It ends where no child is large enough.
    """
    weigh(wrapper)
    fixed = sum(s.fixed_chars for s in wrapper.nodes())
    holds, found = {}, []
    for s in reversed(list(wrapper.nodes())):
        holds[id(s)] = not _is_noise(s) and (s.tag in CONTENT_TAGS or any(holds[id(c)] for c in s.children))

    def share(s: Slot) -> float:
        return s.varying / max(1.0, s.varying, s.total - fixed * s.pages / max(1, wrapper.pages))

    todo = [wrapper]
    while todo:
        s = todo.pop()
        if s.tag in CONTENT_TAGS:
            found.append(s)
            continue
        kids = [c for c in s.children if c.tag in CONTAINERS]
        noise = {id(c) for c in kids if _is_noise(c)}
        large = [c for c in kids if share(c) * (1 / MEANING if id(c) in noise else MEANING if holds[id(c)] else 1) >= REGION_SHARE]
        if marked := [c for c in large if holds[id(c)]]:
            large = marked
        if not large:  # a name may be wrong where nearly all varying text stands under it
            large = [c for c in kids if share(c) >= REGION_SHARE and c.pages >= LEAST_PAGES and c.tag not in ("footer", "nav", "aside")]
        if not large:
            found.append(s)
            continue
        first = min(i for i, c in enumerate(s.children) if any(c is x for x in large))
        for i, c in enumerate(s.children):
            if any(c is x for x in large):
                todo.append(c)
            elif i < first and c.tag in HEADINGS and c.varying and not _is_noise(c) or not marked and id(c) not in noise and c.tag in CONTAINERS and share(c) >= PART_SHARE:
                found.append(c)
    return found


def align(g: Group, s: Slot | None, number: int = 0) -> Iterator[tuple[Group, Slot | None, int]]:
    """The nodes of a page with those of the wrapper they stand for, and their numbers.

    A node outside the wrapper has none, and a number made of that of the node above and its key.
    """
    todo, known = [(g, s, number)], {}
    while todo:
        g, s, number = todo.pop()
        yield g, s, number
        to = dict(match(g.children, s.children, known)) if s else {}
        for i, child in enumerate(g.children):
            at = s.children[to[i]] if i in to else None
            todo.append((child, at, at.number if at else text_hash(f"{number}/{child.key}")))


def article_hash(root: Node) -> int:
    """Pages of one article have the same: that of the text of the ``article`` and ``main`` elements, or else of the page."""
    for named in (True, False):
        out: list[str] = []
        todo = [(root, not named)]
        while todo:
            node, inside = todo.pop()
            inside = inside or node.tag in CONTENT_TAGS
            if inside:
                out += node.texts()
            todo += [(child, inside) for child in node.blocks()[::-1] if not child.noise]
        if out:
            break
    return text_hash("\n".join(out))


def page_texts(root: Node, wrapper: Slot) -> dict[tuple[int, int], int]:
    """Characters of every text by its wrapper node, and under text 0 each node that the page has."""
    out: dict[tuple[int, int], int] = {}
    for g, _, number in align(Group([root]), wrapper):
        out[number, 0] = 0
        for node in g.members:
            for text in node.texts():
                at = number, text_hash(text)
                out[at] = out.get(at, 0) + len(text)
    return out


def surrounds(node: Node, s: Slot | None) -> bool:
    """Whether a node whose name leaves it open is no part of the article: few words a text, many links, or a repeated item each.

    The texts of all pages of the wrapper's node decide, or those of the page if it is alone.
    """
    chars, links, runs, items = 0, 0, 0, 0
    if s is not None and s.pages >= LEAST_PAGES:
        for x in s.nodes():
            chars, links, runs = chars + x.chars, links + x.links, runs + x.runs
        items = max((x.chars + sum(c.chars for c in x.nodes()) for x in s.children if 2 * x.many >= x.pages and (x.tag in CONTAINERS or x.tag == "li")), default=0)
    else:
        repeated: dict[str, list[int]] = {}
        for x in node.below():
            texts = x.texts()
            chars, links, runs = chars + sum(map(len, texts)), links + x.links, runs + len(texts)
        for x in node.blocks():
            if x.tag in CONTAINERS or x.tag == "li":
                repeated.setdefault(x.key, []).append(sum(len(t) for y in x.below() for t in y.texts()))
        items = max((sum(v) for v in repeated.values() if len(v) > 1), default=0)
    return chars < 40 * runs or 2 * links >= chars or 2 * items >= chars


def extract(page: str | None, wrapper: Slot | None) -> str:
    """Text of the slots of the article region of one page; without a wrapper, of all that is not named as surrounding an article."""
    root = parse(page or "")
    skip: dict[int, set[int]] = {}
    stands: dict[int, Slot] = {}
    regions: set[int] = set()
    if wrapper is not None:
        if wrapper.regions is None:
            wrapper.regions = {id(r): r for r in content_roots(wrapper)}
        roots = wrapper.regions
        own: set[int] = set()
        named = True
        for g, s, number in align(Group([root]), wrapper):
            if s is not None:
                stands |= dict.fromkeys(map(id, g.members), s)
            if id(s) in roots and s is not wrapper:
                regions |= set(map(id, g.members))
                named = named and s.tag in CONTENT_TAGS
            elif s is None and g.members[0].tag in CONTENT_TAGS:
                own |= set(map(id, g.members))
            if fixed := s.template if s else wrapper.loose.get(number):
                skip |= dict.fromkeys(map(id, g.members), fixed)
        # Articles outside the wrapper count with its own, and before a region found by its text.
        own = {id(x) for x in _outside_noise(root) if id(x) in own}
        regions = (regions | own if named else own) if own else regions
    out: list[str] = []

    def emit(top: Node) -> None:
        todo: list = [top]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                text, fixed = x
                if not (fixed and text_hash(text) in fixed):
                    out.append(text)
                continue
            fixed, run, row = skip.get(id(x)), [], []
            for item in [*x.items, None]:
                if isinstance(item, str):
                    run.append(item)
                    continue
                if run and (text := " ".join("".join(run).split())):
                    row.append((text, fixed))
                run = []
                if item is not None and not item.noise and not (item.unsure and surrounds(item, stands.get(id(item)))):
                    row.append(item)
            todo += row[::-1]

    if regions:
        todo = [root]
        while todo:
            node = todo.pop()
            if id(node) in regions:
                emit(node)
            else:
                todo += node.blocks()[::-1]
    else:
        emit(root)
    if not out:  # a page whose article stands in a container that is named like noise
        todo = [root]
        while todo:
            node = todo.pop()
            if node.tag in CONTENT_TAGS:
                emit(node)
            else:
                todo += node.blocks()[::-1]
    return "\n".join(out)


def _outside_noise(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        if not node.noise:
            yield node
            todo += node.blocks()


def page_wrapper(page: str | None) -> Slot:
    """The wrapper of one page."""
    return as_slot(Group([parse(page or "")]))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    have: dict[str, tuple[Slot, list[int]]] = {}

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(have), pa.string()), pa.array([json.dumps(s.dump()) for s, _ in have.values()], pa.string())], ["host", "wrapper"])

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            new = page_wrapper(page)
            if host in have:
                merge(have[host][0], new, have[host][1])
            else:
                have[host] = (new, [MOST_NODES])
        if len(have) > 2000:
            yield flush()
            have.clear()
    if have:
        yield flush()


def _merge_all(pdf: pd.DataFrame) -> pd.DataFrame:
    """Wrappers of one host, in a fixed order, into one."""
    first, *rest = [Slot.load(json.loads(w)) for w in sorted(pdf["wrapper"])]
    room = [max(0, MOST_NODES - tree_size(first))]
    for s in rest:
        merge(first, s, room)
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(first.dump())]})


def merged(parts: DataFrame) -> DataFrame:
    """One wrapper a host: rounds in which a task merges about FAN_IN, until each host has one."""
    while True:
        counts = parts.groupBy("host").agg(F.count("*").alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= 1:
            return parts
        salt = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / FAN_IN)).alias("salt")
        parts = scratch(parts.join(counts, "host").select("host", "wrapper", salt).groupBy("host", "salt").applyInPandas(_merge_all, "host string, wrapper string"), "wrappers")


class Wrappers:
    """Wrappers read from their dumps, each once while it is in use."""

    def __init__(self):
        self.seen: dict[tuple, Slot] = {}

    def get(self, dump: str | None, template: str | None = None) -> Slot | None:
        if dump is None:
            return None
        at = dump, template
        if at not in self.seen:
            if len(self.seen) > 500:
                self.seen.clear()
            out = self.seen[at] = Slot.load(json.loads(dump))
            nodes = list(out.nodes())
            for x in json.loads(template or "[]"):
                if 0 <= x["node"] < len(nodes):
                    nodes[x["node"]].template.add(x["text"])
                    nodes[x["node"]].fixed_chars += x["chars"]
                else:
                    out.loose.setdefault(x["node"], set()).add(x["text"])
        return self.seen[at]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers = Wrappers()
    for batch in batches:
        rows = []
        for host, page, dump in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper"))):
            root = parse(page or "")
            article = article_hash(root)
            rows += [(host, article, *at, chars) for at, chars in page_texts(root, wrappers.get(dump)).items()]
        columns = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 4))], ["host", "article", "node", "text", "chars"])


def template_texts(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """For each host the texts, by node of its wrapper, that stand on at least TEMPLATE_SHARE of the pages with that node.

    Pages with the same article count as one, so that copies don't make its text a template.
    """
    texts = pages.join(wrappers, "host").mapInArrow(_count, "host string, article bigint, node bigint, text bigint, chars bigint")
    once = texts.groupBy("host", "node", "text", "article").agg(F.sum("chars").alias("chars"))
    counts = scratch(once.groupBy("host", "node", "text").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).where(F.col("n") >= LEAST_PAGES), "texts")
    having = counts.where("text = 0").select("host", "node", F.col("n").alias("pages"))
    fixed = counts.where("text <> 0").join(having, ["host", "node"]).where(F.col("n") >= TEMPLATE_SHARE * F.col("pages"))
    return fixed.groupBy("host").agg(F.to_json(F.array_sort(F.collect_list(F.struct("node", "text", "chars")))).alias("template"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers = Wrappers()
    for batch in batches:
        out = [extract(page, wrappers.get(dump, template)) for page, dump, template in zip(*(batch.column(c).to_pylist() for c in ("html", "wrapper", "template")))]
        yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(out, pa.string())], ["k", "text"])


def extract_main_text(df: DataFrame, url_col: str = "url", html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per input row: the columns of ``keep`` and ``text``.

    Null and empty pages give an empty text; null urls share one host. Repeated rows are extracted
    each. Pages of any length are taken whole. An empty table gives an empty result.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    pages = df.select(F.struct(*[F.col(c) for c in keep]).alias("k"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    wrappers = merged(scratch(pages.select("host", "html").mapInArrow(_fold, "host string, wrapper string"), "folds"))
    # Both sides are plain scans, so that a host with very many pages can be split.
    template = scratch(wrappers.join(template_texts(pages.select("host", "html"), wrappers), "host", "left"), "template")
    joined = pages.join(template, "host", "left").select("k", "html", "wrapper", "template")
    out = joined.mapInArrow(_extract, f"k {joined.schema['k'].dataType.simpleString()}, text string")
    return out.select(*[F.col("k")[c].alias(c) for c in keep], "text")
