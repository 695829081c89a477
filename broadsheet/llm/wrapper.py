"""Main text of web pages by wrapper induction.

Pages become trees of their block elements; siblings with one label (tag, classes, id) are one list node. Pages with
the same tree have one form. All forms of a host are aligned by simple tree matching into one wrapper tree, whose nodes
know on how many pages they stand, how much text and how much of it in links they hold. A text that stands at one place
(the labels from the root) on CONSTANT of the pages that have the place is template; how often each text stands at each
place is counted exactly.

What varies are slots, and slots that hold running text are content (`chosen`): from the root, the way goes down to
the child with the most varying text outside of links that a page of the host is expected to have there, as long as
one holds more than what stands beside it. What stands beside it, such as comments or adverts, is left out unless it
holds half as much. A list of records, elements of one label that have parts of their own, weighs as much as the root of their
expected number of them, so that many comments or teasers don't outweigh one text. Elements that say what they are (nav,
footer and so on) hold no content, nor do forms, unless they hold half of the page's running text; then only their controls go. Names of
classes shift these weights, and leave out parts that are called adverts, comments and so on, if all of a name says so ("side-effects"
doesn't) and its node holds less than half of the page. Lists of links are left out, but not within an article.

Spark sums up the forms of a host and the texts of a place. Forms are folded into wrappers in groups of about FAN by
their hash, in a fixed order, until one is left for a host, so that no task sees all of a large host and the result
doesn't depend on how pages are dealt. Nodes on under RARE of a wrapper's pages are left out of it: they are judged by
the page they stand on. Wrappers are sent to all tasks if their size, which is looked up, is small; else pages are
shuffled to meet the wrapper of their host, those of a large host in many tasks.

Defined cases
-------------
* null or empty html, and pages without text: empty text. Broken markup is read as browsers do, roughly: unclosed and
  unopened elements are closed where their block ends. Elements may be nested to any depth.
* null url, or one without a host: such pages form one host.
* a text is template from LEAST_PAGES pages of its place on. Copies of an article on one host: if constant texts are
  over half of what a page's content would be, they stay.
* repeated rows count as pages of their own, and each gets its text. An empty table gives an empty result.
* extra columns are ignored. A host with one page is told by that page's own weights.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import keep

#: Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " select summary table tbody td tfoot th thead tr ul caption button label".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table td th div section article aside main nav body blockquote".split())
NOT_TEXT = frozenset("head nav footer aside button select label dialog menu search option".split())
FORMS = frozenset("form fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset("html body div section article main center table tbody tr td details header form fieldset".split())
NOT_TEXT_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promos promotion promoted"
    " cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login"
    " share sharing social comment comments commentlist disqus reply replies respond discussion sidebar side widget widgets related"
    " recommended recommendations trending popular breadcrumb breadcrumbs menu menus nav navbar navigation footer masthead topbar"
    " pagination pager toolbar search copyright legal skip hidden".split()
)
#: Parts of names that say nothing about the part of the page.
NEUTRAL = frozenset(
    "a area bar block bottom box btn button buttons cell center col column container entry float foot form frame global grid group head header holder icon icons"
    " inner item items layout left level line link links list lists main message messages mini module new outer page panel part post primary right row section"
    " site slot small sticky strip tab table text title toggle top unit view wrap wrapper zone".split()
)
ARTICLE_CLASSES = frozenset("article articlebody story storybody post postbody entry entrycontent maincontent main content".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_VALUE = re.compile(r"=\s*([\"'])|>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_SPACE = re.compile(r"[\s ]+")
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ODD = re.compile(r"[^a-z0-9-]")

#: Share of the pages with a place from which on a text at it is template, and the fewest such pages.
CONSTANT, LEAST_PAGES = 0.8, 3
#: Wrappers folded together at a time, about; the share of a wrapper's pages that its nodes stand on at least.
FAN, RARE = 256, 1 / 2000
#: A host with over 1 / PARTS of all pages is dealt over several tasks; so there are PARTS such hosts at most.
PARTS = 1000
#: What stands beside the main part needs this share of its weight to be content too.
BESIDE = 0.5
#: How names shift a node's weight in the choice of the main part: elements and classes for articles, classes for other parts.
ARTICLE_TAG, ARTICLE_NAME, OTHER_NAME = 3.0, 1.5, 0.1
#: Bytes of wrappers, about, that are sent to all executors. Beyond that, pages are shuffled by host to meet them.
MOST_SENT = 16_000_000
#: Texts that a task counts before it hands them on.
MOST_COUNTED = 1 << 18


# --- pages -----------------------------------------------------------------------------------------------------------


class Page:
    """labels, parents and numbers of its block elements, in the order they begin; blocks: node, text, characters of it in links."""

    def __init__(self):
        self.labels, self.parents, self.items, self.known = ["html"], [-1], [1], {}
        self.blocks: list[tuple[int, str, int]] = []

    def child(self, parent: int, label: str) -> int:
        """The node of all children of one label."""
        node = self.known.setdefault((parent, label), len(self.labels))
        if node == len(self.labels):
            self.labels.append(label)
            self.parents.append(parent)
            self.items.append(0)
        self.items[node] += 1
        return node

    def form(self) -> tuple[str, list[int]]:
        """A line per node, depth and label, from the root down; and the line of each node."""
        children: list[list[int]] = [[] for _ in self.labels]
        for node, parent in enumerate(self.parents[1:], 1):
            children[parent].append(node)
        lines, place, stack = [], [0] * len(self.labels), [(0, 0)]
        while stack:
            node, depth = stack.pop()
            place[node] = len(lines)
            lines.append(f"{depth} {self.labels[node]}")
            stack += [(c, depth + 1) for c in reversed(children[node])]
        return "\n".join(lines), place

    def places(self, host: str) -> list[int]:
        """A hash of the host and the labels down to each node."""
        out = [_hash(host.encode("utf-8", "surrogatepass"))]
        for label, parent in zip(self.labels[1:], self.parents[1:]):
            out.append(_hash(out[parent].to_bytes(8, "little", signed=True) + label.encode("utf-8", "surrogatepass")))
        return out


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def text_key(text: str) -> int:
    return _hash(text.encode("utf-8", "surrogatepass"))


def _label(tag: str, attributes: str) -> str:
    tag = _ODD.sub("-", tag)
    if not attributes.strip():
        return tag
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return f"{tag}.hidden"
    names = " ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop"))
    pieces = sorted({p.lower() for p in _PIECES.findall(names)})
    return ".".join([tag, *pieces, *([OUT] if any(map(_says_out, names.split())) else [])])


#: Marks the label of an element one of whose names says that it is no content.
OUT = "!"


def _says_out(name: str) -> bool:
    pieces = {p.lower() for p in _PIECES.findall(name)}
    return bool(pieces & NOT_TEXT_CLASSES) and pieces <= NOT_TEXT_CLASSES | NEUTRAL


class _Tags:
    """Where tags end. Every character is gone over a fixed number of times, whatever quotes are left open."""

    def __init__(self, source: str):
        self.source, self.plain = source, 0  # up to `plain`, quotes aren't believed: one of them stays open

    def end(self, at: int) -> int:
        """The place behind the tag whose name ends at `at`; -1 if it has no end."""
        source, place = self.source, at
        while place >= self.plain and (m := _VALUE.search(source, place)):
            if m[1] is None:
                return m.end()
            close = source.find(m[1], m.end())
            if close < 0:
                self.plain = m.end()
                break
            place = close + 1
        return source.find(">", at) + 1 or -1


def read_page(source: str) -> Page:
    page, tags = Page(), _Tags(source)
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements, each with the block it is in
    opened: Counter = Counter()
    text: list[str] = []
    link_chars = node = 0

    def flush() -> None:
        nonlocal text, link_chars
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                page.blocks.append((node, whole, min(link_chars, len(whole))))
        text, link_chars = [], 0

    def close(depth: int) -> None:
        nonlocal node
        for tag, _ in stack[depth:]:
            opened[tag] -= 1
        del stack[depth:]
        node = stack[-1][1]

    def add(piece: str) -> None:
        nonlocal link_chars
        text.append(piece)
        link_chars += len(piece) if opened["a"] else 0

    at, size = 0, len(source)
    last = source.rfind(">")
    while at < size:
        begin = source.find("<", at)
        if begin < 0 or begin > last:
            add(source[at:])
            break
        if begin > at:
            add(source[at:begin])
        if source.startswith("<!--", begin):
            at = source.find("-->", begin + 4) + 3
            at = size if at < 3 else at
            continue
        if source.startswith(("<!", "<?"), begin):
            at = source.find(">", begin) + 1
            continue
        closing = source.startswith("</", begin)
        name = _NAME.match(source, begin + 1 + closing)
        if name is None or (end := tags.end(name.end())) < 0:
            add("<")
            at = begin + 1
            continue
        tag, at = name[0].lower(), end
        if closing:
            if opened[tag] > 0:
                if tag in BLOCK:
                    flush()
                close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag))
            continue
        attributes = source[name.end() : end - 1]
        if tag in RAW:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(source, at)
                at = source.find(">", stop.end()) + 1 or size if stop else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            ends = CLOSES.get(tag, set()) | {"p"}
            depth = len(stack) - 1
            while depth and any(opened[t] > 0 for t in ends) and (stack[depth][0] in ends or stack[depth][0] not in SCOPES):
                if stack[depth][0] in ends:
                    close(depth)
                depth -= 1
            if tag == "html" or tag == "body" and opened["body"] > 0:
                continue
            node = page.child(stack[-1][1], _label(tag, attributes))
        stack.append((tag, node))
        opened[tag] += 1
    flush()
    return page


# --- wrappers --------------------------------------------------------------------------------------------------------


class Node:
    """A node of a wrapper: pages it stands on, characters of its own text, those of them in links, and its elements."""

    __slots__ = ("label", "children", "pages", "chars", "links", "items")

    def __init__(self, label: str, pages: int = 0, chars: int = 0, links: int = 0, items: int = 0):
        self.label, self.pages, self.chars, self.links, self.items = label, pages, chars, links, items
        self.children: list[Node] = []


def tree_of(form: str, pages: list[int], chars: list[int], links: list[int], items: list[int]) -> list[Node]:
    """The nodes of a form, a line each."""
    nodes, path = [], []
    for line, *numbers in zip(form.split("\n"), pages, chars, links, items):
        depth, label = line.split(" ", 1)
        node = Node(label, *map(int, numbers))
        del path[int(depth) :]
        if path:
            path[-1].children.append(node)
        path.append(node)
        nodes.append(node)
    return nodes


def form_of(root: Node, least: float = 0.0) -> tuple[str, list[int], list[int], list[int], list[int]]:
    """The form of a tree and its nodes' numbers, without nodes on fewer pages than `least`."""
    lines, pages, chars, links, items, stack = [], [], [], [], [], [(root, 0)]
    while stack:
        node, depth = stack.pop()
        lines.append(f"{depth} {node.label}")
        pages.append(node.pages)
        chars.append(node.chars)
        links.append(node.links)
        items.append(node.items)
        stack += [(c, depth + 1) for c in reversed(node.children) if c.pages >= least]
    return "\n".join(lines), pages, chars, links, items


def _best_chain(pairs: list[tuple[int, int, int]], weight: list[int], n: int) -> tuple[int, list[int]]:
    """The heaviest of the pairs (i, j, k) that rise in both i and j; pairs are in order of i, and of one i from the largest j; j < n.

    A tree over j keeps the best chain up to each j, so the time is the number of pairs times a logarithm.
    """
    tree, before = [(0, -1)] * (n + 1), [-1] * len(pairs)
    for at, (_, j, k) in enumerate(pairs):
        best, place = (0, -1), j
        while place:
            best = max(best, tree[place])
            place &= place - 1
        before[at] = best[1]
        here, place = (best[0] + weight[k], at), j + 1
        while place <= n:
            if tree[place] < here:
                tree[place] = here
            place += place & -place
    best, place = (0, -1), n
    while place:
        best = max(best, tree[place])
        place &= place - 1
    chain, at = [], best[1]
    while at >= 0:
        chain.append(pairs[at][2])
        at = before[at]
    return best[0], chain


def aligned(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: the pairs of nodes in the largest order-keeping match of two trees from their roots down."""
    pairs, below = [(a, b)], []
    for x, y in pairs:  # grows
        by_label: dict[str, list[int]] = {}
        for j, d in enumerate(y.children):
            by_label.setdefault(d.label, []).append(j)
        own = []
        for i, c in enumerate(x.children):
            for j in reversed(by_label.get(c.label, ())):
                own.append((i, j, len(pairs)))
                pairs.append((c, y.children[j]))
        below.append(own)
    size, chains = [0] * len(pairs), [[]] * len(pairs)
    for k in range(len(pairs) - 1, -1, -1):
        best, chains[k] = _best_chain(below[k], size, len(pairs[k][1].children)) if below[k] else (0, [])
        size[k] = 1 + best
    out, open_ = [], [0]
    while open_:
        k = open_.pop()
        out.append(pairs[k])
        open_ += chains[k]
    return out


def merge(root: Node, other: Node) -> None:
    """Aligns another tree with a wrapper, adds its numbers, and inserts what has no partner beside its neighbours' partners."""
    partner = {id(b): a for a, b in aligned(root, other)}
    stack = [other]
    while stack:
        node = stack.pop()
        here = partner[id(node)]
        here.pages += node.pages
        here.chars += node.chars
        here.links += node.links
        here.items += node.items
        place = {id(x): k for k, x in enumerate(here.children)}
        added: list[list[Node]] = [[] for _ in range(len(here.children) + 1)]
        before = 0  # partners rise in both trees
        for child in node.children:
            if (own := partner.get(id(child))) is None:
                own = partner[id(child)] = Node(child.label)
                added[before].append(own)
            else:
                before = place[id(own)] + 1
        here.children = [x for k, news in enumerate(added) for x in (*news, *here.children[k : k + 1])]
        stack += node.children


# --- content ---------------------------------------------------------------------------------------------------------


class Content:
    """What a host's wrapper and template texts say about its pages."""

    def __init__(self, wrapper: list | None, constant: dict[tuple[int, int], int]):
        """wrapper: form, pages, chars, links, items; constant: (place, text) -> characters."""
        self.root = tree_of(*wrapper)[0] if wrapper else Node("html")
        self.constant, self.fixed = constant, Counter()
        for (place, _), n in constant.items():
            self.fixed[place] += n
        self.seen: dict[str, list[Node | None]] = {}

    def _slots(self, form: str) -> list[Node | None]:
        if (known := self.seen.get(form)) is None:
            n = form.count("\n") + 1
            own = tree_of(form, *[[0] * n] * 4)
            partner = {id(b): a for a, b in aligned(self.root, own[0])}
            known = [partner.get(id(x)) for x in own]
            if len(self.seen) >= 1000:
                self.seen.clear()
            self.seen[form] = known
        return known

    def text(self, page: Page, host: str) -> str:
        if not page.blocks:
            return ""
        form, line = page.form()
        slots = self._slots(form)
        places = page.places(host)
        chars, links, fixed = ([0.0] * len(line) for _ in range(3))
        items = [float(x) for x in page.items]
        for node, text, linked in page.blocks:
            chars[node] += len(text)
            links[node] += linked
        for node in range(len(line)):
            if (slot := slots[line[node]]) is not None and slot.pages:
                chars[node], links[node], items[node] = (x / slot.pages for x in (slot.chars, slot.links, slot.items))
            fixed[node] = min(chars[node], self.fixed[places[node]])
        good = chosen(page, chars, links, fixed, items)
        found = [(text, (places[node], text_key(text)) in self.constant) for k, (node, text, _) in enumerate(page.blocks) if good[k]]
        if 2 * sum(len(text) for text, is_fixed in found if is_fixed) <= sum(len(text) for text, _ in found):
            found = [x for x in found if not x[1]]
        return " ".join(text for text, _ in found)


def _sums(parents: list[int], own: list[float]) -> list[float]:
    """Of each node and all below it; parents come before their children."""
    out = list(own)
    for node in range(len(out) - 1, 0, -1):
        out[parents[node]] += out[node]
    return out


def chosen(page: Page, chars: list[float], links: list[float], fixed: list[float], items: list[float]) -> list[bool]:
    """Which blocks are content. Of each node, what is expected: chars and those in links; fixed, those of template texts; items, its elements."""
    parents, n = page.parents, len(page.labels)
    split = [label.split(".") for label in page.labels]
    prose = [max(c - f, 0.0) * max(0.0, 1 - 2 * k / c) if c else 0.0 for c, k, f in zip(chars, links, fixed)]
    if not any(prose):  # all is template: copies of one page
        prose = [c * max(0.0, 1 - 2 * k / c) if c else 0.0 for c, k in zip(chars, links)]
    # Elements that hold no content; a page's header, but not an article's.
    gone, article = [False] * n, [False] * n
    for forms in (False, True):  # a form is judged by what is left when the others are gone
        below = _sums(parents, prose)
        for node in range(n):
            tag, up = split[node][0], parents[node]
            article[node] = tag in ("article", "main") or up >= 0 and article[up]
            gone[node] |= up >= 0 and gone[up] or tag in NOT_TEXT or tag == "header" and not article[node]
            gone[node] |= forms and tag in FORMS and 2 * below[node] < below[0]
            if gone[node]:
                prose[node] = 0.0
    below = _sums(parents, prose)
    all_chars, all_links = _sums(parents, chars), _sums(parents, links)
    factor = [1.0] * n
    for node in range(1, n):
        tag, *names = split[node]
        factor[node] = factor[parents[node]]
        named = OUT in names or "hidden" in names or "header" in names and not article[node]
        if named and 2 * below[node] < below[0]:
            gone[node], factor[node] = True, factor[node] * OTHER_NAME
        elif tag in ("article", "main"):
            factor[node] = max(factor[node], ARTICLE_TAG)
        elif tag != "body" and ARTICLE_CLASSES.intersection(names):
            factor[node] = max(factor[node], ARTICLE_NAME)
        listed = tag in CONTAINERS or tag in ("ul", "ol", "dl")
        gone[node] |= gone[parents[node]] or listed and not article[node] and 2 * all_links[node] > all_chars[node] > 0
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(1, n):
        children[parents[node]].append(node)
    share = [1.0] * n
    for node in range(1, n):
        record = children[node] and (split[node][0] in CONTAINERS or split[node][0] == "li")
        share[node] = share[parents[node]] / (max(items[node], 1.0) ** 0.5 if record else 1.0)
    weight = [p * f * x for p, f, x in zip(prose, factor, share)]
    below = _sums(parents, weight)

    # Down to the main part; `beside` are the headings and equals of it that stay.
    here, beside, semantic = 0, [], False
    while True:
        inner = [c for c in children[here] if split[c][0] in CONTAINERS]
        best = max(inner, key=lambda c: below[c], default=None)
        direct = weight[here] + sum(below[c] for c in children[here] if c not in inner)
        if best is None or below[best] <= direct:
            break
        equals = [c for c in children[here] if c != best and below[c] >= BESIDE * below[best] and factor[c] >= factor[best]]
        if any(c in inner for c in equals):
            beside += [c for c in inner if c == best or c in equals]
            break
        semantic |= split[best][0] in ("article", "main")
        beside += equals
        beside += [c for c in children[here] if split[c][0] in HEADINGS and not semantic]
        here = best
    several = bool(beside) and parents[beside[-1]] == here and split[beside[-1]][0] in CONTAINERS

    # The part of the content that each node is in: `here` itself, one of its children, or one of `beside`.
    part = [-1] * n
    stays = set(beside)
    for node in range(n):
        up = parents[node]
        if node == here or node in stays or up >= 0 and part[up] == here:
            part[node] = node
        elif up >= 0:
            part[node] = part[up]
    if several:
        return [not gone[node] and (part[node] in stays or split[part[node]][0] in HEADINGS if part[node] >= 0 else False) for node, _, _ in page.blocks]
    plain = [part[node] >= 0 and (part[node] == here or split[part[node]][0] not in CONTAINERS) and not gone[node] for node, _, _ in page.blocks]
    at = [k for k, x in enumerate(plain) if x]
    first, last = (at[0], at[-1]) if at else (0, -1)
    out = []
    for k, (node, _, _) in enumerate(page.blocks):
        good = part[node] >= 0 and not gone[node]
        if good and not plain[k] and part[node] not in stays and not semantic and not article[here]:
            # A part before or behind the text needs weight of its own.
            good = first < k < last or below[part[node]] >= BESIDE * direct
        out.append(good)
    return out


# --- Spark -----------------------------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


_PARTS = "host string, form string, pages long, chars array<long>, links array<long>, items array<long>, places array<long>, texts array<long>, sizes array<int>, counts array<long>"


def _read(pages: DataFrame) -> DataFrame:
    """pages(host, html) -> rows of two kinds, each summed up by task: forms with their numbers, and texts by place.

    A text of key 0 and size -1 stands for the place itself, once a page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms: dict[tuple[str, str], list] = {}
        texts: dict[str, dict[tuple[int, int, int], int]] = {}
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(host, form, *x, None, None, None, None) for (host, form), x in forms.items()]
            for host, own in texts.items():
                rows.append((host, None, 0, None, None, None, *([k[i] for k in own] for i in range(3)), list(own.values())))
            for lo in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[lo : lo + 1000]], t) for i, t in enumerate(_ARROW.types)], schema=_ARROW)

        for batch in batches:
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = read_page(source.as_py() or "")
                form, line = page.form()
                own = forms.setdefault((host, form), [0, *([0] * len(line) for _ in range(3))])
                own[0] += 1
                for node, n in enumerate(page.items):
                    own[3][line[node]] += n
                places, found = page.places(host), set()
                for node, text, links in page.blocks:
                    own[1][line[node]] += len(text)
                    own[2][line[node]] += links
                    found |= {(places[node], text_key(text), len(text)), (places[node], 0, -1)}
                counts = texts.setdefault(host, {})
                for key in found:
                    counts[key] = counts.get(key, 0) + 1
                count += len(found)
            if count > MOST_COUNTED:
                yield from out()
                forms, texts, count = {}, {}, 0
        yield from out()

    return pages.select("host", "html").mapInArrow(run, _PARTS)


_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema([
    ("host", pa.string()), ("form", pa.string()), ("pages", pa.int64()), ("chars", _LONGS), ("links", _LONGS), ("items", _LONGS),
    ("places", _LONGS), ("texts", _LONGS), ("sizes", pa.list_(pa.int32())), ("counts", _LONGS),
])

_NUMBERS = ("form", "pages", "chars", "links", "items")
_WRAPPERS = "host string, form string, pages array<long>, chars array<long>, links array<long>, items array<long>"


def wrappers(parts: DataFrame) -> DataFrame:
    """host, form, pages, chars, links, items (numbers by node): the wrapper of each host."""
    rows = parts.filter("form is not null").withColumn("id", F.xxhash64("form"))
    numbers = rows.select("host", "id", "pages", F.posexplode(F.arrays_zip("chars", "links", "items")).alias("at", "x"))
    numbers = numbers.groupBy("host", "id", "at").agg(F.sum("pages").alias("pages"), *[F.sum(f"x.{c}").alias(c) for c in _NUMBERS[2:]])
    numbers = numbers.groupBy("host", "id").agg(F.array_sort(F.collect_list(F.struct("at", *_NUMBERS[1:]))).alias("x"))  # a row a node
    forms = rows.groupBy("host", "id").agg(F.min("form").alias("form"))
    found = keep(forms.join(numbers, ["host", "id"]).select("host", "form", *[f"x.{c}" for c in _NUMBERS[1:]]), "forms")

    def folded(frame: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(frame)), key=lambda k: (-int(frame["pages"].iloc[k][0]), frame["form"].iloc[k]))
        trees = (tree_of(*(frame[c].iloc[k] for c in _NUMBERS))[0] for k in order)
        root = next(trees)
        for tree in trees:
            merge(root, tree)
        form, *numbers = form_of(root, RARE * root.pages)
        return pd.DataFrame({"host": frame["host"].iloc[:1].to_numpy(), "form": [form]} | {c: [x] for c, x in zip(_NUMBERS[1:], numbers)})

    while True:
        sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return found
        if most <= FAN:
            return keep(found.groupBy("host").applyInPandas(folded, _WRAPPERS), "wrappers")
        group = F.pmod(F.xxhash64("form"), F.ceil(F.col("n") / FAN))
        found = keep(found.join(sizes, "host").withColumn("group", group).groupBy("host", "group").applyInPandas(folded, _WRAPPERS), "wrappers")


def template_texts(parts: DataFrame) -> DataFrame:
    """host, constant (place, text, size): the texts that stand at a place on most of its pages."""
    rows = parts.filter("places is not null").select("host", F.inline(F.arrays_zip("places", "texts", "sizes", "counts")))
    counted = rows.groupBy("host", "places", "texts", "sizes").agg(F.sum("counts").alias("n")).filter(F.col("n") >= LEAST_PAGES)
    counted = keep(counted, "texts")
    pages = counted.filter("sizes < 0").select("host", "places", F.col("n").alias("pages"))
    fixed = counted.filter("sizes >= 0").join(pages, ["host", "places"]).filter(F.col("n") >= CONSTANT * F.col("pages"))
    # At most the texts of a page / CONSTANT for each place.
    return fixed.groupBy("host").agg(F.collect_list(F.struct("places", "texts", "sizes")).alias("constant"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text: a row per page."""
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    parts = keep(_read(pages), "page-forms")
    hosts = keep(wrappers(parts).join(template_texts(parts), "host", "left"), "host-wrappers")
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string"
    size = F.coalesce(F.length("host"), F.lit(0)) + F.length("form") + 32 * F.size("pages") + 24 * F.greatest(F.size("constant"), F.lit(0))
    if (hosts.agg(F.sum(size)).first()[0] or 0) <= MOST_SENT:
        found = {r["host"]: ([r[c] for c in _NUMBERS], {(x["places"], x["texts"]): x["sizes"] for x in r["constant"] or ()}) for r in hosts.collect()}
        held = pages.sparkSession.sparkContext.broadcast(found)  # at most some times MOST_SENT

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: dict[str, Content] = {}
            for batch in batches:
                texts = []
                for host, source in zip(batch.column(0).to_pylist(), batch.column(3)):
                    if host not in own:
                        if len(own) > 1000:
                            own.clear()
                        own[host] = Content(*held.value.get(host, (None, {})))
                    texts.append(own[host].text(read_page(source.as_py() or ""), host))
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

        return pages.select("host", "page_id", "url", "html").mapInArrow(sent, schema)

    total = hosts.agg(F.sum(F.get("pages", F.lit(0)))).first()[0] or 0
    large = hosts.select(F.col("host").alias("h_"), F.ceil(F.get("pages", F.lit(0)) * F.lit(PARTS / max(total, 1))).alias("deals")).filter("deals > 1")
    large = F.broadcast(large)  # at most PARTS rows
    deals = F.coalesce("deals", F.lit(1))
    rows = pages.join(large, F.col("host") == F.col("h_"), "left").select(
        "host", F.pmod(F.xxhash64("html", "page_id"), deals).alias("deal"), F.lit(True).alias("is_page"), "page_id", "url", "html"
    )
    known = hosts.join(large, F.col("host") == F.col("h_"), "left").select(
        "host", F.explode(F.sequence(F.lit(0).cast("long"), deals - 1)).alias("deal"), F.lit(False).alias("is_page"), *_NUMBERS, "constant"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, host = Content(None, {}), None
        for batch in batches:
            is_page = batch.column(1).to_pylist()
            hosts_, sources, texts = batch.column(0).to_pylist(), batch.column(4), []
            for i, page in enumerate(is_page):
                if not page:
                    wrapper = [batch.column(k)[i].as_py() for k in range(5, 10)]
                    content, host = Content(wrapper, {(x["places"], x["texts"]): x["sizes"] for x in batch.column(10)[i].as_py() or ()}), hosts_[i]
                    continue
                if hosts_[i] != host:
                    content, host = Content(None, {}), hosts_[i]
                texts.append(content.text(read_page(sources[i].as_py() or ""), host))
            mask = batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(2).filter(mask), batch.column(3).filter(mask), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    both = rows.unionByName(known, allowMissingColumns=True)
    both = both.repartition("host", "deal").sortWithinPartitions("host", "deal", "is_page")
    both = both.select("host", "is_page", "page_id", "url", "html", *_NUMBERS, "constant")
    return both.mapInArrow(run, schema)
