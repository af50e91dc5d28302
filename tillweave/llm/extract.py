"""Main text of web pages by wrapper induction over the pages of a host.

Every page becomes a tree of slots: siblings that repeat a label one after another are
one slot. The centre of a host is its most frequent tree of labels. Every page is aligned
with the centre by simple tree matching, each on its own; what finds no partner there is
told by its label. Slots are then counted natively by host and place: on how many pages
they occur, whether their text is always the same, how much there is, and which blocks of
text they hold on how many pages. Counts, sums, minima and maxima know no order, so the
result depends neither on the order of pages nor on how they are dealt to tasks, and no
group of pages is ever gathered. From the counts comes the template, and from it the
wrapper: the node that holds the article (a landmark, or where the varying text sits),
constant nodes and constant blocks among others (template), varying slots (content), and
regions that are no article whatever they say. A page is then aligned with its host's
wrapper and gives the text of its content slots.

A host may have several layouts. Pages with a landmark and pages without have a template
each. Without a landmark, containers of which every page has one are places of an article
each; a page that has none of them gives the place that holds most of its own text which
the template does not know as constant.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .steps import Steps

#: Wrappers and centres a task remembers, and rows it makes before it hands them on.
HOSTS, ROWS = 2000, 50_000
#: Pages that must agree on a text inside the article before it counts as template.
SUPPORT = 8
#: Pages that must hold a block of text, and their share of all pages with the article, before a block
#: that looks like its neighbours counts as template.
LINES, MOST = 16, 0.9
#: Slots and blocks on less than one page of so many of a layout are left out of its template, whose size this bounds.
RARE = 1000
#: Children up to which order counts in the alignment; longer lists are repetitions, told by label.
ORDERED = 32

# --- fixed values: names of HTML elements, and words that mark regions which are no article
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
CLOSES_P = BLOCK - frozenset("body caption html legend li tbody td tfoot th thead tr dd dt".split())
APART = frozenset("nav footer aside form script style noscript template iframe button select input textarea label option head title menu dialog svg math object embed canvas".split())
MARKS = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner cookie cookies consent notice notices gdpr "
                   "newsletter subscribe subscription signup popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination "
                   "footer comment comments disqus reply replies share sharing social related recommended widget skip login search toolbar").split())
REMARK = frozenset("comment reply".split())
TOP_MARKS = frozenset("header masthead topbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>\"']|$)", re.I)
_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """An element: tag, label (tag and marking words), whether it is apart from any article, texts and elements in order."""

    __slots__ = ("tag", "label", "apart", "main", "parts")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.label, self.parts = tag, tag, []
        self.apart, self.main = tag in APART, tag in ("article", "main")
        if tag == "header":
            self.apart = None  # apart unless inside an article
        if "=" in attributes or "hidden" in attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if name in ("class", "id"):
                    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower())
                    self.label += f"{'.' if name == 'class' else '#'}{' '.join(words)}"
                    if tag in ("html", "body") or self.main:
                        if REMARK.intersection(words):
                            self.apart, self.main = True, False
                        continue
                    if MARKS.intersection(words):
                        self.apart = True
                    elif TOP_MARKS.intersection(words) and self.apart is False:
                        self.apart = None
                elif name == "role":
                    self.main |= value in ("main", "article")
                    self.apart = self.apart or value in ROLES
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                    self.apart = True


def _room(depth: int) -> None:
    """Trees are walked by plain Python calls, at most three a level, which take heap and no C stack."""
    if sys.getrecursionlimit() < 3 * depth + 2000:
        sys.setrecursionlimit(6 * depth + 2000)


def _wide_forms(root: Node, forms: list[Node]) -> None:
    """A form around an article or around most of a page's paragraphs is a container like any other."""
    order, up = [root], [-1]
    for k, node in enumerate(order):
        inner = [x for x in node.parts if isinstance(x, Node)] if node.tag not in RAW else []
        order += inner
        up += [k] * len(inner)
    size = [sum(len(x.strip()) for x in n.parts if isinstance(x, str)) if n.tag not in RAW else 0 for n in order]
    main, paragraph = [n.main for n in order], [n.tag == "p" for n in order]
    for k in range(len(order) - 1, 0, -1):  # from the leaves up
        size[up[k]] += size[k]
        main[up[k]] |= main[k]
        paragraph[up[k]] |= paragraph[k]
    wide = {id(n) for k, n in enumerate(order) if main[k] or paragraph[k] and 2 * size[k] > size[0]}
    for form in forms:
        if id(form) in wide and not MARKS.intersection(re.split(r"[.# ]", form.label)):
            form.tag, form.label, form.apart = "div", "div" + form.label[len("form"):], False


def tree(page: str) -> Node:
    """The element tree of a page, as broken and deep as it may be: end tags close what they can, the rest closes by itself."""
    root = Node("#page")
    stack, at, deepest, forms = [root], 0, 1, []
    opened: Counter[str] = Counter()

    def close(k: int) -> None:
        opened.subtract(n.tag for n in stack[k:])
        del stack[k:]

    while True:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            stack[-1].parts.append(entities.unescape(text) if "&" in text else text)
        if not m:
            _room(deepest)
            if forms:
                _wide_forms(root, forms)
            return root
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                stack[-1].parts.append(m[0][9:-3])
            continue
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        if tag in _SAME:
            for k in range(len(stack) - 1, 0, -1) if any(opened[x] for x in _SAME[tag]) else ():
                if stack[k].tag in _SAME[tag]:
                    close(k)
                    break
                if stack[k].tag in _ENDS[tag]:
                    break
        elif tag in CLOSES_P and opened["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        node = Node(tag, m[3] or m[6] or "")
        stack[-1].parts.append(node)
        if tag == "form":
            forms.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            stack.append(node)
            opened[tag] += 1
            deepest = max(deepest, len(stack))


def _without(node: Node) -> bool:
    """Whether a page has no article or main element outside regions that are no article."""
    left = [node]
    while left:
        node = left.pop()
        if node.tag in RAW or node.tag == "head" or node.apart or node.apart is None:
            continue
        if node.main and node.tag in ("article", "main"):
            return False
        left += [p for p in node.parts if isinstance(p, Node)]
    return True


# --- slots of a page: [label, own text's checksum, whole text's checksum, characters, checksums of blocks, children, elements]
# --- templates: [label, pages, own text's checksum or None, whole text's checksum or None, characters, children, key, {block: pages}]


def _flat(top: list | dict, fields: tuple, children: int | str) -> str:
    """A template or wrapper as JSON of one row a node, parents first; nested JSON would be bounded in depth."""
    out, left = [], [top]
    while left:
        t = left.pop()
        out.append([*(t[f] for f in fields), len(t[children])])
        left.extend(reversed(t[children]))
    return json.dumps(out, separators=(",", ":"))


def _grown(rows: list[list], make: Callable[[list], list | dict], children: int | str) -> list | dict:
    """The tree of such rows."""
    top, path, deepest = None, [], 1
    for *values, n in rows:
        node = make(values)
        if top is None:
            top = node
        else:
            path[-1][0][children].append(node)
            path[-1][1] -= 1
        path.append([node, n])
        deepest = max(deepest, len(path))
        while path and not path[-1][1]:
            path.pop()
    _room(deepest)
    return top


def _elements(node: Node) -> list[Node]:
    return [p for p in node.parts if isinstance(p, Node) and p.tag not in RAW and p.tag != "head"]


def _check(text: str) -> int:
    return zlib.crc32(" ".join(text.split()).encode("utf-8", "surrogatepass"))


def _blocks(root: Node) -> dict[int, int]:
    """Checksums of the texts of blocks that hold no other block, by element."""
    order, up = [root], [-1]
    for k, node in enumerate(order):
        inner = _elements(node)
        order += inner
        up += [k] * len(inner)
    holds = [False] * len(order)
    for k in range(len(order) - 1, 0, -1):
        holds[up[k]] |= holds[k] or order[k].tag in BLOCK
    out = {}
    for k, node in enumerate(order):
        if node.tag in BLOCK and not holds[k]:
            texts, left = [], [node]
            while left:
                part = left.pop()
                if isinstance(part, str):
                    texts.append(part)
                elif part.tag not in RAW:
                    left += reversed(part.parts)
            if any(map(str.strip, texts)):
                out[id(node)] = _check("".join(texts))
    return out


def _slot(nodes: list[Node], blocks: dict[int, int]) -> list:
    """One slot of elements that repeat a label; the children of several elements, and long mixed lists, go by label."""
    owns, size, inner = [], 0, []
    for node in nodes:
        own = " ".join(" ".join(p for p in node.parts if isinstance(p, str)).split()).encode("utf-8", "surrogatepass")
        owns.append(zlib.crc32(own))
        size += len(own)
        inner += _elements(node)
    runs: list[list[Node]] = []
    for node in inner:
        if runs and runs[-1][0].label == node.label:
            runs[-1].append(node)
        else:
            runs.append([node])
    if len(nodes) > 1 or len(runs) > ORDERED:
        by: dict[str, list[Node]] = {}
        for node in inner:
            by.setdefault(node.label, []).append(node)
        runs = list(by.values())
    kids = [_slot(run, blocks) for run in runs]
    check = owns[0] if len(owns) == 1 else zlib.crc32(repr(owns).encode())
    whole = zlib.crc32(repr([check, *(c[2] for c in kids)]).encode()) if kids else check
    held = sorted({blocks[id(n)] for n in nodes if id(n) in blocks})
    return [nodes[0].label, check, whole, size + sum(c[3] for c in kids), held, kids, nodes]


def shape(root: Node) -> list:
    """The slots of a page."""
    return _slot([root], _blocks(root))


def _shape(part: str) -> list:
    return _grown(json.loads(part), lambda v: [*v, [], ()], 5)


def _matching(a: list, b: list) -> int:
    """Size of the largest ordered matching of two trees with equal labels."""
    return 1 + sum(w for _, _, w in _aligned(a[5], b[5])) if a[0] == b[0] else 0


def _aligned(a: list[list], b: list[list]) -> list[tuple[int, int, int]]:
    """Pairs of children in order, with the size of their matching, of greatest total size."""
    names, others = [x[0] for x in a], [x[0] for x in b]
    if len(set(names)) == len(names) and len(set(others)) == len(others):  # labels alone tell
        where = {n: k for k, n in enumerate(others)}
        pairs = [(i, where[n], 1) for i, n in enumerate(names) if n in where]
        if len(a) > ORDERED or len(b) > ORDERED or all(x[1] < y[1] for x, y in zip(pairs, pairs[1:])):
            return pairs
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    size = {}
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1])
            if names[i] == others[j]:
                size[i, j] = _matching(a[i], b[j])
                best[i][j] = max(best[i][j], size[i, j] + best[i + 1][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if (i, j) in size and best[i][j] == size[i, j] + best[i + 1][j + 1]:
            out.append((i, j, size[i, j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def _keys(kids: list[list], centre: list[list]) -> list[str]:
    """Places of slots: that of the centre's slot each is aligned with, or its own label."""
    keys = ["+" + k[0] for k in kids]
    for i, j, _ in _aligned(kids, centre):
        keys[i] = str(j)
    return keys


def rows(page: list, centre: list) -> Iterator[tuple]:
    """(node, up, key, label, block, own, whole, characters) of every slot of a page, and of every block of a slot.

    A node is named by the keys above it, so equal places of different pages have equal names.
    """
    left = [(page, centre, 0, "")]
    while left:
        slot, at, up, key = left.pop()
        node = xxhash.xxh64_intdigest(f"{up}/{key}") - (1 << 63)
        yield node, up, key, slot[0], None, slot[1], slot[2], slot[3]
        for block in slot[4]:
            yield node, up, key, slot[0], block, 0, 0, 0
        inner = at[5] if at else []
        places: dict[str, list] = {}
        for k, kid in zip(_keys(slot[5], inner), slot[5]):
            if k in places:  # labels without a place that repeat apart from each other
                a = places[k]
                places[k] = [a[0], zlib.crc32(b"%d %d" % (a[1], kid[1])), zlib.crc32(b"%d %d" % (a[2], kid[2])), a[3] + kid[3],
                             sorted({*a[4], *kid[4]}), a[5] + kid[5], ()]
            else:
                places[k] = kid
        left += [(kid, None if k[0] == "+" else inner[int(k)], node, k) for k, kid in places.items()]


def template(counts: Iterable[tuple]) -> list:
    """The template of (node, up, key, label, block, pages, least and greatest own, least and greatest whole, characters)."""
    nodes: dict[int, list] = {}
    under: dict[int, list[tuple]] = {}
    held: dict[int, dict[int, int]] = {}
    top, depth = None, 1
    for node, up, key, label, block, pages, own, own_max, whole, whole_max, size in counts:
        if block is not None:
            held.setdefault(node, {})[block] = pages
            continue
        nodes[node] = [label, pages, own if own == own_max else None, whole if whole == whole_max else None, size, [], key, {}]
        if key:
            under.setdefault(up, []).append((key[0] == "+", key if key[0] == "+" else int(key), node))
        else:
            top = node
    left = [(top, 1)]
    while left:
        at, level = left.pop()
        nodes[at][7], depth = held.get(at, {}), max(depth, level)
        for _, _, node in sorted(under.get(at, ())):
            nodes[at][5].append(nodes[node])
            left.append((node, level + 1))
    _room(depth)
    return nodes[top]


def _joined(a: list, b: list) -> list:
    """The template ``a`` with what ``b`` knows of the nodes that both have."""
    kids = list(a[5])
    for i, j, _ in _aligned(a[5], b[5]):
        kids[i] = _joined(a[5][i], b[5][j])
    same = [x if x == y else None for x, y in zip(a[2:4], b[2:4])]
    return [a[0], a[1] + b[1], *same, a[4] + b[4], kids, *a[6:]]


# --- wrappers: [label, key, holds the article, own text is template, it is constant on the host, children, checksums of blocks that are template]


def _apart(label: str, inside: bool) -> bool:
    tag, _, rest = label.partition(".")
    tag = tag.partition("#")[0]
    node = Node(tag, "")
    words = set(re.findall(r"[a-z]+", label[len(tag):]))
    if REMARK & words:
        return True
    if tag not in ("html", "body", "article", "main"):
        if MARKS & words:
            return True
        if TOP_MARKS & words or tag == "header":
            return not inside
    return bool(node.apart)


def _is_main(label: str) -> bool:
    return bool(re.match(r"(article|main)(?=[.#]|$)", label))


def wrapper(template: list, places: bool = True) -> list:
    """Which nodes of a layout's template hold the article, and which texts are template; without ``places`` each page finds its own."""
    varies = template[3] is None

    def has_main(t: list) -> bool:
        left = [t]
        while left:
            t = left.pop()
            if not _apart(t[0], False):
                if _is_main(t[0]):
                    return True
                left += t[5]
        return False

    masses: dict[int, int] = {}

    def mass(t: list) -> int:
        """Characters of varying text outside regions that are no article (of all text if nothing varies)."""
        if id(t) not in masses:
            own, below = t[4], 0
            if not _apart(t[0], False):
                for c in t[5]:
                    own -= c[4]
                    below += mass(c)
                below += own if t[2] is None or not varies else 0
            masses[id(t)] = below
        return masses[id(t)]

    landmark = has_main(template)
    chosen: list[list] = []
    left = [] if landmark or not places else [template]
    while left:
        t = left.pop()
        total = mass(t)
        inner = sorted((c for c in t[5] if c[0].split(".")[0].split("#")[0] in BLOCK - {"p", "li", "td"} and mass(c) > 0), key=lambda c: -mass(c))
        large = [c for c in t[5] if any(c is x for x in inner) and mass(c) >= 0.7 * total]
        if large:
            left.append(large[0])
            continue
        ways: list[list] = []  # containers of which each page has one
        for c in inner:
            if c[1] < t[1] and sum(x[1] for x in ways) + c[1] <= t[1]:
                ways.append(c)
        if len(ways) > 1 and sum(x[1] for x in ways) >= 0.99 * t[1] and sum(map(mass, ways)) >= 0.7 * total:
            left += ways
        else:
            chosen.append(t)
    starting = {id(t) for t in chosen}

    def rule(t: list, inside: bool, vary: bool, pages: int) -> list:
        starts = not inside and (places and (_is_main(t[0]) if landmark else id(t) in starting))
        if starts:
            vary, pages = t[3] is None, t[1]
        inside = inside or starts
        constant = t[2] is not None and t[1] == pages
        fixed = inside and vary and constant and (pages >= SUPPORT or not landmark and pages > 1)
        common = varies and t[2] is not None and 1 < t[1] and (t[1] >= SUPPORT or t[1] == template[1])
        enough = max(LINES, MOST * (pages if inside else template[1]))
        lines = sorted(b for b, n in t[7].items() if n >= enough) if (vary if inside else varies) else []
        kids = [rule(c, inside, vary, pages) for c in t[5]]
        # of slots without a place in the centre, only those that decide something are kept
        kids = [k for k in kids if k[1][0] != "+" or k[2] or k[3] or k[4] or k[5] or k[6]]
        return [t[0], t[6], int(starts), int(fixed), int(common), kids, lines]

    return rule(template, False, False, 0)


class Reader:
    """Applies one host's wrappers to its pages: a single one, or those of pages with and without a landmark, null if there are none."""

    def __init__(self, rules: str):
        read = json.loads(rules)
        self.rules = [r and _grown(r, lambda v: [*v[:5], [], *v[5:]], 5) for r in (read if len(read) == 2 else read * 2)]
        left = [r for r in self.rules if r]
        while left:  # children with a place in the centre stay a list, the others are looked up by key
            r = left.pop()
            left += r[5]
            r.append({k[1]: k for k in r[5]})
            r[5] = [k for k in r[5] if k[1][0] != "+"]

    def text(self, page: str | None) -> str:
        root = tree(page or "")
        without = _without(root)
        rules = self.rules[without]
        blocks = _blocks(root) if rules else {}
        match = _match(_slot([root], blocks), rules) if rules else {}
        text, started = self._read(root, match, blocks, None)
        return self._read(root, match, blocks, _place(root, match, blocks))[0] if without and not started else text

    def _read(self, root: Node, match: dict[int, list], checks: dict[int, int], place: Node | None) -> tuple[str, bool]:
        """The text, and whether an article starts anywhere; with a place it does there only, and constant text is template."""
        started = False
        blocks: list[str] = []
        held: list[str] = []

        def flush() -> None:
            line = " ".join("".join(held).split())
            if line:
                blocks.append(line)
            held.clear()

        def walk(node: Node, inside: bool) -> None:
            if node.tag in RAW or node.tag == "head" or node.apart or node.apart is None and not inside:
                return
            rule = match.get(id(node))
            inside = inside or (node is place if place else node.main or bool(rule and rule[2]))
            nonlocal started
            started |= inside
            block = node.tag in BLOCK
            if block:
                flush()
            if rule and rule[6] and checks.get(id(node)) in rule[6]:
                return
            fixed = bool(rule and rule[4 if place else 3])
            for p in node.parts:
                if isinstance(p, Node):
                    if p.tag == "br":
                        held.append(" ")
                    else:
                        walk(p, inside)
                elif inside and not fixed:
                    held.append(p)
            if block:
                flush()

        walk(root, False)
        flush()
        return "\n".join(blocks), started


def _match(page: list, rules: list) -> dict[int, list]:
    """The wrapper's rule of each element that has one."""
    out, left = {}, [(page, rules)]
    while left:
        slot, rule = left.pop()
        for node in slot[6]:
            out[id(node)] = rule
        for key, kid in zip(_keys(slot[5], rule[5]), slot[5]):
            if key[0] != "+":
                key = rule[5][int(key)][1]
            if key in rule[7]:
                left.append((kid, rule[7][key]))
    return out


def _place(root: Node, match: dict[int, list], blocks: dict[int, int]) -> Node:
    """Where most of a page's own text is, the one that the wrapper does not know as constant."""
    order: list[tuple[Node, int, int]] = []  # element, its parent's place, characters
    left: list[tuple[Node, int]] = [(root, -1)]
    while left:
        node, up = left.pop()
        if node.tag in RAW or node.tag == "head" or node.apart or node.apart is None:
            continue
        rule = match.get(id(node))
        if rule and rule[6] and blocks.get(id(node)) in rule[6]:
            continue
        own = 0 if rule and rule[4] else sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        left += [(p, len(order)) for p in node.parts if isinstance(p, Node)]
        order.append((node, up, own))
    mass = [own for _, _, own in order]
    for k in range(len(order) - 1, 0, -1):
        mass[order[k][1]] += mass[k]
    at = 0
    for k in range(1, len(order)):  # parents come first
        if order[k][1] == at and order[k][0].tag in BLOCK - {"p", "li", "td"} and mass[k] >= 0.7 * mass[at] > 0:
            at = k
    return order[at][0] if order else root


def _host(url_col: str):
    return F.regexp_extract(F.lower(F.coalesce(F.col(url_col).cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)


_ROW = pa.schema([("host", pa.string()), ("layout", pa.int32()), ("total", pa.int64()), ("node", pa.int64()), ("up", pa.int64()), ("key", pa.string()),
                  ("label", pa.string()), ("block", pa.int64()), ("own", pa.int64()), ("whole", pa.int64()), ("size", pa.int64())])


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, rules): the wrappers of a host's two kinds of layouts, from all its pages. Pages without a host share the host ''.

    The shapes of pages are written once, with checksums instead of texts. What meets in
    one group is a host's template: at most RARE times the slots and blocks of its mean page.
    """
    steps = Steps(pages.sparkSession)

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts, labels, parts = [], [], []
            for page in batch.column(1).to_pylist():
                root = tree(page or "")
                top = shape(root)
                layouts.append(int(_without(root)))
                labels.append(xxhash.xxh64_intdigest(_flat(top, (0,), 5)) - (1 << 63))
                parts.append(_flat(top, range(5), 5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(layouts, pa.int32()), pa.array(labels, pa.int64()), pa.array(parts, pa.string())],
                                             names=["host", "layout", "labels", "shape"])

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres: dict[str, list] = {}
        for batch in batches:
            out: list[tuple] = []
            for host, layout, total, part, centre in zip(*(c.to_pylist() for c in batch.columns)):
                if centre not in centres:
                    if len(centres) >= HOSTS:
                        centres.clear()
                    centres[centre] = _shape(centre)
                out += [(host, layout, total, *r) for r in rows(_shape(part), centres[centre])]
                if len(out) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ROW.types)], schema=_ROW)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ROW.types)], schema=_ROW)

    def rules(f: pd.DataFrame) -> pd.DataFrame:
        def grown(layout: int) -> list | None:
            mine = f[f["layout"] == layout]
            blocks = [None if pd.isna(b) else int(b) for b in mine["block"]]
            columns = [mine[c].tolist() for c in ("pages", "own", "own_max", "whole", "whole_max", "size")]
            return template(zip(mine["node"].tolist(), mine["up"].tolist(), mine["key"], mine["label"], blocks, *columns)) if len(mine) else None

        marked, plain = grown(0), grown(1)
        alone = marked is not None and plain is not None and plain[1] == 1  # a single page: the others tell what is constant
        made = [t and wrapper(t) for t in (marked, None if alone else plain)]
        if alone:
            made[1] = wrapper(_joined(plain, marked), False)
        flat = ",".join(_flat(w, (0, 1, 2, 3, 4, 6), 5) if w else "null" for w in made)
        return pd.DataFrame({"host": [f["host"].iloc[0]], "rules": [f"[{flat}]"]})

    found = steps.write(pages.select(_host(url_col).alias("host"), F.col(html_col).cast("string")).mapInArrow(
        shapes, "host string, layout int, labels long, shape string"), "shapes")
    kinds = found.groupBy("host", "layout", "labels").agg(F.count("*").alias("n"), F.min("shape").alias("shape"))
    centres = steps.write(kinds.groupBy("host", "layout").agg(F.sum("n").alias("total"), F.max_by("shape", F.struct("n", "labels")).alias("centre")), "centres")
    placed = found.join(centres, ["host", "layout"]).select("host", "layout", "total", "shape", "centre")
    schema = "host string, layout int, total long, node long, up long, key string, label string, block long, own long, whole long, size long"
    counts = placed.mapInArrow(slots, schema).groupBy("host", "layout", "node", "block").agg(
        F.count("*").alias("pages"), F.max("total").alias("total"), F.min("up").alias("up"), F.min("key").alias("key"), F.min("label").alias("label"),
        F.min("own").alias("own"), F.max("own").alias("own_max"), F.min("whole").alias("whole"), F.max("whole").alias("whole_max"), F.sum("size").alias("size"))
    kept = counts.where((F.col("pages") * RARE >= F.col("total")) & (F.col("block").isNull() | (F.col("pages") >= LINES)))
    return steps.write(kept.groupBy("host").applyInPandas(rules, "host string, rules string"), "wrappers", (found, centres))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page: the article's blocks in page order, one a line.

    A null page is empty, a page without an article gives an empty text; both keep their
    row, as do repeated rows. Other columns are ignored.
    """
    wrappers = induce(pages, url_col, html_col)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[str, Reader] = {}
        for batch in batches:
            texts = []
            for page, rules in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if rules not in readers:
                    if len(readers) >= HOSTS:
                        readers.clear()
                    readers[rules] = Reader(rules)
                texts.append(readers[rules].text(page))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), _host(url_col).alias("host"))
    # the wrappers are on file, so Spark knows their size before it picks the join; a hot host's partition can be split
    return rows.join(wrappers, "host").select("id", "url", "html", "rules").mapInArrow(
        run, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
