"""Main text of web pages by wrappers inferred for each host.

A wrapper is a union-free regular expression over the tokens of a host's pages: tags, fixed texts,
text slots, optional groups and repeated groups. It starts as the tokens of one page, with blocks
that follow each other several times folded into repeated groups. Each further page is aligned with
it: texts that differ become slots, a block that the other side repeats becomes a repeated group, and
tokens on one side alone become optional.

What a host's pages have in common is its template. So texts that stay the same from page to page, and
slots that mostly hold such texts (the entries of a menu), are no article; the element that holds the
article is the one with the varying text; and a page's texts that fall on the article's slots are the
main text. Names of elements and classes count besides, as hints.

A wrapper is inferred from all pages of its host, copies of a page counting once. Pages of one structure
are one; structures are aligned in parts, and the parts with each other, until a host has one wrapper.
Then all pages are matched with it, and what falls on its slots is counted: aggregates by host, slot,
text and path, from which fixed texts and the article's element follow.
"""

from __future__ import annotations

import html
import json
import math
import operator
import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from coursepulse.llm.folders import working_dir
from coursepulse.llm.urls import host_and_path
from coursepulse.workspace import stored

#: Structures, or wrappers of parts of a host, that one task aligns with each other at a time.
PARTS = 64
#: The share of the pages with a node at the top of a wrapper, of those merged so far. What fewer pages
#: have is not in common, and left out of the wrapper; their texts there are judged by their own tags.
RARE = 0.05
#: Parts of folded pages that are aligned by their longest common runs; longer ones are split first where
#: something stands once in both.
ALIGNED = 3000
#: A slot has fixed texts if it is on this share of the pages, and a text is fixed if this share of the
#: pages with its slot have it (up to nine pages, all of them).
MOST_PAGES, SAME_TEXT = 2 / 3, 0.9
#: Pages that have to agree on a text for it to be fixed in a slot whose texts vary otherwise.
LEAST_PAGES = 3
#: The share of an article element's text that may be fixed. If more is, the pages are copies.
MOST_FIXED = 0.3
#: Tokens of the longest block that is looked for as a repeated group.
PERIOD = 24
#: Counts a task adds up before it hands them on.
MOST_COUNTS = 200_000
#: Copies of pages that a broadcast may name.
MOST_SENT = 500_000
#: For sums of pages, which have a share of a page for each of its copies.
CLOSE = 1e-6

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math object textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never part of an article, and whole class names, ids and roles that say the same.
APART = frozenset("nav footer aside form menu button select dialog".split())
APART_NAMES = frozenset(
    "ad ads adbox ad-box ad-container ad-slot adslot advert advertisement advertising adverts alert "
    "banner breadcrumb breadcrumbs comment comments comment-list comments-area post-comments consent "
    "cookie cookies cookie-banner cookie-notice complementary contentinfo discussion disqus_thread "
    "footer site-footer gdpr login masthead menu main-menu nav-menu menubar modal nav main-nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promoted promotion recommended "
    "related related-posts respond search search-form share share-bar share-buttons sharing sidebar "
    "signup skip skip-link social social-share sponsor sponsored subscribe subscription toolbar topbar "
    "widget widget-area".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_DIGITS = re.compile(r"\d+")


# --- tokens ---------------------------------------------------------------------------------


def tokens(page: str) -> list[tuple[str, str]]:
    """``(label, text)`` of a page: tags have a label such as ``<div ad>``, texts the label ``#``.

    Comments, declarations and elements without readable text are left out. Labels keep class names,
    ids and roles, with numbers made alike. Texts are as written.
    """
    found: list[tuple[str, str]] = []
    at = 0
    while True:
        match = _TOKEN.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            found.append(("#", text))
        if not match:
            return found
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if match[1]:
            if name not in RAW:
                found.append((f"</{name}>", ""))
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        else:
            found.append((_label(name, match[3]), ""))


def _label(name: str, attributes: str) -> str:
    if "=" not in attributes and "hidden" not in attributes:
        return f"<{name}>"
    marks = []
    for key, *values in _ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id", "role"):
            marks += _DIGITS.sub("0", next(filter(None, values), "").lower()).split()
    if re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes, re.IGNORECASE):
        marks.append("hidden")
    return f"<{' '.join([name, *sorted(set(marks))])}>"


@lru_cache(4096)
def _name(label: str) -> str:
    return label.strip("</>").split(" ")[0]


@lru_cache(4096)
def _apart(label: str) -> bool:
    """Whether an opening tag's element is no article text."""
    name, *marks = label.strip("<>").split(" ")
    return name in APART or "hidden" in marks or not APART_NAMES.isdisjoint(marks)


# --- wrappers -------------------------------------------------------------------------------


@dataclass(slots=True)
class Node:
    """A part of a wrapper: a tag, a text, or a repeated group with a body."""

    label: str
    text: str | None = None  # a fixed text; None is a slot
    body: list[Node] = field(default_factory=list)
    optional: bool = False
    pages: float = 1  # that have it
    places: list[tuple[int, int]] = field(default_factory=list)  # pages and tokens it stands for
    key: str = ""

    def __post_init__(self) -> None:
        self.key = f"({' '.join(node.key for node in self.body)})+" if self.body else self.label


def page_nodes(found: list[tuple[str, str]], page: int = 0) -> list[Node]:
    return [Node(label, places=[(page, at)]) for at, (label, _) in enumerate(found)]


def _merge(kept: Node, other: Node) -> Node:
    """``kept`` standing for ``other`` as well, which has the same key."""
    if kept.body:
        for mine, theirs in zip(kept.body, other.body, strict=True):
            _merge(mine, theirs)
    kept.places += other.places
    kept.optional |= other.optional
    kept.pages = max(kept.pages, other.pages)
    return kept


def fold(nodes: list[Node]) -> list[Node]:
    """Folds blocks that follow each other twice or more, shorter blocks first."""
    keys = [node.key for node in nodes]
    for period in range(1, PERIOD + 1):
        if 2 * period > len(nodes):
            break
        same = list(map(operator.eq, keys, keys[period:]))
        if sum(same) < period:
            continue
        out, at, run = [], 0, 0
        ahead = [0] * (len(same) + 1)  # how many positions from here on equal those a period later
        for place in range(len(same) - 1, -1, -1):
            ahead[place] = ahead[place + 1] + 1 if same[place] else 0
        while at < len(nodes):
            run = ahead[at] if at < len(same) else 0
            starts_block = keys[at].startswith(("<", "(")) and not keys[at].startswith("</")
            if run >= period and starts_block and (period > 1 or keys[at].startswith("(")):
                times = run // period + 1
                body = nodes[at : at + period]
                for turn in range(1, times):
                    for offset in range(period):
                        _merge(body[offset], nodes[at + turn * period + offset])
                if period == 1:
                    out += body
                else:
                    out.append(Node("", body=body))
                at += times * period
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
        keys = [node.key for node in nodes]
    return nodes


def fold_known(nodes: list[Node], bodies: dict[str, int]) -> list[Node]:
    """Folds single occurrences of blocks that are repeated elsewhere; ``bodies`` maps a group's key
    to the length of its body."""
    if not bodies:
        return nodes
    out, at = [], 0
    keys = [node.key for node in nodes]
    firsts = {key[1:].split(" ")[0]: [] for key in bodies}
    for key, length in bodies.items():
        firsts[key[1:].split(" ")[0]].append((length, key))
    while at < len(nodes):
        for length, key in sorted(firsts.get(keys[at].split(" ")[0], ()), reverse=True):
            if f"({' '.join(keys[at : at + length])})+" == key:
                body = nodes[at : at + length]
                group = Node("", body=body, optional=any(node.optional for node in body),
                             pages=max(node.pages for node in body))
                if out and out[-1].key == key:
                    _merge(out[-1], group)
                else:
                    out.append(group)
                at += length
                break
        else:
            if out and out[-1].body and out[-1].key == keys[at]:
                _merge(out[-1], nodes[at])
            else:
                out.append(nodes[at])
            at += 1
    return out


def _bodies(nodes: list[Node]) -> dict[str, int]:
    return {node.key: len(node.body) for node in nodes if node.body}


def matching(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """Runs ``(start in a, start in b, length)`` that two lists of keys have in common, in order.

    Long lists are split where a key stands once in both, in the same order; parts that stay long, and
    have nothing like that, have no more runs.
    """
    if min(len(a), len(b)) * max(len(a), len(b)) <= ALIGNED ** 2:
        found = SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
        return [(run.a, run.b, run.size) for run in found if run.size]
    often_a, often_b = Counter(a), Counter(b)
    place = {key: at for at, key in enumerate(b) if often_b[key] == 1}
    anchors = _rising([(at, place[key]) for at, key in enumerate(a)
                       if often_a[key] == 1 and key in place])
    runs, low_a, low_b = [], 0, 0
    for at, there in [*anchors, (len(a), len(b))]:
        if anchors and (at > low_a and there > low_b):
            runs += [(low_a + x, low_b + y, size)
                     for x, y, size in matching(a[low_a:at], b[low_b:there])]
        if at < len(a):
            runs.append((at, there, 1))
        low_a, low_b = at + 1, there + 1
    return runs


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest choice of pairs, which rise in the first number, that rises in the second too."""
    ends: list[int] = []
    tails: list[int] = []
    before = [-1] * len(pairs)
    for number, (_, there) in enumerate(pairs):
        at = bisect_left(ends, there)
        before[number] = tails[at - 1] if at else -1
        ends[at:at + 1], tails[at:at + 1] = [there], [number]
    found, number = [], tails[-1] if tails else -1
    while number >= 0:
        found.append(pairs[number])
        number = before[number]
    return found[::-1]


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper generalised so that it also fits the page."""
    known = _bodies(wrapper) | _bodies(page)
    wrapper, page = fold_known(wrapper, known), fold_known(page, known)
    out: list[Node] = []
    a = c = 0
    for at, there, size in [*matching([n.key for n in wrapper], [n.key for n in page]),
                            (len(wrapper), len(page), 0)]:
        for node in wrapper[a:at] + page[c:there]:
            node.optional = True
            out.append(node)
        a, c = at + size, there + size
        for mine, theirs in zip(wrapper[at:a], page[there:c], strict=True):
            pages = mine.pages + theirs.pages
            out.append(_merge(mine, theirs))
            out[-1].pages = pages
    return out


def align_all(parts: Iterable[tuple[list[Node], float]]) -> tuple[list[Node], float]:
    """The wrapper that fits all parts, and its number of pages. Parts are wrappers, or structures of
    pages, with theirs."""
    nodes: list[Node] | None = None
    total = 0.0
    for part, pages in parts:
        nodes = part if nodes is None else align(nodes, part)
        total += pages
    return [node for node in nodes or () if node.pages >= RARE * total - CLOSE], total


def pack(nodes: list[Node]) -> str:
    """Nodes as text, without their places."""
    def shape(node: Node) -> str | list:
        return [shape(part) for part in node.body] if node.body else node.label
    return json.dumps([[shape(node), round(node.pages, 6), int(node.optional)] for node in nodes],
                      ensure_ascii=False, separators=(",", ":"))


def unpack(packed: str, pages: float | None = None) -> list[Node]:
    """The nodes of a text; ``pages``, if given, is how many have each."""
    def node(shape: str | list, **more) -> Node:
        if isinstance(shape, str):
            return Node(shape, **more)
        return Node("", body=[node(part) for part in shape], **more)
    return [node(shape, pages=has if pages is None else pages, optional=bool(optional))
            for shape, has, optional in json.loads(packed)]


class Path:
    """The open elements at a point of a token stream."""

    CLOSED_BY = {"p": frozenset(("p", "article", "section", "div", "ul", "ol", "table", "nav",
                                 "footer", "header", "aside", "form", *HEADINGS)),
                 "li": frozenset(("li",)), "option": frozenset(("option",)),
                 "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")),
                 "th": frozenset(("td", "th", "tr"))}

    def __init__(self) -> None:
        self.open: list[str] = []

    def step(self, label: str) -> None:
        name = _name(label)
        if label.startswith("</"):
            for at in range(len(self.open) - 1, -1, -1):
                if _name(self.open[at]) == name:
                    del self.open[at:]
                    return
            return
        if self.open and name in self.CLOSED_BY.get(_name(self.open[-1]), ()):
            self.open.pop()
        if name not in VOID:
            self.open.append(label)


def _leaves(nodes: list[Node]) -> Iterator[Node]:
    for node in nodes:
        if node.body:
            yield from _leaves(node.body)
        else:
            yield node


@dataclass
class Slot:
    """What is the template's in a slot: its fixed texts' digests, and whether all that falls there."""

    template: bool
    fixed: frozenset[int]
    around: tuple[str, bool]  # a text's element, and whether the holder is open


@dataclass
class Wrapper:
    """The nodes of a wrapper, the label of the element that holds the article, and the slots that hold
    texts of the template, by their number among the nodes' texts."""

    nodes: list[Node]
    holder: str | None
    slots: dict[int, Slot] = field(default_factory=dict)
    known: dict[tuple, list[tuple[int, int, int]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.bodies = _bodies(self.nodes)
        self.keys = [node.key for node in self.nodes]
        self.numbers, number = [], 0  # of each node's texts
        for node in self.nodes:
            self.numbers.append([])
            for leaf in _leaves([node]):
                self.numbers[-1].append(number if leaf.label == "#" else -1)
                number += leaf.label == "#"

    def __reduce__(self) -> tuple:
        return Wrapper, (self.nodes, self.holder, self.slots)

    @classmethod
    def infer(cls, pages: list[str]) -> Wrapper:
        """The wrapper of these pages; ``infer_wrappers`` does the same to each host of a table."""
        pages = list(dict.fromkeys(pages))
        shapes = Counter(pack(fold(page_nodes(tokens(page)))) for page in pages)
        wrapper = cls(align_all((unpack(shape, number), number) for shape, number
                                in sorted(shapes.items(), key=_order))[0], None)
        found = [tokens(page) for page in pages]
        slots = [wrapper.places(page) for page in found]
        texts: dict[int, dict[str, set[int]]] = {}
        for page, (tags, on) in enumerate(zip(found, slots, strict=True)):
            for (_, text), slot in zip(tags, on, strict=True):
                if slot >= 0:
                    texts.setdefault(slot, {}).setdefault(" ".join(text.split()), set()).add(page)
        fixed: dict[int, set[str]] = {}
        having = {slot: len(set().union(*held.values())) for slot, held in texts.items()}
        for slot, held in texts.items():
            if having[slot] >= max(2, MOST_PAGES * len(pages) - CLOSE):
                fixed[slot] = {text for text, on in held.items()
                               if text and len(on) >= SAME_TEXT * having[slot] - CLOSE}
        template = {(page, at) for page, (tags, on) in enumerate(zip(found, slots, strict=True))
                    for at, slot in enumerate(on) if slot >= 0
                    and " ".join(tags[at][1].split()) in fixed.get(slot, ())}
        wrapper.holder = _holder(found, template)
        if not _copies(found, wrapper.holder, template):
            chars: dict[int, Counter] = {}
            for page, (tags, on) in enumerate(zip(found, slots, strict=True)):
                path = Path()
                for at, (label, text) in enumerate(tags):
                    if label != "#":
                        path.step(label)
                    elif fixed.get(on[at]):
                        chars.setdefault(on[at], Counter())[
                            tuple(path.open), (page, at) in template] += len(text)
            for slot, held in chars.items():
                paths = Counter()
                for (path, _), count in held.items():
                    paths["\n".join(path)] += count
                most = max(paths, key=lambda path: (paths[path], path))
                ours = sum(count for (_, is_fixed), count in held.items() if is_fixed)
                wrapper.slots[slot] = Slot(
                    ours >= 0.5 * sum(held.values()),
                    frozenset(map(_digest, fixed[slot])) if having[slot] >= LEAST_PAGES else frozenset(),
                    _around(most.split("\n") if most else [], wrapper.holder))
        leaves = [node for node in _leaves(wrapper.nodes) if node.label == "#"]
        for slot, held in texts.items():
            leaves[slot].text = next(iter(held)) if len(held) == 1 else None
        return wrapper

    def pattern(self) -> str:
        """The wrapper as a regular expression over tokens."""
        def write(node: Node) -> str:
            if node.body:
                found = f"( {' '.join(write(part) for part in node.body)} )+"
            elif node.label == "#":
                found = "#PCDATA" if node.text is None else repr(node.text)
            else:
                found = node.label
            return f"( {found} )?" if node.optional else found
        return " ".join(write(node) for node in self.nodes)

    def places(self, found: list[tuple[str, str]]) -> list[int]:
        """The slot that each token of a page falls on; -1 for tags, and texts that fall on none."""
        nodes = fold_known(fold(page_nodes(found)), self.bodies)
        keys = tuple(node.key for node in nodes)
        blocks = self.known.get(keys)
        if blocks is None:
            blocks = matching(self.keys, list(keys))
            if len(self.known) < 500:
                self.known[keys] = blocks
        slots = [-1] * len(found)
        for a, c, size in blocks:
            for number in range(size):
                for slot, held in zip(self.numbers[a + number], _leaves([nodes[c + number]]),
                                      strict=True):
                    if slot >= 0:
                        for _, at in held.places:
                            slots[at] = slot
        return slots

    def extract(self, page: str) -> str:
        """The main text of a page."""
        found = tokens(page)
        holder = self.holder
        if holder is not None and all(label != holder for label, _ in found):
            holder = _holder([found])  # of another template than the wrapper's holder
        pieces = []
        path = Path()
        for (label, text), place in zip(found, self.places(found), strict=True):
            if label != "#":
                path.step(label)
                if _name(label) not in INLINE:
                    pieces.append(" ")
            elif _inside(path.open, holder):
                slot = self.slots.get(place)
                if slot is None or _around(path.open, holder) != slot.around or not (
                        slot.template or (slot.fixed and _digest(text) in slot.fixed)):
                    pieces.append(html.unescape(text))
        return " ".join("".join(pieces).split())


def _order(shape: tuple[str, float]) -> tuple[float, str]:
    """Structures of most pages first."""
    return -shape[1], shape[0]


def _digest(text: str) -> int:
    """A text's digest, white space made alike, as a signed number of 64 bits."""
    found = xxh3_64_intdigest(" ".join(text.split()).encode("utf-8", "surrogatepass"))
    return found - (1 << 64) if found >> 63 else found


def _around(path: list[str], holder: str | None) -> tuple[str, bool]:
    """What a text and the slot it falls on must have in common."""
    return path[-1] if path else "", holder in path


def _inside(path: list[str], holder: str | None) -> bool:
    """Whether a text at this path is article text: below the holder, in nothing apart."""
    if holder is not None:
        if holder not in path:
            return False
    elif any(_name(label) in ("head", "header") for label in path):
        return False
    return not any(_apart(label) for label in path)


def _copies(pages: list[list[tuple[str, str]]], holder: str | None,
            template: set[tuple[int, int]]) -> bool:
    """Whether too much inside of an article element is the same on all pages."""
    if holder is None or _name(holder) not in ("article", "main"):
        return False
    fixed = total = 0
    for page, found in enumerate(pages):
        path = Path()
        for at, (label, text) in enumerate(found):
            if label != "#":
                path.step(label)
            elif _inside(path.open, holder):
                total += len(text)
                fixed += len(text) * ((page, at) in template)
    return fixed > MOST_FIXED * total


def _holder(pages: list[list[tuple[str, str]]],
            template: set[tuple[int, int]] = frozenset()) -> str | None:
    """The label of the element that holds the article, by all tokens of the pages: ``article`` or
    ``main`` with the most text, else the innermost element that holds nearly all text that isn't the
    template's, apart, or in links. Without any such text, the template's counts too."""
    held, total, depth = {}, 0, {}
    for page, found in enumerate(pages):
        path = Path()
        for at, (tag, text) in enumerate(found):
            if tag != "#":
                path.step(tag)
                continue
            if (page, at) in template or not _telling(path.open):
                continue
            total += len(text)
            for place, label in enumerate(dict.fromkeys(path.open)):
                held[label] = held.get(label, 0) + len(text)
                depth[label] = max(depth.get(label, 0), place)
    if not total:
        return _holder(pages) if template else None
    for kind in (ARTICLE, MAIN):
        fit = [label for label in held if _kind(label) == kind and held[label]]
        if fit:
            return max(fit, key=lambda label: (held[label], label))
    most = [label for label in held if held[label] >= 0.9 * total and _kind(label) == OTHER]
    return max(most, key=lambda label: (depth[label], label)) if most else None


def _telling(path: list[str]) -> bool:
    """Whether texts at this path tell where the article is."""
    return not any(_apart(label) or _name(label) in ("a", "head", "header") for label in path)


# fixed values: kinds of elements that may hold an article
ARTICLE, MAIN, OTHER, NONE = range(4)


@lru_cache(4096)
def _kind(label: str) -> int:
    name, marks = _name(label), label.strip("<>").split(" ")[1:]
    if name == "article":
        return ARTICLE
    if name == "main" or "main" in marks:
        return MAIN
    return NONE if name in INLINE | HEADINGS | {"p", "html", "body"} else OTHER


# --- tables ---------------------------------------------------------------------------------


def _single_pages(pages: DataFrame) -> DataFrame:
    """``host, html, share``: all pages; the copies of a page on its host have equal shares of it."""
    rows = pages.select(host_and_path("url")[0].alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    digest = [F.xxhash64("html").alias("digest"), F.length("html").alias("chars")]
    copied = stored(
        rows.select("host", *digest).groupBy("host", "digest", "chars").agg(F.count("*").alias("copies"))
        .filter("copies > 1"), working_dir(pages.sparkSession, "copies"))
    if copied.count() <= MOST_SENT:
        copied = F.broadcast(copied)
    return rows.select("*", *digest).join(copied, ["host", "digest", "chars"], "left").select(
        "host", "html", F.coalesce(1 / F.col("copies"), F.lit(1.0)).alias("share"))


def _structures(rows: DataFrame) -> DataFrame:
    """``host, part, pages``: the structures of a host's pages."""
    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def taken() -> pd.DataFrame:
            return pd.DataFrame([(*key, pages) for key, pages in seen.items()],
                                columns=["host", "part", "pages"])

        seen: dict[tuple[str, str], float] = {}
        chars = 0
        for batch in batches:
            for host, page, share in zip(batch["host"], batch["html"], batch["share"], strict=True):
                key = host, pack(fold(page_nodes(tokens(page))))
                if key not in seen:
                    chars += len(key[1])
                seen[key] = seen.get(key, 0.0) + share
                if chars >= 100 * MOST_COUNTS:
                    yield taken()
                    seen, chars = {}, 0
        if seen:
            yield taken()

    return rows.mapInPandas(shapes, "host string, part string, pages double").groupBy(
        "host", "part").agg(F.round(F.sum("pages"), 6).alias("pages"))


def _aligned(structures: DataFrame) -> DataFrame:
    """``host, part, pages``, one row per host: its pages' structures aligned, some at a time by their
    hash, and what that gives again, until there is one part."""
    spark = structures.sparkSession

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def given() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(batch["host"], batch["number"], batch["part"], batch["pages"], strict=True)

        merged = []
        for (host, _), group in groupby(given(), key=lambda row: row[:2]):
            nodes, pages = align_all((unpack(part, pages if first else None), pages)
                                     for *_, part, pages in group)
            merged.append((host, pack(nodes), round(pages, 6)))
            if len(merged) >= PARTS:
                yield pd.DataFrame(merged, columns=["host", "part", "pages"])
                merged = []
        if merged:
            yield pd.DataFrame(merged, columns=["host", "part", "pages"])

    parts, first, most = stored(structures, working_dir(spark, "structures")), True, 2
    while most > 1:
        parts = parts.join(parts.groupBy("host").agg(F.count("*").alias("of")), "host")
        merged = (
            parts.filter(F.lit(first) | (F.col("of") > 1))
            .withColumn("number", F.pmod(F.xxhash64("part"), F.ceil(F.col("of") / PARTS)))
            .repartition("host", "number").sortWithinPartitions("host", "number", F.desc("pages"), "part")
            .mapInPandas(merge, "host string, part string, pages double"))
        if not first:
            merged = merged.unionByName(parts.filter("of = 1").drop("of"))
        parts, first = stored(merged, working_dir(spark, "parts")), False
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    return parts


def _counts(rows: DataFrame) -> DataFrame:
    """What is on the slots, by ``host, slot, text, path``: pages, of all that have them, and
    characters. A row without path has the pages of a slot, without slot those of the host; one with
    ``labels`` has what the path's number stands for. Texts in no slot have the slot -1 and no text."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def taken() -> pd.DataFrame:
            host, slot, text, path, labels = zip(*seen, strict=True)
            pages, chars = zip(*seen.values(), strict=True)
            return pd.DataFrame({  # digests don't fit floating point numbers
                "host": host, "slot": pd.array(slot, "Int64"), "text": pd.array(text, "Int64"),
                "path": pd.array(path, "Int64"), "labels": labels, "pages": pages, "chars": chars})

        def add(key: tuple, pages: float, chars: float = 0.0) -> None:
            has = seen.setdefault(key, [0.0, 0.0])
            has[0] += pages
            has[1] += chars

        seen: dict[tuple, list[float]] = {}
        known: dict[str, Wrapper] = {}
        paths: dict[tuple[str, ...], tuple[int, str]] = {}
        for batch in batches:
            for host, page, share, part in zip(
                    batch["host"], batch["html"], batch["share"], batch["part"], strict=True):
                wrapper = known.get(part)
                if wrapper is None:
                    if len(known) >= 200:
                        known.clear()
                    known[part] = wrapper = Wrapper(unpack(part), None)
                found = tokens(page)
                open_ones, on_page = Path(), set()
                add((host, None, None, None, None), share)
                for (label, text), slot in zip(found, wrapper.places(found), strict=True):
                    if label != "#":
                        open_ones.step(label)
                        continue
                    place = tuple(open_ones.open)
                    if place not in paths:
                        if len(paths) >= MOST_COUNTS:
                            paths.clear()
                        labels = "\n".join(place)
                        paths[place] = _digest(labels), labels
                    path, labels = paths[place]
                    seen.setdefault((host, None, None, path, labels), [0.0, 0.0])
                    digest = None
                    if slot >= 0:
                        digest = _digest(text)
                        if slot not in on_page:
                            on_page.add(slot)
                            add((host, slot, None, None, None), share)
                    new = slot >= 0 and (slot, digest) not in on_page
                    if new:
                        on_page.add((slot, digest))
                    add((host, slot, digest, path, None), share if new else 0.0, share * len(text))
                if len(seen) >= MOST_COUNTS:
                    yield taken()
                    seen = {}
        if seen:
            yield taken()

    return rows.mapInPandas(count, "host string, slot long, text long, path long, labels string, "
                                   "pages double, chars double").groupBy(
        "host", "slot", "text", "path", "labels").agg(
        F.round(F.sum("pages"), 6).alias("pages"), F.round(F.sum("chars"), 3).alias("chars"))


def _holders(held: DataFrame) -> DataFrame:
    """``host, holder``, as ``_holder`` finds it, from ``host, labels, chars, ours``."""
    telling, kind = (F.udf(lambda labels: _telling(labels), "boolean"),
                     F.udf(lambda label: _kind(label), "int"))
    paths = held.groupBy("host", "labels").agg(F.sum("chars").alias("chars"), F.sum("ours").alias("ours"))
    paths = paths.filter(telling("labels"))

    def best(chars: Column) -> tuple[list[Column], Column]:
        """Aggregates over a host's labels, and the holder from them."""
        name = F.col("label")
        found = [F.max(F.when((F.col("kind") == want) & (chars > CLOSE), F.struct(chars.alias("c"), name)))
                 for want in (ARTICLE, MAIN)]
        found.append(F.max(F.when((F.col("kind") == OTHER) & (chars >= 0.9 * F.col("total") - CLOSE),
                                  F.struct(F.col("depth").alias("c"), name))))
        return found, F.coalesce(*[f"label{at}" for at in range(3)])

    totals = paths.groupBy("host").agg(F.sum("chars").alias("all"),
                                       F.sum(F.col("chars") - F.col("ours")).alias("varying"))
    labels = paths.select("host", "chars", (F.col("chars") - F.col("ours")).alias("varying"),
                          F.posexplode(F.array_distinct("labels")).alias("depth", "label"))
    # by varying text alone, if there is any, else by all
    labels = labels.join(totals.select("host", (F.col("varying") > CLOSE).alias("varies"),
                                       F.when(F.col("varying") > CLOSE, F.col("varying"))
                                       .otherwise(F.col("all")).alias("total")), "host")
    labels = labels.withColumn("chars", F.when(F.col("varies"), F.col("varying")).otherwise(F.col("chars")))
    labels = labels.filter(F.col("chars") > CLOSE).groupBy("host", "label", "total").agg(
        F.round(F.sum("chars"), 3).alias("chars"), F.max("depth").alias("depth"))
    found, holder = best(F.col("chars"))
    return labels.withColumn("kind", kind("label")).groupBy("host").agg(
        *[one["label"].alias(f"label{at}") for at, one in enumerate(found)]).select(
        "host", holder.alias("holder"))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper``: each host's wrapper, from all of its pages."""
    spark = pages.sparkSession
    rows = _single_pages(pages)
    parts = _aligned(_structures(rows))
    counts = stored(_counts(rows.join(parts.select("host", "part"), "host")),
                    working_dir(spark, "counts"))
    number = counts.filter("slot IS NULL AND path IS NULL").select("host", F.col("pages").alias("of"))
    having = counts.filter("slot IS NOT NULL AND path IS NULL").select(
        "host", "slot", F.col("pages").alias("having"))
    texts = counts.filter("text IS NOT NULL")
    fixed = stored(  # a fixed text is on two pages at least, or nearly
        texts.filter(F.col("text") != _digest("")).groupBy("host", "slot", "text")
        .agg(F.sum("pages").alias("pages")).filter(F.col("pages") >= 2 * SAME_TEXT - CLOSE)
        .join(having, ["host", "slot"]).join(number, "host")
        .filter((F.col("having") >= F.greatest(F.lit(2.0), MOST_PAGES * F.col("of")) - CLOSE)
                & (F.col("pages") >= SAME_TEXT * F.col("having") - CLOSE))
        .select("host", "slot", "text", "having"), working_dir(spark, "fixed"))
    paths = counts.filter("labels IS NOT NULL").select(
        "host", "path", F.filter(F.split("labels", "\n"), lambda label: label != "").alias("labels"))
    ours = texts.join(fixed.select("host", "slot", "text"), ["host", "slot", "text"]).groupBy(
        "host", "path").agg(F.sum("chars").alias("ours"))
    held = stored(
        counts.filter("slot IS NOT NULL AND path IS NOT NULL").groupBy("host", "path")
        .agg(F.sum("chars").alias("chars")).join(ours, ["host", "path"], "left")
        .join(paths, ["host", "path"])
        .select("host", "labels", "chars", F.coalesce("ours", F.lit(0.0)).alias("ours")),
        working_dir(spark, "held"))
    holders = stored(_holders(held), working_dir(spark, "holders"))

    kind = F.udf(lambda label: _name(label) in ("article", "main"), "boolean")
    inside = F.udf(lambda labels, holder: _inside(labels, holder), "boolean")
    copies = held.join(holders.filter(F.col("holder").isNotNull() & kind("holder")), "host").filter(
        inside("labels", "holder")).groupBy("host").agg(
        F.sum("chars").alias("chars"), F.sum("ours").alias("ours")).filter(
        F.col("ours") > MOST_FIXED * F.col("chars") + CLOSE)

    kept = fixed.join(copies, "host", "left_anti")
    slots = kept.groupBy("host", "slot").agg(
        F.sort_array(F.collect_list(F.when(F.col("having") >= LEAST_PAGES - CLOSE, F.col("text"))))
        .alias("fixed"))
    around = texts.join(slots.select("host", "slot"), ["host", "slot"]).join(
        kept.select("host", "slot", "text", F.lit(True).alias("ours")), ["host", "slot", "text"], "left")
    around = around.groupBy("host", "slot", "path").agg(
        F.round(F.sum("chars"), 3).alias("chars"),
        F.sum(F.when(F.col("ours"), F.col("chars")).otherwise(0.0)).alias("ours"))
    around = around.join(paths, ["host", "path"]).groupBy("host", "slot").agg(
        (F.sum("ours") >= 0.5 * F.sum("chars") - CLOSE).alias("template"),
        F.max(F.struct("chars", F.array_join("labels", "\n").alias("most")))["most"].alias("around"))
    slots = slots.join(around, ["host", "slot"]).groupBy("host").agg(
        F.collect_list(F.struct("slot", "template", "fixed", "around")).alias("slots"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for part, holder, slots in zip(batch["part"], batch["holder"], batch["slots"], strict=True):
                wrapper = Wrapper(unpack(part), holder)
                for slot in slots if slots is not None else ():
                    around = slot["around"].split("\n") if slot["around"] else []
                    wrapper.slots[slot["slot"]] = Slot(
                        bool(slot["template"]), frozenset(map(int, slot["fixed"])),
                        _around(around, holder))
                packed.append(pickle.dumps(wrapper))
            yield pd.DataFrame({"host": batch["host"], "wrapper": packed})

    built = parts.join(holders, "host", "left").join(slots, "host", "left").select(
        "host", "part", "holder", "slots")
    return stored(built.mapInPandas(build, "host string, wrapper binary"),
                  working_dir(spark, "wrappers"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per row of ``page_id, url, html``.

    Null HTML is empty, and an empty page has an empty text. Pages without a host in their URL share
    one wrapper. Blocks are joined in page order by one space. Other columns are not read.
    """
    wrappers = infer_wrappers(pages)
    rows = pages.select("page_id", "url", "html", host_and_path("url")[0].alias("host")).join(
        wrappers, "host", "left").drop("host")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, Wrapper] = {}
        for batch in batches:
            texts = []
            for page, packed in zip(batch["html"], batch["wrapper"], strict=True):
                wrapper = known.get(packed)
                if wrapper is None:
                    if len(known) >= 200:
                        known.clear()
                    wrapper = pickle.loads(packed) if packed else Wrapper([], None)
                    known[packed] = wrapper
                texts.append(wrapper.extract(page) if isinstance(page, str) else "")
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"],
                                "text": texts, "n_chars": [len(text) for text in texts]})

    return rows.mapInPandas(extract, "page_id long, url string, text string, n_chars long")
