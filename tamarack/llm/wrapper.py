"""Main text of HTML pages by wrapper induction.

The DOM trees of the pages of one host are aligned by simple tree matching and merged into one tree, the host's wrapper. Its slots
know on how many pages they stand, how much text and link text they hold, and whether their text varies between pages. The content
lies where the text varies: below the lowest node that covers the varying text outside links. Article and main elements narrow
that down to themselves if they hold at least half of the varying text, or half of all text (copies of one article under many
addresses vary only outside it). Inside the content, elements that stand alike on all pages that have their slot are template, if
these are most of the pages with the content, differ, and such elements hold at most half of the content's text; headings and all
that a page would be left with are kept. Menus, headers, footers and the like are template even where their text varies. Slots are
told apart by tag and by words of class and id that recur on the host's pages, so that a tree is bounded by the template. Merging
is done per task first, then per host in rounds of shares, so that no task sees all pages of a host.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.llm.common import written
from tamarack.llm.urls import split_url

#: Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html", "tr", "tbody", "tfoot", "thead", "li", "dd", "dt"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = frozenset("table td th ul ol dl select body html article section div aside nav footer header main form".split())

#: Elements and roles that mark template whatever it says, and words of class or id that mark it outside the main varying text.
SKIPPED = frozenset("head script style noscript template iframe svg nav footer aside form button select textarea dialog menu title".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice alert popup modal overlay sidebar"
    " menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments respond replies disqus share sharing social"
    " related recommended newsletter subscribe signup login".split()
)

#: Words that may stand beside such a word in one hyphenated class.
PLAIN = frozenset("box bar block list links area wrap wrapper container section widget posts items buttons form slot unit text top bottom".split())
#: Elements that no word of a class makes template.
OPEN = frozenset("html body main article".split())
#: What a node or slot is: content, template if its words are right, template.
KEPT, HINTED, DROPPED = range(3)

#: Depth to which a tree is kept. Deeper elements are open besides it: their text goes to the
#: element at that depth, or to the first of them with hint words, or nowhere below template.
DEPTH = 60

#: Share of a host's pages on which a word of class or id must stand to be part of labels.
RECURS = 0.1
#: Parts of lists and tables, which are template only with the whole list or table, and headings, which are never constant template.
ROWS = frozenset("li dt dd tr td th tbody thead tfoot caption option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>?", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")


class Node:
    """An element of a page: its label (tag, role, mark and recurring words of class and id) and its children and texts in order."""

    __slots__ = ("tag", "label", "skip", "items", "mark", "own")

    def __init__(self, tag: str, label: str, skip: int):
        self.tag, self.label, self.skip, self.items, self.mark, self.own = tag, label, skip, [], None, None


def _hints(value: str) -> bool:
    """Whether a class or id has a token made of hint words, at most with plain ones: cookie-notice, share-box, not has-banner."""
    for token in value.split():
        words = re.findall(r"[a-z]+", token)
        if HINTS.intersection(words) and all(w in HINTS or w in PLAIN for w in words):
            return True
    return False


def _words(kind: str, value: str) -> list[str]:
    """Tokens of a class, or the id, without digits."""
    words = ("-".join(re.findall(r"[a-z]+", token)) for token in value.split())
    return [("#" if kind == "id" else "") + w for w in words if w]


def _node(tag: str, token: str, ranks: dict[str, int] | None) -> Node:
    skip, role, found = DROPPED if tag in SKIPPED else KEPT, "", set()
    for m in _ATTRIBUTE.finditer(token) if " " in token or "\n" in token or "\t" in token else ():
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "role":
            skip, role = DROPPED if value in ROLES else skip, value if value in ROLES or value == "main" else ""
        elif kind == "hidden":
            skip = DROPPED
        else:
            if tag not in OPEN and _hints(value):
                skip = max(skip, HINTED)
            found.update(_words(kind, value))
    if ranks is not None:  # of the words that recur, the commonest and the rarest
        known = sorted((ranks[w], w) for w in found if w in ranks)
        found = {w for _, w in known[:1] + known[-1:]}
    label = " ".join([tag, *(f"role={role}" for _ in role[:1]), *(str(skip) for _ in range(skip > 0)), *sorted(found)])
    return Node(tag, label, skip)


def parse(source: str, ranks: dict[str, int] | None = None) -> Node:
    """The tree of a page, with labels of the words that have ranks, or all. Unclosed and misplaced tags are mended as browsers do in the common cases."""
    root = Node("html", "html", KEPT)
    stack = [root]
    over: list[Node] = []  # open elements below the depth that is kept
    names_over: Counter[str] = Counter()
    void: list[int] = []  # places in ``over`` of elements that are, or may be, template
    at = 0

    def put(item: str | Node) -> None:
        if not void:
            stack[-1].items.append(item)
        elif item and all(over[k].skip != DROPPED for k in void):
            over[void[0]].items.append(item)  # the wrapper decides on its words

    def text(piece: str) -> None:
        if piece:
            put(piece)

    def cut(k: int) -> None:
        """Close the elements from place k of ``over`` on."""
        border = False
        for node in over[k:]:
            names_over[node.tag] -= 1
            border = border or node.tag in BLOCKS
        del over[k:]
        while void and void[-1] >= k:
            void.pop()
        if border:
            put(Node("br", "br", KEPT))

    def close(names: set[str] | frozenset[str]) -> None:
        for k in range(len(over) - 1, -1, -1):
            if over[k].tag in names:
                return cut(k)
            if over[k].tag in FENCES:
                return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return cut(0)
            if stack[k].tag in FENCES:
                return

    end = len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        token = m[0]
        if token.startswith("<![CDATA["):
            text(token[9:].removesuffix("]]>"))
            continue
        if token[1] in "!?":
            continue
        tag = _NAME.match(token)[1].lower()
        if token[1] == "/":
            if names_over[tag]:
                cut(next(k for k in range(len(over) - 1, -1, -1) if over[k].tag == tag))
                continue
            if tag == "p" and any(n.tag in FENCES for n in over):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    cut(0)
                    break
                if tag == "p" and stack[k].tag in FENCES:
                    break
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P:
            close({"p"})
        if tag in SIBLINGS:
            close(SIBLINGS[tag])
        if tag[0] == "h" and tag[1:].isdigit():
            close({"h1", "h2", "h3", "h4", "h5", "h6"})
        if tag == "body":
            del stack[1:]
            cut(0)
        node = _node(tag, token, ranks)
        put(node)
        if tag in VOID or token.endswith("/>"):
            continue
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(source, at)
            inner = source[at : stop.start() if stop else end]
            if inner:
                node.items.append(inner)
            at = source.find(">", stop.start()) + 1 if stop else end
            at = at or end
            continue
        if len(stack) < DEPTH and not over:
            stack.append(node)
            continue
        if node.skip:
            void.append(len(over))
        over.append(node)
        names_over[tag] += 1
    return root


# A slot of a wrapper: [label, tag, skip, pages, characters, characters in links, text sum, varies, children, marks that stand on all
# of its pages, mark of one of its pages, whether its pages differ]
LABEL, TAG, SKIP, PAGES, CHARS, LINKED, TEXT, VARIES, CHILDREN, COMMON, PAGE, DIFFERS = range(12)
_LENGTH = 20


def _own_text(node: Node) -> str:
    """The text of an element besides that of its children, with single spaces."""
    if node.own is None:
        texts = [i for i in node.items if i.__class__ is str]
        node.own = " ".join(" ".join(texts).split()) if texts else ""
    return node.own


def mark_of(node: Node) -> int:
    """A hash of the text of an element outside template, with its length in the last bits; 0 without text."""
    if node.mark is None:
        node.mark = 0
        if node.skip != DROPPED:
            own = _own_text(node)
            marks = [m for i in node.items if i.__class__ is Node and (m := mark_of(i))]
            if own or marks:
                size = len(own) + sum(m & ((1 << _LENGTH) - 1) for m in marks)
                parts = own.encode("utf-8", "replace") + b"\0" + b"".join([m.to_bytes(8, "big") for m in marks])
                found = int.from_bytes(hashlib.blake2b(parts, digest_size=5).digest(), "big")
                node.mark = found << _LENGTH | min(size, (1 << _LENGTH) - 1)
    return node.mark


def _page_mark(page: Node) -> int:
    """A mark of the page's text outside elements with hint words."""
    texts, stack = [], [page]
    while stack:
        node = stack.pop()
        if node.skip == KEPT:
            texts.append(_own_text(node))
            stack += [i for i in node.items if i.__class__ is Node]
    return zlib.crc32("\0".join(texts).encode("utf-8", "replace"))


def tree_of(page: Node) -> list:
    """The slots of one page: children of one label are one repeating slot."""
    tree = _tree_of(page, False, _page_mark(page))
    stack = [tree]
    while stack:
        slot = stack.pop()
        slot[COMMON] = sorted(slot[COMMON])
        stack += slot[CHILDREN]
    return tree


def _tree_of(node: Node, linked: bool, page: int) -> list:
    linked = linked or node.tag == "a"
    own = _own_text(node) if node.skip != DROPPED else ""
    children: dict[str, list] = {}
    for item in node.items:
        if isinstance(item, Node):
            slot = _tree_of(item, linked, page)
            there = children.get(item.label)
            children[item.label] = slot if there is None else merge(there, slot, same_page=True)
    size = len(own)
    text, mark = zlib.crc32(own.encode("utf-8", "replace")) if own else 0, mark_of(node)
    common = {mark} if mark else set()  # a set while the page's own slots are joined
    return [node.label, node.tag, node.skip, 1, size, size if linked else 0, text, False, list(children.values()), common, page, False]


def matching(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the largest number of slots that pair off in order, and the pairs among the children."""
    if a[LABEL] != b[LABEL]:
        return 0, []
    left, right = a[CHILDREN], b[CHILDREN]
    if [c[LABEL] for c in left] == [c[LABEL] for c in right]:
        return 1 + sum(matching(x, y)[0] for x, y in zip(left, right)), [(k, k) for k in range(len(left))]
    weight = {(i, j): matching(x, y)[0] for i, x in enumerate(left) for j, y in enumerate(right) if x[LABEL] == y[LABEL]}
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(1, len(left) + 1):
        for j in range(1, len(right) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + weight.get((i - 1, j - 1), 0))
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
    return 1 + best[-1][-1], pairs[::-1]


def _labels(slot: list) -> list[str]:
    return [c[LABEL] for c in slot[CHILDREN]]


def _merge_children(left: list, right: list, matched: list[tuple[int, int]] | None, same_page: bool) -> list:
    """Children of two slots as one list, by the pairs that match; None if all pair off in order."""
    if matched is None:
        return [merge(x, y, same_page) for x, y in zip(left, right)]
    pairs = dict(matched)
    partner = {j: i for i, j in pairs.items()}
    children, seen = [], 0
    for i, x in enumerate(left):
        if i in pairs:
            children += [y for j, y in enumerate(right[seen : pairs[i]], seen) if j not in partner]
            seen = pairs[i] + 1
            children.append(merge(x, right[pairs[i]], same_page))
        else:
            children.append(x)
    children += right[seen:]
    merged: dict[str, list] = {}
    for c in children:  # a slot that moved to another place stays one slot
        there = merged.get(c[LABEL])
        merged[c[LABEL]] = c if there is None else merge(there, c, same_page)
    return list(merged.values())


def merge(a: list, b: list, same_page: bool = False) -> list:
    """Two aligned trees as one; children without a partner stay where they stood."""
    slots = _merge_children(a[CHILDREN], b[CHILDREN], matching(a, b)[1] if _labels(a) != _labels(b) else None, same_page)
    varies = a[VARIES] or b[VARIES] or (not same_page and a[TEXT] != b[TEXT])
    text = zlib.crc32(f"{a[TEXT]} {b[TEXT]}".encode()) if same_page else a[TEXT]
    pages = max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES]
    if same_page:
        common = a[COMMON]
        common |= b[COMMON]
    else:
        common = sorted(set(a[COMMON]).intersection(b[COMMON]))
    differs = a[DIFFERS] or b[DIFFERS] or a[PAGE] != b[PAGE]
    chars, links = a[CHARS] + b[CHARS], a[LINKED] + b[LINKED]
    return [a[LABEL], a[TAG], max(a[SKIP], b[SKIP]), pages, chars, links, text, varies, slots, common, a[PAGE], differs]


def _settle(wrapper: list) -> None:
    """Decide on the slots with hint words: they are template unless they hold the content, which is at least half of the text that
    varies, while there is no article or main element with text of its own outside them."""

    def texts(slot: list) -> int:
        return 0 if slot[SKIP] == DROPPED else (slot[CHARS] - slot[LINKED] if slot[VARIES] or alone else 0) + sum(map(texts, slot[CHILDREN]))

    def named(slot: list) -> bool:
        return not slot[SKIP] and (_rank(slot) is not None and texts(slot) > 0 or any(map(named, slot[CHILDREN])))

    def decide(slot: list) -> None:
        if slot[SKIP] == HINTED:
            slot[SKIP] = KEPT if not elsewhere and whole and 2 * texts(slot) >= whole else DROPPED
        for c in slot[CHILDREN]:
            decide(c)

    alone = False
    alone = wrapper[PAGES] == 1 or not texts(wrapper)
    whole, elsewhere = texts(wrapper), named(wrapper)
    decide(wrapper)


def _rank(slot: list) -> int | None:
    """0 for an article, 1 for a main element, else None."""
    return 0 if slot[TAG] == "article" else 1 if slot[TAG] == "main" or "role=main" in slot[LABEL] else None


def _varying(slot: list, alone: bool) -> int:
    """Characters of varying text outside links and template below a slot."""
    if slot[SKIP]:
        return 0
    return _own(slot, alone) + sum(_varying(c, alone) for c in slot[CHILDREN])


def _own(slot: list, alone: bool) -> int:
    """Characters of a slot's own text outside links, if it varies; on one page only, there is nothing that it agrees with."""
    return slot[CHARS] - slot[LINKED] if slot[VARIES] or alone or slot[PAGES] == 1 else 0


def content_roots(wrapper: list) -> tuple[list[tuple[str, ...]], bool, set[tuple[str, ...]]]:
    """Label paths of the slots that hold the content, whether elements say so, and paths near the top that are not content.

    It is the lowest slot that covers all varying text outside links. Down from there to where that text is spread out, slots
    without such text are not content, and a path that ends in "" stands for a slot's own text. Article and main elements take its
    place if they hold at least half of that text, or half of all text outside links.
    """
    queue, named = [((), wrapper)], []
    alone = wrapper[PAGES] == 1 or not _varying(wrapper, False)
    while queue:
        path, slot = queue.pop(0)
        if slot[SKIP]:
            continue
        if _rank(slot) is not None:
            named.append((path, slot))
            continue
        queue += [((*path, c[LABEL]), c) for c in slot[CHILDREN]]
    if named and any(2 * sum(_varying(s, whole) for _, s in named) >= _varying(wrapper, whole) for whole in {alone, True}):
        return [path for path, _ in named], True, set()
    path, slot, root, aside = (), wrapper, (), set()
    covers = True
    while slot[CHILDREN]:
        mass = {c[LABEL]: _varying(c, alone) for c in slot[CHILDREN]}
        whole = _own(slot, alone) + sum(mass.values())
        heavy = max(slot[CHILDREN], key=lambda c: mass[c[LABEL]])
        text_tags = ("p", "h1", "h2", "h3", "ul", "ol", "table", "a", "b", "i", "span", "em", "strong", "blockquote", "pre")
        if not whole or heavy[TAG] in text_tags or mass[heavy[LABEL]] < 0.7 * whole:
            break
        covers = covers and mass[heavy[LABEL]] == whole
        aside.update((*path, label) for label, m in mass.items() if not m)
        if not _own(slot, alone):
            aside.add((*path, ""))
        path, slot = (*path, heavy[LABEL]), heavy
        if covers:
            root = path
    return [root], False, aside


def _constant(slot: list, pages: int) -> list[int]:
    """Marks of the elements of a slot that stand on all its pages, while these differ and are most of ``pages``: template."""
    most = slot[PAGES] > 1 and 2 * slot[PAGES] > pages and slot[DIFFERS]
    return slot[COMMON] if most and slot[TAG] not in ROWS and slot[TAG] not in HEADINGS else []


def _weights(slot: list, pages: int) -> tuple[int, int]:
    """Characters of constant elements below a slot on a page, and of all text below it on all pages."""
    below = [_weights(c, pages) for c in slot[CHILDREN] if slot[SKIP] != DROPPED]
    constant = max(sum(m & ((1 << _LENGTH) - 1) for m in _constant(slot, pages)), sum(b[0] for b in below))
    return constant, (slot[CHARS] if slot[SKIP] != DROPPED else 0) + sum(b[1] for b in below)


#: Marks of constant elements by the label path of their slot.
Marks = dict[tuple[str, ...], frozenset[int]]


class Wrapper:
    """A host's merged tree, ready to extract, and the ranks of the words in its labels."""

    def __init__(self, tree: list, ranks: dict[str, int] | None = None):
        self.tree, self.ranks = tree, ranks
        _settle(tree)
        roots, self.named, self.aside = content_roots(tree)
        self.roots = set(roots)
        self.above = {r[:k] for r in roots for k in range(len(r))}
        self.constant: Marks = {}
        self.kept: set[tuple[str, ...]] = set()  # with hint words, but content
        for root in roots:
            slot = tree
            for k, label in enumerate(root):
                slot = next(c for c in slot[CHILDREN] if c[LABEL] == label)
                self.kept.add(root[: k + 1])
            below = [_weights(c, slot[PAGES]) for c in slot[CHILDREN] if not c[SKIP]]
            minor = 2 * slot[PAGES] * sum(b[0] for b in below) <= slot[CHARS] + sum(b[1] for b in below)
            self._mark(slot, root, slot[PAGES] if minor else None)

    def _mark(self, slot: list, path: tuple[str, ...], pages: int | None) -> None:
        for c in slot[CHILDREN]:
            below = (*path, c[LABEL])
            if not c[SKIP]:
                self.kept.add(below)
            if pages and (marks := _constant(c, pages)):
                self.constant[below] = frozenset(marks)
            self._mark(c, below, pages)

    def blocks(self, page: Node) -> list[str] | None:
        """Content blocks of a page; None if the page has no slot where the wrapper has its content. Constant elements are kept if
        nothing else is there."""
        blocks: list[str] = []
        for constant in (self.constant, {}) if self.constant else ({},):
            out: list[list[str]] = [[]]
            fits = self._find(page, (), out, constant)
            found = (" ".join(entities.unescape("".join(b)).split()) for b in out)
            blocks = [b for b in found if b]
            if blocks or not fits:
                break
        return blocks if fits and (blocks or self.named) else None

    def _find(self, node: Node, path: tuple[str, ...], out: list[list[str]], constant: Marks) -> bool:
        """Walk the content slots of a page in order; whether there are any."""
        if path in self.roots:
            out.append([])
            self._walk(node, path, out, constant)
            return True
        fits = False
        if path in self.above:
            for item in node.items:
                if isinstance(item, Node) and item.skip != DROPPED:
                    fits = self._find(item, (*path, item.label), out, constant) or fits
        return fits

    def _walk(self, node: Node, path: tuple[str, ...], out: list[list[str]], constant: Marks) -> None:
        silent = (*path, "") in self.aside
        for item in node.items:
            if isinstance(item, str):
                if not silent:
                    out[-1].append(item)
            elif item.tag in BLOCKS:
                out.append([])
                below = (*path, item.label)
                if not self._template(item, below, constant):
                    self._walk(item, below, out, constant)
                    out.append([])
            elif item.tag in ("td", "th"):
                out[-1].append(" ")
                self._walk(item, (*path, item.label), out, constant)
                out[-1].append(" ")
            elif not self._template(item, below := (*path, item.label), constant):
                self._walk(item, below, out, constant)

    def _template(self, item: Node, below: tuple[str, ...], constant: Marks) -> bool:
        if below in constant and mark_of(item) in constant[below]:
            return True
        return item.skip == DROPPED or below in self.aside or item.skip == HINTED and below not in self.kept


def extract(source: str | None, wrapper: Wrapper | None) -> str:
    """Main text of a page: its blocks joined by newlines."""
    if not source:
        return ""
    blocks = wrapper.blocks(parse(source, wrapper.ranks)) if wrapper else None
    if blocks is None:
        page = parse(source)
        blocks = Wrapper(tree_of(page)).blocks(page)
    return "\n".join(blocks or [])


def _ranks(words: list[str] | None) -> dict[str, int] | None:
    return None if words is None else {w: k for k, w in enumerate(words)}


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages that have a word of class or id, per host; the word "" counts all pages."""
    counts: Counter[tuple[str | None, str]] = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        if counts:
            hosts, words = zip(*counts)
            arrays = [pa.array(hosts, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "word", "n"])
            counts.clear()

    for batch in batches:
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            if source := source.as_py():
                words = {""}
                for token in re.findall(r"<[a-zA-Z][^<>]*=[^<>]*", source):
                    for m in _ATTRIBUTE.finditer(token):
                        if (kind := m[1].lower()) in ("class", "id"):
                            words.update(_words(kind, (m[2] or m[3] or m[4] or "").lower()))
                counts.update((host, w) for w in words)
            if len(counts) > 100_000:
                yield from flush()
    yield from flush()


def recurring_words(pages: DataFrame) -> DataFrame:
    """Words of class and id that stand on two pages or more and on ``RECURS`` of a host's pages, commonest first: host, words.

    So a host has at most 1 / ``RECURS`` times as many as its pages have on average. On a host with one page all words count.
    """
    counts = pages.where("html IS NOT NULL").mapInArrow(_count_words, "host string, word string, n long")
    counts = counts.groupBy("host", "word").agg(F.sum("n").alias("n"))
    sizes = counts.where("word = ''").select("host", F.col("n").alias("pages"))
    kept = counts.where("word <> ''").join(sizes, "host").where((F.col("pages") == 1) | (F.col("n") >= F.greatest(F.lit(2), F.col("pages") * RECURS)))
    words = kept.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("words"))
    return sizes.join(words, "host", "left").select("host", F.coalesce(F.col("words.word"), F.array().cast("array<string>")).alias("words"))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees: dict[str, list] = {}
    ranks: dict[str, dict[str, int] | None] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        if trees:
            packed = [_pack(list(ranks[h]) if ranks[h] is not None else None, t) for h, t in trees.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(trees), pa.string()), pa.array(packed, pa.string())], ["host", "wrapper"])
            trees.clear()
            ranks.clear()

    for batch in batches:
        for host, source, words in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if source := source.as_py():
                if host not in ranks:
                    ranks[host] = _ranks(words.as_py())
                tree = tree_of(parse(source, ranks[host]))
                trees[host] = merge(trees[host], tree) if host in trees else tree
        if len(trees) > 2000:
            yield from flush()
    yield from flush()


def _pack(words: list[str] | None, tree: list) -> str:
    return json.dumps([words, tree], separators=(",", ":"))


def _merge_group(group: pa.Table) -> pa.Table:
    host, words, merged = group["host"][0].as_py(), None, None
    for packed in sorted(group["wrapper"].to_pylist()):
        words, tree = json.loads(packed)
        merged = tree if merged is None else merge(merged, tree)
    return pa.table({"host": pa.array([host], pa.string()), "wrapper": pa.array([_pack(words, merged)], pa.string())})


def induce_wrappers(pages: DataFrame, rounds: tuple[int, ...] = (512, 64, 8)) -> DataFrame:
    """One wrapper per host: host, wrapper (JSON of the words in its labels and its tree). Takes host and html.

    A host's trees are merged in rounds of fewer and fewer shares.
    """
    pages = pages.select("host", "html").where("html IS NOT NULL")
    words = written(recurring_words(pages), "wrapper-words")
    trees = pages.join(words, "host", "left").select("host", "html", "words").mapInArrow(_skeletons, "host string, wrapper string")

    def run(group: pa.Table) -> pa.Table:
        return _merge_group(group)

    for shares in rounds:
        trees = trees.withColumn("share", F.pmod(F.xxhash64("wrapper"), F.lit(shares)))
        trees = trees.groupBy("host", "share").applyInArrow(run, "host string, wrapper string")
    return trees.groupBy("host").applyInArrow(run, "host string, wrapper string")


def _extract_batches(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    ready: dict[str, Wrapper] = {}
    for batch in batches:
        texts = []
        packed, sources = (batch.column(batch.schema.get_field_index(c)) for c in ("_wrapper", "html"))
        for tree, source in zip(packed, sources):
            tree = tree.as_py()
            if tree is not None and tree not in ready:
                if len(ready) >= 1000:
                    ready.clear()
                words, merged = json.loads(tree)
                ready[tree] = Wrapper(merged, _ranks(words))
            texts.append(extract(source.as_py(), ready.get(tree)))
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keep, "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Add ``text``, the main text from ``html``, to every row; ``url`` gives the host.

    Null or empty html has an empty text; pages without a host share one wrapper, and a page that does not fit its host's wrapper
    is judged by its own tree. Equal pages get equal texts. An existing ``text`` is replaced; an empty table gives an empty result.
    """
    kept = [c for c in pages.columns if c not in ("text", "_host", "_wrapper")]
    rows = pages.select(*kept, split_url("url")[0].alias("_host"))
    wrappers = written(induce_wrappers(rows.select(F.col("_host").alias("host"), "html")), "wrappers")
    wrappers = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    joined = rows.join(wrappers, "_host", "left").select(*kept, "_wrapper")
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField("text", T.StringType())])
    return joined.mapInArrow(partial(_extract_batches, keep=kept), schema)
