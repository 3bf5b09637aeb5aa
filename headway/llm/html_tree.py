"""A forgiving HTML tree in linear time, its text blocks, and its block elements grouped for alignment.

Nothing here recurses, so depth is bounded by memory alone.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=\"']+)?[\s\"']*(=)?\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
_KEPT = frozenset(("class", "id", "role", "hidden", "aria-hidden"))


class Node:
    __slots__ = ("tag", "attributes", "children", "text")

    def __init__(self, tag: str, attributes: dict[str, str], text: str | None = None):
        self.tag, self.attributes, self.text = tag, attributes, text
        self.children: list[Node] = []

    @property
    def kind(self) -> str:
        """Tag, class and id: what two elements must share to be the same part of a layout."""
        named = " ".join(self.attributes.get(name, "") for name in ("class", "id")).strip()
        return f"{self.tag}.{named}"


def _tag_end(source: str, at: int, last_quote: dict[str, int]) -> tuple[int, dict[str, str], bool]:
    """Where a tag ends after its name, its attributes, and whether it closes itself."""
    found: dict[str, str] = {}
    size = len(source)
    while at < size:
        m = _ATTRIBUTE.match(source, at)
        name, at = m[1], m.end()
        if m[2]:
            quote = source[at : at + 1]
            if quote and quote in "\"'" and at < last_quote[quote]:
                end = source.find(quote, at + 1)
                value, at = source[at + 1 : end], end + 1
            else:
                value = _UNQUOTED.match(source, at)[0]
                at += len(value)
        else:
            value = ""
        if name and name.lower() in _KEPT:
            found.setdefault(name.lower(), " ".join(value.lower().split()))
        if source[at : at + 1] == ">":
            return at + 1, found, source[at - 1] == "/"
        if m.end() == m.start() and not value:
            at += 1
    return size, found, False


def tokens(source: str) -> Iterator[tuple[str, str, dict[str, str], int]]:
    """(kind, tag or text, attributes, end): kinds ``text``, ``open``, ``empty`` and ``close``; the consumer may move on by send()."""
    size, at = len(source), 0
    last_close = source.rfind(">")
    last_quote = {q: source.rfind(q) for q in "\"'"}
    while at < size:
        lt = source.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            yield "text", source[at:lt], {}, lt
            at = lt
            continue
        follows = source[lt + 1 : lt + 2]
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        slash = follows == "/"
        name = _NAME.match(source, lt + 1 + slash) if lt < last_close else None
        if name:
            at, attributes, empty = _tag_end(source, name.end(), last_quote)
            tag = name[0].lower()
            kind = "close" if slash else "empty" if empty or tag in _VOID else "open"
            moved = yield kind, tag, attributes, at
            if moved is not None:
                at = moved
                yield "text", "", {}, at
        elif follows in ("!", "?") and lt < last_close:
            at = source.find(">", lt) + 1
        else:
            yield "text", "<", {}, lt + 1
            at = lt + 1


def parse(source: str) -> Node:
    """The tree: missing end tags are supplied, stray ones ignored, scripts and the like left empty."""
    root = Node("#root", {})
    stack, open_tags = [root], Counter()

    def close_to(length: int) -> None:
        while len(stack) > length:
            open_tags[stack.pop().tag] -= 1

    def last(tag: str) -> int:
        k = len(stack) - 1
        while stack[k].tag != tag:
            k -= 1
        return k

    lowered = None
    stream = tokens(source)
    for kind, tag, attributes, end in stream:
        if kind == "text":
            if tag:
                stack[-1].children.append(Node("#text", {}, tag))
            continue
        if kind == "close":
            if open_tags[tag]:
                close_to(last(tag))
            continue
        if tag in _CLOSES_P and open_tags["p"]:
            close_to(last("p"))
        elif tag in _CLOSED_BY_SAME:
            ends = {"dt", "dd"} if tag in ("dt", "dd") else {tag}
            if any(open_tags[t] for t in ends):
                k = len(stack) - 1
                while k and stack[k].tag not in _CLOSED_BY_SAME[tag] and stack[k].tag not in ends:
                    k -= 1
                if k and stack[k].tag in ends:
                    close_to(k)
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if kind == "open":
            if tag in _RAW:
                lowered = source.lower() if lowered is None else lowered
                close = lowered.find(f"</{tag}", end) if len(lowered) == len(source) else -1
                stop = source.find(">", close) if close >= 0 else -1
                stream.send(len(source) if stop < 0 else stop + 1)
            else:
                stack.append(node)
                open_tags[tag] += 1
    return root


class Block:
    """A stretch of text that no block element or line break divides; ``group`` is its element's place in the layout."""

    __slots__ = ("text", "links", "group", "hidden")

    def __init__(self, text: str, links: int, group: int, hidden: bool):
        self.text, self.links, self.group, self.hidden = text, links, group, hidden


class Layout:
    """A page's text blocks and its groups of block elements.

    A group holds the like elements (same kind) below the elements of one group,
    so the groups form a tree whose siblings all differ in kind. ``hidden`` text
    belongs to elements that ``is_hidden`` names.
    """

    def __init__(self, source: str, is_hidden):
        self.kinds, self.parents, self.depths = ["#root"], [-1], [0]
        self.children: list[list[int]] = [[]]
        self.blocks: list[Block] = []
        found: dict[tuple[int, str], int] = {}
        pending: list[tuple[str, bool]] = []
        owner = [0, False]

        def flush() -> None:
            text = " ".join(html.unescape("".join(t for t, _ in pending)).split())
            if text:
                linked = sum(len(t) for t, in_link in pending if in_link)
                self.blocks.append(Block(text, min(linked, len(text)), *owner))
            pending.clear()

        # (node, hidden, in a link, group of the nearest block element) to enter, or None to end a block
        work: list = [(parse(source), False, False, 0)]
        while work:
            item = work.pop()
            if item is None:
                flush()
                continue
            node, hidden, in_link, group = item
            if node.text is not None:
                if not pending or owner != [group, hidden]:
                    flush()
                    owner[:] = [group, hidden]
                pending.append((node.text, in_link))
                continue
            if node.tag in ("br", "hr"):
                flush()
                continue
            hidden = hidden or is_hidden(node)
            if node.tag not in INLINE and node.tag != "#root":
                flush()
                work.append(None)
                key = (group, node.kind)
                inner = found.get(key)
                if inner is None:
                    inner = found[key] = len(self.kinds)
                    self.kinds.append(node.kind)
                    self.parents.append(group)
                    self.depths.append(self.depths[group] + 1)
                    self.children.append([])
                    self.children[group].append(inner)
                group = inner
            in_link = in_link or node.tag == "a"
            for child in reversed(node.children):
                work.append((child, hidden, in_link, group))
        flush()

    def paths(self) -> list[int]:
        """A 64-bit name of each group, from the kinds on the way to it."""
        out: list[int] = []
        for kind, parent in zip(self.kinds, self.parents):
            above = out[parent] if parent >= 0 else 0
            name = hashlib.blake2b(kind.encode("utf-8", "replace"), digest_size=8, key=above.to_bytes(8, "little", signed=True))
            out.append(int.from_bytes(name.digest(), "little", signed=True))
        return out

    def signature(self) -> int:
        """Names the page's longest text: pages that share it are copies of one another."""
        longest = max((b.text for b in self.blocks if not b.hidden), key=len, default="")
        return text_hash(longest)


def text_hash(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _heaviest_rise(ranks: list[int], weights: list[int]) -> list[int]:
    """Places of the heaviest subsequence with rising ``ranks`` (all different): a Fenwick tree of best sums."""
    order = {r: k + 1 for k, r in enumerate(sorted(ranks))}
    tree = [(0, -1)] * (len(ranks) + 1)
    before = []
    for place, (rank, weight) in enumerate(zip(ranks, weights)):
        k, best = order[rank] - 1, (0, -1)
        while k:
            best = max(best, tree[k])
            k &= k - 1
        before.append(best[1])
        k, here = order[rank], (best[0] + weight, place)
        while k < len(tree):
            tree[k] = max(tree[k], here)
            k += k & -k
    k, best = len(ranks), (0, -1)
    while k:
        best = max(best, tree[k])
        k &= k - 1
    out, place = [], best[1]
    while place >= 0:
        out.append(place)
        place = before[place]
    return out[::-1]


def matched(layout: Layout, paths: list[int], wrapper: dict[int, tuple[int, int]]) -> set[int]:
    """Simple tree matching of a page's groups with a wrapper's (path -> (parent path, order)): the groups matched.

    Roots match; of two matched nodes' children, like kinds may match as long as
    no two matches cross, and the matching with most nodes is taken. Siblings
    differ in kind, so only equal paths can match and the best matching of
    children is a heaviest rising subsequence.
    """
    common = [k for k, path in enumerate(paths) if k == 0 or path in wrapper]
    members = set(common)
    sizes: dict[int, int] = {}
    chosen: dict[int, list[int]] = {}
    for k in sorted(common, key=lambda k: -layout.depths[k]):
        children = [c for c in layout.children[k] if c in members]
        if len(children) > 1:
            rise = _heaviest_rise([wrapper[paths[c]][1] for c in children], [sizes[c] for c in children])
            children = [children[p] for p in rise]
        chosen[k] = children
        sizes[k] = 1 + sum(sizes[c] for c in children)
    out, work = set(), [0]
    while work:
        k = work.pop()
        out.add(k)
        work += chosen.get(k, ())
    return out
