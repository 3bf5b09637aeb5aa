"""Suffix sorting by induction, with disk-backed priority queues and common-prefix values.

The sorter works on one shard. Suffixes that start a rise after a fall (here:
peaks' feet, "S*") are sorted first: the stretches between them are ranked and
form a shorter text, whose suffixes are sorted by the same method, or directly
once that text is short. From the sorted feet all falling suffixes are induced in
ascending order, and from those all rising ones in descending order. Induction
takes suffixes from a queue whose priority is (first symbol, arrival) and puts
the suffix one symbol longer back; each entry carries the common prefix with the
entry before it, one more than the least common prefix passed since the last
entry with its symbol. Queues spill to unnamed scratch files of the task beyond a
memory bound, as Spark's own sorts do; nothing outlives the task.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

QUEUE_BYTES = 64 << 20
SHORT = 1 << 22
COMPARED = 1 << 22  # symbols compared at once
FAR = np.int32(2**30)


class DiskQueue:
    """Entries (position, common prefix) by symbol, first in first out within a symbol."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self.chunks: dict[int, list] = {}
        self.limit, self.held = limit, 0
        self.file = None

    def push(self, symbol: int, position: np.ndarray, lcp: np.ndarray) -> None:
        self.chunks.setdefault(symbol, []).append((position, lcp))
        self.held += position.nbytes + lcp.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, chunks in self.chunks.items():
            for k, chunk in enumerate(chunks):
                if chunk is not None and isinstance(chunk[0], np.ndarray):
                    at = self.file.tell()
                    chunk[0].tofile(self.file)
                    chunk[1].tofile(self.file)
                    chunks[k] = (at, len(chunk[0]))
        self.held = 0

    def pop(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The symbol's chunks in order, those pushed meanwhile included."""
        chunks = self.chunks.get(symbol, [])
        at = 0
        while at < len(chunks):
            chunk, chunks[at] = chunks[at], None
            at += 1
            if isinstance(chunk[0], np.ndarray):
                self.held -= chunk[0].nbytes + chunk[1].nbytes
                yield chunk
            else:
                self.file.seek(chunk[0])
                yield np.fromfile(self.file, np.int64, chunk[1]), np.fromfile(self.file, np.int32, chunk[1])
        self.chunks.pop(symbol, None)


def rising(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after; the last (the sentinel) counts as rising."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    # where symbols repeat, the next change decides
    change = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(change[::-1])[::-1]
    return np.concatenate((np.append(step, -1)[following] > 0, [True]))


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length, up to ``limit``, of the common prefixes of pairs of different suffixes, compared a block at a time."""
    out = np.zeros(len(a), np.int32)
    live = np.arange(len(a))
    depth, block = 0, 8
    while len(live) and depth < limit:
        # past the end stands a symbol unlike any other; two different suffixes never both reach it
        padded = np.append(text, np.full(block, -1, text.dtype))
        views = np.lib.stride_tricks.sliding_window_view(padded, block)
        going = []
        for part in np.array_split(live, -(-len(live) * block // COMPARED)):
            differ = views[a[part] + depth] != views[b[part] + depth]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), block)
            out[part] = depth + first
            going.append(part[first == block])
        live = np.concatenate(going)
        depth += block
        block = min(2 * block, 64)
    return np.minimum(out, limit)


def _numbered(values: np.ndarray) -> np.ndarray:
    """Dense ranks of small non-negative integers."""
    return np.cumsum(np.bincount(values) > 0)[values] - 1


def _ranked(text: np.ndarray, is_rising: np.ndarray, feet: np.ndarray) -> np.ndarray:
    """Order-keeping numbers of the stretches from each foot to the next, equal for equal stretches."""
    last = np.append(feet[1:], feet[-1])
    symbols = text.astype(np.int64) * 2 + is_rising
    rank = _numbered(symbols[feet])
    depth = 1
    open_ = np.flatnonzero(feet + depth <= last)
    while len(open_):
        size = np.bincount(rank, minlength=int(rank.max()) + 1)
        open_ = open_[(size[rank[open_]] > 1)]
        if not len(open_):
            break
        key = np.full(len(feet), -1, np.int64)
        key[open_] = symbols[feet[open_] + depth]
        # only ranks with an open stretch are split further
        split = np.zeros(len(size), bool)
        split[rank[open_]] = True
        moved = np.flatnonzero(split[rank])
        order = moved[np.lexsort((key[moved], rank[moved]))]
        new = np.concatenate(([True], (rank[order][1:] != rank[order][:-1]) | (key[order][1:] != key[order][:-1])))
        first_of = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
        # ranks count the stretches that are smaller, so splitting one leaves the others as they are
        before = np.cumsum(size) - size
        start = np.maximum.accumulate(np.where(first_of, np.arange(len(order)), 0))
        inner = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        wide = before[rank]
        wide[order] = before[rank[order]] + (inner - start)
        rank = _numbered(wide)
        depth += 1
        open_ = open_[feet[open_] + depth <= last[open_]]
    return rank


def doubled(text: np.ndarray) -> np.ndarray:
    """Suffix array of a short text, by sorting prefixes of doubling length; settled suffixes are not sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.append(True, text[order[1:]] != text[order[:-1]])
    rank = np.empty(n, np.int64)  # how many suffixes are known to be smaller
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width = 1
    while True:
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)  # places in the order that are still shared
        if not len(at):
            return order
        open_ = order[at]
        far = np.zeros(len(open_), np.int64)
        inside = open_ + width < n
        far[inside] = rank[open_[inside] + width] + 1
        key = rank[open_] * (n + 1) + far
        turn = np.argsort(key)
        order[at], key = open_[turn], key[turn]
        fresh = np.append(True, key[1:] != key[:-1])
        new[at] = fresh
        rank[order[at]] = np.maximum.accumulate(np.where(fresh, at, 0))
        width *= 2


class _Induction:
    """Puts suffixes one symbol longer into the queue, with their common prefixes."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, limit: int, queue: DiskQueue, symbols: int):
        self.text, self.wanted, self.limit, self.queue = text, wanted, limit, queue
        self.least = np.zeros(symbols, np.int32)  # the least common prefix passed since the last push, by symbol

    def scan(self, position: np.ndarray, lcp: np.ndarray) -> None:
        self.least = np.minimum(self.least, FAR)
        before = position - 1
        at = np.flatnonzero((position > 0) & self.wanted[before])
        whole = int(lcp.min())
        if not len(at):
            np.minimum(self.least, whole, out=self.least)
            return
        symbol = self.text[before[at]]
        order = np.argsort(symbol.astype(np.uint16) if len(self.least) <= 1 << 16 else symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        first = np.concatenate(([True], symbol[1:] != symbol[:-1]))
        begin = np.where(first, 0, np.concatenate(([0], at[:-1] + 1)))
        padded = np.append(lcp, FAR)
        passed = np.minimum.reduceat(padded, np.column_stack((begin, at + 1)).ravel())[::2]
        heads = np.flatnonzero(first)
        passed[heads] = np.minimum(passed[heads], self.least[symbol[heads]])
        tails = np.append(heads[1:], len(at)) - 1
        np.minimum(self.least, whole, out=self.least)
        rest = np.minimum.reduceat(padded, np.column_stack((at[tails] + 1, np.full(len(tails), len(lcp)))).ravel())[::2] if len(tails) else []
        self.least[symbol[tails]] = np.where(at[tails] + 1 < len(lcp), rest, FAR)
        value = np.minimum(passed + 1, self.limit).astype(np.int32)
        for a, b in zip(heads, np.append(heads[1:], len(at))):
            self.queue.push(int(symbol[a]), before[at[a:b]].astype(np.int64), value[a:b])


def suffix_array(text: np.ndarray, limit: int = 1 << 20, queue_bytes: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``text`` in order, and each one's common prefix (up to ``limit``) with the one before.

    ``text`` holds small non-negative integers and ends with a 0 that stands nowhere else.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int32)
    up = rising(text)
    feet = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    rank = _ranked(text, up, feet)
    if rank.max() == len(feet) - 1:
        order = np.argsort(rank)
    elif len(feet) > SHORT:
        order, _ = suffix_array(rank, limit, queue_bytes)
    else:
        order = doubled(rank)
    feet = feet[order]
    feet_lcp = np.concatenate(([0], common_prefixes(text, feet[1:], feet[:-1], limit))).astype(np.int32)
    symbols = int(text.max()) + 1
    edges = np.searchsorted(text[feet], np.arange(symbols + 1))

    def seam(a: int, b: int) -> int:
        size = min(limit, n - a, n - b)
        differ = text[a : a + size] != text[b : b + size]
        return int(differ.argmax()) if differ.any() else size

    queue = DiskQueue(queue_bytes)
    induce = _Induction(text, ~up, limit, queue, symbols)
    falling: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for c in range(symbols):
        got = []
        for position, lcp in queue.pop(c):
            if not got:
                lcp = lcp.copy()
                lcp[0] = 0
            got.append((position, lcp))
            induce.scan(position, lcp)
        if got:
            falling[c] = tuple(np.concatenate(x) for x in zip(*got))
        own, own_lcp = feet[edges[c] : edges[c + 1]], feet_lcp[edges[c] : edges[c + 1]].copy()
        if len(own):
            own_lcp[0] = seam(falling[c][0][-1], own[0]) if c in falling else 0
            induce.scan(own, own_lcp)

    queue = DiskQueue(queue_bytes)
    induce = _Induction(text, up, limit, queue, symbols)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(symbols - 1, -1, -1):
        got = []
        if c == 0:
            queue.push(0, np.array([n - 1]), np.zeros(1, np.int32))
        for position, lcp in queue.pop(c):
            if not got:
                lcp = lcp.copy()
                lcp[0] = 0
            got.append((position, lcp))
            induce.scan(position, lcp)
        down, down_lcp = falling.get(c, (np.empty(0, np.int64), np.empty(0, np.int32)))
        if got:
            position, lcp = (np.concatenate(x) for x in zip(*got))
            join = seam(position[-1], down[-1]) if len(down) else 0
            parts.append((position[::-1], np.append(lcp[1:], 0)[::-1].astype(np.int32)))
            parts[-1][1][0] = join
        if len(down):
            back = np.append(down_lcp[1:], 0)[::-1].astype(np.int32)
            back[0] = join if got else 0
            induce.scan(down[::-1], back)
            parts.append((down, down_lcp))
    return tuple(np.concatenate(x) for x in zip(*parts[::-1]))
