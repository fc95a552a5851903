"""Suffix order and common prefixes of one shard by external induced sorting.

The classic induction in the form for disks: the order of the suffixes that start a rising run (``stars``) yields
that of all falling ones in one ascending sweep, and those yield the rising ones in one descending sweep. A sweep is
a monotone priority queue: the smallest suffixes leave it, and each puts the suffix one symbol longer back in. Here
tuples (symbol, position, common prefix) leave and enter in batches, as numpy arrays; the queue's cells, the orders
between sweeps and the text are files once they exceed the memory given. The order of the stars themselves comes from
the same two sweeps over unsorted stars, which sort the substrings between stars, and from the order of the shorter
text of their names, found in the same way until it fits into memory.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np

#: Items of a cell of the queue where symbols are many, and of a batch taken from it.
CELL, BATCH = 1 << 15, 1 << 12
#: Items that sweeps hand on at once.
BLOCK = 1 << 18


class Disk:
    """Memory for arrays of one task, and files of its own for what exceeds it; all goes when the task ends.

    The files are like Spark's own spill files: no other task reads them.
    """

    def __init__(self, memory: int = 256 << 20):
        self.memory, self.used, self.spools = memory, 0, []
        self._folder: tempfile.TemporaryDirectory | None = None
        self.spilled = 0

    def path(self) -> str:
        if self._folder is None:
            self._folder = tempfile.TemporaryDirectory(prefix="suffixes-")
        self.spilled += 1
        return os.path.join(self._folder.name, str(self.spilled))

    def array(self, size: int, dtype) -> np.ndarray:
        """Zeros for random access: in memory, or mapped from a file."""
        if size * np.dtype(dtype).itemsize <= self.memory // 4:
            return np.zeros(size, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(size,))

    def hold(self, size: int) -> None:
        self.used += size
        while self.used > self.memory and any(s.held for s in self.spools):
            max(self.spools, key=lambda s: s.held).spill()

    def close(self) -> None:
        self.spools.clear()
        if self._folder is not None:
            self._folder.cleanup()
            self._folder = None

    def __enter__(self) -> Disk:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Spool:
    """Tuples of arrays, appended and read in order; the oldest lie in a file."""

    def __init__(self, disk: Disk):
        self.disk, self.parts, self.held, self.file = disk, [], 0, None
        disk.spools.append(self)

    def append(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.parts.append(columns)
            size = sum(c.nbytes for c in columns)
            self.held += size
            self.disk.hold(size)

    def spill(self) -> None:
        self.file = self.file or self.disk.path()
        with open(self.file, "ab") as out:
            for k, part in enumerate(self.parts):
                if isinstance(part, tuple):
                    self.parts[k] = self._write(out, part)
        self.disk.used -= self.held
        self.held = 0

    @staticmethod
    def _write(out, part) -> list[tuple[int, np.dtype, int]]:
        places = []
        for column in part:
            places.append((out.tell(), column.dtype, len(column)))
            out.write(np.ascontiguousarray(column).data)
        return places

    def _read(self, part) -> tuple[np.ndarray, ...]:
        if isinstance(part, tuple):
            return part
        return tuple(np.fromfile(self.file, dtype, count, offset=at) for at, dtype, count in part)

    def __iter__(self) -> Iterator[tuple[np.ndarray, ...]]:
        return map(self._read, list(self.parts))

    def __reversed__(self) -> Iterator[tuple[np.ndarray, ...]]:
        return map(self._read, self.parts[::-1])

    def take(self) -> tuple[np.ndarray, ...] | None:
        """Everything at once, and forget it."""
        parts = list(self)
        self.drop()
        return tuple(np.concatenate(c) for c in zip(*parts)) if parts else None

    def drop(self) -> None:
        self.disk.used -= self.held
        self.parts, self.held = [], 0
        if self.file:
            os.unlink(self.file)
            self.file = None


class Queue:
    """Tuples ``(key, pos, common)`` by key, first in first out among equal keys.

    ``key`` is twice the symbol, plus one for the given suffixes that come after the induced ones of their symbol.
    A cell holds the symbols from one edge to the next.
    """

    def __init__(self, disk: Disk, edges: np.ndarray):
        self.edges, self.cells = edges, [Spool(disk) for _ in edges]
        self.single = edges[-1] == len(edges) - 1

    def push(self, key: np.ndarray, pos: np.ndarray, common: np.ndarray) -> None:
        """``key`` must be sorted, equal keys in order of insertion."""
        if not len(key):
            return
        cell = key >> 1 if self.single else np.searchsorted(self.edges, key >> 1, side="right") - 1
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        starts = [0, *cuts.tolist(), len(key)]
        for first, last in zip(starts, starts[1:]):
            self.cells[cell[first]].append(key[first:last], pos[first:last], common[first:last])


def stable_order(key: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers; 16 bits are sorted by radix."""
    if key.dtype.itemsize > 2 and len(key) and key.max() < 1 << 16:
        key = key.astype(np.uint16)
    return np.argsort(key, kind="stable")


def shared_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, at most ``cap``; ``text`` has 8 bytes more behind its end."""
    words = np.ndarray((len(text) - 7,), np.uint64, text, 0, (1,))
    out = np.full(len(a), cap, np.uint8)
    left, done = np.arange(len(a)), 0
    end = len(text) - 8
    while len(left) and done < cap:
        i, j = np.minimum(a[left] + done, end), np.minimum(b[left] + done, end)
        diff = words[i] ^ words[j]
        apart = np.flatnonzero(diff)
        low = diff[apart] & (~diff[apart] + np.uint64(1))
        out[left[apart]] = np.minimum(done + (np.bitwise_count(low - np.uint64(1)) >> 3), cap)
        left = left[diff == 0]
        done += 8
    return np.minimum(out, end - np.maximum(a, b)).astype(np.uint8)


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of ``values[first:last + 1]`` for each pair, by doubling spans."""
    size = last - first + 1
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    span, width = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        mine = np.flatnonzero(level == k)
        out[mine] = np.minimum(span[first[mine]], span[last[mine] - width + 1])
        if len(span) > width:
            span = np.minimum(span[:-width], span[width:])
        width *= 2
    return out


class Sweep:
    """One pass over a text: given suffixes in, given and induced ones out in order.

    Ascending, or descending by mirrored symbols. With ``cap`` every suffix carries the length of its common prefix
    with the one that left before it, at most ``cap``: for induced ones, one more than the smallest since the last
    that went to the same symbol.
    """

    def __init__(self, text: np.ndarray, size: int, symbols: int, edges: np.ndarray, disk: Disk, descending: bool, cap: int = 0):
        self.text, self.size, self.symbols, self.descending, self.cap = text, size, symbols, descending, cap
        self.queue = Queue(disk, edges)
        self.single = len(edges) == symbols
        self.since = np.full(symbols, cap, np.uint8) if cap else None
        self.last = (-1, -1, False)

    def keys(self, pos: np.ndarray) -> np.ndarray:
        symbol = self.text[pos].astype(np.int32)
        return self.symbols - 1 - symbol if self.descending else symbol

    def give(self, pos: np.ndarray, common: np.ndarray) -> None:
        key = self.keys(pos) * 2 + 1
        order = stable_order(key)
        self.queue.push(key[order], pos[order], common[order])

    def run(self, sink: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
        """Empty the queue into ``sink(positions, common prefixes, induced or not)``."""
        for c, cell in enumerate(self.queue.cells):
            items = cell.take()
            while items is not None and len(items[0]):
                order = stable_order(items[0]) if not self.single or (items[0][1:] < items[0][:-1]).any() else slice(None)
                items = tuple(x[order] for x in items)
                if self.single:
                    # The induced ones first, generation by generation, then the given ones, which add none here.
                    given = np.searchsorted(items[0], 2 * c + 1)
                    wave, items = tuple(x[:given] for x in items), tuple(x[given:] for x in items)
                    while len(wave[0]):
                        self.step(wave, sink)
                        wave = cell.take() or (wave[0][:0],)
                    if len(items[0]):
                        self.step(items, sink)
                    items = cell.take()
                    continue
                while len(items[0]):
                    cut, fresh = self.step(tuple(x[:BATCH] for x in items), sink, c)
                    items = tuple(x[cut:] for x in items)
                    if len(fresh[0]):
                        at = np.searchsorted(items[0], fresh[0], side="right")
                        items = tuple(np.insert(x, at, y) for x, y in zip(items, fresh))
                items = cell.take()

    def step(self, batch, sink, cell: int | None = None):
        """Let a batch leave, up to the first suffix that one induced by the batch must precede."""
        key, pos, common = batch
        before = np.maximum(pos - 1, 0)
        longer = self.keys(before) * 2
        # Equal symbols: an induced suffix goes on in the same run, a given one has its own kind before it.
        ok = (pos > 0) & ((longer > key) | (longer == key))
        cut = len(key)
        if cell is not None:
            lowest = np.minimum.accumulate(np.where(ok, longer, np.iinfo(np.int32).max))
            late = np.flatnonzero(key[1:] > lowest[:-1])
            if len(late):
                cut = int(late[0]) + 1
                key, pos, common, before, longer, ok = (x[:cut] for x in (key, pos, common, before, longer, ok))
        if self.cap:
            common = self.settle(key, pos, common)
        sink(pos, common, key & 1 == 0)
        chosen = np.flatnonzero(ok)
        target = longer[chosen] >> 1
        order = chosen[stable_order(target.astype(np.uint8) if self.symbols <= 256 else target)]
        new_key, new_pos = longer[order], before[order]
        new_common = self.inherit(common, order, new_key) if self.cap else np.zeros(len(order), np.uint8)
        if cell is None:
            self.queue.push(new_key, new_pos, new_common)
            return cut, None
        edges = self.queue.edges
        stay = int(np.searchsorted(new_key, 2 * edges[cell + 1])) if cell + 1 < len(edges) else len(new_key)
        self.queue.push(new_key[stay:], new_pos[stay:], new_common[stay:])
        return cut, (new_key[:stay], new_pos[:stay], new_common[:stay])

    def settle(self, key: np.ndarray, pos: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Common prefixes with the suffix that leaves before: none across symbols, compared where kinds meet."""
        common = common.copy()
        last_key, last_pos, _ = self.last
        before_key, before_pos = np.concatenate(([last_key], key[:-1])), np.concatenate(([last_pos], pos[:-1]))
        common[key >> 1 != before_key >> 1] = 0
        seam = np.flatnonzero((key >> 1 == before_key >> 1) & (key != before_key))
        if len(seam):
            common[seam] = shared_prefix(self.text, before_pos[seam], pos[seam], self.cap)
        self.last = (int(key[-1]), int(pos[-1]), True)
        return common

    def inherit(self, common: np.ndarray, order: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Common prefixes of induced suffixes with the one induced before them to the same symbol."""
        out = np.empty(len(order), np.uint8)
        symbol = key >> 1
        if len(order):
            head = np.concatenate(([True], symbol[1:] != symbol[:-1]))
            rest = np.flatnonzero(~head)
            out[rest] = range_minima(common, order[rest - 1] + 1, order[rest])
            first = np.flatnonzero(head)
            out[first] = np.minimum(self.since[symbol[first]], np.minimum.accumulate(common)[order[first]])
        self.since = np.minimum(self.since, common.min(initial=self.cap))
        if len(order):
            tail = np.append(first[1:], len(order)) - 1
            after = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(self.cap))
            self.since[symbol[tail]] = after[order[tail] + 1]
        return np.minimum(out, self.cap - 1) + np.uint8(1)


def starts_of_runs(text: np.ndarray, size: int, disk: Disk) -> np.ndarray:
    """Positions whose suffix is smaller than the next one while the suffix before is larger than itself, ascending."""
    found, rising, behind = [], False, None
    for last in range(size, 0, -BLOCK):
        first = max(0, last - BLOCK)
        here = text[first:last].astype(np.int64)
        after = np.append(here[1:], -1 if behind is None else behind[0])
        sign = np.sign(after - here)
        # Equal neighbours are of the kind of the right one; the text ends in a symbol smaller than all.
        known = np.append(np.where(sign != 0, np.arange(len(here)), len(here)), len(here))
        nearest = np.minimum.accumulate(known[::-1])[::-1][:-1]
        up = np.append(sign, 1 if rising else -1)[nearest] > 0
        if behind is not None and behind[1] and not up[-1]:
            found.append(np.array([last], np.int64))
        star = np.flatnonzero(up[1:] & ~up[:-1]) + 1
        found.append((first + star[::-1]).astype(np.int64))
        behind, rising = (int(here[0]), bool(up[0])), bool(up[0])
    stars = disk.array(sum(map(len, found)), np.int64)
    at = len(stars)
    for part in found:
        stars[at - len(part):at] = part[::-1]
        at -= len(part)
    return stars


def edges_of(text: np.ndarray, size: int, symbols: int, descending: bool) -> np.ndarray:
    """Where the cells of a queue begin: at every symbol if they are few, else after about so many suffixes."""
    if symbols <= 1 << 10:
        return np.arange(symbols)
    counts = np.zeros(symbols, np.int64)
    for first in range(0, size, BLOCK):
        counts += np.bincount(text[first:min(size, first + BLOCK)], minlength=symbols)
    if descending:
        counts = counts[::-1]
    share = max(CELL, size >> 10)
    cell = np.cumsum(counts) // share
    return np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1))


def both_sweeps(text, size, symbols, given: Iterable[tuple[np.ndarray, np.ndarray]], disk: Disk, sink, cap: int = 0) -> None:
    """From the stars to all suffixes, in descending order with the common prefix to the one before, into ``sink``."""
    up = Sweep(text, size, symbols, edges_of(text, size, symbols, False), disk, False, cap)
    # The empty suffix comes first of all; it induces the last position.
    end = np.array([size - 1])
    up.queue.push(up.keys(end) * 2, end, np.zeros(1, np.uint8))
    for pos, common in given:
        up.give(pos, common)
    falling = Spool(disk)
    up.run(lambda pos, common, induced: falling.append(pos[induced], common[induced]))
    down = Sweep(text, size, symbols, edges_of(text, size, symbols, True), disk, True, cap)
    behind = np.zeros(1, np.uint8)
    for pos, common in reversed(falling):
        shifted = np.concatenate((behind, common[:0:-1]))
        behind = common[:1]
        down.give(pos[::-1], shifted)
    falling.drop()
    down.run(sink)


def star_order(text: np.ndarray, size: int, symbols: int, stars: np.ndarray, disk: Disk, depth: int | None) -> Iterator[np.ndarray]:
    """The stars by their suffixes, ascending, in blocks."""
    if not len(stars):
        return
    if text.dtype == np.uint8 and len(stars) * 64 <= disk.memory:
        names, order, count = direct_names(text, size, stars)
        yield stars[order if count == len(stars) else doubled_order(names, depth, order)]
        return
    none = lambda n: np.zeros(n, np.uint8)
    place = disk.array(size + 1, np.int32 if len(stars) < 1 << 31 else np.int64)
    for first in range(0, len(stars), BLOCK):
        block = stars[first:first + BLOCK]
        place[block] = np.arange(first + 1, first + 1 + len(block))
    order = Spool(disk)
    blocks = (stars[first:first + BLOCK] for first in range(0, len(stars), BLOCK))

    def keep(pos, common, induced):
        order.append(pos[(place[pos] > 0) & induced])

    both_sweeps(text, size, symbols, ((np.asarray(b), none(len(b))) for b in blocks), disk, keep)
    names, count, before = disk.array(len(stars), np.int64), 0, None
    for (pos,) in order:
        rank = place[pos] - 1
        pair = (pos, rank) if before is None else (np.concatenate((before[0], pos)), np.concatenate((before[1], rank)))
        fresh = np.ones(len(pos), bool)
        fresh[len(pos) - len(pair[0]) + 1:] = ~same_substrings(text, size, stars, *pair)
        label = count + np.cumsum(fresh)
        names[rank] = label
        count, before = int(label[-1]), (pos[-1:], rank[-1:])
    if count == len(stars):
        for (pos,) in reversed(order):
            yield pos[::-1]
        return
    order.drop()
    del place
    for first in range(0, len(names), BLOCK):  # from the descending numbers to ascending ones
        names[first:first + BLOCK] = count - names[first:first + BLOCK]
    for part in name_order(names, count, disk, depth):
        yield stars[part]


def direct_names(text: np.ndarray, size: int, stars: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Ranks of the substrings from each star to the next one, the stars by rank, and the number of ranks, in memory.

    Eight bytes are compared at a time. Behind its end a substring counts as larger than one that goes on, as the
    symbol there begins a rising run; the last one ends with the text and counts as smaller. ``text`` has 8 bytes more.
    """
    words = np.ndarray((len(text) - 7,), np.uint64, text, 0, (1,))
    n, end = len(stars), len(text) - 8
    length = np.append(stars[1:] + 1, size) - stars

    def word(which: np.ndarray, done: int) -> np.ndarray:
        kept = np.clip(length[which] - done, 0, 8).astype(np.uint64)
        found = words[np.minimum(stars[which] + done, end)].byteswap()
        behind = np.where(kept > 0, (np.uint64(1) << (np.uint64(64) - np.uint64(8) * np.maximum(kept, np.uint64(1)))) - np.uint64(1), ~np.uint64(0))
        return np.where(which == n - 1, found & ~behind, found | behind)

    first_word = word(np.arange(n), 0)
    order = np.argsort(first_word)
    found = first_word[order]
    head = np.concatenate(([True], found[1:] != found[:-1]))
    done = 8
    while True:
        group = np.cumsum(head) - 1
        longest = np.maximum.reduceat(length[order], np.flatnonzero(head))
        tied = np.bincount(group) > 1
        places = np.flatnonzero((tied & (longest > done))[group])
        if not len(places):
            break
        which = order[places]
        more, where = word(which, done), group[places]
        within = np.lexsort((more, where))
        order[places] = which[within]
        more = more[within]
        head[places] = np.concatenate(([True], (where[1:] != where[:-1]) | (more[1:] != more[:-1])))
        done += 8
    # The last one has no equal: it leads its group.
    at = int(np.flatnonzero(order == n - 1)[0])
    lead = int(np.flatnonzero(head[:at + 1])[-1])
    order[lead], order[at] = order[at], order[lead]
    if lead + 1 < n:
        head[lead + 1] = True
    names = np.empty(n, np.int64)
    names[order] = np.cumsum(head) - 1
    return names, order, int(head.sum())


def same_substrings(text, size, stars, pos, rank) -> np.ndarray:
    """Whether the substrings of neighbours in ``pos``, from their star to the next one, are the same."""
    last = rank + 1 >= len(stars)
    length = np.where(last, size, stars[np.minimum(rank + 1, len(stars) - 1)]) - pos
    same = (length[1:] == length[:-1]) & ~last[1:] & ~last[:-1]
    left, done = np.flatnonzero(same), 0
    while len(left):
        equal = text[pos[left] + done] == text[pos[left + 1] + done]
        same[left[~equal]] = False
        left = left[equal]
        done += 1
        left = left[length[left] >= done]
    return same


def name_order(names: np.ndarray, symbols: int, disk: Disk, depth: int | None) -> Iterator[np.ndarray]:
    """Positions of a text of names, by suffix: by doubling if that fits into memory, else by induction again."""
    if len(names) * 48 <= disk.memory:
        yield doubled_order(np.asarray(names), depth)
        return
    stars = starts_of_runs(names, len(names), disk)
    cap = None if depth is None else max(depth // 2, 1) + 1
    given = ((pos, np.zeros(len(pos), np.uint8)) for pos in star_order(names, len(names), symbols, stars, disk, cap))
    order = Spool(disk)
    both_sweeps(names, len(names), symbols, given, disk, lambda pos, common, induced: order.append(pos))
    for (pos,) in reversed(order):
        yield pos[::-1]


def doubled_order(names: np.ndarray, depth: int | None = None, order: np.ndarray | None = None) -> np.ndarray:
    """Positions by suffix, in memory; names that agree in ``depth`` symbols may come in any order. ``order``: them by name."""
    n = len(names)
    order = np.argsort(names) if order is None else order
    rank = names.astype(np.int64)
    sorted_rank = rank[order]
    head = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
    # The rank of a group is the place of its first member.
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = first
    k = 1
    while depth is None or k < depth:
        alone = head & np.append(head[1:], True)
        open_places = np.flatnonzero(~alone)
        if not len(open_places):
            break
        members = order[open_places]
        after = members + k
        group = first[open_places]
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        within = np.argsort(group * (n + 1) + second)  # groups lie in order already and stay in their places
        members, second = members[within], second[within]
        order[open_places] = members
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        head[open_places] = fresh
        first[open_places] = np.maximum.accumulate(np.where(fresh, open_places, 0))
        rank[members] = first[open_places]
        k *= 2
    return order


def sorted_suffixes(text: np.ndarray, size: int, symbols: int, disk: Disk, sink, cap: int) -> None:
    """All suffixes of ``text[:size]`` in descending order into ``sink(positions, common prefixes, induced)``.

    ``text`` are bytes with 8 more zeros behind the end. Order and common prefixes are exact up to ``cap`` symbols,
    200 or so; suffixes that agree that far come next to each other in any order.
    """
    stars = starts_of_runs(text, size, disk)

    def given():
        before = None
        for pos in star_order(text, size, symbols, stars, disk, cap):
            chain = pos if before is None else np.concatenate((before, pos))
            common = shared_prefix(text, chain[:-1], chain[1:], cap)
            yield pos, common if before is not None else np.concatenate((np.zeros(1, np.uint8), common))
            before = pos[-1:]

    both_sweeps(text, size, symbols, given(), disk, sink, cap)
