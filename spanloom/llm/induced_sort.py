"""External induced suffix sorting that carries common prefixes (numpy).

A suffix is of type S if it is less than the one after it, else L; a star is an S suffix after an L one. Stars are sorted
first: one induction from stars in the order of their first symbols sorts the strings between stars, these get names, and
the string of names is sorted by recursion. A second induction from the sorted stars sorts everything: in ascending order
each suffix that comes out puts the L suffix before it into the queue of that suffix's first symbol, then in descending
order the S suffixes. As suffixes come out in order, a queue is first in, first out for each symbol: a monotone priority
queue over (symbol, rank). All that comes out of a symbol's queue at a time is handled as one block of arrays.

Tuples in the queues are (position, common prefix with the tuple before). The common prefix of two suffixes that follow
each other in a queue is one more than that of the suffixes they were induced from, the least common prefix on the way
from one to the other. Queues keep `held` bytes in memory and write the rest to files, read back a symbol at a time; the
string itself (one byte a suffix, four for names) stays in memory.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np

Block = tuple[np.ndarray, "np.ndarray | None"]
Emit = Callable[[np.ndarray, "np.ndarray | None"], None]
#: Strings of names of at most this length are sorted by doubling in memory instead of another induction.
BASE = 1 << 22
HELD = 256 << 20
#: Suffixes that are induced from at once.
STEP = 1 << 18


class Queues:
    """First-in-first-out queues of blocks, one a symbol, on files of a folder beyond `held` bytes."""

    def __init__(self, folder: str | None, held: int = HELD):
        self.folder, self.held, self.size = folder, held, 0
        self.blocks: dict[int, list] = defaultdict(list)
        self.files: list[str] = []

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder)

    def put(self, symbol: int, pos: np.ndarray, lcp: np.ndarray | None) -> None:
        self.blocks[symbol].append((pos, lcp))
        self.size += pos.nbytes + (0 if lcp is None else lcp.nbytes)
        if self.folder and self.size > self.held:
            self._spill()

    def _spill(self) -> None:
        store, path = self._store()
        store.create_dir(path, recursive=True)
        name, at = f"{path}/queue-{uuid.uuid4().hex}", 0
        with store.open_output_stream(name) as out:
            for blocks in self.blocks.values():
                for k, (pos, lcp) in enumerate(blocks):
                    if isinstance(pos, np.ndarray):
                        raw = (pos.tobytes(), b"" if lcp is None else lcp.tobytes())
                        blocks[k] = ((name, at, pos.dtype, len(raw[0])), lcp if lcp is None else (lcp.dtype, len(raw[1])))
                        out.write(raw[0] + raw[1])
                        at += len(raw[0]) + len(raw[1])
        self.files.append(name)
        self.size = 0

    def take(self, symbol: int) -> Block | None:
        """All that the queue of a symbol holds, in order; None if it is empty."""
        out, store, file, opened = [], None, None, ""
        for pos, lcp in self.blocks.pop(symbol, ()):
            if isinstance(pos, tuple):
                store = store or self._store()[0]
                if pos[0] != opened:
                    file, opened = store.open_input_file(pos[0]), pos[0]
                file.seek(pos[1])
                pos, lcp = np.frombuffer(file.read(pos[3]), pos[2]), lcp if lcp is None else np.frombuffer(file.read(lcp[1]), lcp[0])
            else:
                self.size -= pos.nbytes + (0 if lcp is None else lcp.nbytes)
            out.append((pos, lcp))
        if not out:
            return None
        return np.concatenate([p for p, _ in out]), None if out[0][1] is None else np.concatenate([x for _, x in out])

    def close(self) -> None:
        for name in self.files:
            self._store()[0].delete_file(name)


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes a[i] and b[i], at most most[i] (none reaches past the end)."""
    n, left = np.zeros(len(a), np.int64), np.arange(len(a))
    wide = text.dtype == np.uint8
    if wide:
        words = np.ndarray((len(text),), np.uint64, np.concatenate((text, np.zeros(8, np.uint8))), 0, (1,))  # from every byte on
    while len(left):
        x, y = a[left] + n[left], b[left] + n[left]
        if wide:
            differ = words[x] ^ words[y]
            # The lowest bit that differs tells how many whole bytes before it are equal.
            step = np.where(differ == 0, 8, np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3).astype(np.int64)
            full = step == 8
        else:
            full = text[x] == text[y]
            step = full.astype(np.int64)
        n[left] += step
        left = left[full & (n[left] < most[left])]
        left = left[np.maximum(a[left], b[left]) + n[left] < len(text)]
    return np.minimum(n, most)


def is_s(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last symbol is the least and unlike the one before it."""
    turn = np.flatnonzero(text[1:] != text[:-1])
    return np.append(np.repeat(text[turn + 1] > text[turn], np.diff(turn, prepend=-1)), True)


class Least:
    """Least values of ranges of an array, from minima over ranges of each power of two."""

    def __init__(self, x: np.ndarray):
        levels = max(1, len(x).bit_length())
        self.of = np.empty((levels, len(x)), x.dtype)
        self.of[0] = x
        for k in range(1, levels):
            half = 1 << (k - 1)
            self.of[k] = self.of[k - 1]
            np.minimum(self.of[k - 1][:-half], self.of[k - 1][half:], out=self.of[k][:-half])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        return np.minimum(self.of[k, first], self.of[k, last - (1 << k.astype(np.int64)) + 1])


class Induction:
    def __init__(self, text: np.ndarray, cap: int | None, queues: Callable[[], Queues]):
        self.text, self.cap, self.queues = text, cap, queues
        self.since = np.zeros(int(text.max()) + 1 if cap else 0, np.uint16)

    def _spread(self, pos: np.ndarray, lcp: np.ndarray | None, wanted: Callable[[np.ndarray], np.ndarray], to: Queues) -> None:
        """Queues the suffixes before pos whose first symbols are wanted. since: for each symbol the least common prefix
        from the last suffix that was queued under it to the last one seen."""
        for i in range(0, len(pos), STEP):
            part, x = pos[i : i + STEP], None if lcp is None else lcp[i : i + STEP]
            before = self.text[part - 1]
            at = np.flatnonzero((part > 0) & wanted(before))
            if not len(at):
                if x is not None:
                    np.minimum(self.since, x.min(), out=self.since)
                continue
            symbol = before[at]
            order = np.argsort(symbol, kind="stable")
            at, symbol = at[order], symbol[order]
            first = np.concatenate(([0], np.flatnonzero(symbol[1:] != symbol[:-1]) + 1))
            new, kinds = part[at] - 1, symbol[first].tolist()
            value = None
            if x is not None:
                least = Least(x)
                begin = np.empty_like(at)
                begin[1:] = at[:-1] + 1
                begin[first] = 0
                value = least(begin, at)
                value[first] = np.minimum(value[first], self.since[kinds])
                value = np.minimum(value + np.uint16(1), np.uint16(self.cap))
                np.minimum(self.since, least.of[0].min(), out=self.since)
                last = at[np.append(first[1:], len(at)) - 1] + 1
                self.since[kinds] = self.cap
                open_ = last < len(x)
                self.since[np.asarray(kinds)[open_]] = least(last[open_], np.full(open_.sum(), len(x) - 1))
            for s, a, b in zip(kinds, first.tolist(), [*first[1:].tolist(), len(at)], strict=True):
                to.put(s, new[a:b], None if value is None else value[a:b])

    def _meet(self, lcp: np.ndarray | None, last: int | None, pos: int) -> None:
        """The first common prefix of a block: none at a symbol's first block, else that with the suffix before."""
        if lcp is not None:
            lcp[0] = 0 if last is None else common(self.text, np.array([last]), np.array([pos]), np.array([self.cap]))[0]

    def run(self, stars: np.ndarray, lcp: np.ndarray | None, emit: Emit) -> None:
        """From sorted stars to all suffixes but the last, in descending order, block by block through emit."""
        text, rising, lower, falling = self.text, self.queues(), self.queues(), self.queues()
        symbols = np.unique(text)
        own = text[stars]
        bounds = np.searchsorted(own, np.append(symbols, symbols[-1]), side="left").tolist()
        bounds[-1] = len(stars)
        for c, a, b in zip(symbols.tolist(), bounds[:-1], bounds[1:], strict=True):
            last, self.since[:] = None, 0
            while (block := rising.take(c)) is not None:
                pos, x = block[0], None if lcp is None else block[1].copy()
                if last is None:
                    self._meet(x, None, 0)
                last = int(pos[-1])
                lower.put(c, pos, x)
                self._spread(pos, x, lambda p, c=c: p >= c, rising)
            if b > a:
                x = None if lcp is None else lcp[a:b].copy()
                self._meet(x, last, int(stars[a]))
                self._spread(stars[a:b], x, lambda p, c=c: p > c, rising)
        for c in reversed(symbols.tolist()):
            last, self.since[:] = None, 0
            while (block := falling.take(c)) is not None:
                pos, x = block[0], None if lcp is None else block[1].copy()
                if last is None:
                    self._meet(x, None, 0)
                last = int(pos[-1])
                emit(pos, x)
                self._spread(pos, x, lambda p, c=c: p <= c, falling)
            if (block := lower.take(c)) is not None:
                pos, x = block[0][::-1], None
                if lcp is not None:
                    x = np.append(np.uint16(0), block[1][:0:-1])
                    self._meet(x, last, int(pos[0]))
                emit(pos, x)
                self._spread(pos, x, lambda p, c=c: p < c, falling)
        for q in (rising, lower, falling):
            q.close()


def doubled(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names by prefix doubling; only suffixes that are not yet told apart are sorted again."""
    n, k = len(names), 1
    order = np.argsort(names, kind="stable")
    first = np.concatenate(([True], names[order][1:] != names[order][:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[n] = -1
    while not first.all():
        open_ = ~first | ~np.append(first[1:], True)
        at = np.flatnonzero(open_)
        who = order[at]
        group, beyond = rank[who], rank[np.minimum(who + k, n)]
        again = np.lexsort((beyond, group))
        who, group, beyond = who[again], group[again], beyond[again]
        order[at] = who
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])))
        first[at] = new
        rank[who] = np.maximum.accumulate(np.where(new, at, 0))
        k *= 2
    return order


def sorted_stars(text: np.ndarray, queues: Callable[[], Queues], base: int = BASE) -> np.ndarray:
    """The stars in the order of their suffixes. text ends with its least symbol, which is not doubled there."""
    s, end = is_s(text), len(text) - 1
    star = np.append(False, s[1:] & ~s[:-1])
    stars = np.flatnonzero(star)
    stars = stars.astype(np.int32) if len(text) < 1 << 31 else stars
    start = np.append(stars[-1:], stars[:-1][np.argsort(text[stars[:-1]], kind="stable")])
    found: list[np.ndarray] = []
    Induction(text, None, queues).run(start, None, lambda pos, _: found.append(pos[star[pos]]))
    found.append(stars[-1:])
    order = np.concatenate(found)[::-1]
    index = np.searchsorted(stars, order)
    length = np.diff(stars, append=end) + 1
    a, b = index[:-1], index[1:]
    same = length[a] == length[b]
    same[same] = common(text, stars[a[same]].astype(np.int64), stars[b[same]].astype(np.int64), length[a[same]]) == length[a[same]]
    names = np.empty(len(stars), np.int32)
    names[index] = np.append(0, np.cumsum(~same))
    if same.any():
        order = stars[doubled(names) if len(names) <= base else suffixes(names, queues, base)]
    return order


def suffixes(text: np.ndarray, queues: Callable[[], Queues], base: int = BASE) -> np.ndarray:
    """The suffix array of a string that ends with its least symbol, which occurs there alone or not twice in a row."""
    out: list[np.ndarray] = []
    Induction(text, None, queues).run(sorted_stars(text, queues, base), None, lambda pos, _: out.append(pos))
    return np.append(len(text) - 1, np.concatenate(out)[::-1] if out else [])


def ordered(text: np.ndarray, cap: int, emit: Emit, folder: str | None = None, held: int = HELD, base: int = BASE) -> None:
    """Suffixes of text in descending order through emit, with common prefixes with the one before, at most cap."""
    queues = lambda: Queues(folder, held)
    stars = sorted_stars(text, queues, base)
    wide = stars.astype(np.int64)
    lcp = np.append(0, common(text, wide[:-1], wide[1:], np.full(len(stars) - 1, cap))).astype(np.uint16)
    Induction(text, cap, queues).run(stars, lcp, emit)


def repeats(parts: list[bytes], size: int, folder: str | None = None, held: int = HELD, base: int = BASE) -> np.ndarray:
    """Over the parts joined by one byte each: whether the size bytes from there lie in one part and start elsewhere too.

    Parts are UTF-8, where the byte 255 does not occur, so one more than each byte leaves 0 as the least symbol."""
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)
    again = np.zeros(len(text), bool)
    behind = None

    def mark(pos: np.ndarray, lcp: np.ndarray) -> None:
        nonlocal behind
        hit = lcp >= size
        again[pos[hit]] = True
        again[pos[:-1][hit[1:]]] = True
        if hit[0] and behind is not None:
            again[behind] = True
        behind = int(pos[-1])

    ordered(text, size, mark, folder, held, base)
    stop = np.flatnonzero(text == 0)
    room = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(len(text))
    return again & (room >= size)


def runs(marked: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of maximal runs of marked places."""
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    yield from zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True)
