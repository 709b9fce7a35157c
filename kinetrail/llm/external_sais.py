"""Suffix and LCP arrays by induced sorting with queues that spill to disk.

The sequence is reduced to its S* substrings, their names are sorted recursively in the same way, and the order of all suffixes
is induced from the order of the S* suffixes in two passes. A pass takes tuples (position, common prefix with the tuple before)
from a priority queue by character and pushes the tuples of the preceding positions. Tuples of one character arrive in
their final order, so the queue is a list of runs by character; runs beyond the memory limit go to temporary files,
as do the orders that the passes hand on. The common prefix of two neighbours that are pushed is one more than the least
common prefix between the tuples that pushed them. Common prefixes are counted up to ``cap``.

All steps work on whole runs in numpy. With a large alphabet (the names of the recursion) a queue entry is a range of characters;
what a range pushes into itself is sorted together with it.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: bytes of one run that are held in memory before it goes to a file
MEMORY = 64 << 20


class Run:
    """An append-only array that moves to a temporary file when it grows beyond ``limit`` bytes."""

    def __init__(self, kind, limit: int):
        self.kind, self.limit, self.parts, self.size, self.file, self.count = np.dtype(kind), limit, [], 0, None, 0

    def push(self, values: np.ndarray) -> None:
        if not len(values):
            return
        values = np.ascontiguousarray(values, self.kind)
        self.count += len(values)
        self.parts.append(values)
        self.size += values.nbytes
        if self.size > self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            for part in self.parts:
                part.tofile(self.file)
            self.parts, self.size = [], 0

    def take(self) -> np.ndarray:
        """Everything pushed so far, in order; the run is empty afterwards."""
        head = []
        if self.file is not None:
            self.file.flush()
            self.file.seek(0)
            head = [np.fromfile(self.file, self.kind)]
            self.file.close()
            self.file = None
        out = np.concatenate([*head, *self.parts]) if head or self.parts else np.empty(0, self.kind)
        self.parts, self.size, self.count = [], 0, 0
        return out


class Queue:
    """A priority queue of (position, common prefix) by bucket; a bucket's tuples come out in the order they went in."""

    def __init__(self, buckets: int, memory: int):
        each = max(1 << 12, memory // max(1, buckets))
        self.positions = [Run(np.int64, each) for _ in range(buckets)]
        self.prefixes = [Run(np.uint8, each) for _ in range(buckets)]

    def push(self, bucket: int, positions: np.ndarray, prefixes: np.ndarray | None = None) -> None:
        self.positions[bucket].push(positions)
        if prefixes is not None:
            self.prefixes[bucket].push(prefixes)

    def pop(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        return self.positions[bucket].take(), self.prefixes[bucket].take()


def _least_between(prefixes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of prefixes[low + 1 .. high] for each pair, by a table of powers of two."""
    table = [prefixes]
    while (1 << len(table)) <= len(prefixes):
        half, last = 1 << (len(table) - 1), table[-1]
        nxt = last.copy()
        np.minimum(last[:-half], last[half:], out=nxt[:-half])
        table.append(nxt)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    out = np.empty(len(low), np.uint8)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][low[at] + 1], table[k][high[at] - (1 << k) + 1])
    return out


def _run_length(text: np.ndarray, at: int, cap: int) -> int:
    part = text[at : at + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _induce_small(text: np.ndarray, sigma: int, seeds: np.ndarray, seed_prefixes: np.ndarray, cap: int, memory: int):
    """Induces from sorted seeds, character by character. Yields (character, positions, prefixes, prefix of the first seed)."""
    queue = Queue(sigma, memory)
    filled = np.zeros(sigma, bool)
    seed_cut = np.searchsorted(text[seeds], np.arange(sigma + 1))
    for ch in range(sigma):
        now, lcp = queue.pop(ch)
        mine, prefixes, turn = [now], [lcp], 0
        while len(now):
            into = np.flatnonzero((now > 0) & (text[np.maximum(now - 1, 0)] == ch))
            if not len(into):
                break
            new = np.empty(len(into), np.uint8)
            new[0] = min(turn + 1, cap)  # the last of this round has turn + 1 equal characters, the first of the next has more
            if len(into) > 1:
                new[1:] = np.minimum(np.minimum.reduceat(lcp[: into[-1] + 1], into[:-1] + 1).astype(np.int64) + 1, cap)
            now, lcp = now[into] - 1, new
            mine.append(now)
            prefixes.append(lcp)
            turn += 1
        induced, common = np.concatenate(mine), np.concatenate(prefixes)
        a, b = seed_cut[ch], seed_cut[ch + 1]
        joint = 0
        extra = seed_prefixes[a:b].copy()
        if b > a:
            joint = min(turn + 1, _run_length(text, int(seeds[a]), cap + 1), cap) if len(induced) else 0
            extra[0] = joint
        yield ch, induced, common, joint
        every, prefix = np.concatenate([induced, seeds[a:b]]), np.concatenate([common, extra])
        target = text[np.maximum(every - 1, 0)]
        push = np.flatnonzero((every > 0) & (target > ch))
        if not len(push):
            continue
        target = target[push]
        order = np.argsort(target, kind="stable")
        push, target = push[order], target[order]
        new = np.ones(len(push), bool)
        new[1:] = target[1:] != target[:-1]
        out = np.zeros(len(push), np.uint8)
        inner = np.flatnonzero(~new)
        if len(inner):
            out[inner] = np.minimum(_least_between(prefix, push[inner - 1], push[inner]).astype(np.int64) + 1, cap)
        starts = np.flatnonzero(new)
        out[starts] = np.where(filled[target[starts]], 1, 0)
        filled[target[starts]] = True
        for x, y in zip(starts, np.append(starts[1:], len(push)), strict=True):
            queue.push(int(target[x]), every[push[x:y]] - 1, out[x:y])


def _induce_wide(text: np.ndarray, sigma: int, seeds: np.ndarray, memory: int) -> np.ndarray:
    """Induces from sorted seeds over a large alphabet; returns the induced positions in order."""
    ranges = int(min(sigma, max(1, len(text) // 8192)))
    width = -(-sigma // ranges)
    queue = Queue(ranges + 1, memory)
    out = Run(np.int64, memory)
    seed_chars = text[seeds]

    def hand_on(ordered: np.ndarray, stop: int, limit: int) -> np.ndarray:
        """Pushes what lies at or beyond ``limit``; returns what lies in [stop, limit), both in the order of their inducers."""
        before = ordered[ordered > 0] - 1
        ch = text[before]
        far, near = before[ch >= limit], before[(ch >= stop) & (ch < limit)]
        bucket = text[far] // width
        order = np.argsort(bucket, kind="stable")
        far, bucket = far[order], bucket[order]
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(far) else []
        for x, y in zip(starts, np.append(starts[1:], len(far)) if len(far) else [], strict=True):
            queue.push(int(bucket[x]), far[x:y])
        return near

    def work(low: int, high: int, drained: np.ndarray, limit: int) -> np.ndarray:
        """Handles the characters [low, high); returns what it pushes into [high, limit)."""
        mine = seeds[np.searchsorted(seed_chars, low) : np.searchsorted(seed_chars, high)]
        if high - low == 1:
            rounds, now = [drained], drained
            while len(now):
                now = now[now > 0] - 1
                now = now[text[now] == low]
                rounds.append(now)
            induced = np.concatenate(rounds)
            out.push(induced)
            return hand_on(np.concatenate([induced, mine]), high, limit)
        base = np.concatenate([drained, mine])
        strict = np.repeat([False, True], [len(drained), len(mine)])
        kinds, parents, levels = [np.where(strict, 2, 0)], [np.arange(len(base))], [base]
        now, first = base, 0
        while len(now):
            before = np.maximum(now - 1, 0)
            ch, own = text[before], text[now]
            at = np.flatnonzero((now > 0) & (ch < high) & np.where(strict, ch > own, ch >= own))
            if not len(at):
                break
            if len(levels) > 48:
                middle = (low + high) // 2
                left = work(low, middle, drained[text[drained] < middle], limit)
                inner = text[left] < high
                return np.concatenate([left[~inner], work(middle, high, np.concatenate([drained[text[drained] >= middle], left[inner]]), limit)])
            parents.append(first + at)
            first += len(now)
            now = before[at]
            strict = np.zeros(len(at), bool)
            kinds.append(np.ones(len(at), np.int64))
            levels.append(now)
        every, kind, parent = np.concatenate(levels), np.concatenate(kinds), np.concatenate(parents)
        # a suffix ranks by its character, how it came (drained, induced here, seed) and the rank of what it was induced from; the latter
        # ranks are right to a depth of one more suffix in each turn
        count = len(every)
        top = ((text[every] - low) * 3 + kind) * count
        top[: len(base)] += np.arange(len(base))  # what came in keeps the order it came in
        parent = parent[len(base) :]
        rank, order = np.arange(count), np.arange(count)
        while True:
            key = top.copy()
            key[len(base) :] += rank[parent]
            order = np.argsort(key)
            new = np.empty(count, np.int64)
            new[order] = np.arange(count)
            if np.array_equal(new, rank):
                break
            rank = new
        ordered = every[order]
        out.push(ordered[kind[order] != 2])
        return hand_on(ordered, high, limit)

    for k in range(ranges):
        low, high = k * width, min(sigma, (k + 1) * width)
        if low < high:
            work(low, high, queue.pop(k)[0], high)
    return out.take()


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one."""
    n = len(text)
    rises = np.empty(n, np.int8)
    rises[-1] = 1
    rises[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    decides = np.where(rises != 0, np.arange(n), n)
    return rises[np.minimum.accumulate(decides[::-1])[::-1]] > 0


def _names(text: np.ndarray, sigma: int, starts: np.ndarray) -> np.ndarray:
    """Ranks of the S* substrings; of two where one begins the other the longer ranks first."""
    bits = int(sigma).bit_length()
    chars = 63 // bits
    length = np.append(np.diff(starts) + 1, 1)
    rank = np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    word = 0
    while len(open_):
        key = np.zeros(len(open_), np.int64)
        for k in range(word * chars, (word + 1) * chars):
            here = np.where(k < length[open_], text[np.minimum(starts[open_] + k, len(text) - 1)], sigma)
            key = (key << bits) | here
        order = np.lexsort((key, rank[open_]))
        members, key = open_[order], key[order]
        old = rank[members]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        part = group | np.concatenate([[True], key[1:] != key[:-1]])
        index = np.arange(len(members))
        rank[members] = old + np.maximum.accumulate(np.where(part, index, 0)) - np.maximum.accumulate(np.where(group, index, 0))
        word += 1
        cuts = np.flatnonzero(part)
        size = np.diff(np.append(cuts, len(members)))
        longest = np.maximum.reduceat(length[members], cuts)
        open_ = np.sort(members[np.repeat((size > 1) & (longest > word * chars), size)])
    return np.unique(rank, return_inverse=True)[1]


def _star_order(text: np.ndarray, sigma: int, starts: np.ndarray, memory: int) -> np.ndarray:
    """The S* positions in the order of their suffixes."""
    names = _names(text, sigma, starts).astype(np.int64)
    distinct = int(names.max()) + 1
    if distinct == len(starts):
        return starts[np.argsort(names)]
    return starts[order_wide(names, distinct, memory)]


def order_wide(text: np.ndarray, sigma: int, memory: int = MEMORY) -> np.ndarray:
    """Suffix array of a sequence that ends with its only 0."""
    rising = _types(text)
    starts = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if len(text) == 1:
        return np.zeros(1, np.int64)
    seeds = _star_order(text, sigma, starts, memory)
    falling = _induce_wide(text, sigma, seeds, memory)
    mirrored = sigma - 1 - text
    small = _induce_wide(mirrored, sigma, falling[::-1], memory)[::-1]
    both = np.concatenate([[len(text) - 1], falling, small])
    kind = np.concatenate([[0], np.zeros(len(falling), np.int64), np.ones(len(small), np.int64)])
    return both[np.lexsort((kind, text[both]))]  # stable: within a character the falling suffixes come first


def _common(text: np.ndarray, left: np.ndarray, right: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, eight bytes or as many wider characters as fit in eight bytes at a step."""
    size = text.dtype.itemsize
    chars = 8 // size
    padded = np.concatenate([text, np.zeros(chars, text.dtype)])  # the ending 0 occurs once, so no pair gets beyond it
    word = np.lib.stride_tricks.as_strided(padded, (len(text), chars), (size, size)).copy().view(np.uint64).ravel()
    out = np.zeros(len(left), np.int64)
    going = np.arange(len(left))
    last = len(text) - 1
    while len(going):
        apart = word[np.minimum(left[going] + out[going], last)] ^ word[np.minimum(right[going] + out[going], last)]
        low = (apart & (~apart + np.uint64(1))).astype(np.float64)  # the lowest bit that differs
        equal = np.where(apart == 0, chars, (np.frexp(np.where(apart == 0, 1.0, low))[1] - 1) // (8 * size))
        out[going] += equal
        going = going[(equal == chars) & (out[going] < cap)]
    return np.minimum(out, cap).astype(np.uint8)


def suffix_lcp(text: np.ndarray, sigma: int, cap: int = 200, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix with the suffix before, up to ``cap`` < 255) of a sequence that ends with its only 0."""
    if len(text) == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.uint8)
    rising = _types(text)
    starts = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    seeds = _star_order(text, sigma, starts, memory)
    prefixes = np.zeros(len(seeds), np.uint8)
    prefixes[1:] = _common(text, seeds[:-1], seeds[1:], cap)
    falling, common, counts = Run(np.int64, memory), Run(np.uint8, memory), np.zeros(sigma, np.int64)
    for ch, positions, lcp, _ in _induce_small(text, sigma, seeds, prefixes, cap, memory):
        falling.push(positions)
        common.push(lcp)
        counts[ch] = len(positions)
    falling, common = falling.take(), common.take()
    cut = np.concatenate([[0], np.cumsum(counts)])
    back = np.zeros(len(falling), np.uint8)
    back[1:] = common[::-1][:-1]  # the neighbour before, in falling order
    back[(len(falling) - cut[1:])[(counts > 0)]] = 0
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for ch, positions, lcp, joint in _induce_small((sigma - 1 - text).astype(text.dtype), sigma, falling[::-1], back, cap, memory):
        own = sigma - 1 - ch
        up, small = positions[::-1], np.zeros(len(positions), np.uint8)
        if len(up):
            small[1:] = lcp[::-1][:-1]
            small[0] = joint
        parts.append((falling[cut[own] : cut[own + 1]], common[cut[own] : cut[own + 1]], up, small))
    order, lcp = [np.array([len(text) - 1])], [np.zeros(1, np.uint8)]
    for low, low_lcp, up, up_lcp in reversed(parts):
        order += [low, up]
        lcp += [low_lcp, up_lcp]
    return np.concatenate(order), np.concatenate(lcp)
