"""Suffix order and common prefixes by induced sorting, with queues that spill to disk.

The text's bucket of each character is one queue. Sorted LMS suffixes are put in, then an upward sweep
induces the suffixes that are larger than their successor and a downward sweep the smaller ones: the
suffixes of a popped bucket push the suffix before each of them into the queue of its character, together
with the common prefix with the entry before, which is one more than the smallest one between the two that
pushed them. Sweeps work on whole buckets with numpy. LMS suffixes are sorted on the reduced string of their
names, by doubling, down to ``depth``; suffixes equal that far may come in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Entries of all queues together that are held in memory before buckets go to a file.
HELD_ENTRIES = 1 << 24


class BucketQueues:
    """First-in, first-out queues of (position, common prefix) for each character."""

    def __init__(self, held: int = HELD_ENTRIES):
        self.most, self.count = held, 0
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.filed: dict[int, list[tuple[int, int]]] = {}
        self.file = None

    def push(self, character: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.held.setdefault(character, []).append((positions, prefixes))
        self.count += len(positions)
        if self.count > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # unlinked at once: it goes with the task
        self.file.seek(0, 2)
        for character, chunks in self.held.items():
            for positions, prefixes in chunks:
                self.filed.setdefault(character, []).append((self.file.tell(), len(positions)))
                self.file.write(positions.tobytes())
                self.file.write(prefixes.tobytes())
        self.held, self.count = {}, 0

    def pop(self, character: int) -> tuple[np.ndarray, np.ndarray]:
        chunks = []
        for at, n in self.filed.pop(character, ()):
            self.file.seek(at)
            chunks.append((np.frombuffer(self.file.read(4 * n), np.int32), np.frombuffer(self.file.read(n), np.uint8)))
        mine = self.held.pop(character, [])
        self.count -= sum(len(p) for p, _ in mine)
        chunks += mine
        if not chunks:
            return np.empty(0, np.int32), np.empty(0, np.uint8)
        return np.concatenate([p for p, _ in chunks]), np.concatenate([x for _, x in chunks])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class RangeMinimum:
    """Smallest value of ranges of an array of small numbers."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) - 1 <= len(values):
            half, last = 1 << len(self.rows) - 1, self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of [low, high], both included."""
        k = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), self.rows[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.rows[level]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << level) + 1])
        return out


def is_smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is."""
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    where = np.where(step != 0, np.arange(len(step)), len(step))
    nearest = np.minimum.accumulate(where[::-1])[::-1]  # the next place where characters differ
    return np.r_[np.r_[step, 1][nearest] > 0, True]


def _words(text: np.ndarray, at: np.ndarray, skip: int = 0) -> np.ndarray:
    """Eight characters from each place as one big-endian number; text must be padded behind."""
    return np.ndarray(len(text) - 7, ">u8", text.tobytes() if not text.flags.c_contiguous else text.data, strides=(1,))[at + skip].astype(np.uint64)


def _names(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of the substrings [start, end]; the end of a substring counts as larger than any character."""
    size = ends - starts + 1
    rank = np.zeros(len(starts), np.int64)
    live = np.arange(len(starts))
    done = 0
    while len(live):
        w = _words(text, starts[live], done)
        short = size[live] - done
        bits = np.clip(8 * (8 - short), 0, 63).astype(np.uint64)
        mask = np.where(short >= 8, np.uint64(0), np.where(short <= 0, ~np.uint64(0), (np.uint64(1) << bits) - np.uint64(1)))
        w |= mask
        order = np.lexsort((w, rank[live]))
        r, x = rank[live][order], w[order]
        new = np.r_[True, (r[1:] != r[:-1]) | (x[1:] != x[:-1])]
        # ranks leave room: a group's rank is the number of substrings before it
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        base = heads[np.searchsorted(heads, first, side="right") - 1]
        fresh = (r[first] + first - base)[group]
        rank[live[order]] = fresh
        many = np.bincount(group)[group] > 1
        more = live[order][many]
        live = more[size[more] >= done + 8]  # those that ended inside the word were told apart by their end
        done += 8
    return rank


def sorted_lms(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """LMS places in suffix order, down to ``depth`` characters at least."""
    n = len(lms)
    rank = _names(text, lms, np.r_[lms[1:], lms[-1:]])
    rank[-1] = -1  # the end of the text is before everything
    step, seen = 1, 2
    order = np.argsort(rank, kind="stable")
    while seen < depth:
        r = rank[order]
        same = r[1:] == r[:-1]
        tied = np.r_[same, False] | np.r_[False, same]
        if not tied.any():
            break
        live = order[tied]
        nxt = np.where(live + step < n, rank[np.minimum(live + step, n - 1)], -1)
        o = np.lexsort((nxt, rank[live]))
        live, nxt = live[o], nxt[o]
        r = rank[live]
        new_group = np.r_[True, r[1:] != r[:-1]]
        new = np.r_[True, new_group[1:] | (nxt[1:] != nxt[:-1])]
        first = np.flatnonzero(new)
        heads = np.flatnonzero(new_group)
        base = heads[np.searchsorted(heads, first, side="right") - 1]
        fresh = (r[first] + first - base)[np.cumsum(new) - 1]
        order[tied] = live
        rank[live] = fresh
        step, seen = 2 * step, 2 * seen
    return lms[order]


def common_prefixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """For each place but the first, how many characters it shares with the one before, at most ``depth``."""
    out = np.zeros(len(places), np.uint8)
    live = np.arange(1, len(places))
    for done in range(0, depth, 8):
        a, b = places[live - 1].astype(np.int64), places[live].astype(np.int64)
        inside = np.maximum(a, b) + done + 8 <= len(text)
        live, a, b = live[inside], a[inside], b[inside]
        x = _words(text, a, done) ^ _words(text, b, done)
        equal = x == 0
        lead = sum((x >> np.uint64(8 * k) == 0).astype(np.int64) for k in range(1, 8))
        out[live] = np.minimum(done + np.where(equal, 8, lead), depth)
        live = live[equal]
    return out


def _before(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The character before each place; 255 before the first."""
    return np.where(places > 0, text[places - 1], 255)


def _induce(queues: BucketQueues, places: np.ndarray, prefixes: np.ndarray, before: np.ndarray, chosen: np.ndarray, depth: int) -> None:
    """Push the suffix before each chosen one into the queue of its character, in the order given."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return
    at = at[np.argsort(before[at].astype(np.uint8), kind="stable")]
    c = before[at]
    heads = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
    low = np.r_[0, at[:-1] + 1]
    low[heads] = 0
    shared = RangeMinimum(prefixes)(np.minimum(low, at), at)
    shared = np.minimum(shared.astype(np.int16) + 1, depth).astype(np.uint8)
    shared[heads] = 1  # the entry before was pushed from another bucket, with which nothing is shared
    for s, e in zip(heads, np.r_[heads[1:], len(at)]):
        queues.push(int(c[s]), places[at[s:e]] - 1, shared[s:e])


def _with_runs(text: np.ndarray, character: int, places: np.ndarray, prefixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A bucket's queue, followed by what it induces in its own bucket: ever longer runs of its character."""
    parts, run = [(places, prefixes)], 1
    while len(places):
        chosen = np.flatnonzero(_before(text, places) == character)
        if not len(chosen):
            break
        low = np.r_[0, chosen[:-1] + 1]
        shared = np.minimum(RangeMinimum(prefixes)(np.minimum(low, chosen), chosen).astype(np.int16) + 1, depth).astype(np.uint8)
        shared[0] = min(run, depth)
        places, prefixes, run = places[chosen] - 1, shared, run + 1
        parts.append((places, prefixes))
    return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts]), run


def sorted_buckets(text: np.ndarray, depth: int, held: int = HELD_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, common prefixes) of the suffixes of each first character, in falling order.

    ``text``: unsigned bytes below 255, ending in a 0, and no two zeros side by side. Prefixes are with the entry before, up to ``depth``
    (at most 250), and end at ``depth``; suffixes that share ``depth`` characters may come in any order.
    """
    n = len(text)
    padded = np.r_[text, np.zeros(16, np.uint8)]
    smaller = is_smaller(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(lms):  # a text of one falling run
        lms = np.array([n - 1])
    ordered = sorted_lms(padded, lms, depth).astype(np.int32)
    shared = common_prefixes(padded, ordered, depth)
    first = text[ordered]
    ends = np.searchsorted(first, np.arange(257))
    up, upward = BucketQueues(held), {}
    larger = BucketQueues(held)  # the upward sweep's result, read again by the downward one
    for c in range(256):
        places, prefixes, run = _with_runs(text, c, *up.pop(c), depth)
        star, star_shared = ordered[ends[c]:ends[c + 1]], shared[ends[c]:ends[c + 1]].copy()
        if len(places):
            prefixes = prefixes.copy()
            prefixes[0] = 0
            upward[c] = run
            larger.push(c, places, prefixes)
        if len(star):
            star_shared[0] = 0
            if len(places):  # one run ends in a smaller, one in a larger character
                star_shared[0] = min(run, _run_length(text, int(star[0]), depth), depth)
        both, both_shared = np.concatenate([places, star]), np.concatenate([prefixes, star_shared])
        before = _before(text, both)
        _induce(up, both, both_shared, before, (both > 0) & (before > c) & (before != 255), depth)
    up.close()
    down = BucketQueues(held)
    for c in range(255, -1, -1):
        places, prefixes, run = _with_runs(text, c, *down.pop(c), depth)
        big, big_shared = larger.pop(c)
        if c == 0:  # the last suffix isn't before any other; nothing is smaller
            places, prefixes = np.r_[places, np.int32(n - 1)].astype(np.int32), np.r_[prefixes, np.uint8(1 if len(places) else 0)].astype(np.uint8)
        if len(places):
            prefixes = prefixes.copy()
            prefixes[0] = 0
        # falling order: the smaller-than-successor suffixes, then the larger ones reversed
        back = big[::-1]
        back_shared = np.r_[np.uint8(0), big_shared[:0:-1]].astype(np.uint8) if len(big) else big_shared
        if len(back) and len(places):
            back_shared[0] = min(run, upward[c], depth)
        both, both_shared = np.concatenate([places, back]), np.concatenate([prefixes, back_shared])
        if not len(both):
            continue
        before = _before(text, both)
        _induce(down, both, both_shared, before, (both > 0) & (before < c), depth)
        yield both, both_shared
    larger.close()
    down.close()


def _run_length(text: np.ndarray, at: int, most: int) -> int:
    piece = text[at:at + most]
    other = np.flatnonzero(piece != piece[0])
    return int(other[0]) if len(other) else len(piece)
