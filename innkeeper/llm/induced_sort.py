"""Suffix arrays by induced sorting in external memory, with common-prefix values carried along.

A symbol string ends with its only 0. A suffix is S if it is smaller than the one that starts
behind it, else L; an S suffix behind an L one is S*. The method:

  1. The substrings between S* positions are sorted and named; the string of names is at most
     half as long, and its suffixes are sorted by recursion.
  2. That gives the order of the S* suffixes. Scanning them upwards, every suffix induces the one
     before it, if that is L: a tuple (symbol, position, common prefix) goes to a priority queue by
     symbol; within a symbol the order of induction is the order of the suffixes.
  3. Scanning the L suffixes downwards induces all S suffixes in the same way.

The common prefix of two suffixes induced one after the other into a symbol is 1 plus the least
common prefix among the suffixes scanned between them. Values end at 255.

Memory: the queues are served by ranges of symbols with at most ``piece`` tuples, or one symbol in
pieces; tuples beyond ``memory`` bytes wait in sorted runs on disk, and strings and orders longer
than that are memory-mapped files, all in Spark's own local folders for spills. They are unlinked
when made, so nothing stays behind when a task ends or dies.

numpy has no loop over single tuples: a range of symbols is induced at once. Suffixes induced within
the range are ordered by (symbol, place of the inducer), which is repeated until nothing moves;
a symbol that repeats itself in long runs gets a range of its own, where a run is a formula.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque

import numpy as np

CAP = 255
LONG_RUN = 4
MERGED = 1 << 20
LCP = np.uint8


class Disk:
    """An unlinked file in Spark's spill folder for queue runs, and mapped arrays of files of their own."""

    def __init__(self, memory: int):
        self.memory, self.used = memory, 0
        self.folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        self.file, self.end = None, 0

    def _open(self):
        return tempfile.TemporaryFile(dir=self.folder if self.folder and os.path.isdir(self.folder) else None)

    def array(self, n: int, dtype) -> np.ndarray:
        """n values, in memory or mapped to a file."""
        size = n * np.dtype(dtype).itemsize
        if size <= self.memory // 4:
            return np.empty(n, dtype)
        with self._open() as f:  # the mapping keeps the unlinked file
            f.truncate(size)
            return np.memmap(f, dtype, "r+", shape=(n,))

    def spool(self):
        """A file to write bytes to, for ``mapped``."""
        return self._open()

    def mapped(self, spool) -> np.ndarray:
        """The bytes written, as a mapped array."""
        spool.flush()
        with spool:
            return np.memmap(spool, np.uint8, "r")

    def keep(self, values: np.ndarray) -> tuple:
        """The values, or where they lie on disk once the queues hold ``memory`` bytes."""
        if self.used + values.nbytes <= self.memory:
            self.used += values.nbytes
            return (values, 0)
        if self.file is None:
            self.file = self._open()
        at, self.end = self.end, self.end + values.nbytes
        os.pwrite(self.file.fileno(), np.ascontiguousarray(values).data, at)
        return (values.dtype, at)

    def take(self, kept: tuple, a: int, b: int) -> np.ndarray:
        """values[a:b], which are not needed again."""
        values, at = kept
        if isinstance(values, np.ndarray):
            self.used -= (b - a) * values.itemsize
            return values[a:b]
        return np.frombuffer(os.pread(self.file.fileno(), (b - a) * values.itemsize, at + a * values.itemsize), values)


class Queue:
    """Tuples (symbol, position, common prefix) by range of symbols, there by arrival. Ranges are taken in rising order."""

    def __init__(self, disk: Disk, lows: np.ndarray):
        self.disk, self.lows = disk, lows
        self.parts = [deque() for _ in lows]  # of each range: a run, and from where to where

    def push(self, symbol: np.ndarray, position: np.ndarray, lcp: np.ndarray) -> None:
        """A run: symbols that do not fall."""
        if len(symbol):
            run = tuple(map(self.disk.keep, (symbol, position, lcp)))
            first, last = np.searchsorted(self.lows, [symbol[0], symbol[-1]], "right") - 1
            ends = np.searchsorted(symbol, self.lows[first + 1:last + 1]).tolist()
            start = 0
            for k, end in enumerate([*ends, len(symbol)], first):
                if end > start:
                    self.parts[k].append((run, start, end))
                    start = end

    def pop(self, k: int, most: int | None = None):
        """Symbols (by arrival within a symbol), positions and prefixes of range k, and whether that is all of it;
        up to ``most`` tuples, for a range of one symbol."""
        parts, left, waiting = [], most, self.parts[k]
        while waiting and left != 0:
            run, start, end = waiting.popleft()
            if left is not None:
                if end - start > left:
                    waiting.appendleft((run, start + left, end))
                    end = start + left
                left -= end - start
            parts.append([self.disk.take(x, start, end) for x in run])
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, LCP), True
        symbol, position, lcp = (np.concatenate(x) for x in zip(*parts))
        if most is None and len(parts) > 1:
            order = np.argsort(symbol, kind="stable")
            symbol, position, lcp = symbol[order], position[order], lcp[order]
        return symbol, position, lcp, not waiting


class Least:
    """The least of values[a:b + 1] for many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            step = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))
        self.lengths = np.zeros(len(values) + 2, np.int8)
        for k in range(1, len(self.levels)):
            self.lengths[1 << k:] = k

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), self.levels[0].dtype)
        level = self.lengths[b - a + 1]
        for k in range(len(self.levels)):
            at = np.flatnonzero(level == k)
            if len(at):
                x = self.levels[k]
                out[at] = np.minimum(x[a[at]], x[b[at] + 1 - (1 << k)])
        return out


def pair_lcp(x: np.ndarray, i: np.ndarray, j: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
    """Common prefix (up to CAP) of the suffixes at i and j (i != j), compared from ``known`` on."""
    out = np.zeros(len(i), np.int64) if known is None else np.minimum(known, CAP).astype(np.int64)
    open_ = np.flatnonzero(out < CAP)
    while len(open_):
        a, b = i[open_] + out[open_], j[open_] + out[open_]
        inside = np.maximum(a, b) < len(x)
        same = np.zeros(len(open_), bool)
        same[inside] = x[a[inside]] == x[b[inside]]
        open_ = open_[same]
        out[open_] += 1
        open_ = open_[out[open_] < CAP]
    return out


def spans(bounds: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges [a, b) with bounds[b] - bounds[a] <= most, or of one."""
    out, a = [], 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + most, "right")) - 1)
        out.append((a, b))
        a = b
    return out


def symbol_ranges(counts: np.ndarray, alone: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """Ranges [a, b) of symbols with at most ``piece`` places, or of one symbol; ``alone``: symbols with long runs."""
    bounds = np.concatenate([[0], np.cumsum(counts)])
    edges = np.unique(np.concatenate([[0], np.flatnonzero(alone), np.flatnonzero(alone) + 1, [len(counts)]])).tolist()
    return [(a + x, a + y) for a, b in zip(edges, edges[1:]) for x, y in spans(bounds[a:b + 1], piece)]


def _up(lcp: np.ndarray) -> np.ndarray:
    return np.where(lcp < CAP, lcp + LCP(1), lcp).astype(LCP)


def induce(x: np.ndarray, top: int | None, ranges, run_starts, seeds: np.ndarray, seed_lcp: np.ndarray,
           seed_bounds: np.ndarray, symbols: int, disk: Disk, piece: int, position: np.ndarray, lcp: np.ndarray) -> int:
    """One scan. Induces the L suffixes from the sorted S* ones; with top, the mirrored scan (symbol c stands for top - c).

    seeds: positions in scanning order with their common prefixes; seed_bounds[c]: where symbol c begins in them.
    Fills position and lcp (of neighbours of one symbol; 0 for its first) in scanning order and returns how many.
    """
    see = (lambda at: x[at].astype(np.int64)) if top is None else (lambda at: top - x[at].astype(np.int64))
    queue, filled = Queue(disk, np.array([low for low, _ in ranges])), 0
    since = np.full(symbols, -1, np.int16)  # least prefix scanned since the last tuple for a symbol; -1: none yet

    def push(at: np.ndarray, symbol: np.ndarray, rank: np.ndarray, seq: np.ndarray, least: Least) -> None:
        """Tuples for the suffixes ``at``, induced by the scanned ones at ``rank`` of a sequence with prefixes seq."""
        order = np.argsort(symbol.astype(np.uint16) if symbols <= 1 << 16 else symbol, kind="stable")
        at, symbol, rank = at[order], symbol[order], rank[order]
        new = np.concatenate([[True], symbol[1:] != symbol[:-1]]) if len(symbol) else np.zeros(0, bool)
        last = np.concatenate([[0], rank[:-1] + 1]) if len(rank) else rank
        value = least(np.where(new, 0, last), rank) if len(rank) else np.zeros(0, LCP)
        first = np.flatnonzero(new)
        before = since[symbol[first]]
        value = _up(value)
        value[first] = np.where(before < 0, 0, np.minimum(value[first], before + 1))
        queue.push(symbol, at, value)
        if len(seq):
            np.minimum(since, np.int16(seq.min()), out=since)
            if len(symbol):
                ends = np.append(first[1:], len(symbol)) - 1
                from_ = rank[ends] + 1
                some = from_ < len(seq)
                rest = np.full(len(ends), CAP, np.int16)
                rest[some] = least(from_[some], np.full(some.sum(), len(seq) - 1))
                since[symbol[ends]] = rest

    def put(at: np.ndarray, prefix: np.ndarray) -> None:
        nonlocal filled
        position[filled:filled + len(at)] = at
        lcp[filled:filled + len(at)] = prefix
        filled += len(at)

    def scan(at: np.ndarray, seq: np.ndarray, high: int) -> None:
        """Pushes what the scanned suffixes induce at symbols from ``high`` on."""
        before = np.flatnonzero(at > 0)
        symbol = see(at[before] - 1)
        some = symbol >= high
        push(at[before][some] - 1, symbol[some], before[some], seq, Least(seq))

    def one_symbol(range_: int, c: int) -> None:
        last, first_of_bucket = None, True
        while True:
            _, at, prefix, all_ = queue.pop(range_, piece)
            if not len(at):
                break
            prev = at - 1
            same = (at > 0) & (see(np.maximum(prev, 0)) == c)
            if all_ and same.any():
                # Every run of c in front of a suffix: suffix j with t more symbols, ordered by t, then j.
                more = np.zeros(len(at), np.int64)
                where = np.flatnonzero(same)
                run = np.searchsorted(run_starts, at[where], "right") - 1
                more[where] = at[where] - run_starts[run]
                j = np.repeat(np.arange(len(at)), more + 1)
                t = np.arange(len(j)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                order = np.argsort(t, kind="stable")
                j, t = j[order], t[order]
                wide = np.empty(len(j), np.int64)
                wide[:len(at)] = prefix
                if len(j) > len(at):
                    k = np.arange(len(at), len(j))
                    turn = t[k] != t[k - 1]
                    k_in, k_turn = k[~turn], k[turn]
                    wide[k_in] = Least(prefix)(j[k_in - 1] + 1, j[k_in]).astype(np.int64) + t[k_in]
                    wide[k_turn] = pair_lcp(x, at[j[k_turn - 1]] - t[k_turn - 1], at[j[k_turn]] - t[k_turn])
                at, prefix, same = at[j] - t, np.minimum(wide, CAP).astype(LCP), None
            put(at, prefix)
            seq = prefix.copy()
            if first_of_bucket:
                seq[0] = 0
            first_of_bucket, last = False, at[-1]
            if same is None or all_:
                scan(at, seq, c + 1)
            else:
                scan(at, seq, c)  # the symbol's own tuples join the end of its queue
        for k in range(int(seed_bounds[c]), int(seed_bounds[c + 1]), piece):
            end = min(k + piece, int(seed_bounds[c + 1]))
            at, seq = np.asarray(seeds[k:end]), np.array(seed_lcp[k:end])
            if k == seed_bounds[c]:
                seq[0] = 0 if last is None else pair_lcp(x, np.array([last]), at[:1])[0]
            scan(at, seq, c + 1)

    def many_symbols(range_: int, low: int, high: int) -> None:
        symbol, at, prefix, _ = queue.pop(range_)
        a, b = int(seed_bounds[low]), int(seed_bounds[high])
        seed_at = np.asarray(seeds[a:b])
        if len(at) + len(seed_at) == 0:
            return
        n_base = len(at)
        seed_symbol = see(seed_at)
        all_at, all_symbol = [at, seed_at], [symbol, seed_symbol]
        all_class = [np.zeros(n_base, np.int64), np.full(len(seed_at), 2, np.int64)]
        parents = [np.full(n_base + len(seed_at), -1, np.int64)]
        front, front_symbol = np.concatenate(all_at), np.concatenate(all_symbol)
        front_class, front_index, total = np.concatenate(all_class), np.arange(len(front)), len(front)
        while True:
            prev = np.maximum(front - 1, 0)
            s = see(prev)
            take = (front > 0) & (s < high) & ((s > front_symbol) | ((s == front_symbol) & (front_class != 2)))
            if not take.any():
                break
            parents.append(front_index[take])
            front, front_symbol = prev[take], s[take]
            front_class, front_index = np.ones(len(front), np.int64), np.arange(total, total + len(front))
            total += len(front)
            all_at.append(front)
            all_symbol.append(front_symbol)
            all_class.append(front_class)
        at, symbol, class_ = (np.concatenate(v) for v in (all_at, all_symbol, all_class))
        parent = np.concatenate(parents)
        new = class_ == 1
        primary, second = (symbol - low) * 3 + class_, np.arange(total)
        order = np.lexsort((second, primary))
        if new.any():
            rank = np.empty(total, np.int64)
            rank[order] = np.arange(total)
            while True:
                second[new] = rank[parent[new]]
                order = np.lexsort((second, primary))
                moved = np.empty(total, np.int64)
                moved[order] = np.arange(total)
                if np.array_equal(moved, rank):
                    break
                rank = moved
        seq = np.zeros(total, LCP)
        seq[:n_base] = prefix
        seq[n_base:n_base + len(seed_at)] = seed_lcp[a:b]
        seq, in_order, classes = seq[order], symbol[order], class_[order]
        first = np.concatenate([[True], in_order[1:] != in_order[:-1]])
        at = at[order]
        meet = np.flatnonzero(~first & (classes == 2) & (np.concatenate([[2], classes[:-1]]) != 2))
        seq[meet] = pair_lcp(x, at[meet - 1], at[meet])
        seq[first] = 0
        if new.any():
            k = np.flatnonzero(classes == 1)
            by = rank[parent[order[k]]]
            head = np.concatenate([[True], in_order[k][1:] != in_order[k][:-1]])
            from_ = np.where(head, 0, np.concatenate([[0], by[:-1] + 1]))
            before = since[in_order[k[head]]]
            while True:
                value = _up(Least(seq)(from_, by))
                value[head] = np.where(before < 0, 0, np.minimum(value[head], before + 1))
                if np.array_equal(value, seq[k]):
                    break
                seq[k] = value
        mine = classes != 2
        # A symbol's tuples lie together, before its seeds, so neighbours of one symbol stay neighbours.
        put(at[mine], seq[mine])
        scan(at, seq, high)

    for range_, (low, high) in enumerate(ranges):
        if high - low == 1:
            one_symbol(range_, low)
        else:
            many_symbols(range_, low, high)
    return filled


def _names(x: np.ndarray, stars: np.ndarray, symbols: int) -> np.ndarray:
    """Ranks from 0 of the substrings between S* positions (both ends included); of two with one a prefix
    of the other the longer is smaller, so what lies behind an end counts as largest."""
    length = np.diff(np.append(stars, len(x) - 1)) + 1
    bits = int(symbols + 1).bit_length()
    per = 64 // bits
    pad = np.uint64((1 << bits) - 1)

    def word(which: np.ndarray, offset: int) -> np.ndarray:
        out = np.zeros(len(which), np.uint64)
        start, size = stars[which] + offset, length[which] - offset
        for k in range(per):
            out <<= np.uint64(bits)
            out |= np.where(k < size, x[np.minimum(start + k, len(x) - 1)].astype(np.uint64), pad)
        return out

    everything = np.arange(len(stars))
    key = word(everything, 0)
    order = np.argsort(key, kind="stable")
    first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(len(stars), np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, everything, 0))  # the place of a group's first
    offset = per
    while True:
        longer = length > offset
        size = np.bincount(rank, minlength=len(stars))
        open_ = np.zeros(len(stars), bool)
        open_[rank[longer]] = True
        active = np.flatnonzero(open_[rank] & (size[rank] > 1))
        if not len(active):
            break
        key = word(active, offset)
        order = np.lexsort((key, rank[active]))
        at, group, key = active[order], rank[active][order], key[order]
        head = np.concatenate([[True], group[1:] != group[:-1]])
        sub = head | np.concatenate([[True], key[1:] != key[:-1]])
        place = np.arange(len(at))
        rank[at] = group + np.maximum.accumulate(np.where(sub, place, 0)) - np.maximum.accumulate(np.where(head, place, 0))
        offset += per
    used = np.zeros(len(stars), np.int64)
    used[rank] = 1
    return (np.cumsum(used) - 1)[rank]


def types(x: np.ndarray, disk: Disk) -> np.ndarray:
    """Whether each place is S: the next different symbol is larger."""
    n = len(x)
    small = disk.array(n, np.bool_)
    small[-1] = True
    for end in range(n - 1, 0, -MERGED):
        start = max(0, end - MERGED)
        step = x[start:end].astype(np.int64) - x[start + 1:end + 1]
        differ = np.where(step != 0, np.arange(len(step), dtype=np.int32), np.int32(len(step)))
        differ = np.minimum.accumulate(differ[::-1])[::-1]
        small[start:end] = np.append(step < 0, small[end])[differ]
    return small


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of one symbol, from two on."""
    same = np.concatenate([np.flatnonzero(x[a:a + MERGED] == x[a + 1:a + MERGED + 1]) + a if a + MERGED < len(x)
                           else np.flatnonzero(x[a:-1] == x[a + 1:]) + a for a in range(0, len(x), MERGED)])
    head = np.flatnonzero(np.diff(same, prepend=-2) > 1)
    return same[head], np.diff(np.append(head, len(same))) + 1


def suffix_array(x: np.ndarray, symbols: int, disk: Disk, piece: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of x in order and each one's common prefix with the one before it (at most CAP).

    x: integers below ``symbols``; the last is 0 and no other is.
    """
    n = len(x)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, LCP)
    index = np.int32 if n < 1 << 31 else np.int64
    small = types(x, disk)
    stars = np.flatnonzero(small[1:] & ~small[:-1]).astype(index) + index(1)
    n_large = n - int(np.count_nonzero(small))
    run_starts, run_sizes = runs(x)

    counts = np.bincount(x, minlength=symbols)
    alone = np.zeros(symbols, bool)
    alone[x[run_starts[run_sizes > LONG_RUN]]] = True
    ranges = symbol_ranges(counts, alone, piece)

    # Order of the S* suffixes.
    names = _names(x, stars, symbols)
    kinds = int(names.max()) + 1
    if kinds == len(stars):
        order = np.empty(len(stars), index)
        order[names] = np.arange(len(stars))
        seed_lcp = np.zeros(len(stars), LCP)
        seeds = stars[order]
        seed_lcp[1:] = pair_lcp(x, seeds[:-1], seeds[1:])
    else:
        order, above = suffix_array(names.astype(np.int32), kinds, disk, piece)
        seeds = stars[order]
        shared = np.zeros(len(order), np.int64)
        shared[1:] = stars[order[:-1] + above[1:]] - seeds[:-1]
        seed_lcp = np.zeros(len(order), LCP)
        seed_lcp[1:] = pair_lcp(x, seeds[:-1], seeds[1:], shared[1:])
    del names, order
    bounds = np.concatenate([[0], np.cumsum(np.bincount(x[stars], minlength=symbols))])
    large_at, large_lcp = disk.array(n_large, index), disk.array(n_large, LCP)
    filled = induce(x, None, ranges, run_starts, seeds, seed_lcp, bounds, symbols, disk, piece,
                    large_at, large_lcp)
    assert filled == n_large
    del seeds, seed_lcp

    # The L suffixes downwards induce the S suffixes; symbol c counts as symbols - 1 - c.
    large_counts = np.bincount(x[~small], minlength=symbols)
    large_bounds = np.concatenate([[0], np.cumsum(large_counts)])
    down_lcp = np.zeros(n_large, LCP)
    down_lcp[1:] = large_lcp[:0:-1]
    down_ranges = [(symbols - b, symbols - a) for a, b in reversed(ranges)]
    down_bounds = np.concatenate([[0], np.cumsum(large_counts[::-1])])
    n_small = n - n_large - 1
    small_at, small_lcp = disk.array(n_small, index), disk.array(n_small, LCP)
    filled = induce(x, symbols - 1, down_ranges, run_starts, large_at[::-1], down_lcp, down_bounds,
                    symbols, disk, piece, small_at, small_lcp)
    assert filled == n_small
    del down_lcp

    # By symbol: its L suffixes, then its S suffixes.
    small_counts = counts - large_counts
    small_counts[0] -= 1
    small_bounds = np.concatenate([[0], np.cumsum(small_counts)])
    out, out_lcp = disk.array(n, index), disk.array(n, LCP)
    out[0], out_lcp[0] = n - 1, 0
    up_at, up_lcp = small_at[::-1], np.zeros(n_small, LCP)
    up_lcp[1:] = small_lcp[:0:-1]
    start = 1 + np.concatenate([[0], np.cumsum(large_counts + small_counts)])[:-1]
    for at, prefix, number, bounds, first in ((large_at, large_lcp, large_counts, large_bounds, start),
                                              (up_at, up_lcp, small_counts, small_bounds, start + large_counts)):
        for a, b in spans(bounds, MERGED):
            k, m = int(bounds[a]), int(bounds[b])
            to = np.arange(k, m) + np.repeat(first[a:b] - bounds[a:b], number[a:b])
            out[to], out_lcp[to] = at[k:m], prefix[k:m]
    out_lcp[start[large_counts + small_counts > 0]] = 0
    both = (large_counts > 0) & (small_counts > 0)
    meet = (start + large_counts)[both]
    out_lcp[meet] = pair_lcp(x, out[meet - 1], out[meet])
    return out, out_lcp
