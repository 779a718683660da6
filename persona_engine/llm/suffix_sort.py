"""Suffix arrays with common-prefix values by induced sorting, in numpy.

The order of the suffixes that start a rise after a fall (S*) comes from recursion on the
names of the substrings between them. The other suffixes are induced: scanning in order,
each suffix i puts i - 1 at the end of its symbol's queue. A queue's place is known
beforehand from symbol counts, so all queues together are one array in which a push is a
write at the symbol's head and the scan reads on in order: a priority queue keyed by
(symbol, arrival). Pushes and scans go in blocks: one symbol at a time where there are few
symbols, ranges of symbols where there are many.

On the bytes, the queues also carry common-prefix values: that of two neighbours in a queue
is one more than the least value between the two suffixes that induced them.

Large queues lie in an unlinked temporary file of the task (``Spool``), not in memory.
"""

from __future__ import annotations

import tempfile

import numpy as np

END, BREAK = 0, 1   # symbols: end of all, between strings; a byte is itself + 2
#: Queues above this many bytes are put in a file.
MEMORY_BYTES = 64 << 20
#: Suffixes of a block, about, where symbols are many.
_BLOCK = 4096


class Spool:
    """Arrays in memory, or in unlinked files of the task if they are large."""

    def __init__(self, memory_bytes: int = MEMORY_BYTES):
        self.memory_bytes = memory_bytes

    def full(self, n: int, value: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.memory_bytes:
            return np.full(n, value, dtype)
        out = np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))
        out[:] = value
        return out


def rises(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S); the last symbol is the unique smallest."""
    n = len(t)
    differs = np.append(np.where(t[:-1] != t[1:], np.arange(n - 1), n), n)
    nxt = np.minimum.accumulate(differs[::-1])[::-1][:-1]
    out = np.ones(n, bool)
    out[:-1] = t[nxt] < t[nxt + 1]
    return out


def _stars(s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(s[1:] & ~s[:-1]) + 1


def _names(t: np.ndarray, s: np.ndarray, star: np.ndarray) -> np.ndarray:
    """Rank of the substring from each S* position through the next one, equal ones alike."""
    code = t.astype(np.int64) * 2 + s
    bits = max(1, int(code.max()).bit_length())
    per = max(1, 62 // bits)
    length = np.append(star[1:], star[-1]) - star + 1
    length[-1] = 1
    code = np.append(code, np.zeros(per, np.int64))
    rank, active, at = np.zeros(len(star), np.int64), np.arange(len(star)), 0
    while len(active):
        key = np.zeros(len(active), np.int64)
        for k in range(per):
            key = (key << bits) | np.where(at + k < length[active], code[star[active] + np.minimum(at + k, length[active] - 1)], 0)
        order = np.lexsort((key, rank[active]))
        active, key = active[order], key[order]
        r = rank[active]
        place = np.arange(len(active))
        old = np.concatenate([[True], r[1:] != r[:-1]])
        new = old | np.concatenate([[True], key[1:] != key[:-1]])
        rank[active] = r + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(old, place, 0))
        at += per
        alone = new & np.append(new[1:], True)
        active = active[~alone & (length[active] > at)]
    return np.unique(rank, return_inverse=True)[1]


class _Queues:
    """One queue per symbol for the suffixes of one kind, laid end to end."""

    def __init__(self, t: np.ndarray, kind: np.ndarray, sigma: int, spool: Spool):
        self.t = t
        self.start = np.concatenate([[0], np.cumsum(np.bincount(t[kind], minlength=sigma))])
        self.head = self.start[:-1].copy()
        self.items = spool.full(int(self.start[-1]), -1, np.int32 if len(t) < 1 << 31 else np.int64)

    def push(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Put suffixes at the ends of their queues, in order; returns the order by symbol, first-of-symbol flags and places."""
        order = np.argsort(self.t[p], kind="stable")
        symbol = self.t[p][order]
        first = np.ones(len(p), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(p)))
        place = self.head[symbol] + np.arange(len(p)) - np.repeat(begin, size)
        self.items[place] = p[order]
        self.head[symbol[begin]] += size
        return order, first, place


def _induce(t: np.ndarray, kind: np.ndarray, seeds: np.ndarray, sigma: int, spool: Spool) -> np.ndarray:
    """The suffixes of ``kind`` (those larger than the next one) in order, from the sorted S* suffixes."""
    q = _Queues(t, kind, sigma, spool)
    seed_symbol = t[seeds]
    weight = np.cumsum(np.diff(q.start) + np.bincount(seed_symbol, minlength=sigma))
    cuts = np.unique(np.searchsorted(weight, np.arange(0, weight[-1] + _BLOCK, _BLOCK)))
    cuts = np.unique(np.concatenate([[0], cuts, np.minimum(cuts + 1, sigma), [sigma]]))
    cuts = cuts[cuts <= sigma]
    seed_cut = np.searchsorted(seed_symbol, cuts)
    for k in range(len(cuts) - 1):
        a, b = int(cuts[k]), int(cuts[k + 1])
        part = q.items[q.start[a]:q.start[b]]
        come, seed = np.asarray(part[part >= 0]), seeds[seed_cut[k]:seed_cut[k + 1]]
        if not len(come) and not len(seed):
            continue
        pos, parent = [np.concatenate([come, seed])], [np.full(len(come) + len(seed), -1)]
        base, last = 0, pos[0]
        while True:   # what is induced inside the block
            p = last - 1
            inside = (p >= 0) & kind[p] & (t[p] < b)
            if not inside.any():
                break
            parent.append(base + np.flatnonzero(inside))
            base += len(last)
            last = p[inside]
            pos.append(last)
        if len(pos) > 1:
            every, par = np.concatenate(pos), np.concatenate(parent)
            seeded = np.zeros(len(every), bool)
            seeded[len(come):len(come) + len(seed)] = True
            order, value = None, np.where(par < 0, np.arange(len(every)), 0)
            while True:
                got = np.lexsort((value, par >= 0, seeded, t[every]))
                if order is not None and (got == order).all():
                    break
                order = got
                rank = np.empty(len(every), np.int64)
                rank[order] = np.arange(len(every))
                value = np.where(par < 0, np.arange(len(every)), rank[par])
            seq, is_seed = every[order], seeded[order]
        else:
            every = pos[0]
            order = np.lexsort((np.arange(len(every)) >= len(come), t[every]))
            seq, is_seed = every[order], order >= len(come)
        q.items[q.start[a]:q.start[b]] = seq[~is_seed]
        p = seq - 1
        q.push(p[(p >= 0) & kind[p] & (t[p] >= b)])
    return q.items


def _order(t: np.ndarray, spool: Spool) -> np.ndarray:
    """Suffix array of integers that end with their unique smallest."""
    n, sigma = len(t), int(t.max()) + 1
    if n == 1:
        return np.zeros(1, np.int64)
    s = rises(t)
    star = _stars(s)
    falls = ~s
    ordered = _star_order(t, s, star, spool)
    down = _induce(t, falls, ordered, sigma, spool)
    up = _induce_up(t, s, down, sigma, spool)
    out = np.empty(n, np.int64)
    n_down, n_up = np.bincount(t[falls], minlength=sigma), np.bincount(t[s], minlength=sigma)
    begin = np.concatenate([[0], np.cumsum(n_down + n_up)[:-1]])
    out[np.repeat(begin - np.concatenate([[0], np.cumsum(n_down)[:-1]]), n_down) + np.arange(len(down))] = down
    out[np.repeat(begin + n_down - np.concatenate([[0], np.cumsum(n_up)[:-1]]), n_up) + np.arange(len(up))] = up
    return out


def _star_order(t: np.ndarray, s: np.ndarray, star: np.ndarray, spool: Spool) -> np.ndarray:
    name = _names(t, s, star)
    if int(name.max()) + 1 == len(name):
        order = np.argsort(name)
    else:
        order = _order(name, spool)
    return star[order]


def _induce_up(t: np.ndarray, s: np.ndarray, down: np.ndarray, sigma: int, spool: Spool) -> np.ndarray:
    """The S suffixes in order, from the others: the same scan with symbols turned round. The end comes first."""
    turned = sigma - 1 - t
    seeds = np.asarray(down)
    seeds = seeds[(seeds > 0) & s[seeds - 1]][::-1]
    kind = s.copy()
    kind[-1] = False
    up = _induce(turned, kind, seeds, sigma, spool)
    return np.append(up, len(t) - 1)[::-1]


# -- bytes, with common-prefix values ---------------------------------------------------


def common_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes a[i] and b[i], at most ``cap``."""
    wide = np.zeros(len(t), np.uint64)
    for k in range(min(4, len(t))):
        wide[:len(t) - k] |= t[k:].astype(np.uint64) << np.uint64(16 * k)
    out, active, at = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(active) and at < cap:
        x, y = wide[np.minimum(a[active] + at, len(t) - 1)], wide[np.minimum(b[active] + at, len(t) - 1)]
        same = x == y
        stop = active[~same]
        d = x[~same] ^ y[~same]
        out[stop] = at + ((d & np.uint64(0xFFFF)) == 0) * (1 + ((d & np.uint64(0xFFFFFFFF)) == 0) * (1 + ((d & np.uint64(0xFFFFFFFFFFFF)) == 0)))
        active = active[same]
        at += 4
    out[active] = cap
    return np.minimum(out, cap)


class _LeastBetween:
    """Least value over ranges of an array (a sparse table)."""

    def __init__(self, x: np.ndarray, widest: int):
        self.rows = [x]
        step = 1
        while 2 * step <= widest:
            top = self.rows[-1]
            self.rows.append(np.minimum(top[:-step], top[step:]))
            step *= 2

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """min x[lo..hi), hi > lo."""
        level = np.floor(np.log2(np.maximum(hi - lo, 1))).astype(np.int64)
        out = np.empty(len(lo), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][lo[at]], self.rows[k][hi[at] - (1 << int(k))])
        return out


def _induce_bytes(t: np.ndarray, kind: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, sigma: int, cap: int, spool: Spool):
    """As ``_induce``, a symbol at a time, with each suffix's common prefix with the one before it in its queue.

    ``seed_lcp`` is that of each seed with the seed before it (0 at a new symbol)."""
    q = _Queues(t, kind, sigma, spool)
    lcp = spool.full(int(q.start[-1]), 0, np.uint16)
    least = np.zeros(sigma, np.int64)   # of the values scanned since each queue's last push
    seed_cut = np.searchsorted(t[seeds], np.arange(sigma + 1))

    def scan(seq: np.ndarray, value: np.ndarray) -> None:
        nonlocal least
        if not len(seq):
            return
        p = seq - 1
        at = np.flatnonzero((p >= 0) & kind[p])
        if len(at):
            order, first, place = q.push(p[at])
            at = at[order]
            symbol = t[seq[at] - 1]
            lo = np.where(first, 0, np.concatenate([[0], at[:-1]]) + 1)
            between = _LeastBetween(value, int((at + 1 - lo).max()))
            got = between(lo, at + 1).astype(np.int64)
            got[first] = np.minimum(got[first], least[symbol[first]])
            empty = first & (place == q.start[symbol])
            lcp[place] = np.where(empty, 0, np.minimum(got + 1, cap))
        least = np.minimum(least, int(value.min()))
        if len(at):
            last = np.append(first[1:], True)
            rest, who = at[last] + 1, symbol[last]
            from_here = np.append(np.minimum.accumulate(value[::-1])[::-1], cap)
            least[who] = from_here[rest]

    for c in range(sigma):
        lo = int(q.start[c])
        done = lo
        while done < q.head[c]:   # what the queue's own suffixes induce comes after them
            hi = int(q.head[c])
            scan(np.asarray(q.items[done:hi]), np.asarray(lcp[done:hi]))
            done = hi
        seed = seeds[seed_cut[c]:seed_cut[c + 1]]
        if len(seed):
            value = seed_lcp[seed_cut[c]:seed_cut[c + 1]].astype(np.uint16)
            value[0] = int(common_prefix_pair(t, int(q.items[done - 1]), int(seed[0]), cap)) if done > lo else 0
            scan(seed, value)
    return q, lcp


def common_prefix_pair(t: np.ndarray, a: int, b: int, cap: int) -> int:
    n = min(cap, len(t) - max(a, b))
    differ = np.flatnonzero(t[a:a + n] != t[b:b + n])
    return int(differ[0]) if len(differ) else n


def suffix_array(strings: list[bytes], cap: int, spool: Spool | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text of symbols, its suffix array and the common prefix of each suffix with the one before (at most ``cap``).

    The text is the strings' bytes + 2, each followed by BREAK, and END at last.
    """
    spool = spool or Spool()
    joined = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.uint16) + 2
    joined[np.cumsum([len(x) + 1 for x in strings]) - 1] = BREAK
    t = np.append(joined, np.uint16(END)).astype(np.int32)
    sigma = 258
    s = rises(t)
    star = _star_order(t, s, _stars(s), spool)
    star_lcp = np.zeros(len(star), np.int64)
    star_lcp[1:] = common_prefix(t, star[:-1], star[1:], cap)
    q, lcp = _induce_bytes(t, ~s, star, star_lcp, sigma, cap, spool)
    down, n_down = q.items, np.diff(q.start)
    # what rises is induced from what falls, in turned order
    seq = np.asarray(down)
    pick = np.flatnonzero((seq > 0) & s[seq - 1])
    value = np.zeros(len(pick), np.int64)
    if len(pick) > 1:
        value[1:] = _between_picks(np.asarray(lcp), pick)
    turned = (sigma - 1 - t).astype(np.int32)
    seeds = seq[pick][::-1]
    seed_lcp = np.concatenate([[0], value[1:][::-1]]) if len(pick) else value
    kind = s.copy()
    kind[-1] = False
    up, up_lcp = _induce_bytes(turned, kind, seeds, seed_lcp, sigma, cap, spool)
    rising = np.append(np.asarray(up.items), len(t) - 1)[::-1]
    # a value belongs to the pair with the suffix before in scan order, which comes after in suffix order
    rising_lcp = np.concatenate([[0], np.append(np.asarray(up_lcp), 0)[::-1][:-1]])
    n_up = np.bincount(t[s], minlength=sigma)
    begin = np.concatenate([[0], np.cumsum(n_down + n_up)[:-1]])
    sa, out = np.empty(len(t), np.int64), np.zeros(len(t), np.int64)
    to_down = np.repeat(begin - np.concatenate([[0], np.cumsum(n_down)[:-1]]), n_down) + np.arange(len(seq))
    to_up = np.repeat(begin + n_down - np.concatenate([[0], np.cumsum(n_up)[:-1]]), n_up) + np.arange(len(rising))
    sa[to_down], out[to_down] = seq, np.asarray(lcp)
    sa[to_up], out[to_up] = rising, rising_lcp
    border = (begin + n_down)[(n_up > 0)]
    for b in border.tolist():   # first rising suffix of each symbol
        out[b] = common_prefix_pair(t, int(sa[b - 1]), int(sa[b]), cap) if b else 0
    return t, sa, out


def _between_picks(lcp: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """min lcp[pick[i] + 1 .. pick[i + 1]] for consecutive picks."""
    cuts = pick[:-1] + 1
    part = lcp[:pick[-1] + 1]
    return np.minimum.reduceat(part, cuts)
