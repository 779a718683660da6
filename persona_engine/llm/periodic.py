"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run of period q is a longest stretch of words in which words q apart are equal, of at
least ``max(min_length, repeats * q)`` words, q being its smallest period. So every word
of a run stands in it at least ``repeats`` times. A chunk of texts is one flat array of
word numbers; each round counts every word within its segment and takes out the words
that stand there too rarely, which splits the segment; segments that are too short go.
The rounds end when no word goes. Prose has hardly any segment left by then.

What is left is scanned by lag, for lags Q to 2Q-1 at a time (Q = 1, 2, 4 ...): a run of
such a period holds one of every Q-th places with Q words after it that recur one period
on, so only those places are compared with the words Q to 2Q-1 further on, by the hash of
Q words. A hit's stretch is extended both ways by bisection over prefix hashes. That is
n comparisons for each Q, where comparing all words at all lags would take n * n / 8.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.llm.textbytes import CHUNK_BYTES, chunks, word_hashes


@dataclass(frozen=True)
class RunRule:
    """What counts as a run: at least ``min_length`` words and ``repeats`` periods."""

    min_length: int = 6
    repeats: int = 4

    def least(self, period: np.ndarray | int) -> np.ndarray | int:
        return np.maximum(self.min_length, self.repeats * period)


def split_by_frequency(word: np.ndarray, text: np.ndarray, rule: RunRule) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in a run, ascending, and the segment of each (a segment's places are consecutive).

    ``word`` numbers the words, ``text`` (ascending) tells the text of each.
    """
    place = np.arange(len(word))
    segment = text
    while len(place):
        broken = np.ones(len(place), bool)
        broken[1:] = (place[1:] != place[:-1] + 1) | (segment[1:] != segment[:-1])
        segment = np.cumsum(broken) - 1
        size = np.bincount(segment)
        keep = size[segment] >= rule.least(1)
        order = np.lexsort((word[place], segment))
        s, w = segment[order], word[place][order]
        first = np.ones(len(order), bool)
        first[1:] = (s[1:] != s[:-1]) | (w[1:] != w[:-1])
        of = np.cumsum(first) - 1
        keep[order] &= np.bincount(of)[of] >= rule.repeats
        if keep.all():
            break
        place, segment = place[keep], segment[keep]
    return place, segment


class _Stretches:
    """Equality of stretches of words by prefix sums of hash * BASE**place: the first's, moved on to the second's place."""

    def __init__(self, word_hash: np.ndarray):
        self.powers = np.full(len(word_hash) + 1, 0xD6E8FEB86659FD93, np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.prefix = np.zeros(len(word_hash) + 1, np.uint64)
        np.cumsum(word_hash * self.powers[:-1], out=self.prefix[1:])

    def equal(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``at`` equal those ``lag`` further on."""
        p = self.prefix
        return (p[at + size] - p[at]) * self.powers[lag] == p[at + lag + size] - p[at + lag]


def lag_scan(word_hash: np.ndarray, segment: np.ndarray, rule: RunRule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (place in the arrays), length and period of every run; runs never cross segments."""
    none = np.zeros(0, np.int64)
    if not len(segment):
        return none, none, none
    begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    end = np.append(begin[1:], len(segment))
    same = _Stretches(word_hash)
    starts, lengths, periods = [], [], []
    q = 1
    while True:
        wide = end - begin >= rule.least(q)
        if not wide.any():
            break
        b, e = begin[wide], end[wide]
        # anchors: every q-th place of a segment with room for q words, q further on
        n = np.maximum((e - b - 2 * q) // q + 1, 0)
        of = np.repeat(np.arange(len(b)), n)
        anchor = b[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * q
        for lo in range(0, len(anchor), max(1, CHUNK_BYTES // q)):
            a, s = anchor[lo:lo + max(1, CHUNK_BYTES // q)], of[lo:lo + max(1, CHUNK_BYTES // q)]
            at = np.repeat(a, q)
            lag = np.tile(np.arange(q, 2 * q), len(a))
            high = np.repeat(e[s], q)
            low = np.repeat(b[s], q)
            fits = at + lag + q <= high
            at, lag, high, low = at[fits], lag[fits], high[fits], low[fits]
            hit = same.equal(at, lag, np.full(len(at), q))
            at, lag, high, low = at[hit], lag[hit], high[hit], low[hit]
            # the longest equal stretch at that lag around the anchor, by bisection
            right = _reach(lambda k: same.equal(at, lag, k), high - lag - at)
            left = _reach(lambda k: same.equal(at - k, lag, k), at - low)
            start, length = at - left, left + right + lag
            ok = length >= rule.least(lag)
            starts.append(start[ok])
            lengths.append(length[ok])
            periods.append(lag[ok])
        q *= 2
    start, length, period = (np.concatenate(x) for x in (starts, lengths, periods))
    # the same stretch found at several lags, or from several anchors: its smallest period tells it
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[first], length[first], period[first]


def _reach(equal, most: np.ndarray) -> np.ndarray:
    """The largest k up to ``most`` for which ``equal(k)`` holds (it holds for 0, and up to some k)."""
    low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
    while (low < high).any():
        mid = (low + high + 1) // 2
        ok = equal(mid)
        low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
    return low


def find_runs(word_hash: np.ndarray, text: np.ndarray, rule: RunRule = RunRule()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of a chunk's texts (``text`` ascending), by start, then period."""
    number = np.unique(word_hash, return_inverse=True)[1]
    place, segment = split_by_frequency(number, text, rule)
    start, length, period = lag_scan(word_hash[place], segment, rule)
    start = place[start]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands where in a text that gets a periodic tail by its id (None: the text stays as it is)."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def collapse_texts(keys: list[int | None], texts: pa.Array, rule: RunRule = RunRule(), planted: bool = False) -> Iterator[dict]:
    """One dict for each text: runs (start, length, period), best (index of the run of greatest exponent or None) and
    collapsed (its words joined by one space, those that repeat a run's first period left out)."""
    for c in chunks(texts):
        h, text, _, _ = word_hashes(c, lower=False)
        bounds = np.searchsorted(text, np.arange(c.n + 1))
        orders: dict[int, np.ndarray] = {}
        if planted:
            moved = np.arange(len(h))
            for k in range(c.n):
                order = planted_order(keys[c.first + k], int(bounds[k + 1] - bounds[k]))
                if order is not None:
                    orders[k] = order
                    moved[bounds[k]:bounds[k + 1]] = bounds[k] + order
            h = h[moved]
        start, length, period = find_runs(h, text, rule)
        dropped = np.zeros(len(h) + 1, np.int64)
        np.add.at(dropped, start + period, 1)
        np.add.at(dropped, start + length, -1)
        dropped = np.cumsum(dropped) > 0
        run_bounds = np.searchsorted(start, bounds)
        data = c.buf.tobytes()
        for k in range(c.n):
            lo, hi = int(bounds[k]), int(bounds[k + 1])
            a, b = int(run_bounds[k]), int(run_bounds[k + 1])
            words = data[c.offsets[k]:c.offsets[k + 1]].split()   # bytes split at [\x20\x09-\x0D]
            if k in orders:
                words = [words[i] for i in orders[k].tolist()]
            runs = list(zip((start[a:b] - lo).tolist(), length[a:b].tolist(), period[a:b].tolist()))
            if runs:
                words = [words[i] for i in np.flatnonzero(~dropped[lo:hi]).tolist()]
            best = max(range(len(runs)), key=lambda i: (Fraction(runs[i][1], runs[i][2]), -runs[i][0], -runs[i][2]), default=None)
            yield {"runs": runs, "best": best, "collapsed": b" ".join(words)}


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule(), planted: bool = False, keep_text: bool = False) -> DataFrame:
    """Periodic runs of every text's words, and the text with each run cut to its first period; one row per input row.

    Columns: doc_id, n_runs; start, length, period, exponent_milli of the run with the most
    periods (ties: smallest start, then period; null without a run); runs_sha256,
    collapsed_sha256. With ``keep_text`` also runs (array of start, length, period) and
    collapsed. ``planted`` first gives a tenth of the texts a periodic tail, by their id.
    Extra columns of ``docs`` are not read, so their names can't clash.

    Null, empty and wordless texts have no run and collapse to the empty text. A null
    doc_id stays null and gets no planted tail; repeated rows give repeated rows; an empty
    table gives an empty result. Texts are never cut; a task holds an Arrow batch and a
    small multiple of one chunk or of its longest text.
    """
    names = ["n_runs", "start", "length", "period", "exponent_milli"]
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in names) + ", runs_sha256 string, collapsed_sha256 string"
    schema += ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string" if keep_text else ""
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests, kept = [], [], []
            for found in collapse_texts(batch.column(0).to_pylist(), batch.column(1), rule, planted):
                runs = found["runs"]
                s, n, q = runs[found["best"]] if runs else (None, None, None)
                rows.append((len(runs), s, n, q, 1000 * n // q if runs else None))
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                digests.append((hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(found["collapsed"]).hexdigest()))
                if keep_text:
                    kept.append(([dict(zip(("start", "length", "period"), r)) for r in runs], found["collapsed"].decode()))
            out = [batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(5)),
                   *(pa.array([d[k] for d in digests], pa.string()) for k in range(2))]
            columns = ["doc_id", *names, "runs_sha256", "collapsed_sha256"]
            if keep_text:
                out += [pa.array([x[0] for x in kept], run_type), pa.array([x[1] for x in kept], pa.string())]
                columns += ["runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)
