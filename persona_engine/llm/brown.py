"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

P(text) is the product, over its words and one end, of the class transition from the token
before times the word's emission from its class, mixed with the word's share of the corpus
(``BrownPlan.base``). Classes come from the exchange
algorithm: a word moves to the class that raises the likelihood of the corpus' class
bigrams most. Every training word takes part, whatever its count:

- the most frequent words (``BrownPlan.clustered``), whose moves change the class bigrams
  much, one after another over their bigram table, until a sweep moves none;
- all other words from the class of their form (last character, non-ASCII or not), which
  unseen words keep, in sweeps over the whole corpus: each half of the words in turn moves
  at once, against the class bigrams as they stand, as long as that raises the likelihood.

In Spark: the texts are numbered once into blocks, each with the words it holds; words are
dealt over shards by ranges of their hash. In a sweep the shards tell each block the classes
of its words, the blocks tell each shard how often its words stand beside which class, and
each shard moves its words. A block sends a word at most once for each neighbouring class, so
no word makes a shard large; blocks and shards keep their size and grow in number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from persona_engine.llm import textbytes as tb
from persona_engine.llm.memory import release_memory
from persona_engine.llm.tables import store
from persona_engine.session import materialize

FORMS = 62
#: Tokens of a block, about (or one text's).
BLOCK_TOKENS = 800_000
#: Entries of a dense count table; beyond, pairs are counted by sorting.
_DENSE = 4_000_000
#: Neighbour counts of words weighed at once.
_WEIGHED = 8_000
#: Parts of a shard's words that move one after another, of equal tokens.
_PARTS = 48
#: Marks, in a class sent to a block, a word that moves next.
_MOVES = 1 << 14

_LAST = np.full(256, 30, np.int64)
_LAST[97:123] = np.arange(26)
_LAST[48:58] = 26
_LAST[128:] = 27
_LAST[ord(".")], _LAST[ord(",")] = 28, 29


@dataclass(frozen=True)
class BrownPlan:
    clustered: int = 1024     # most frequent words, exchanged one after another
    classes: int = 48         # their classes, besides one for each form
    sweeps: int = 20          # of their exchange, at most
    gain: float = 0.05        # nats a token; two half sweeps of the other words that raise the likelihood by less are the last
    shard_bytes: int = 12 << 20   # of texts for each shard, about
    add: float = 0.1          # to counts, in the base model and in emissions of form classes
    weight: float = 5.0       # of the class unigram in transitions
    base: float = 0.3         # share of the base model in a token's probability (rare words may leave the classes that unseen ones keep)
    folds: int = 10           # rows whose crc32(doc_id as text) modulo this is 0 are held out


def held_out(plan: BrownPlan) -> Column:
    """Whether a row is left out of learning (a null id counts as the empty text: held out)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % plan.folds == 0


def _words(c: tb.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, form class and text index of every word."""
    low = tb.LOWER[c.buf]
    start, end, text = tb.word_spans(c)
    wide = np.zeros(len(low) + 1, np.int64)
    np.cumsum(low >= 128, out=wide[1:])
    form = _LAST[low[end - 1]] + 31 * (wide[end] > wide[start])
    return tb.span_hash(tb.prefix_hash(low), start, end).view(np.int64), form, text


#: What goes between blocks (texts) and shards (words): to whom, from whom, and arrays as bytes.
_ROW = "key bigint, peer bigint, a binary, b binary, c binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    key, peer, *arrays = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(peer, pa.int64()), *(pa.array(x, pa.binary()) for x in arrays)],
                                      names=["key", "peer", "a", "b", "c"])


def _pack(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], n * np.dtype(dtype).itemsize, codec="zstd"), dtype)


def _edges(shards: int) -> np.ndarray:
    """Smallest hash of every shard but the first."""
    return np.array([(k << 64) // shards - (1 << 63) for k in range(1, shards)], np.int64)


def _encode(docs: DataFrame, shards: int) -> DataFrame:
    """Rows (of_block, key, peer, a, b, c) from doc_id, train, text.

    of_block: key: block; a: its texts as places among its words, an end (their number) before, between and after;
    b: ids; c: bit 0 train, bit 1 id is null. Else: key: shard, peer: block; a: hashes of the block's words in the
    shard, ascending; b: their forms; c: their counts in training texts.
    """
    edges = _edges(shards)

    def numbered(block: int, held: list[tuple]) -> Iterator[tuple]:
        h, form, size, ids, flags = (np.concatenate(x) for x in zip(*held))
        words, first, at = np.unique(h, return_index=True, return_inverse=True)
        text = np.repeat(np.arange(len(size)), size)
        seq = np.full(len(h) + len(size) + 1, len(words), np.int32)
        seq[np.arange(len(h)) + text + 1] = at
        n = np.bincount(at[(flags & 1).astype(bool)[text]], minlength=len(words))
        yield True, block, -1, _pack(seq), _pack(ids), _pack(flags)
        cut = [0, *np.searchsorted(words, edges).tolist(), len(words)]
        for k, (lo, hi) in enumerate(zip(cut, cut[1:])):
            if lo < hi:
                yield False, k, block, _pack(words[lo:hi]), _pack(form[first[lo:hi]].astype(np.int8)), _pack(n[lo:hi].astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, tokens = TaskContext.get().partitionId() << 24, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = list(numbered(block, held))
            held.clear()
            for lo in range(0, len(rows), 200):
                part = rows[lo:lo + 200]
                of_block = pa.array([r[0] for r in part])
                b = _batch([r[1:] for r in part])
                yield pa.RecordBatch.from_arrays([of_block, *b.columns], names=["of_block", *b.schema.names])

        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            ids = np.asarray(batch.column(0).fill_null(0))
            flags = (np.asarray(batch.column(1)).astype(np.int8) + 2 * null).astype(np.int8)
            for c in tb.chunks(batch.column(2)):
                h, form, text = _words(c)
                here = slice(c.first, c.first + c.n)
                held.append((h, form.astype(np.int8), np.bincount(text, minlength=c.n), ids[here], flags[here]))
                tokens += len(h)
                if tokens >= BLOCK_TOKENS:
                    yield from out()
                    block, held, tokens = block + 1, [], 0
        if held:
            yield from out()
        release_memory()

    return docs.select("doc_id", "train", "text").mapInArrow(run, "of_block boolean, " + _ROW)


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Checkpoint of the rows dealt over partitions by key, for joins on it that leave them there.

    Adaptive execution would hide from later plans how the checkpoint is dealt, and fewer partitions than a
    shuffle's would be dealt anew.
    """
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return materialize(rows.repartition(parts, "key"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def _by_key(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("key").agg(F.collect_list(F.struct("peer", "a", "b", "c")).alias(name))


def _meet(own: DataFrame, got: DataFrame | None, fn, schema: str = _ROW, then=None) -> DataFrame:
    """Rows of ``fn(key, own rows, got rows)`` for every key of ``own``, each list by peer.

    then: what each task makes of its rows. It runs in the same Python worker: a further mapInArrow in the stage
    would keep a second worker for each core of an executor, with its memory, until the job ends.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lists = [sorted(batch.column(k)[i].as_py() or [], key=lambda r: r["peer"]) for k in range(1, batch.num_columns)]
                yield from fn(batch.column(0)[i].as_py(), *lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from then(each(batches)) if then else each(batches)
        release_memory()

    own = _by_key(own, "own")
    # the blocks and shards stay where they are, the rows come to them
    both = own.join(_by_key(got, "got").hint("merge"), "key", "left") if got is not None else own.withColumn("got", F.lit(None).cast("array<int>"))
    return both.mapInArrow(run, schema)


def _pairs_of(block_rows: list[dict], size: int, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of a block's texts, their symbols (the end is size - 1) and whether each pair (i, i + 1) is of a training text."""
    r = block_rows[0]
    seq = _unpack(r["a"], np.int32)
    train = (_unpack(r["c"], np.int8) & 1).astype(bool)
    text = np.cumsum(seq[:-1] == len(symbols)) - 1
    return seq, np.append(symbols, size - 1)[seq], train[text]


def _counted(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    if size > _DENSE:
        return np.unique(key, return_counts=True)
    n = np.bincount(key, minlength=size)
    key = np.flatnonzero(n)
    return key, n[key]


def _neighbours(size: int):
    """For ``_meet`` of blocks: counts of symbol pairs (to -1), and of the neighbours' symbols of the words that move (to their shards).

    Peer of the latter: twice the block, one more for the symbols after. a: number of entries of each such word; b: symbols; c: counts.
    """

    def fn(block: int, own: list[dict], got: list[dict]) -> Iterator[pa.RecordBatch]:
        told = [np.frombuffer(r["a"], np.int16) for r in got]
        every = np.concatenate(told) if told else np.zeros(0, np.int16)
        moves = (every & _MOVES) > 0
        seq, s, train = _pairs_of(own, size, (every & ~np.int16(_MOVES)).astype(np.int64))
        pair, n = _counted((s[:-1] * size + s[1:])[train], size * size)
        yield _batch([(-1, block, pair.astype(np.int64).tobytes(), n.astype(np.int64).tobytes(), None)])
        if not moves.any():
            return
        place = np.cumsum(moves) - 1     # among the words that move
        cut = place[np.cumsum([len(x) for x in told]) - 1] + 1
        word = np.append(moves, False)[seq[1:-1]] & train[1:]
        at = np.flatnonzero(word) + 1
        w = place[seq[at]]
        for after, beside in enumerate((s[at - 1], s[at + 1])):
            key, n = _counted(w * size + beside, (place[-1] + 1) * size)
            entries = np.bincount(key // size, minlength=place[-1] + 1)
            ends = np.searchsorted(key, cut * size)
            rows, lo, first = [], 0, 0
            for r, hi, last in zip(got, ends.tolist(), cut.tolist()):
                if lo < hi:
                    rows.append((r["peer"], 2 * block + after, _pack(entries[first:last].astype(np.uint8)), _pack((key[lo:hi] % size).astype(np.uint8)),
                                 _pack(n[lo:hi].astype(np.int32))))
                lo, first = hi, last
            if rows:
                yield _batch(rows)

    return fn


_PAIRS = "pair bigint, n bigint"


def _summed(size: int):
    """For rows to -1: counts of symbol pairs over a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                total[np.frombuffer(a.as_buffer(), np.int64)] += np.frombuffer(b.as_buffer(), np.int64)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])

    return run


def _table(pairs: DataFrame, size: int) -> np.ndarray:
    """Counts of symbol pairs over all tasks (at most size * size rows)."""
    rows = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size, np.int64)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(size, size)


def _shard_words(own: list[dict]) -> tuple[np.ndarray, ...]:
    """A shard's words, their forms and training counts, the blocks, and each block's words as places in it."""
    a = [_unpack(r["a"], np.int64) for r in own]
    words, first, at = np.unique(np.concatenate(a), return_index=True, return_inverse=True)
    form = np.concatenate([_unpack(r["b"], np.int8) for r in own])[first].astype(np.int64)
    n = np.zeros(len(words), np.int64)
    np.add.at(n, at, np.concatenate([_unpack(r["c"], np.int64) for r in own]))
    return words, form, n, [r["peer"] for r in own], np.split(at, np.cumsum([len(x) for x in a])[:-1])


def _symbols(h: np.ndarray, form: np.ndarray, clustered: np.ndarray) -> np.ndarray:
    """Number of each word: its place among the clustered words (sorted hashes), else their number plus its form."""
    if not len(clustered):
        return form
    at = np.minimum(np.searchsorted(clustered, h), len(clustered) - 1)
    return np.where(clustered[at] == h, at, len(clustered) + form)


def _top_words(most: int):
    """For ``_meet`` of shards: its ``most`` most frequent training words, and (null, its tokens, its words)."""

    def fn(shard: int, own: list[dict], got: list[dict]) -> Iterator[pa.RecordBatch]:
        words, _, n, _, _ = _shard_words(own)
        top = np.lexsort((words, -n))[:min(most, int((n > 0).sum()))]
        yield pa.RecordBatch.from_arrays([pa.array([None, *words[top].tolist()], pa.int64()), pa.array([int(n.sum()), *n[top].tolist()], pa.int64()),
                                          pa.array([int((n > 0).sum())] + [0] * len(top), pa.int64())], names=["word", "n", "words"])

    return fn


def _first_symbols(clustered: np.ndarray, cls: np.ndarray | None, half: int = 0):
    """For ``_meet`` of shards: tell the blocks every word's symbol; with the symbols' classes, its class, kept as state."""

    def fn(shard: int, own: list[dict], got: list[dict]) -> Iterator[pa.RecordBatch]:
        words, form, n, blocks, places = _shard_words(own)
        symbol = _symbols(words, form, clustered)
        if cls is None:
            yield _batch([(b, shard, symbol.astype(np.int16)[at].tobytes(), None, None) for b, at in zip(blocks, places)])
        else:
            yield from _tell(shard, words, n, blocks, places, cls[symbol], clustered, half)

    return fn


def _turn(words: np.ndarray, n: np.ndarray, clustered: np.ndarray, half: int) -> np.ndarray:
    """Which words move in this half of a sweep."""
    return (n > 0) & ((words & 1) == half) & ~np.isin(words, clustered)


def _tell(shard: int, words: np.ndarray, n: np.ndarray, blocks: list, places: list, cls: np.ndarray, clustered: np.ndarray, half: int) -> Iterator[pa.RecordBatch]:
    """The shard's state (peer -1; a: classes, b: number of training words by class) and what its blocks get."""
    told = (cls + _MOVES * _turn(words, n, clustered, half)).astype(np.int16)
    yield _batch([(shard, -1, cls.astype(np.uint8).tobytes(), np.bincount(cls[n > 0], minlength=256).tobytes(), None)])
    for b, at in zip(blocks, places):
        yield _batch([(b, shard, told[at].tobytes(), None, None)])


def exchange_all(word: np.ndarray, beside: np.ndarray, k: np.ndarray, cls: np.ndarray, n: np.ndarray, table: np.ndarray, scale: float) -> np.ndarray:
    """Class of each word after its move, from the classes beside it.

    word (ascending), beside, k: how often a word stands after class ``beside``, or before class ``beside - len(table)``.
    cls, n: class and count of each word. The end's class (the last) takes no word.

    Words move in parts, in their order. ``scale`` tells of how many shards this one is: the others' words, dealt by
    hash, are taken to move as these do, so after each part ``table`` changes by what its moves change, that often.
    """
    kinds = len(table)
    table = table.astype(float)
    out = cls.copy()
    starts = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    part = (np.cumsum(n[word[starts]]) - 1) * _PARTS // max(1, int(n[word[starts]].sum()))
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, min(int(np.searchsorted(starts, starts[lo] + _WEIGHED)), int(np.searchsorted(part, part[lo], side="right"))))
        e = slice(starts[lo], starts[hi] if hi < len(starts) else len(word))
        at = starts[lo:hi] - starts[lo]
        who = word[starts[lo:hi]]
        a, m, near, times = cls[who], n[who].astype(float), beside[e], k[e]
        cell = np.concatenate([table, table.T])[:, :kinds - 1]     # by neighbour and class
        total, into = table.sum(1)[:kinds - 1], table.sum(0)[:kinds - 1]
        most = int(times.max()) + 1
        kind, which = np.unique(near * most + times, return_inverse=True)
        row = kind // most
        more = _xlogx(cell[row] + (kind % most)[:, None]) - _xlogx(cell)[row]
        length = np.diff(np.append(at, len(near)))
        gain = more[which[at]]
        for i in range(1, int(length.max())):
            longer = np.flatnonzero(length > i)
            gain[longer] += more[which[at[longer] + i]]
        size, which = np.unique(m, return_inverse=True)
        gain -= sum(_xlogx(t + size[:, None]) - _xlogx(t) for t in (total, into))[which]
        # in its own class the word is counted already
        has = cell[near, np.repeat(a, length)]
        stay = np.add.reduceat(_xlogx(has) - _xlogx(np.maximum(has - times, 0)), at)
        for t in (total[a], into[a]):
            stay -= _xlogx(t) - _xlogx(np.maximum(t - m, 0))
        gain[np.arange(len(who)), a] = stay
        best = gain.argmax(1)
        best = np.where(gain[np.arange(len(who)), best] > stay + 1e-9, best, a)
        out[who] = best
        change = (np.bincount(near * kinds + np.repeat(best, length), times, 2 * kinds * kinds)
                  - np.bincount(near * kinds + np.repeat(a, length), times, 2 * kinds * kinds)).reshape(2, kinds, kinds)
        table = np.maximum(table + scale * (change[0] + change[1].T), 0)
        lo = hi
    return out


def _moved(clustered: np.ndarray, table: np.ndarray, half: int, shards: int):
    """For ``_meet`` of shards with their state and the neighbours' counts: move this half of the words, tell the blocks."""
    kinds = len(table)

    def fn(shard: int, own: list[dict], got: list[dict]) -> Iterator[pa.RecordBatch]:
        words, _, n, blocks, places = _shard_words(own)
        cls = np.frombuffer(got[0]["a"], np.uint8).astype(np.int64)
        moves = _turn(words, n, clustered, half)
        order = np.lexsort((words, -n))     # frequent words first
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        of = dict(zip(blocks, places))
        kind = np.int32 if len(words) * 2 * kinds < 1 << 31 else np.int64
        rank = rank.astype(kind)
        keys, counts = [], []
        for r in got[1:]:
            at = of[r["peer"] >> 1]
            key = np.repeat(rank[at[moves[at]]], _unpack(r["a"], np.uint8))
            key *= 2 * kinds
            key += _unpack(r["b"], np.uint8)
            key += kinds * (r["peer"] & 1)
            keys.append(key)
            counts.append(_unpack(r["c"], np.int32))
        got.clear()
        if keys:
            every, k = np.concatenate(keys), np.concatenate(counts)
            keys.clear(), counts.clear()
            ascending = np.argsort(every, kind="stable")
            every, k = every[ascending], k[ascending]
            del ascending
            first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
            k = np.add.reduceat(k, first, dtype=np.int64)
            word, beside = np.divmod(every[first].astype(np.int64), 2 * kinds)
            del every
            cls = exchange_all(word, beside, k, cls[order], n[order], table, shards)[rank]
        yield from _tell(shard, words, n, blocks, places, cls, clustered, 1 - half)

    return fn


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, n_words: int, classes: int, sweeps: int) -> np.ndarray:
    """Class of every symbol. The first ``n_words`` symbols move between ``classes`` classes;
    each other symbol keeps a class of its own, after those.

    Words are visited from the most frequent on; each is taken out of its class and put
    where the likelihood of the class bigrams is greatest (the smallest class of ties).
    """
    pairs = pairs.astype(float)
    size = len(pairs)
    kinds = classes + size - n_words
    order = np.argsort(-pairs[:n_words].sum(1), kind="stable")
    cls = np.concatenate([np.zeros(n_words, np.int64), np.arange(classes, kinds)])
    cls[order] = np.arange(n_words) % classes
    member = np.zeros((size, kinds))
    member[np.arange(size), cls] = 1
    right, left = pairs @ member, pairs.T @ member     # by symbol and class of the neighbour
    table = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a, own = cls[w], pairs[w, w]
            r, l = right[w].copy(), left[w].copy()  # noqa: E741
            r[a] -= own
            l[a] -= own
            table[a] -= r
            table[:, a] -= l
            table[a, a] -= own
            base = _xlogx(table)
            gain = (_xlogx(table[:classes] + r) - base[:classes]).sum(1) + (_xlogx(table[:, :classes] + l[:, None]) - base[:, :classes]).sum(0)
            d = np.diagonal(table)[:classes]
            rb, lb, db = r[:classes], l[:classes], np.diagonal(base)[:classes]
            gain += _xlogx(d + rb + lb + own) - db - (_xlogx(d + rb) - db) - (_xlogx(d + lb) - db)
            out, into = table[:classes].sum(1), table[:, :classes].sum(0)
            # wherever the word goes, its neighbours' totals are back; its own class gets its counts besides
            gain -= _xlogx(out + lb + r.sum() + own) - _xlogx(out + lb) + _xlogx(into + rb + l.sum() + own) - _xlogx(into + rb)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += l
            table[b, b] += own
            if b != a:
                moved += 1
                cls[w] = b
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            break
    return cls


@dataclass
class BrownModel:
    blocks: DataFrame           # the texts, numbered
    words: DataFrame            # the words of the shards
    state: DataFrame            # of every shard: the classes of its words
    tokens: int                 # training tokens, ends included
    ends: int                   # of them, ends
    transition: np.ndarray      # log10, by class before and class
    class_total: np.ndarray     # log10 of the emission's denominator, by class
    base_total: float           # log10 of the base model's denominator


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of class pairs, and of the words in their classes but for what no move changes."""
    return float(_xlogx(table.astype(float)).sum() - _xlogx(table.sum(0).astype(float)).sum() - _xlogx(table.sum(1).astype(float)).sum())


def train_brown(docs: DataFrame, plan: BrownPlan = BrownPlan()) -> BrownModel:
    """Learn from all rows of ``docs`` (doc_id, text) that are not held out."""
    docs = docs.withColumn("train", ~held_out(plan))
    size = docs.agg(F.sum(F.col("train").cast("long")).alias("ends"), F.sum(F.octet_length("text")).alias("bytes")).first()
    ends = size["ends"] or 0
    shards = max(1, -(-(size["bytes"] or 0) // plan.shard_bytes))
    rows = _dealt(_encode(docs, shards), shards)
    blocks, words = rows.where("of_block").drop("of_block"), rows.where("not of_block").drop("of_block")

    top = store(_meet(words, None, _top_words(plan.clustered), "word bigint, n bigint, words bigint"))
    seen = top.where("word is null").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    tokens, distinct = (seen["n"] or 0) + ends, (seen["words"] or 0) + (ends > 0)
    frequent = top.where("word is not null").orderBy(F.desc("n"), "word").limit(plan.clustered).toPandas()
    clustered = np.sort(frequent["word"].to_numpy(np.int64))

    symbols = len(clustered) + FORMS + 1
    told = _meet(words, None, _first_symbols(clustered, None))
    pairs = _table(_meet(blocks, told, _neighbours(symbols), _PAIRS, _summed(symbols)), symbols)
    cls = exchange(pairs, len(clustered), plan.classes, plan.sweeps)

    kinds, half = plan.classes + FORMS + 1, 0
    told = store(_meet(words, None, _first_symbols(clustered, cls)))
    best, state, table, steps = -np.inf, told, np.zeros((kinds, kinds), np.int64), []
    while True:
        sent = store(_meet(blocks, told.where("peer >= 0"), _neighbours(kinds)))
        pairs = _table(sent.where("key = -1").select("a", "b").mapInArrow(_summed(kinds), _PAIRS), kinds)
        steps.append(likelihood(pairs))
        if steps[-1] > best:
            best, state, table = steps[-1], told, pairs
        if len(steps) > 1 and steps[-1] < steps[-2] or len(steps) > 2 and steps[-1] - steps[-3] < plan.gain * tokens or not tokens:
            break
        told = store(_meet(words, told.where("peer = -1").unionByName(sent.where("key >= 0")), _moved(clustered, pairs, half, shards)))
        half = 1 - half
    state = state.where("peer = -1")

    into = (table.sum(0) + 1) / (table.sum() + kinds)
    transition = np.log10((table + plan.weight * into) / (table.sum(1, keepdims=True) + plan.weight))
    members = np.zeros(256, np.int64)
    for r in state.select("b").toLocalIterator():
        members += np.frombuffer(r["b"], np.int64)
    of_class = table.sum(0)
    # unseen words fall to the classes of forms
    smooth = np.arange(kinds) >= plan.classes
    class_total = np.log10(np.where(smooth, of_class + plan.add * (members[:kinds] + 1), np.maximum(of_class, 1)))
    return BrownModel(blocks, words, state, tokens, ends, transition, class_total, float(np.log10(tokens + plan.add * (distinct + 1))))


def _classes_and_counts(shard: int, own: list[dict], got: list[dict]) -> Iterator[pa.RecordBatch]:
    """For ``_meet`` of shards with their state: tell the blocks class and training count of every word."""
    _, _, n, blocks, places = _shard_words(own)
    cls = np.frombuffer(got[0]["a"], np.uint8)
    for b, at in zip(blocks, places):
        yield _batch([(b, shard, cls[at].tobytes(), n[at].tobytes(), None)])


_SCORED = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _scored(model: BrownModel, plan: BrownPlan):
    """For ``_meet`` of blocks: the scores of their texts."""
    transition, class_total, base_total, ends = model.transition, model.class_total, model.base_total, model.ends
    kinds, end_base = len(transition), float(np.log10(model.ends + plan.add)) - model.base_total

    def fn(block: int, own: list[dict], got: list[dict]) -> Iterator[pa.RecordBatch]:
        cls = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["a"], np.uint8) for r in got)]).astype(np.int64)
        n = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["b"], np.int64) for r in got)])
        seq, s, _ = _pairs_of(own, kinds, cls)
        base = np.append(np.log10(n + plan.add) - base_total, end_base)
        emission = np.append(np.log10(np.where(cls >= plan.classes, n + plan.add, np.maximum(n, 1))) - class_total[cls], 0)
        text = np.cumsum(seq[:-1] == len(cls)) - 1     # of the pair that starts here
        size = text[-1] + 1
        by_class = 10.0 ** (transition[s[:-1], s[1:]] + emission[seq[1:]])
        score = np.bincount(text, np.log10((1 - plan.base) * by_class + plan.base * 10.0 ** base[seq[1:]]), size)
        known = np.bincount(text, np.append(n > 0, ends > 0)[seq[1:]], size).astype(np.int64)
        ids = pa.array(_unpack(own[0]["b"], np.int64), mask=(_unpack(own[0]["c"], np.int8) & 2).astype(bool))
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.bincount(text, minlength=size)), pa.array(known),
                                          pa.array(np.bincount(text, base[seq[1:]], size)), pa.array(score)],
                                         names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return fn


def score_documents(docs: DataFrame, plan: BrownPlan = BrownPlan()) -> DataFrame:
    """Learn from the rows that are not held out and score every row's whole text; one row per input row.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (of them, seen in
    training), train_tokens, base_score, score, perplexity (10 ** (-score / n_tokens)).

    Null or empty text: one token, the end. A row with null doc_id is held out and scored;
    repeated rows count and return each; an empty table gives an empty result. Without
    training rows every word is unknown to both models. Extra columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train_brown(docs, plan)
    told = _meet(model.words, model.state, _classes_and_counts)
    rows = _meet(model.blocks, told, _scored(model, plan), _SCORED)
    return rows.select("doc_id", held_out(plan).alias("held_out"), "n_tokens", "n_known", F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
                       "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
