"""Removal of long strings that start more than once, by suffix arrays of sharded passages.

A string of ``length`` bytes is found again wherever it starts, in any document. Which
strings to compare is told by content: of the ``anchor``-byte grams in a string, the one of
smallest hash is its anchor, so equal strings have equal anchors at equal places. Starts in
a row with the same anchor form a run; a run's passage is the bytes its strings cover.

Only runs whose anchor occurs again are kept. Equal passages are one, counted. Passages
are dealt over shards by anchor, so equal strings meet; each shard is sorted by induced
suffix sorting (``suffix_sort``), whose queues carry common-prefix values, and a start
whose neighbour in that order shares ``length`` bytes is repeated. Each start of a document
lies in one run, and in a passage only its own starts have ``length`` bytes to go, so
nothing is matched with itself. The places go back to the documents, which lose the bytes
covered.

A passage that a third of all documents hold is one row for each task before the shuffle;
the joins back are on (anchor, passage) and split where they are skewed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.llm import textbytes as tb
from persona_engine.llm.suffix_sort import suffix_array
from persona_engine.llm.tables import broadcast_if_small, store

_PLACE = np.uint64((1 << 28) - 1)
#: Repeated anchors (8 bytes each) up to this many are broadcast to the runs; beyond, the join is by shuffle.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class RepeatPlan:
    length: int = 400            # bytes of a string
    anchor: int = 64             # bytes of an anchor
    shard_bytes: int = 2 << 20   # of passages in a shard, about


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive entries."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchor_runs(c: tb.Chunk, plan: RepeatPlan) -> tuple[np.ndarray, ...]:
    """Text index, first start, number of starts, anchor hash and passage hash of every run of a chunk's texts."""
    if len(c.buf) < plan.length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    prefix = tb.prefix_hash(c.buf)
    gram = np.arange(len(c.buf) - plan.anchor + 1)
    h = tb.span_hash(prefix, gram, gram + plan.anchor)
    # the smallest hash (by its upper bits), the leftmost of equal ones; texts are far shorter than 2**28 bytes
    place = _window_least((h & ~_PLACE) | gram.astype(np.uint64), plan.length - plan.anchor + 1) & _PLACE
    size = np.diff(c.offsets)
    starts = np.maximum(size - plan.length + 1, 0)
    text = np.repeat(np.arange(c.n), starts)
    s = np.arange(len(text)) - np.repeat(np.cumsum(starts) - starts, starts) + c.offsets[:-1][text]
    at = place[s].astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(s)))
    lo, text, at = s[first], text[first], at[first]
    passage = tb.span_hash(prefix, lo, lo + n - 1 + plan.length)
    return text, lo - c.offsets[text], n, h[at].view(np.int64), passage.view(np.int64)


def _runs(docs: DataFrame, plan: RepeatPlan) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for c in tb.chunks(batch.column(2)):
                text, lo, n, anchor, passage = anchor_runs(c, plan)
                at = c.first + text
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(keys[at]), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)),
                                                  pa.array(anchor), pa.array(passage)], names=["id", "text_key", "lo", "n", "anchor", "passage"])

    return docs.select("id", "text_key", "text").mapInArrow(run, "id bigint, text_key bigint, lo int, n int, anchor bigint, passage bigint")


def _cut(docs: DataFrame, wanted: DataFrame, plan: RepeatPlan) -> DataFrame:
    """anchor, passage, many, bytes of the wanted passages (wanted: id, text_key, lo, n, anchor, passage, many).

    Rows of the same id and text give a passage more than once, which is found twice then, as ``many`` says.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, want in zip(batch.column(0), batch.column(1).to_pylist()):
                raw = text.as_buffer().to_pybytes()
                out += [(w["anchor"], w["passage"], w["many"], raw[w["lo"]:w["lo"] + w["n"] - 1 + plan.length]) for w in want]
            for lo in range(0, len(out), 2000):
                a, p, m, b = zip(*out[lo:lo + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(p, pa.int64()), pa.array(m, pa.bool_()), pa.array(b, pa.binary())],
                                                 names=["anchor", "passage", "many", "bytes"])

    by_text = wanted.groupBy("id", "text_key").agg(F.collect_list(F.struct("lo", "n", "anchor", "passage", "many")).alias("want"))
    return docs.join(by_text, ["id", "text_key"]).select("text", "want").mapInArrow(run, "anchor bigint, passage bigint, many boolean, bytes binary")


def repeated_starts(passages: list[bytes], plan: RepeatPlan) -> list[np.ndarray]:
    """For each passage, whether the string at each of its starts is found at another place of these passages."""
    t, order, lcp = suffix_array(passages, plan.length)
    hit = lcp >= plan.length
    hit[:-1] |= hit[1:]
    repeated = np.zeros(len(t), bool)
    repeated[order[hit]] = True
    begin = np.cumsum([0, *[len(p) + 1 for p in passages]])
    return [repeated[b:b + len(p) - plan.length + 1] for b, p in zip(begin.tolist(), passages)]


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _sorted_shards(passages: DataFrame, plan: RepeatPlan) -> DataFrame:
    """anchor, passage, ranges of repeated starts (first, last), from passages with their counts."""
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def run(group: pa.Table) -> pa.Table:
        raw = group.column("bytes").to_pylist()
        out = []
        for flags, many in zip(repeated_starts(raw, plan), group.column("many").to_pylist()):
            a, b = _ranges(flags | many)   # a passage found twice repeats all its strings
            out.append([{"first": x, "last": y} for x, y in zip(a.tolist(), b.tolist())])
        return pa.table({"anchor": group.column("anchor"), "passage": group.column("passage"), "ranges": pa.array(out, kind)})

    return passages.groupBy("shard").applyInArrow(run, "anchor bigint, passage bigint, ranges array<struct<first:int,last:int>>")


def _removed(docs: DataFrame, plan: RepeatPlan, keep_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, ranges in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                spans: list[list[int]] = []
                for a, b in sorted((r["first"], r["last"] + plan.length) for r in ranges or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept_bytes = b"".join([*kept, raw[at:]])
                rows.append({"doc_id": doc_id, "n_bytes": len(raw), "n_removed": len(raw) - len(kept_bytes), "n_spans": len(spans),
                             "kept_sha256": hashlib.sha256(kept_bytes).hexdigest(), **({"kept": kept_bytes} if keep_text else {})})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + ([("kept", pa.binary())] if keep_text else []))
    return docs.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep_text else ""))


def remove_repeats(docs: DataFrame, plan: RepeatPlan = RepeatPlan(), keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of each row; one row per input row.

    With ``keep_text`` also the kept bytes (``kept``). Every byte goes that a string of
    ``plan.length`` bytes covers which also starts anywhere else, in any row, in the input.

    Null or empty text: no bytes, nothing removed. A null doc_id stays null; repeated rows
    are rows of their own, so their strings repeat. An empty table gives an empty result.
    Extra columns are not read. Texts are never cut.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows of the same id and text get the same result, so these two name a text
    docs = docs.withColumns({"id": F.coalesce("doc_id", F.lit(0)), "text_key": F.xxhash64("text")})
    runs = store(_runs(docs, plan))
    often = store(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"))
    runs = store(runs.join(broadcast_if_small(often, BROADCAST_ROWS), "anchor"))
    found = store(runs.groupBy("anchor", "passage").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "text_key", "lo", "n")).alias("one")))
    wanted = found.select("anchor", "passage", (F.col("times") > 1).alias("many"), "one.*")
    size = found.agg(F.sum(F.col("one.n") + plan.length)).first()[0] or 0
    shards = max(1, -(-size // plan.shard_bytes))
    passages = _cut(docs, wanted, plan).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    hits = store(_sorted_shards(passages, plan).where(F.size("ranges") > 0))
    places = (runs.join(hits, ["anchor", "passage"])
              .select("id", "text_key", F.explode(F.transform("ranges", lambda r: F.struct(
                  (F.col("lo") + r["first"]).alias("first"), (F.col("lo") + r["last"]).alias("last")))).alias("range"))
              .groupBy("id", "text_key").agg(F.collect_set("range").alias("ranges")))
    return _removed(docs.join(places, ["id", "text_key"], "left").select("doc_id", "text", "ranges"), plan, keep_text)
