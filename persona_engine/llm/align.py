"""Alignment of two tokenizers' tokens over the same bytes, by merging in lockstep.

A task encodes a chunk of texts with both tokenizers. Each side is then one flat array of
token ends over the chunk's bytes. One state vector holds a pointer into either array for
every lane (a document, or a stretch of ``LANE_BYTES`` of a longer one, so that one long
text doesn't keep the others waiting); each step emits the link under every pointer pair
and a cut where both tokens end, moves the pointers whose token ends first, and drops the
lanes that are done.

How many documents link a pair of ids is counted over the corpus with a map-side
combine. Each document's distinct pairs lie in a Parquet table between the passes, so
texts are encoded once. Pairs linked by many documents (at most ``FREQUENT_PAIRS``) travel
to the tasks; the others, of which no one is hot, are joined by shuffle.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.llm.tables import store

#: Text bytes that are encoded and merged together (one longer text is a chunk of its own).
CHUNK_BYTES = 1 << 19
#: Bytes of a lane of the state vector.
LANE_BYTES = 1024
#: Pairs whose counts travel to the tasks: those of highest counts.
FREQUENT_PAIRS = 1 << 19

#: FIXED VALUE: the public pattern by which byte-level BPE files with ``use_regex`` split a text.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, then 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}


class ByteLevelTokenizer:
    """The byte-level BPE of a ``tokenizers`` JSON file, special tokens being plain text.

    Run by ``tiktoken``, several times as fast, with the file's vocabulary as ranks: so the
    file's merges must make its entries in the order of their ids (else ValueError).
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"] or {}
        if (spec["normalizer"], before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) != (None, "ByteLevel", True, False):
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        byte = byte_of_char()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[ch] for ch in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"][m] for m in merged]
        if ids != sorted(set(ids)) or len(ids) + 256 != len(ranks):
            raise ValueError(f"{path}: the merges don't follow the ids")
        self.size = max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of = {i: b for b, i in ranks.items()}
        self._bpe = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text."""
        return [self._bpe.encode_ordinary(" " + t) for t in texts]


class PieceTokenizer:
    """A sentencepiece model with byte fallback; it puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self._model
        self.size = m.get_piece_size()
        self.bytes_of = {i: bytes([int(m.id_to_piece(i)[3:-1], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                         for i in range(self.size)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@dataclass
class Side:
    """One tokenizer's tokens of a chunk: ids, where each ends in the chunk's bytes, tokens before each text (one more)."""

    ids: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


@dataclass
class Links:
    """Overlapping tokens in order: place in either side, whether both end there, and their text."""

    a: np.ndarray
    b: np.ndarray
    cut: np.ndarray
    text: np.ndarray


class TokenTable:
    """Lengths and decimal digits of a tokenizer's ids, as arrays."""

    def __init__(self, tokenizer: ByteLevelTokenizer | PieceTokenizer):
        self.tokenizer = tokenizer
        self.bytes_of = tokenizer.bytes_of
        self.length = np.zeros(tokenizer.size, np.int64)
        for i, b in self.bytes_of.items():
            self.length[i] = len(b)
        text = [str(i).encode() for i in range(tokenizer.size)]
        self.width = np.array([len(t) for t in text])
        w = int(self.width.max())
        self.digits = np.frombuffer(b"".join(t.ljust(w) for t in text), np.uint8).reshape(-1, w)

    def side(self, ids: list[list[int]]) -> Side:
        flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
        return Side(flat, np.cumsum(self.length[flat]), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64))


def encode_both(texts: list[str | None], a: TokenTable, b: TokenTable) -> tuple[Side, Side]:
    """Tokens of each text on both sides; none for null, empty, or texts that a tokenizer doesn't give back byte by byte."""
    known = [t or "" for t in texts]
    got = [a.tokenizer.encode(known), b.tokenizer.encode(known)]
    for k, text in enumerate(known):
        want = b" " + text.encode()
        if not text or any(b"".join(map(t.bytes_of.__getitem__, ids[k])) != want for t, ids in zip((a, b), got)):
            got[0][k], got[1][k] = [], []
    return a.side(got[0]), b.side(got[1])


def merge_lockstep(a: Side, b: Side, lane_bytes: int = LANE_BYTES) -> Links:
    """All links of a chunk. Both sides cover the same bytes text by text (tokens of no bytes don't occur)."""
    text_end = np.concatenate([[0], a.ends])[a.bounds]
    size = np.diff(text_end)
    per_text = -(-size // lane_bytes)
    text = np.repeat(np.arange(len(size)), per_text)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    low = text_end[text] + nth * lane_bytes
    high = np.minimum(low + lane_bytes, text_end[text + 1])
    # a lane holds the links whose common bytes end in (low, high]
    at_a, at_b = np.searchsorted(a.ends, low, "right"), np.searchsorted(b.ends, low, "right")
    lane = np.arange(len(low))
    steps: list[tuple[np.ndarray, ...]] = []
    while len(lane):
        end_a, end_b = a.ends[at_a], b.ends[at_b]
        end = np.minimum(end_a, end_b)
        own = end <= high
        if own.all():
            steps.append((lane, at_a, at_b, end_a == end_b))
        else:
            steps.append((lane[own], at_a[own], at_b[own], (end_a == end_b)[own]))
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        going = end < high
        if not going.all():
            lane, at_a, at_b, high = lane[going], at_a[going], at_b[going], high[going]
    if not steps:
        none = np.zeros(0, np.int64)
        return Links(none, none, np.zeros(0, bool), none)
    of, link_a, link_b, cut = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(of, kind="stable")
    return Links(link_a[order], link_b[order], cut[order], text[of[order]])


def _starts(x: np.ndarray) -> np.ndarray:
    """Whether each entry differs from the one before it."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def groups_text(a: Side, b: Side, links: Links, ta: TokenTable, tb: TokenTable) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of every text as one byte array, with offsets (one more than texts; each ends one byte late)."""
    group = np.cumsum(links.cut) - links.cut
    ga, gb = group[_starts(links.a)], group[_starts(links.b)]
    n = len(ga) + len(gb)
    place_a = np.arange(len(ga)) + np.searchsorted(gb, ga, "left")
    place_b = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")
    of, is_b = np.zeros(n, np.int64), np.zeros(n, bool)
    of[place_a], of[place_b] = ga, gb
    is_b[place_b] = True
    wide = max(ta.digits.shape[1], tb.digits.shape[1])
    out = np.zeros((n, wide + 1), np.uint8)
    width = np.zeros(n, np.int64)
    for place, side, table in ((place_a, a, ta), (place_b, b, tb)):
        out[place, :table.digits.shape[1]] = table.digits[side.ids]
        width[place] = table.width[side.ids]
    separator = np.full(n, ord(";"), np.uint8)
    same = of[1:] == of[:-1]
    separator[:-1][same] = np.where(is_b[1:] != is_b[:-1], ord("|"), ord(","))[same]
    out[np.arange(n), width] = separator
    flat = out[np.arange(wide + 1)[None, :] <= width[:, None]]
    offsets = np.concatenate([[0], np.cumsum(width + 1)])
    return flat, offsets[a.bounds + b.bounds]


_tables: dict[tuple[str, str], tuple[TokenTable, TokenTable]] = {}


def token_tables(a_file: str, b_file: str) -> tuple[TokenTable, TokenTable]:
    """Both tokenizers, loaded once in a worker."""
    key = (a_file, b_file)
    if key not in _tables:
        _tables[key] = TokenTable(ByteLevelTokenizer(a_file)), TokenTable(PieceTokenizer(b_file))
    return _tables[key]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``CHUNK_BYTES``."""
    size = [len(x) if x is not None else 0 for x in texts.cast(pa.large_binary()).to_pylist()]
    lo = 0
    while lo < len(size):
        hi, total = lo + 1, size[lo]
        while hi < len(size) and total + size[hi] <= CHUNK_BYTES:
            total += size[hi]
            hi += 1
        yield lo, hi
        lo = hi


_ALIGNED = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
_ALIGNED_DDL = ("rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                "pairs array<bigint>, times array<int>")


def align_chunk(texts: list[str | None], ta: TokenTable, tb: TokenTable) -> tuple[list, list[str]]:
    """Per text: counts, distinct pairs (a * size of B + b) with times, and the digest of its groups; and the groups' text."""
    a, b = encode_both(texts, ta, tb)
    links = merge_lockstep(a, b)
    flat, offsets = groups_text(a, b, links, ta, tb)
    data = flat.tobytes()
    groups = [data[lo:hi - 1] if hi > lo else b"" for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    n = len(texts)
    pair_count = tb.tokenizer.size * ta.tokenizer.size
    pairs = a.ids[links.a] * tb.tokenizer.size + b.ids[links.b]
    order = np.lexsort((pairs, links.text)) if n * pair_count >= 1 << 63 else np.argsort(links.text * pair_count + pairs)
    text, pairs = links.text[order], pairs[order]
    first = np.flatnonzero(_starts(text) | _starts(pairs))
    times = np.diff(np.append(first, len(pairs)))
    held = np.concatenate([[0], np.cumsum(np.bincount(text[first], minlength=n))])
    columns = [np.diff(a.bounds), np.diff(b.bounds), np.bincount(links.text[links.cut], minlength=n), np.bincount(links.text, minlength=n),
               [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
               pa.ListArray.from_arrays(pa.array(held, pa.int32()), pa.array(pairs[first], pa.int64())),
               pa.ListArray.from_arrays(pa.array(held, pa.int32()), pa.array(times, pa.int32()))]
    return columns, [g.decode() for g in groups]


def align_documents(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Tokens, groups, links and distinct linked pairs of every text: rid, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs (A id * B's size + B id, ascending) and times (links of each). One row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ta, tb = token_tables(a_file, b_file)
        for batch in batches:
            texts = batch.column(2)
            for lo, hi in _chunks(texts):
                columns, _ = align_chunk(texts.slice(lo, hi - lo).to_pylist(), ta, tb)
                keys = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type)
                                                  for x, f in zip([*keys, *columns], _ALIGNED)], schema=_ALIGNED)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _ALIGNED_DDL)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (whether no pair of the same A id has more)."""
    counts = store(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    a_id = F.floor(F.col("pair") / b_size) if b_size & (b_size - 1) else F.shiftright("pair", b_size.bit_length() - 1)
    top = counts.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))
    # one row for an A id at most: bounded by the vocabulary
    return counts.withColumn("a_id", a_id).join(F.broadcast(top), "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have that count or more."""
    sizes = {r["bits"]: r["k"] for r in
             counts.groupBy(F.floor(F.log2(F.col("n").cast("double"))).alias("bits")).agg(F.count("*").alias("k")).collect()}
    total, least = 0, 64
    for bits in sorted(sizes, reverse=True):
        total += sizes[bits]
        if total > most:
            break
        least = bits
    return 1 << min(least, 62)


def token_alignment(docs: DataFrame, a_file: str, b_file: str, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """How the tokens of two tokenizers overlap in every text; one row per input row.

    Columns: doc_id, n_a, n_b (tokens), n_groups (stretches between the places where both
    end a token), n_links (overlapping token pairs), n_best (links whose pair is linked in
    as many documents as any pair of its A id), count_sum (those document counts over all
    links), groups_sha256. Extra columns of ``docs`` are not read, so their names can't clash.

    Null and empty texts, and texts that a tokenizer changes (a U+2581, say), have zeros and
    an empty digest and count in no pair. A null doc_id stays null; repeated rows are
    documents of their own; an empty table gives an empty result. Texts are never cut; a
    task holds an Arrow batch, one chunk or longest text, and the frequent pairs.
    """
    spark = docs.sparkSession
    b_size = token_tables(a_file, b_file)[1].tokenizer.size
    aligned = store(align_documents(docs, a_file, b_file))
    counts = store(pair_counts(aligned, b_size))
    least = frequent_from(counts, frequent_pairs)
    known = counts.filter(F.col("n") >= least).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast((known["pair"].to_numpy(), known["n"].to_numpy(), np.asarray(known["best"].to_numpy(), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            column = {f.name: batch.column(k) for k, f in enumerate(batch.schema)}
            pairs, times = column["pairs"].flatten().to_numpy(), column["times"].flatten().to_numpy().astype(np.int64)
            sizes = column["pairs"].value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            at, weight = at[hit], times[hit]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            found = []
            for values in (best, n):
                total = np.zeros(len(row) + 1, np.int64)
                total[1:][hit] = values[at] * weight
                np.cumsum(total, out=total)
                found.append(pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64()))
            left = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))])
            rest = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(v[~hit], t))
                    for v, t in ((pairs, pa.int64()), (times, pa.int32()))]
            names = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(column[c] for c in names), *found, *rest], names=[*names, "n_best", "count_sum", "pairs", "times"])

    scored = store(aligned.mapInArrow(run, _ALIGNED_DDL.replace("pairs", "n_best bigint, count_sum bigint, pairs")))
    rest = scored.filter(F.size("pairs") > 0).select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rest = rest.select("rid", F.col("x.pairs").alias("pair"), F.col("x.times").cast("bigint").alias("times"))
    rare = (rest.join(counts.filter(F.col("n") < least), "pair").groupBy("rid")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more")))
    return scored.join(rare, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
