"""N-gram Jaccard join with prefix filters under several global token orders.

A document is its set of distinct word shingles. Equal sets are one class. Two sets are
similar enough only if, under any fixed order of all tokens, they share a token among
their first ``n - ceil(t * n) + 1``: so candidates must share prefix tokens under each of
three orders (by document frequency, then by the token or by one of two hashes within a
band of frequencies), and only those are verified.

Tokens that a single document holds come first in every order. So a first pass finds, for
each document, how many of its tokens any other document holds: documents where that is
less than t of the set have no partner, and only the rest is kept and ordered. That pass
ships packed, sorted token hashes of blocks of texts to the token's bucket (a token held
by several texts of a block is sent once for the block), and gets back places, not pairs.

Pairs are not enumerated within a token's group. Tokens with the same members are one
group. First every document is verified against one hub of its groups, and what links
gets the hub's label; groups of one label are done. In the groups left, only documents of
different labels are compared: in small groups as pairs, in large ones block by block in
numpy (the documents outside a group's main label against all of it), where each block
returns only links that connect something new.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from persona_engine.llm import textbytes as tb
from persona_engine.llm.components import connected_components
from persona_engine.llm.tables import broadcast_if_small
from persona_engine.session import materialize

#: Tokens and texts of a block, at most (memory of a task in the first pass).
BLOCK_TOKENS = 1_000_000
BLOCK_TEXTS = 60_000
#: Bytes of text whose tokens share a bucket, about (a bucket's tokens are in one task's memory, at some 2 bytes a byte of text).
BUCKET_BYTES = 16 << 20
#: Rows up to which a table of document ids is broadcast; beyond, it is joined by shuffle.
BROADCAST_IDS = 500_000
#: Groups up to this many members are compared as pairs of rows; larger ones in blocks.
PAIR_MEMBERS = 32
#: Documents on either side of a block.
BLOCK_MEMBERS = 1_024
_ID = 6   # bytes of a token hash that the first pass ships


@dataclass(frozen=True)
class JaccardPlan:
    words: int = 5
    percent: int = 75   # 100 * intersection >= percent * union


def shingle_sets(c: tb.Chunk, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Text index and token hash of every distinct shingle, by text, then hash (as unsigned)."""
    h, text, _, _ = tb.word_hashes(c)
    win = tb.window_hash(h, words)
    inside = np.flatnonzero(text[:len(win)] == text[words - 1:]) if len(win) else np.zeros(0, np.int64)
    tokens, owner = [win[inside]], [text[inside]]
    count = np.bincount(text, minlength=c.n)
    first = np.searchsorted(text, np.arange(c.n))
    for w in range(1, words):   # fewer words: the whole sequence is one token
        short = np.flatnonzero(count == w)
        if len(short):
            tokens.append(tb.mix(tb.window_hash(h, w)[first[short]] + np.uint64(w)))
            owner.append(short)
    token, text = np.concatenate(tokens), np.concatenate(owner)
    order = np.lexsort((token, text))
    token, text = token[order], text[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
    return text[new], token[new]


def _digests(text: np.ndarray, token: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size and two 64-bit sums over the set, of each text."""
    at = np.searchsorted(text, np.arange(n + 1))
    sums = []
    for salt in (0x51ED270B, 0xA0761D65):
        total = np.zeros(len(token) + 1, np.uint64)
        np.cumsum(tb.mix(token + np.uint64(salt)), out=total[1:])
        sums.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return np.diff(at), sums[0], sums[1]


def _planes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize)[:, :width].T).tobytes()


def _unplanes(b: bytes, width: int, kind) -> np.ndarray:
    n = len(b) // width
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(kind)


_PACKED = "bucket int, block bigint, tokens binary, places binary, documents binary"
_DOC = np.dtype([("doc_id", "<i8"), ("known", "?"), ("n", "<i8"), ("d1", "<i8"), ("d2", "<i8"), ("shared", "<i8")])
#: Place of a token that several texts of its block hold: they have counted it already.
_MANY = np.uint16(0xFFFF)


def _pack_blocks(docs: DataFrame, plan: JaccardPlan, buckets: int) -> DataFrame:
    """Blocks of texts as packed rows: (token hashes, places in the block) by bucket, and the block's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        n_tokens = n_texts = 0

        def out() -> Iterator[pa.RecordBatch]:
            starts = np.cumsum([0, *[len(x[0]) for x in held]])
            info = np.concatenate([x[0] for x in held])
            place = np.concatenate([x[1] + s for x, s in zip(held, starts)])
            token = np.concatenate([x[2] for x in held])
            order = np.argsort(token, kind="stable")
            token, place = token[order], place[order]
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(token)))
            many = np.repeat(size > 1, size)
            info["shared"] = np.bincount(place[many], minlength=len(info))
            place = place.astype(np.uint16)
            place[many] = _MANY
            token, place = token[begin], place[begin]
            # buckets are ranges of the token's top bits
            cut = np.searchsorted(token, (np.arange(buckets + 1, dtype=object) * (1 << 8 * _ID) // buckets).astype(np.uint64))
            rows = [{"bucket": k, "block": block, "tokens": _planes(token[a:b], _ID), "places": _planes(place[a:b], 2), "documents": None}
                    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
            rows.append({"bucket": int(block * 2654435761 >> 7) % buckets, "block": block, "tokens": None, "places": None, "documents": info.tobytes()})
            for lo in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[lo:lo + 256], schema=_PACKED_ARROW)

        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            ids = np.asarray(ids.fill_null(0))
            for c in tb.chunks(batch.column(1)):
                if held and (n_tokens > BLOCK_TOKENS or n_texts + c.n > BLOCK_TEXTS):
                    yield from out()
                    held, n_tokens, n_texts, block = [], 0, 0, block + 1
                text, token = shingle_sets(c, plan.words)
                info = np.zeros(c.n, _DOC)
                info["doc_id"], info["known"] = ids[c.first:c.first + c.n], known[c.first:c.first + c.n]
                info["n"], info["d1"], info["d2"] = _digests(text, token, c.n)
                held.append((info, text, token >> np.uint64(64 - 8 * _ID)))
                n_tokens, n_texts = n_tokens + len(token), n_texts + c.n
        if held:
            yield from out()

    return docs.select("doc_id", "text").mapInArrow(run, _PACKED)


_PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("tokens", pa.binary()), ("places", pa.binary()), ("documents", pa.binary())])


def _shared_places(group: pa.Table) -> pa.Table:
    """Of a bucket: the places of tokens that other texts hold too, for each block; documents pass through."""
    rows = group.to_pylist()
    packed = [r for r in rows if r["tokens"]]
    out = [{"block": r["block"], "places": None, "documents": r["documents"]} for r in rows if r["documents"] is not None]
    if packed:
        place = [_unplanes(r["places"], 2, np.uint16) for r in packed]
        token = np.concatenate([_unplanes(r["tokens"], _ID, np.uint64) for r in packed])
        order = np.argsort(token, kind="stable")
        token = token[order]
        twice = np.zeros(len(token), bool)
        twice[1:] = token[1:] == token[:-1]
        twice[:-1] |= twice[1:]
        shared = np.zeros(len(token), bool)
        shared[order] = twice
        at = 0
        for r, p in zip(packed, place):
            hit = p[shared[at:at + len(p)] & (p != _MANY)]
            at += len(p)
            if len(hit):
                out.append({"block": r["block"], "places": hit.tobytes(), "documents": None})
    return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("places", pa.binary()), ("documents", pa.binary())]))


def _block_documents(group: pa.Table) -> pa.Table:
    """A block's documents with the number of their tokens that other texts hold."""
    rows = group.to_pylist()
    info = np.frombuffer(next(r["documents"] for r in rows if r["documents"] is not None), _DOC).copy()
    for r in rows:
        if r["places"]:
            info["shared"] += np.bincount(np.frombuffer(r["places"], np.uint16), minlength=len(info))
    return pa.table({"doc_id": pa.array(info["doc_id"], mask=~info["known"]), "n": info["n"], "d1": info["d1"], "d2": info["d2"], "shared": info["shared"]})


def set_sizes(docs: DataFrame, plan: JaccardPlan) -> DataFrame:
    """doc_id, n (set size), d1, d2 (digest of the set) and shared (tokens that other texts hold too; some more by
    chance of the shortened hash) of every row."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    places = (_pack_blocks(docs, plan, buckets).groupBy("bucket")
              .applyInArrow(_shared_places, "block bigint, places binary, documents binary"))
    return places.groupBy("block").applyInArrow(_block_documents, "doc_id bigint, n bigint, d1 bigint, d2 bigint, shared bigint")


def _least_overlap(n: Column, percent: int) -> Column:
    """ceil(percent / 100 * n)."""
    return F.floor((F.lit(percent) * n + 99) / 100)


def _live_sets(docs: DataFrame, live: DataFrame, plan: JaccardPlan) -> DataFrame:
    """cid (d1), n and the tokens of the live classes (live: doc_id, d1, d2, one row per class; a row that
    repeats its doc_id and text gives its class again)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want1, want2 = (np.asarray(batch.column(k)) for k in (1, 2))
            for c in tb.chunks(batch.column(0)):
                text, token = shingle_sets(c, plan.words)
                n, d1, d2 = _digests(text, token, c.n)
                right = (d1 == want1[c.first:c.first + c.n]) & (d2 == want2[c.first:c.first + c.n])
                keep = right[text]
                ends = np.concatenate([[0], np.cumsum(n[right])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d1[right]), pa.array(n[right]), pa.ListArray.from_arrays(ends, pa.array(token[keep].view(np.int64)))],
                    names=["cid", "n", "tokens"])

    return (docs.join(broadcast_if_small(live, BROADCAST_IDS), "doc_id").select("text", "d1", "d2")
            .mapInArrow(run, "cid bigint, n bigint, tokens array<bigint>"))


def _prefixes(sets: DataFrame, plan: JaccardPlan) -> DataFrame:
    """cid, n, its tokens that other classes hold, and of these the prefix under each order (p1, p2, p3), of
    sets that can have a partner.

    A token's frequency is counted over the live classes. A token of one class comes first in
    every order and is in no other set, so it only shortens the rest of the prefix.
    """
    tokens = sets.select("cid", "n", F.explode("tokens").alias("token"))
    often = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    # a class's own tokens: bounded by its text
    held = tokens.join(often, "token").groupBy("cid").agg(F.first("n").alias("n"), F.collect_set(F.struct("df", "token")).alias("held"))
    length = (F.size("held") - _least_overlap(F.col("n"), plan.percent) + 1).cast("int")
    df = held.withColumn("length", length).where("length > 0")
    band = lambda x: F.floor(F.log2(x["df"].cast("double")))
    orders = {
        "p1": lambda x: F.struct(x["df"].alias("a"), F.lit(0).cast("long").alias("b"), x["token"].alias("token")),
        "p2": lambda x: F.struct(band(x).alias("a"), F.xxhash64(F.lit(2), x["token"]).alias("b"), x["token"].alias("token")),
        "p3": lambda x: F.struct(band(x).alias("a"), F.xxhash64(F.lit(3), x["token"]).alias("b"), x["token"].alias("token")),
    }
    return df.select("cid", "n", F.col("held.token").alias("tokens"), *[
        F.slice(F.array_sort(F.transform("held", f)), F.lit(1), F.col("length"))["token"].alias(k) for k, f in orders.items()])


def _of(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The index rows of the named classes (ids: cid, not null)."""
    return index.join(broadcast_if_small(ids.distinct(), BROADCAST_IDS), "cid", "left_semi")


def _verify(pairs: DataFrame, index: DataFrame, plan: JaccardPlan) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; first the other orders' prefixes must meet."""
    pairs = materialize(pairs)
    left, right = (_of(index, pairs.select(F.col(k).alias("cid"))).select(
        F.col("cid").alias(k), F.col("n").alias(f"n{k}"), F.col("tokens").alias(f"t{k}"), F.col("p2").alias(f"{k}2"), F.col("p3").alias(f"{k}3"))
        for k in ("a", "b"))
    met = pairs.join(left, "a").join(right, "b").where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3"))
    both = F.size(F.array_intersect("ta", "tb"))
    return met.where(100 * both >= plan.percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common tokens of each set on the left with each on the right (sets of distinct numbers)."""
    out = np.zeros((len(left), len(right)), np.float32)
    sides = [(np.concatenate(x) if x else np.zeros(0, np.int64), np.repeat(np.arange(len(x)), [len(v) for v in x])) for x in (left, right)]
    both = np.intersect1d(sides[0][0], sides[1][0])
    places = []
    for token, row in sides:
        at = np.searchsorted(both, token)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == token[hit]
        order = np.argsort(at[hit], kind="stable")
        places.append((at[hit][order], row[hit][order]))
    for lo in range(0, len(both), 4096):   # dense columns, some at a time
        width = min(4096, len(both) - lo)
        dense = []
        for (at, row), n in zip(places, out.shape):
            i, j = np.searchsorted(at, [lo, lo + width])
            m = np.zeros((n, width), np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _block_links(group: pa.Table, percent: int) -> pa.Table:
    """Links between a block's documents outside the main label and its documents of other labels, those only
    that connect something the block's labels and earlier links don't."""
    rest = np.asarray(group.column("rest").combine_chunks())
    cid, label, n = (np.asarray(group.column(k).combine_chunks()) for k in ("cid", "label", "n"))
    sets = {k: group.column(k).to_pylist() for k in ("tokens", "p2", "p3")}
    a, b = np.flatnonzero(rest), np.flatnonzero(~rest)
    side = lambda k, at: [np.array(sets[k][i], np.int64) for i in at]
    small, large = np.minimum.outer(n[a], n[b]), np.maximum.outer(n[a], n[b])
    may = (label[a][:, None] != label[b][None, :]) & (100 * small >= percent * large)
    for k in ("p2", "p3"):
        may &= _shared(side(k, a), side(k, b)) > 0
    both = _shared(side("tokens", a), side("tokens", b)) if may.any() else np.zeros(may.shape, np.int64)
    hit = may & (100 * both >= percent * (n[a][:, None] + n[b][None, :] - both))
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out: list[tuple] = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(hit))):
        x, y = root(int(label[a[i]])), root(int(label[b[j]]))
        if x != y:
            parent[x] = y
            out.append((int(cid[a[i]]), int(cid[b[j]])))
    left, right = zip(*out) if out else ((), ())
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _large_groups(rest: DataFrame, index: DataFrame, plan: JaccardPlan) -> DataFrame:
    """Links across labels in groups of many members (rest: token, m, cid, label)."""
    main = rest.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
        F.max(F.struct("k", "label"))["label"].alias("main"), F.sum("k").alias("m"), F.max("k").alias("most"))
    rows = rest.select("token", "cid", "label").join(main, "token").withColumns({
        "n_rest": F.ceil((F.col("m") - F.col("most")) / BLOCK_MEMBERS).cast("int"), "n_all": F.ceil(F.col("m") / BLOCK_MEMBERS).cast("int")})
    block = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    sides = [rows.select("token", "cid", "label", F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1)).alias("i"), block("n_all").alias("j"), F.lit(False).alias("rest")),
             rows.where("label <> main").select("token", "cid", "label", block("n_rest").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("j"), F.lit(True).alias("rest"))]
    whole = sides[0].union(sides[1]).join(_of(index, rest.select("cid")).select("cid", "n", "tokens", "p2", "p3"), "cid")
    return whole.groupBy("token", "i", "j").applyInArrow(lambda g: _block_links(g, plan.percent), "a bigint, b bigint").distinct()


def link_classes(index: DataFrame, plan: JaccardPlan) -> DataFrame:
    """node, component of the classes that link with another."""
    posts = index.select("cid", "n", F.explode("p1").alias("token"))
    # tokens with the same members are one group, named by one of them
    members = posts.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("y"))
    named = members.where("m > 1").groupBy("m", "x", "y").agg(F.min("token").alias("token")).select("token", "m")
    posts = materialize(posts.join(named, "token").select("token", "m", "cid", "n"))
    close = 100 * F.least("na", "nb") >= plan.percent * F.greatest("na", "nb")
    # every class against one hub: of its groups' members of smallest hash, the smallest that is near in size
    hubs = posts.groupBy("token").agg(F.min(F.struct(F.xxhash64("cid").alias("h"), F.col("cid").alias("b"), F.col("n").alias("nb"))).alias("hub"))
    pairs = (posts.withColumnRenamed("n", "na").join(hubs, "token").select(F.col("cid").alias("a"), "na", "hub.*").where("a <> b").where(close)
             .groupBy("a").agg(F.min(F.struct("h", "b"))["b"].alias("b")))
    links = materialize(_verify(pairs, index, plan))
    up = links.select(F.col("a").alias("b"), F.col("b").alias("c"))
    labels = links.join(up, "b", "left").select("a", F.coalesce("c", "b").alias("b")).join(up, "b", "left").select(
        F.col("a").alias("cid"), F.coalesce("c", "b").alias("label"))
    now = posts.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    mixed = now.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("token")
    rest = materialize(now.join(mixed, "token").select("token", "m", "cid", "n", "label"))
    few = rest.where(F.col("m") <= PAIR_MEMBERS)
    other = few.select("token", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("label").alias("label_b"))
    pairs = (few.select("token", F.col("cid").alias("a"), F.col("n").alias("na"), "label").join(other, "token")
             .where("label < label_b").where(close).select("a", "b").distinct())
    many = rest.where(F.col("m") > PAIR_MEMBERS)
    more = [links, materialize(_verify(pairs, index, plan))]
    if not many.isEmpty():
        more.append(materialize(_large_groups(many, index, plan)))
    return connected_components(reduce(DataFrame.union, more)).select("node", "component")


def jaccard_components(docs: DataFrame, plan: JaccardPlan = JaccardPlan()) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of each row; one row per input row.

    Words are lower-cased (A-Z) and split at white space. Null or empty text: an empty set,
    linked with nothing. Rows of equal sets link with each other, repeated rows too. A row
    with null doc_id is returned with null component_id and links with nothing. An empty
    table gives an empty result. Extra columns are not read. Texts are never cut.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    info = materialize(set_sizes(docs, plan))
    classes = materialize(info.where("doc_id is not null and n > 0").groupBy("n", "d1", "d2")
                          .agg(F.min("doc_id").alias("rep"), F.max("shared").alias("shared")))
    live = classes.where(F.col("shared") >= _least_overlap(F.col("n"), plan.percent)).select(F.col("rep").alias("doc_id"), "d1", "d2")
    index = materialize(_prefixes(materialize(_live_sets(docs, live, plan)), plan))   # tokens of one class left out
    nodes = link_classes(index, plan)
    member = classes.join(nodes, classes["d1"] == nodes["node"]).select("n", "d1", "d2", "rep", "component")
    least = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    member = member.join(least, "component").select("n", "d1", "d2", "component_id")
    found = materialize(classes.select("n", "d1", "d2", "rep").join(member, ["n", "d1", "d2"], "left")
                        .select("n", "d1", "d2", F.coalesce("component_id", "rep").alias("component_id")))
    single = info.where("doc_id is null or n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    rest = info.where("doc_id is not null and n > 0").join(found, ["n", "d1", "d2"]).select("doc_id", "n", "component_id")
    return rest.union(single).withColumnRenamed("n", "n_shingles")


def keep_one_of_each(docs: DataFrame, plan: JaccardPlan = JaccardPlan()) -> DataFrame:
    """One document of each component, with all its columns: the one of smallest doc_id.

    Rows that repeat a kept row's doc_id and text go too; rows with null doc_id stay. Texts
    are shuffled only where the ids that go are too many to broadcast, and for repeated rows.
    """
    found = materialize(jaccard_components(docs, plan).where("doc_id is not null"))
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias("_gone"))   # an id may stand for several texts
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct().join(stays, "_gone", "left_anti"))
    id_ = F.col("doc_id").cast("bigint")
    kept = docs.join(broadcast_if_small(gone, BROADCAST_IDS), id_ == F.col("_gone"), "left_anti")
    again = (docs.where(id_.isNotNull()).groupBy(id_.alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_key"))
             .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id", "_key"))
    again = materialize(again)
    if again.isEmpty():
        return kept
    same = (id_ == F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_key"))
    again = broadcast_if_small(again, BROADCAST_IDS)
    one = kept.join(again, same).dropDuplicates(["_id", "_key"]).drop("_id", "_key")
    return kept.join(again, same, "left_anti").unionByName(one)
