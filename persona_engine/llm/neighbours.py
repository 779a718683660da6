"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` hash tables cuts ``M`` Gaussian projections of a vector into cells of
width W; a bucket is a tuple of cells. A neighbour at distance r projects to a normal
distribution around the query, so each bucket near the query's has a known probability of
holding it. The query visits buckets in falling order of that probability until they
hold a neighbour with the wanted probability; candidates of all tables are merged and
ranked by their exact distance.

r and W come from a bounded sample of vectors, M from their number. Equal vectors are one
entry with its smallest ids (more can't be among the nearest), so a vector that a third of
all rows share is one entry; a bucket of very many vectors is split, and queries visit all
its parts. Buckets are dealt over shards; a shard returns each query's nearest of its own.

The estimate holds for neighbours up to r. A query whose buckets hold fewer than k others, or
whose k-th found lies well beyond r (isolated, or in a region sparser than most), is compared
with every entry instead, block by block; so is one of a length other than the most frequent.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from persona_engine.llm import textbytes as tb
from persona_engine.session import materialize

_REACH = 4   # cells on either side of the query's cell that a probe may lie


@dataclass(frozen=True)
class NeighbourPlan:
    k: int = 10
    every: int = 100            # rows whose id is divisible by this are queries
    tables: int = 4
    width: float = 2.0          # of a cell, in estimated neighbour distances
    success: float = 0.95       # estimated probability that the buckets visited hold a neighbour
    sample: int = 4_096         # vectors to estimate the neighbour distance from
    beyond: float = 1.25        # k-th distance, in estimated ones, from which a query is compared with every entry
    exact_rows: int = 4_096     # queries of a block that is compared with every entry
    bucket_rows: int = 20_000   # of a bucket's part
    shard_rows: int = 50_000    # of a shard, about
    seed: int = 5


def _cells(n_rows: int) -> int:
    """Projections of a table: buckets grow with the number of vectors."""
    return max(3, round(0.65 * math.log2(max(n_rows, 32) / 16)))


class Hasher:
    """The hash tables' projections, and their buckets as 64-bit numbers."""

    def __init__(self, dim: int, m: int, cell: float, plan: NeighbourPlan):
        rng = np.random.default_rng(plan.seed)
        self.a = rng.standard_normal((plan.tables, dim, m)) / cell
        self.b = rng.random((plan.tables, m))

    def place(self, x: np.ndarray, table: int) -> np.ndarray:
        return x @ self.a[table] + self.b[table]

    @staticmethod
    def bucket(cells: np.ndarray, table: int) -> np.ndarray:
        h = np.full(len(cells), table + 1, np.uint64)
        for j in range(cells.shape[1]):
            h = tb.mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, j].astype(np.int64).view(np.uint64))
        return h.view(np.int64)


def probe_cells(place: np.ndarray, spread: float, success: float) -> np.ndarray:
    """Cells of the buckets to visit for one query, likeliest first, until their probability reaches ``success``."""
    m = len(place)
    home = np.floor(place).astype(np.int64)
    within = place - home
    choices = []
    for f in within.tolist():
        p = [(0.5 * (math.erf((o + 1 - f) / spread / math.sqrt(2)) - math.erf((o - f) / spread / math.sqrt(2))), o) for o in range(-_REACH, _REACH + 1)]
        choices.append([(math.log(max(q, 1e-300)), o) for q, o in sorted(p, reverse=True)])
    start = (0,) * m
    heap, seen, total, out = [(-sum(c[0][0] for c in choices), start)], {start}, 0.0, []
    while heap and total < success:
        cost, at = heapq.heappop(heap)
        total += math.exp(-cost)
        out.append([choices[i][k][1] for i, k in enumerate(at)])
        for i in range(m):
            if at[i] < 2 * _REACH:
                nxt = at[:i] + (at[i] + 1,) + at[i + 1:]
                if nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (cost + choices[i][at[i]][0] - choices[i][at[i] + 1][0], nxt))
    return home + np.array(out, np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _nearest(x: np.ndarray, y: np.ndarray, keep: int, bound: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x up to ``bound`` from y and their distances: the ``keep`` nearest, with ties."""
    d = np.sqrt(((x - y) ** 2).sum(1))
    if len(d) > keep:
        bound = min(bound, np.partition(d, keep - 1)[keep - 1])
    at = np.flatnonzero(d <= bound)
    return at, d[at]


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _compare(entries: DataFrame, queries: pa.Table, keep: int) -> DataFrame:
    """query, vec_id, score: the nearest of each task's entries for each of a block of queries (entry, bound, v) of their length."""
    size = pc.list_value_length(queries.column("v")).to_numpy()
    blocks = []
    for dim in np.unique(size).tolist():
        mine = queries.filter(pa.array(size == dim))
        blocks.append((dim, mine.column("entry").to_pylist(), mine.column("bound").to_pylist(), _matrix(mine.column("v"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for b in batches:
            size = pc.list_value_length(b.column("v")).to_numpy()
            for dim, query, bound, y in blocks:
                here = pa.array(np.flatnonzero(size == dim))
                if not len(here):
                    continue
                x, ids = _matrix(b.column("v").take(here)), b.column("ids").take(here)
                for i in range(len(query)):
                    old = best.get((dim, i), [])
                    at, d = _nearest(x, y[i], keep, old[-1][0] if len(old) == keep else bound[i])
                    if len(at):
                        best[dim, i] = sorted(old + [(dist, vec) for dist, a in zip(d.tolist(), at.tolist()) for vec in ids[a].as_py()])[:keep]
        name = {(dim, i): q for dim, query, _, _ in blocks for i, q in enumerate(query)}
        out = [(name[key], vec, dist) for key, near in best.items() for dist, vec in near]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                                         names=["query", "vec_id", "score"])

    return entries.mapInArrow(run, "query bigint, vec_id bigint, score double")


def nearest_neighbours(vectors: DataFrame, plan: NeighbourPlan = NeighbourPlan(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's nearest found.

    Queries are the usable rows whose id is divisible by ``plan.every``; candidates every
    usable row of the query's length but those with the query's id. Nearest first, ties to
    the smaller id; all candidates where there are fewer than ``plan.k``.

    Rows with a null id, or a vector that is null, zero or holds a null or non-finite
    component, take no part. Repeated rows (same id,
    same vector) count once. An empty table gives an empty result. Extra columns are not read.
    """
    p = plan
    spark = vectors.sparkSession
    v = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))   # -0.0 is 0.0
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    if lengths is None:
        return empty
    dim, n_rows = lengths["dim"], lengths["n"]
    rows = rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(p.seed), "v")})
    # equal vectors: one entry with its k + 1 smallest ids, kept by a limit inside each task first
    order = F.dense_rank().over(Window.partitionBy("k1", "k2").orderBy("id"))
    few = rows.withColumn("at", order).where(F.col("at") <= p.k + 1)
    every_entry = materialize(few.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.first("v").alias("v"))
                              .withColumn("entry", F.element_at("ids", 1)))
    asked = materialize(rows.where(F.col("id") % p.every == 0).select("id", "k1", "k2").distinct()
                        .join(every_entry.select("k1", "k2", "entry", F.size("v").alias("dim")), ["k1", "k2"]).select("id", "k1", "k2", "entry", "dim"))
    entries = every_entry.where(F.size("v") == dim)

    # a bounded sample gives the distance to look for
    sample = entries.orderBy(F.xxhash64(F.lit(p.seed + 1), "entry"), "entry").limit(p.sample).select("v").toArrow()
    x = _matrix(sample.column(0))
    near = [np.partition(np.sqrt(((x - q) ** 2).sum(1)), min(p.k, len(x) - 1))[min(p.k, len(x) - 1)] for q in x[:128]]
    r = max(float(np.quantile(near, 0.9)), 1e-9)
    m = _cells(n_rows)
    hasher = Hasher(dim, m, p.width * r, p)
    per_table = 1 - (1 - p.success) ** (1 / p.tables)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                for t in range(p.tables):
                    bucket = hasher.bucket(np.floor(hasher.place(x, t)), t)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), b.column("entry"), b.column("ids"), b.column("v")], names=["bucket", "entry", "ids", "v"])

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                for i, entry in enumerate(b.column("entry").to_pylist()):
                    found = [hasher.bucket(probe_cells(hasher.place(x[i], t), 1 / p.width, per_table), t) for t in range(p.tables)]
                    bucket = np.concatenate(found)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), entry)), pa.array(bucket)], names=["query", "bucket"])

    table = entries.select("entry", "ids", "v").mapInArrow(hashed, "bucket bigint, entry bigint, ids array<bigint>, v array<double>")
    hot = materialize(table.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > p.bucket_rows)
                      .select("bucket", F.ceil(F.col("n") / p.bucket_rows).cast("int").alias("parts")))
    asking = entries.join(asked.where(F.col("dim") == dim).select("entry").distinct(), "entry").select("entry", "v")
    probes = materialize(asking.mapInArrow(probed, "query bigint, bucket bigint"))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows * p.tables / p.shard_rows))
    split = not hot.isEmpty()
    part = F.pmod(F.xxhash64("entry"), F.coalesce("parts", F.lit(1))).cast("int") if split else F.lit(0)
    shard = F.pmod(F.xxhash64("bucket", "part"), F.lit(shards)).cast("int")
    if split:
        table, probes = table.join(hot, "bucket", "left"), probes.join(hot, "bucket", "left")
    table = table.withColumn("part", part).select(shard.alias("shard"), "bucket", "entry", "ids", "v")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)) if split else F.lit(0)
    visits = (probes.withColumn("part", parts).groupBy(shard.alias("shard"), "query").agg(F.collect_set("bucket").alias("buckets"))
              .join(asking.withColumnRenamed("entry", "query"), "query").select("shard", "query", "buckets", "v"))
    keep = p.k + 1

    def rank(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            bucket = np.asarray(rows.column("bucket").combine_chunks())
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            entry = np.asarray(rows.column("entry").combine_chunks())[order]
            x = _matrix(rows.column("v"))[order]
            ids = rows.column("ids").take(pa.array(order)).to_pylist()
            y = _matrix(queries.column("v"))
            for i, (query, wanted) in enumerate(zip(queries.column("query").to_pylist(), queries.column("buckets").to_pylist())):
                wanted = np.sort(np.array(wanted))
                lo, hi = np.searchsorted(bucket, wanted, side="left"), np.searchsorted(bucket, wanted, side="right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi) if b > a] or [np.zeros(0, np.int64)])
                if not len(at):
                    continue
                _, one = np.unique(entry[at], return_index=True)   # tables may meet in a shard
                at = at[one]
                near, d = _nearest(x[at], y[i], keep)
                at = at[near]
                best = sorted((dist, vec) for dist, a in zip(d.tolist(), at.tolist()) for vec in ids[a])[:keep]
                out += [(query, vec, dist) for dist, vec in best]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return (asked.select(F.col("id").alias("query_id"), F.col("entry").alias("query")).distinct()
                .join(found.groupBy("query", "vec_id").agg(F.min("score").alias("score")), "query").where("vec_id <> query_id")
                .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k).select("query_id", "query", "rank", "vec_id", "score"))

    found = materialize(ranked(table.groupBy("shard").cogroup(visits.groupBy("shard")).applyInArrow(rank, "query bigint, vec_id bigint, score double")))
    reach = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("far"))
    lost = (F.coalesce("n", F.lit(0)) < p.k) | (F.col("far") > p.beyond * r) | (F.col("dim") != dim)
    bound = F.when((F.coalesce("n", F.lit(0)) < p.k) | (F.col("dim") != dim), float("inf")).otherwise(F.col("far") * (1 + 1e-9))
    lone = materialize(asked.join(reach, asked["id"] == reach["query_id"], "left").where(lost).groupBy("entry").agg(F.max(bound).alias("bound"))
                       .join(every_entry.select("entry", "v"), "entry"))
    blocks = math.ceil(lone.count() / p.exact_rows)
    passes = []
    for i in range(blocks):
        block = lone.where(F.pmod(F.xxhash64("entry"), F.lit(blocks)) == i).toArrow()
        passes.append(_compare(every_entry.select("ids", "v"), block, keep))
        if blocks > 1:
            passes[-1] = materialize(passes[-1])
    columns = ["query_id", "rank", "vec_id", "score"]
    if not passes:
        return found.select(columns)
    exact = ranked(reduce(DataFrame.unionAll, passes)).join(lone.select(F.col("entry").alias("query")).distinct(), "query", "left_semi")
    return found.join(lone.select(F.col("entry").alias("query")), "query", "left_anti").select(columns).unionAll(exact.select(columns))
