"""K-Means over standardised numbers and one categorical column of any number of values.

The one-hot columns of a value v would be (1[v = own] - m) / s with the value's share m and
s² = m (1 - m). A centroid's coordinate there is (p - m) / s, p being the value's share in
its cluster. So the squared distance over all these columns is

    sum over v of p_v² / s_v²  +  (1 - 2 p_own) / s_own²

a number per cluster and one look-up per row: no column per value is ever made, the values
are not collected, and a centroid's categorical half is a table of (value, share in each
cluster). Rows look it up by a join, which travels to the tasks up to a counted size.
Results equal ``lloyd_kmeans`` over the one-hot columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import hash_order
from persona_engine.operators.lloyd import iterate, point_blocks
from persona_engine.session import materialize

#: Entries (values × centroids) of a look-up table that may travel to the tasks.
BROADCAST_SHARES = 4_000_000
#: Values up to which the shares of all centroids are a small array: rows carry their value's number (``lloyd.iterate``).
NARROW = 2_048


@dataclass
class Centroids:
    """``dense``: {(restart, cluster): vector}; ``shares``: value, w (1 / s²), p (share in each cluster, in the order of ``dense``)."""

    dense: dict
    shares: DataFrame

    @property
    def keys(self) -> list:
        return sorted(self.dense)

    def base(self) -> np.ndarray:
        """The part of the distance that depends on the cluster only."""
        n = len(self.dense)
        row = self.shares.agg(*[F.sum(F.col("p")[j] * F.col("p")[j] * F.col("w")).alias(f"b{j}") for j in range(n)]).first()
        return np.array([row[j] or 0.0 for j in range(n)])


def value_weights(df: DataFrame, category: str) -> DataFrame:
    """value, w: 1 / (m (1 - m)) of each value's share m of all rows; 0 where all rows have it (its column would be constant)."""
    n = df.count()
    m = F.col("n") / F.lit(float(max(n, 1)))
    return df.where(F.col(category).isNotNull()).groupBy(F.col(category).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
        "value", F.when(F.col("n") < n, 1.0 / (m * (1.0 - m))).otherwise(0.0).alias("w"))


def seed_rows(df: DataFrame, cols: list[str], category: str, k: int, seed: int, id_col: str, restarts: int) -> dict:
    """{(restart, cluster): (vector, value)} of the k rows of smallest md5(seed:init:restart:id) (as ``segment.seed_centroids``)."""
    out = {}
    for r in range(restarts):
        h = hash_order(seed, f"init:{r}", id_col)
        for i, x in enumerate(df.select(h.alias("_h"), *cols, category).orderBy("_h").limit(k).collect()):
            out[r, i] = ([x[c] for c in cols], x[category])
    return out


def looked_up(df: DataFrame, category: str, cents: Centroids) -> DataFrame:
    """Rows with w and p of their value (null: 0 and no shares)."""
    table = cents.shares
    if table.count() * len(cents.dense) <= BROADCAST_SHARES:
        table = F.broadcast(table)
    return df.join(table, F.col(category) == F.col("value"), "left").drop("value")


def step(df: DataFrame, cols: list[str], category: str, cents: Centroids, weights: DataFrame) -> tuple[Centroids, dict]:
    """One Lloyd step of all restarts: new centroids and {restart: cost}. A cluster without rows drops out."""
    keys, base = cents.keys, cents.base()
    dense = np.array([cents.dense[x] for x in keys], float)
    cut = [j for j in range(len(keys)) if j == 0 or keys[j][0] != keys[j - 1][0]] + [len(keys)]

    def assign(batches):
        for pdf in batches:
            x = pdf[cols].to_numpy(float)
            p = np.zeros((len(pdf), len(keys)))
            has = pdf["p"].notna().to_numpy()
            if has.any():
                p[has] = np.stack(pdf["p"].to_numpy()[has])
            w = pdf["w"].fillna(0.0).to_numpy()
            dist = np.stack([((x - c) ** 2).sum(axis=1) for c in dense], axis=1) + base + (1.0 - 2.0 * p) * w[:, None]
            for a, b in zip(cut[:-1], cut[1:]):
                j = dist[:, a:b].argmin(axis=1) + a          # ties → the smallest cluster id
                yield pd.DataFrame({"j": j, "value": pdf[category], "d": dist[np.arange(len(pdf)), j],
                                    **{f"s{i}": x[:, i] for i in range(len(cols))}})

    schema = "j int, value string, d double, " + ", ".join(f"s{i} double" for i in range(len(cols)))
    rows = looked_up(df.select(*cols, category), category, cents).mapInPandas(assign, schema)
    # one row a cluster and value: added up in the tasks first
    by_value = materialize(rows.groupBy("j", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("d"),
                                                          *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(cols))]))
    total = {r["j"]: r for r in by_value.groupBy("j").agg(F.sum("n").alias("n"), F.sum("d").alias("d"),
                                                          *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(cols))]).collect()}
    kept = sorted(total)
    size = F.array(*[F.lit(float(total[j]["n"])) for j in kept])
    place = {j: i for i, j in enumerate(kept)}
    at = F.create_map(*[F.lit(v) for j, i in place.items() for v in (j, i)])
    counts = by_value.where("value is not null").groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct(at[F.col("j")], "n"))).alias("m"))
    p = F.transform(F.sequence(F.lit(0), F.lit(len(kept) - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)) / F.element_at(size, i + 1))
    shares = materialize(counts.join(weights, "value").select("value", "w", p.alias("p")))
    dense_new = {keys[j]: [total[j][f"s{i}"] / total[j]["n"] for i in range(len(cols))] for j in kept}
    cost: dict = {}
    for j in kept:
        cost[keys[j][0]] = cost.get(keys[j][0], 0.0) + total[j]["d"]
    return Centroids(dense_new, shares), cost


def _still(old: Centroids, new: Centroids, tol: float) -> set:
    """Restarts whose centroids didn't move: neither the numbers nor any value's share."""
    same = set()
    for r in {x[0] for x in new.keys}:
        mine = [x for x in new.keys if x[0] == r]
        if mine == [x for x in old.keys if x[0] == r] and all(np.linalg.norm(np.subtract(new.dense[x], old.dense[x])) <= tol for x in mine):
            same.add(r)
    if not same:
        return same
    a, b = old.shares.select("value", F.col("p").alias("a")), new.shares.select("value", F.col("p").alias("b"), "w")
    j = a.join(b, "value", "full_outer")
    moved = [F.sum(F.pow((F.coalesce(F.col("a")[old.keys.index(x)], F.lit(0.0)) - F.coalesce(F.col("b")[i], F.lit(0.0))), F.lit(2))
                   * F.coalesce("w", F.lit(0.0))).alias(str(i)) if x[0] in same else F.lit(0.0).alias(str(i)) for i, x in enumerate(new.keys)]
    row = j.agg(*moved).first()
    return same - {x[0] for i, x in enumerate(new.keys) if (row[i] or 0.0) > tol ** 2}


def only(cents: Centroids, restarts: set) -> Centroids:
    """The centroids of some restarts."""
    kept = [i for i, x in enumerate(cents.keys) if x[0] in restarts]
    return Centroids({x: v for x, v in cents.dense.items() if x[0] in restarts},
                     cents.shares.select("value", "w", F.array(*[F.col("p")[i] for i in kept]).alias("p")))


def kmeans_with_category(df: DataFrame, cols: list[str], category: str, k: int, seed: int = 42, n_init: int = fixed.N_INIT,
                         max_iter: int = 300, id_col: str = "cust_id", tol: float = 1e-9) -> tuple[Centroids, float]:
    """Seeded Lloyd restarts to convergence over standardised ``cols`` and the (unmade) standardised one-hot columns of ``category``.

    Returns the centroids (keys (0, cluster)) and the cost of the restart of lowest cost (of
    equal costs to six digits, the first). A null value is no value: all its columns are 0
    before standardising. ``df`` is scanned by every step: the caller persists it.
    """
    weights = materialize(value_weights(df, category))
    seeds = seed_rows(df, cols, category, k, seed, id_col, n_init)
    narrow = weights.limit(NARROW + 1).collect()
    if len(narrow) <= NARROW:
        return _narrow_category(df, cols, category, seeds, sorted(narrow, key=lambda x: x["value"]), max_iter, tol)
    order = sorted(seeds)
    picked = [(seeds[x][1], i) for i, x in enumerate(order) if seeds[x][1] is not None]
    one = df.sparkSession.createDataFrame(picked, "value string, j int") if picked else df.sparkSession.createDataFrame([], "value string, j int")
    owners = one.groupBy("value").agg(F.collect_set("j").alias("js"))
    p = F.transform(F.sequence(F.lit(0), F.lit(len(order) - 1)), lambda i: F.coalesce(F.array_contains("js", i), F.lit(False)).cast("double"))
    cents = Centroids({x: seeds[x][0] for x in order}, materialize(weights.join(F.broadcast(owners), "value", "left").select("value", "w", p.alias("p"))))
    best: tuple | None = None
    for _ in range(max_iter):
        new, cost = step(df, cols, category, cents, weights)
        still = _still(cents, new, tol)
        for r in sorted(still):
            if best is None or (round(cost[r], 6), r) < (round(best[1], 6), best[2]):
                best = (only(new, {r}), cost[r], r)
        moving = {x[0] for x in new.keys} - still
        if not moving:
            break
        cents = only(new, moving) if still else new
    else:
        for r in sorted(moving):
            if best is None or (round(cost[r], 6), r) < (round(best[1], 6), best[2]):
                best = (only(new, {r}), cost[r], r)
    found = best[0]
    return Centroids({(0, x[1]): found.dense[x] for x in found.keys}, materialize(found.shares)), best[1]


def _narrow_category(df: DataFrame, cols: list[str], category: str, seeds: dict, weights: list, max_iter: int, tol: float) -> tuple[Centroids, float]:
    """``kmeans_with_category`` for at most ``NARROW`` values: all restarts step over blocks of points, a row's value being a number."""
    spark = df.sparkSession
    number = {x["value"]: i for i, x in enumerate(weights)}
    w = np.array([x["w"] for x in weights], float)
    starts = []
    for r in sorted({x[0] for x in seeds}):
        mine = [seeds[x] for x in sorted(seeds) if x[0] == r]
        at = np.zeros((len(mine), len(cols) + len(w)))
        for i, (vector, value) in enumerate(mine):
            at[i, :len(cols)] = vector
            if value is not None:
                at[i, len(cols) + number[value]] = np.sqrt(w[number[value]])
        starts.append((list(range(len(mine))), at))
    table = F.broadcast(spark.createDataFrame([(v, i) for v, i in number.items()], "value string, _number int"))
    coded = df.select(*cols, category).join(table, F.col(category) == F.col("value"), "left").select(*cols, F.coalesce("_number", F.lit(len(w))).alias("_number"))
    blocks = point_blocks(coded, [*cols, "_number"])
    try:
        found = iterate(blocks, starts, len(cols), max_iter, tol, w)
    finally:
        blocks.unpersist()
    best = min(range(len(found)), key=lambda r: (round(found[r].cost, 6), r))
    s = found[best]
    share = s.at[:, len(cols):] / np.sqrt(np.where(w > 0, w, 1.0))
    shares = spark.createDataFrame([(x["value"], float(x["w"]), share[:, i].tolist()) for i, x in enumerate(weights)], "value string, w double, p array<double>")
    return Centroids({(0, i): v[:len(cols)].tolist() for i, v in zip(s.ids, s.at)}, shares), s.cost


def assign_with_category(df: DataFrame, cols: list[str], category: str, cents: Centroids, label: str = "persona_cluster",
                         dist: str = "sq_dist") -> DataFrame:
    """Each row's nearest centroid (ties → smallest id) and the squared distance."""
    base = cents.base()
    d = looked_up(df, category, cents)
    each = [F.expr(" + ".join(f"(`{c}` - ({float(v)!r}D)) * (`{c}` - ({float(v)!r}D))" for c, v in zip(cols, cents.dense[x])) + f" + ({float(b)!r}D)")
            + F.coalesce((1.0 - 2.0 * F.col("p")[i]) * F.col("w"), F.lit(0.0)) for i, (x, b) in enumerate(zip(cents.keys, base))]
    ids = F.array(*[F.lit(x[1]).cast("long") for x in cents.keys])
    d = d.withColumn("_d", F.array(*each))
    nearest = F.element_at(ids, F.array_position("_d", F.array_min("_d")).cast("int"))
    return d.withColumns({label: nearest, dist: F.array_min("_d")}).drop("_d", "p", "w")
