"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets are shared by weight and stop at a multiple of a source's size. Each source's
documents are spread over shards by a seeded hash; the mix is cut into equal blocks of
words, and every (source, shard) cell gets an integer quota of blocks: the cells' claims
(their share of the source's target) are apportioned by highest quotients
claim / (2 * blocks + 1). A cell's words form a ring in seeded document order, and its
blocks are laid along the ring from a seeded place. So a document is taken whole as often
as the ring is gone round, and the two documents at the ends of the last arc in part.

The quotients are not enumerated: for a divisor d the quota is claim / d rounded, so a few
aggregates bracket the divisor and only the last blocks are given by sorted quotients.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from persona_engine.operators.indexing import row_number_within, running_sum_within
from persona_engine.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to this many are broadcast; beyond, they are joined by shuffle.
BROADCAST_SOURCES = 100_000
#: Divisors tried in one pass over the cells.
_GRID = 48


@dataclass(frozen=True)
class MixPlan:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)   # by source in code-point order, repeating
    share: float = 1.5                             # of all sizes
    max_repeat: int = 2                            # targets and documents stop at this many times their size
    block_words: int = 4                           # quotas are whole blocks; only a cell's last may be cut
    shard_docs: int = 4096                         # documents of a cell, about
    seed: int = 17


def source_targets(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """One row per source: key, documents, size and target (rows: key, is_null, size).

    In order of cap / weight, the sources below the water level stop at their cap; the
    level is what remains of the total, per weight of the sources not yet stopped.
    """
    s = rows.groupBy("key", "is_null").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    # sources may be many (hosts): their order and the sums up to each are taken over range partitions
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    s = row_number_within(s, [], ["is_null", "key"], "place")
    s = s.withColumn("w", F.element_at(weights, ((F.col("place") - 1) % len(plan.weights) + 1).cast("int")))
    s = s.withColumn("cap", (plan.max_repeat * F.col("source_size")).cast("double"))
    s = s.withColumn("ratio", F.col("cap") / F.col("w"))
    whole = s.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    if not whole["w"]:
        return s.select("key", "is_null", "n_docs", "source_size", F.lit(0.0).alias("target"))
    order = ["ratio", "is_null", "key"]
    upto = running_sum_within(running_sum_within(s, [], order, "cap", "cap_upto"), [], order, "w", "w_upto")
    level = (F.lit(plan.share * whole["size"]) - F.col("cap_upto") + F.col("cap")) / (F.lit(whole["w"]) - F.col("w_upto") + F.col("w"))
    # the level before the first source that doesn't stop is final
    stays = F.when(F.col("cap") >= level * F.col("w"), F.struct(*order, level.alias("level")))
    final = upto.agg(F.min(stays)["level"].alias("level")).first()["level"]
    return s.select("key", "is_null", "n_docs", "source_size", F.least("cap", F.lit(float(final or 0.0)) * F.col("w")).alias("target")
                    if final is not None else F.col("cap").alias("target"))


def apportion(cells: DataFrame, seats: int) -> DataFrame:
    """Sainte-Laguë quotas of ``seats`` over cells (columns claim, most and id columns).

    Adds ``quota``: at most ``most`` each, their sum ``seats`` or the sum of ``most`` if
    that is less. Ties go to the smaller (key, is_null, shard).
    """
    ids = ["key", "is_null", "shard"]

    def rounded(d: float):
        return F.least(F.floor(F.col("claim") / F.lit(d) + 0.5).cast("long"), F.col("most"))

    whole = cells.agg(F.sum("claim").alias("claim"), F.sum("most").alias("most")).first()
    seats = min(seats, int(whole["most"] or 0))
    if not whole["claim"] or seats <= 0:
        return cells.withColumn("quota", F.lit(0).cast("long"))
    low, high = whole["claim"] / seats / 4, whole["claim"] / seats * 4   # more blocks at low, fewer at high
    for _ in range(4):
        grid = [low * (high / low) ** (k / (_GRID - 1)) for k in range(_GRID)]
        got = cells.agg(*[F.sum(rounded(d)) for d in grid]).first()
        above = [k for k in range(_GRID) if got[k] >= seats]
        low, high = grid[max(above, default=0)], grid[min(max(above, default=0) + 1, _GRID - 1)]
        d, given = high, got[min(max(above, default=0) + 1, _GRID - 1)]
    out = cells.withColumn("quota", rounded(d))
    while given < seats:
        nxt = (out.where("quota < most")
               .select(*ids, F.explode(F.sequence(F.lit(0), F.least(F.col("most") - F.col("quota") - 1, F.lit(3)))).alias("more"), "claim", "quota")
               .select(*ids, (F.col("claim") / (2 * (F.col("quota") + F.col("more")) + 1)).alias("quotient"))
               .orderBy(F.col("quotient").desc(), *ids).limit(int(seats - given)))
        add = materialize(nxt.groupBy(*ids).agg(F.count(F.lit(1)).alias("more")))
        got = add.agg(F.sum("more")).first()[0] or 0
        if not got:
            break
        out = materialize(out.join(add, ids, "left").withColumn("quota", F.col("quota") + F.coalesce("more", F.lit(0))).drop("more"))
        given += got
    return out


def mix_sources(docs: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """What the mix takes of each document; one row per input row.

    Columns: doc_id, source, size (words), source_size, target, taken (words, repeats
    counted), copies (times the whole document is taken) and parts (word ranges taken
    besides, ``array<struct<from_word, to_word>>``).

    Null text: size 0, nothing taken. A null source is a source of its own, last in order.
    Repeated rows count and return each. An empty table gives an empty result. Extra
    columns are not read. Reruns give the same rows.
    """
    p = plan
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = materialize(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                   size.alias("size"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
                       .withColumn("is_null", F.col("source").isNull()).withColumn("key", F.coalesce("source", F.lit(""))))
    sources = materialize(source_targets(rows, p))
    # one row per source: broadcast if there are few; a source with a third of all rows is then not moved
    few = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    placed = rows.join(few, ["key", "is_null"]).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(p.seed), "doc_id", "text_key"), F.ceil(F.col("n_docs") / p.shard_docs)))
    cells = (placed.groupBy("key", "is_null", "shard")
             .agg(F.sum("size").alias("ring"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
             .withColumn("claim", F.when(F.col("source_size") > 0, F.col("target") * F.col("ring") / F.col("source_size")).otherwise(0.0))
             .withColumn("most", F.ceil(p.max_repeat * F.col("ring") / p.block_words).cast("long")))
    cells = materialize(cells.select("key", "is_null", "shard", "ring", "claim", "most"))
    total = cells.agg(F.sum("claim")).first()[0] or 0.0
    quotas = apportion(cells, round(total / p.block_words)).select(
        "key", "is_null", "shard", "ring", F.least(F.col("quota") * p.block_words, p.max_repeat * F.col("ring")).alias("words"),
        F.when(F.col("ring") > 0, F.pmod(F.xxhash64(F.lit(p.seed + 1), "key", "is_null", "shard"), F.col("ring"))).otherwise(0).alias("begin"))
    quotas = quotas.withColumns({"copies": F.when(F.col("ring") > 0, F.floor(F.col("words") / F.col("ring"))).otherwise(0).cast("long"),
                                 "arc": F.when(F.col("ring") > 0, F.col("words") % F.col("ring")).otherwise(0)})
    order = Window.partitionBy("key", "is_null", "shard").orderBy(F.xxhash64(F.lit(p.seed + 2), "doc_id"), "doc_id", "size", "text_key")
    out = (placed.join(quotas, ["key", "is_null", "shard"])
           .withColumn("x", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")))

    def part(shift):
        a = F.greatest(F.col("begin") - shift, F.col("x")) - F.col("x")
        b = F.least(F.col("begin") + F.col("arc") - shift, F.col("x") + F.col("size")) - F.col("x")
        return F.struct(a.alias("from_word"), b.alias("to_word"))

    parts = F.filter(F.array(part(F.col("ring")), part(F.lit(0))), lambda r: r["to_word"] > r["from_word"])
    out = out.withColumn("parts", parts)
    taken = F.col("copies") * F.col("size") + F.aggregate("parts", F.lit(0).cast("long"), lambda s, r: s + r["to_word"] - r["from_word"])
    return out.select("doc_id", "source", "text_key", "size", "source_size", "target", taken.alias("taken"), "copies", "parts")


def take_mix(docs: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """The mix itself, with all columns: a row for each time a document is taken whole, and one with the
    words taken for each part; n_chars (where there is one) is counted anew for parts.

    What is taken of rows with the same doc_id, source and text is added up over them.
    """
    mix = mix_sources(docs, plan).where("taken > 0")
    name = lambda c: F.to_json(F.struct(c.cast("string").alias("v")))  # noqa: E731  null is a value of its own
    whole = F.transform(F.sequence(F.lit(1), F.col("copies").cast("int")), lambda _: F.lit(None).cast("struct<from_word:bigint,to_word:bigint>"))
    takes = F.concat(F.when(F.col("copies") > 0, whole).otherwise(F.array().cast("array<struct<from_word:bigint,to_word:bigint>>")), F.col("parts"))
    taken = (mix.select(name(F.col("doc_id")).alias("_id"), name(F.col("source")).alias("_source"), F.col("text_key").alias("_key"), takes.alias("_takes"))
             .groupBy("_id", "_source", "_key").agg(F.flatten(F.collect_list("_takes")).alias("_takes")))
    keyed = docs.withColumns({"_i": name(F.col("doc_id").cast("bigint")), "_s": name(F.col("source")), "_k": F.xxhash64(F.col("text").cast("string"))})
    keyed = keyed.dropDuplicates(["_i", "_s", "_k"])
    rows = (keyed.join(taken, (F.col("_i") == F.col("_id")) & (F.col("_s") == F.col("_source")) & (F.col("_k") == F.col("_key")))
            .withColumn("_take", F.explode("_takes")))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("_take.from_word") + 1).cast("int"), (F.col("_take.to_word") - F.col("_take.from_word")).cast("int")), "")
    text = F.when(F.col("_take").isNull(), F.col("text")).otherwise(F.regexp_replace(part, r"^[\x20\x09-\x0D]+", ""))
    columns = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("_take").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(k) for k, v in columns.items()])
