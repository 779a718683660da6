"""Toxicity scores: gradient-boosted trees over dense text features, isotonic calibration.

A bounded sample of labelled rows (``ToxicityPlan.train_rows``) is split in two by a hash
of the id: four fifths give a lexicon of words and word beginnings that stand in toxic
documents far more often than chance explains, and train the trees; the rest, which
neither has seen, fits the calibration.
The features of a text are densities of listed and learned words, listed words near the
second person, capitals, punctuation and obfuscation. Scoring is one pass over the texts
with the lexicon (bounded) in the task; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from persona_engine.llm import textbytes as tb
from persona_engine.llm.private_terms import TERM_SEPARATOR
from persona_engine.session import materialize

# FIXED VALUES: insults and second-person words
INSULTS = """
idiot idiots moron morons stupid scum trash loser losers pathetic worthless clown clowns disgusting dumb dumbass jerk
garbage filth filthy vermin imbecile cretin fool foolish ugly hate coward liar freak creep pig pigs rat rats
dummkopf trottel arschloch abschaum dreck versager ekelhaft widerlich wertlos blödmann schwein
imbécile crétin connard salaud ordure nul débile abruti minable pourri
imbécil estúpido estúpida basura idiota asqueroso inútil patético payaso perdedor escoria
""".split()
SECOND_PERSON = """
you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro
""".split()
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

#: Lengths in bytes of the word beginnings that the lexicon looks at, besides whole words.
BEGINNINGS = (4, 5, 6)
NEAR_WORDS = 3
FEATURES = ["listed", "listed_hits", "learned", "learned_max", "learned_hits", "near_you", "capitals", "shouted",
            "exclaims", "questions", "punct_runs", "obfuscated", "obfuscated_hits", "log_words"]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_HIDING = np.zeros(256, bool)
_HIDING[list(b"0134578@$!*._-")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_SPACED_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class ToxicityPlan:
    train_rows: int = 20_000     # labelled rows sampled at most (by a hash of the id)
    folds: int = 5               # rows whose crc32(doc_id) modulo this is 0 are held out
    lexicon_size: int = 4_096
    min_toxic_docs: int = 3      # toxic documents that hold a lexicon entry
    trees: int = 20
    depth: int = 3
    seed: int = 11


def held_out(plan: ToxicityPlan = ToxicityPlan()) -> Column:
    """Whether a row's label is never learned from (null id: no label can belong to it; false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % plan.folds == 0, F.lit(False))


def _hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    c = next(tb.chunks(pa.array([" ".join(words)], pa.large_string()), 1 << 30))
    a, b, _ = tb.word_spans(c)
    return np.unique(tb.span_hash(tb.prefix_hash(c.buf), a, b))


def _word_keys(c: tb.Chunk) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word and of its beginnings (0 where it is shorter), text index, start and end."""
    a, b, text = tb.word_spans(c, TERM_SEPARATOR)
    prefix = tb.prefix_hash(tb.LOWER[c.buf])
    keys = [tb.span_hash(prefix, a, b)]
    for n in BEGINNINGS:
        k = tb.mix(tb.span_hash(prefix, a, np.minimum(a + n, b)) + np.uint64(n))
        keys.append(np.where(b - a >= n, k, np.uint64(0)))
    return keys, text, a, b


@dataclass
class Lexicon:
    keys: np.ndarray      # sorted
    weights: np.ndarray
    insults: np.ndarray = field(default_factory=lambda: _hashes(INSULTS))
    second: np.ndarray = field(default_factory=lambda: _hashes(SECOND_PERSON))

    def weight(self, k: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(k))
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.weights[at], 0.0)


def _in(sorted_keys: np.ndarray, k: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, k), len(sorted_keys) - 1)
    return sorted_keys[at] == k


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def text_features(c: tb.Chunk, lex: Lexicon) -> dict[str, np.ndarray]:
    """The dense features of each text of a chunk (empty texts: all 0)."""
    keys, text, a, b = _word_keys(c)
    n, m = c.n, len(a)
    words = np.bincount(text, minlength=n).astype(float)
    per = 100.0 / np.maximum(words, 1)
    listed = _in(lex.insults, keys[0])
    weight = np.max([lex.weight(k) for k in keys], axis=0) if m else np.zeros(0)
    hit = listed | (weight > 0)
    you = np.zeros(m + 1, np.int64)
    np.cumsum(_in(lex.second, keys[0]), out=you[1:])
    first = np.searchsorted(text, np.arange(n + 1))
    i = np.flatnonzero(hit)
    near = you[np.minimum(i + NEAR_WORDS + 1, first[text[i] + 1])] > you[np.maximum(i - NEAR_WORDS, first[text[i]])]
    biggest = np.zeros(n)
    np.maximum.at(biggest, text, weight)
    upper = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(_UPPER[c.buf], out=upper[1:])
    shouted = (b - a >= 2) & (upper[b] - upper[a] == b - a)
    letters = _per_text(_LETTER[c.buf], c.offsets)
    run = np.zeros(len(c.buf), bool)
    run[1:] = _PUNCT[c.buf[1:]] & (c.buf[1:] == c.buf[:-1])
    inner = np.zeros(len(c.buf), bool)
    if len(c.buf) > 2:
        inner[1:-1] = _HIDING[c.buf[1:-1]] & _LETTER[c.buf[:-2]] & _LETTER[c.buf[2:]]
    place = np.flatnonzero(inner)
    where = np.searchsorted(c.offsets, place, side="right") - 1
    found = np.zeros(n)
    raw, known = c.buf.tobytes(), set(INSULTS)
    for t in np.unique(where):
        for w in {_around(raw, p, int(c.offsets[t]), int(c.offsets[t + 1])) for p in place[where == t].tolist()}:
            found[t] += w.translate(_PLAIN).strip("'\",;:?()[]") in known
    return {
        "listed": np.bincount(text, listed, n) * per, "listed_hits": np.log1p(np.bincount(text, listed, n)),
        "learned": np.bincount(text, weight, n) * per, "learned_max": biggest,
        "learned_hits": np.log1p(np.bincount(text, weight > 0, n)),
        "near_you": np.bincount(text[i], near, n) * per,
        "capitals": _per_text(_UPPER[c.buf], c.offsets) / np.maximum(letters, 1),
        "shouted": np.bincount(text, shouted, n) * per,
        "exclaims": _per_text(c.buf == 33, c.offsets) * per, "questions": _per_text(c.buf == 63, c.offsets) * per,
        "punct_runs": _per_text(run, c.offsets) * per,
        "obfuscated": np.bincount(where, minlength=n) * per, "obfuscated_hits": np.log1p(found),
        "log_words": np.log1p(words),
    }


def _around(raw: bytes, p: int, low: int, high: int) -> str:
    """The white-space word around a place, lower-cased (at most 40 bytes on either side: longer ones are no word)."""
    a, b = max(low, p - 40), min(high, p + 40)
    left, right = re.split(rb"[\x20\x09-\x0D]", raw[a:p])[-1], re.split(rb"[\x20\x09-\x0D]", raw[p:b])[0]
    return (left + right).decode("utf-8", "ignore").lower()


def feature_rows(docs: DataFrame, kept: Column, lex: Lexicon) -> DataFrame:
    """``kept`` (whatever the caller wants back, as one column) and the features of every row's whole text."""
    rows = docs.select(kept.alias("kept"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in tb.chunks(batch.column(1)):
                f = text_features(c, lex)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.first, c.n), *[pa.array(f[k]) for k in FEATURES]], names=["kept", *FEATURES])

    return rows.mapInArrow(run, T.StructType([rows.schema["kept"], *[T.StructField(k, T.DoubleType()) for k in FEATURES]]))


def learn_lexicon(rows: DataFrame, plan: ToxicityPlan) -> Lexicon:
    """Entries that toxic rows hold far more often (rows: text, toxic): by the log-likelihood
    ratio against independence, above what the number of entries tried explains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)
            for c in tb.chunks(batch.column(0)):
                keys, text, _, _ = _word_keys(c)
                key, doc = np.concatenate(keys), np.tile(text, len(keys))
                key, doc = key[key != 0], doc[key != 0]
                _, one = np.unique(key ^ tb.mix(doc.astype(np.uint64)), return_index=True)
                k, at = np.unique(key[one], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.view(np.int64)), pa.array(np.bincount(at, minlength=len(k))),
                     pa.array(np.bincount(at, toxic[c.first + doc[one]], len(k)).astype(np.int64))], names=["key", "n", "n_toxic"])

    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = size["n"], size["toxic"] or 0
    if not 0 < toxic < n:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    counts = (rows.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("bigint").alias("toxic"))
              .mapInArrow(run, "key bigint, n bigint, n_toxic bigint")
              .groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("t")).where(F.col("t") >= plan.min_toxic_docs))
    counts = materialize(counts)
    rate, tried = toxic / n, counts.count()
    clean = F.col("n") - F.col("t")
    ratio = 2 * (F.col("t") * F.log(F.col("t") / (F.col("n") * F.lit(rate)))
                 + F.when(clean > 0, clean * F.log(clean / (F.col("n") * F.lit(1 - rate)))).otherwise(0.0))
    odds = F.log(((F.col("t") + 0.5) / (toxic + 1)) / ((clean + 0.5) / (n - toxic + 1)))
    top = (counts.withColumns({"ratio": ratio, "odds": odds})
           .where((F.col("odds") > 0) & (F.col("ratio") > 2 * float(np.log(max(tried, 1))) + 4))
           .orderBy(F.col("ratio").desc(), "key").limit(plan.lexicon_size).select("key", "odds").collect())
    keys = np.array([r["key"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.array([r["odds"] for r in top], float)[order])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float       # score where there was nothing to learn from


def train_toxicity(docs: DataFrame, labels: DataFrame, plan: ToxicityPlan = ToxicityPlan()) -> ToxicityModel:
    """Learn from labelled rows (labels: doc_id, toxic 0/1; other values and null ids don't count;
    of repeated labels the larger). Rows held out by ``held_out`` are never learned from."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(plan))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, plan.train_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(F.lit(plan.seed), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the sample is bounded by plan.train_rows (but for the hash's spread), so it is broadcast
    sample = materialize(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                         .join(F.broadcast(known), "doc_id")
                         .withColumn("part", F.pmod(F.xxhash64(F.lit(plan.seed + 1), "doc_id"), F.lit(10))))
    lexicon = learn_lexicon(sample.where("part < 8"), plan)
    rows = feature_rows(sample, F.struct(F.col("toxic").cast("double").alias("toxic"), "part"), lexicon)
    rows = materialize(rows.select("kept.*", *FEATURES).coalesce(6))
    fit, tune = rows.where("part < 8"), rows.where("part >= 8")
    counts = rows.groupBy((F.col("part") >= 8).alias("tune"), "toxic").count().collect()
    total = sum(r["count"] for r in counts)
    rate = sum(r["count"] for r in counts if r["toxic"]) / total if total else 0.0
    if len({r["toxic"] for r in counts if not r["tune"]}) < 2:
        return ToxicityModel(lexicon, None, None, rate)
    trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=plan.trees, maxDepth=plan.depth, stepSize=0.3,
                          minInstancesPerNode=3, seed=plan.seed).fit(_vector(fit))
    calibration = None
    if len({r["toxic"] for r in counts if r["tune"]}) == 2:
        calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic").fit(_raw(trees, tune))
    return ToxicityModel(lexicon, trees, calibration, rate)


def _vector(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(_vector(rows)).withColumn("raw", vector_to_array("probability")[1]).drop("prediction")


def _scored(docs: DataFrame, kept: Column, model: ToxicityModel) -> DataFrame:
    """``kept`` and the score of every row's whole text."""
    rows = feature_rows(docs, kept, model.lexicon)
    if model.trees is None:
        score = F.lit(float(model.rate))
    else:
        rows, score = _raw(model.trees, rows), F.col("raw")
        if model.calibration is not None:
            rows, score = model.calibration.transform(rows), F.col("prediction")
    return rows.select("kept", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))


def score_toxicity(docs: DataFrame, model: ToxicityModel, plan: ToxicityPlan = ToxicityPlan()) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5) of each row's whole text; one row per input row.

    Null or empty text: the score of all features 0. A null doc_id stays null; repeated
    rows return each; an empty table gives an empty result. Extra columns are not read.
    Without toxic and other labelled rows to learn from, every score is their toxic share.
    """
    rows = _scored(docs, F.col("doc_id").cast("bigint"), model).withColumnRenamed("kept", "doc_id")
    return rows.select("doc_id", held_out(plan).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows, with all their columns, whose score is below 0.5 (any other column may have any name)."""
    rows = _scored(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), model)
    return rows.where("score < 0.5").select("kept.*")
