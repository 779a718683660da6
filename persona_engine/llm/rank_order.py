"""Language by rank order: a text's most frequent letter n-grams against each language's.

Words are runs of letters and combining marks, lower-cased, each between two blanks
(``_``); n-grams have 1 to 5 characters and don't cross words. A language's profile holds
its most frequent n-grams with their ranks from 0 (ties by code point), counted over all
learned texts: tasks sum up what they read before anything is shuffled, so a language that
a third of all texts are in costs no more than another.

A text's n-grams of equal count share the middle of their ranks; its profile is those of
which fewer than ``size`` n-grams are more frequent. The distance to a language is the sum
over the text's profile of how far out of place each n-gram is, ``size`` where the
language's profile lacks it. The nearest language wins (ties by code point).
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from persona_engine.llm.tables import store
from persona_engine.llm.textbytes import mix

_U = np.uint64
#: Characters whose n-grams are counted together (one longer text is a chunk of its own), and the most texts of a chunk.
CHUNK_CHARS, CHUNK_TEXTS = 1 << 18, 1 << 11
#: Distinct words that a task counts before it hands their n-grams on, and words whose n-grams are told at once.
HELD_WORDS, STEP_WORDS = 1 << 19, 1 << 15
#: Rows of profiles that travel to the tasks at once; more languages are compared block by block.
BLOCK_ROWS = 1 << 18
UNKNOWN = "und"
BLANK = ord("_")
LONGEST = 5
#: Bits of an n-gram's hash; those above it number the texts of a chunk.
HASH_BITS = 53


@dataclass(frozen=True)
class ProfileRule:
    """``size``: n-grams of a profile; ``longest`` (up to 5): characters of an n-gram."""

    size: int = 400
    longest: int = LONGEST


_kinds: list[np.ndarray] = []


def character_kinds() -> np.ndarray:
    """For each code point: 2 a letter, 1 a combining mark, 0 anything else."""
    if not _kinds:
        category = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
        _kinds.append(((category == "L") * 2 + (category == "M")).astype(np.uint8))
    return _kinds[0]


def mix_gram(h: np.ndarray, n: int) -> np.ndarray:
    return mix(h + _U(n)) >> _U(64 - HASH_BITS)


def rolled(codes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For n = 1 to ``longest``: a hash of the n characters from each place (before ``mix_gram``)."""
    x = codes.astype(np.uint64)
    h = np.zeros(len(x) + 1, np.uint64)
    for n in range(1, min(longest, len(x)) + 1):
        h = h[:-1] * _U(0x9E3779B97F4A7C15) + x[n - 1:]
        yield n, h


def gram_hash(gram: str) -> int:
    """The hash that ``place_grams`` gives an n-gram."""
    *_, (n, h) = rolled(np.array([ord(c) for c in gram], np.uint32), len(gram))
    return int(mix_gram(h, n)[0])


def place_grams(codes: np.ndarray, letter: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1 to ``longest``: places and hashes of the n-grams of words (``letter``: not a blank) that have blanks around them."""
    inner = np.zeros(0, bool)
    for n, h in rolled(codes, longest):
        if n == 1:
            good = letter
        elif n == 2:
            good = letter[:-1] | letter[1:]
        else:                                   # no blank between the first and the last character
            inner = letter[1:-1] if n == 3 else inner[:-1] & letter[n - 2:-1]
            good = inner
        at = np.flatnonzero(good)
        yield n, at, mix_gram(h[at], n)


def blanked(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts with a blank on either side and in place of all that is no letter or mark: code points, the
    text of each, and which texts have a letter."""
    lowered = [f"\n{(t or '').lower()}\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    kind = character_kinds()[codes]
    return np.where(kind > 0, codes, np.uint32(BLANK)), text, np.bincount(text[kind == 2], minlength=len(texts)) > 0


def text_grams(texts: list[str | None], longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text: text (ascending), hash and times; and which texts have a letter. At most CHUNK_TEXTS texts."""
    codes, text, has_letter = blanked(texts)
    letter = codes != BLANK
    near = letter.copy()
    near[1:] |= letter[:-1]
    near[:-1] |= letter[1:]
    codes, text, letter = codes[near], text[near].astype(np.uint64), letter[near]
    keys = [(text[at] << _U(HASH_BITS)) | h for _, at, h in place_grams(codes, letter, longest)]
    key = np.sort(np.concatenate([np.zeros(0, np.uint64), *keys]))
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    key, times = key[first], np.diff(np.append(first, len(key)))
    return (key >> _U(HASH_BITS)).astype(np.int64), key & _U((1 << HASH_BITS) - 1), times, has_letter


def words_of(texts: list[str | None]) -> list[list[str]]:
    """The words of each text."""
    codes, _, _ = blanked(texts)
    size = np.cumsum([0, *(len((t or "").lower()) + 2 for t in texts)]).tolist()
    flat = codes.astype("<u4").tobytes().decode("utf-32-le")
    return [[w for w in flat[a:b].split(chr(BLANK)) if w] for a, b in zip(size[:-1], size[1:])]


def word_grams(words: list[str], times: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of words that occur so many times: hash (ascending), the n-gram and its times."""
    blank = chr(BLANK)
    codes = np.frombuffer(f"{blank}{blank.join(words)}{blank}".encode("utf-32-le"), np.uint32)
    letter = codes != BLANK
    word = np.cumsum(~letter) - 1               # a blank counts for the word after it ...
    places, hashes, lengths = [], [], []
    for n, at, h in place_grams(codes, letter, longest):
        places.append(at)
        hashes.append(h)
        lengths.append(np.full(len(at), n))
    place, h, n = (np.concatenate(x) for x in (places, hashes, lengths))
    order = np.argsort(h)
    place, h, n = place[order], h[order], n[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), h[1:] != h[:-1]]))
    total = np.add.reduceat(times[word[place]], first) if len(first) else np.zeros(0, np.int64)
    wide = np.arange(LONGEST)
    text = codes[np.minimum(place[first, None] + wide, len(codes) - 1)]
    text[wide >= n[first, None]] = 0
    return h[first], np.ascontiguousarray(text).view(f"<U{LONGEST}").ravel(), total


def middle_ranks(text: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For n-grams by text: how many of the same text are more frequent, and the middle of the ranks of its equals."""
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0)
    begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    of = np.cumsum(np.concatenate([[True], text[1:] != text[:-1]])) - 1
    most = np.maximum.reduceat(times, begin)
    offset = np.concatenate([[0], np.cumsum(most + 1)])
    slot = offset[of] + most[of] - times        # a text's counts in falling order, one slot for each
    equal = np.bincount(slot, minlength=offset[-1])
    before = np.concatenate([[0], np.cumsum(equal)])
    more = before[slot] - before[offset[of]]
    return more, more + (equal[slot] - 1) / 2


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(texts):
        hi, total = lo + 1, len(texts[lo] or "")
        while hi < len(texts) and hi - lo < CHUNK_TEXTS and total + len(texts[hi] or "") <= CHUNK_CHARS:
            total += len(texts[hi] or "")
            hi += 1
        yield lo, hi
        lo = hi


class _LanguageSums:
    """Words of languages counted over a task's texts, then their n-grams; holds at most about HELD_WORDS words."""

    def __init__(self, longest: int):
        self.longest = longest
        self.words: dict[str, Counter] = {}

    def add(self, lang: str, words: list[str]) -> None:
        self.words.setdefault(lang, Counter()).update(words)

    def full(self) -> bool:
        return sum(map(len, self.words.values())) > HELD_WORDS

    def take(self) -> Iterator[pa.RecordBatch]:
        """lang, gram, n of what was counted; empties the counts."""
        for lang, count in self.words.items():
            held = (np.zeros(0, np.uint64), np.zeros(0, f"<U{LONGEST}"), np.zeros(0, np.int64))
            words, times = list(count), np.fromiter(count.values(), np.int64, len(count))
            for lo in range(0, len(words), STEP_WORDS):
                more = word_grams(words[lo:lo + STEP_WORDS], times[lo:lo + STEP_WORDS], self.longest)
                h, gram, n = (np.concatenate(x) for x in zip(held, more))
                order = np.argsort(h, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
                held = h[order][first], gram[order][first], np.add.reduceat(n[order], first)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held[0]), pa.string()), pa.array(held[1], pa.string()),
                                              pa.array(held[2], pa.int64())], names=["lang", "gram", "n"])
        self.words = {}


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is not learned from: crc32 of its id as text (null: empty) is divisible by ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def language_profiles(texts: DataFrame, rule: ProfileRule = ProfileRule()) -> DataFrame:
    """lang, gram, n (times it occurs), rank (from 0): the most frequent n-grams of each language.

    ``texts`` has columns text and lang; rows with a null lang or text teach nothing. An
    empty table gives no profile.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _LanguageSums(rule.longest)
        for batch in batches:
            known, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _chunks(known):
                for lang, words in zip(langs[lo:hi], words_of(known[lo:hi])):
                    sums.add(lang, words)
                if sums.full():
                    yield from sums.take()
        yield from sums.take()

    counted = (texts.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter("lang is not null and text is not null")
               .mapInArrow(run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counted.withColumn("rank", F.row_number().over(by_count) - 1).filter(F.col("rank") < rule.size)
            .select("lang", "gram", "n", F.col("rank").cast("bigint")))


class _Profiles:
    """Profiles as arrays: for each distinct n-gram, the languages that have it and their ranks."""

    def __init__(self, table: pa.Table):
        self.langs = sorted(set(table["lang"].to_pylist()))
        number = {x: k for k, x in enumerate(self.langs)}
        grams = table["gram"].to_pylist()
        h = np.array([gram_hash(g) for g in grams], np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash, begin = np.unique(h[order], return_index=True)
        self.bounds = np.append(begin, len(h))
        self.lang = np.array([number[x] for x in table["lang"].to_pylist()], np.int64)[order]
        self.rank = table["rank"].to_numpy()[order]

    def nearest(self, texts: list[str | None], rule: ProfileRule) -> list[tuple[str, float, float]]:
        """Language, score and margin of each text (see ``predict_language``)."""
        text, h, times, has_letter = text_grams(texts, rule.longest)
        more, rank = middle_ranks(text, times)
        own = np.flatnonzero(more < rule.size)
        text, rank, h = text[own], rank[own], h[own]
        worst = np.bincount(text, minlength=len(texts)).astype(float) * rule.size
        found = []
        if self.langs:
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = np.flatnonzero(self.hash[at] == h)
            n = self.bounds[at[hit] + 1] - self.bounds[at[hit]]
            of = np.repeat(hit, n)
            entry = np.repeat(self.bounds[at[hit]], n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            # what a known n-gram takes off the distance
            credit = np.maximum(0.0, rule.size - np.abs(rank[of] - self.rank[entry]))
            total = np.bincount(text[of] * len(self.langs) + self.lang[entry], credit, len(texts) * len(self.langs))
            total = total.reshape(len(texts), len(self.langs))
            best = np.argmax(total, axis=1)
            top = total[np.arange(len(texts)), best]
            rest = total.copy()
            rest[np.arange(len(texts)), best] = -1.0
            second = np.maximum(rest.max(axis=1), 0.0)
            found = list(zip(best.tolist(), top.tolist(), second.tolist()))
        out = []
        for k, letter in enumerate(has_letter.tolist()):
            if not letter or not found:
                out.append((UNKNOWN, 0.0, 0.0))
            else:
                b, t, s = found[k]
                out.append((self.langs[b], t / worst[k], s / worst[k]))
        return out


def predict_language(docs: DataFrame, profiles: DataFrame, rule: ProfileRule = ProfileRule(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nearest language of every text; one row per input row.

    Columns: doc_id, held_out (see ``held_out``), lang_pred, score (1 less the distance's
    share of the largest one possible, 0 to 1) and margin (by how much the next language's
    score is less). Extra columns of ``docs`` are not read, so their names can't clash.

    Null, empty and letterless texts, and all texts if there are no profiles: ``und`` with
    score 0. A null doc_id stays null and counts as held out; repeated rows give repeated
    rows; an empty table gives an empty result. Texts are never cut; a task holds an Arrow
    batch, the profiles of one block and a small multiple of one chunk or longest text.
    """
    spark = docs.sparkSession
    profiles = store(profiles)
    blocks = max(1, -(-profiles.count() // block_rows))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    if blocks > 1:
        rows = store(rows.withColumn("rid", F.monotonically_increasing_id()))
    else:
        rows = rows.withColumn("rid", F.lit(0).cast("bigint"))

    def compared(block: int) -> DataFrame:
        part = profiles.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block).select("lang", "gram", "rank")
        table = spark.sparkContext.broadcast(part.orderBy("lang", "rank").toArrow())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = _Profiles(table.value)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                found = [x for lo, hi in _chunks(texts) for x in known.nearest(texts[lo:hi], rule)]
                columns = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["doc_id", "rid", "lang_pred", "score", "next"])

        return rows.mapInArrow(run, "doc_id bigint, rid bigint, lang_pred string, score double, next double")

    result = compared(0)
    if blocks > 1:
        for block in range(1, blocks):
            result = result.unionByName(compared(block))
        # the best block's language; the next score is its own second or another block's best
        order = F.struct((-F.col("score")).alias("s"), (F.col("lang_pred") == UNKNOWN).alias("u"), F.col("lang_pred").alias("l"),
                         F.col("next").alias("n"), F.col("doc_id").alias("d"))
        result = result.groupBy("rid").agg(F.sort_array(F.collect_list(order)).alias("x")).select(   # one entry a block
            F.col("x")[0]["d"].alias("doc_id"), F.col("x")[0]["l"].alias("lang_pred"), (-F.col("x")[0]["s"]).alias("score"),
            F.greatest(F.col("x")[0]["n"], -F.col("x")[1]["s"]).alias("next"))
    return result.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                         (F.col("score") - F.col("next")).alias("margin"))


def rank_order_language(docs: DataFrame, rule: ProfileRule = ProfileRule()) -> DataFrame:
    """Learns profiles from text and lang of the documents that aren't held out, and predicts the language of all."""
    return predict_language(docs, language_profiles(docs.filter(~held_out(F.col("doc_id"))), rule), rule)
