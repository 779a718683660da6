"""Quality rules with host verdicts.

Each document gets its rule counts from one numpy pass over the bytes of its whole text.
Rule failures are then counted by host, the failure rates are shrunk with a beta prior
fitted to all hosts by the method of moments, and each host's verdict is joined back to
its documents. A host holding a third of all rows is pre-aggregated before the shuffle;
the join back is left to adaptive execution (a small verdict table is broadcast by its
measured size, a large one is joined with skewed partitions split).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from persona_engine.llm import textbytes as tb
from persona_engine.session import materialize

WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


@dataclass(frozen=True)
class HostRules:
    """Thresholds. A document fails if a rule says so; a host fails if its shrunk failure rate is above ``max_rate``."""

    min_words: int = 20
    max_repeat_pct: int = 30      # words in repeated windows, of 100 words
    max_symbol_pct: int = 10      # symbols, of 100 characters in words
    max_dup_line_pct: int = 50    # lines that repeat an earlier one, of 100 lines with a word
    max_rate: float = 0.5


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_counts(c: tb.Chunk) -> dict[str, np.ndarray]:
    """The rule counts of each text of a chunk."""
    space = tb.SPACE[c.buf]
    prefix = tb.prefix_hash(c.buf)
    start, end, text = tb.word_spans(c)
    out = {"n_words": np.bincount(text, minlength=c.n).astype(np.int64),
           "word_chars": _sums(((c.buf & 0xC0) != 0x80) & ~space, c.offsets),
           "n_symbols": _sums(_SYMBOL[c.buf], c.offsets)}
    # lines: from a text's start or after \n, up to \n or the text's end
    feed = np.flatnonzero(c.buf == 10)
    a = np.sort(np.concatenate([c.offsets[:-1], feed + 1]))
    b = np.sort(np.concatenate([c.offsets[1:], feed]))
    words_before = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(~space, out=words_before[1:])
    has = words_before[b] > words_before[a]
    a, b = a[has], b[has]
    line_text = np.searchsorted(c.offsets, a, side="right") - 1
    out["n_lines"] = np.bincount(line_text, minlength=c.n).astype(np.int64)
    key = tb.span_hash(prefix, a, b) ^ tb.mix(line_text.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_text[first], minlength=c.n)
    # words in windows found twice or more in their text
    h = tb.span_hash(prefix, start, end)
    win = tb.window_hash(h, WINDOW)
    covered = np.zeros(len(h) + 1, np.int64)
    if len(win):
        inside = np.flatnonzero(text[:len(win)] == text[WINDOW - 1:])
        key = win[inside] ^ tb.mix(text[inside].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(inside), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = inside[twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    out["n_repeat_words"] = np.bincount(text[repeated], minlength=c.n).astype(np.int64)
    return out


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def rule_counts(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host and the rule counts of every whole text (null: no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in tb.chunks(batch.column(2)):
                counts = text_counts(c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(c.first, c.n), batch.column(1).slice(c.first, c.n),
                     *[pa.array(counts[k]) for k in _COUNTS]], names=["doc_id", "host", *_COUNTS])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id bigint, host string, " + ", ".join(f"{k} bigint" for k in _COUNTS)))


def host_verdicts(rows: DataFrame, failed: Column, max_rate: float) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate and verdict.

    The prior's mean is the hosts' mean failure rate; its weight comes from the variance
    of the rates beyond what sampling explains. Without such variance, or with one host,
    every host gets the mean of all documents.
    """
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(failed.cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("var"), F.avg(1 / F.col("n")).alias("inv_n"),
                      (F.sum("failures") / F.sum("n")).alias("all_rate"), F.count(F.lit(1)).alias("hosts")).first()
    spread = (prior["mean"] or 0.0) * (1 - (prior["mean"] or 0.0))
    beyond = (prior["var"] or 0.0) - spread * (prior["inv_n"] or 0.0)
    if beyond > 0 and spread > 0:
        weight = max(spread / beyond - 1, 0.0)
        shrunk = (F.col("failures") + F.lit(weight * prior["mean"])) / (F.col("n") + F.lit(weight))
    else:
        shrunk = F.lit(float(prior["all_rate"] or 0.0))
    return hosts.select("host", "n", "failures", shrunk.alias("host_rate"), (shrunk <= max_rate).alias("host_kept"))


def host_rules(docs: DataFrame, rules: HostRules = HostRules(), host_col: str = "source") -> DataFrame:
    """Rule counts, rule failures and verdict of each document; one row per input row.

    ``base_failed``: too few words or too many in repeated windows. ``kept``: not
    base_failed, and the host's shrunk failure rate (over base failures, symbol and
    repeated-line rules) is at most ``max_rate``.

    Null or empty text: no words, base_failed. Null host: a host of its own. A null
    doc_id stays null, repeated rows count and return each; an empty table gives an empty
    result. Extra columns are not read. Texts are never cut.
    """
    r = rules
    base = (F.col("n_words") < r.min_words) | (100 * F.col("n_repeat_words") > r.max_repeat_pct * F.col("n_words"))
    rows = materialize(rule_counts(docs, host_col).withColumn("base_failed", base))
    failed = (F.col("base_failed") | (100 * F.col("n_symbols") > r.max_symbol_pct * F.col("word_chars"))
              | (100 * F.col("n_dup_lines") > r.max_dup_line_pct * F.col("n_lines")))
    hosts = host_verdicts(rows, failed, r.max_rate).withColumnRenamed("host", "h")
    out = rows.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left")
    return out.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "host_rate", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
