"""Scores, near duplicates, licences, quality rules, repeated strings: against plain versions."""

import collections
import hashlib
import math
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame

sys.path.insert(0, str(Path(__file__).parent))
from conftest import SF001  # noqa: E402
from helpers import LOWER, PROSE, documents, empty, lower_words, messy, messy_rows, rows_of, words  # noqa: E402

from persona_engine.llm import brown, components, host_rules, licenses, ngram_join, queries, repeats, suffix_sort  # noqa: E402

N_MESSY = len(messy_rows())


# -- Brown model ------------------------------------------------------------------------


def test_base_scores_equal_plain_version(spark):
    got = queries.op1_brown_lm(spark, SF001).toPandas().set_index("doc_id")
    tokens = {i: [*lower_words(t), None] for i, t in documents(spark, SF001).items()}
    count = collections.Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            count.update(w)
    n, v = sum(count.values()), len(count)
    assert sorted(tokens) == sorted(got.index)
    for i, w in tokens.items():
        r = got.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[k] > 0 for k in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[k] + 0.1) / (n + 0.1 * (v + 1))) for k in w))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()   # classes help on unseen texts


def test_exchange_ends_where_no_move_is_better():
    rng = np.random.default_rng(7)
    topic = np.arange(12) % 3
    pairs = rng.poisson(np.where(topic[:, None] == topic[None, :], 9.0, 1.0))
    pairs = np.block([[pairs, rng.poisson(2, (12, 2))], [rng.poisson(2, (2, 14))]])   # two symbols of fixed class

    def likelihood(cls):
        member = np.zeros((14, 5))
        member[np.arange(14), cls] = 1
        table = member.T @ pairs @ member
        return sum(brown._xlogx(x).sum() for x in (table,)) - brown._xlogx(table.sum(0)).sum() - brown._xlogx(table.sum(1)).sum()

    cls = brown.exchange(pairs, 12, 3, 50)
    best = likelihood(cls)
    assert cls[12] == 3 and cls[13] == 4
    for w in range(12):
        for c in range(3):
            other = cls.copy()
            other[w] = c
            assert likelihood(other) <= best + 1e-6
    assert all(len(set(cls[:12][topic == t])) == 1 for t in range(3))


def test_brown_odd_cases(spark):
    got = rows_of(brown.score_documents(messy(spark)))
    assert len(got) == N_MESSY
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (4, 5, 6)} == {1}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert brown.score_documents(empty(spark)).count() == 0


def test_brown_stages_run_one_python_node(spark, monkeypatch):
    plans, collect = [], DataFrame.toPandas

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(DataFrame, "toPandas", spy)
    got = brown.train_brown(messy(spark))
    monkeypatch.undo()
    # a second worker for each core would keep its memory until the job ends
    assert sum("MapInArrow" in p for p in plans) >= 3
    assert not [p for p in plans if re.search(r"MapInArrow((?!Exchange).)*MapInArrow", p, re.DOTALL)]
    tokens = sum(len(lower_words(t)) + 1 for i, t, *_ in messy_rows() if i is not None and zlib.crc32(str(i).encode()) % 10)
    assert got.tokens == tokens


def test_words_beyond_the_most_frequent_get_classes_of_their_neighbours(spark):
    rng = random.Random(5)
    after_the, after_of = ([f"{c}{k}x" for k in range(80)] for c in "ab")   # of one form, each far rarer than "the" and "of"

    def text(first, second, n=20):
        return " ".join(f"the {rng.choice(first)} of {rng.choice(second)}" for _ in range(n))

    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(400) if not zlib.crc32(str(i).encode()) % 10][:2]
    like = [(rng.choice(after_the), rng.choice(after_of)) for _ in range(20)]
    rows = [(i, text(after_the, after_of)) for i in ids] + [(held[0], " ".join(f"the {a} of {b}" for a, b in like)),
                                                            (held[1], " ".join(f"the {b} of {a}" for a, b in like))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in rows_of(brown.score_documents(docs, brown.BrownPlan(clustered=2, shard_bytes=1 << 15)))}
    assert len(got) == len(rows) and got[held[0]]["base_score"] == pytest.approx(got[held[1]]["base_score"])
    assert got[held[0]]["score"] > got[held[1]]["score"] + 10   # the same words, told apart by their neighbours alone


# -- n-gram Jaccard join ----------------------------------------------------------------


def plain_components(texts):
    sets = {}
    for i, t in texts.items():
        w = lower_words(t)
        sets[i] = frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        common = collections.Counter(j for x in s for j in holders[x])
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in s:
            holders[x].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(n, words_each=120, seed=3):
    """Variants of one text around the threshold, of another just below, and unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(5000)]
    bases = [[rng.choice(vocabulary) for _ in range(words_each)] for _ in range(2)]
    texts = {}
    for i in range(n):
        if i % 5 == 4:
            texts[i] = " ".join(rng.choice(vocabulary) for _ in range(words_each))
        else:
            w = list(bases[i % 2])
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts[i] = " ".join(w)
    return texts


def components_of(spark, texts, **plan):
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(ngram_join.jaccard_components(df, **plan))}


def test_components_equal_plain_version(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(queries.op2_ngram_jaccard(spark, SF001))}
    assert got == plain_components(documents(spark, SF001))


@pytest.mark.parametrize("pair_members,block_members", [(32, 1024), (2, 16)])
def test_large_groups_lose_no_link(spark, monkeypatch, pair_members, block_members):
    monkeypatch.setattr(ngram_join, "PAIR_MEMBERS", pair_members)
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", block_members)
    texts = near_copies(150)
    assert components_of(spark, texts) == plain_components(texts)


def test_common_tokens_of_sets():
    a = [np.array([1, 2, 3]), np.array([], int), np.array([9, 10_000])]
    b = [np.array([2, 3, 4]), np.array([10_000])]
    assert ngram_join._shared(a, b).tolist() == [[2, 0], [0, 0], [0, 1]]


def test_join_odd_cases(spark):
    got = rows_of(ngram_join.jaccard_components(messy(spark)))
    assert len(got) == N_MESSY
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert by_id[1][1] == by_id[2][1] == by_id[3][1] == 1 and by_id[None][1] is None
    assert by_id[4] == (0, 4) and by_id[6] == (0, 6) and by_id[14] == (1, -13) and by_id[7] == (1, 7)
    assert ngram_join.jaccard_components(empty(spark)).count() == 0
    kept = ngram_join.keep_one_of_each(messy(spark))
    assert kept.columns == messy(spark).columns
    assert sorted(r["doc_id"] or 0 for r in rows_of(kept)) == [-13, 0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 15]


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in rows_of(components.connected_components(links))}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


# -- licences ---------------------------------------------------------------------------


def plain_licenses(text):
    low = (text or "").translate(LOWER)
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        hit = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += hit
        labels |= {label} if hit else set()
    found = [(m.start(), m.end(), n, i, a, c) for i, (a, k, p, n, c) in enumerate(licenses.rules()) if k in low for m in re.finditer(p, low)]

    def inside(d, o):
        return o is not d and o[0] <= d[0] and o[1] >= d[1] and (o[2] > d[2] or o[2] == d[2] and (o[1] - o[0] > d[1] - d[0] or o[3] < d[3]))

    kept = [d for d in found if not any(inside(d, o) for o in found)]
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {d[4] for d in kept})), max([d[5] for d in kept] + [0.6] * bool(places), default=0.0))


LICENCE_TEXTS = [
    "SPDX-License-Identifier: Apache-2.0", "This work is licensed under the GNU General Public License, version 3.", "mit license mit license MIT LICENSE",
    "Released under the MIT License. Distributed under the terms of the BSD 3-Clause license", "see https://opensource.org/licenses/MIT",
    "licensed under CC BY-NC-SA 4.0 and the lesser general public license version 2.1", "all rights reserved. proprietary and confidential",
    "permission is hereby granted, free of charge, to any person obtaining a copy", "general public license" * 3, "nothing here", "", None,
]


def test_licenses_equal_plain_version(spark):
    texts = documents(spark, SF001) | {-k - 1: t for k, t in enumerate(LICENCE_TEXTS)} | {r[0]: r[1] for r in messy_rows()[7:]}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for r in rows_of(licenses.scan_licenses(df)):
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])
        assert got == plain_licenses(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_licenses_odd_cases_and_no_python(spark):
    assert len(licenses.rules()) > 200
    df = licenses.scan_licenses(messy(spark))
    assert df.count() == N_MESSY and licenses.scan_licenses(empty(spark)).count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


WRAPPED_AND_OTHER_NAMES = [
    "GNU General\nPublic License, version 3", "GNU  General  Public\n * License", "under the terms of the GNU Lesser General\n   Public License version 2.1",
    "licensed under the Mozilla\nPublic  License 2.0", "subject to the Eclipse\tPublic License v2.0", "GNU Free\nDocumentation License licence",
    "licensed under Creative Commons Attribution 4.0", "released under the Creative  Commons Attribution-ShareAlike 3.0 license", "the Expat license",
    "licensed under creative commons attribution-noncommercial-noderivatives 4.0", "published under creative commons attribution non commercial share alike",
    "distributed under the zero-clause BSD license", "licensed under CC Zero", "subject to the PNG Reference Library license", "all\nrights\nreserved",
    "permission is\nhereby granted, free of\ncharge, to any person obtaining a copy", "released\ninto the public\ndomain", "SIL Open\nFont License license",
    "licensed under the open  database license", "open data\ncommons attribution license license", "common\npublic license license",
    "licensed under the common development\nand distribution license", "european\nunion public licence license", "microsoft\npublic license license",
]


def test_no_match_is_lost_to_keywords(spark, monkeypatch):
    table = licenses.rules()
    assert not any(re.search(r"\s", k) for _, k, _, _, _ in table)
    texts = dict(enumerate(WRAPPED_AND_OTHER_NAMES + LICENCE_TEXTS)) | {-k: t for k, t in documents(spark, SF001).items() if k > 0}
    monkeypatch.setattr(licenses, "rules", lambda: [(a, "", p, n, c) for a, k, p, n, c in table])   # every pattern on every text
    want = {k: plain_licenses(t) for k, t in texts.items()}
    monkeypatch.undo()
    assert all(want[k][5] for k in range(len(WRAPPED_AND_OTHER_NAMES)))
    for r in rows_of(licenses.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == want[r["doc_id"]], texts[r["doc_id"]]


# -- quality rules ----------------------------------------------------------------------


def plain_counts(text):
    w, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count, covered = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7)), set()
    for k in range(len(w) - 7):
        if count[tuple(w[k:k + 8])] > 1:
            covered.update(range(k, k + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_rule_counts_equal_plain_version(spark):
    texts = documents(spark, SF001) | {r[0]: r[1] for r in messy_rows()}
    df = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id bigint, text string, source string")
    for r in rows_of(host_rules.host_rules(df)):
        want = plain_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{k}" for k in range(40)), "too short"
    rows = [(i, good if i % 10 else bad, "good") for i in range(200)] + [(1000 + i, bad if i % 10 else good, "bad") for i in range(200)]
    rows += [(3000, bad, "tiny"), (3001, good, None)] + [(4000 + 10 * h + i, good, f"host{h}") for h in range(20) for i in range(10)]
    got = rows_of(host_rules.host_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    rate = {r["host"]: r["host_rate"] for r in got}
    assert rate["bad"] > 0.5 > rate["good"] and rate["tiny"] < 1.0     # one failure alone is shrunk
    assert all(r["kept"] == (not r["base_failed"] and r["host_rate"] <= 0.5) for r in got)
    assert host_rules.host_rules(messy(spark)).count() == N_MESSY and host_rules.host_rules(empty(spark)).count() == 0


# -- repeated strings -------------------------------------------------------------------


def plain_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        runs = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_removed_strings_equal_plain_version(spark):
    texts = documents(spark, SF001)
    want = dict(zip(texts, plain_removed(texts.values(), 400)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows_of(queries.op6_repeated_strings(spark, SF001))}
    assert got == want


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_removed_strings_small_lengths(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 120))) for _ in range(40)] + ["é" * 30, "a" * 90, None, "", "ab" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plan = repeats.RepeatPlan(length=12, anchor=4, shard_bytes=200)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows_of(repeats.remove_repeats(df, plan))}
    assert got == dict(enumerate(plain_removed(texts, 12)))


def test_removal_odd_cases(spark):
    got = rows_of(repeats.remove_repeats(messy(spark), keep_text=True))
    assert len(got) == N_MESSY and repeats.remove_repeats(empty(spark)).count() == 0
    assert all(r["n_removed"] == r["n_bytes"] for r in got if r["doc_id"] in (3, 9, 10))   # repeated row, texts that repeat themselves
    assert all(len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got)
    assert len(PROSE) > 400


def test_suffix_arrays_equal_plain_version(monkeypatch):
    rng = random.Random(1)
    for _ in range(150):
        alphabet = rng.choice(["a", "ab", "abc", "abcdefgh"])
        parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(3)]
        strings = ["".join(rng.choice([*parts, *alphabet]) for _ in range(rng.randint(0, 12))).encode() for _ in range(rng.randint(1, 6))]
        cap = rng.choice([3, 10, 400])
        monkeypatch.setattr(suffix_sort, "_BLOCK", rng.choice([1, 3, 20, 4096]))
        t, order, lcp = suffix_sort.suffix_array(strings, cap, suffix_sort.Spool(rng.choice([0, 1 << 20])))
        plain = t.tolist()
        want = sorted(range(len(plain)), key=lambda i: plain[i:])
        assert order.tolist() == want
        for k in range(1, len(want)):
            a, b, n = want[k - 1], want[k], 0
            while n < cap and a + n < len(plain) and b + n < len(plain) and plain[a + n] == plain[b + n]:
                n += 1
            assert lcp[k] == n
