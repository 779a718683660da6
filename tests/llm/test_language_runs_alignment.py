"""Language by rank order, periodic runs, token alignment: against plain versions."""

import collections
import hashlib
import json
import random
import sys
import unicodedata
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from conftest import SF001  # noqa: E402
from helpers import documents, empty, messy, messy_rows, rows_of, words  # noqa: E402

from persona_engine.llm import align, periodic, queries, rank_order  # noqa: E402

N_MESSY = len(messy_rows())


# -- rank-order language ------------------------------------------------------------------


def plain_grams(text):
    text = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    count = collections.Counter()
    for w in text.split():
        w = f"_{w}_"
        count.update(w[i:i + n] for n in range(1, 6) for i in range(len(w) - n + 1))
    del count["_"]
    return count


def plain_language(text, profiles, size):
    """The contract's words turned into loops: profiles is {lang: {gram: rank}}."""
    if not any(c.isalpha() for c in text or "") or not profiles:
        return "und", 0.0
    count = plain_grams(text)
    by_times = collections.Counter(count.values())
    more = {n: sum(k for m, k in by_times.items() if m > n) for n in by_times}
    own = {g: more[n] + (by_times[n] - 1) / 2 for g, n in count.items() if more[n] < size}
    far = {lang: sum(min(size, abs(r - known[g])) if g in known else size for g, r in own.items()) for lang, known in profiles.items()}
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (len(own) * size)


def plain_profiles(rows, size):
    count = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            count[lang].update(plain_grams(text))
    return {lang: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size])}
            for lang, c in count.items() if c}


ODD = ["", None, "a", "A b", "  x-y  ", "é ü 中文 😀 ▁x  y\x00z", "İstanbul", "123 !", "áb c", "word " * 500, "x" * 3000]


def test_grams_equal_plain_version():
    text, h, times, has_letter = rank_order.text_grams(ODD)
    for k, t in enumerate(ODD):
        want = plain_grams(t)
        assert dict(zip(h[text == k].tolist(), times[text == k].tolist())) == {rank_order.gram_hash(g): n for g, n in want.items()}
        assert has_letter[k] == any(c.isalpha() for c in t or "")
        count = collections.Counter(rank_order.words_of(ODD)[k])
        if count:
            _, gram, n = rank_order.word_grams(list(count), np.array(list(count.values())))
            assert dict(zip(gram.tolist(), n.tolist())) == want


@pytest.mark.parametrize("block_rows,held_words", [(1 << 18, 1 << 19), (500, 50)])
def test_languages_equal_plain_version(spark, monkeypatch, block_rows, held_words):
    monkeypatch.setattr(rank_order, "HELD_WORDS", held_words)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    learned = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    rule = rank_order.ProfileRule(400)
    profiles = rank_order.language_profiles(docs.filter(~rank_order.held_out(docs["doc_id"])), rule)
    want = plain_profiles(learned, 400)
    got = collections.defaultdict(dict)
    for r in profiles.collect():
        got[r.lang][r.gram] = r.rank
    assert got == want
    found = {r.doc_id: r for r in rank_order.predict_language(docs, profiles, rule, block_rows).collect()}
    assert len(found) == len(rows)
    for r in rows:
        lang, score = plain_language(r.text, want, 400)
        assert found[r.doc_id].lang_pred == lang and found[r.doc_id].score == pytest.approx(score)
        assert found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and found[r.doc_id].margin >= 0


def test_language_on_held_out_documents(spark):
    got = queries.op11_rank_order_language(spark, SF001).join(
        spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def test_language_odd_cases(spark):
    got = rows_of(rank_order.rank_order_language(messy(spark)))
    assert len(got) == N_MESSY
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (4, 5, 6)} == {"und"}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert rank_order.rank_order_language(empty(spark)).count() == 0
    unlearned = rank_order.rank_order_language(messy(spark).drop("lang").selectExpr("*", "cast(null as string) lang"))
    assert {(r["lang_pred"], r["score"]) for r in rows_of(unlearned)} == {("und", 0.0)}


# -- periodic runs ------------------------------------------------------------------------


def plain_runs(w):
    n, runs = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                stretch = w[i:i + size]
                if all(stretch[d:] != stretch[:-d] for d in range(1, q)):
                    runs.add((i, size, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain_periodic(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return {"n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(kept.encode()).hexdigest()}


def test_runs_of_built_texts_equal_plain_version():
    rnd = random.Random(11)
    texts = []
    for _ in range(1500):
        w = []
        for _ in range(rnd.randrange(6)):
            letters = rnd.choice(["ab", "abc", "abcdefgh"])
            if rnd.randrange(4) == 0:
                w += [rnd.choice(letters) for _ in range(rnd.randrange(30))]
            else:
                p = [rnd.choice(letters) for _ in range(rnd.randrange(1, 9))]
                w += (p * 9)[:rnd.randrange(2, 9) * len(p) - rnd.randrange(len(p))]
        texts.append(" ".join(w))
    found = list(periodic.collapse_texts([None] * len(texts), pa.array(texts)))
    for t, x in zip(texts, found):
        assert x["runs"] == plain_runs(t.split())
    assert sum(len(x["runs"]) for x in found) > 1000


def test_rare_words_split_until_nothing_goes():
    w = "a b a b a b c a b a b a b a b d d d".split()
    number = np.unique(w, return_inverse=True)[1]
    place, segment = periodic.split_by_frequency(number, np.zeros(len(w), np.int64), periodic.RunRule())
    assert place.tolist() == list(range(7, 15)) and len(set(segment.tolist())) == 1


def test_periodic_documents_equal_plain_version(spark):
    got = {r["doc_id"]: r for r in rows_of(queries.op12_periodic_runs(spark, SF001))}
    texts = documents(spark, SF001)
    assert sorted(got) == sorted(texts)
    for i, t in texts.items():
        assert got[i] == {"doc_id": i, **plain_periodic(i, t)}
    assert any(r["n_runs"] for r in got.values())


def test_periodic_odd_cases(spark):
    got = rows_of(periodic.periodic_runs(messy(spark), planted=True, keep_text=True))
    assert len(got) == N_MESSY
    want = collections.Counter(plain_periodic(r[0], r[1])["collapsed_sha256"] for r in messy_rows() if len(r[1] or "") < 9000)
    assert not want - collections.Counter(r["collapsed_sha256"] for r in got)
    long = next(r for r in got if r["doc_id"] == 9)          # 40,000 words "a", with or without a planted tail
    assert (long["n_runs"], long["start"], long["length"], long["period"], long["collapsed"]) == (1, 0, 40_000, 1, "a")
    none = hashlib.sha256(b"").hexdigest()
    assert {(r["n_runs"], r["start"], r["runs_sha256"], r["collapsed_sha256"]) for r in got if r["doc_id"] in (4, 5, 6)} == {(0, None, none, none)}
    assert periodic.periodic_runs(empty(spark)).count() == 0


# -- token alignment ----------------------------------------------------------------------


def plain_alignment(texts):
    """{key: text} → {key: (counts, groups, links)} with the libraries themselves and a loop over all overlapping tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_file, b_file = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path()
    ta = Tokenizer.from_file(a_file)
    ta.encode_special_tokens = True
    with open(a_file, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = align.byte_of_char()
    a_bytes = {i: bytes(byte.get(c, 0) for c in t) for t, i in vocab.items()}
    tb = sentencepiece.SentencePieceProcessor(model_file=b_file)
    out = {}
    for key, text in texts.items():
        out[key] = (0, 0, "", [])
        if not text:
            continue
        a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
        parts = [[a_bytes[i] for i in a], [bytes([int(p[3:-1], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()
                                           for i in b for p in [tb.id_to_piece(i)]]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for c in cuts:
            i2, j2 = ends[0].index(c) + 1, ends[1].index(c) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            for x in range(i, i2):
                for y in range(j, j2):
                    lo = max(ends[0][x] - len(parts[0][x]), ends[1][y] - len(parts[1][y]))
                    if lo < min(ends[0][x], ends[1][y]):
                        links.append((a[x], b[y]))
            i, j = i2, j2
        out[key] = (len(a), len(b), ";".join(groups), links)
    return out


def plain_rows(texts):
    found = plain_alignment(texts)
    count = collections.Counter(p for x in found.values() for p in set(x[3]))
    top = collections.Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return {key: {"n_a": a, "n_b": b, "n_groups": groups.count(";") + 1 if groups else 0, "n_links": len(links),
                  "n_best": sum(count[p] == top[p[0]] for p in links), "count_sum": sum(count[p] for p in links),
                  "groups_sha256": hashlib.sha256(groups.encode()).hexdigest() if groups else ""}
            for key, (a, b, groups, links) in found.items()}


ALIGN_ODD = ["<|endoftext|> and </s> <s> <unk>", "▁mark", "a▁b", "\x00\x01", "  two  spaces ", "\n\n\t\r\n", "中文字 and 😀👩‍👩‍👧", "ﬁ Å é",
             "x" * 5000, " ", "don't we'll I'M 123456 1,234.5", " 　 z", "�​﻿"]


@pytest.mark.parametrize("lane", [1, 7, 1024])
def test_lanes_give_all_links(lane):
    ta, tb = align.token_tables(queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path())
    a, b = align.encode_both(ALIGN_ODD, ta, tb)
    links = align.merge_lockstep(a, b, lane)
    want = plain_alignment(dict(enumerate(ALIGN_ODD)))
    got = collections.defaultdict(list)
    for t, x, y in zip(links.text.tolist(), a.ids[links.a].tolist(), b.ids[links.b].tolist()):
        got[t].append((x, y))
    assert {k: got[k] for k in want} == {k: x[3] for k, x in want.items()}


def test_byte_tokens_equal_the_library():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    rnd = random.Random(3)
    alphabet = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) != "Cs"] + list(" \t\n\r'stdm 09azAZ") * 200
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(3000)] + ALIGN_ODD
    ours = align.token_tables(queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path())[0].tokenizer.encode(texts)
    assert ours == [e.ids for e in lib.encode_batch([" " + t for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("frequent", [1 << 19, 300, 0])
def test_alignment_equals_plain_version(spark, frequent):
    texts = {i: t for i, t in documents(spark, SF001).items() if len(t) < 4000}
    texts.update({-k: t for k, t in enumerate(ALIGN_ODD, 1)})
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = align.token_alignment(docs, queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path(), frequent)
    want = plain_rows(texts)
    found = {r.pop("doc_id"): r for r in rows_of(got)}
    assert found == want


def test_alignment_odd_cases(spark):
    got = rows_of(align.token_alignment(messy(spark), queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path()))
    assert len(got) == N_MESSY
    nothing = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "n_best": 0, "count_sum": 0, "groups_sha256": ""}
    assert all({c: r[c] for c in nothing} == nothing for r in got if r["doc_id"] in (4, 5, 8))   # null, empty, a U+2581
    assert sum(r["doc_id"] is None for r in got) == 1 and sum(r["doc_id"] == 3 for r in got) == 2
    files = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path()
    assert align.token_alignment(empty(spark), *files).count() == 0
    unchanged = rows_of(align.token_alignment(messy(spark).filter("doc_id = 5"), *files))
    assert [{c: r[c] for c in nothing} for r in unchanged] == [nothing]
