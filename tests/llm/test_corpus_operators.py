"""Toxicity, mixing, neighbours, encoding, personal data and the pipeline."""

import collections
import math
import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from conftest import SF001, SF01  # noqa: E402
from helpers import LOWER, documents, empty, messy, messy_rows, rows_of, words  # noqa: E402

from persona_engine.llm import encode, mixing, neighbours, private_terms, queries, toxicity  # noqa: E402

N_MESSY = len(messy_rows())
SF_TENTH = "/root/testdata/sf0.1"


# -- toxicity ---------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    got = queries.op4_toxicity(spark, SF_TENTH).join(queries.labels(spark, SF_TENTH), "doc_id").where("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert len(toxic) > 50
    assert (toxic.predicted == 1).mean() > 0.85 and (clean.predicted == 1).mean() < 0.01
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_toxicity_odd_cases(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1), (7, 5), (1, 0)], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    got = rows_of(toxicity.score_toxicity(docs, model))
    assert len(got) == N_MESSY and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_toxicity(empty(spark), model).count() == 0
    none = toxicity.train_toxicity(docs, labels.limit(0))
    assert {r["score"] for r in rows_of(toxicity.score_toxicity(docs, none))} == {0.0}
    assert toxicity.drop_toxic(docs, none).columns == docs.columns and toxicity.drop_toxic(docs, none).count() == N_MESSY


def test_hidden_insults_are_seen():
    import pyarrow as pa

    from persona_engine.llm import textbytes as tb
    lexicon = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    c = next(tb.chunks(pa.array(["you are an id1ot and a l.o.s.e.r", "you idiot", "a fine day", ""])))
    f = toxicity.text_features(c, lexicon)
    assert f["obfuscated_hits"][0] > 0 and f["listed"][1] > 0 and f["near_you"][1] > 0
    assert f["listed"][2] == f["obfuscated_hits"][2] == 0 and all(f[k][3] == 0 for k in toxicity.FEATURES)


# -- mixing -----------------------------------------------------------------------------


def plain_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2):
    """Sources in order → target: shared by weight, stopped at most * size, the excess shared anew until none is above."""
    w = {s: weights[k % len(weights)] for k, s in enumerate(sizes)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        left = total - sum(stopped.values())
        open_ = [s for s in sizes if s not in stopped]
        target = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if target[s] > most * sizes[s]]
        if not above:
            return stopped | target
        stopped |= {s: float(most * sizes[s]) for s in above}


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = queries.op7_mixing(spark, SF01).toPandas()
    again = queries.op7_mixing(spark, SF01).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    text = docs.select("doc_id", "text", "source").toPandas().set_index("doc_id")
    assert all(n == len(words(text.text[i])) for i, n in zip(got.doc_id, got["size"]))
    got["source"] = [text.source[i] for i in got.doc_id]
    per = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    want = plain_targets(per["size"].to_dict())
    for s, r in per.iterrows():
        assert r.target == pytest.approx(want[s], rel=1e-12)
        assert abs(r.taken - r.target) <= max(4, 0.001 * r.target)
    assert (got.taken <= 2 * got["size"]).all()


def test_small_sources_get_their_share(spark):
    sizes = {"a": [700, 400], "b": [1], "c": [2, 1], "d": [10], "e": [15], "f": [0, 0], None: [40]}
    rows = [(k, " ".join(["w"] * n), s) for s, ns in sizes.items() for k, n in enumerate(ns)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).toPandas()
    per = {s: g for s, g in got.groupby(got.source.fillna("~"))}
    want = plain_targets({s or "~": sum(ns) for s, ns in sizes.items()})
    for s, g in per.items():
        assert g.target.iloc[0] == pytest.approx(want[s]) and abs(g.taken.sum() - want[s]) <= 4 and (g.taken <= 2 * g["size"]).all()
    assert all(per[s].taken.sum() > 0 for s in ("c", "d", "e"))


def test_many_sources_meet_their_targets(spark):
    rng = random.Random(2)
    sizes = {f"h{k:04d}": rng.choice([0, 1, 3, 17, 90, 400]) for k in range(1500)}
    rows = [(k, "w " * n, s) for k, (s, n) in enumerate(sizes.items())]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).toPandas().set_index("source")
    want = plain_targets(sizes)
    assert all(got.target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) and abs(got.taken[s] - want[s]) <= 4 for s in sizes)


def test_apportionment_is_highest_quotients(spark):
    rng = random.Random(4)
    claims = [round(rng.random() * 40, 3) for _ in range(30)]
    most = [rng.choice([0, 2, 5, 100]) for _ in claims]
    cells = spark.createDataFrame([(f"s{k % 3}", False, k, float(c), m) for k, (c, m) in enumerate(zip(claims, most))],
                                  "key string, is_null boolean, shard bigint, claim double, most bigint")
    for seats in (0, 1, 17, 60, 10_000):
        got = {r["shard"]: r["quota"] for r in rows_of(mixing.apportion(cells, seats))}
        want = dict.fromkeys(range(len(claims)), 0)
        for _ in range(min(seats, sum(m for c, m in zip(claims, most)))):
            free = [k for k in want if want[k] < most[k]]
            k = max(free, key=lambda k: claims[k] / (2 * want[k] + 1))
            want[k] += 1
        assert got == want


def test_mixing_odd_cases(spark):
    got = rows_of(mixing.mix_sources(messy(spark)))
    assert len(got) == N_MESSY and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert {r["taken"] for r in got if r["doc_id"] in (4, 5, 6)} == {0}
    assert mixing.mix_sources(empty(spark)).count() == 0
    docs = messy(spark).drop("size")
    mix = mixing.take_mix(docs)
    assert mix.columns == docs.columns
    n = mix.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert n == sum(r["taken"] for r in got)
    assert mixing.take_mix(empty(spark)).count() == 0


# -- neighbours -------------------------------------------------------------------------


def plain_neighbours(rows, every, k):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_recall_against_plain_search(spark):
    e = spark.read.parquet(f"{SF_TENTH}/embeddings.parquet")
    want = plain_neighbours([(r["vec_id"], r["embedding"]) for r in e.collect()], 100, 10)
    got = queries.op8_multiprobe_lsh(spark, SF_TENTH).toPandas()
    found = 0
    for q, near in want.items():
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and mine.score.is_monotonic_increasing
        found += len({v for v, _ in near} & set(mine.vec_id))
    assert found / (10 * len(want)) >= 0.9


def test_probes_come_in_order_of_probability():
    place = np.array([0.5, 2.9, -1.2])
    cells = neighbours.probe_cells(place, 0.5, 0.99)
    assert cells[0].tolist() == [0, 2, -2] and len({tuple(c) for c in cells}) == len(cells)
    assert cells[1].tolist() == [0, 3, -2]   # across the nearest border


def test_neighbours_odd_cases(spark):
    one, two = [1.0, 0.0], [0.0, 2.0]
    rows = [(k, one) for k in range(0, 400)] + [(400, two), (401, [0.5, 0.5]), (400, two), (500, None), (600, [0.0, 0.0]), (700, [1.0, None]),
                                                (800, [float("nan"), 1.0]), (900, [float("inf"), 1.0]), (1000, [1.0, 2.0, 3.0]), (None, one)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1)).withColumn("entry", F.lit(2))
    got = neighbours.nearest_neighbours(df).toPandas()
    assert set(got.query_id) == {0, 100, 200, 300, 400}
    mine = got[got.query_id == 0].sort_values("rank")
    assert mine.vec_id.tolist() == list(range(1, 11)) and (mine.score == 0).all()
    far = got[got.query_id == 400].sort_values("rank")
    assert far.vec_id.tolist()[0] == 401 and len(far) == 10 and 400 not in far.vec_id.tolist()
    split = neighbours.nearest_neighbours(df, neighbours.NeighbourPlan(bucket_rows=1)).toPandas()
    assert split.sort_values(["query_id", "rank"]).reset_index(drop=True).equals(got.sort_values(["query_id", "rank"]).reset_index(drop=True))
    assert neighbours.nearest_neighbours(df.limit(0)).count() == 0
    assert neighbours.nearest_neighbours(df.where("vec_id = 0")).count() == 0


def test_isolated_and_sparse_queries_get_all_their_neighbours(spark):
    rng = np.random.default_rng(11)
    dense = rng.normal(0, 0.01, (1500, 8)) + 5
    loose = rng.normal(0, 3.0, (300, 8)) - 40
    alone = rng.normal(0, 500.0, (40, 8))
    x = np.concatenate([dense, loose, alone])
    rows = [(k, v) for k, v in zip(rng.permutation(len(x)).tolist(), x.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = plain_neighbours(rows, 4, 10)
    for exact_rows in (4096, 7):
        plan = neighbours.NeighbourPlan(every=4, exact_rows=exact_rows)
        got = neighbours.nearest_neighbours(df, plan).toPandas().sort_values(["query_id", "rank"])
        assert got.groupby("query_id").size().to_dict() == {q: 10 for q in want}
        mine = got.groupby("query_id").vec_id.apply(list).to_dict()
        groups = {name: [k for k, v in rows if k % 4 == 0 and name == ("dense" if abs(v[0] - 5) < 1 else "loose" if abs(v[0] + 40) < 20 else "alone")]
                  for name in ("dense", "loose", "alone")}
        recall = {name: [len({v for v, _ in want[q]} & set(mine[q])) / 10 for q in qs] for name, qs in groups.items()}
        assert min(recall["alone"]) == 1 and np.mean(recall["loose"]) >= 0.9 and np.mean(recall["dense"]) >= 0.9


def test_rarer_lengths_are_searched_among_themselves(spark):
    rows = [(k, [float(k), 1.0]) for k in range(200)] + [(1000 + k, [float(k), 0.0, 2.0]) for k in range(0, 105, 5)]
    got = neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).toPandas()
    mine = got[got.query_id == 1000].sort_values("rank")
    assert mine.vec_id.tolist() == list(range(1005, 1055, 5)) and mine.score.tolist() == [5.0 * k for k in range(1, 11)]
    assert got.groupby("query_id").size().to_dict() == {0: 10, 100: 10, 1000: 10, 1100: 10} and (got[got.query_id < 200].vec_id < 200).all()


# -- encoding ---------------------------------------------------------------------------


def odd_texts(n=400):
    rng = random.Random(3)
    parts = ["a", "b", "e", "er", "th", " ", "  ", "\n", "\t", "é", "中", "😀", "▁", ".", "0", "\x00", "aaaa", "     ", "in", "(", "==", "-", "　", "<s>", "<0x41>", "́"]
    out = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 30, 200]))) for _ in range(n)]
    return out + [" " * k for k in range(40)] + ["a" * k for k in range(40)] + ["-" * k for k in range(60)] + [None, "thequickbrownfox" * 200]


def test_encoding_equals_the_library(spark):
    import sentencepiece as spm
    sp = spm.SentencePieceProcessor(model_file=queries.tokenizer_path())
    texts = dict(enumerate([*documents(spark, SF001).values(), *odd_texts()]))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = rows_of(encode.encode_documents(df, queries.tokenizer_path(), keep_ids=True))
    assert len(got) == len(texts)
    for r in got:
        ids = [*sp.encode(texts[r["doc_id"]] or ""), sp.eos_id()]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == sp.decode(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_encoding_odd_cases(spark):
    path = queries.tokenizer_path()
    assert encode.encode_documents(messy(spark), path).count() == N_MESSY and encode.encode_documents(empty(spark), path).count() == 0


# -- personal data ----------------------------------------------------------------------


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(x) for x in m.group() if x.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    return sorted(out + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(x.isdigit() for x in m.group()) <= 15])


def test_base_spans_equal_plain_patterns():
    rng = random.Random(5)
    parts = ["a", "b.", "@", ".", "c", "_", "-", "1", "2", "255", "0", "+", "4", "(", " ", "5555", "3", "9", "é", "@x.y", "%"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert private_terms.base_spans(t) == plain_spans(t)


def test_long_runs_are_quick():
    assert private_terms.base_spans("x" * 200_000 + "1" * 200_000 + "@" * 1000 + "." * 1000) == []


def test_terms_that_give_an_entity_away(spark):
    filler = " ".join(f"common{k}" for k in range(30))
    rows = [(k, f"{filler} ask zanzibar at joe@corp.org or common1 {filler}") for k in range(5)]
    rows += [(100 + k, f"{filler} common words only, nothing {k}") for k in range(40)] + [(200, "zanzibar alone has no spans")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in rows_of(private_terms.find_private(df))}
    for k in range(5):
        text = rows[k][1]
        terms = [text[int(a):int(b)] for kind, a, b in (s.split(":") for s in got[k]) if kind == "term"]
        assert "zanzibar" in terms and not any(t.startswith("common") for t in terms)
    assert got[200] == [] and got[100] == []
    clean = {r["doc_id"]: r["text"] for r in rows_of(private_terms.sanitise_documents(df))}
    assert "joe@" not in clean[0] and "zanzibar" not in clean[0] and "[EMAIL]" in clean[0] and clean[200] == rows[-1][1]


def test_terms_are_spans_at_all_their_places(spark, monkeypatch):
    filler = " ".join(f"common{k}" for k in range(30))
    rows = [(k, f"Zanzibar é {filler} ask joe@corp.org or common1 {filler} zanzibar") for k in range(5)]
    rows += [(100 + k, f"{filler} common words only, nothing {k}") for k in range(40)] + [(200, "far zanzibar, alone"), (201, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for most in (private_terms.BROADCAST_TERMS, 0):
        monkeypatch.setattr(private_terms, "BROADCAST_TERMS", most)
        for everywhere in (True, False):
            plan = private_terms.DisclosurePlan(everywhere=everywhere)
            got = {r["doc_id"]: [s.split(":") for s in r["spans"].split(",") if s] for r in rows_of(private_terms.find_private(df, plan))}
            for k in range(5):
                text = rows[k][1]
                found = [text[int(a):int(b)].lower() for kind, a, b in got[k] if kind == "term"]
                assert found.count("zanzibar") == 2 and "corp" not in found and not any(t.startswith("common") for t in found)
            assert got[200] == ([["term", "4", "12"]] if everywhere else []) and got[201] == got[100] == []


def plain_terms(texts, plan):
    """Term spans of each text, from document sets and the words of the definition."""
    term = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
    lower = lambda t: t.translate(LOWER)
    held = [{lower(m.group()) for m in term.finditer(t or "")} for t in texts]
    spans = [plain_spans(t or "") for t in texts]
    docs_of, parts = collections.defaultdict(set), collections.defaultdict(set)
    for i, t in enumerate(texts):
        for a, kind, b in spans[i]:
            e = private_terms._entity(kind, t[a:b])
            docs_of[e].add(i)
            if kind == 0:
                parts[e] |= {x.lower() for x in re.findall("[A-Za-z0-9]+", t[a:b].rpartition(".")[0]) if len(x) >= 3}
            elif kind in (2, 3):
                parts[e] |= {x for x in re.findall("[0-9]+", t[a:b]) if len(x) >= 4}
    n = len(texts)
    df = collections.Counter(x for h in held for x in h)
    best = collections.Counter()
    for e, d in docs_of.items():
        if len(d) == n:
            continue
        both = collections.Counter(x for i in d for x in held[i])
        for x in both:
            if both[x] >= plan.min_docs <= len(d) or x in parts[e]:
                given = math.log2((len(d) if x in parts[e] else both[x]) * n / (df[x] * len(d))) / math.log2(n / len(d))
                best[x] = max(best[x], given)
    out = []
    for t, base in zip(texts, spans):
        mine = [(m.start(), 4, m.end()) for m in term.finditer(t or "") if best[lower(m.group())] >= plan.generalise
                and not any(a < m.end() and m.start() < b for a, _, b in base)]
        out.append(",".join(f"{private_terms.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + mine)))
    return out


def test_term_spans_equal_plain_version(spark):
    rng = random.Random(8)
    texts = list(documents(spark, SF01).values())
    for k in range(60):     # names in addresses and last digits of numbers, which stand in one more document; common names
        name, digits = f"zq{rng.randrange(10**6)}x", str(rng.randrange(1000, 10**4))
        texts += [f"Write to {name}.office@mail.example.org or call +1 (521) 555-{digits}.", f"We met {name.upper()} at door {digits}, office of the mail."]
    texts += [f"kestrel and boss@bird.example.com with {k}" for k in range(4)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plan = private_terms.DisclosurePlan(everywhere=True)
    got = {r["doc_id"]: r["spans"] for r in rows_of(private_terms.find_private(df, plan))}
    want = plain_terms(texts, plan)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(x.count("term:") for x in want) >= 120 and "term" in got[len(texts) - 3]


def test_values_stated_once_are_protected(spark):
    """On the given documents: every term span is a part of a value that some document states."""
    docs = documents(spark, SF_TENTH)
    got = rows_of(private_terms.find_private(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(8),
                                             private_terms.DisclosurePlan(everywhere=True)))
    parts = {p for t in docs.values() for a, k, b in private_terms.base_spans(t or "") for p in private_terms.value_parts(k, t[a:b])}
    found = [docs[r["doc_id"]][int(a):int(b)].translate(LOWER) for r in got for kind, a, b in (s.split(":") for s in r["spans"].split(",") if s) if kind == "term"]
    assert found and set(found) <= parts


def test_private_odd_cases(spark):
    got = {r["doc_id"]: r for r in rows_of(private_terms.find_private(messy(spark)))}
    assert private_terms.find_private(messy(spark)).count() == N_MESSY and private_terms.find_private(empty(spark)).count() == 0
    r = got[11]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest()
    out = private_terms.sanitise_documents(messy(spark))
    assert out.columns == messy(spark).columns and out.count() == N_MESSY


# -- pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_out):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF01).write.parquet(f"{tmp_out}/{name}")
        docs = spark.read.parquet(f"{tmp_out}/{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    private = spark.read.parquet(f"{tmp_out}/private_data")
    assert not any(private_terms.base_spans(r["text"] or "") for r in private.collect())
    assert corpus_pipeline.run(spark, SF01).count() == counts[4]


def test_pipeline_odd_cases(spark, tmp_out):
    import corpus_pipeline
    docs = messy(spark)
    n = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF001).write.parquet(f"{tmp_out}/{name}")
        docs = spark.read.parquet(f"{tmp_out}/{name}")
        assert docs.columns == messy(spark).columns
        n.append(docs.count())
    assert n[0] >= n[1] == n[2] > 0 and docs.where("text is not null").count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert last.count() == n[3]
    nothing = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF001).count() == 0


def test_entry_lists_all_operators():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13
