"""Draws from many categories, principal axes, K-Means in the JVM, as-of joins, chart points, streamed usage with late rows."""

import datetime as dt
import hashlib
import json

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from persona_engine.functions import prompts
from persona_engine.operators import marginals as mg
from persona_engine.operators import report as rp
from persona_engine.operators import segment as sg
from persona_engine.operators import synth as sy
from persona_engine.operators.indexing import as_of, running_sum_within
from persona_engine.streaming.usage_stream import UsageStream, run_weekly_usage_stream


def plain_unit(seed, salt, i):
    h = hashlib.md5(f"{seed}:{salt}:{i}".encode()).hexdigest()
    return (int(h[:8], 16) + 0.5) / 4294967296.0


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_draws_from_many_categories(spark, broadcast_rows):
    # 100,000 values: one holds a third of all rows, the others one or two rows each
    n = 100_000
    many = spark.range(n).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"), F.expr("1 + id % 2").alias("k"))
    rows = many.select("c", F.explode(F.expr("sequence(1, k)")).alias("_")).select("c").unionAll(spark.range(75_000).select(F.lit("hot").alias("c")))
    rows = rows.unionAll(spark.createDataFrame([(None,)] * 3, "c string"))
    levels = mg.levels(rows, ["c"]).cache()
    table = levels.orderBy("lo").toPandas()
    assert len(table) == n + 1 and table.value[0] == "hot" and abs(table.hi.iloc[-1] - 1.0) < 1e-15 and (table.lo[1:].values == table.hi[:-1].values).all()
    drawn = sy.draw_categories(spark.range(1, 5001), levels, ["c"], 7, broadcast_rows).toPandas().set_index("id").c
    u = np.array([plain_unit(7, "c", i) for i in range(1, 5001)])
    want = table.value.values[np.searchsorted(table.hi.values, u, side="right")]
    assert len(drawn) == 5000 and (drawn.sort_index().values == want).all()
    levels.unpersist()


def test_draws_without_levels_and_with_one(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "x string, y string")
    got = sy.draw_categories(spark.range(1, 4), mg.levels(df, ["x", "y"]), ["x", "y"], 1).collect()
    assert [(r["x"], r["y"]) for r in got] == [("a", None)] * 3


def test_running_sum_over_slices(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"), F.lit(1).alias("v"))
    got = running_sum_within(df, ["g"], ["o"], "v", "s", 7).collect()
    assert all(r["s"] == r["o"] // 2 + 1 for r in got) and len(got) == 1000


def test_axes_are_canonical(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) @ np.diag([3.0, 2.0, 1.0, 0.5]) @ np.linalg.qr(rng.normal(size=(4, 4)))[0]
    cols = [f"c{i}" for i in range(4)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in cols))
    assert np.allclose(sg.covariance(df, cols), np.cov(x.T))
    axes = sg.principal_axes(np.cov(x.T))
    assert all(a[np.argmax(np.abs(a))] > 0 for a in axes) and np.allclose(np.abs(np.linalg.eigh(np.cov(x.T))[1][:, -1]), np.abs(axes[0]))
    got = sg.pca_projection(df, cols, keep=["id"]).orderBy("id").toPandas()
    assert np.allclose(got[["x", "y"]].values, x @ axes.T)
    # the same axes whatever the order of rows, and whatever the sign of the solver's
    again = sg.pca_projection(df.repartition(7).orderBy(F.rand(1)), cols, keep=["id"]).orderBy("id").toPandas()
    assert np.allclose(got.values, again.values)
    assert np.allclose(sg.principal_axes(np.array([[1.0]]), 1), [[1.0]])
    one = sg.pca_projection(df.select("id", "c0"), ["c0"], keep=["id"]).first()
    assert one["y"] == 0.0


def plain_lloyd(x, start, tol=1e-9):
    c = {i: v for i, v in enumerate(start)}
    while True:
        ids = sorted(c)
        d = np.stack([((x - c[i]) ** 2).sum(axis=1) for i in ids], axis=1)
        j = d.argmin(axis=1)
        new = {ids[k]: x[j == k].mean(axis=0) for k in range(len(ids)) if (j == k).any()}
        if new.keys() == c.keys() and all(np.linalg.norm(new[i] - c[i]) <= tol for i in new):
            return new, d.min(axis=1).sum()
        c = new


@pytest.mark.parametrize("repeated", [False, True])
def test_kmeans_equals_plain_restarts(spark, repeated):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 1.0, (60, 3)) for m in (0, 4, 9)])
    if repeated:                                   # equal rows as seeds: clusters run empty and drop out
        x[:90] = x[0]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "cust_id long, a double, b double, c double").cache()
    cents, history = sg.lloyd_kmeans(df, ["a", "b", "c"], 4, 42, 5)
    runs = []
    for r in range(5):
        order = sorted(range(len(x)), key=lambda i: hashlib.md5(f"42:init:{r}:{i}".encode()).hexdigest())
        runs.append(plain_lloyd(x, [x[i] for i in order[:4]]))
    best = min(range(5), key=lambda r: (round(runs[r][1], 6), r))
    assert sorted(cents) == sorted(runs[best][0]) and all(np.allclose(cents[i], runs[best][0][i]) for i in cents)
    assert history[-1] == pytest.approx(runs[best][1])


@pytest.mark.parametrize("broadcast_rows", [10_000, 0])
def test_as_of_takes_the_valid_version(spark, broadcast_rows):
    day = lambda k: dt.date(2024, 1, k)
    versions = spark.createDataFrame([("a", day(3), "1", ["x"]), ("a", day(9), "2", []), ("a", day(9), "3", ["y"]), ("b", day(5), "1", None)],
                                     "t string, valid_from date, v string, blocks array<string>")
    rows = spark.createDataFrame([(k, t, day(k)) for t in ("a", "b", "c") for k in range(1, 12)] + [(99, None, day(5)), (98, "a", None)],
                                 "k long, t string, at date")
    got = {(r["t"], r["k"]): (r["v"], r["blocks"]) for r in as_of(rows, versions, "t", "at", broadcast_rows=broadcast_rows).collect()}
    assert len(got) == 35
    for k in range(1, 12):
        assert got["a", k] == ((None, None) if k < 3 else ("1", ["x"]) if k < 9 else ("3", ["y"]))
        assert got["b", k] == ((None, None) if k < 5 else ("1", None)) and got["c", k] == (None, None)
    assert got[None, 99] == got["a", 98] == (None, None)


def test_forms_give_schema_and_example():
    assert prompts.form_schema(prompts.EVIDENCE_FORM) == "struct<label:string,value:string>"
    example = json.loads(prompts.form_example(prompts.REPORT_FORM))
    assert list(example) == [n for n, _ in prompts.REPORT_FORM] and list(example["sections"][0]["evidence"][0]) == ["label", "value"]
    answer = json.loads("[" + prompts.form_example(prompts.ANSWER_FORM) + "]")[0]
    assert isinstance(answer["cot"], list) and isinstance(answer["integrity_score"], float)


def test_chart_points_come_back_typed(spark):
    items = spark.createDataFrame([("tea", 9, 1), ("milk", 4, 2)], "keyword string, frequency long, rank long")
    answers = spark.createDataFrame([("q1", "x"), ("q1", "x"), ("q1", "y"), ("q2", None)], "question_id string, selected_option string")
    ages = spark.createDataFrame([("30s", 2), ("20s", 5), (None, 1)], "age_band string, n long")
    cards = spark.createDataFrame([("B", 3, 1.5, None), ("A", 3, 2.5, 80.0)], "segment string, n long, purchase_intent double, brand_attitude double")
    points = rp.chart_points(items, rp.option_distribution(answers), ages, cards, "q1")
    assert [r["title"] for r in points.where("chart_id = 'question-distribution'").select("title").distinct().collect()] == ["q1"]
    read = lambda c: [tuple(r) for r in rp.read_chart(points, c).orderBy("ord").collect()]
    assert read("keyword-radar") == [(1, "tea", 9, 50, 100), (2, "milk", 4, 50, 100)]
    assert read("question-strength") == [(1, "q1", "x", 66.7), (2, "q2", None, 100.0)]
    assert read("age-distribution") == [(1, None, 1), (2, "20s", 5), (3, "30s", 2)]
    assert read("question-distribution") == [(1, "q1", "x", 2, 0.667, 1), (2, "q1", "y", 1, 0.333, 0), (3, "q2", None, 1, 1.0, 1)]
    assert read("segment-cards") == [(1, "A", 3, 2.5, 80.0), (2, "B", 3, 1.5, None)]


def test_streamed_usage_holds_open_weeks_only(spark):
    windows, stream = run_weekly_usage_stream(spark, SF001, slices=4)
    held = stream.state_rows()
    assert max(held) < 0.7 * windows.count() and stream.late_rows().count() == 0


def events_frame(spark, rows):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(t), u, "view", 1.0, "") for i, (t, u) in enumerate(rows)],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_late_rows_are_kept_apart(spark, tmp_out):
    first = events_frame(spark, [("2024-01-02 10:00", 1), ("2024-01-09 10:00", 1), ("2024-01-17 10:00", 2)])
    second = events_frame(spark, [("2024-01-10 12:00", 1), ("2024-01-16 09:00", 2), ("2024-01-25 10:00", 1)])
    for name, df in (("a", first), ("b", second)):
        stream = UsageStream(spark, f"{tmp_out}/usage", "1 day")      # a new object each time: a restarted driver
        stream.feed(df, name)
        stream.feed(df, name)                                          # fed twice under a name: once
        stream.run()
    # after the first run the watermark is 2024-01-16 10:00: the week of 2024-01-08 is closed, that of 2024-01-15 is open
    assert [r["user_id"] for r in stream.late_rows().collect()] == [1]
    got = {(r["cust_id"], str(r["week_start"])): r["usage_cnt"] for r in stream.windows().collect()}
    assert got == {(1, "2024-01-01"): 1, (1, "2024-01-08"): 1, (2, "2024-01-15"): 2, (1, "2024-01-22"): 1}


def test_clusters_over_a_category_equal_one_hot_columns(spark):
    from persona_engine.operators import features as fe
    from persona_engine.plans import pipeline as pl
    rng = np.random.default_rng(9)
    rows = [(i, float(rng.normal(i % 3 * 3)), None if i % 17 == 0 else f"r{rng.integers(0, 5)}") for i in range(300)]
    df = spark.createDataFrame(rows, "cust_id long, a double, usr_cnty_ap2 string").cache()
    wide, names = fe.one_hot(df)
    dense = pl.segment_table(wide, ["a", *names], 4, 42, 3).labelled.select("cust_id", "persona_cluster", "sq_dist").toPandas()
    sparse = pl.segment_table_by_category(df, ["a"], "usr_cnty_ap2", 4, 42, 3).labelled.select("cust_id", "persona_cluster", "sq_dist").toPandas()
    both = dense.merge(sparse, on="cust_id")
    assert (both.persona_cluster_x == both.persona_cluster_y).all() and np.allclose(both.sq_dist_x, both.sq_dist_y)


def test_wide_domains_make_no_columns(spark, monkeypatch):
    from persona_engine.operators import features as fe
    from persona_engine.operators import sparse_segment as ss
    df = spark.range(50_010).select((F.col("id") + 1).alias("cust_id"), (F.col("id") % 7).cast("double").alias("a"),
                                    F.when(F.col("id") < 50_000, F.concat(F.lit("v"), F.col("id"))).alias("c"))
    with pytest.raises(ValueError):
        fe.one_hot(df, "c")
    index = fe.value_index(df, "c")
    assert index.count() == 50_000 and index.agg(F.max("index")).first()[0] == 49_999
    vectors = fe.one_hot_sparse(df.where("cust_id > 49990"), "c").select("c", "region_vector").collect()
    assert all(r[1].size == 10 and len(r[1].indices) == (r[0] is not None) for r in vectors) and len({tuple(r[1].indices) for r in vectors}) == 11
    monkeypatch.setattr(ss, "BROADCAST_SHARES", 0)      # by shuffle
    cents, cost = ss.kmeans_with_category(df, ["a"], "c", 3, 42, 1, 2)
    got = ss.assign_with_category(df, ["a"], "c", cents)
    assert got.count() == 50_010 and got.agg(F.sum("sq_dist")).first()[0] <= cost * (1 + 1e-9)


def test_lloyd_steps_set_rows_apart(spark, monkeypatch):
    """Steps over the rows near a border only give the centroids of passes over all rows; max_iter bounds all steps."""
    from persona_engine.operators import lloyd
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(m, 1.0, (2_500, 3)) for m in (0, 2, 5)])
    df = spark.createDataFrame(list(map(tuple, x.tolist())), "a double, b double, c double")
    starts = [(list(range(4)), x[rng.choice(len(x), 4, replace=False)]) for _ in range(3)]
    passes = {"full_pass": 0, "_partial_pass": 0}
    for name in passes:
        def counted(*a, name=name, run=getattr(lloyd, name)):
            passes[name] += 1
            return run(*a)
        monkeypatch.setattr(lloyd, name, counted)
    monkeypatch.setattr(lloyd, "APART_WORK", 0)
    blocks = lloyd.point_blocks(df, ["a", "b", "c"])
    found = lloyd.iterate(blocks, starts, 3, 300, 1e-9)
    assert passes["_partial_pass"] > 0 and passes["full_pass"] < max(s.steps for s in found)
    for s, (_, at) in zip(found, starts):
        want, cost = plain_lloyd(x, list(at))
        assert s.done and s.ids == sorted(want) and np.allclose(s.at, [want[i] for i in s.ids]) and s.cost == pytest.approx(cost)
    cut = lloyd.iterate(blocks, starts, 3, 2, 1e-9)
    assert [s.steps for s in cut] == [2, 2, 2]


def test_equal_distances_go_to_the_smallest_id(spark):
    from persona_engine.operators import lloyd
    df = spark.createDataFrame([(0.1,), (0.3,), (0.5,)] * 40, "a double")
    s = lloyd.iterate(lloyd.point_blocks(df, ["a"]), [([0, 1, 2], np.array([[0.1], [0.5], [0.1]]))], 1, 1, 1e-9)[0]
    assert s.ids == [0, 1] and np.allclose(s.at, [[0.2], [0.5]])


def test_narrow_category_steps_over_blocks(spark, monkeypatch):
    """The same clusters by blocks and by tables of shares; a value that is null takes part."""
    from persona_engine.operators import sparse_segment as ss
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(rng.normal(i % 3 * 2)), None if i % 17 == 0 else f"v{i % 5}") for i in range(400)],
                               "cust_id long, a double, c string").cache()
    monkeypatch.setattr(ss, "step", None)       # blocks take no step by tables
    by_blocks = ss.kmeans_with_category(df, ["a"], "c", 3, 42, 1)
    monkeypatch.undo()
    monkeypatch.setattr(ss, "NARROW", 0)
    by_tables = ss.kmeans_with_category(df, ["a"], "c", 3, 42, 1)
    assert by_blocks[1] == pytest.approx(by_tables[1])
    one, two = [ss.assign_with_category(df, ["a"], "c", x[0]).select("cust_id", "persona_cluster", F.round("sq_dist", 6)).orderBy("cust_id").collect()
                for x in (by_blocks, by_tables)]
    assert one == two


def test_pyspark_ml_restarts_step_together(spark):
    """The model is pyspark.ml's of the restart of lowest cost; only that one is fitted to the end by it."""
    from pyspark.ml.clustering import KMeans
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(m, 1.0, (80, 2)) for m in (0, 3, 7, 9)])
    df = sg.assemble(spark.createDataFrame(list(map(tuple, x.tolist())), "a double, b double").coalesce(1), ["a", "b"]).cache()
    model, cost = sg.fit_kmeans(df, ["a", "b"], 4, 42, 4, features_col="features")
    costs = [KMeans(k=4, seed=42 + i, maxIter=300, featuresCol="features").fit(df).summary.trainingCost for i in range(4)]
    assert cost == pytest.approx(min(costs), rel=1e-9) and model.summary.trainingCost == cost


def test_kmeans_refuses_missing_values(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float(i)) for i in range(20)], "cust_id long, a double")
    with pytest.raises(ValueError):
        sg.lloyd_kmeans(df, ["a"], 3, 42, 2)
