"""Skew handling changes the plan, never the result."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.operators import markers, neighbors, qc, scale, series


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 40), i, float(rnd.randint(0, 9))) for i in range(3000)]
    return spark.createDataFrame(rows, "k int, i int, v double").cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_hot_equals_join(skewed, how):
    per = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("total")).where("k % 3 <> 1")
    want = skewed.join(per.drop("rows"), "k", how)
    got = scale.join_hot(skewed, per, ["k"], "rows", how, hot_rows=50)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_join_hot_spreads_the_heavy_key(skewed):
    per = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    text = scale.join_hot(skewed, per, ["k"], "rows", hot_rows=50)._jdf.queryExecution().toString()
    assert "_salt" in text


@pytest.mark.parametrize("limit", [1, 100_000])
def test_lookup_join_both_ways(skewed, monkeypatch, limit):
    monkeypatch.setattr(scale, "LOOKUP_ROWS", limit)
    names = skewed.sparkSession.createDataFrame([(i, f"n{i}") for i in range(0, 40, 2)], "k int, name string")
    got = scale.lookup_join(skewed, names, ["k"], "left")
    want = skewed.join(names, "k", "left")
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_running_sums_cross_blocks(skewed):
    got = scale.running(skewed, ["k"], ["v", "i"], F.floor("v"), {"s": "v"}).collect()
    rows = sorted((r["k"], r["v"], r["i"], r["s"]) for r in got)
    total, last = 0.0, None
    for k, v, _, s in rows:
        total = v if k != last else total + v
        last = k
        assert s == total


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles_interpolate(skewed, by):
    probs = [0.0, 0.01, 0.33, 0.5, 0.98, 1.0]
    got = scale.quantiles(skewed, by, "v", probs).collect()
    pdf = skewed.toPandas()
    groups = {(): pdf} if not by else {(k,): g for k, g in pdf.groupby("k")}
    assert len(got) == len(groups) * len(probs)
    for r in got:
        values = groups[tuple(r[c] for c in by)]["v"]
        assert math.isclose(r["q"], np.quantile(values, r["p"]), abs_tol=1e-9)


def test_global_position(skewed):
    got = scale.global_position(skewed.select("v", "i"), ["v", "i"], "pos").collect()
    assert [(r["v"], r["i"]) for r in sorted(got, key=lambda r: r["pos"])] == sorted((r["v"], r["i"]) for r in got)
    assert sorted(r["pos"] for r in got) == list(range(1, 3001))


def test_average_ranks(skewed):
    got = {r["i"]: r["rank"] for r in scale.average_ranks(skewed, ["k"], "v", F.floor("v"), "rank").collect()}
    pdf = skewed.toPandas()
    pdf["want"] = pdf.groupby("k")["v"].rank()
    assert all(got[i] == w for i, w in zip(pdf["i"], pdf["want"]))


def test_bh_equals_loop(spark):
    rnd = random.Random(5)
    p = [round(rnd.random() ** 3, 2) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(p)], "i int, p double")
    got = {r["i"]: r["q"] for r in markers.bh_adjust(df, "p").collect()}
    order = sorted(range(300), key=lambda i: (p[i], i))
    best = float("inf")
    for rank in range(300, 0, -1):
        i = order[rank - 1]
        best = min(best, p[i] * 300 / rank)
        # the loop gives tied p-values one value as well: that of their last rank
        assert math.isclose(got[i], best, rel_tol=1e-12)


def _vectors(n, dim, seed, centres=5):
    rng = np.random.RandomState(seed)
    base = rng.normal(size=(centres, dim)) * 4
    return base[rng.randint(0, centres, n)] + rng.normal(size=(n, dim))


def _brute(v, k):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return [sorted(range(len(v)), key=lambda j: (d[i, j], j))[:k] for i in range(len(v))]


@pytest.mark.parametrize("copies", [0, 60])
def test_knn_is_exact_over_many_tiles(spark, copies):
    v = _vectors(220, 6, 1)
    v[:copies] = v[0]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "cell_id long, vec array<double>")
    rows = neighbors.knn(df, 7, tile_rows=16).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["cell_id"], r["rank"])):
        got.setdefault(r["cell_id"], []).append(r["nbr_id"])
    assert [got[i] for i in range(220)] == _brute(v, 7)


def test_knn_probe_recall(spark):
    v = _vectors(400, 6, 2, centres=8)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "cell_id long, vec array<double>")
    got = {(r["cell_id"], r["nbr_id"]) for r in neighbors.knn(df, 5, probe=6, tile_rows=32).collect()}
    want = {(i, j) for i, row in enumerate(_brute(v, 5)) for j in row}
    assert len(got & want) / len(want) >= 0.9


@pytest.mark.parametrize("hub_rows", [3, 10_000])
def test_snn_equals_counting(spark, hub_rows):
    rng = np.random.RandomState(4)
    near = []
    for i in range(120):
        # cell 0 is everyone's neighbour
        others = [0] * (i != 0) + [int(j) for j in rng.permutation(120) if j not in (0, i)]
        near += [(i, j, rank + 1) for rank, j in enumerate(others[:5])]
    df = spark.createDataFrame(near, "cell_id long, nbr_id long, rank int")
    got = {(r["src"], r["dst"]): r["w"] for r in neighbors.snn(df, k=6, hub_rows=hub_rows).collect()}
    sets = {i: {i} | {j for c, j, _ in near if c == i} for i in range(120)}
    want = {}
    for a in range(120):
        for b in range(a + 1, 120):
            s = len(sets[a] & sets[b])
            if s / (12 - s) >= 1 / 15:
                want[a, b] = s / (12 - s)
    assert got == want


def test_snn_weights_take_the_published_values(edges):
    """With k = 10 a weight is s / (20 - s) for 2 to 10 shared neighbours."""
    allowed = {s / (20 - s) for s in range(2, 11)}
    assert {r["w"] for r in edges.select("w").distinct().collect()} <= allowed


@pytest.mark.parametrize("block", [7, 4096])
def test_smoothing_is_independent_of_blocks(spark, block):
    rng = np.random.RandomState(6)
    x = [round(float(v), 3) for v in np.concatenate([rng.normal(size=60), np.zeros(40), rng.normal(size=30) * 5])]
    df = spark.createDataFrame([("g", i + 1, v) for i, v in enumerate(x)], "gene_id string, pos long, x double")
    mean = {r["pos"]: r["x"] for r in series.moving_average(df, 9, block=block).collect()}
    soft = {r["pos"]: r["x"] for r in series.adaptive_moving_average(df, 10, 2, 3.0, block=block).collect()}
    for i in range(len(x)):
        assert math.isclose(mean[i + 1], np.mean(x[max(0, i - 9): i + 10]), abs_tol=1e-9)
        sd = np.std(x[max(0, i - 10): i + 11], ddof=1)
        half = 2 + round(3.0 / (sd + 0.1))
        assert math.isclose(soft[i + 1], np.mean(x[max(0, i - half): i + half + 1]), abs_tol=1e-9)


def test_rank_sum_equals_dense_ranks(spark):
    import pandas as pd

    rng = np.random.RandomState(7)
    dense = rng.poisson(0.7, size=(60, 4)).astype(float)
    labels = ["a" if i % 3 else "b" for i in range(60)]
    cells = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "cell_id long, label string")
    expr = spark.createDataFrame(
        [(i, g, float(np.log1p(dense[i, g]))) for i in range(60) for g in range(4) if dense[i, g]], "cell_id long, gene_id long, x double"
    )
    got = {(r["cluster"], r["gene"]): r["z"] for r in markers.markers_one_vs_rest(expr, cells, "label", 0.0, 0.0).collect()}
    for g in range(4):
        ranks = pd.Series(dense[:, g]).rank().to_numpy()
        ties = pd.Series(dense[:, g]).value_counts().to_numpy()
        mine = np.array([v == "b" for v in labels])
        n1, n2 = mine.sum(), (~mine).sum()
        u = ranks[mine].sum() - n1 * (n1 + 1) / 2 - n1 * n2 / 2
        sd = np.sqrt(n1 * n2 / 12 * (61 - (ties**3 - ties).sum() / (60 * 59)))
        assert math.isclose(got["b", g], (u - 0.5 * np.sign(u)) / sd, abs_tol=1e-9)


def test_hot_cell_does_not_change_normalising(tables, monkeypatch):
    want = {(r[0], r[1]): r[3] for r in qc.log_normalise(tables.counts).collect()}
    monkeypatch.setattr(scale, "HOT_ROWS", 3)
    got = {(r[0], r[1]): r[3] for r in qc.log_normalise(tables.counts).collect()}
    assert got == want


def test_missing_column_raises(tables):
    with pytest.raises(ValueError, match="missing columns"):
        qc.downsample_per_label(tables.cells, "nothing", 3, 1)


def spread_values(kind):
    rng = np.random.RandomState(6)
    if kind == "outlier":
        return np.r_[rng.uniform(size=5000), 1e12]
    if kind == "tiny p":
        return rng.uniform(size=5000) / 1000
    return np.r_[rng.uniform(size=2500) * 1e-9, -rng.uniform(size=2500) * 1e9]


@pytest.mark.parametrize("kind", ["outlier", "tiny p", "two scales"])
def test_pieces_follow_the_values(spark, kind, monkeypatch):
    monkeypatch.setattr(scale, "PIECE_ROWS", 100)
    x = spread_values(kind)
    rows = [("g", i, float(v)) for i, v in enumerate(x)] + [("few", i, float(i)) for i in range(20)] + [("one", 0, 3.0)]
    df = spark.createDataFrame(rows, "k string, i long, v double").repartition(5)
    got = scale.in_pieces(df, ["k"], "v").collect()
    own = sorted((r["v"], r["_piece"]) for r in got if r["k"] == "g")
    assert [p for _, p in own] == sorted(p for _, p in own)
    sizes = np.bincount([p for _, p in own])
    assert sizes.max() <= 2 * len(x) / 50 and {r["_piece"] for r in got if r["k"] != "g"} == {0}
    q = {(r["k"], r["p"]): r["q"] for r in scale.quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 0.999, 1.0]).collect()}
    for p in (0.0, 0.25, 0.5, 0.999, 1.0):
        assert q["g", p] == pytest.approx(np.quantile(x, p), rel=1e-12) and q["few", p] == pytest.approx(19 * p)
    ranks = {r["i"]: r["r"] for r in scale.average_ranks(df.where("k = 'g'"), ["k"], "v", None, "r").collect()}
    assert [ranks[i] for i in range(len(x))] == (x.argsort().argsort() + 1).tolist()


def test_bh_of_small_p_values(spark, monkeypatch):
    from tallyweave.operators.markers import bh_adjust

    monkeypatch.setattr(scale, "PIECE_ROWS", 100)
    p = np.round(spread_values("tiny p")[:1500], 6)
    got = {r["i"]: r["q"] for r in bh_adjust(spark.createDataFrame([(i, float(v)) for i, v in enumerate(p)], "i long, p double"), "p").collect()}
    order = np.argsort(p)
    want = np.empty(len(p))
    want[order] = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    for v in np.unique(p):  # ties share the last rank's value
        want[p == v] = want[p == v].min()
    assert np.allclose([got[i] for i in range(len(p))], want)
