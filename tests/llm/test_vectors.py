"""Operators on embeddings beside brute-force versions."""

from collections import Counter

import numpy as np
import pytest

from tallyweave.llm import crosspolytope, multiindex

SCHEMA = "vec_id long, embedding array<float>, node long"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 24))
    x[300:600] = x[rng.integers(0, 40, 300)] + 0.12 * rng.normal(size=(300, 24))
    x[650:] = x[0]
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def table(spark, vectors):
    odd = [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, [None, *[1.0] * 23], 1), (9005, [float("inf"), *[1.0] * 23], 1), (9006, [], 1), (9007, [1.0, 2.0], 1)]
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)] + odd, SCHEMA).repartition(3)


@pytest.mark.parametrize("block", [2048, 16])  # the second deals large buckets into blocks
def test_links_and_components(spark, table, vectors, monkeypatch, block):
    monkeypatch.setattr(crosspolytope, "BLOCK", block)
    x = vectors.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min(label[i], label[near[i]].min(initial=len(x))) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    got = {r["vec_id"]: r for r in crosspolytope.near_vectors(table).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.99 * near.sum()
    assert np.mean([got[i]["component_id"] == label[i] for i in range(len(x))]) > 0.99
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(9001, 9008))
    assert crosspolytope.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_and_null_ids(spark, vectors):
    v = vectors[0].tolist()
    got = crosspolytope.near_vectors(spark.createDataFrame([(5, v, 0), (5, v, 0), (None, v, 0), (7, vectors[1].tolist(), 0)], SCHEMA)).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter([(5, 2, 5), (5, 2, 5), (None, 2, 5), (7, 0, 7)])


def test_nearest_recall_and_order(spark, table, vectors):
    x = vectors.astype(float) * 3
    scaled = table.selectExpr("vec_id", "transform(embedding, x -> x * 3) AS embedding", "node")
    got = multiindex.nearest(scaled).collect()
    hit = total = 0
    for q in range(0, len(x), 20):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(r["score"], -r["vec_id"]) for r in mine] == sorted(((r["score"], -r["vec_id"]) for r in mine), reverse=True)
        score = x @ x[q]
        assert all(abs(score[r["vec_id"]] - r["score"]) < 1e-5 for r in mine)
        score[q] = -np.inf
        least = np.sort(score)[-20]
        hit += sum(r["score"] >= least - 1e-5 for r in mine)
        total += 20
    assert hit >= 0.95 * total
    assert {r["query_id"] for r in got} == set(range(0, 700, 20))
    assert multiindex.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_few_rows_and_ties(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [1.0, 1.0], 0), (3, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)]
    got = multiindex.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0] == [(20, 1.0), (2, 0.5), (3, 0.5)]


def test_pigeonhole_meets_every_code_in_the_radius(spark, vectors):
    words = np.random.default_rng(1).integers(-(2**62), 2**62, (200, multiindex.WORDS))
    data = [(i, vectors[i].astype(float).tolist(), w.tolist()) for i, w in enumerate(words)]
    df = spark.createDataFrame(data, "node long, vector array<double>, words array<long>")
    radius = 120
    got = {(r["query"], r["node"]) for r in multiindex.search(df, df.filter("node < 10"), radius, 200, 200, 10).collect()}
    codes = words.view(np.uint64)
    far = np.bitwise_count(codes[:10, None, :] ^ codes[None]).sum(2)
    assert got == {(i, j) for i in range(10) for j in range(200) if i != j and far[i, j] <= radius}
