"""Ward clustering beside the one-by-one procedure."""

import numpy as np
import pytest

from tallyweave.operators import ward


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "cell_id long, vec array<double>")


def parts(df):
    sets = {}
    for r in df.collect():
        sets.setdefault(r["cluster"], set()).add(r["cell_id"])
    return {frozenset(s) for s in sets.values()}


def one_by_one(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        cost = {}
        for i, a in enumerate(groups):
            for j in range(i):
                b = groups[j]
                cost[i, j] = len(a) * len(b) / (len(a) + len(b)) * np.sum((x[a].mean(0) - x[b].mean(0)) ** 2)
        i, j = min(cost, key=cost.get)
        groups[j] += groups.pop(i)
    return {frozenset(g) for g in groups}


def test_all_neighbours_give_the_one_by_one_tree(spark):
    x = np.random.default_rng(4).normal(size=(36, 3))
    emb = frame(spark, x)
    tree = ward.materialise(ward.ward_tree(emb, 35))
    assert tree.count() == 35 and tree.select("hi").distinct().count() == 35
    for k in (1, 2, 5, 11):
        assert parts(ward.cut_tree(emb, tree, k)) == one_by_one(x, k)


def test_falling_apart_copies_and_few_cells(spark):
    rng = np.random.default_rng(7)
    far = np.concatenate([rng.normal(size=(12, 2)) + c for c in ((0, 0), (100, 0), (0, 300))])
    x = np.concatenate([far, np.repeat(far[:1], 20, 0)])
    emb = frame(spark, x)
    tree = ward.materialise(ward.ward_tree(emb, 3))
    blobs = [frozenset([*range(12), *range(36, 56)]), frozenset(range(12, 24)), frozenset(range(24, 36))]
    assert parts(ward.cut_tree(emb, tree, 3)) == set(blobs)
    assert parts(ward.cut_tree(emb, tree, 2)) == {blobs[0] | blobs[1], blobs[2]}
    assert parts(ward.cut_tree(emb, tree, 36)) == {frozenset([0, *range(36, 56)])} | {frozenset([i]) for i in range(1, 36)}
    assert len(parts(ward.cut_tree(emb, tree, 99))) == 56


def test_no_cells_and_wrong_sizes(spark):
    none = frame(spark, np.zeros((0, 2)))
    tree = ward.ward_tree(none)
    assert ward.cut_tree(none, tree, 3).count() == 0
    with pytest.raises(ValueError):
        ward.cut_tree(none, tree, 0)


@pytest.mark.parametrize("name", [int, "cell_{}_of_a_donor_with_a_long_name".format, "c{}".format])
def test_one_task_makes_the_rounds_of_the_jobs(spark, monkeypatch, name):
    rng = np.random.default_rng(5)
    lattice = np.array([(i, j) for i in range(7) for j in range(7)], float)  # equal costs, so ties count
    x = np.concatenate([lattice, rng.normal(size=(40, 2)) * 3, rng.normal(size=(12, 2)) + 500, lattice[:4]])
    kind = "long" if name is int else "string"
    emb = spark.createDataFrame([(name(i), [float(v) for v in row]) for i, row in enumerate(x)], f"cell_id {kind}, vec array<double>")
    rows = lambda: sorted(map(tuple, ward.ward_tree(emb, 4).select("hi", "lo", "h", "round").collect()))
    made, plain = [], ward.materialise
    monkeypatch.setattr(ward, "materialise", lambda df: made.append(1) or plain(df))
    one = rows()
    few = len(made)
    monkeypatch.setattr(ward, "TASK_GROUPS", 30)
    assert rows() == one  # jobs first, one task for the rest
    made.clear()
    monkeypatch.setattr(ward, "TASK_GROUPS", 0)
    assert rows() == one and len(made) > 2 * few


def test_pair_hash_is_the_one_of_the_engine(spark):
    import pyarrow as pa

    pairs = [(0, 1), (-5, 7), (1 << 40, -(1 << 62))]
    names = ["", "a", "abcd", "é" * 5, "x" * 31, "y" * 32, "z" * 77]
    cases = [("long", pairs), ("int", [(0, 1), (-5, 7)]), ("string", [(a, b) for a in names for b in names])]
    for kind, both in cases:
        df = spark.createDataFrame(both, f"lo {kind}, hi {kind}")
        want = [r[0] for r in df.selectExpr("xxhash64(lo, hi)").collect()]
        ids = pa.array([x for p in both for x in p], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind])
        at = np.arange(len(both)) * 2
        assert ward._pair_hash(ids, df.schema["lo"].dataType)(at, at + 1).tolist() == want
