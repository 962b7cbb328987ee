"""Classifiers trained on expression, on planted cell kinds and planted doublets."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tallyweave.operators import hinge, learn, markers, qc
from tallyweave.operators.scale import materialise


@pytest.fixture(scope="module")
def planted(spark):
    """(counts, cells): three kinds of cells in one lane, eight marker genes each, twelve genes that tell nothing."""
    rng = np.random.RandomState(8)
    kinds = rng.randint(3, size=240)
    rate = np.full((240, 36), 1.0)
    for k in range(3):
        rate[kinds == k, 8 * k : 8 * k + 8] = 12.0
    n = rng.poisson(rate)
    cells = spark.createDataFrame([(i, f"kind{kinds[i]}" if i else None, "one") for i in range(240)], "cell_id long, label string, lane string")
    stored = [(i, j, int(n[i, j])) for i in range(240) for j in range(36) if n[i, j]]
    return spark.createDataFrame(stored, "cell_id long, gene_id long, n long"), cells


def accuracy(report):
    return report.agg(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).first()[0]


def test_cell_kinds_are_learnt_from_their_markers(spark, planted, tmp_path):
    counts, cells = planted
    expr = qc.log_normalise(counts)
    named = cells.where("label IS NOT NULL")
    found = markers.markers_one_vs_rest(expr, named, "label")
    model, report = learn.train_cell_classifier(expr, cells, "label", found, cost=(1.0, 10.0), folds=2)
    assert accuracy(report) >= 0.95
    assert {r["predicted"] for r in report.select("predicted").distinct().collect()} == {"kind0", "kind1", "kind2"}
    assert report.where("cell_id = 0").isEmpty()  # it has no label
    model.save(str(tmp_path / "kinds"))
    rows = learn.marker_features(expr, cells, "label", found)
    again = learn.apply_classifier(rows, str(tmp_path), "kinds", "said").join(report, "cell_id")
    assert again.where("said <> predicted").isEmpty() and again.count() == report.count()


def test_doublets_of_unlike_cells_are_told_from_singlets(planted):
    counts, cells = planted
    genes = counts.select("gene_id").distinct()
    _, report = learn.train_doublet_classifier(counts, cells, "lane", genes=genes, cost=(10.0, 100.0), folds=2, gamma=1e-2)
    # a third of all pairs join cells of one kind
    assert accuracy(report) >= 0.7
    assert {r["actual"] for r in report.select("actual").distinct().collect()} == {"Singlet", "Doublet"}


def vectors(spark, flat):
    """(features vector, class 0 to 2) of 900 rows; with ``flat`` nearly all are equal.  One feature is constant."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 8))
    x[:, 4] = 0.25
    if flat:
        x[rng.random(900) < 0.95] = 0.1
    kind = (x[:, 0] + 0.3 * rng.normal(size=900) > 0.4).astype(int) + (x[:, 1] > 1)
    rows = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, kind))], "cell_id long, x array<double>, c int")
    return materialise(rows.select("cell_id", array_to_vector("x").alias("waves"), F.col("c").cast("double").alias("target")).repartition(4, "cell_id"))


@pytest.mark.parametrize("flat", [False, True])
def test_machines_in_shared_passes_are_those_of_linear_svc(spark, monkeypatch, flat):
    df = vectors(spark, flat)
    passes, plain = [], hinge._measured
    monkeypatch.setattr(hinge, "_measured", lambda *a: passes.append(1) or plain(*a))
    equal = df.groupBy("waves", "target").agg(F.count(F.lit(1)).cast("double").alias("times")).withColumn("fold", F.lit(0))
    tiles = hinge.pack(equal, "waves", "target", "fold", "times")
    got = hinge.fit_machines(tiles, [(c, -1, 1e-4) for c in range(3)], 8)
    assert len(passes) <= 40  # one by one the searches of a class alone measure up to 400 points
    for c in range(3):
        svm = LinearSVC(featuresCol="waves", labelCol="y", maxIter=20, standardization=False, regParam=1e-4)
        want = svm.fit(df.withColumn("y", (F.col("target") == c).cast("double")))
        assert np.allclose(got[c][0], want.coefficients.toArray(), atol=1e-6) and abs(got[c][1] - want.intercept) < 1e-6


def test_costs_are_judged_as_by_cross_validation(spark):
    df = vectors(spark, False)
    many = OneVsRest(classifier=(svm := LinearSVC(featuresCol="waves", labelCol="target", maxIter=20, standardization=False)), featuresCol="waves", labelCol="target")
    grid = ParamGridBuilder().addGrid(svm.regParam, [1e-4, 0.3]).build()
    judge = MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy")
    want = CrossValidator(estimator=many, estimatorParamMaps=grid, evaluator=judge, numFolds=3, seed=5).fit(df).avgMetrics
    draw = F.col("draw")
    folds = df.withColumn("draw", F.rand(5)).withColumns({"fold": (draw >= 1 / 3).cast("int") + (draw >= 2 / 3).cast("int"), "one": F.lit(1.0)})
    tiles = hinge.pack(folds, "waves", "target", "fold", "one")
    tried = [(c, f, r) for r in (1e-4, 0.3) for f in range(3) for c in range(3)]
    right = hinge.right_shares(tiles, tried, hinge.fit_machines(tiles, tried, 8, 3), 3)
    assert np.allclose([np.mean([right[f, r] for f in range(3)]) for r in (1e-4, 0.3)], want, atol=1e-9)
