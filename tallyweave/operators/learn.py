"""Classifiers on expression features, their reports, and agreement of labelings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType

from ..functions.formulas import ratio
from .hinge import fit_machines, pack, right_shares
from .scale import global_position, join_hot, lookup_join, materialise, require
from .ward import cut_tree, ward_tree


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of an RBF kernel, so that a linear machine separates like a kernel machine."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=1e-3, size=128, seed=1):
        super().__init__()
        self._setDefault(gamma=1e-3, size=128, seed=1)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, size, seed = (self.getOrDefault(p) for p in (self.gamma, self.size, self.seed))

        def wave(batch):
            import numpy as np
            import pandas as pd

            x = np.stack(batch.to_numpy()) if len(batch) else np.empty((0, 1))
            draw = np.random.RandomState(seed)
            w = draw.normal(scale=np.sqrt(2 * gamma), size=(x.shape[1], size))
            b = draw.uniform(0, 2 * np.pi, size)
            return pd.Series(list(np.sqrt(2.0 / size) * np.cos(x @ w + b)))

        spread = F.pandas_udf(wave, "array<double>")
        arrays = spread(vector_to_array(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(arrays))


def feature_matrix(expr: DataFrame, cells: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cell_id, features), and the listed genes without any value.

    ``features`` is a sparse vector as a struct: its ``size`` and, in gene-id order, the places ``at`` from 0 and values ``to`` of what
    the cell holds; everything else is zero.  Any number of genes will do: no row is wider than its cell."""
    index = materialise(global_position(genes.select("gene_id").distinct(), ["gene_id"], "_pos"))
    size = index.count()
    index = index.select("gene_id", (F.col("_pos") - 1).cast("int").alias("at"))
    held = lookup_join(expr.select("cell_id", "gene_id", "x"), index, ["gene_id"], "inner")
    stored = held.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("at", F.col("x").cast("double").alias("to")))).alias("_e"))
    entries = F.coalesce("_e", F.array().cast("array<struct<at:int,to:double>>"))
    features = F.struct(F.lit(size).alias("size"), entries["at"].alias("at"), entries["to"].alias("to"))
    vectors = cells.select("cell_id").join(stored, "cell_id", "left").select("cell_id", features.alias("features"))
    missing = genes.select("gene_id").distinct().join(expr.select("gene_id").distinct(), "gene_id", "left_anti")
    return vectors, missing


def with_vector(rows: DataFrame) -> DataFrame:
    """Add ``vector``, the machine-learning vector of ``features``: an array, or a sparse one as :func:`feature_matrix` gives it."""
    if isinstance(rows.schema["features"].dataType, ArrayType):
        return rows.withColumn("vector", array_to_vector("features"))
    sparse = F.udf(lambda f: Vectors.sparse(f["size"], f["at"], f["to"]), VectorUDT())
    return rows.withColumn("vector", sparse("features"))


def split_train_test(rows: DataFrame, test: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """A reproducible split by the md5 of the cell id."""
    from ..functions.formulas import hash_int

    part = hash_int(F.concat(F.col("cell_id").cast("string"), F.lit(f"|{seed}"))) / F.lit(float(1 << 32))
    return rows.where(part >= test), rows.where(part < test)


def linear_machine(svm, coefficients: np.ndarray, intercept: float):
    """The model that ``svm`` would be with these coefficients."""
    from pyspark.ml.classification import LinearSVCModel
    from pyspark.ml.common import _py2java

    sc = SparkSession.active().sparkContext
    made = sc._jvm.org.apache.spark.ml.classification.LinearSVCModel(svm.uid, _py2java(sc, Vectors.dense(coefficients)), float(intercept))
    return svm._copyValues(LinearSVCModel(made))


def train_classifier(
    rows: DataFrame, test: float = 0.3, cost: tuple[float, ...] = (10.0,), gamma: float = 1e-3, folds: int = 5,
    share: float = 0.8, size: int = 128, seed: int = 1,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on ``rows(cell_id, features, label)``: PCA to ``share`` of the variance, Fourier features, linear SVM.

    Splits before anything is fitted; of several costs one is picked by cross-validation.  Rows without a label are left
    out.  Returns the model and its predictions (cell_id, actual, predicted) on the held-out cells.
    """
    from pyspark.ml.classification import LinearSVC, OneVsRest, OneVsRestModel
    from pyspark.ml.feature import PCA, IndexToString, StringIndexer, VectorSlicer

    require(rows, "cell_id", "features", "label")
    rows = materialise(rows.select("cell_id", "features", "label").where("label IS NOT NULL"))
    train, held = split_train_test(rows, test, seed)
    train, held = with_vector(train), with_vector(held)
    names = StringIndexer(inputCol="label", outputCol="target", stringOrderType="alphabetAsc").fit(train)
    n = train.count()
    width = with_vector(rows).select("vector").first()[0].size if n else 0
    if not width:
        raise ValueError("no labelled cells, or no genes to train on")
    reduce = PCA(k=width, inputCol="vector", outputCol="every_pc").fit(materialise(train.select("vector")))
    k = min(int(np.searchsorted(np.cumsum(reduce.explainedVariance.toArray()), share)) + 1, width)
    first = VectorSlicer(inputCol="every_pc", outputCol="pc", indices=list(range(k)))
    wave = FourierFeatures(inputCol="pc", outputCol="waves", gamma=gamma, size=size, seed=seed)
    shown = lambda df: wave.transform(first.transform(reduce.transform(df)))
    penalty, classes = 1.0 / (cost[0] * n), range(len(names.labels))
    target = names.transform(train)
    if len(cost) > 1:
        draw = lambda i: F.col("draw") >= i * (1.0 / folds)
        ready = materialise(shown(target).select("cell_id", "waves", "target")).withColumn("draw", F.rand(seed))
        tiles = pack(ready.withColumns({"fold": sum(draw(i).cast("int") for i in range(1, folds)) if folds > 1 else F.lit(0), "one": F.lit(1.0)}), "waves", "target", "fold", "one")
        tried = [(c, f, 1.0 / (x * n)) for x in cost for f in range(folds) for c in classes]
        right = right_shares(tiles, tried, fit_machines(tiles, tried, size, folds), len(classes))
        penalty = 1.0 / (cost[int(np.argmax([np.mean([right[f, 1.0 / (x * n)] for f in range(folds)]) for x in cost]))] * n)
    else:  # equal rows count as often as they come
        some = target.groupBy("features", "target").agg(F.count(F.lit(1)).cast("double").alias("times"))
        tiles = pack(shown(with_vector(some)).withColumn("fold", F.lit(0)), "waves", "target", "fold", "times")
    fitted = fit_machines(tiles, [(c, -1, penalty) for c in classes], size, folds if len(cost) > 1 else 1)
    svm = LinearSVC(featuresCol="waves", labelCol="target", maxIter=20, standardization=False, regParam=penalty)
    many = OneVsRest(classifier=svm, featuresCol="waves", labelCol="target", predictionCol="prediction", parallelism=1)
    machine = many._copyValues(OneVsRestModel(models=[linear_machine(svm, *m) for m in fitted]))
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=names.labels)
    model = PipelineModel([reduce, first, wave, machine, back])
    report = model.transform(held).select("cell_id", F.col("label").alias("actual"), "predicted")
    return model, report


def marker_features(expr: DataFrame, cells: DataFrame, label: str, markers: DataFrame, top: int = 20) -> DataFrame:
    """rows(cell_id, features, label) on the union of the top markers of every label."""
    from .markers import top_markers

    genes = top_markers(markers, top).select(F.col("gene").alias("gene_id")).distinct()
    vectors, _ = feature_matrix(expr, cells, genes)
    return vectors.join(cells.select("cell_id", F.col(label).alias("label")), "cell_id")


def train_cell_classifier(expr, cells, label, markers, **options) -> tuple[PipelineModel, DataFrame]:
    """Classifier of cell labels on marker genes; drop doublets from ``cells`` first."""
    return train_classifier(marker_features(expr, cells, label, markers), **options)


def train_doublet_classifier(
    counts: DataFrame, cells: DataFrame, lane: str, seed: int = 1, genes: DataFrame | None = None, **options
) -> tuple[PipelineModel, DataFrame]:
    """Classifier of simulated doublets on ``genes``, the variable ones if not given; a third is held out."""
    from . import doublets, qc

    mixed, labels = doublets.simulate_doublets(counts, cells, lane, seed)
    expr, labels = materialise(qc.log_normalise(mixed)), materialise(labels)
    genes = genes if genes is not None else qc.selected_genes(qc.variable_genes_mvp(expr, labels))
    vectors, _ = feature_matrix(expr, labels, genes)
    options = {"test": 0.33, "cost": (1.0, 10.0, 100.0, 300.0), "folds": 3, **options}
    return train_classifier(vectors.join(labels.select("cell_id", "label"), "cell_id"), seed=seed, **options)


def available_classifiers(spark: SparkSession, folder: str) -> list[str]:
    """Names of the models saved under ``folder``."""
    try:
        files = spark.read.text(f"{folder.rstrip('/')}/*/metadata").select("_metadata.file_path").distinct()
    except AnalysisException:
        return []
    return sorted({r[0].split("/")[-3] for r in files.collect()})  # one row per model


def apply_classifier(rows: DataFrame, folder: str, name: str, out_col: str) -> DataFrame | None:
    """Add the labels a saved model predicts; an unknown name prints the available ones and gives None."""
    spark = rows.sparkSession
    known = available_classifiers(spark, folder)
    if name not in known:
        print(f"no classifier {name!r}; available: {known}")
        return None
    model = PipelineModel.load(f"{folder.rstrip('/')}/{name}")
    out = model.transform(with_vector(rows))
    return out.select(*rows.columns, F.col("predicted").alias(out_col))


def classification_report(pred: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) per actual class, and the support-weighted ``avg / total``."""
    tally = pred.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    rows = tally.groupBy(F.col("actual").alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    said = tally.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("said"))
    both = rows.join(said, "class", "left")
    precision = F.coalesce(F.col("tp") / F.col("said"), F.lit(0.0))
    recall = F.col("tp") / F.col("support")
    both = both.select("class", precision.alias("precision"), recall.alias("recall"), "support")
    total = F.col("precision") + F.col("recall")
    both = both.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), total, 0.0))
    mean = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    overall = both.agg(F.lit("avg / total").alias("class"), mean("precision"), mean("recall"), mean("f1"), F.sum("support").alias("support"))
    columns = ["class", "precision", "recall", "f1", "support"]
    return both.select(*columns).unionByName(overall.select(*columns))


def confusion_matrix(pred: DataFrame, normalise: str | None = "predicted") -> DataFrame:
    """(actual, predicted, n, freq): counts over the total of the ``normalise`` axis."""
    tally = pred.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    if normalise is None:
        return tally.withColumn("freq", F.col("n").cast("double"))
    total = F.sum("n").over(Window.partitionBy(normalise))  # one row per class
    return tally.withColumn("freq", F.col("n") / F.when(total == 0, 1).otherwise(total))


def class_weights(cells: DataFrame, label: str) -> DataFrame:
    """(class, weight): N / (K * n_class)."""
    sizes = cells.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return sizes.withColumn("_t", whole).select("class", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight"))


def frequency_guess(cells: DataFrame, label: str) -> DataFrame:
    """One row (accuracy): expected accuracy of guessing labels by their frequency."""
    sizes = cells.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg((F.sum(F.col("n").cast("double") * F.col("n")) / (F.sum("n").cast("double") * F.sum("n"))).alias("accuracy"))


def discriminatory_power(rows: DataFrame, genes: list, trees: int = 500, test: float = 0.3, min_split: int = 5, depth: int = 10, seed: int = 1):
    """Random forest on ``rows(cell_id, features, label)``: held-out predictions and (gene, importance).

    Classes are weighted by N / (K * n_class) of the training cells.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import IndexToString, StringIndexer

    rows = materialise(rows.select("cell_id", "features", "label").where("label IS NOT NULL"))
    train, held = split_train_test(rows, test, seed)
    names = StringIndexer(inputCol="label", outputCol="target", stringOrderType="alphabetAsc").fit(train)
    weights = class_weights(train, "label").withColumnRenamed("class", "label")
    train = with_vector(lookup_join(train, weights, ["label"], "inner"))
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="target", weightCol="weight", numTrees=trees, impurity="gini", maxDepth=depth,
        minInstancesPerNode=max(1, min_split // 2), seed=seed,
    ).fit(names.transform(train))
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=names.labels)
    scored = back.transform(forest.transform(with_vector(held)))
    importance = rows.sparkSession.createDataFrame(
        [(g, float(v)) for g, v in zip(genes, forest.featureImportances.toArray())], ["gene", "importance"]
    )
    return scored.select("cell_id", F.col("label").alias("actual"), "predicted"), importance


def gmm(emb: DataFrame, k: int, seed: int = 52) -> DataFrame:
    """(cell_id, cluster, probability array): full-covariance Gaussian mixture."""
    from pyspark.ml.clustering import GaussianMixture

    rows = materialise(emb.select("cell_id", array_to_vector("vec").alias("features")))
    model = GaussianMixture(k=k, seed=seed, maxIter=30).fit(rows)
    return model.transform(rows).select(
        "cell_id", F.col("prediction").cast("long").alias("cluster"), vector_to_array("probability").alias("probability")
    )


def agglomerative(emb: DataFrame, k: int, neighbours: int = 15) -> DataFrame:
    """(cell_id, cluster): ``k`` clusters of Ward's tree on the graph of nearest ``neighbours`` (:mod:`.ward`)."""
    return cut_tree(emb, materialise(ward_tree(emb, neighbours)), k)


def voted_labels(cells: DataFrame, truth: str, pred: str) -> DataFrame:
    """Add ``voted``: the most frequent true label of each predicted cluster, the smallest on ties."""
    tally = cells.groupBy(pred, truth).agg(F.count(F.lit(1)).alias("n"))
    best = tally.groupBy(pred).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(truth).alias("v")))["v"].alias("voted"), F.sum("n").alias("_rows"))
    return join_hot(cells, best, [pred], "_rows")


def _table(cells: DataFrame, a: str, b: str) -> DataFrame:
    return cells.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def adjusted_rand_index(cells: DataFrame, a: str, b: str) -> DataFrame:
    """One row (ari)."""
    pairs = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    table = _table(cells, a, b)
    joint = table.agg(F.struct(pairs("n").alias("p"), F.sum("n").alias("n")).alias("t")).scalar()
    rows = table.groupBy("a").agg(F.sum("n").alias("m")).agg(pairs("m").alias("p")).scalar()
    one = table.groupBy("b").agg(F.sum("n").alias("m")).agg(pairs("m").alias("q"))
    out = one.withColumn("t", joint).withColumn("p", rows)
    chance = F.col("p") * F.col("q") / (F.col("t.n") * (F.col("t.n") - 1) / 2)
    return out.select(ratio(F.col("t.p") - chance, (F.col("p") + F.col("q")) / 2 - chance, 1.0).alias("ari"))


STRIDE = 4096
"""Overlaps that are looked at together."""


def expected_information(na: int, nb: int, n: int) -> float:
    """Expected m / n * ln(n m / (na nb)) of the overlap m of two random groups of these sizes among n.

    The overlap's weights relative to its mode follow from their ratios, outwards from the mode until they vanish; their own sum
    normalises them.  The work is a few standard deviations of the overlap.
    """
    low, high = max(0, na + nb - n), min(na, nb)
    mode = min(high, max(low, (na + 1) * (nb + 1) // (n + 2)))
    term = lambda m: m / n * np.log(np.maximum(m, 1.0) * (n / na / nb))
    mass, told = 1.0, float(term(np.float64(mode)))
    for step, last in ((1, high), (-1, low)):
        at, log_w = mode, 0.0
        while at != last:
            m = np.arange(at + step, at + step * (min(STRIDE, abs(last - at)) + 1), step, dtype=np.float64)
            up = m if step > 0 else m + 1  # the larger of each two neighbours
            ratio_up = np.log(na - up + 1) + np.log(nb - up + 1) - np.log(up) - np.log(n - na - nb + up)
            logs = log_w + step * np.cumsum(ratio_up)
            w = np.exp(logs)
            mass, told = mass + float(w.sum()), told + float(w @ term(m))
            at, log_w = int(m[-1]), float(logs[-1])
            if w[-1] < 1e-20:
                break
    return told / mass


def adjusted_mutual_info(cells: DataFrame, a: str, b: str) -> DataFrame:
    """One row (mi, ami), normalised by the larger entropy.  The expected information is summed over pairs of group sizes."""
    table = materialise(_table(cells, a, b))
    total = int(table.agg(F.sum("n")).first()[0] or 0)
    n = F.lit(float(total))
    side = {c: table.groupBy(c).agg(F.sum("n").alias(f"n{c}")) for c in ("a", "b")}
    entropy = lambda c: side[c].agg((-F.sum(F.col(f"n{c}") / n * F.log(F.col(f"n{c}") / n))).alias("h")).scalar()
    both = lookup_join(lookup_join(table, side["a"], ["a"], "inner"), side["b"], ["b"], "inner")
    information = F.col("n") / n * F.log(n * F.col("n") / (F.col("na") * F.col("nb")))
    mi = both.agg(F.sum(information).alias("mi"))
    # group sizes repeat, so pairs of sizes are counted instead of pairs of groups
    sizes = {c: side[c].groupBy(f"n{c}").agg(F.count(F.lit(1)).alias(f"k{c}")) for c in ("a", "b")}
    others = sizes["b"].agg(F.collect_list(F.struct("nb", "kb")).alias("l")).scalar()
    pairs = sizes["a"].select("na", "ka", F.explode(others).alias("o"))
    pairs = pairs.select(F.col("na").cast("long").alias("na"), F.col("o.nb").cast("long").alias("nb"), (F.col("ka") * F.col("o.kb")).alias("k")).repartition("na", "nb")

    def expect(batches):
        for batch in batches:
            na, nb, k = (c.to_pylist() for c in batch.columns)
            e = [times * expected_information(x, y, total) for x, y, times in zip(na, nb, k)]
            yield pa.record_batch([pa.array(e, pa.float64())], names=["e"])

    emi = pairs.mapInArrow(expect, "e double").agg(F.sum("e").alias("e")).scalar()
    out = mi.withColumns({"e": emi, "h": F.greatest(entropy("a"), entropy("b"))})
    return out.select("mi", ratio(F.col("mi") - F.col("e"), F.col("h") - F.col("e"), 1.0).alias("ami"))
