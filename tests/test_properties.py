"""What must hold where SQL cannot say the result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.operators import doublets, graph, learn, neighbors, profile, qc, reduce
from tallyweave.operators.scale import scratch_dir


def test_pca_scores_are_orthogonal(tables):
    scores, loadings = reduce.pca(tables.emb, 8)
    m = np.array([r["vec"] for r in scores.collect()])
    cov = np.cov(m.T)
    raw = np.array([r["vec"] for r in tables.emb.collect()])
    values = np.sort(np.linalg.eigvalsh(np.cov(raw.T)))[::-1][:8]
    assert np.allclose(cov, np.diag(values), atol=1e-9)
    for r in loadings.collect():
        assert max(r["loading"], key=abs) > 0


def test_pca_variance_keeps_enough(tables):
    _, loadings = reduce.pca_variance(tables.emb, 0.8)
    shares = [r["share"] for r in loadings.orderBy("component").collect()]
    assert sum(shares) >= 0.8 > sum(shares[:-1])


def test_louvain_beats_the_given_labels(edges, tables):
    found = graph.louvain(edges, 1.0, rounds=5, levels=3)
    q = graph.modularity(edges, found).first()["q"]
    given = tables.emb_cells.select(F.col("cell_id").alias("node"), F.hash("label").cast("long").alias("community"))
    assert q > graph.modularity(edges, given).first()["q"] and q > 0.3
    inside = {r["community"]: r["m"] for r in found.groupBy("community").agg(F.min("node").alias("m")).collect()}
    assert all(c == m for c, m in inside.items())


def test_overcluster_refines(spark):
    ring = lambda a: [(a + i, a + j, 1.0) for i in range(6) for j in range(i + 1, 6)]
    rows = ring(0) + ring(6) + ring(12) + [(5, 6, 0.2), (11, 12, 0.2)]
    out = graph.overcluster(spark.createDataFrame(rows, "src long, dst long, w double"), rounds=4).collect()
    parents = {}
    for r in out:
        parents.setdefault(r["cluster"], set()).add(r["parent"])
    assert len(out) == 18 and all(len(p) == 1 for p in parents.values())
    assert len({r["parent"] for r in out}) == 3


def test_diffusion_map_solves_the_matrix(near, tables):
    edges = neighbors.gauss_graph(near)
    emb, values = graph.diffusion_map(edges, 6)
    rows = graph.transition(edges).collect()
    ids = {c: i for i, c in enumerate(sorted({r["src"] for r in rows}))}
    t = np.zeros((len(ids), len(ids)))
    for r in rows:
        t[ids[r["src"]], ids[r["dst"]]] = r["t"]
    lam = [r["eigenvalue"] for r in values.orderBy("idx").collect()]
    assert np.allclose(lam, np.sort(np.linalg.eigvalsh(t))[::-1][:6], atol=1e-6)
    v = np.zeros((len(ids), 6))
    for r in emb.collect():
        v[ids[r["cell_id"]]] = r["vec"]
    assert np.abs(t @ v - v * lam).max() < 1e-3 and abs(lam[0] - 1) < 1e-6
    dpt = {r[0]: r[1] for r in graph.diffusion_pseudotime(emb, values, tables.emb_cells, "label", "c0").collect()}
    root = min(r["cell_id"] for r in tables.emb_cells.where("label = 'c0'").collect())
    assert dpt[root] == 0 and max(dpt.values()) == 1


def test_harmony_mixes_batches(spark):
    rng = np.random.RandomState(2)
    rows = []
    for i in range(240):
        kind, batch = i % 2, i % 3
        v = rng.normal(size=5) * 0.3
        v[kind] += 6
        v[4] += 2.0 * batch
        rows.append((i, [float(x) for x in v], f"k{kind}", f"b{batch}"))
    df = spark.createDataFrame(rows, "cell_id long, vec array<double>, kind string, batch string")
    fixed = reduce.harmony(df.select("cell_id", "vec"), df, "batch", clusters=4)

    def same(emb, col):
        pairs = neighbors.knn(emb, 10)
        a = df.select("cell_id", F.col(col).alias("a"))
        b = df.select(F.col("cell_id").alias("nbr_id"), F.col(col).alias("b"))
        return pairs.join(a, "cell_id").join(b, "nbr_id").agg(F.avg((F.col("a") == F.col("b")).cast("double"))).first()[0]

    before, after = same(df.select("cell_id", "vec"), "batch"), same(fixed, "batch")
    assert before > 0.9 and after < before - 0.3
    assert same(fixed, "kind") > 0.95


def test_classifier_saves_and_applies(spark, tables):
    import uuid

    largest = F.array_position(F.slice("vec", 1, 4), F.array_max(F.slice("vec", 1, 4)))
    rows = tables.emb.select("cell_id", F.col("vec").alias("features"), F.concat(F.lit("k"), largest.cast("string")).alias("label"))
    model, report = learn.train_classifier(rows, gamma=0.5, folds=2)
    right = report.agg(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).first()[0]
    most = max(r["count"] for r in rows.groupBy("label").count().collect()) / rows.count()
    assert right > most + 0.1
    folder = f"{scratch_dir(spark)}/models-{uuid.uuid4().hex}"
    model.save(f"{folder}/cells")
    assert learn.apply_classifier(rows, folder, "cells", "p").where("p is null").count() == 0
    assert learn.apply_classifier(rows, folder, "other", "p") is None
    assert learn.available_classifiers(spark, folder) == ["cells"]


def test_discriminatory_power(tables):
    rows = tables.emb.withColumnRenamed("vec", "features").join(tables.emb_cells.select("cell_id", "label"), "cell_id")
    pred, importance = learn.discriminatory_power(rows, list(range(64)), trees=20)
    assert abs(importance.agg(F.sum("importance")).first()[0] - 1) < 1e-6
    assert pred.count() > 100


def test_mixture_probabilities(tables):
    out = learn.gmm(reduce.pca(tables.emb, 5)[0], 4)
    total = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
    low, high = out.agg(F.min(total), F.max(total)).first()
    assert abs(low - 1) < 1e-6 and abs(high - 1) < 1e-6


def test_agglomerative_gives_k(tables):
    assert learn.agglomerative(tables.emb, 6).select("cluster").distinct().count() == 6


@pytest.mark.parametrize("metric", ["euclidean", "spearman"])
def test_gene_order_is_a_permutation(tables, metric):
    prof = profile.mean_expression(tables.expr, tables.cells, "label")
    prof = prof.select("gene_id", F.col("label").alias("col"), F.col("mean").alias("value"))
    out = profile.cluster_gene_order(prof, 4, metric).collect()
    assert sorted(r["position"] for r in out) == list(range(1, len(out) + 1))
    assert len({r["gene_id"] for r in out}) == len(out) == prof.select("gene_id").distinct().count()


@pytest.mark.parametrize("na,nb,n", [(1, 1, 2), (5, 7, 12), (3, 40, 41), (40, 60, 90), (500, 700, 5000), (9000, 20000, 30000), (12, 12, 12)])
def test_expected_information_is_the_hypergeometric_mean(na, nb, n):
    from fractions import Fraction
    from math import comb, log

    every = range(max(0, na + nb - n), min(na, nb) + 1)
    every = [m for m in every if m and (n < 1000 or abs(m - na * nb / n) < 400)]
    want = sum(float(Fraction(comb(nb, m) * comb(n - nb, na - m), comb(n, na))) * m / n * log(n * m / na / nb) for m in every)
    assert learn.expected_information(na, nb, n) == pytest.approx(want, abs=1e-13, rel=1e-9)


def test_expected_information_of_large_groups():
    # large samples: half the degrees of freedom of a cell's chi square, over n
    for n in (10**6, 10**10):
        na, nb = n // 5, n // 4
        cell = [learn.expected_information(x, y, n) for x in (na, n - na) for y in (nb, n - nb)]
        assert sum(cell) == pytest.approx(0.5 / n, rel=0.02 if n < 10**9 else 2.0, abs=1e-12)


def test_mutual_information_of_odd_labelings(spark):
    rows = spark.createDataFrame([(i, "abc"[i % 3], "xyz"[i % 3], "one") for i in range(30)], "cell_id long, p string, q string, r string")
    assert learn.adjusted_mutual_info(rows, "p", "q").first()["ami"] == pytest.approx(1.0)
    assert learn.adjusted_mutual_info(rows, "p", "r").first()["ami"] == pytest.approx(0.0, abs=1e-9)
    assert learn.adjusted_mutual_info(rows, "r", "r").first()["ami"] == 1.0


def test_contingency_margins(tables):
    rows = qc.contingency(tables.cells, "label", "batch").collect()
    total = [r["n"] for r in rows if r["level"] == 3]
    assert total == [1500] and sum(r["n"] for r in rows if r["level"] == 0) == 1500


def test_list_reader_takes_all_line_ends(spark, tmp_path):
    from tallyweave.sources import files

    path = tmp_path / "list.txt"
    path.write_bytes(b"A\rB, C\r\nD\nE\n")
    assert sorted(r[0] for r in files.read_list(spark, str(path), ", ").collect()) == ["A", "B", "C", "D", "E"]


def test_template_reader_sniffs(spark, tmp_path):
    from tallyweave.sources import files

    for sep in ("\t", ","):
        path = tmp_path / f"t{ord(sep)}.csv"
        path.write_text(f"Cluster{sep}Identity\n0{sep}x\n")
        assert files.read_template(spark, str(path)).columns == ["Cluster", "Identity"]


def test_plain_matrix_file(spark, tmp_path):
    from tallyweave.sources import files

    path = tmp_path / "m.mtx"
    path.write_text("%%MatrixMarket matrix coordinate real symmetric\n% note\n3 3 3\n1 1 1\n2 1 0.5\n3 3 1\n")
    got = sorted(tuple(r) for r in files.read_mtx(spark, str(path)).collect())
    assert got == [(1, 1, 1.0), (1, 2, 0.5), (2, 1, 0.5), (3, 3, 1.0)]
    assert files.read_mtx(spark, str(path), mirror=False).count() == 3


def test_sample_folder_of_plain_files(spark, tmp_path):
    from tallyweave.sources import files

    for name in ("one", "two"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n2 3 3\n1 1 4\n2 3 5\n1 2 6\n")
        (folder / "barcodes.tsv").write_text("AA-1\nCC-1\nGG-1\n")
        (folder / "genes.tsv").write_text("e1\tG1\ne2\tG2\n")
    counts, genes = files.read_10x(spark, [(str(tmp_path / "one"), "F1__a"), (str(tmp_path / "two"), "F2_b")])
    got = sorted(tuple(r) for r in counts.collect())
    assert got[:3] == [("F1_a_AA-1", "G1", 4.0), ("F1_a_CC-1", "G1", 6.0), ("F1_a_GG-1", "G2", 5.0)]
    assert len(got) == 6 and genes.count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_10x(spark, [(str(tmp_path / "none"), "x")])


def test_compare_datasets_plan(tables):
    from tallyweave.plans import analyses

    split = {}
    for name, where in (("q", "batch = 'F'"), ("r", "batch <> 'F'")):
        cells = tables.cells.where(where)
        split[name] = (tables.counts.join(cells.select("cell_id"), "cell_id", "left_semi"), cells)
    out = analyses.compare_datasets(split["q"], split["r"], "label", cap=200)
    assert set(out) == {"query_profile", "reference_profile", "correlation"}


def test_marker_plans_have_no_cartesian_product(tables):
    from tallyweave.operators import markers

    plans = [
        qc.log_normalise(tables.counts),
        qc.filter_cells_genes(tables.counts, 3, 2),
        qc.variable_genes_mvp(tables.expr, tables.cells),
        markers.markers_one_vs_rest(tables.expr, tables.cells, "label"),
        profile.mean_expression(tables.expr, tables.cells, "label"),
    ]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_the_needed_columns(tables):
    text = qc.cell_stats(tables.counts)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in text and "l_quantity" in text


def test_louvain_takes_string_ids(spark, edges):
    from tallyweave.operators import graph

    named = edges.selectExpr("concat('cell_', src) AS a", "concat('cell_', dst) AS b", "w").selectExpr("least(a, b) AS src", "greatest(a, b) AS dst", "w")
    got = graph.louvain(named)
    q = graph.modularity(named, got).first()["q"]
    assert got.select("community").distinct().count() > 1 and q > 0.2


def test_read_10x_by_any_path(spark, tmp_path, monkeypatch):
    from tallyweave.sources.files import read_10x

    folder = tmp_path / "a sample+1"
    folder.mkdir()
    (folder / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n2 2 3\n1 1 5\n2 1 1\n2 2 7\n")
    (folder / "barcodes.tsv").write_text("AA\nBB\n")
    (folder / "genes.tsv").write_text("g1\tone\ng2\ttwo\n")
    want = {("s_AA", "one", 5.0), ("s_AA", "two", 1.0), ("s_BB", "two", 7.0)}
    for path in (str(folder), f"file://{folder}", f"{folder}/"):
        counts, _ = read_10x(spark, [(path, "s")])
        assert {(r["cell_id"], r["gene_id"], float(r["n"])) for r in counts.collect()} == want


def test_percent_pattern_counts_a_repeated_gene_once(spark):
    from tallyweave.operators.qc import percent_pattern

    counts = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0)], "cell_id long, gene_id long, n double")
    genes = spark.createDataFrame([(1, "MT-1"), (1, "MT-1"), (2, "X")], "gene_id long, symbol string")
    assert percent_pattern(counts, genes, "^MT-").first()["pct"] == 0.75


def test_normal_tail_far_out(spark):
    from math import erfc, sqrt

    from tallyweave.functions.formulas import two_sided_normal

    rows = spark.createDataFrame([(z,) for z in (0.0, 0.5, 4.0, 10.0, 20.0, -30.0)], "z double").selectExpr("z", f"{two_sided_normal('z')} AS p").collect()
    assert all(abs(r["p"] / erfc(abs(r["z"]) / sqrt(2)) - 1) < 2e-7 for r in rows)


def test_student_and_f_tails_far_out(spark):
    """Beside fine numerical integration of the densities."""
    import math

    from tallyweave.functions.formulas import two_sided_student, upper_f

    def beta(x, a, b):
        r = np.linspace(0, 9, 400_001)
        y = 2 * r * np.exp(-r * r) * np.maximum(1 - x * np.exp(-r * r / a), 1e-300) ** (b - 1)
        area = (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (r[1] - r[0]) / 3
        return math.exp(a * math.log(x) - math.log(a) - math.lgamma(a) - math.lgamma(b) + math.lgamma(a + b)) * area

    ts = [(float(t), float(v)) for t in (0.3, 1, 4, 6, -6, 30) for v in (3, 8, 60, 20_000)]
    got = spark.createDataFrame(ts, "t double, v double").select("t", "v", two_sided_student(F.col("t"), F.col("v")).alias("p")).collect()
    assert all(abs(r["p"] / beta(r["v"] / (r["v"] + r["t"] ** 2), r["v"] / 2, 0.5) - 1) < 1e-6 for r in got)
    fs = [(float(f), float(d)) for f in (0.05, 1, 8, 15, 30, 300) for d in (5, 40, 996, 100_000)]
    got = spark.createDataFrame(fs, "f double, d double").select("f", "d", upper_f(F.col("f"), F.lit(3.0), F.col("d")).alias("p")).collect()
    assert all(abs(r["p"] / beta(r["d"] / (r["d"] + 3 * r["f"]), r["d"] / 2, 1.5) - 1) < 1e-6 for r in got)
    edge = spark.createDataFrame([(0.0,), (None,)], "t double").select(two_sided_student(F.col("t"), F.lit(5.0)).alias("p")).collect()
    assert [r["p"] for r in edge] == [1.0, None]
