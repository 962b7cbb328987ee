"""Reduction, classifiers, doublets and agreement of labelings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyweave.functions.formulas import upper_normal
from tallyweave.operators import doublets, learn, markers, qc, reduce, sparse
from tallyweave.operators.scale import materialise, scratch_dir

from .base import CELLS, COUNTS, EMB, EXPR, HVG, query, rounded


@query("pca")
def _(t):
    return reduce.pca(t.emb, 20)[0]


@query("pca_variance")
def _(t):
    return reduce.pca_variance(t.emb, 0.8)[1]


# The spectrum as its power sums, which the covariance matrix C gives as traces of C, CC and CCC.
@query("pca_spectrum", f"""WITH {EMB}, long AS (SELECT cell_id, unnest(range(1, len(vec) + 1)) AS i, unnest(vec) AS x FROM emb),
centred AS (SELECT cell_id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM long),
c AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) / ((SELECT count(*) FROM emb) - 1) AS v FROM centred a JOIN centred b USING (cell_id) GROUP BY 1, 2),
cc AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM c a JOIN c b ON a.j = b.i GROUP BY 1, 2)
SELECT 1 AS power, round(sum(v), 6) AS total FROM c WHERE i = j UNION ALL SELECT 2, round(sum(v), 6) FROM cc WHERE i = j
UNION ALL SELECT 3, round(sum(c.v * cc.v), 6) FROM c JOIN cc ON c.i = cc.j AND c.j = cc.i""")
def _(t):
    loadings = reduce.pca_variance(t.emb, 1.0)[1]
    powers = loadings.select(F.explode(F.array(*[F.struct(F.lit(m).alias("power"), F.pow("eigenvalue", F.lit(float(m))).alias("v")) for m in (1, 2, 3)])).alias("x"))
    return rounded(powers.groupBy("x.power").agg(F.sum("x.v").alias("total")), 6, "total")


# the same for scaled variable genes, zeros and clipping included; unexplained: greatest distance of a score's variance from its eigenvalue
@query("pca_scaled_spectrum", f"""WITH {EXPR}, {CELLS}, {HVG}, nc AS (SELECT CAST(count(*) AS DOUBLE) AS n_all FROM cells),
ms AS (SELECT gene_id, sum(x) / max(n_all) AS m, sqrt((sum(x * x) - sum(x) * sum(x) / max(n_all)) / (max(n_all) - 1)) AS sd FROM expr JOIN hvg USING (gene_id), nc WHERE selected GROUP BY 1),
dev AS MATERIALIZED (SELECT cell_id, gene_id, least(10, (x - m) / sd) - least(10, -m / sd) AS d FROM expr JOIN ms USING (gene_id) WHERE sd > 0),
mean AS MATERIALIZED (SELECT gene_id, sum(d) / max(n_all) AS s FROM dev, nc GROUP BY 1),
g AS MATERIALIZED (SELECT a.gene_id AS i, b.gene_id AS j, sum(a.d * b.d) AS v FROM dev a JOIN dev b USING (cell_id) GROUP BY 1, 2),
c AS MATERIALIZED (SELECT a.gene_id AS i, b.gene_id AS j, (coalesce(v, 0) - n_all * a.s * b.s) / (n_all - 1) AS v FROM mean a CROSS JOIN mean b CROSS JOIN nc LEFT JOIN g ON g.i = a.gene_id AND g.j = b.gene_id)
SELECT round(sum(CASE WHEN i = j THEN v ELSE 0 END), 5) AS variance, round(sum(v * v), 4) AS squares, 0e0 AS unexplained FROM c""")
def _(t):
    chosen = qc.selected_genes(qc.variable_genes_mvp(t.expr, t.cells))
    scores, loadings = sparse.pca(qc.scale_clip(t.expr, t.cells, chosen), share=1.0)
    per = scores.select(F.posexplode("vec").alias("component", "v")).groupBy("component").agg(F.var_samp("v").alias("variance"))
    off = per.join(loadings, "component").agg(F.round(F.max(F.abs(F.col("variance") - F.col("eigenvalue"))), 6).alias("unexplained"))
    out = loadings.agg(F.sum("eigenvalue").alias("variance"), F.sum(F.col("eigenvalue") * F.col("eigenvalue")).alias("squares"))
    return rounded(rounded(rounded(out.withColumn("unexplained", F.coalesce(off.scalar(), F.lit(0.0))), 5, "variance"), 4, "squares"), 6, "unexplained")


@query("harmony")
def _(t):
    return reduce.harmony(t.emb, t.emb_cells, "batch", rounds=3, inner=3)


ADD = lambda a, v: a + v


# every entry of every vector enters the two sums
@query("feature_matrix", f"""WITH {EXPR}, {CELLS}, {HVG}, chosen AS (SELECT gene_id, row_number() OVER (ORDER BY gene_id) AS pos FROM hvg WHERE selected),
s AS (SELECT cell_id, sum(x) AS s, sum(pos * x) AS d FROM expr JOIN chosen USING (gene_id) GROUP BY 1)
SELECT cell_id, (SELECT count(*) FROM chosen) AS width, round(coalesce(s, 0), 5) AS total, round(coalesce(d, 0), 4) AS weighted FROM cells LEFT JOIN s USING (cell_id)""")
def _(t):
    genes = qc.selected_genes(qc.variable_genes_mvp(t.expr, t.cells))
    vectors, _ = learn.feature_matrix(t.expr, t.cells, genes)
    out = vectors.select(
        "cell_id", F.col("features.size").cast("long").alias("width"), F.aggregate("features.to", F.lit(0.0), ADD).alias("total"),
        F.aggregate(F.zip_with("features.at", "features.to", lambda i, v: (i + 1) * v), F.lit(0.0), ADD).alias("weighted"),
    )
    return rounded(rounded(out, 5, "total"), 4, "weighted")


@query("feature_matrix_missing", "SELECT p_partkey AS gene_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem) UNION SELECT max(p_partkey) + 1 FROM part")
def _(t):
    extra = t.genes.agg((F.max("gene_id") + 1).alias("gene_id"))
    return learn.feature_matrix(t.expr, t.cells, t.genes.select("gene_id").unionByName(extra))[1]


def _rows(t):
    """Vectors labelled by the largest of their first four coordinates, which a classifier can learn."""
    first = F.slice("vec", 1, 4)
    largest = F.array_position(first, F.array_max(first)).cast("string")
    return t.emb.select("cell_id", F.col("vec").alias("features"), F.concat(F.lit("k"), largest).alias("label"))


@query("train_classifier")
def _(t):
    return learn.train_classifier(_rows(t), folds=2, gamma=0.5)[1]


@query("train_cell_classifier")
def _(t):
    expr = materialise(t.expr)
    found = markers.markers_one_vs_rest(expr, t.cells, "label", min_pct=0.0, logfc=0.0)
    return learn.train_cell_classifier(expr, t.cells, "label", found)[1]


@query("train_doublet_classifier")
def _(t):
    return learn.train_doublet_classifier(t.counts, t.cells, "lane")[1]


@query("apply_classifier")
def _(t):
    model, _ = learn.train_classifier(_rows(t), folds=2, gamma=0.5, size=64)
    folder = f"{scratch_dir(t.spark)}/models-{uuid.uuid4().hex}"
    model.save(f"{folder}/cells")
    return learn.apply_classifier(_rows(t).drop("label"), folder, "cells", "predicted")


@query("discriminatory_power")
def _(t):
    return learn.discriminatory_power(_rows(t), list(range(64)), trees=50)[1]


# actual against a prediction that errs: the status of an order against that of its neighbour in id order
PRED = "pred AS (SELECT o_orderstatus AS actual, lead(o_orderstatus, 1, 'F') OVER (ORDER BY o_orderkey) AS predicted, o_orderpriority AS label FROM orders)"


def _pred(t):
    o = t.raw("orders")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_orderstatus").alias("predicted"))
    both = o.join(nxt, "o_orderkey", "left").fillna("F", ["predicted"])
    return both.select(F.col("o_orderstatus").alias("actual"), "predicted", F.col("o_orderpriority").alias("label"))


@query("classification_report", f"""WITH {PRED}, r AS (SELECT actual AS class, count(*) AS support, count(*) FILTER (actual = predicted) AS tp FROM pred GROUP BY 1),
s AS (SELECT predicted AS class, count(*) AS said FROM pred GROUP BY 1),
m AS (SELECT class, tp / said AS precision, tp / support AS recall, support FROM r JOIN s USING (class)),
f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM m)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f UNION ALL
SELECT 'avg / total', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""")
def _(t):
    return rounded(learn.classification_report(_pred(t)), 6, "precision", "recall", "f1")


@query("confusion_matrix", f"""WITH {PRED} SELECT actual, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY predicted), 6) AS freq FROM pred GROUP BY 1, 2""")
def _(t):
    return rounded(learn.confusion_matrix(_pred(t)), 6, "freq")


@query("class_weights", f"WITH {CELLS} SELECT label AS class, round((SELECT count(*) FROM cells) / ((SELECT count(DISTINCT label) FROM cells) * count(*)), 9) AS weight FROM cells GROUP BY 1")
def _(t):
    return rounded(learn.class_weights(t.cells, "label"), 9, "weight")


@query("frequency_guess", f"WITH {CELLS}, n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY label) SELECT round(sum(n * n) / (sum(n) * sum(n)), 9) AS accuracy FROM n")
def _(t):
    return rounded(learn.frequency_guess(t.cells, "label"), 9, "accuracy")


DOUBLETS = f"""{COUNTS}, {CELLS}, placed AS (SELECT lane, cell_id, row_number() OVER (PARTITION BY lane ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) - 1 AS at_, count(*) OVER (PARTITION BY lane) AS k FROM cells),
drawn AS (SELECT lane, at_ AS d, tag, CAST(('0x' || substr(md5(CAST(lane AS VARCHAR) || '|' || CAST(at_ AS VARCHAR) || '|5|' || tag), 1, 8)) AS BIGINT) % k AS pick FROM placed, (VALUES ('A'), ('B')) v(tag)),
partners AS (SELECT 'D_' || CAST(w.lane AS VARCHAR) || '_' || CAST(d AS VARCHAR) AS doublet, w.lane, p.cell_id FROM drawn w JOIN placed p ON p.lane = w.lane AND p.at_ = pick)"""


@query("simulate_doublets", f"""WITH {DOUBLETS} SELECT 'S_' || CAST(cell_id AS VARCHAR) AS cell_id, gene_id, n FROM counts
UNION ALL SELECT doublet, gene_id, sum(n) FROM partners JOIN counts USING (cell_id) GROUP BY 1, 2""")
def _(t):
    return doublets.simulate_doublets(t.counts, t.cells, "lane", 5)[0]


@query("doublet_labels", f"""WITH {DOUBLETS} SELECT 'S_' || CAST(cell_id AS VARCHAR) AS cell_id, lane, 'Singlet' AS label FROM cells
UNION ALL SELECT DISTINCT doublet, lane, 'Doublet' FROM partners""")
def _(t):
    return doublets.simulate_doublets(t.counts, t.cells, "lane", 5)[1]


# vectors of two classes as observed and simulated; the score follows from the neighbour share
@query("doublet_neighbour_score", """WITH emb AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
near AS (SELECT a.cell_id, b.cell_id AS nbr_id, row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.vec, b.vec), b.cell_id) AS rank
  FROM emb a JOIN emb b ON a.cell_id <> b.cell_id QUALIFY rank <= 15),
q AS (SELECT cell_id, (count(*) FILTER (nbr_id % 3 <> 0) + 1) / 17e0 AS q FROM near WHERE cell_id % 3 = 0 GROUP BY 1)
SELECT cell_id, round(q * 0.1e0 / 2 / (1 - 0.1e0 - q * (1 - 0.1e0 - 0.05e0)), 6) AS score FROM q""")
def _(t):
    from .neighbors import near

    simulated, observed = t.emb.where("cell_id % 3 <> 0"), t.emb.where("cell_id % 3 = 0")
    return rounded(doublets.doublet_neighbour_score(near(t, 15), simulated, observed, 2, 15), 6, "score")


SCORED = """scored AS (SELECT o_orderkey AS cell_id, o_orderstatus AS sample, CAST(o_custkey % 40 AS BIGINT) AS cluster, o_totalprice / 1e5 AS score FROM orders),
cs AS (SELECT *, median(score) OVER (PARTITION BY sample, cluster) AS cluster_score FROM scored),
md AS (SELECT *, median(cluster_score) OVER (PARTITION BY sample) AS med FROM cs),
sp AS (SELECT sample, median(cluster_score - med) AS mad FROM md WHERE cluster_score > med GROUP BY 1),
zz AS (SELECT *, (cluster_score - med) / (1.4826e0 * mad) AS z FROM md LEFT JOIN sp USING (sample))"""
TESTED = f"""{SCORED}, pp AS (SELECT cell_id, sample, cluster, cluster_score, {upper_normal("z")} AS p FROM zz),
rk AS (SELECT *, rank() OVER (PARTITION BY sample ORDER BY p) + count(*) OVER (PARTITION BY sample, p) - 1 AS r, count(*) OVER (PARTITION BY sample) AS n FROM pp),
tested AS (SELECT *, min(p * n / r) OVER (PARTITION BY sample ORDER BY p DESC) AS bh FROM rk)"""


def _tested(t):
    cells = t.raw("orders").select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_orderstatus").alias("sample"), F.pmod(F.col("o_custkey"), F.lit(40)).alias("cluster"),
        (F.col("o_totalprice") / 1e5).alias("score"),
    )
    return doublets.doublet_cluster_test(cells, "sample", "cluster", "score")


@query("doublet_cluster_test", f"WITH {TESTED} SELECT cell_id, sample, cluster, round(cluster_score, 6) AS cluster_score, round(p, 6) AS p, round(bh, 6) AS bh FROM tested")
def _(t):
    return rounded(_tested(t).select("cell_id", "sample", "cluster", "cluster_score", "p", "bh"), 6, "cluster_score", "p", "bh")


@query("filter_by_pvalue", f"WITH {TESTED} SELECT bh > 0.3 AS kept, count(*) AS n FROM tested GROUP BY 1")
def _(t):
    return doublets.filter_by_pvalue(_tested(t), "bh", 0.3)


@query("doublet_score")
def _(t):
    return doublets.doublet_score(t.counts, t.cells.select("cell_id", "batch"), "batch")


@query("gmm")
def _(t):
    return learn.gmm(reduce.pca(t.emb, 10)[0], 5)


@query("agglomerative")
def _(t):
    return learn.agglomerative(t.emb, 10)


PAIR = "pair AS (SELECT o_orderkey AS cell_id, o_orderpriority AS truth, CAST((o_custkey + o_orderkey) % 7 AS BIGINT) AS pred FROM orders)"


def _pair(t):
    return t.raw("orders").select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("truth"), F.pmod(F.col("o_custkey") + F.col("o_orderkey"), F.lit(7)).alias("pred")
    )


@query("voted_labels", f"""WITH {PAIR}, v AS (SELECT pred, truth AS voted FROM pair GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY pred ORDER BY count(*) DESC, truth) = 1)
SELECT cell_id, truth, pred, voted FROM pair JOIN v USING (pred)""")
def _(t):
    return learn.voted_labels(_pair(t), "truth", "pred")


@query("adjusted_rand_index", f"""WITH {PAIR}, j AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM pair GROUP BY truth, pred)),
a AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM pair GROUP BY truth)),
b AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM pair GROUP BY pred)), t AS (SELECT count(*) * (count(*) - 1) / 2 AS s FROM pair)
SELECT round((j.s - a.s * b.s / t.s) / ((a.s + b.s) / 2 - a.s * b.s / t.s), 9) + 0e0 AS ari FROM j, a, b, t""")
def _(t):
    return rounded(learn.adjusted_rand_index(_pair(t), "truth", "pred"), 9, "ari")


@query("adjusted_mutual_info", f"""WITH {PAIR}, t AS (SELECT truth, pred, CAST(count(*) AS DOUBLE) AS n FROM pair GROUP BY 1, 2), nn AS (SELECT sum(n) AS big FROM t),
a AS (SELECT truth, sum(n) AS na FROM t GROUP BY 1), b AS (SELECT pred, sum(n) AS nb FROM t GROUP BY 1),
mi AS (SELECT sum(n / big * ln(big * n / (na * nb))) AS mi FROM t JOIN a USING (truth) JOIN b USING (pred), nn),
h AS (SELECT greatest((SELECT -sum(na / big * ln(na / big)) FROM a, nn), (SELECT -sum(nb / big * ln(nb / big)) FROM b, nn)) AS h),
e AS (SELECT sum(m / big * ln(big * m / (na * nb)) * exp(lgamma(na + 1) + lgamma(nb + 1) + lgamma(big - na + 1) + lgamma(big - nb + 1) - lgamma(big + 1) - lgamma(m + 1)
  - lgamma(na - m + 1) - lgamma(nb - m + 1) - lgamma(big - na - nb + m + 1))) AS e FROM
  (SELECT na, nb, big, CAST(unnest(range(CAST(greatest(1, na + nb - big) AS BIGINT), CAST(least(na, nb) AS BIGINT) + 1)) AS DOUBLE) AS m FROM a, b, nn))
SELECT round(mi, 9) AS mi, round((mi - e) / (h - e), 8) + 0e0 AS ami FROM mi, h, e""")
def _(t):
    return rounded(rounded(learn.adjusted_mutual_info(_pair(t), "truth", "pred"), 9, "mi"), 8, "ami")
