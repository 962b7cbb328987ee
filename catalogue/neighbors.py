"""Nearest neighbours and cell graphs on the vector table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import neighbors

from .base import EMB, query, rounded


def near_sql(k: int) -> str:
    """``near(cell_id, nbr_id, rank, dist)`` by comparing everything."""
    return f"""{EMB}, near AS (SELECT a.cell_id, b.cell_id AS nbr_id, list_distance(a.vec, b.vec) AS dist,
  row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.vec, b.vec), b.cell_id) AS rank
  FROM emb a JOIN emb b ON a.cell_id <> b.cell_id QUALIFY rank <= {k})"""


def near(t, k):
    return neighbors.knn(t.emb, k)


@query("knn", f"WITH {near_sql(15)} SELECT cell_id, nbr_id, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM near")
def _(t):
    return rounded(near(t, 15), 6, "dist")


@query("knn_correlation", f"""WITH {EMB}, cen AS (SELECT cell_id, list_transform(vec, lambda v: v - list_avg(vec)) AS c FROM emb),
u AS (SELECT cell_id, c, sqrt(list_dot_product(c, c)) AS s FROM cen),
near AS (SELECT a.cell_id, b.cell_id AS nbr_id, 1 - list_dot_product(a.c, b.c) / (a.s * b.s) AS dist,
  row_number() OVER (PARTITION BY a.cell_id ORDER BY 1 - list_dot_product(a.c, b.c) / (a.s * b.s), b.cell_id) AS rank
  FROM u a JOIN u b ON a.cell_id <> b.cell_id QUALIFY rank <= 5)
SELECT cell_id, nbr_id, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM near""")
def _(t):
    return rounded(neighbors.knn(t.emb, 5, metric="correlation"), 6, "dist")


# every vector twice, and a crowd with the vector of the first: copies must find each other first
@query("knn_copies", f"""WITH twice AS (SELECT vec_id * 2 + c AS cell_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings, range(2) r(c)
  UNION ALL SELECT 1000000 + vec_id AS cell_id, (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id LIMIT 1) AS vec FROM embeddings),
near AS (SELECT a.cell_id, b.cell_id AS nbr_id, list_distance(a.vec, b.vec) AS dist,
  row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.vec, b.vec), b.cell_id) AS rank
  FROM twice a JOIN twice b ON a.cell_id <> b.cell_id QUALIFY rank <= 6)
SELECT cell_id, nbr_id, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM near""")
def _(t):
    first = t.emb.agg(F.min_by("vec", "cell_id").alias("v")).scalar()
    both = F.explode(F.array(F.lit(0), F.lit(1)))
    twice = t.emb.select("vec", "cell_id", both.alias("c")).select((F.col("cell_id") * 2 + F.col("c")).alias("cell_id"), "vec")
    crowd = t.emb.select((F.col("cell_id") + 1000000).alias("cell_id"), first.alias("vec"))
    return rounded(neighbors.knn(twice.unionByName(crowd), 6), 6, "dist")


SNN = f"""{near_sql(9)}, sets AS (SELECT cell_id, nbr_id FROM near UNION ALL SELECT cell_id, cell_id FROM emb),
pairs AS (SELECT a.cell_id AS src, b.cell_id AS dst, CAST(count(*) AS DOUBLE) AS s FROM sets a JOIN sets b USING (nbr_id)
  WHERE a.cell_id < b.cell_id GROUP BY 1, 2), edges AS (SELECT src, dst, s / (20 - s) AS w FROM pairs WHERE s / (20 - s) >= 1 / 15e0)"""


def snn_edges(t):
    return neighbors.snn(near(t, 9), k=10)


@query("snn", f"WITH {SNN} SELECT src, dst, round(w, 9) AS w FROM edges")
def _(t):
    return rounded(snn_edges(t), 9, "w")


GAUSS = f"""{near_sql(15)}, sig AS (SELECT cell_id, max(dist) / 2 AS s FROM near GROUP BY 1),
edges AS (SELECT least(cell_id, nbr_id) AS src, greatest(cell_id, nbr_id) AS dst,
  max(sqrt(2 * a.s * b.s / (a.s * a.s + b.s * b.s)) * exp(-dist * dist / (a.s * a.s + b.s * b.s))) AS w
  FROM near JOIN sig a USING (cell_id) JOIN sig b ON b.cell_id = nbr_id GROUP BY 1, 2)"""


@query("gauss_graph", f"WITH {GAUSS} SELECT src, dst, round(w, 6) AS w FROM edges")
def _(t):
    return rounded(neighbors.gauss_graph(near(t, 15)), 6, "w")


@query("umap_graph", f"""WITH RECURSIVE {EMB}, cen AS (SELECT cell_id, list_transform(vec, lambda v: v - list_avg(vec)) AS c FROM emb),
u AS (SELECT cell_id, c, sqrt(list_dot_product(c, c)) AS s FROM cen),
near AS (SELECT a.cell_id, b.cell_id AS nbr_id, 1 - list_dot_product(a.c, b.c) / (a.s * b.s) AS dist,
  row_number() OVER (PARTITION BY a.cell_id ORDER BY 1 - list_dot_product(a.c, b.c) / (a.s * b.s), b.cell_id) AS rank
  FROM u a JOIN u b ON a.cell_id <> b.cell_id QUALIFY rank <= 5),
gaps AS (SELECT cell_id, list(dist - lo) AS g FROM (SELECT cell_id, dist, min(dist) OVER (PARTITION BY cell_id) AS lo FROM near) GROUP BY 1),
it AS (SELECT cell_id, g, 0 AS step, 0e0 AS lo, -1e0 AS hi, 1e0 AS mid FROM gaps
  UNION ALL SELECT cell_id, g, step + 1, l2, h2, CASE WHEN h2 < 0 THEN l2 * 2 ELSE (l2 + h2) / 2 END FROM
  (SELECT cell_id, g, step, CASE WHEN s > log2(5e0) THEN lo ELSE mid END AS l2, CASE WHEN s > log2(5e0) THEN mid ELSE hi END AS h2 FROM
    (SELECT *, list_sum(list_transform(g, lambda x: exp(-x / mid))) AS s FROM it WHERE step < 64))),
sig AS (SELECT cell_id, mid AS sigma FROM it WHERE step = 64),
w AS (SELECT cell_id, nbr_id, exp(-(dist - min(dist) OVER (PARTITION BY cell_id)) / sigma) AS w FROM near JOIN sig USING (cell_id))
SELECT least(cell_id, nbr_id) AS src, greatest(cell_id, nbr_id) AS dst,
round(CASE WHEN count(*) = 2 THEN max(w) + min(w) - max(w) * min(w) ELSE max(w) END, 6) AS w FROM w GROUP BY 1, 2""")
def _(t):
    return rounded(neighbors.umap_graph(neighbors.knn(t.emb, 5, metric="correlation")), 6, "w")
