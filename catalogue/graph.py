"""Communities, group graph, diffusion on the vector table."""

from __future__ import annotations


from pyspark.sql import functions as F

from tallyweave.operators import graph, neighbors

from .base import EMB, query, rounded
from .neighbors import GAUSS, SNN, near, near_sql, snn_edges

LABELS = "lab AS (SELECT vec_id AS node, CAST(label AS BIGINT) AS community FROM embeddings)"
SYM = "sym AS (SELECT src, dst, w FROM edges UNION ALL SELECT dst, src, w FROM edges)"


def _labels(t):
    return t.raw("embeddings").select(F.col("vec_id").alias("node"), F.col("label").cast("long").alias("community"))


@query("modularity", f"""WITH {SNN}, {LABELS}, {SYM},
ends AS (SELECT a.community AS c1, b.community AS c2, w FROM sym JOIN lab a ON a.node = src JOIN lab b ON b.node = dst),
per AS (SELECT c1, sum(w) AS tot, coalesce(sum(w) FILTER (c1 = c2), 0) AS w_in FROM ends GROUP BY 1), m AS (SELECT sum(tot) AS m FROM per)
SELECT round(sum(w_in / m - (tot / m) * (tot / m)), 6) AS q FROM per, m""")
def _(t):
    return rounded(graph.modularity(snn_edges(t), _labels(t)), 6, "q")


@query("louvain_round", f"""WITH {SNN}, {LABELS}, {SYM},
k AS (SELECT node, community, coalesce(sum(w), 0) AS k FROM lab LEFT JOIN sym ON src = node GROUP BY 1, 2),
tot AS (SELECT community, sum(k) AS tot FROM k GROUP BY 1), m AS (SELECT sum(w) AS m FROM sym),
kic AS (SELECT src AS node, community AS c, sum(w) AS w FROM sym JOIN lab ON node = dst GROUP BY 1, 2),
gain AS (SELECT node, c, k.community AS own, round((w - k * (tot.tot - CASE WHEN c = k.community THEN k ELSE 0 END) / m) / m, 10) AS g
  FROM kic JOIN k USING (node) JOIN tot ON tot.community = c, m),
stay AS (SELECT k.node, k.community AS own, coalesce(g, round(-k * (tot - k) / m / m, 10)) AS s
  FROM k JOIN tot USING (community) LEFT JOIN gain ON gain.node = k.node AND c = k.community, m),
best AS (SELECT node, c, g FROM gain QUALIFY row_number() OVER (PARTITION BY node ORDER BY g DESC, c) = 1)
SELECT s.node, CASE WHEN instr('02468ace', substr(md5(CAST(s.node AS VARCHAR)), 1, 1)) > 0 AND g > s.s THEN c ELSE own END AS community FROM stay s LEFT JOIN best b USING (node)""")
def _(t):
    return graph.louvain_round(snn_edges(t), _labels(t), 1.0, 0)


@query("louvain")
def _(t):
    return graph.louvain(snn_edges(t), 1.0, nodes=t.emb.select(F.col("cell_id").alias("node")))


@query("overcluster")
def _(t):
    return graph.overcluster(snn_edges(t), 1.0)


PAGA = f"""{near_sql(15)}, links AS (SELECT DISTINCT least(cell_id, nbr_id) AS src, greatest(cell_id, nbr_id) AS dst FROM near),
dir AS (SELECT a.label AS i, b.label AS j FROM (SELECT src, dst FROM links UNION ALL SELECT dst, src FROM links) l
  JOIN emb a ON a.cell_id = src JOIN emb b ON b.cell_id = dst),
size AS (SELECT label, CAST(count(*) AS DOUBLE) AS n FROM emb GROUP BY 1), total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM emb),
es2 AS (SELECT i, CAST(count(*) AS DOUBLE) AS e FROM dir GROUP BY 1),
obs AS (SELECT least(i, j) AS a, greatest(i, j) AS b, CAST(count(*) AS DOUBLE) AS m FROM dir WHERE i <> j GROUP BY 1, 2),
raw AS (SELECT a, b, least(1, m / ((x.e * q.n + y.e * p.n) / (total.n - 1))) AS w FROM obs JOIN es2 x ON x.i = a JOIN es2 y ON y.i = b
  JOIN size p ON p.label = a JOIN size q ON q.label = b, total),
paga AS (SELECT a, b, CASE WHEN w < 0.05 THEN 0 ELSE w END AS w FROM raw)"""


def _paga(t):
    return graph.paga(near(t, 15), t.emb_cells, "label")


@query("paga", f"WITH {PAGA} SELECT a, b, round(w, 6) AS w FROM paga")
def _(t):
    return rounded(_paga(t), 6, "w")


@query("group_segments", f"""WITH {PAGA}, g AS (SELECT label, avg(vec[1]) AS x, avg(vec[2]) AS y FROM emb GROUP BY 1)
SELECT a, b, round(p.x, 6) AS xi, round(p.y, 6) AS yi, round(q.x, 6) AS xf, round(q.y, 6) AS yf, round(w, 6) AS w
FROM paga JOIN g p ON p.label = a JOIN g q ON q.label = b WHERE w > 0""")
def _(t):
    at = t.emb.join(t.emb_cells, "cell_id").groupBy("label").agg(F.avg(F.col("vec")[0]).alias("x"), F.avg(F.col("vec")[1]).alias("y"))
    return rounded(graph.group_segments(_paga(t), at), 6, "xi", "yi", "xf", "yf", "w")


TRANSITION = f"""{GAUSS}, {SYM}, q AS (SELECT src, sum(w) AS q FROM sym GROUP BY 1),
kk AS (SELECT s.src, s.dst, w / (a.q * b.q) AS v FROM sym s JOIN q a ON a.src = s.src JOIN q b ON b.src = s.dst),
z AS (SELECT src, sum(v) AS z FROM kk GROUP BY 1),
tr AS (SELECT k.src, k.dst, v / (sqrt(a.z) * sqrt(b.z)) AS t FROM kk k JOIN z a ON a.src = k.src JOIN z b ON b.src = k.dst)"""


def _gauss(t):
    return neighbors.gauss_graph(near(t, 15))


@query("diffusion_transition", f"WITH {TRANSITION} SELECT src, dst, round(t, 6) AS t FROM tr")
def _(t):
    return rounded(graph.transition(_gauss(t)), 6, "t")


@query("diffusion_product", f"""WITH {TRANSITION} SELECT src AS node, round(sum(t * vec[1]), 6) + 0e0 AS y0, round(sum(t * vec[2]), 6) + 0e0 AS y1
FROM tr JOIN emb ON cell_id = dst GROUP BY 1""")
def _(t):
    block = t.emb.select(F.col("cell_id").alias("node"), F.slice("vec", 1, 2).alias("v"))
    out = graph.spread(graph.transition(_gauss(t)), block, 2)
    return rounded(out.select("node", F.col("y")[0].alias("y0"), F.col("y")[1].alias("y1")), 6, "y0", "y1")


@query("diffusion_map")
def _(t):
    emb, _ = graph.diffusion_map(_gauss(t), 20)
    return emb


@query("diffusion_eigenvalues")
def _(t):
    return graph.diffusion_map(_gauss(t), 20)[1]


@query("diffusion_pseudotime")
def _(t):
    emb, values = graph.diffusion_map(_gauss(t), 10)
    return graph.diffusion_pseudotime(emb, values, t.emb_cells, "label", "c0")


# the distance on given coordinates: the raw vectors, with the largest value of each coordinate as eigenvalue
@query("diffusion_pseudotime_distance", f"""WITH {EMB}, long AS (SELECT cell_id, unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM emb),
lam AS (SELECT i, max(v) AS l FROM long GROUP BY 1), root AS (SELECT min(cell_id) AS r FROM emb WHERE label = 'c3'),
d AS (SELECT a.cell_id, sqrt(sum(pow((a.v - b.v) * (l / (1 - l)), 2))) AS d FROM long a JOIN long b USING (i) JOIN lam USING (i), root
  WHERE b.cell_id = root.r GROUP BY 1)
SELECT cell_id, round(d / max(d) OVER (), 6) AS pseudotime FROM d""")
def _(t):
    long = t.emb.select("cell_id", F.posexplode("vec").alias("idx", "v"))
    lam = long.groupBy("idx").agg(F.max("v").alias("eigenvalue"))
    return rounded(graph.diffusion_pseudotime(t.emb, lam, t.emb_cells, "label", "c3"), 6, "pseudotime")
