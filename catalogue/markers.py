"""Marker tests, their annotation, trends and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.formulas import two_sided_normal
from tallyweave.operators import markers, profile, qc
from tallyweave.operators.scale import materialise, tasks_for

from .base import CELLS, COUNTS, EXPR, GENES, beta_sql, query, rounded


def scored_sql(source: str, n_genes: str) -> str:
    """CTEs from (…, n1, n2, R, T) named ``source`` to ``scored`` with z, p_val, p_val_adj."""
    return f"""zeta AS (SELECT *, R - n1 * (n1 + 1) / 2 - n1 * n2 / 2 AS u,
  sqrt(greatest(0, n1 * n2 / 12e0 * ((n1 + n2 + 1) - T / ((n1 + n2) * (n1 + n2 - 1))))) AS s FROM {source}),
zetb AS (SELECT *, CASE WHEN s > 1e-6 THEN (u - 0.5e0 * sign(u)) / s ELSE 0e0 END AS z FROM zeta),
zetc AS (SELECT *, least(1e0, {two_sided_normal("z")}) AS p_val FROM zetb),
scored AS (SELECT *, least(1e0, p_val * ({n_genes})) AS p_val_adj FROM zetc)"""


def one_vs_rest_sql(min_pct: float, logfc: float) -> str:
    """CTEs that end in ``scored``, from ``expr`` and ``cells``: dense ranks written out."""
    return f"""nz AS (SELECT gene_id, x, label FROM expr JOIN cells USING (cell_id)),
sizes AS (SELECT label, CAST(count(*) AS DOUBLE) AS n1 FROM cells GROUP BY 1),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS N FROM cells),
g AS (SELECT gene_id, CAST(count(*) AS DOUBLE) AS gc, sum(exp(x) - 1) AS ge FROM nz GROUP BY 1),
rk AS (SELECT gene_id, label, x, rank() OVER (PARTITION BY gene_id ORDER BY x) + (count(*) OVER (PARTITION BY gene_id, x) - 1) / 2e0 AS r FROM nz),
ties AS (SELECT gene_id, sum(t * t * t - t) AS tt FROM (SELECT gene_id, x, CAST(count(*) AS DOUBLE) AS t FROM nz GROUP BY 1, 2) GROUP BY 1),
per AS (SELECT gene_id, label, CAST(count(*) AS DOUBLE) AS c, sum(r) AS r, sum(exp(x) - 1) AS e FROM rk GROUP BY 1, 2),
grid AS (SELECT s.label AS cluster, g.gene_id AS gene, n1, N - n1 AS n2, coalesce(c, 0) AS c1, gc - coalesce(c, 0) AS c2,
  coalesce(e, 0) AS e1, ge - coalesce(e, 0) AS e2, N - gc AS z0, coalesce(r, 0) AS r1, tt
  FROM g CROSS JOIN sizes s CROSS JOIN tot JOIN ties USING (gene_id) LEFT JOIN per ON per.gene_id = g.gene_id AND per.label = s.label),
tested AS (SELECT *, ln(e1 / n1 + 1) - ln(e2 / n2 + 1) AS avg_logFC, c1 / n1 AS pct_1, c2 / n2 AS pct_2,
  r1 + c1 * z0 + (n1 - c1) * (z0 + 1) / 2 AS R, tt + z0 * z0 * z0 - z0 AS T FROM grid),
passed AS (SELECT * FROM tested WHERE greatest(pct_1, pct_2) >= {min_pct} AND abs(avg_logFC) >= {logfc}),
{scored_sql("passed", "SELECT count(DISTINCT gene_id) FROM expr")}"""


TEST_COLUMNS = """round(avg_logFC, 6) + 0e0 AS avg_logFC, round(pct_1, 6) AS pct_1, round(pct_2, 6) AS pct_2,
round(z, 5) + 0e0 AS z, round(p_val, 6) AS p_val, round(p_val_adj, 6) AS p_val_adj"""


def shown(df):
    return rounded(rounded(df, 6, "avg_logFC", "pct_1", "pct_2", "p_val", "p_val_adj"), 5, "z")


FILTERED = """raw AS (SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2),
wide AS (SELECT * FROM raw WHERE cell_id IN (SELECT cell_id FROM raw GROUP BY 1 HAVING count(*) FILTER (n > 0) > 2)),
counts AS (SELECT * FROM wide WHERE gene_id IN (SELECT gene_id FROM wide GROUP BY 1 HAVING count(*) FILTER (n > 0) >= 3)),
totals AS (SELECT cell_id, sum(n) AS total FROM counts GROUP BY 1),
expr AS (SELECT c.cell_id, c.gene_id, c.n, ln(1 + c.n * 1e4 / t.total) AS x FROM counts c JOIN totals t USING (cell_id))"""


@query("flagship_markers", f"""WITH {FILTERED}, {CELLS}, {one_vs_rest_sql(0.0, 0.0)}
SELECT cluster, gene, {TEST_COLUMNS} FROM scored QUALIFY rank() OVER (PARTITION BY cluster ORDER BY round(avg_logFC, 9) DESC) <= 10""")
def _(t):
    expr = qc.log_normalise(qc.filter_cells_genes(t.counts, min_cells=3, min_genes=2))
    found = markers.markers_one_vs_rest(expr, t.cells, "label", min_pct=0.0, logfc=0.0)
    return shown(markers.top_markers(rounded(found, 9, "avg_logFC"), 10))


def _written(t):
    """Expression, written once; cells are totalled by as many tasks as the counts ask for."""
    counts = materialise(t.counts)
    return materialise(qc.log_normalise(counts.repartition(tasks_for(t.spark, counts.count()), "cell_id")))


@query("markers_one_vs_rest", f"WITH {EXPR}, {CELLS}, {one_vs_rest_sql(0.002, 0.05)} SELECT cluster, gene, {TEST_COLUMNS} FROM scored")
def _(t):
    return shown(markers.markers_one_vs_rest(_written(t), t.cells, "label", min_pct=0.002, logfc=0.05))


CAPPED = CELLS.replace("cells AS", "everyone AS") + """, cells AS (SELECT * FROM everyone
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(CAST(cell_id AS VARCHAR) || '|0'), cell_id) <= 200)"""


@query("markers_one_vs_rest_capped", f"WITH {EXPR}, {CAPPED}, {one_vs_rest_sql(0.005, 0.25)} SELECT cluster, gene, {TEST_COLUMNS} FROM scored")
def _(t):
    return shown(markers.markers_one_vs_rest(t.expr, t.cells, "label", min_pct=0.005, logfc=0.25, max_cells=200))


TOP = f"""{EXPR}, {CELLS}, {one_vs_rest_sql(0.0, 0.0)},
best AS (SELECT cluster, gene, round(avg_logFC, 9) AS lfc, pct_1 FROM scored),
top AS (SELECT * FROM best QUALIFY rank() OVER (PARTITION BY cluster ORDER BY lfc DESC) <= 20)"""


def _top(t, n=20):
    found = markers.markers_one_vs_rest(t.expr, t.cells, "label", min_pct=0.0, logfc=0.0)
    return markers.top_markers(rounded(found, 9, "avg_logFC"), n)


@query("top_markers", f"WITH {TOP} SELECT cluster, gene, round(lfc, 6) AS avg_logFC, round(pct_1, 6) AS pct_1 FROM top")
def _(t):
    return rounded(_top(t).select("cluster", "gene", "avg_logFC", "pct_1"), 6, "avg_logFC", "pct_1")


@query("annotate_markers", f"""WITH {TOP}, {GENES} SELECT cluster, gene, coalesce(g.name, CAST(gene AS VARCHAR)) AS name,
coalesce(g.family, CAST(gene AS VARCHAR)) AS family, coalesce(g.pathway, CAST(gene AS VARCHAR)) AS pathway
FROM top LEFT JOIN (SELECT * FROM genes WHERE size <= 40) g ON g.gene_id = gene""")
def _(t):
    # genes above size 40 have no entry, so their symbol must survive
    info = t.genes.where("size <= 40").withColumnRenamed("gene_id", "gene")
    return markers.annotate_markers(_top(t).select("cluster", "gene"), info, ["name", "family", "pathway"])


@query("also_present_in", f"""WITH {TOP.replace("<= 20)", "<= 100)")}, w AS (SELECT gene, string_agg(cluster, ', ' ORDER BY cluster) AS s, count(*) AS k FROM top GROUP BY 1)
SELECT cluster, gene, CASE WHEN k > 1 THEN s ELSE '' END AS also_present_in FROM top JOIN w USING (gene)""")
def _(t):
    return markers.also_present_in(_top(t, 100).select("cluster", "gene"))


POPULATIONS = """gene_to_pop AS (SELECT p_partkey AS gene, p_type || ', ' || p_brand AS populations FROM part WHERE p_size % 3 <> 0)"""


def _populations(t):
    """Known populations of a gene, in the delimited form; a third of the sizes have none."""
    g = t.genes.where(F.col("size") % 3 != 0)
    return g.select(F.col("gene_id").alias("gene"), F.concat_ws(", ", "pathway", "family").alias("populations"))


@query("cell_type_flag", f"""WITH {TOP}, {POPULATIONS}, parts AS (SELECT gene, unnest(string_split(populations, ', ')) AS p FROM gene_to_pop),
f AS (SELECT gene, string_agg(DISTINCT p, ', ' ORDER BY p) AS flag FROM parts GROUP BY 1)
SELECT cluster, gene, coalesce(flag, '') AS cell_type_flag FROM top LEFT JOIN f USING (gene)""")
def _(t):
    return markers.cell_type_flag(_top(t).select("cluster", "gene"), _populations(t))


@query("population_mentions", f"""WITH {EXPR}, {CELLS}, {POPULATIONS}, {GENES},
parts AS (SELECT DISTINCT gene, unnest(string_split(populations, ', ')) AS population FROM gene_to_pop),
w AS (SELECT population, count(*) AS k FROM parts GROUP BY 1),
sizes AS (SELECT label, count(*) AS n1 FROM cells GROUP BY 1),
prof AS (SELECT label, gene_id, sum(x) / max(n1) AS mean FROM expr JOIN cells USING (cell_id) JOIN sizes USING (label)
  JOIN genes USING (gene_id) WHERE pathway <> 'ECONOMY' GROUP BY 1, 2),
m AS (SELECT label, population, sum(100 * mean / k) AS weight FROM prof JOIN parts ON gene = gene_id JOIN w USING (population) GROUP BY 1, 2)
SELECT label, population, round(weight, 6) AS weight, CAST(round(100 * weight) AS BIGINT) AS freq FROM m WHERE round(100 * weight) >= 1
QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(100 * weight) DESC, population) <= 500""")
def _(t):
    mito = t.genes.where("pathway = 'ECONOMY'")
    prof = profile.mean_expression(qc.exclude_genes(t.expr, names=mito), t.cells, "label")
    return rounded(markers.population_mentions(prof, _populations(t), top=500), 6, "weight")


LISTED = "listed AS (SELECT gene_id FROM counts GROUP BY 1 ORDER BY count(*) DESC, gene_id LIMIT 20)"


def listed(t):
    """The genes to draw, as a user would list them: the 20 seen in most cells."""
    return qc.gene_stats(t.counts).orderBy(F.col("n_cells").desc(), "gene_id").limit(20).select("gene_id")


@query("marker_expression_long", f"""WITH {EXPR}, {CELLS}, {LISTED}
SELECT CASE WHEN label = '1-URGENT' THEN 'Query_Population' ELSE 'Reference_Population' END AS population, l.gene_id, c.cell_id,
round(coalesce(x, 0), 6) AS x FROM cells c CROSS JOIN listed l LEFT JOIN expr e ON e.cell_id = c.cell_id AND e.gene_id = l.gene_id
WHERE label IN ('1-URGENT', '5-LOW')""")
def _(t):
    return rounded(markers.marker_expression_long(t.expr, t.cells, "label", ("1-URGENT", "5-LOW"), listed(t)), 6, "x")


COMPARED = CELLS.replace("cells AS", "everyone AS") + """, labelled AS (SELECT cell_id, CASE WHEN batch = 'F' THEN 'Q::' ELSE 'R::' END || label AS label FROM everyone),
cells AS (SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(CAST(cell_id AS VARCHAR) || '|0'), cell_id) <= 500)"""


def compared(t):
    side = F.when(F.col("batch") == "F", "Q::").otherwise("R::")
    return t.cells.select("cell_id", F.concat(side, "label").alias("label"))


@query("markers_pairwise", f"""WITH {EXPR}, {COMPARED},
nz AS (SELECT gene_id, x, label FROM expr JOIN cells USING (cell_id)),
sizes AS (SELECT label, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY 1),
pairs AS (SELECT q.label AS ql, r.label AS rl, q.n AS n1, r.n AS n2 FROM sizes q JOIN sizes r ON q.label LIKE 'Q::%' AND r.label LIKE 'R::%'),
pz AS (SELECT ql, rl, n1, n2, gene_id, x, label = ql AS isq FROM nz JOIN pairs ON label IN (ql, rl)),
rk AS (SELECT *, rank() OVER (PARTITION BY ql, rl, gene_id ORDER BY x) + (count(*) OVER (PARTITION BY ql, rl, gene_id, x) - 1) / 2e0 AS r,
  CAST(count(*) OVER (PARTITION BY ql, rl, gene_id, x) AS DOUBLE) AS t FROM pz),
per AS (SELECT ql, rl, gene_id, max(n1) AS n1, max(n2) AS n2, CAST(count(*) FILTER (isq) AS DOUBLE) AS c1, CAST(count(*) FILTER (NOT isq) AS DOUBLE) AS c2,
  coalesce(sum(r) FILTER (isq), 0) AS r1, sum(t * t - 1) AS tt, coalesce(sum(exp(x) - 1) FILTER (isq), 0) AS e1,
  coalesce(sum(exp(x) - 1) FILTER (NOT isq), 0) AS e2 FROM rk GROUP BY 1, 2, 3),
tested AS (SELECT *, n1 + n2 - c1 - c2 AS z0, ln(e1 / n1 + 1) - ln(e2 / n2 + 1) AS avg_logFC, c1 / n1 AS pct_1, c2 / n2 AS pct_2 FROM per),
passed AS (SELECT *, r1 + c1 * z0 + (n1 - c1) * (z0 + 1) / 2 AS R, tt + z0 * z0 * z0 - z0 AS T FROM tested
  WHERE greatest(pct_1, pct_2) >= 0.002 AND abs(avg_logFC) >= 0.25),
{scored_sql("passed", "SELECT count(DISTINCT gene_id) FROM expr")}
SELECT ql[4:] AS query, rl[4:] AS reference, gene_id AS gene, {TEST_COLUMNS} FROM scored""")
def _(t):
    cells = compared(t)
    names = cells.select("label").distinct()
    refs = names.where("label LIKE 'R::%'").agg(F.collect_list("label").alias("a")).scalar()
    pairs = names.where("label LIKE 'Q::%'").select(F.col("label").alias("query"), F.explode(refs).alias("reference"))
    return shown(markers.markers_pairwise(t.expr, cells, "label", pairs, max_cells=500, min_pct=0.002, logfc=0.25))


@query("size_factors", f"""WITH {COUNTS}, tt AS (SELECT cell_id, sum(n) AS total FROM counts GROUP BY 1)
SELECT cell_id, round(total / (SELECT exp(avg(ln(total))) FROM tt), 6) AS size_factor FROM tt""")
def _(t):
    return rounded(markers.size_factors(t.counts), 6, "size_factor")


def spline_sql(by: str | None) -> str:
    """CTEs that end in ``trend`` (f, p per gene): the basis made orthogonal step by step."""
    k = f"{by}" if by else "0"
    return f"""src AS (SELECT cell_id, {k} AS grp, pseudotime AS pt FROM cells),
knots AS (SELECT grp, min(pt) AS k1, quantile_cont(pt, 0.33) AS k2, quantile_cont(pt, 0.67) AS k3, max(pt) AS k4, CAST(count(*) AS DOUBLE) AS n FROM src GROUP BY 1),
unit AS (SELECT cell_id, grp, n, (pt - k1) / (k4 - k1) AS t, (k2 - k1) / (k4 - k1) AS a, (k3 - k1) / (k4 - k1) AS b FROM src JOIN knots USING (grp)),
basis AS (SELECT cell_id, grp, n, t AS b1, pow(t, 3) - pow(greatest(t - b, 0), 3) / (1 - b) AS b2,
  pow(greatest(t - a, 0), 3) / (1 - a) - pow(greatest(t - b, 0), 3) / (1 - b) AS b3 FROM unit),
q1 AS (SELECT *, b1 - avg(b1) OVER (PARTITION BY grp) AS u1, b2 - avg(b2) OVER (PARTITION BY grp) AS v2, b3 - avg(b3) OVER (PARTITION BY grp) AS v3 FROM basis),
q2 AS (SELECT *, v2 - u1 * sum(v2 * u1) OVER (PARTITION BY grp) / sum(u1 * u1) OVER (PARTITION BY grp) AS u2,
  v3 - u1 * sum(v3 * u1) OVER (PARTITION BY grp) / sum(u1 * u1) OVER (PARTITION BY grp) AS w3 FROM q1),
q3 AS (SELECT cell_id, grp, n AS nc, u1, u2, w3 - u2 * sum(w3 * u2) OVER (PARTITION BY grp) / sum(u2 * u2) OVER (PARTITION BY grp) AS u3 FROM q2),
norms AS (SELECT grp, sum(u1 * u1) AS s1, sum(u2 * u2) AS s2, sum(u3 * u3) AS s3 FROM q3 GROUP BY 1),
per AS (SELECT grp, gene_id, max(nc) AS n, sum(x * x) - sum(x) * sum(x) / max(nc) AS rss0, sum(x * u1) AS d1, sum(x * u2) AS d2, sum(x * u3) AS d3
  FROM expr JOIN q3 USING (cell_id) GROUP BY 1, 2),
fit AS (SELECT grp, gene_id, n, rss0, d1 * d1 / s1 + d2 * d2 / s2 + d3 * d3 / s3 AS gain FROM per JOIN norms USING (grp)),
fstat AS (SELECT grp, gene_id, n, gain / 3 * (n - 4) / (rss0 - gain) AS f FROM fit),
trend AS (SELECT grp, gene_id, f, {beta_sql("(n - 4) / (n - 4 + 3 * greatest(f, 0))", "(n - 4) / 2", "1.5e0")} AS p FROM fstat)"""


@query("trend_genes", f"""WITH {EXPR}, {CELLS}, {spline_sql(None)}
SELECT gene_id, round(f, 4) AS f, round(p, 5) AS p FROM trend""")
def _(t):
    return rounded(rounded(markers.trend_genes(t.expr, t.cells, "pseudotime").select("gene_id", "f", "p"), 4, "f"), 5, "p")


@query("trend_genes_by_label", f"""WITH {EXPR}, {CELLS}, {spline_sql("label")},
raw AS (SELECT *, p * count(*) OVER (PARTITION BY grp) / rank() OVER (PARTITION BY grp ORDER BY p) AS v FROM trend)
SELECT grp AS label, gene_id, round(f, 4) AS f, round(p, 5) AS p,
round(min(v) OVER (PARTITION BY grp ORDER BY p DESC), 4) AS q FROM raw""")
def _(t):
    out = markers.trend_genes(t.expr, t.cells, "pseudotime", by="label")
    return rounded(rounded(out.select("label", "gene_id", "f", "p", "q"), 4, "f", "q"), 5, "p")


# p-values with many ties
PVALUES = """pv AS (SELECT o_orderkey AS id, o_orderstatus AS grp, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 3) AS p FROM orders)"""


@query("bh_adjust", f"""WITH {PVALUES}, rk AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY p, id) AS r, count(*) OVER (PARTITION BY grp) AS n FROM pv)
SELECT id, grp, p, round(min(p * n / r) OVER (PARTITION BY grp ORDER BY p DESC), 6) AS q FROM rk""")
def _(t):
    o = t.raw("orders")
    top = o.agg(F.max("o_totalprice").alias("m")).scalar()
    p = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("grp"), F.round(F.col("o_totalprice") / top, 3).alias("p"))
    return rounded(markers.bh_adjust(p, "p", "grp").select("id", "grp", "p", "q"), 6, "q")
