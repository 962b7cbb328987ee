"""Group profiles, orders, coordinates and label look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import profile, qc

from .base import CELLS, EXPR, GENES, HVG, beta_sql, query, rounded
from .markers import LISTED, listed

PROFILE = """sizes AS (SELECT label, count(*) AS n1 FROM cells GROUP BY 1),
sums AS (SELECT label, gene_id, sum(x) AS s FROM expr JOIN cells USING (cell_id) GROUP BY 1, 2),
prof AS (SELECT label, gene_id, coalesce(s, 0) / n1 AS mean FROM sizes CROSS JOIN (SELECT DISTINCT gene_id FROM expr) LEFT JOIN sums USING (label, gene_id))"""
BASE = f"{EXPR}, {CELLS}, {PROFILE}"


def _profile(t, genes=None):
    return profile.mean_expression(t.expr, t.cells, "label", genes)


def _label_order(t):
    """Labels in string order with their position."""
    labels = t.cells.select("label").distinct().agg(F.array_sort(F.collect_list("label")).alias("a"))
    return labels.select(F.posexplode("a").alias("p", "label")).select("label", (F.col("p") + 1).cast("long").alias("position"))


@query("mean_expression", f"WITH {BASE} SELECT label, gene_id, round(mean, 6) AS mean FROM prof")
def _(t):
    return rounded(_profile(t), 6, "mean")


@query("heatmap_table", f"""WITH {EXPR}, {CELLS}, {LISTED}, {PROFILE}
SELECT CAST(gene_id AS VARCHAR) AS "row", label AS col, round(mean, 6) AS value FROM prof JOIN listed USING (gene_id)""")
def _(t):
    order = sorted(r[0] for r in t.cells.select("label").distinct().collect())  # the columns of the wide table
    wide = _profile(t, listed(t)).groupBy(F.col("gene_id").cast("string").alias("gene_id")).pivot("label", order).agg(F.first("mean"))
    return rounded(profile.melt(wide, "gene_id", order), 6, "value")


DIAGONAL = f"""{BASE}, lab AS (SELECT label, row_number() OVER (ORDER BY label) AS i FROM sizes),
cen AS (SELECT gene_id, sum(i * mean) / nullif(sum(mean), 0) AS centre FROM prof JOIN lab USING (label) GROUP BY 1)"""


@query("diagonalise_genes", f"""WITH {DIAGONAL}
SELECT gene_id, round(centre, 9) AS centre, row_number() OVER (ORDER BY round(centre, 9) NULLS LAST, gene_id) AS position FROM cen""")
def _(t):
    # the weight centre is compared to nine digits so that equal centres tie in both engines
    prof = _profile(t)
    return rounded(profile.diagonalise_genes(prof, _label_order(t)), 9, "centre")


@query("spot_table", f"""WITH {EXPR}, {CELLS}, {LISTED}, {PROFILE}, few AS (SELECT * FROM prof JOIN listed USING (gene_id))
SELECT label, gene_id, round(mean, 6) AS mean, dense_rank() OVER (ORDER BY gene_id) AS x, dense_rank() OVER (ORDER BY label) AS y,
CAST(floor(max(mean) OVER ()) + 1 AS BIGINT) AS vmax FROM few""")
def _(t):
    genes = listed(t).select("gene_id", F.col("gene_id").alias("position"))
    return rounded(profile.spot_table(_profile(t, listed(t)), _label_order(t), genes), 6, "mean")


SIDES = CELLS.replace("cells AS", "everyone AS") + """, cells AS (SELECT cell_id, CASE WHEN batch = 'F' THEN 'Q::' ELSE 'R::' END || label AS label FROM everyone)"""
CORRELATION = f"""{EXPR}, {SIDES}, {PROFILE},
picked AS (SELECT * FROM prof WHERE gene_id IN (SELECT e.gene_id FROM expr e JOIN cells c USING (cell_id) WHERE label LIKE 'Q::%')
  AND gene_id IN (SELECT e.gene_id FROM expr e JOIN cells c USING (cell_id) WHERE label LIKE 'R::%')),
ranked AS (SELECT label, gene_id, rank() OVER (PARTITION BY label ORDER BY mean) + (count(*) OVER (PARTITION BY label, mean) - 1) / 2e0 AS r FROM
  (SELECT label, gene_id, round(mean, 12) AS mean FROM picked)),
cor AS (SELECT q.label AS label_q, r.label AS label_r, corr(q.r, r.r) AS rho, count(*) AS n
  FROM ranked q JOIN ranked r USING (gene_id) WHERE q.label LIKE 'Q::%' AND r.label LIKE 'R::%' GROUP BY 1, 2)"""


def _correlation(t):
    side = F.concat(F.when(F.col("batch") == "F", "Q::").otherwise("R::"), F.col("label"))
    cells = t.cells.select("cell_id", side.alias("label"))
    one = lambda tag: profile.mean_expression(
        t.expr.join(cells.where(F.col("label").startswith(tag)).select("cell_id"), "cell_id", "left_semi"),
        cells.where(F.col("label").startswith(tag)), "label",
    ).withColumn("mean", F.round("mean", 12))
    return profile.profile_correlation(one("Q::"), one("R::"))


@query("profile_correlation", f"WITH {CORRELATION} SELECT label_q, label_r, round(rho, 6) + 0e0 AS rho, n FROM cor")
def _(t):
    return rounded(_correlation(t), 6, "rho")


@query("correlation_pvalue", f"""WITH {CORRELATION}, tt AS (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM cor)
SELECT label_q, label_r, round(rho, 6) + 0e0 AS rho, n, round(t, 5) + 0e0 AS t, round({beta_sql("(n - 2) / (n - 2 + t * t)", "(n - 2) / 2e0", "0.5e0")}, 6) AS p FROM tt""")
def _(t):
    return rounded(rounded(profile.correlation_pvalue(_correlation(t)), 6, "rho", "p"), 5, "t")


# cells as points: price against the day of the order
POINTS = "pts AS (SELECT o_orderkey AS cell_id, o_orderpriority AS label, o_totalprice AS px, CAST(dayofyear(o_orderdate) AS DOUBLE) AS py FROM orders)"


def _points(t):
    return t.raw("orders").select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("px"),
        F.dayofyear("o_orderdate").cast("double").alias("py"),
    )


@query("label_centroid_median", f"WITH {POINTS} SELECT label, round(median(px), 6) AS x, round(median(py), 6) AS y FROM pts GROUP BY 1")
def _(t):
    return rounded(profile.label_centroid_median(_points(t), "label", "px", "py"), 6, "x", "y")


@query("robust_limits", f"""WITH {POINTS} SELECT round(1.15 * quantile_cont(px, 0.01), 6) AS x0, round(1.15 * quantile_cont(px, 0.99), 6) AS x1,
round(1.15 * quantile_cont(py, 0.01), 6) AS y0, round(1.15 * quantile_cont(py, 0.99), 6) AS y1 FROM pts""")
def _(t):
    return rounded(profile.robust_limits(_points(t), "px", "py"), 6, "x0", "x1", "y0", "y1")


@query("robust_limits_animation", f"""WITH {POINTS} SELECT round(quantile_cont(px, 0.01) - 15000, 6) AS x0, round(quantile_cont(px, 0.99) + 15000, 6) AS x1,
round(1.1 * quantile_cont(py, 0.01) - 15000, 6) AS y0, round(1.1 * quantile_cont(py, 0.99) + 15000, 6) AS y1 FROM pts""")
def _(t):
    limits = profile.robust_limits(_points(t), "px", "py", factor_x=1.0, factor_y=1.1, pad=15000.0)
    return rounded(limits, 6, "x0", "x1", "y0", "y1")


@query("rescale_coordinates_2d", f"""WITH {POINTS}, l AS (SELECT quantile_cont(px, 0.01) AS xl, quantile_cont(px, 0.98) AS xh,
  quantile_cont(py, 0.01) AS yl, quantile_cont(py, 0.98) AS yh FROM pts),
c AS (SELECT cell_id, px - (xl + xh) * 0.6 AS px, py - (yl + yh) * 0.6 AS py FROM pts, l),
m AS (SELECT 1.2 * greatest(abs(quantile_cont(px, 0.01)), abs(quantile_cont(px, 0.98)), abs(quantile_cont(py, 0.01)), abs(quantile_cont(py, 0.98))) AS m FROM c)
SELECT cell_id, round(px / m, 6) + 0e0 AS px, round(py / m, 6) + 0e0 AS py FROM c, m""")
def _(t):
    out = profile.rescale_coordinates(_points(t), ["px", "py"], "2d")
    return rounded(out.select("cell_id", "px", "py"), 6, "px", "py")


@query("rescale_coordinates_3d", """WITH p AS (SELECT vec_id AS cell_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
l AS (SELECT 1.2 * quantile_cont(x, 0.01) AS xl, 1.2 * quantile_cont(x, 0.99) AS xh, 1.2 * quantile_cont(y, 0.01) AS yl, 1.2 * quantile_cont(y, 0.99) AS yh,
  1.2 * quantile_cont(z, 0.01) AS zl, 1.2 * quantile_cont(z, 0.99) AS zh FROM p),
r AS (SELECT *, 180 / greatest(xh - xl, yh - yl, zh - zl) AS k FROM l)
SELECT cell_id, round((x - (xl + xh) / 2) * k, 6) + 0e0 AS x, round((y - (yl + yh) / 2) * k, 6) + 0e0 AS y, round((z - (zl + zh) / 2) * k, 6) + 0e0 AS z FROM p, r""")
def _(t):
    xyz = t.emb.select("cell_id", *[F.col("vec")[i].alias(c) for i, c in enumerate("xyz")])
    return rounded(profile.rescale_coordinates(xyz, list("xyz"), "3d"), 6, "x", "y", "z")


@query("minmax_by", f"""WITH {EXPR} SELECT gene_id, cell_id, round((x - min(x) OVER (PARTITION BY gene_id)) /
nullif(max(x) OVER (PARTITION BY gene_id) - min(x) OVER (PARTITION BY gene_id), 0), 6) AS x FROM expr""")
def _(t):
    return rounded(profile.minmax_by(t.expr.select("gene_id", "cell_id", "x"), "gene_id"), 6, "x")


@query("minmax_group_graph", f"""WITH {POINTS}, g AS (SELECT label, avg(px) AS x, avg(py) AS y, count(*) AS size FROM pts GROUP BY 1)
SELECT label, round((x - min(x) OVER () * 1.4) / ((max(x) OVER () - min(x) OVER ()) * 1.4), 6) AS x,
round((y - min(y) OVER () * 1.4) / ((max(y) OVER () - min(y) OVER ()) * 1.4), 6) AS y, size FROM g""")
def _(t):
    groups = _points(t).groupBy("label").agg(F.avg("px").alias("x"), F.avg("py").alias("y"), F.count(F.lit(1)).alias("size"))
    return rounded(profile.minmax_group_graph(groups), 6, "x", "y")


@query("max_by_gene", f"WITH {EXPR} SELECT gene_id, round(max(x), 6) AS max FROM expr GROUP BY 1")
def _(t):
    return rounded(profile.max_by_gene(t.expr), 6, "max")


@query("colour_key_check", """WITH used AS (SELECT DISTINCT p_brand AS label FROM part WHERE p_brand <> 'Brand#3'),
k AS (SELECT n_name, 'Brand#' || CAST(n_nationkey AS VARCHAR) AS label, '#' || substr(md5(n_name), 1, 6) AS colour FROM nation)
SELECT label, colour, CASE WHEN used.label IS NULL THEN 'not_in_data' WHEN colour IS NULL THEN 'no_colour' ELSE 'matched' END AS status
FROM used FULL JOIN k USING (label)""")
def _(t):
    cells = t.raw("part").where(F.col("p_brand") != "Brand#3")
    key = t.raw("nation").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("label"),
        F.concat(F.lit("#"), F.substring(F.md5("n_name"), 1, 6)).alias("colour"),
    )
    return profile.colour_key_check(cells, "p_brand", key)


# nations of the first three regions are renamed; some are listed twice and the lower position wins
@query("map_values", """WITH m AS (SELECT n_name AS f, r_name || '/' || CAST(n_nationkey AS VARCHAR) AS t FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey < 3)
SELECT c_custkey, coalesce(t, n_name) AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN m ON f = n_name""")
def _(t):
    nation = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pairs = nation.where("n_regionkey < 3").select(
        F.col("n_name").alias("from"), F.concat_ws("/", "r_name", F.col("n_nationkey").cast("string")).alias("to"), F.lit(1).alias("position")
    )
    pairs = pairs.unionByName(pairs.withColumn("to", F.lit("later")).withColumn("position", F.lit(2)))
    people = t.raw("customer").join(t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return profile.map_values(people.select("c_custkey", F.col("n_name").alias("nation")), "nation", pairs)


@query("update_annotation", """WITH t AS (SELECT CAST(n_nationkey AS VARCHAR) AS Cluster, n_name AS Identity FROM nation WHERE n_nationkey <> 7)
SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS cluster, coalesce(Identity, CAST(s_nationkey AS VARCHAR)) AS identity
FROM supplier LEFT JOIN t ON t.Cluster = CAST(s_nationkey AS VARCHAR)""")
def _(t):
    template = t.raw("nation").where("n_nationkey <> 7").select(F.col("n_nationkey").cast("string").alias("Cluster"), F.col("n_name").alias("Identity"))
    cells = t.raw("supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("cluster"))
    return profile.update_annotation(cells, "cluster", template, "identity")


@query("make_update_template", "SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS Cluster, 'None' AS Identity FROM customer")
def _(t):
    return profile.make_update_template(t.raw("customer"), "c_nationkey")


@query("cluster_gene_order")
def _(t):
    chosen = qc.selected_genes(qc.variable_genes_mvp(t.expr, t.cells))
    prof = _profile(t, chosen).select("gene_id", F.col("label").alias("col"), F.col("mean").alias("value"))
    return profile.cluster_gene_order(prof, k=8)


@query("cluster_gene_order_spearman")
def _(t):
    chosen = qc.selected_genes(qc.variable_genes_mvp(t.expr, t.cells))
    prof = _profile(t, chosen).select("gene_id", F.col("label").alias("col"), F.col("mean").alias("value"))
    return profile.cluster_gene_order(prof, k=8, metric="spearman")
