"""Quality control, normalising, variable genes, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import qc

from .base import CELLS, COUNTS, EXPR, GENES, HVG, query, rounded


@query("cell_stats", f"WITH {COUNTS} SELECT cell_id, sum(n) AS n_umi, count(*) FILTER (n > 0) AS n_gene FROM counts GROUP BY 1")
def _(t):
    return qc.cell_stats(t.counts)


@query("gene_stats", f"WITH {COUNTS} SELECT gene_id, count(*) FILTER (n > 0) AS n_cells, sum(n) AS total FROM counts GROUP BY 1")
def _(t):
    return qc.gene_stats(t.counts)


@query("filter_cells_genes", f"""WITH {COUNTS},
kept AS (SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM counts GROUP BY 1 HAVING count(*) FILTER (n > 0) > 3))
SELECT * FROM kept WHERE gene_id IN (SELECT gene_id FROM kept GROUP BY 1 HAVING count(*) FILTER (n > 0) >= 25)""")
def _(t):
    return qc.filter_cells_genes(t.counts, min_cells=25, min_genes=3)


@query("percent_pattern", f"""WITH {COUNTS}, {GENES}
SELECT cell_id, round(sum(CASE WHEN pathway LIKE 'ECONOMY%' THEN n ELSE 0 END) / sum(n), 6) AS pct
FROM counts LEFT JOIN genes USING (gene_id) GROUP BY 1""")
def _(t):
    return rounded(qc.percent_pattern(t.counts, t.genes, "^ECONOMY", "pathway"), 6, "pct")


@query("filter_threshold", f"""WITH {COUNTS}, {GENES},
pct AS (SELECT cell_id, sum(CASE WHEN pathway LIKE 'ECONOMY%' THEN n ELSE 0 END) / sum(n) AS pct
  FROM counts LEFT JOIN genes USING (gene_id) GROUP BY 1)
SELECT cell_id, round(pct, 6) AS pct FROM pct WHERE pct < 0.2""")
def _(t):
    pct = qc.percent_pattern(t.counts, t.genes, "^ECONOMY", "pathway")
    return rounded(qc.filter_threshold(pct, "pct"), 6, "pct")


@query("contingency", f"""WITH {CELLS} SELECT label, batch, CAST(grouping(label, batch) AS BIGINT) AS level, count(*) AS n
FROM cells GROUP BY CUBE (label, batch)""")
def _(t):
    return qc.contingency(t.cells, "label", "batch")


@query("contingency_by", f"""WITH {CELLS} SELECT lane, label, batch, CAST(grouping(lane, label, batch) AS BIGINT) AS level, count(*) AS n
FROM cells GROUP BY GROUPING SETS ((lane, label, batch), (lane, label), (lane, batch), (lane))""")
def _(t):
    return qc.contingency(t.cells, "label", "batch", by="lane")


@query("log_normalise", f"WITH {EXPR} SELECT cell_id, gene_id, n, round(x, 6) AS x FROM expr")
def _(t):
    return rounded(t.expr, 6, "x")


@query("normalise_per_cell", f"""WITH {EXPR}
SELECT c.cell_id, c.gene_id, c.n, round(c.n * 1e4 / t.total, 6) AS x FROM counts c JOIN totals t USING (cell_id)""")
def _(t):
    return rounded(qc.normalise_per_cell(t.counts), 6, "x")


@query("variable_genes_mvp", f"""WITH {EXPR}, {CELLS}, {HVG}
SELECT gene_id, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, round(z, 5) AS z, selected FROM hvg""")
def _(t):
    return rounded(rounded(qc.variable_genes_mvp(t.expr, t.cells), 6, "mean", "dispersion"), 5, "z")


DISPERSION = f"""{EXPR}, {CELLS},
flat AS (SELECT c.gene_id, c.n * 1e4 / t.total AS y FROM counts c JOIN totals t USING (cell_id)),
mv AS (SELECT gene_id, sum(y) / max(n) AS m, (sum(y * y) - sum(y) * sum(y) / max(n)) / (max(n) - 1) AS v
  FROM flat, (SELECT CAST(count(*) AS DOUBLE) AS n FROM cells) GROUP BY 1),
md AS (SELECT gene_id, ln(1 + m) AS mean, CASE WHEN v > 0 AND m > 0 THEN ln(v / m) ELSE 0 END AS dispersion FROM mv),
binned AS (SELECT md.*, CASE WHEN hi > lo THEN least(20, greatest(1, ceil((mean - lo) / ((hi - lo) / 20)))) ELSE 1 END AS bin
  FROM md, (SELECT min(mean) AS lo, max(mean) AS hi FROM md)),
zed AS (SELECT gene_id, mean, dispersion, CASE WHEN count(*) OVER (PARTITION BY bin) = 1 THEN 1 ELSE coalesce(
  (dispersion - avg(dispersion) OVER (PARTITION BY bin)) / nullif(stddev_samp(dispersion) OVER (PARTITION BY bin), 0), 0) END AS z
  FROM binned)"""


@query("variable_genes_dispersion", f"""WITH {DISPERSION}
SELECT gene_id, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, round(z, 5) AS z,
  mean > 0.0125 AND mean < 3 AND z > 0.5 AS selected FROM zed""")
def _(t):
    hvg = qc.variable_genes_dispersion(qc.normalise_per_cell(t.counts), t.cells)
    return rounded(rounded(hvg, 6, "mean", "dispersion"), 5, "z")


@query("pct_variable", f"""WITH {EXPR}, {CELLS}, {HVG}
SELECT round(100.0 * count(*) FILTER (selected) / count(*), 2) AS pct FROM hvg""")
def _(t):
    return qc.pct_variable(qc.variable_genes_mvp(t.expr, t.cells))


# Every coordinate of every vector enters the two sums.
@query("scale_clip", f"""WITH {EXPR}, {CELLS}, {HVG},
chosen AS (SELECT gene_id, row_number() OVER (ORDER BY gene_id) AS pos FROM hvg WHERE selected),
ms AS (SELECT gene_id, max(pos) AS pos, sum(x) / max(nc) AS m, sqrt((sum(x * x) - sum(x) * sum(x) / max(nc)) / (max(nc) - 1)) AS sd
  FROM expr JOIN chosen USING (gene_id), (SELECT CAST(count(*) AS DOUBLE) AS nc FROM cells) GROUP BY 1),
base AS (SELECT gene_id, pos, m, sd, least(10, -m / sd) AS b FROM ms),
total AS (SELECT count(*) AS k, coalesce(sum(b), 0) AS s, coalesce(sum(pos * b), 0) AS d FROM base),
extra AS (SELECT cell_id, sum(least(10, (x - m) / sd) - b) AS s, sum(pos * (least(10, (x - m) / sd) - b)) AS d
  FROM expr JOIN base USING (gene_id) GROUP BY 1)
SELECT cell_id, k AS n_features, round(total.s + coalesce(extra.s, 0), 4) AS vec_sum, round(total.d + coalesce(extra.d, 0), 3) AS vec_dot
FROM cells LEFT JOIN extra USING (cell_id), total""")
def _(t):
    chosen = qc.selected_genes(qc.variable_genes_mvp(t.expr, t.cells))
    scaled = qc.scale_clip(t.expr, t.cells, chosen)
    whole = scaled.base.agg(F.struct(F.count("*").alias("k"), F.sum("base").alias("s"), F.sum((F.col("pos") + 1) * F.col("base")).alias("d")).alias("w")).scalar()
    extra = F.aggregate("off", F.lit(0.0), lambda a, v: a + v)
    weighted = F.aggregate(F.zip_with("at", "off", lambda i, v: (i + 1) * v), F.lit(0.0), lambda a, v: a + v)
    rows = scaled.rows.withColumn("w", whole)
    out = rows.select("cell_id", F.col("w.k").alias("n_features"), (F.coalesce("w.s", F.lit(0.0)) + extra).alias("vec_sum"), (F.coalesce("w.d", F.lit(0.0)) + weighted).alias("vec_dot"))
    return rounded(rounded(out, 4, "vec_sum"), 3, "vec_dot")


@query("downsample_per_label", f"""WITH {CELLS} SELECT cell_id, label FROM cells
QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(CAST(cell_id AS VARCHAR) || '|7'), cell_id) <= 300""")
def _(t):
    return qc.downsample_per_label(t.cells, "label", 300, 7).select("cell_id", "label")


@query("drop_small_labels", f"""WITH {CELLS} SELECT cell_id, donor FROM cells
QUALIFY count(*) OVER (PARTITION BY donor) >= 20""")
def _(t):
    return qc.drop_small_labels(t.cells.select("cell_id", "donor"), "donor", 20)


@query("exclude_genes", f"""WITH {EXPR}, {GENES} SELECT cell_id, gene_id, round(x, 6) AS x FROM expr JOIN genes USING (gene_id)
WHERE gene_id NOT IN (SELECT gene_id FROM genes WHERE family = 'Brand#1') AND NOT regexp_matches(pathway, '(?i)^economy')""")
def _(t):
    listed = t.genes.where(F.col("family") == "Brand#1")
    tagged = t.expr.join(t.genes.select("gene_id", "pathway"), "gene_id")
    kept = qc.exclude_genes(tagged, names=listed, regex="(?i)^economy", column="pathway")
    return rounded(kept.select("cell_id", "gene_id", "x"), 6, "x")
