"""Ordered series: smoothing and resampling along pseudotime."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tallyweave.operators import series

from .base import CELLS, EXPR, query, rounded
from .markers import LISTED, listed

EVENTS = """ser AS (SELECT event_type AS gene_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos, value AS x FROM events)"""


def _events(t):
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    return t.events.select(F.col("event_type").alias("gene_id"), F.row_number().over(w).cast("long").alias("pos"), F.col("value").alias("x"))


@query("order_by_pseudotime", f"WITH {CELLS} SELECT cell_id, row_number() OVER (ORDER BY pseudotime, cell_id) AS pos FROM cells")
def _(t):
    return series.order_by_pseudotime(t.cells, "pseudotime")


@query("moving_average", f"""WITH {EVENTS} SELECT gene_id, pos, round(avg(x) OVER (PARTITION BY gene_id ORDER BY pos
ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING), 9) AS x FROM ser""")
def _(t):
    return rounded(series.moving_average(_events(t), 50), 9, "x")


def adaptive_sql(source: str, out: str, kernel: int, least: int, factor: float) -> str:
    return f"""{out}_k AS (SELECT gene_id, pos, x, {least} + CAST(round_even({factor} / (coalesce(stddev_samp(x) OVER (PARTITION BY gene_id ORDER BY pos
  ROWS BETWEEN {kernel} PRECEDING AND {kernel} FOLLOWING), 0) + 0.1e0), 0) AS BIGINT) AS h, sum(x) OVER (PARTITION BY gene_id ORDER BY pos) AS c,
  max(pos) OVER (PARTITION BY gene_id) AS n FROM {source}),
{out} AS (SELECT a.gene_id, a.pos, (b.c - coalesce(d.c, 0)) / (least(a.pos + a.h, a.n) - greatest(a.pos - a.h, 1) + 1) AS x
  FROM {out}_k a JOIN {out}_k b ON b.gene_id = a.gene_id AND b.pos = least(a.pos + a.h, a.n)
  LEFT JOIN {out}_k d ON d.gene_id = a.gene_id AND d.pos = greatest(a.pos - a.h, 1) - 1)"""


@query("adaptive_moving_average", f"WITH {EVENTS}, {adaptive_sql('ser', 'sm', 10, 10, 400.0)} SELECT gene_id, pos, round(x, 9) AS x FROM sm")
def _(t):
    return rounded(series.adaptive_moving_average(_events(t), 10, 10, 400.0), 9, "x")


ORDERED = f"""{EXPR}, {CELLS}, {LISTED},
placed AS (SELECT cell_id, pseudotime AS t, row_number() OVER (ORDER BY pseudotime, cell_id) AS pos FROM cells),
ser AS (SELECT l.gene_id, p.pos, coalesce(x, 0e0) AS x FROM placed p CROSS JOIN listed l LEFT JOIN expr e ON e.cell_id = p.cell_id AND e.gene_id = l.gene_id),
pts AS (SELECT j + 1 AS point, lo + j * ((hi - lo) / 99e0) AS tt FROM range(100) r(j), (SELECT min(t) AS lo, max(t) AS hi FROM placed)),
near AS (SELECT point, pos FROM pts, placed QUALIFY row_number() OVER (PARTITION BY point ORDER BY abs(t - tt), pos) = 1)"""


@query("resample_nearest", f"WITH {ORDERED} SELECT gene_id, point, round(x, 6) AS value FROM ser JOIN near USING (pos)")
def _(t):
    from tallyweave.operators.scale import global_position

    placed = global_position(t.cells.select("cell_id", F.col("pseudotime").alias("t")), ["t", "cell_id"], "pos")
    dense = series.dense_series(t.expr, placed.select("cell_id", "pos"), listed(t))
    return rounded(series.resample_nearest(dense, placed.select("pos", "t")).withColumn("point", F.col("point").cast("long")), 6, "value")


HEAT = f"""{ORDERED}, {adaptive_sql('ser', 'sm', 15, 1, 15.0)}"""
MA7 = "avg(value) OVER (PARTITION BY gene_id ORDER BY point ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)"
UNIT = "({v} - min({v}) OVER (PARTITION BY gene_id)) / nullif(max({v}) OVER (PARTITION BY gene_id) - min({v}) OVER (PARTITION BY gene_id), 0)"
NORMALISED = f"""{HEAT}, unit AS (SELECT gene_id, pos, {UNIT.format(v='x')} AS value FROM sm),
samp AS (SELECT gene_id, point, value FROM unit JOIN near USING (pos)), ma AS (SELECT gene_id, point, {MA7} AS value FROM samp),
heat AS (SELECT gene_id, point, {UNIT.format(v='value')} AS value FROM ma)"""


@query("pseudotime_heatmap", f"WITH {NORMALISED} SELECT gene_id, point, round(value, 6) + 0e0 AS value FROM heat")
def _(t):
    return rounded(series.pseudotime_heatmap(t.expr, t.cells, listed(t), "pseudotime"), 6, "value")


@query("pseudotime_heatmap_raw", f"""WITH {HEAT}, samp AS (SELECT gene_id, point, x AS value FROM sm JOIN near USING (pos))
SELECT gene_id, point, round({MA7}, 6) AS value FROM samp""")
def _(t):
    return rounded(series.pseudotime_heatmap(t.expr, t.cells, listed(t), "pseudotime", normalised=False), 6, "value")


@query("select_genes_ordered", f"""WITH {NORMALISED}, names AS (SELECT gene_id, row_number() OVER (ORDER BY md5(CAST(gene_id AS VARCHAR))) AS position FROM listed)
SELECT gene_id, point, round(value, 6) + 0e0 AS value, position FROM heat JOIN names USING (gene_id) WHERE position <= 5""")
def _(t):
    heat = series.pseudotime_heatmap(t.expr, t.cells, listed(t), "pseudotime")
    w = Window.orderBy(F.md5(F.col("gene_id").cast("string")))
    names = listed(t).select("gene_id", F.row_number().over(w).cast("long").alias("position")).where("position <= 5")
    return rounded(series.select_genes_ordered(heat, names), 6, "value")


@query("histogram_by_label", f"""WITH {CELLS}, h AS (SELECT label, CAST(floor(pseudotime / 10000e0) AS BIGINT) AS bin, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT label, bin, n, round(n / sum(n) OVER (PARTITION BY bin), 6) AS share FROM h""")
def _(t):
    return rounded(series.histogram_by_label(t.cells, "pseudotime", "label", 10000.0), 6, "share")


@query("density_by_label", f"""WITH {CELLS}, lim AS (SELECT min(pseudotime) AS lo, (max(pseudotime) - min(pseudotime)) / 511e0 AS step FROM cells),
bins AS (SELECT label, CAST(round((pseudotime - lo) / step) AS INTEGER) AS b, count(*) AS n FROM cells, lim GROUP BY 1, 2),
w AS (SELECT label, count(*) AS m, 0.9e0 * stddev_samp(pseudotime) * pow(count(*), -0.2e0) AS bw FROM cells GROUP BY 1)
SELECT label, round(lo + j * step, 6) AS at, round(1e6 * sum(n * exp(-pow((j - b) * step / bw, 2) / 2)) / (max(m) * max(bw) * 2.5066282746310002), 5) AS density
FROM bins JOIN w USING (label), lim, range(512) r(j) GROUP BY label, j, lo, step""")
def _(t):
    out = series.density_by_label(t.cells, "pseudotime", "label")
    return rounded(rounded(out.withColumn("density", F.col("density") * 1e6), 6, "at"), 5, "density")
