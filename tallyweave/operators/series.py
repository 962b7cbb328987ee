"""Ordered series: cells ranked along pseudotime, smoothed, resampled and shaped for a heat map.

Long windows are cut into blocks of positions.  A block also receives the rows that lie within the kernel of
its edges, so every window is complete inside one block and a series of any length spreads over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .profile import minmax_by
from .scale import global_position, lookup_join, require

BLOCK = 4096
"""Positions per block."""


def order_by_pseudotime(cells: DataFrame, col: str) -> DataFrame:
    """(cell_id, pos): rank along ``col``, ties by cell id."""
    require(cells, "cell_id", col)
    return global_position(cells.select("cell_id", col), [col, "cell_id"], "pos").select("cell_id", "pos")


def _with_halo(series: DataFrame, reach: int, block: int) -> DataFrame:
    """Rows repeated into every block they are within ``reach`` of; ``_home`` marks the own block."""
    own = F.floor((F.col("pos") - 1) / block)
    first = F.greatest(F.floor((F.col("pos") - 1 - reach) / block), F.lit(0).cast("long"))
    last = F.floor((F.col("pos") - 1 + reach) / block)
    spread = series.withColumn("_block", F.explode(F.sequence(first, last)))
    return spread.withColumn("_home", F.col("_block") == own)


def moving_average(series: DataFrame, kernel: int = 50, block: int = BLOCK) -> DataFrame:
    """Mean over the positions within ``kernel``, cut off at the ends of the series."""
    require(series, "gene_id", "pos", "x")
    w = Window.partitionBy("gene_id", "_block").orderBy("pos").rowsBetween(-kernel, kernel)
    spread = _with_halo(series.select("gene_id", "pos", "x"), kernel, block)
    return spread.withColumn("x", F.avg("x").over(w)).where("_home").select("gene_id", "pos", "x")


def adaptive_moving_average(
    series: DataFrame, kernel: int = 10, min_kernel: int = 10, range_factor: float = 5.0, block: int = BLOCK
) -> DataFrame:
    """Mean over a window that widens where the series is flat.

    The half width is ``min_kernel + round(range_factor / (sd + 0.1))`` with the sd over ``kernel`` positions
    on each side; rounding is half to even.  The mean comes from running sums of the block.
    """
    require(series, "gene_id", "pos", "x")
    reach = max(kernel, min_kernel + int(round(range_factor / 0.1)) + 1)
    spread = _with_halo(series.select("gene_id", "pos", F.col("x").cast("double").alias("x")), reach, block)
    near = Window.partitionBy("gene_id", "_block").orderBy("pos").rowsBetween(-kernel, kernel)
    sd = F.coalesce(F.stddev_samp("x").over(near), F.lit(0.0))
    half = F.lit(min_kernel) + F.bround(F.lit(float(range_factor)) / (sd + 0.1)).cast("int")
    spread = spread.withColumn("_half", half)

    def smooth(pdf):
        import numpy as np

        pdf = pdf.sort_values("pos", kind="stable")
        total = np.concatenate(([0.0], np.cumsum(pdf["x"].to_numpy())))
        at = np.arange(len(pdf))
        width = pdf["_half"].to_numpy()
        start = np.maximum(at - width, 0)
        stop = np.minimum(at + width, len(pdf) - 1)
        pdf = pdf.assign(x=(total[stop + 1] - total[start]) / (stop + 1 - start))
        return pdf.loc[pdf["_home"], ["gene_id", "pos", "x"]]

    kind = series.schema["gene_id"].dataType.simpleString()
    # a group holds at most one block and its two margins
    return spread.groupBy("gene_id", "_block").applyInPandas(smooth, f"gene_id {kind}, pos long, x double")


def nearest_positions(pseudotime: DataFrame, points: int = 100) -> DataFrame:
    """(point, pos): the cell nearest to each of ``points`` even steps; the smallest position on ties.

    ``pseudotime(pos, t)``.  A point's nearest cell is the last one of the gaps before it or the first one of
    the gaps after it, so one aggregate per gap is enough.
    """
    require(pseudotime, "pos", "t")
    span = pseudotime.agg(F.struct(F.min("t").alias("lo"), F.max("t").alias("hi")).alias("s")).scalar()
    step = (F.col("_s.hi") - F.col("_s.lo")) / F.lit(float(points - 1))
    gap = F.when(step > 0, F.least(F.floor((F.col("t") - F.col("_s.lo")) / step), F.lit(points - 1))).otherwise(0)
    gaps = (
        pseudotime.withColumn("_s", span)
        .groupBy(gap.cast("long").alias("gap"))
        .agg(
            F.min(F.struct("t", "pos")).alias("first"),
            F.max(F.struct(F.col("t"), (-F.col("pos")).alias("np"))).alias("last"),
            F.max("_s").alias("_s"),
        )
    )  # at most one row per point from here on
    frame = pseudotime.sparkSession.range(points).select(F.col("id").alias("gap")).join(F.broadcast(gaps.drop("_s")), "gap", "left")
    upto = Window.orderBy("gap").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("gap").rowsBetween(0, Window.unboundedFollowing)
    frame = frame.withColumn("_s", span).select(
        (F.col("gap") + 1).alias("point"),
        (F.col("_s.lo") + F.col("gap") * step).alias("at"),
        F.max("last").over(upto).alias("l"),
        F.min("first").over(onward).alias("r"),
    )
    candidates = F.array(
        F.struct(F.abs(F.col("l.t") - F.col("at")).alias("d"), (-F.col("l.np")).alias("pos")),
        F.struct(F.abs(F.col("r.t") - F.col("at")).alias("d"), F.col("r.pos").alias("pos")),
    )
    known = F.filter(candidates, lambda c: c["d"].isNotNull())
    return frame.select("point", F.array_min(known)["pos"].alias("pos"))


def resample_nearest(series: DataFrame, pseudotime: DataFrame, points: int = 100) -> DataFrame:
    """(gene_id, point, value): the series read at the cells nearest to even steps of pseudotime."""
    at = nearest_positions(pseudotime, points)
    return series.join(F.broadcast(at), "pos").select("gene_id", "point", F.col("x").alias("value"))  # `points` rows


def dense_series(expr: DataFrame, positions: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene_id, pos, x) for the listed genes over all positions; absent entries are zero."""
    ids = genes.select("gene_id").distinct()
    wanted = ids.agg(F.collect_list("gene_id").alias("g")).scalar()
    stored = lookup_join(expr.select("cell_id", "gene_id", "x"), ids, ["gene_id"], "inner")
    zeros = positions.select("pos", F.explode(wanted).alias("gene_id"), F.lit(0.0).alias("x"))
    stored = stored.join(positions, "cell_id").select("pos", "gene_id", "x")
    return zeros.unionByName(stored).groupBy("gene_id", "pos").agg(F.sum("x").alias("x"))


def pseudotime_heatmap(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, pseudotime: str, normalised: bool = True, points: int = 100
) -> DataFrame:
    """(gene_id, point, value): smoothed, resampled, smoothed again; min-max scaled when ``normalised``."""
    from .scale import materialise

    placed = global_position(cells.select("cell_id", F.col(pseudotime).alias("t")), ["t", "cell_id"], "pos")
    series = adaptive_moving_average(dense_series(expr, placed.select("cell_id", "pos"), genes), 15, 1, 15.0)
    if normalised:
        series = minmax_by(materialise(series), "gene_id")
    sampled = resample_nearest(series, placed.select("pos", "t"), points)
    table = moving_average(sampled.select("gene_id", F.col("point").alias("pos"), F.col("value").alias("x")), 7)
    if normalised:
        table = minmax_by(table, "gene_id")
    return table.select("gene_id", F.col("pos").alias("point"), F.col("x").alias("value"))


def select_genes_ordered(heatmap: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of the listed genes with their place in the list: ``names(gene_id, position)``."""
    require(names, "gene_id", "position")
    listed = names.groupBy("gene_id").agg(F.min("position").alias("position"))
    return lookup_join(heatmap, listed, ["gene_id"], "inner")


def histogram_by_label(cells: DataFrame, col: str, label: str, binwidth: float = 0.01) -> DataFrame:
    """Count per (label, bin) and the label's share of the bin."""
    bin_ = F.floor(F.col(col) / F.lit(float(binwidth))).cast("long")
    tally = cells.groupBy(F.col(label).alias("label"), bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("bin"))  # one row per label
    return tally.withColumn("share", F.col("n") / total)


def density_by_label(cells: DataFrame, col: str, label: str, points: int = 512) -> DataFrame:
    """Gaussian kernel density of ``col`` per label on ``points`` even steps of the whole range.

    The cells are first binned, so the kernel runs over at most ``points`` bins per label.  The bandwidth is
    Silverman's 0.9 * sd * n^(-1/5).
    """
    span = cells.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("s")).scalar()
    step = (F.col("_s.hi") - F.col("_s.lo")) / F.lit(float(points - 1))
    framed = cells.withColumn("_s", span).withColumn("_step", step)
    at = F.when(F.col("_step") > 0, F.round((F.col(col) - F.col("_s.lo")) / F.col("_step"))).otherwise(0).cast("int")
    bins = framed.groupBy(F.col(label).alias("label"), at.alias("_at")).agg(F.count(F.lit(1)).alias("n"))
    spread = framed.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("m"), F.stddev_samp(col).alias("sd"), F.max("_s.lo").alias("lo"), F.max("_step").alias("step")
    )
    held = bins.groupBy("label").agg(F.collect_list(F.struct("_at", "n")).alias("bins"))  # <= `points` per label
    curve = held.join(spread, "label").withColumn("bw", 0.9 * F.col("sd") * F.pow("m", F.lit(-0.2)))
    curve = curve.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    z = lambda b: (F.col("point") - b["_at"]) * F.col("step") / F.col("bw")
    kernel = F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + b["n"] * F.exp(-z(b) * z(b) / 2))
    density = kernel / (F.col("m") * F.col("bw") * 2.5066282746310002)  # sqrt(2 pi)
    return curve.select("label", (F.col("lo") + F.col("point") * F.col("step")).alias("at"), density.alias("density"))
