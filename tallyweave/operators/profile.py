"""Group profiles, their correlation, gene orders, coordinate summaries and label look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.formulas import ratio, two_sided_student
from .markers import label_sizes
from .scale import average_ranks, global_position, join_hot, lookup_join, materialise, quantiles, require


def mean_expression(expr: DataFrame, cells: DataFrame, label: str, genes: DataFrame | None = None) -> DataFrame:
    """Mean x per (label, gene) over all cells of the label; every label gets every gene present."""
    require(cells, "cell_id", label)
    if genes is not None:
        expr = lookup_join(expr, genes.select("gene_id").distinct(), ["gene_id"], "left_semi")
    sums = (
        expr.select("cell_id", "gene_id", "x")
        .join(cells.select("cell_id", F.col(label).alias("label")), "cell_id")
        .groupBy("gene_id", "label")
        .agg(F.sum("x").alias("s"))
    )
    sizes = label_sizes(cells, label).agg(F.collect_list(F.struct("label", "n")).alias("a")).scalar()
    per_gene = sums.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "s"))).alias("m"))
    grid = per_gene.select("gene_id", "m", F.explode(sizes).alias("g"))
    mean = F.coalesce(F.col("m")[F.col("g.label")], F.lit(0.0)) / F.col("g.n")
    return grid.select(F.col("g.label").alias("label"), "gene_id", mean.alias("mean"))


def melt(wide: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """Wide table to (row, col, value)."""
    return wide.unpivot([row], columns, "col", "value").withColumnRenamed(row, "row")


def spot_table(profile: DataFrame, label_order: DataFrame, gene_order: DataFrame) -> DataFrame:
    """Profile with plot positions: x is the rank of the gene, y of the label; vmax the colour limit."""
    require(label_order, "label", "position")
    require(gene_order, "gene_id", "position")
    top = profile.agg((F.floor(F.max("mean")) + 1).alias("v")).scalar()
    rank = lambda order, key, name: order.select(
        key, F.dense_rank().over(Window.orderBy("position")).cast("long").alias(name)
    )  # the orders are the lists of labels and genes to draw
    out = lookup_join(profile, rank(gene_order, "gene_id", "x"), ["gene_id"], "inner")
    out = lookup_join(out, rank(label_order, "label", "y"), ["label"], "inner")
    return out.select("label", "gene_id", "mean", "x", "y").withColumn("vmax", top)


def diagonalise_genes(profile: DataFrame, label_order: DataFrame) -> DataFrame:
    """Order genes by the weight centre of their profile over the ordered labels."""
    placed = lookup_join(profile, label_order, ["label"], "inner")
    centre = ratio(F.sum(F.col("position") * F.col("mean")), F.sum("mean"))
    centres = placed.groupBy("gene_id").agg(F.round(centre, 9).alias("centre"))  # equal profiles tie
    return global_position(centres, [F.col("centre").asc_nulls_last(), "gene_id"], "position")


def cluster_gene_order(profile: DataFrame, k: int, metric: str = "euclidean", seed: int = 1) -> DataFrame:
    """Order genes by similarity of their profiles: bisecting k-means leaves, then weight centre.

    ``spearman`` ranks each gene's values first and standardises the ranks, so that squared distance is
    proportional to 1 - rho.  ``profile(gene_id, col, value)`` must be complete.
    """
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector

    if metric not in ("euclidean", "spearman"):
        raise ValueError(metric)
    value = "value"
    if metric == "spearman":
        w = Window.partitionBy("gene_id").orderBy("value")
        same = Window.partitionBy("gene_id", "value")
        profile = profile.withColumn("value", F.rank().over(w) + (F.count(F.lit(1)).over(same) - 1) / 2.0)
        every = Window.partitionBy("gene_id")
        sd = F.stddev_pop("value").over(every)
        profile = profile.withColumn("value", F.when(sd > 0, (F.col("value") - F.avg("value").over(every)) / sd).otherwise(0.0))
    rows = profile.groupBy("gene_id").agg(
        F.array_sort(F.collect_list(F.struct("col", value))).alias("cells"),
    )
    vec = F.transform("cells", lambda c: c[value])
    weigh = F.transform("cells", lambda c, i: (i + 1) * c[value])
    add = lambda a, v: a + v
    total = F.aggregate(vec, F.lit(0.0), add)
    rows = rows.select(
        "gene_id",
        array_to_vector(vec).alias("features"),
        ratio(F.aggregate(weigh, F.lit(0.0), add), total).alias("centre"),
    )
    rows = materialise(rows)  # read once per split
    leaves = BisectingKMeans(k=k, seed=seed, minDivisibleClusterSize=2.0).fit(rows).transform(rows)
    middle = leaves.groupBy("prediction").agg(F.avg("centre").alias("leaf_centre"))
    leaves = leaves.join(F.broadcast(middle), "prediction")  # at most k rows
    order = [F.col("leaf_centre").asc_nulls_last(), "prediction", F.col("centre").asc_nulls_last(), "gene_id"]
    placed = global_position(leaves.select("gene_id", "prediction", "centre", "leaf_centre"), order, "position")
    return placed.select("gene_id", F.col("prediction").cast("long").alias("leaf"), "position")


def profile_ranks(profile: DataFrame) -> DataFrame:
    """Average ranks of the genes within each label."""
    return average_ranks(profile, ["label"], "mean", None, "rank")


def profile_correlation(query: DataFrame, reference: DataFrame) -> DataFrame:
    """Spearman correlation of every query label with every reference label over their shared genes."""
    shared = query.select("gene_id").intersect(reference.select("gene_id"))
    q = profile_ranks(query.join(shared, "gene_id", "left_semi"))
    r = profile_ranks(reference.join(shared, "gene_id", "left_semi"))
    both = q.select("gene_id", F.col("label").alias("label_q"), F.col("rank").alias("rq")).join(
        r.select("gene_id", F.col("label").alias("label_r"), F.col("rank").alias("rr")), "gene_id"
    )
    return both.groupBy("label_q", "label_r").agg(F.corr("rq", "rr").alias("rho"), F.count(F.lit(1)).alias("n"))


def correlation_pvalue(corr: DataFrame) -> DataFrame:
    """t statistic and two-sided p of each correlation."""
    left = 1 - F.col("rho") * F.col("rho")
    t = F.when(left > 0, F.col("rho") * F.sqrt((F.col("n") - 2) / left))
    p = F.when(left > 0, two_sided_student(F.col("t"), (F.col("n") - 2).cast("double"))).otherwise(0.0)
    return corr.withColumn("t", t).withColumn("p", p)


def label_centroid_median(cells: DataFrame, label: str, x: str, y: str) -> DataFrame:
    """Median x and y per label."""
    long = _axes(cells, [x, y], [label])
    q = quantiles(long, [label, "axis"], "v", [0.5])
    pick = lambda c: F.max(F.when(F.col("axis") == c, F.col("q")))
    return q.groupBy(F.col(label).alias("label")).agg(pick(x).alias("x"), pick(y).alias("y"))


def _axes(cells: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("v")) for c in columns])
    return cells.select(*(keep or []), F.inline(pairs))


def _axis_quantiles(cells: DataFrame, columns: list[str], probs: list[float]) -> Column:
    """One array per call: struct(axis, lo, hi) of the first and last of ``probs``."""
    q = quantiles(_axes(cells, columns), ["axis"], "v", probs)
    edges = q.groupBy("axis").agg(F.min_by("q", "p").alias("lo"), F.max_by("q", "p").alias("hi"))
    entries = F.map_from_entries(F.collect_list(F.struct("axis", F.struct("lo", "hi"))))
    return edges.agg(entries.alias("e")).scalar()


def robust_limits(
    cells: DataFrame, x: str, y: str, q: float = 0.01, factor_x: float = 1.15, factor_y: float = 1.15, pad: float = 0.0
) -> DataFrame:
    """Plot limits: the q and 1-q quantiles of each axis times a factor, padded."""
    spark = cells.sparkSession
    row = spark.range(1).select(_axis_quantiles(cells, [x, y], [q, 1 - q]).alias("e"))
    e = lambda c, end: F.col("e")[c][end]
    return row.select(
        (e(x, "lo") * factor_x - pad).alias("x0"),
        (e(x, "hi") * factor_x + pad).alias("x1"),
        (e(y, "lo") * factor_y - pad).alias("y0"),
        (e(y, "hi") * factor_y + pad).alias("y1"),
    )


def rescale_coordinates(cells: DataFrame, columns: list[str], mode: str = "2d") -> DataFrame:
    """Centre and scale coordinates for viewing.

    ``2d``: limits p1 and p98 times 1.2, centred on their mean, divided by the largest absolute limit of the
    centred data.  ``3d``: limits p1 and p99 times 1.2, the widest range becomes 180.
    """
    if mode not in ("2d", "3d"):
        raise ValueError(mode)
    high = 0.98 if mode == "2d" else 0.99
    framed = cells.withColumn("_e", _axis_quantiles(cells, columns, [0.01, high]))
    lo = {c: F.col("_e")[c]["lo"] for c in columns}
    hi = {c: F.col("_e")[c]["hi"] for c in columns}
    centre = {c: (lo[c] * 1.2 + hi[c] * 1.2) / 2 for c in columns}
    if mode == "2d":
        # quantiles move with the shift, so the limits of the centred data need no second pass
        ends = [F.abs((v[c] - centre[c]) * 1.2) for c in columns for v in (lo, hi)]
        scale = F.lit(1.0) / F.greatest(*ends)
    else:
        scale = F.lit(180.0) / F.greatest(*[hi[c] * 1.2 - lo[c] * 1.2 for c in columns])
    out = framed.withColumns({f"_{c}": (F.col(c) - centre[c]) * scale for c in columns})
    return out.select(*[F.col(f"_{c}").alias(c) if c in columns else F.col(c) for c in cells.columns])


def minmax_by(series: DataFrame, key: str, value: str = "x") -> DataFrame:
    """Min-max scaling within ``key``; a constant key gives null."""
    span = series.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(F.lit(1)).alias("_rows"))
    joined = join_hot(series, span, [key], "_rows")
    scaled = ratio(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return joined.withColumn(value, scaled).select(*series.columns)


def minmax_group_graph(groups: DataFrame, margin: float = 1.4) -> DataFrame:
    """Group positions on the unit square: limits are the extremes times ``margin``; largest groups first."""
    lim = groups.agg(
        F.struct(*[f(c).alias(f"{n}{c}") for c in ("x", "y") for f, n in ((F.min, "lo"), (F.max, "hi"))]).alias("l")
    ).scalar()
    at = lambda c: (F.col(c) - F.col("_l")[f"lo{c}"] * margin) / ((F.col("_l")[f"hi{c}"] - F.col("_l")[f"lo{c}"]) * margin)
    framed = groups.withColumn("_l", lim).withColumns({"_x": at("x"), "_y": at("y")})
    return framed.select("label", F.col("_x").alias("x"), F.col("_y").alias("y"), "size")


def max_by_gene(expr: DataFrame) -> DataFrame:
    """Largest value per gene."""
    return expr.groupBy("gene_id").agg(F.max("x").alias("max"))


def colour_key_check(cells: DataFrame, label: str, key: DataFrame) -> DataFrame:
    """Labels with their colour: ``matched``, labels without one: ``no_colour``, unused keys: ``not_in_data``."""
    used = cells.select(F.col(label).alias("label")).distinct().withColumn("_used", F.lit(True))
    known = key.groupBy("label").agg(F.min("colour").alias("colour"))
    status = (
        F.when(F.col("_used").isNull(), "not_in_data").when(F.col("colour").isNull(), "no_colour").otherwise("matched")
    )
    return used.join(known, "label", "full").select("label", "colour", status.alias("status"))


def map_values(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """Replace mapped values of ``col`` and keep the rest; ``mapping(from, to[, position])``.

    When a value is mapped twice the lowest ``position`` wins, or the smallest target without positions.
    """
    require(mapping, "from", "to")
    first = F.min_by("to", "position") if "position" in mapping.columns else F.min("to")
    pairs = mapping.groupBy(F.col("from").alias(col)).agg(first.alias("_to"))
    joined = lookup_join(df, pairs, [col], "left")
    mapped = F.coalesce(F.col("_to"), F.col(col))
    return joined.withColumn(out or col, mapped).drop("_to")


def update_annotation(cells: DataFrame, cluster_col: str, template: DataFrame, out_col: str) -> DataFrame:
    """Write each cluster's identity from ``template(Cluster, Identity)`` to ``out_col``."""
    require(template, "Cluster", "Identity")
    pairs = template.select(F.col("Cluster").alias("from"), F.col("Identity").alias("to"))
    return map_values(cells, cluster_col, pairs, out_col)


def make_update_template(cells: DataFrame, cluster_col: str) -> DataFrame:
    """Distinct clusters as strings in string order, each with identity ``None``."""
    clusters = cells.select(F.col(cluster_col).cast("string").alias("Cluster")).distinct()
    return clusters.select("Cluster", F.lit("None").alias("Identity")).orderBy("Cluster")
