"""Row and column statistics of the sparse matrix: filters, normalising, variable genes, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.formulas import hash_order
from .scale import join_hot, lookup_join, require
from .sparse import scale_clip  # noqa: F401  scaled values live in a module of their own


def cell_stats(counts: DataFrame) -> DataFrame:
    """Total count and number of detected genes per cell."""
    require(counts, "cell_id", "gene_id", "n")
    return counts.groupBy("cell_id").agg(F.sum("n").alias("n_umi"), F.count_if(F.col("n") > 0).alias("n_gene"))


def gene_stats(counts: DataFrame) -> DataFrame:
    """Number of cells with the gene, and its total count."""
    return counts.groupBy("gene_id").agg(F.count_if(F.col("n") > 0).alias("n_cells"), F.sum("n").alias("total"))


def filter_cells_genes(counts: DataFrame, min_cells: int = 3, min_genes: int = 200) -> DataFrame:
    """Keep cells with more than ``min_genes`` genes, then genes in at least ``min_cells`` kept cells."""
    seen = F.count_if(F.col("n") > 0)
    rows = F.count(F.lit(1)).alias("_rows")
    cells = counts.groupBy("cell_id").agg(seen.alias("_k"), rows).where(F.col("_k") > min_genes)
    kept = join_hot(counts, cells.select("cell_id", "_rows"), ["cell_id"], "_rows", "left_semi")
    genes = kept.groupBy("gene_id").agg(seen.alias("_k"), rows).where(F.col("_k") >= min_cells)
    kept = join_hot(kept, genes.select("gene_id", "_rows"), ["gene_id"], "_rows", "left_semi")
    return kept.select(*counts.columns)


def percent_pattern(counts: DataFrame, genes: DataFrame, regex: str, column: str = "symbol") -> DataFrame:
    """Share of each cell's count that falls on genes whose ``column`` matches ``regex``."""
    require(genes, "gene_id", column)
    hits = genes.where(F.col(column).rlike(regex)).select("gene_id", F.lit(True).alias("_hit")).distinct()
    on = F.sum(F.when(F.col("_hit"), F.col("n")).otherwise(0.0))
    return counts.join(hits, "gene_id", "left").groupBy("cell_id").agg((on / F.sum("n")).alias("pct"))


def filter_threshold(
    cells: DataFrame, col: str, low: float = float("-inf"), high: float = 0.2
) -> DataFrame:
    """Strictly between ``low`` and ``high``."""
    require(cells, col)
    return cells.where((F.col(col) > low) & (F.col(col) < high))


def contingency(cells: DataFrame, c1: str, c2: str, by: str | None = None) -> DataFrame:
    """Cross tally with row totals, column totals and the grand total; ``level`` is the grouping id."""
    n = F.count(F.lit(1)).alias("n")
    if by is None:
        return cells.cube(c1, c2).agg(F.grouping_id().alias("level"), n)
    sets = [[F.col(by), F.col(c1), F.col(c2)], [F.col(by), F.col(c1)], [F.col(by), F.col(c2)], [F.col(by)]]
    return cells.groupingSets(sets, F.col(by), F.col(c1), F.col(c2)).agg(F.grouping_id().alias("level"), n)


def with_cell_total(counts: DataFrame) -> DataFrame:
    """A cell has at most one row per gene, so a window over it is bounded."""
    return counts.withColumn("_total", F.sum("n").over(Window.partitionBy("cell_id")))


def normalise_per_cell(counts: DataFrame, target: float = 1e4) -> DataFrame:
    """Scale each cell to the same total, without the logarithm: ``expr(cell_id, gene_id, n, x)``."""
    scaled = F.col("n") * F.lit(float(target)) / F.col("_total")
    return with_cell_total(counts).select("cell_id", "gene_id", "n", scaled.alias("x"))


def log1p_expr(expr: DataFrame) -> DataFrame:
    return expr.withColumn("x", F.log1p("x"))


def log_normalise(counts: DataFrame, scale: float = 1e4) -> DataFrame:
    """``x = ln(1 + n * scale / cell total)``."""
    return log1p_expr(normalise_per_cell(counts, scale))


def gene_moments(expr: DataFrame, cells: DataFrame, value: Column | str = "x") -> DataFrame:
    """(gene_id, n_cells, s1, mean, var) over all cells; absent entries count as zero."""
    n = cells.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    v = F.col(value) if isinstance(value, str) else value
    sums = expr.groupBy("gene_id").agg(F.sum(v).alias("s1"), F.sum(v * v).alias("s2"))
    sums = sums.withColumn("n_cells", n)
    return sums.select(
        "gene_id",
        "n_cells",
        "s1",
        (F.col("s1") / F.col("n_cells")).alias("mean"),
        ((F.col("s2") - F.col("s1") * F.col("s1") / F.col("n_cells")) / (F.col("n_cells") - 1)).alias("var"),
    )


def _binned_dispersion(genes: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins of ``mean`` with the bin's average and sd of ``dispersion``."""
    lim = genes.agg(F.struct(F.min("mean").alias("lo"), F.max("mean").alias("hi")).alias("lim")).scalar()
    step = (F.col("_lim.hi") - F.col("_lim.lo")) / F.lit(float(bins))
    at = F.when(step > 0, F.ceil((F.col("mean") - F.col("_lim.lo")) / step)).otherwise(1)
    genes = genes.withColumn("_lim", lim).withColumn("bin", F.least(F.lit(bins), F.greatest(F.lit(1), at)).cast("int"))
    spread = genes.groupBy("bin").agg(F.avg("dispersion").alias("bin_mean"), F.stddev_samp("dispersion").alias("bin_sd"))
    return genes.drop("_lim").join(F.broadcast(spread), "bin")  # one row per bin


def variable_genes_mvp(
    expr: DataFrame, cells: DataFrame, x_low: float = 0.0125, x_high: float = 3.0, y: float = 0.625, bins: int = 20, by: str | None = None
) -> DataFrame:
    """Mean and variance-to-mean ratio of the un-logged values; z-score of the dispersion in mean bins.

    With ``by`` (a column of cells) every key has its own means, bins and choice."""
    keys = [by] if by else []
    if by:
        n = cells.groupBy(by).agg(F.count(F.lit(1)).cast("double").alias("n_cells"))
        v = F.expm1("x")
        sums = expr.join(cells.select("cell_id", by), "cell_id").groupBy(by, "gene_id").agg(F.sum(v).alias("s1"), F.sum(v * v).alias("s2"))
        m = lookup_join(sums, n, [by], "inner")
        m = m.withColumn("mean", F.col("s1") / F.col("n_cells")).withColumn("var", (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n_cells")) / F.when(F.col("n_cells") > 1, F.col("n_cells") - 1))
    else:
        m = gene_moments(expr, cells, F.expm1("x"))
    dispersion = F.when((F.col("var") > 0) & (F.col("mean") > 0), F.log(F.col("var") / F.col("mean")))
    genes = m.select(*keys, "gene_id", F.log(F.col("mean") + 1).alias("mean"), F.coalesce(dispersion, F.lit(0.0)).alias("dispersion"))
    z = F.when(F.col("bin_sd") > 0, (F.col("dispersion") - F.col("bin_mean")) / F.col("bin_sd"))
    keep = (F.col("mean") > x_low) & (F.col("mean") < x_high) & (F.col("z") > y)
    binned = _binned_by(genes, bins, by) if by else _binned_dispersion(genes, bins)
    return binned.withColumn("z", F.coalesce(z, F.lit(0.0))).select(*keys, "gene_id", "mean", "dispersion", "z", keep.alias("selected"))


def _binned_by(genes: DataFrame, bins: int, by: str) -> DataFrame:
    """Equal-width bins of ``mean`` inside each key, with the bin's average and sd of ``dispersion``; windows over genes, not cells."""
    whole = Window.partitionBy(by)
    low, high = F.min("mean").over(whole), F.max("mean").over(whole)
    step = (high - low) / F.lit(float(bins))
    at = F.when(step > 0, F.ceil((F.col("mean") - low) / step)).otherwise(1)
    genes = genes.withColumn("bin", F.least(F.lit(bins), F.greatest(F.lit(1), at)).cast("int"))
    own = Window.partitionBy(by, "bin")
    return genes.withColumns({"bin_mean": F.avg("dispersion").over(own), "bin_sd": F.stddev_samp("dispersion").over(own)})


def variable_genes_dispersion(
    expr: DataFrame, cells: DataFrame, min_mean: float = 0.0125, max_mean: float = 3.0, min_disp: float = 0.5, bins: int = 20
) -> DataFrame:
    """The same on un-logged input; a bin with one gene scores it 1."""
    m = gene_moments(expr, cells)
    dispersion = F.when((F.col("var") > 0) & (F.col("mean") > 0), F.log(F.col("var") / F.col("mean")))
    genes = m.select("gene_id", F.log1p("mean").alias("mean"), F.coalesce(dispersion, F.lit(0.0)).alias("dispersion"))
    alone = F.col("bin_sd").isNull()
    z = F.when(alone, F.lit(1.0)).when(
        F.col("bin_sd") > 0, (F.col("dispersion") - F.col("bin_mean")) / F.col("bin_sd")
    )
    keep = (F.col("mean") > min_mean) & (F.col("mean") < max_mean) & (F.col("z") > min_disp)
    return (
        _binned_dispersion(genes, bins)
        .withColumn("z", F.coalesce(z, F.lit(0.0)))
        .select("gene_id", "mean", "dispersion", "z", keep.alias("selected"))
    )


def selected_genes(hvg: DataFrame) -> DataFrame:
    return hvg.where("selected").select("gene_id")


def pct_variable(hvg: DataFrame) -> DataFrame:
    """Percentage of genes selected."""
    return hvg.agg(F.round(100.0 * F.count_if("selected") / F.count(F.lit(1)), 2).alias("pct"))


def downsample_per_label(cells: DataFrame, label: str, k: int, seed: int) -> DataFrame:
    """At most ``k`` cells per label, in md5 order; every task keeps only its first ``k`` per label."""
    require(cells, "cell_id", label)
    w = Window.partitionBy(label).orderBy(hash_order(F.col("cell_id"), seed), "cell_id")
    return cells.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def drop_small_labels(cells: DataFrame, label: str, least: int) -> DataFrame:
    """Drop the cells of labels with fewer than ``least`` cells."""
    sizes = cells.groupBy(label).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= least)
    return join_hot(cells, sizes, [label], "_rows", "left_semi").select(*cells.columns)


def exclude_genes(df: DataFrame, names: DataFrame | None = None, regex: str | None = None, column: str = "gene_id") -> DataFrame:
    """Drop rows whose gene is listed in ``names(gene_id)`` or whose ``column`` matches ``regex``."""
    if names is not None:
        df = lookup_join(df, names.select("gene_id").distinct(), ["gene_id"], "left_anti")
    if regex is not None:
        df = df.where(~F.col(column).rlike(regex))
    return df
