"""Rank-sum marker tests on sparse data, marker annotation, trend tests and multiple-testing correction.

The tests never build a dense matrix and never loop over labels.  Values of a gene are tallied as
(gene, value, label, count) before they are ordered, so ties cost nothing, and the order is computed in blocks
of the value axis so that no task holds a whole gene.  Zeros are not stored: they share one rank below all
others, which needs only the number of cells.  Values must therefore be zero or positive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.formulas import bind, ratio, two_sided_normal, upper_f
from .qc import downsample_per_label
from .scale import in_pieces, join_hot, lookup_join, materialise, quantiles, require, running, tasks_for

BLOCKS_PER_UNIT = 32.0
"""Blocks of the value axis per unit of log-normalised expression."""

RESULT = ["avg_logFC", "pct_1", "pct_2", "z", "p_val", "p_val_adj"]


def value_block(value: Column) -> Column:
    return F.floor(value * F.lit(BLOCKS_PER_UNIT)).cast("long")


def label_sizes(cells: DataFrame, label: str) -> DataFrame:
    """(label, n): one row per annotation label."""
    require(cells, label)
    return cells.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def label_tally(expr: DataFrame, cells: DataFrame, label: str) -> DataFrame:
    """(gene_id, x, label, c) over stored non-zero values."""
    labelled = expr.where(F.col("x") != 0).select("cell_id", "gene_id", "x").join(
        cells.select("cell_id", F.col(label).alias("label")), "cell_id"
    )
    return labelled.groupBy("gene_id", "x", "label").agg(F.count(F.lit(1)).alias("c"))


def _scored(df: DataFrame, n_genes: Column) -> DataFrame:
    """z, p and the Bonferroni p from the rank sum ``R``, sizes ``n1 n2`` and tie term ``T``."""
    total = F.col("n1") + F.col("n2")
    u = F.col("R") - F.col("n1") * (F.col("n1") + 1) / 2 - F.col("n1") * F.col("n2") / 2
    var = F.col("n1") * F.col("n2") / 12.0 * ((total + 1) - F.col("T") / (total * (total - 1)))
    df = df.withColumn("_u", u).withColumn("_s", F.sqrt(F.greatest(var, F.lit(0.0))))
    # one rank sum is known to within about 1e-9; below that the variance is a rounding remnant
    z = F.when(F.col("_s") > 1e-6, (F.col("_u") - 0.5 * F.signum("_u")) / F.col("_s")).otherwise(0.0)
    df = df.withColumn("z", z).withColumn("p_val", F.least(F.lit(1.0), F.expr(two_sided_normal("z"))))
    return df.withColumn("p_val_adj", F.least(F.lit(1.0), F.col("p_val") * n_genes)).drop("_u", "_s")


def _log_mean(total: str, n: str) -> Column:
    return F.log(ratio(F.col(total), F.col(n), 0.0) + 1)


def _share(hits: str, n: str) -> Column:
    return ratio(F.col(hits), F.col(n), 0.0)


def markers_one_vs_rest(
    expr: DataFrame,
    cells: DataFrame,
    label: str,
    min_pct: float = 0.25,
    logfc: float = 0.25,
    max_cells: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Every label against all other cells, all labels in one plan.

    ``max_cells`` caps every label first (a fixed md5 order), and the test then runs on the capped cells.
    The Bonferroni factor is the number of genes present in ``expr``, which is read three times: pass a written table, or one that is
    cheap to make.  Tasks are as many as its rows ask for.
    """
    n_genes = expr.select("gene_id").distinct().agg(F.count(F.lit(1)).alias("g")).scalar()
    if max_cells is not None:
        cells = downsample_per_label(cells, label, max_cells, seed)
    tasks = tasks_for(expr.sparkSession, expr.count())
    labelled = expr.where(F.col("x") != 0).select("cell_id", "gene_id", "x").repartition(tasks, "cell_id")
    labelled = labelled.join(cells.select("cell_id", F.col(label).alias("label")), "cell_id").withColumn("_block", value_block(F.col("x")))
    # dealt once by gene and block, which serves the tally, the order inside a block and its sums
    tally = labelled.repartition(tasks, "gene_id", "_block").groupBy("gene_id", "_block", "x", "label").agg(F.count(F.lit(1)).alias("c"))
    piece = Window.partitionBy("gene_id", "_block")
    ranked = tally.select(
        "gene_id", "_block", "label", "c", "x",
        F.sum("c").over(piece.orderBy("x")).alias("upto"),
        F.sum("c").over(Window.partitionBy("gene_id", "_block", "x")).alias("t"),
    )
    c, t = F.col("c").cast("double"), F.col("t").cast("double")
    pieces = ranked.groupBy("gene_id", "_block", "label").agg(
        F.sum("c").alias("c"),
        F.sum(c * (F.col("upto") - (t - 1) / 2)).alias("r"),
        F.sum(c * (t * t - 1)).alias("ties"),
        F.sum(c * F.expm1("x")).alias("e"),
    )
    below = Window.partitionBy("gene_id").orderBy("_block").rangeBetween(Window.unboundedPreceding, -1)
    # counts below a block, over the few (block, label) rows of a gene
    pieces = pieces.repartition(tasks, "gene_id").withColumn("below", F.coalesce(F.sum("c").over(below), F.lit(0)))
    sizes = label_sizes(cells, label)
    all_labels = sizes.agg(F.collect_list(F.struct("label", "n")).alias("a")).scalar()
    per_label = pieces.groupBy("gene_id", "label").agg(
        F.sum("c").alias("c"),
        F.sum(F.col("r") + F.col("c") * F.col("below")).alias("r"),
        F.sum("ties").alias("ties"),
        F.sum("e").alias("e"),
    )
    # one row per gene holds its labels (at most one entry per label), then every label gets its row
    per_gene = per_label.groupBy("gene_id").agg(
        F.sum("c").alias("gc"), F.sum("ties").alias("gties"), F.sum("e").alias("ge"),
        F.map_from_entries(F.collect_list(F.struct("label", F.struct("c", "r", "e")))).alias("by_label"),
    )
    total = cells.agg(F.count(F.lit(1)).alias("n")).scalar()
    grid = (
        per_gene.select("*", total.alias("N"), F.explode(all_labels).alias("g"))
        .select("*", F.col("g.label").alias("cluster"), F.col("g.n").cast("double").alias("n1"))
        .withColumn("m", F.col("by_label")[F.col("cluster")])
        .select(
            "cluster", F.col("gene_id").alias("gene"), "n1", "gc", "ge", "gties", "N",
            F.coalesce("m.c", F.lit(0)).alias("c1"),
            F.coalesce("m.r", F.lit(0.0)).alias("r1"),
            F.coalesce("m.e", F.lit(0.0)).alias("e1"),
        )
    )
    zeros = F.col("N") - F.col("gc")
    grid = (
        grid.withColumn("n2", F.col("N") - F.col("n1"))
        .withColumn("c2", F.col("gc") - F.col("c1"))
        .withColumn("e2", F.col("ge") - F.col("e1"))
        .withColumn("z0", zeros.cast("double"))
        .withColumn("avg_logFC", _log_mean("e1", "n1") - _log_mean("e2", "n2"))
        .withColumn("pct_1", _share("c1", "n1"))
        .withColumn("pct_2", _share("c2", "n2"))
        .where((F.greatest("pct_1", "pct_2") >= min_pct) & (F.abs("avg_logFC") >= logfc))
        .withColumn("R", F.col("r1") + F.col("c1") * F.col("z0") + (F.col("n1") - F.col("c1")) * (F.col("z0") + 1) / 2)
        .withColumn("T", F.col("gties") + F.col("z0") * (F.col("z0") * F.col("z0") - 1))
    )
    return _scored(grid, n_genes).select("cluster", "gene", *RESULT)


def markers_pairwise(
    expr: DataFrame,
    cells: DataFrame,
    label: str,
    pairs: DataFrame,
    max_cells: int | None = None,
    min_pct: float = 0.1,
    logfc: float = 0.25,
    seed: int = 0,
) -> DataFrame:
    """Each (query, reference) pair of labels against each other; equal labels are skipped.

    With ``max_cells`` every label is capped first, so a pair costs at most twice that
    many values per gene.  ``pairs(query, reference)`` is a lookup table.  Leading ``Q::`` and ``R::`` are
    stripped from the reported names.
    """
    require(pairs, "query", "reference")
    n_genes = expr.select("gene_id").distinct().agg(F.count(F.lit(1)).alias("g")).scalar()
    if max_cells is not None:
        cells = downsample_per_label(cells, label, max_cells, seed)
    pairs = pairs.where(F.col("query") != F.col("reference")).select("query", "reference").distinct()
    tally = label_tally(expr, cells, label)
    as_query = lookup_join(tally, pairs.select(F.col("query").alias("label"), "query", "reference"), ["label"], "inner")
    as_ref = lookup_join(tally, pairs.select(F.col("reference").alias("label"), "query", "reference"), ["label"], "inner")
    key = ["query", "reference", "gene_id"]
    both = as_query.select(*key, "x", F.col("c").alias("cq"), F.lit(0).cast("long").alias("cr")).unionByName(
        as_ref.select(*key, "x", F.lit(0).cast("long").alias("cq"), F.col("c").alias("cr"))
    )
    at = both.groupBy(*key, "x").agg(F.sum("cq").cast("double").alias("cq"), F.sum("cr").cast("double").alias("cr"))
    at = running(at, key, ["x"], value_block(F.col("x")), {"ur": "cr"})
    t = F.col("cq") + F.col("cr")
    sums = at.groupBy(*key).agg(
        F.sum("cq").alias("c1"),
        F.sum("cr").alias("c2"),
        F.sum(F.col("cq") * (F.col("ur") - F.col("cr") / 2)).alias("u"),
        F.sum(t * (t * t - 1)).alias("ties"),
        F.sum(F.col("cq") * F.expm1("x")).alias("e1"),
        F.sum(F.col("cr") * F.expm1("x")).alias("e2"),
    )
    sizes = label_sizes(cells, label)
    sums = lookup_join(sums, sizes.select(F.col("label").alias("query"), F.col("n").cast("double").alias("n1")), ["query"], "inner")
    sums = lookup_join(sums, sizes.select(F.col("label").alias("reference"), F.col("n").cast("double").alias("n2")), ["reference"], "inner")
    z0 = F.col("n1") + F.col("n2") - F.col("c1") - F.col("c2")
    sums = (
        sums.withColumn("z0", z0)
        .withColumn("avg_logFC", _log_mean("e1", "n1") - _log_mean("e2", "n2"))
        .withColumn("pct_1", _share("c1", "n1"))
        .withColumn("pct_2", _share("c2", "n2"))
        .where((F.greatest("pct_1", "pct_2") >= min_pct) & (F.abs("avg_logFC") >= logfc))
        # ranks among the query's own values, then values of the reference below, then zeros
        .withColumn(
            "R",
            F.col("c1") * (F.col("c1") + 1) / 2 + F.col("u") + F.col("c1") * F.col("z0")
            + (F.col("n1") - F.col("c1")) * (F.col("z0") + 1) / 2,
        )
        .withColumn("T", F.col("ties") + F.col("z0") * (F.col("z0") * F.col("z0") - 1))
    )
    bare = lambda c: F.regexp_replace(c, "^[QR]::", "")
    return _scored(sums, n_genes).select(
        bare("query").alias("query"), bare("reference").alias("reference"), F.col("gene_id").alias("gene"), *RESULT
    )


def top_markers(markers: DataFrame, n: int, by: str = "avg_logFC", group: str = "cluster", lowest: bool = False) -> DataFrame:
    """The ``n`` best rows per group, ties kept."""
    key = F.col(by).asc() if lowest else F.col(by).desc()
    w = Window.partitionBy(group).orderBy(key)
    return markers.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= n).drop("_rank")


def annotate_markers(markers: DataFrame, gene_info: DataFrame, columns: list[str]) -> DataFrame:
    """Look up descriptive ``columns`` by gene; genes without an entry keep their own name."""
    require(gene_info, "gene", *columns)
    info = gene_info.groupBy("gene").agg(*[F.min(c).alias(c) for c in columns])
    out = lookup_join(markers, info, ["gene"], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col("gene").cast("string")) for c in columns})


def also_present_in(top: DataFrame) -> DataFrame:
    """Add the comma list of clusters that share the marker; empty when there is only one."""
    where = top.select("gene", "cluster").distinct().groupBy("gene").agg(F.array_sort(F.collect_list("cluster")).alias("_in"))
    listed = F.when(F.size("_in") > 1, F.array_join("_in", ", ")).otherwise("")
    return top.join(where, "gene").withColumn("also_present_in", listed).drop("_in")


def cell_type_flag(top: DataFrame, gene_to_pop: DataFrame) -> DataFrame:
    """Add the populations a gene is known for, joined by ``", "``; empty when there is none."""
    require(gene_to_pop, "gene", "populations")
    flags = split_populations(gene_to_pop).groupBy("gene").agg(F.array_join(F.array_sort(F.collect_set("population")), ", ").alias("cell_type_flag"))
    return lookup_join(top, flags, ["gene"], "left").fillna("", ["cell_type_flag"])


def split_populations(gene_to_pop: DataFrame) -> DataFrame:
    """(gene, population) from the ``", "`` separated list."""
    return gene_to_pop.select("gene", F.explode(F.split("populations", ", ")).alias("population")).distinct()


def population_mentions(profile: DataFrame, gene_to_pop: DataFrame, top: int | None = None) -> DataFrame:
    """Per label: every population flagged by a gene gets 100 * mean / genes of that population.

    ``profile(label, gene_id, mean)`` should already lack the genes that are not to count.
    """
    flags = split_populations(gene_to_pop).withColumnRenamed("gene", "gene_id")
    weight = flags.groupBy("population").agg(F.count(F.lit(1)).alias("genes"))
    flags = lookup_join(flags, weight, ["population"], "inner")
    hit = lookup_join(profile.where(F.col("mean") != 0), flags, ["gene_id"], "inner")
    out = hit.groupBy("label", "population").agg(F.sum(100.0 * F.col("mean") / F.col("genes")).alias("weight"))
    out = out.withColumn("freq", F.round(100 * F.col("weight")).cast("long")).where(F.col("freq") >= 1)
    if top is None:
        return out
    w = Window.partitionBy("label").orderBy(F.col("freq").desc(), "population")
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).drop("_rn")


def marker_expression_long(expr: DataFrame, cells: DataFrame, label: str, pair: tuple[str, str], genes: DataFrame) -> DataFrame:
    """(population, gene_id, cell_id, x) of chosen genes in two labels, zeros included."""
    query, reference = pair
    name = F.when(F.col(label) == query, "Query_Population").otherwise("Reference_Population")
    picked = cells.where(F.col(label).isin(query, reference)).select("cell_id", name.alias("population"))
    return dense_grid(expr, picked, genes).select("population", "gene_id", "cell_id", "x")


def dense_grid(expr: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Every cell of ``cells`` with every gene of the list ``genes``; absent entries are zero.

    The list rides along as one array per cell; stored values are gathered per cell and looked up in it.
    """
    ids = genes.select("gene_id").distinct()
    wanted = ids.agg(F.collect_list("gene_id").alias("g")).scalar()
    stored = lookup_join(expr.select("cell_id", "gene_id", "x"), ids, ["gene_id"], "inner")
    zeros = cells.withColumn("gene_id", F.explode(wanted)).withColumn("x", F.lit(0.0))
    tagged = stored.join(cells, "cell_id", "inner").select(*zeros.columns)
    keep = [c for c in zeros.columns if c not in ("cell_id", "gene_id", "x")]
    return zeros.unionByName(tagged).groupBy("cell_id", "gene_id", *keep).agg(F.sum("x").alias("x"))


def size_factors(counts: DataFrame) -> DataFrame:
    """Cell total over the geometric mean of the cell totals."""
    totals = counts.groupBy("cell_id").agg(F.sum("n").alias("total"))
    centre = totals.agg(F.exp(F.avg(F.log("total"))).alias("g")).scalar()
    return totals.select("cell_id", (F.col("total") / centre).alias("size_factor"))


def bh_adjust(df: DataFrame, p: str, group: str | None = None, name: str = "q") -> DataFrame:
    """Benjamini-Hochberg within ``group``: smallest ``p * n / rank`` at or above each p.

    Equal p-values share the value of their last rank, so the work runs on the distinct p-values, in pieces of about equal size.
    """
    by = [group] if group else []
    keyed = df if by else df.withColumn("_all", F.lit(0))
    by = by or ["_all"]
    tally = keyed.where(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count(F.lit(1)).alias("_n"))
    tally = in_pieces(materialise(tally), by, p)
    ranked = running(tally, by, [p], F.col("_piece"), {"_rank": "_n"})
    sizes = tally.groupBy(*by).agg(F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_rows"))


    ranked = join_hot(ranked, sizes, by, "_rows")
    ranked = ranked.withColumn("_raw", F.col(p) * F.col("_size") / F.col("_rank")).withColumnRenamed("_piece", "_block")
    lows = ranked.groupBy(*by, "_block").agg(F.min("_raw").alias("_low"))
    above = Window.partitionBy(*by).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lows = lows.select(*by, "_block", F.min("_low").over(above).alias("_above"))
    inside = Window.partitionBy(*by, "_block").orderBy(F.col(p).desc()).rowsBetween(Window.unboundedPreceding, 0)
    adjusted = ranked.withColumn("_in", F.min("_raw").over(inside)).join(lows, [*by, "_block"])
    adjusted = adjusted.select(*by, p, F.least("_in", "_above").alias(name), "_n")
    return join_hot(keyed, adjusted, [*by, p], "_n", "left").drop("_all")


def spline_basis(cells: DataFrame, pseudotime: str, by: str | None = None) -> DataFrame:
    """Natural cubic spline columns b1..b3 per cell; knots at min, q33, q67 and max of pseudotime.

    With ``by`` each group has its own knots.  Truncated-power form; the constant is left out.
    """
    keys = [by] if by else []
    limits = cells.groupBy(*keys).agg(F.min(pseudotime).alias("k1"), F.max(pseudotime).alias("k4"), F.count(F.lit(1)).alias("_rows"))
    inner = quantiles(cells, keys, pseudotime, [0.33, 0.67])
    inner = inner.groupBy(*keys).agg(F.min("q").alias("k2"), F.max("q").alias("k3"))


    if by:
        knots = join_hot(cells, limits.join(inner, keys), keys, "_rows")
    else:
        both = limits.drop("_rows").select("*", inner.agg(F.struct(F.max("k2").alias("k2"), F.max("k3").alias("k3")).alias("k")).scalar().alias("k"))
        both = both.agg(F.struct(F.max("k1").alias("k1"), F.max("k.k2").alias("k2"), F.max("k.k3").alias("k3"), F.max("k4").alias("k4")).alias("k"))
        knots = cells.withColumn("_k", both.scalar()).select("*", "_k.k1", "_k.k2", "_k.k3", "_k.k4").drop("_k")
    u = lambda c: (F.col(c) - F.col("k1")) / (F.col("k4") - F.col("k1"))
    cube = lambda knot: F.pow(F.greatest(F.col("_t") - knot, F.lit(0.0)), F.lit(3.0))
    knots = knots.withColumns({"_t": u(pseudotime), "_a": u("k2"), "_b": u("k3")})
    one = F.lit(1.0)
    last = (cube(F.col("_b")) - cube(one)) / (one - F.col("_b"))
    return knots.select(
        *keys, "cell_id",
        F.col("_t").alias("b1"),
        ((cube(F.lit(0.0)) - cube(one)) / one - last).alias("b2"),
        ((cube(F.col("_a")) - cube(one)) / (one - F.col("_a")) - last).alias("b3"),
    )


def trend_genes(expr: DataFrame, cells: DataFrame, pseudotime: str, by: str | None = None) -> DataFrame:
    """Genes that vary along pseudotime: natural spline against a constant, F test, BH over genes.

    The negative-binomial likelihood ratio is replaced by least squares on normalised log values.  The
    cross-products of the basis are shared by all genes of a group, so one aggregate over the stored values
    gives every gene its sums, and one 4 x 4 solve per group gives the fit.
    """
    keys = [by] if by else []
    basis = spline_basis(cells, pseudotime, by)
    b = ["b1", "b2", "b3"]
    gram = basis.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("m00"),
        *[F.sum(c).alias(f"m0{i}") for i, c in enumerate(b, 1)],
        *[F.sum(F.col(b[i - 1]) * F.col(b[j - 1])).alias(f"m{i}{j}") for i in (1, 2, 3) for j in range(i, 4)],
    )
    kinds = [f"{c} {gram.schema[c].dataType.simpleString()}" for c in keys]

    def invert(frames):
        """Inverse of the lower Cholesky factor of each group's 4 x 4 cross-products."""
        import numpy as np

        for pdf in frames:
            full = np.zeros((len(pdf), 4, 4))
            for i in range(4):
                for j in range(i, 4):
                    full[:, i, j] = full[:, j, i] = pdf[f"m{i}{j}"]
            rows = pdf[[*keys, "m00"]].copy()
            inverse = np.linalg.inv(np.linalg.cholesky(full)) if len(pdf) else full
            for i in range(4):
                for j in range(i + 1):
                    rows[f"l{i}{j}"] = inverse[:, i, j]
            yield rows

    lower = [f"l{i}{j}" for i in range(4) for j in range(i + 1)]
    solved = gram.where(F.col("m00") > 4).mapInPandas(invert, ", ".join([*kinds, "m00 double", *[f"{c} double" for c in lower]]))
    x = F.col("x")
    sums = expr.select("cell_id", "gene_id", "x").join(basis, "cell_id").groupBy(*keys, "gene_id").agg(
        F.sum(x * x).alias("yy"), F.sum(x).alias("s0"), *[F.sum(x * F.col(c)).alias(f"s{i}") for i, c in enumerate(b, 1)]
    )
    if by:
        sums = lookup_join(sums, solved, keys, "inner")
    else:
        row = solved.agg(F.struct(*[F.max(c).alias(c) for c in ["m00", *lower]]).alias("g")).scalar()
        sums = sums.withColumn("_g", row).select("*", "_g.*").drop("_g")
    for i in range(4):
        sums = sums.withColumn(f"w{i}", sum([F.col(f"l{i}{j}") * F.col(f"s{j}") for j in range(i + 1)], F.lit(0.0)))
    rss0 = F.col("yy") - F.col("w0") * F.col("w0")
    gain = F.col("w1") * F.col("w1") + F.col("w2") * F.col("w2") + F.col("w3") * F.col("w3")
    out = sums.select(
        *keys, "gene_id", "m00", (gain / 3.0).alias("_num"), (rss0 - gain).alias("_rss1")
    ).withColumn("f", ratio(F.col("_num") * (F.col("m00") - 4), F.greatest("_rss1", F.lit(0.0))))
    out = out.withColumn("p", upper_f(F.col("f"), F.lit(3.0), F.col("m00") - 4)).select(*keys, "gene_id", "f", "p")
    return bh_adjust(materialise(out), "p", by)


def select_trend_genes(trends: DataFrame, trends_by: DataFrame, by: str, top: int = 100) -> DataFrame:
    """Union of the ``top`` genes by q over all cells and within each group."""
    overall = trends.orderBy("q", F.col("f").desc(), "gene_id").limit(top).select("gene_id")
    w = Window.partitionBy(by).orderBy("q", F.col("f").desc(), "gene_id")
    local = trends_by.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).select("gene_id")
    return overall.union(local).distinct()


