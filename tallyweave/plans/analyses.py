"""Whole analyses, each a composition of operators that returns named tables.

Wide intermediate results that several steps read are written once in between; everything else stays lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import doublets, graph, markers, neighbors, profile, qc, reduce, series
from ..operators.scale import materialise
from ..sources import datasets


def annotate_counts(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, mito: str = "^MT-", max_mito: float = 0.2, min_cells: int = 3,
    min_genes: int = 200, components: int = 20, probe="all",
) -> dict[str, DataFrame]:
    """Filtered, normalised and reduced data with its shared-neighbour graph, from raw counts."""
    kept = qc.filter_cells_genes(counts, min_cells, min_genes)
    share = qc.filter_threshold(qc.percent_pattern(kept, genes, mito), "pct", high=max_mito)
    cells = cells.join(share, "cell_id")
    kept = materialise(kept.join(share.select("cell_id"), "cell_id", "left_semi"))
    cells = materialise(cells.join(qc.cell_stats(kept), "cell_id"))
    expr = materialise(qc.log_normalise(kept))
    hvg = materialise(qc.variable_genes_mvp(expr, cells))
    emb, loadings = reduce.pca(qc.scale_clip(expr, cells, qc.selected_genes(hvg)), components)
    emb = materialise(emb)
    near = neighbors.knn(emb, 9, probe=probe)
    return {"counts": kept, "cells": cells, "expr": expr, "variable_genes": hvg, "pca": emb, "loadings": loadings,
            "neighbours": near, "snn": materialise(neighbors.snn(near, k=10))}


def mark_clusters(
    expr: DataFrame, cells: DataFrame, edges: DataFrame, gene_info: DataFrame, info_columns: list[str], gene_to_pop: DataFrame,
    resolution: float = 1.0, cap: int | None = None, top: int = 50, min_pct: float = 0.25, logfc: float = 0.25,
) -> dict[str, DataFrame]:
    """Communities, their markers with annotation, and an empty template for their names."""
    found = graph.louvain(edges, resolution)
    cells = materialise(cells.join(found.withColumnRenamed("node", "cell_id"), "cell_id"))
    tested = materialise(markers.markers_one_vs_rest(expr, cells, "community", min_pct, logfc, max_cells=cap))
    best = markers.also_present_in(markers.top_markers(tested, top))
    best = markers.cell_type_flag(markers.annotate_markers(best, gene_info, info_columns), gene_to_pop)
    return {"cells": cells, "markers": tested, "annotation": best, "template": profile.make_update_template(cells, "community")}


def trajectory(
    counts: DataFrame, cells: DataFrame, label: str, root: str, keep: list[str] | None = None, drop_genes: DataFrame | None = None,
    components: int = 20, k: int = 15, top: int = 100,
) -> dict[str, DataFrame]:
    """Diffusion pseudotime from a root label, trend genes and their smoothed heat map."""
    if keep is not None:
        counts, cells = datasets.subset(counts, cells, {label: keep})
    if drop_genes is not None:
        counts = qc.exclude_genes(counts, names=drop_genes)
    flat = materialise(qc.normalise_per_cell(counts))
    hvg = materialise(qc.variable_genes_dispersion(flat, cells))
    expr = materialise(qc.log1p_expr(flat))
    emb, _ = reduce.pca(qc.scale_clip(expr, cells, qc.selected_genes(hvg)), components)
    dm, values = graph.diffusion_map(neighbors.gauss_graph(neighbors.knn(materialise(emb), k)))
    dm = materialise(dm)
    cells = materialise(cells.join(graph.diffusion_pseudotime(dm, values, cells, label, root), "cell_id"))
    overall = markers.trend_genes(expr, cells, "pseudotime")
    local = markers.trend_genes(expr, cells, "pseudotime", by=label)
    chosen = materialise(markers.select_trend_genes(overall, local, label, top))
    heat = series.pseudotime_heatmap(expr, cells, chosen, "pseudotime")
    return {"cells": cells, "diffusion": dm, "eigenvalues": values, "trend_genes": chosen, "heatmap": heat}


def compare_datasets(
    query: tuple[DataFrame, DataFrame], reference: tuple[DataFrame, DataFrame], label: str, least: int = 20, cap: int | None = None,
) -> dict[str, DataFrame]:
    """Profiles of two data sets, their rank correlation with p, over the shared variable genes."""
    sides = {}
    for tag, (counts, cells) in (("Q", query), ("R", reference)):
        drawn = cells if cap is None else qc.downsample_per_label(cells, label, cap, 0)
        cells = qc.drop_small_labels(drawn, label, least)
        expr = materialise(qc.log_normalise(counts.join(cells.select("cell_id"), "cell_id", "left_semi")))
        hvg = qc.selected_genes(qc.variable_genes_mvp(expr, cells))
        sides[tag] = (profile.mean_expression(expr, cells, label), hvg)
    genes = materialise(sides["Q"][1].union(sides["R"][1]).distinct())
    profiles = {tag: materialise(p.join(genes, "gene_id", "left_semi")) for tag, (p, _) in sides.items()}
    corr = profile.correlation_pvalue(profile.profile_correlation(profiles["Q"], profiles["R"]))
    return {"query_profile": profiles["Q"], "reference_profile": profiles["R"], "correlation": corr}


def flag_doublets(counts: DataFrame, cells: DataFrame, sample: str, edges: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """Cells with doublet score, over-clustered community, cluster score, p and adjusted p."""
    scored = materialise(doublets.doublet_score(counts, cells, sample, genes=genes))
    fine = graph.overcluster(edges).withColumnRenamed("node", "cell_id").select("cell_id", "cluster")
    return doublets.doublet_cluster_test(materialise(cells.join(scored, "cell_id").join(fine, "cell_id")), sample, "cluster", "score")
