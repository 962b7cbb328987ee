"""Sample keys, metadata from cell names, merging, subsetting and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.profile import map_values
from ..operators.scale import lookup_join, require

# Gate names as written in sample names, and as shown.
GATES = {"CD45P": "CD45+", "CD45N": "CD45-", "TOT": "Total"}


def field(text: Column, at: int) -> Column:
    """Field ``at`` (from 1) of an underscore-separated name; null when there are fewer."""
    return F.try_element_at(F.split(text, "_"), F.lit(at))


def select_samples(key: DataFrame, sample_key: DataFrame, organ: str, sequencing: list[str]) -> DataFrame:
    """Passed samples of an organ and sequencing types, with Fetus, gate, Prelabel and whether the fetus is known."""
    require(key, "SUPPLIER_SAMPLE_NAME", "SANGER_SAMPLE_ID", "Organ", "Sequencing", "Passed")
    require(sample_key, "Sample")
    rows = key.where((F.col("Organ") != "other") & (F.col("Organ") == organ) & F.col("Sequencing").isin(sequencing) & F.col("Passed"))
    raw = field(F.col("SUPPLIER_SAMPLE_NAME"), 3)
    names = F.create_map(*[F.lit(v) for pair in GATES.items() for v in pair])
    rows = rows.withColumns({
        "Fetus": F.regexp_extract("SUPPLIER_SAMPLE_NAME", "F[0-9]{2}", 0),
        "gate": F.coalesce(names[raw], raw),
    })
    rows = rows.withColumn("Prelabel", F.concat_ws("_", "Fetus", "Organ", "gate", "SANGER_SAMPLE_ID"))
    known = sample_key.select(F.col("Sample").alias("Fetus")).distinct().withColumn("in_sample_key", F.lit(True))
    return lookup_join(rows, known, ["Fetus"], "left").fillna(False, ["in_sample_key"])


def metadata_from_cell_name(cells: DataFrame, key: DataFrame, sample_key: DataFrame) -> DataFrame:
    """Parse ``donor_tissue_gate_lane_barcode`` cell ids; donors and lanes are mapped through the keys.

    Unmapped values stay as they are; gender is the second field of the mapped donor name.
    """
    require(sample_key, "Sample", "Stage", "Type", "Name")
    require(key, "SANGER_SAMPLE_ID", "AnnatomicalPart")
    name = F.col("cell_id")
    rows = cells.withColumns({"_donor": field(name, 1), "tissue": field(name, 2), "gate": field(name, 3), "lane": field(name, 4)})
    for source, out in (("Stage", "stage"), ("Type", "type"), ("Name", "donor")):
        rows = map_values(rows, "_donor", sample_key.select(F.col("Sample").alias("from"), F.col(source).alias("to")), out)
    parts = key.select(F.col("SANGER_SAMPLE_ID").alias("from"), F.col("AnnatomicalPart").alias("to"))
    rows = map_values(rows, "lane", parts, "part")
    return rows.withColumn("gender", field(F.col("donor"), 2)).drop("_donor")


def merge_datasets(
    datasets: list[tuple[DataFrame, DataFrame]], tags: list[str], tag_cols: list[str], prefixes: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Union of (counts, cells) pairs: ``_tag`` added to chosen columns, ids optionally prefixed, genes united."""
    if len(tags) != len(datasets) or (prefixes is not None and len(prefixes) != len(datasets)):
        raise ValueError("one tag and one prefix per dataset")
    counts, cells = None, None
    for i, (n, c) in enumerate(datasets):
        require(c, "cell_id", *tag_cols)
        c = c.withColumns({col: F.concat_ws("_", F.col(col), F.lit(tags[i])) for col in tag_cols})
        if prefixes is not None:
            named = F.concat(F.lit(prefixes[i] + "_"), F.col("cell_id").cast("string"))
            n, c = n.withColumn("cell_id", named), c.withColumn("cell_id", named)
        counts = n if counts is None else counts.unionByName(n)
        cells = c if cells is None else cells.unionByName(c, allowMissingColumns=True)
    return counts, cells


def subset(counts: DataFrame, cells: DataFrame, keep: dict[str, list]) -> tuple[DataFrame, DataFrame]:
    """Cells whose value is listed in every named column, and their counts."""
    require(cells, "cell_id", *keep)
    for col, values in keep.items():
        cells = cells.where(F.col(col).isin(values))
    return counts.join(cells.select("cell_id"), "cell_id", "left_semi"), cells


def export_dr_and_metadata(cells: DataFrame, reductions: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """One wide row per cell: ``reductions`` maps a name to (embedding, width); coordinates become name1, name2, …"""
    wide = cells
    for name, (emb, width) in reductions.items():
        at = emb.select("cell_id", *[F.col("vec")[i].alias(f"{name}{i + 1}") for i in range(width)])
        wide = wide.join(at, "cell_id", "left")
    return wide


def gene_family_table(markers: DataFrame, genes: DataFrame) -> DataFrame:
    """(family, members): sorted distinct genes of every cluster, and ``ALL`` genes of the gene table."""
    per = markers.groupBy(F.col("cluster").alias("family")).agg(F.array_sort(F.collect_set("gene")).alias("members"))
    every = genes.select(F.col("gene_id").alias("gene")).agg(F.array_sort(F.collect_set("gene")).alias("members"))
    return per.unionByName(every.select(F.lit("ALL").alias("family"), "members"))


def category_positions(cells: DataFrame, label: str) -> DataFrame:
    """(label, cell_id, pos): 1-based position of each cell in id order, long form."""
    from ..operators.scale import global_position

    return global_position(cells.select(F.col(label).alias("label"), "cell_id"), ["cell_id"], "pos")


def export_pseudotime_table(expr: DataFrame, cells: DataFrame, emb: DataFrame, genes: list, label: str, pseudotime: str) -> DataFrame:
    """DM1..3, label, pseudotime and one column per listed gene, in pseudotime order; absent values are zero."""
    stored = expr.where(F.col("gene_id").isin(genes)).groupBy("cell_id").pivot("gene_id", genes).agg(F.sum("x"))
    stored = stored.select("cell_id", *[F.col(f"`{g}`").alias(f"gene_{g}") for g in genes])
    at = emb.select("cell_id", *[F.col("vec")[i].alias(f"DM{i + 1}") for i in range(3)])
    wide = cells.select("cell_id", F.col(label).alias("label"), F.col(pseudotime).alias("pseudotime")).join(at, "cell_id")
    wide = wide.join(stored, "cell_id", "left").fillna(0.0, [f"gene_{g}" for g in genes])
    return wide.orderBy("pseudotime", "cell_id")


def attach_cell_results(cells: DataFrame, results: DataFrame, parts: tuple[int, ...] = (4, 5), key: str = "cell_key") -> DataFrame:
    """Left join of per-cell results on chosen fields of the cell name (``lane_barcode`` by default)."""
    short = F.concat_ws("_", *[field(F.col("cell_id"), p) for p in parts])
    return cells.withColumn(key, short).join(results, key, "left")
