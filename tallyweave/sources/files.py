"""Matrix, key and list files."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.scale import global_position, require

BANNER = "%%MatrixMarket"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, file, start, id): text lines with their file, split offset and order inside the split."""
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )


def _matrix_lines(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, i, j, v) of every entry and (file, symmetric) of every headed file; comments and the size line are dropped.

    The size line is the first plain line after a banner, so it is looked for in the first split of a file only.
    """
    lines = _lines(spark, paths).where(F.trim("value") != "")
    comment = F.col("value").startswith("%")
    banner = F.col("value").startswith(BANNER)
    whole = Window.partitionBy("file")  # the first split of one file
    plain = F.sum(F.when(comment, 0).otherwise(1)).over(whole.orderBy("id"))
    head = lines.where("start = 0").withColumns({
        "_headed": F.max(banner).over(whole),
        "_symmetric": F.max(banner & F.lower("value").contains("symmetric")).over(whole),
        "_plain": plain,
    })
    kinds = head.where("_headed").select("file", F.col("_symmetric").alias("symmetric")).distinct()
    entries = head.where(~comment & (~F.col("_headed") | (F.col("_plain") > 1))).select("file", "value")
    entries = entries.unionByName(lines.where((F.col("start") > 0) & ~comment).select("file", "value"))
    parts = F.split(F.trim("value"), r"\s+")
    rows = entries.select("file", parts[0].cast("long").alias("i"), parts[1].cast("long").alias("j"), F.coalesce(F.try_element_at(parts, F.lit(3)).cast("double"), F.lit(1.0)).alias("v"))
    return rows, kinds


def read_mtx(spark: SparkSession, path: str, mirror: bool = True) -> DataFrame:
    """(i, j, v) of a MatrixMarket coordinate file or of a folder written by :func:`write_mtx`.

    Indices start at 1.  A symmetric file stores one triangle; ``mirror`` adds the other.
    """
    rows, kinds = _matrix_lines(spark, [path] if not _is_folder(spark, path) else [f"{path}/header", f"{path}/entries"])
    rows = rows.select("i", "j", "v")
    if not mirror:
        return rows
    symmetric = kinds.agg(F.coalesce(F.max("symmetric"), F.lit(False)).alias("s")).scalar()
    here = F.struct("i", "j", "v")
    flipped = F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "v")
    both = F.when(F.col("_s") & (F.col("i") != F.col("j")), F.array(here, flipped)).otherwise(F.array(here))
    return rows.withColumn("_s", symmetric).select(F.inline(both))


def _is_folder(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(f"{path}/header").limit(0).collect()
        return True
    except AnalysisException:
        return False


def write_mtx(df: DataFrame, path: str, shape: tuple[int, int] | None = None, symmetric: bool = False) -> None:
    """Write (i, j, v) as ``path/header`` and ``path/entries``, which joined in that order are one MatrixMarket file."""
    require(df, "i", "j", "v")
    if symmetric:
        df = df.where("i >= j")
    rows, columns, n = df.agg(F.max("i"), F.max("j"), F.count(F.lit(1))).first()
    rows, columns = shape or (rows or 0, columns or 0)
    kind = "symmetric" if symmetric else "general"
    spark = df.sparkSession
    head = spark.createDataFrame([(f"{BANNER} matrix coordinate real {kind}\n{rows} {columns} {n}",)], "value string")
    head.coalesce(1).write.text(f"{path}/header")
    whole = F.col("v") == F.floor("v")
    value = F.when(whole, F.col("v").cast("long").cast("string")).otherwise(F.col("v").cast("double").cast("string"))
    df.select(F.concat_ws(" ", F.col("i").cast("string"), F.col("j").cast("string"), value).alias("value")).write.text(f"{path}/entries")


def _folder_of(file: Column) -> Column:
    """The sample folder of one of its files; a listed file may itself be a folder of parts."""
    top = F.regexp_extract(file, r"^(.*?)/(?:matrix\.mtx|barcodes\.tsv|genes\.tsv)(?:/.*)?$", 1)
    return _plain(top)


def _plain(uri: Column) -> Column:
    """A file's URI without escapes, and with one slash after the scheme."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(uri, r"\+", "%2B")), ":/+", ":/")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as the file system names it: absolute, with scheme and host, escaped like the URIs of files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()


def _numbered(spark: SparkSession, paths: list[str], column: int) -> DataFrame:
    """(folder, at, name): a field of every line with its line number in the sample's file.

    Lines are numbered inside each file split, and the splits' line counts carry the offsets.
    """
    field = F.split("value", "\t")
    name = F.coalesce(F.try_element_at(field, F.lit(column + 1)), field[0])
    lines = _lines(spark, paths).withColumn("folder", _folder_of(F.col("file")))
    inside = F.row_number().over(Window.partitionBy("folder", "file", "start").orderBy("id"))
    before = Window.partitionBy("folder").orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("folder", "file", "start").agg(F.count(F.lit(1)).alias("_n"))  # one row per split
    offsets = sizes.select("folder", "file", "start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = lines.withColumn("_in", inside).join(offsets, ["folder", "file", "start"])
    return numbered.select("folder", (F.col("_before") + F.col("_in")).alias("at"), name.alias("name"))


def read_10x(spark: SparkSession, samples: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(counts, genes) from many sample folders in one plan.

    Each folder holds matrix.mtx, barcodes.tsv and genes.tsv.  A folder that cannot be read is tried at its first
    two path components.  Cell ids are ``prefix_barcode`` with runs of ``_`` collapsed; nothing is filtered.
    """
    found = []
    for path, prefix in samples:
        short = "/".join(path.split("/")[:2])
        for option in (path, short):
            try:
                spark.read.text(f"{option}/matrix.mtx")
                found.append((option.rstrip("/"), prefix))
                break
            except AnalysisException:
                continue
        else:
            raise FileNotFoundError(path)
    files = lambda name: [f"{p}/{name}" for p, _ in found]
    matrices = [part for m in files("matrix.mtx") for part in ([f"{m}/header", f"{m}/entries"] if _is_folder(spark, m) else [m])]
    entries, _ = _matrix_lines(spark, matrices)
    entries = entries.withColumn("folder", _folder_of(F.col("file")))
    table = spark.createDataFrame([(_qualified(spark, p), x) for p, x in found], "path string, prefix string")
    table = F.broadcast(table.select(_plain(F.col("path")).alias("folder"), "prefix"))  # one row per sample
    barcodes = _numbered(spark, files("barcodes.tsv"), 0)
    silent = [r["folder"] for r in table.join(barcodes.select("folder").distinct(), "folder", "left_anti").collect()]
    if silent:  # at most one row per sample
        raise ValueError(f"samples without barcodes: {silent}")
    genes = _numbered(spark, files("genes.tsv"), 1)
    named = (
        entries.join(barcodes.select("folder", F.col("at").alias("j"), F.col("name").alias("barcode")), ["folder", "j"])
        .join(genes.select("folder", F.col("at").alias("i"), F.col("name").alias("gene_id")), ["folder", "i"])
        .join(table, "folder")
    )
    cell = F.regexp_replace(F.concat_ws("_", "prefix", "barcode"), "_+", "_")
    counts = named.select(cell.alias("cell_id"), "gene_id", F.col("v").alias("n"))
    return counts, genes.select(F.col("name").alias("gene_id")).distinct()


def read_key(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated key file; dots in column names become underscores."""
    df = spark.read.csv(path, sep="\t", header=True)
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """An update template: tab separated, or comma separated when tabs give a single column."""
    df = spark.read.csv(path, sep="\t", header=True)
    return df if len(df.columns) > 1 else spark.read.csv(path, sep=",", header=True)


def read_list(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """(name): entries of a list file with any line ends, split again on ``sep`` when given."""
    text = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\r\n?|\n")).alias("name"))
    if sep is not None:
        text = text.select(F.explode(F.split("name", re.escape(sep))).alias("name"))
    return text.select(F.trim("name").alias("name")).where("name <> ''")


def check_members(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, status): ``present``, ``missing`` from ``known(name)``, or ``duplicate`` when listed twice and present."""
    tally = names.groupBy("name").agg(F.count(F.lit(1)).alias("k"))
    seen = known.select("name").distinct().withColumn("_seen", F.lit(True))
    status = F.when(F.col("_seen").isNull(), "missing").when(F.col("k") > 1, "duplicate").otherwise("present")
    return tally.join(seen, "name", "left").select("name", status.alias("status"))


def save_gene_order(order: DataFrame, path: str) -> None:
    """Write the gene ids in ``position`` order as text."""
    require(order, "gene_id", "position")
    order.orderBy("position").select(F.col("gene_id").cast("string").alias("value")).write.text(path)


def split_by(df: DataFrame, col: str, path: str) -> None:
    """Write one partition per level of ``col`` in one pass; spaces and slashes of the level become ``_``."""
    safe = F.regexp_replace(F.col(col).cast("string"), "[ /]", "_")
    df.withColumn(f"{col}_level", safe).write.partitionBy(f"{col}_level").parquet(path)


def export_gene_bundles(expr: DataFrame, cells: DataFrame, genes: DataFrame, size: int, path: str) -> None:
    """Write expression with the cells' columns, partitioned by ``bundle`` of ``size`` genes in id order."""
    gene_bundles(expr, cells, genes, size).write.partitionBy("bundle").parquet(path)


def gene_bundles(expr: DataFrame, cells: DataFrame, genes: DataFrame, size: int) -> DataFrame:
    placed = global_position(genes.select("gene_id").distinct(), ["gene_id"], "_at")
    bundles = placed.select("gene_id", F.floor((F.col("_at") - 1) / size).alias("bundle"))
    return expr.select("cell_id", "gene_id", "x").join(bundles, "gene_id").join(cells, "cell_id")
