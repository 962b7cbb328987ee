"""Readers, writers, keys, merging and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyweave.operators import qc
from tallyweave.operators.scale import global_position, scratch_dir
from tallyweave.sources import datasets, files

from .base import CELLS, COUNTS, EXPR, GENES, HVG, query, rounded
from .markers import TOP, _top


def scratch(t):
    """A new folder for files derived from the tables."""
    return f"{scratch_dir(t.spark)}/files-{uuid.uuid4().hex}"


@query("read_10x", f"""WITH {COUNTS}, {CELLS}, {GENES}
SELECT 'S_' || batch || '_' || CAST(cell_id AS VARCHAR) || '-1' AS cell_id, symbol AS gene_id, n
FROM counts JOIN cells USING (cell_id) JOIN genes USING (gene_id)""")
def _(t):
    # one sample folder per batch, written from the tables, then all folders read in one plan
    root, samples = scratch(t), []
    genes = t.genes.withColumn("i", F.col("gene_id") + 1)
    listed = genes.orderBy("i").select(F.concat_ws("\t", F.col("gene_id").cast("string"), "symbol").alias("value"))
    counts = t.counts.join(t.cells.select("cell_id", "batch"), "cell_id")
    for batch in ("F", "O", "P"):
        mine = counts.where(F.col("batch") == batch)
        placed = global_position(mine.select("cell_id").distinct(), ["cell_id"], "j")
        folder = f"{root}/{batch}"
        entries = mine.join(placed, "cell_id").select((F.col("gene_id") + 1).alias("i"), "j", F.col("n").alias("v"))
        files.write_mtx(entries, f"{folder}/matrix.mtx")
        placed.orderBy("j").select(F.concat(F.col("cell_id").cast("string"), F.lit("-1")).alias("value")).write.text(f"{folder}/barcodes.tsv")
        listed.write.text(f"{folder}/genes.tsv")
        samples.append((folder, f"S__{batch}"))
    return files.read_10x(t.spark, samples)[0]


@query("read_write_mtx", f"WITH {COUNTS} SELECT gene_id + 1 AS i, cell_id + 1 AS j, n AS v FROM counts")
def _(t):
    path = scratch(t)
    files.write_mtx(t.counts.select((F.col("gene_id") + 1).alias("i"), (F.col("cell_id") + 1).alias("j"), F.col("n").alias("v")), path)
    return files.read_mtx(t.spark, path)


@query("read_write_mtx_symmetric", """WITH e AS (SELECT DISTINCT c_nationkey + 1 AS a, CAST(c_custkey % 25 AS INTEGER) + 1 AS b FROM customer),
low AS (SELECT DISTINCT greatest(a, b) AS i, least(a, b) AS j FROM e)
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, i + j / 100.0e0 AS v FROM low UNION ALL
SELECT CAST(j AS BIGINT), CAST(i AS BIGINT), i + j / 100.0e0 FROM low WHERE i <> j""")
def _(t):
    a, b = F.col("c_nationkey") + 1, F.pmod(F.col("c_custkey"), F.lit(25)) + 1
    low = t.raw("customer").select(F.greatest(a, b).alias("i"), F.least(a, b).alias("j")).distinct()
    path = scratch(t)
    files.write_mtx(low.withColumn("v", F.col("i") + F.col("j") / 100.0), path, symmetric=True)
    return files.read_mtx(t.spark, path)


KEY = """key AS (SELECT 'SUP' || CAST(s_suppkey AS VARCHAR) || '_F' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '_' ||
  CASE s_suppkey % 4 WHEN 0 THEN 'CD45P' WHEN 1 THEN 'CD45N' WHEN 2 THEN 'TOT' ELSE 'Other' END AS SUPPLIER_SAMPLE_NAME,
  'L' || CAST(s_suppkey AS VARCHAR) AS SANGER_SAMPLE_ID, CASE s_nationkey % 3 WHEN 0 THEN 'liver' WHEN 1 THEN 'skin' ELSE 'other' END AS Organ,
  CASE s_suppkey % 2 WHEN 0 THEN 'normal' ELSE '5GEX' END AS Sequencing, s_acctbal > 0 AS Passed, 'part' || CAST(s_suppkey % 5 AS VARCHAR) AS AnnatomicalPart FROM supplier),
sample_key AS (SELECT 'F' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS Sample, 'stage' || CAST(n_regionkey AS VARCHAR) AS Stage,
  'type' || CAST(n_regionkey % 2 AS VARCHAR) AS Type, n_name[8:] || 'x_' || CASE n_nationkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS Name
  FROM nation WHERE n_nationkey <> 9)"""


def _key(t):
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    gate = F.element_at(F.array(*[F.lit(v) for v in ("CD45P", "CD45N", "TOT", "Other")]), (s % 4 + 1).cast("int"))
    organ = F.element_at(F.array(*[F.lit(v) for v in ("liver", "skin", "other")]), (n % 3 + 1).cast("int"))
    return t.raw("supplier").select(
        F.concat(F.lit("SUP"), s.cast("string"), F.lit("_F"), F.lpad(n.cast("string"), 2, "0"), F.lit("_"), gate).alias("SUPPLIER_SAMPLE_NAME"),
        F.concat(F.lit("L"), s.cast("string")).alias("SANGER_SAMPLE_ID"),
        organ.alias("Organ"),
        F.when(s % 2 == 0, "normal").otherwise("5GEX").alias("Sequencing"),
        (F.col("s_acctbal") > 0).alias("Passed"),
        F.concat(F.lit("part"), (s % 5).cast("string")).alias("AnnatomicalPart"),
    )


def _sample_key(t):
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    return t.raw("nation").where("n_nationkey <> 9").select(
        F.concat(F.lit("F"), F.lpad(n.cast("string"), 2, "0")).alias("Sample"),
        F.concat(F.lit("stage"), r.cast("string")).alias("Stage"),
        F.concat(F.lit("type"), (r % 2).cast("string")).alias("Type"),
        F.concat(F.substring("n_name", 8, 100), F.lit("x_"), F.when(n % 2 == 0, "male").otherwise("female")).alias("Name"),
    )


@query("select_samples", f"""WITH {KEY}, sel AS (SELECT *, SUPPLIER_SAMPLE_NAME[position('_' IN SUPPLIER_SAMPLE_NAME) + 1:][1:3] AS Fetus,
  CASE split_part(SUPPLIER_SAMPLE_NAME, '_', 3) WHEN 'CD45P' THEN 'CD45+' WHEN 'CD45N' THEN 'CD45-' WHEN 'TOT' THEN 'Total' ELSE split_part(SUPPLIER_SAMPLE_NAME, '_', 3) END AS gate
  FROM key WHERE Organ = 'liver' AND Sequencing IN ('normal', '5GEX') AND Passed)
SELECT *, Fetus || '_' || Organ || '_' || gate || '_' || SANGER_SAMPLE_ID AS Prelabel, Fetus IN (SELECT Sample FROM sample_key) AS in_sample_key FROM sel""")
def _(t):
    return datasets.select_samples(_key(t), _sample_key(t), "liver", ["normal", "5GEX"])


NAMED = """named AS (SELECT 'F' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '_' || lower(c_mktsegment) || '_gate' || CAST(o_orderkey % 3 AS VARCHAR) || '_L' ||
  CAST(o_custkey % 130 AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) AS cell_id FROM orders JOIN customer ON c_custkey = o_custkey)"""


def _named(t):
    o = t.raw("orders").join(t.raw("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return o.select(F.concat(
        F.lit("F"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("_"), F.lower("c_mktsegment"), F.lit("_gate"), (F.col("o_orderkey") % 3).cast("string"),
        F.lit("_L"), (F.col("o_custkey") % 130).cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"),
    ).alias("cell_id"))


@query("metadata_from_cell_name", f"""WITH {KEY}, {NAMED}, p AS (SELECT cell_id, split_part(cell_id, '_', 1) AS d, split_part(cell_id, '_', 2) AS tissue,
  split_part(cell_id, '_', 3) AS gate, split_part(cell_id, '_', 4) AS lane FROM named),
m AS (SELECT p.*, coalesce(Stage, d) AS stage, coalesce(Type, d) AS type, coalesce(Name, d) AS donor, coalesce(k.AnnatomicalPart, lane) AS part
  FROM p LEFT JOIN sample_key ON Sample = d LEFT JOIN key k ON SANGER_SAMPLE_ID = lane)
SELECT cell_id, tissue, gate, lane, stage, type, donor, part, nullif(split_part(donor, '_', 2), '') AS gender FROM m""")
def _(t):
    return datasets.metadata_from_cell_name(_named(t), _key(t), _sample_key(t))


@query("merge_datasets", f"""WITH {COUNTS}, {CELLS} SELECT CASE WHEN batch = 'F' THEN 'Q_' ELSE 'R_' END || CAST(cell_id AS VARCHAR) AS cell_id, gene_id, n,
label || CASE WHEN batch = 'F' THEN '_a' ELSE '_b' END AS label FROM counts JOIN cells USING (cell_id)""")
def _(t):
    one = lambda cells: (t.counts.join(cells.select("cell_id"), "cell_id", "left_semi"), cells)
    q, r = t.cells.where("batch = 'F'"), t.cells.where("batch <> 'F'").drop("lane")
    counts, cells = datasets.merge_datasets([one(q), one(r)], ["a", "b"], ["label"], ["Q", "R"])
    return counts.join(cells.select("cell_id", "label"), "cell_id")


@query("subset", f"""WITH {COUNTS}, {CELLS} SELECT cell_id, gene_id, n FROM counts WHERE cell_id IN
(SELECT cell_id FROM cells WHERE label IN ('1-URGENT', '2-HIGH') AND batch IN ('F', 'O'))""")
def _(t):
    return datasets.subset(t.counts, t.cells, {"label": ["1-URGENT", "2-HIGH"], "batch": ["F", "O"]})[0]


@query("split_by", f"WITH {CELLS} SELECT regexp_replace(label, '[ /]', '_', 'g') AS label_level, count(*) AS n FROM cells GROUP BY 1")
def _(t):
    path = scratch(t)
    files.split_by(t.cells, "label", path)
    return t.spark.read.parquet(path).groupBy("label_level").agg(F.count(F.lit(1)).alias("n"))


@query("export_dr_and_metadata", """SELECT vec_id AS cell_id, 'c' || CAST(label AS VARCHAR) AS label, 'b' || CAST(vec_id % 3 AS VARCHAR) AS batch,
round(CAST(embedding[1] AS DOUBLE), 9) AS umap1, round(CAST(embedding[2] AS DOUBLE), 9) AS umap2, round(CAST(embedding[1] AS DOUBLE), 9) AS pc1,
round(CAST(embedding[2] AS DOUBLE), 9) AS pc2, round(CAST(embedding[3] AS DOUBLE), 9) AS pc3 FROM embeddings""")
def _(t):
    wide = datasets.export_dr_and_metadata(t.emb_cells, {"umap": (t.emb, 2), "pc": (t.emb, 3)})
    return rounded(wide, 9, "umap1", "umap2", "pc1", "pc2", "pc3")


@query("export_gene_bundles", f"""WITH {EXPR}, {CELLS}, {HVG}, b AS (SELECT gene_id, CAST(floor((row_number() OVER (ORDER BY gene_id) - 1) / 50) AS INTEGER) AS bundle FROM hvg WHERE selected)
SELECT bundle, cell_id, gene_id, round(x, 6) AS x, label FROM expr JOIN b USING (gene_id) JOIN cells USING (cell_id)""")
def _(t):
    path = scratch(t)
    genes = qc.selected_genes(qc.variable_genes_mvp(t.expr, t.cells))
    files.export_gene_bundles(t.expr, t.cells.select("cell_id", "label"), genes, 50, path)
    kinds = "cell_id long, gene_id long, x double, label string, bundle int"
    return rounded(t.spark.read.schema(kinds).parquet(path), 6, "x")


@query("gene_family_table", f"""WITH {TOP}, {GENES}, f AS (SELECT cluster AS family, gene FROM top UNION ALL SELECT 'ALL', gene_id FROM genes)
SELECT family, string_agg(CAST(gene AS VARCHAR), ',' ORDER BY gene) AS members FROM (SELECT DISTINCT * FROM f) GROUP BY 1""")
def _(t):
    table = datasets.gene_family_table(_top(t).select("cluster", "gene"), t.genes)
    return table.select("family", F.array_join(F.transform("members", lambda g: g.cast("string")), ",").alias("members"))


@query("read_list", """WITH m AS (SELECT unnest(string_split(p_name, ' ')) AS name FROM part), c AS (SELECT name, count(*) AS n FROM m GROUP BY 1)
SELECT name, n FROM c""")
def _(t):
    # names written with all three line ends and a second separator, then read back
    path = scratch(t)
    mixed = t.raw("part").select(F.concat(F.regexp_replace("p_name", " ", ", "), F.element_at(F.array(F.lit("\r"), F.lit("\r\n"), F.lit("")), (F.col("p_partkey") % 3 + 1).cast("int"))).alias("value"))
    mixed.write.text(path)
    return files.read_list(t.spark, path, ", ").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("check_members", """WITH l AS (SELECT p_brand AS name FROM part UNION ALL SELECT n_name FROM nation), k AS (SELECT DISTINCT p_brand AS name FROM part WHERE p_size > 49)
SELECT name, CASE WHEN name NOT IN (SELECT name FROM k) THEN 'missing' WHEN count(*) > 1 THEN 'duplicate' ELSE 'present' END AS status FROM l GROUP BY 1""")
def _(t):
    names = t.raw("part").select(F.col("p_brand").alias("name")).unionByName(t.raw("nation").select(F.col("n_name").alias("name")))
    return files.check_members(names, t.raw("part").where("p_size > 49").select(F.col("p_brand").alias("name")))


@query("category_index", f"WITH {CELLS} SELECT label, cell_id, row_number() OVER (ORDER BY cell_id) AS pos FROM cells")
def _(t):
    return datasets.category_positions(t.cells, "label")


@query("export_pseudotime_table", f"""WITH {EXPR}, w AS (SELECT cell_id, sum(x) FILTER (gene_id = 1) AS g1, sum(x) FILTER (gene_id = 2) AS g2, sum(x) FILTER (gene_id = 3) AS g3 FROM expr GROUP BY 1)
SELECT vec_id AS cell_id, 'c' || CAST(label AS VARCHAR) AS label, o_totalprice AS pseudotime, round(CAST(embedding[1] AS DOUBLE), 9) AS DM1, round(CAST(embedding[2] AS DOUBLE), 9) AS DM2,
round(CAST(embedding[3] AS DOUBLE), 9) AS DM3, round(coalesce(g1, 0), 6) AS gene_1, round(coalesce(g2, 0), 6) AS gene_2, round(coalesce(g3, 0), 6) AS gene_3
FROM embeddings JOIN orders ON o_orderkey = vec_id LEFT JOIN w ON cell_id = vec_id""")
def _(t):
    cells = t.emb_cells.join(t.cells.select("cell_id", "pseudotime"), "cell_id")
    out = datasets.export_pseudotime_table(t.expr, cells, t.emb, [1, 2, 3], "label", "pseudotime")
    return rounded(rounded(out, 6, "gene_1", "gene_2", "gene_3"), 9, "DM1", "DM2", "DM3")


@query("attach_cell_results", f"""WITH {NAMED}, r AS (SELECT 'L' || CAST(o_custkey % 130 AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) AS cell_key, o_totalprice AS score FROM orders WHERE o_orderstatus <> 'P')
SELECT cell_id, cell_key, score FROM (SELECT cell_id, split_part(cell_id, '_', 4) || '_' || split_part(cell_id, '_', 5) AS cell_key FROM named) LEFT JOIN r USING (cell_key)""")
def _(t):
    results = t.raw("orders").where("o_orderstatus <> 'P'").select(
        F.concat(F.lit("L"), (F.col("o_custkey") % 130).cast("string"), F.lit("_"), F.col("o_orderkey").cast("string")).alias("cell_key"),
        F.col("o_totalprice").alias("score"),
    )
    return datasets.attach_cell_results(_named(t), results)


@query("save_gene_order", f"WITH {COUNTS} SELECT DISTINCT CAST(gene_id AS VARCHAR) AS gene_id FROM counts")
def _(t):
    path = scratch(t)
    order = global_position(qc.gene_stats(t.counts), [F.col("n_cells").desc(), "gene_id"], "position")
    files.save_gene_order(order, path)
    return files.read_list(t.spark, path).withColumnRenamed("name", "gene_id")
