"""The given tables seen as counts, cells, genes and vectors, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweave.operators import qc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy views of one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def counts(self) -> DataFrame:
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), "l_quantity")
        return lines.groupBy("cell_id", "gene_id").agg(F.sum("l_quantity").alias("n"))

    @property
    def cells(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("cell_id"),
            F.col("o_orderpriority").alias("label"),
            F.col("o_orderstatus").alias("batch"),
            F.col("o_custkey").alias("donor"),
            F.year("o_orderdate").cast("long").alias("stage"),
            F.col("o_totalprice").alias("pseudotime"),
            F.pmod(F.col("o_custkey"), F.lit(10)).cast("long").alias("lane"),
        )

    @property
    def genes(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("gene_id"),
            F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("symbol"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("family"),
            F.col("p_type").alias("pathway"),
            F.col("p_size").cast("long").alias("size"),
        )

    @property
    def expr(self) -> DataFrame:
        return qc.log_normalise(self.counts)

    @property
    def emb(self) -> DataFrame:
        return self.raw("embeddings").select(
            F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("vec")
        )

    @property
    def emb_cells(self) -> DataFrame:
        """Vector labels; the batch is an arithmetic function of the id."""
        return self.raw("embeddings").select(
            F.col("vec_id").alias("cell_id"),
            F.concat(F.lit("c"), F.col("label").cast("string")).alias("label"),
            F.concat(F.lit("b"), F.pmod(F.col("vec_id"), F.lit(3)).cast("string")).alias("batch"),
        )

    @property
    def events(self) -> DataFrame:
        return self.raw("events")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with the SQL that gives the same rows."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round before comparing; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def beta_sql(x: str, a: str, b: str) -> str:
    """The regularised incomplete beta function as DuckDB SQL, by Simpson's rule: with y = x exp(-r r / a) its integral is that of a bell.
    Beyond the middle it is taken from the other side, where the bell has no edge."""

    def side(x: str, a: str, b: str) -> str:
        r = "(k * 7e0 / 2000)"
        bell = f"2 * {r} * exp(-{r} * {r}) * pow(greatest(1 - ({x}) * exp(-{r} * {r} / ({a})), 1e-300), ({b}) - 1)"
        rule = f"list_sum(list_transform(range(0, 2001), lambda k: (CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * {bell})) * 7e0 / 6000"
        return f"exp(({a}) * ln(greatest({x}, 1e-300)) - ln({a}) - lgamma({a}) - lgamma({b}) + lgamma(({a}) + ({b}))) * {rule}"

    return f"(CASE WHEN {x} < (({a}) + 1) / (({a}) + ({b}) + 2) THEN {side(x, a, b)} ELSE 1 - {side(f'(1 - {x})', b, a)} END)"


# The same views as SQL, to be put after WITH.
COUNTS = """counts AS (SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS n
  FROM lineitem GROUP BY 1, 2)"""
CELLS = """cells AS (SELECT o_orderkey AS cell_id, o_orderpriority AS label, o_orderstatus AS batch, o_custkey AS donor,
  CAST(year(o_orderdate) AS BIGINT) AS stage, o_totalprice AS pseudotime, CAST(o_custkey % 10 AS BIGINT) AS lane FROM orders)"""
GENES = """genes AS (SELECT p_partkey AS gene_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS symbol, p_name AS name,
  p_brand AS family, p_type AS pathway, CAST(p_size AS BIGINT) AS size FROM part)"""
EXPR = COUNTS + """, totals AS (SELECT cell_id, sum(n) AS total FROM counts GROUP BY 1),
expr AS (SELECT c.cell_id, c.gene_id, c.n, ln(1 + c.n * 1e4 / t.total) AS x FROM counts c JOIN totals t USING (cell_id))"""
EMB = """emb AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS vec, 'c' || CAST(label AS VARCHAR) AS label,
  'b' || CAST(vec_id % 3 AS VARCHAR) AS batch FROM embeddings)"""
# Genes that pass the default limits of the mean-variance rule.
HVG = """moments AS (SELECT gene_id, sum(exp(x) - 1) AS s1, sum((exp(x) - 1) * (exp(x) - 1)) AS s2 FROM expr GROUP BY 1),
mv AS (SELECT gene_id, s1 / n AS m, (s2 - s1 * s1 / n) / (n - 1) AS v
  FROM moments, (SELECT count(*) AS n FROM cells)),
md AS (SELECT gene_id, ln(m + 1) AS mean, CASE WHEN v > 0 AND m > 0 THEN ln(v / m) ELSE 0 END AS dispersion FROM mv),
binned AS (SELECT md.*, CASE WHEN hi > lo THEN least(20, greatest(1, ceil((mean - lo) / ((hi - lo) / 20)))) ELSE 1 END AS bin
  FROM md, (SELECT min(mean) AS lo, max(mean) AS hi FROM md)),
zed AS (SELECT gene_id, mean, dispersion, coalesce((dispersion - avg(dispersion) OVER (PARTITION BY bin)) /
  nullif(stddev_samp(dispersion) OVER (PARTITION BY bin), 0), 0) AS z FROM binned),
hvg AS (SELECT gene_id, mean, dispersion, z, mean > 0.0125 AND mean < 3 AND z > 0.625 AS selected FROM zed)"""
