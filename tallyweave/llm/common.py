"""Shared folder for intermediate tables, Arrow text blocks, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Words are separated by these ASCII characters alone.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that one vectorised step works on; a longer document is a step of its own.
BLOCK_BYTES = 1 << 20
BATCH_ROWS = 1000
#: What operators keep in a worker from task to task. Workers go on from one operator to the next, and so would this.
CACHES: list[dict] = []


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share. Set here only where the session names none, which a local master allows."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Rows that go to Python together: texts are long, so fewer than Spark's own default, unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: the lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` wrote and nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._llm_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and the n + 1 offsets into them; null counts as empty."""
    column = pc.fill_null(column, "")
    if pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or offsets[-1] == offsets[0] or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES, cache: dict | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows whose texts hold about ``limit`` bytes; yields (rows, bytes, offsets). Of the worker's
    caches only ``cache`` is kept; the others are those of operators that are over, and are emptied."""
    for held in CACHES:
        if held is not cache:
            held.clear()
    for batch in batches:
        raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first), raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an undirected edge table; the component is its smallest node.

    Every node takes the smallest label around it, then labels are followed to their ends, until nothing changes. Each
    round is a join and an aggregate over the edges, written to the shared folder; the driver sees one count a round.
    """
    both = saved(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = saved(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("x"), F.min("y")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "component"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        step = saved(labels.join(near, "node").select("node", F.least("component", "near").alias("component"), (F.col("near") < F.col("component")).alias("moved")), "labels")
        moved = step.filter("moved").limit(1).count()
        forget(labels)
        labels = step.select("node", "component")
        labels._llm_path = step._llm_path
        if not moved:
            forget(both)
            return labels
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        step = saved(labels.join(up, "component").select("node", F.least("component", "above").alias("component")), "labels")
        forget(labels)
        labels = step
