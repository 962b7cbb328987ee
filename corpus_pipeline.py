"""A training corpus from the documents table: good texts, one of each group of near copies, without secrets, mixed by source, packed.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and gives the next one's docs. All but the last
return the columns of documents. Stages take any rows: null and empty texts, null and repeated ids, further columns (which they
drop) and empty tables have the results that the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweave.llm import jaccard, mixing, packing, quality, secret_scan
from tallyweave.llm.common import saved
from tallyweave.llm.queries import table, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of good quality."""
    scored = quality.quality_scores(docs, table(spark, sf_dir, "labels"), keep=COLUMNS[1:])
    return scored.filter("predicted = 1").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return jaccard.near_duplicates(docs, keep=COLUMNS[1:]).filter("stays").select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars counts the new text."""
    rows = secret_scan.scan(docs, keep=COLUMNS[1:])
    some = F.size("found") > 0
    text = F.when(some, secret_scan.redacted(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    out = rows.withColumns({"n_chars": F.when(some, F.length(text).cast("long")).otherwise(F.col("n_chars").cast("long")), "text": text})
    return out.select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole number: not at all, once or twice. Equal rows are taken
    equally often, by the mean of what the mix takes of them."""
    keyed = docs.select(*COLUMNS).withColumn("print", F.xxhash64("text"))
    taken = mixing.mixed(keyed, keep=("print",)).groupBy("source", "doc_id", "print").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    times = taken.filter("size > 0").select("source", "doc_id", "print", F.round(F.col("taken") / F.col("size")).cast("int").alias("times")).filter("times > 0")
    same = [keyed[c].eqNullSafe(times[c]) for c in ("source", "doc_id", "print")]
    rows = keyed.join(times, same[0] & same[1] & same[2]).select(*[keyed[c] for c in COLUMNS], "times")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", without_secrets),
    ("mixing sources", mixed_sources),
    ("packing", packed_windows),
]

#: A classifier and a Markov model decide: tested against brute force and held-out labels instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
