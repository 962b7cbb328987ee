"""Nearest neighbours by inner product with multi-index hashing of learned binary codes.

Rows are scaled by the largest norm and get one more coordinate that makes them unit vectors, so that the largest inner product is the
smallest angle. Rotations learned on a bounded sample (alternating between signs and the best rotation onto them) turn a
vector into WORDS words of 64 bits, and each word is indexed. Two codes within Hamming radius r agree in some word up to r / WORDS
bits, so probing every word's index up to that distance meets every code within the radius; the first word that meets it
counts. What is within the radius is ranked by the floats. The radius is the one that holds RECALL of the sample's own
neighbours; a query that finds too few in it looks at all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import saved
from .crosspolytope import matrix, usable

WORDS = 4
BITS = 64
#: Rows on which rotations and radius are fitted, at most; those with the smallest hashes of their ids.
SAMPLE = 8192
PROBED = 256
RECALL = 0.99
ROUNDS = 20
#: Leading bits of a word that name its list, rows of a list that are scanned together, and queries that probe together.
LIST_BITS = 3
ROWS = 20_000
QUERIES = 4096
SEED = 5


def unit_rows(x: np.ndarray, most: float) -> np.ndarray:
    """Rows scaled by ``most`` with the coordinate that makes each a unit vector."""
    x = x / most
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]])


def learned(x: np.ndarray) -> np.ndarray:
    """Directions of all bits: for each word an orthogonal matrix that turns the sample towards the corners of a cube."""
    rng = np.random.default_rng(SEED)
    width = x.shape[1]
    out = []
    for _ in range(WORDS):
        parts = []
        while sum(p.shape[1] for p in parts) < BITS:
            r = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for _ in range(ROUNDS):
                u, _, v = np.linalg.svd(x.T @ np.where(x @ r >= 0, 1.0, -1.0))
                r = u @ v
            parts.append(r)
        out.append(np.hstack(parts)[:, :BITS])
    return np.hstack(out)


def code_words(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """(rows, WORDS) unsigned 64-bit words."""
    return np.packbits(x @ directions >= 0, axis=1, bitorder="big").reshape(len(x), WORDS, 8).view(">u8").reshape(len(x), WORDS).astype(np.uint64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :])


def fitted(x: np.ndarray, most: float, k: int) -> tuple[np.ndarray, int]:
    """(directions, radius) from the sample."""
    unit = unit_rows(x, most)
    directions = learned(unit)
    words = code_words(unit, directions)
    probe = np.arange(min(PROBED, len(x)))
    q = x[probe] / np.linalg.norm(x[probe], axis=1, keepdims=True)
    q_words = code_words(np.hstack([q, np.zeros((len(q), 1))]), directions)
    score = x[probe] @ x.T
    score[probe, probe] = -np.inf
    nearest = np.argsort(-score, axis=1)[:, : min(k, len(x) - 1)]
    far = sum(distances(q_words[:, w], words[:, w]).astype(int) for w in range(WORDS))
    near = np.take_along_axis(far, nearest, 1)
    return directions, int(np.quantile(near, RECALL)) if near.size else WORDS * BITS


def search(index: DataFrame, queries: DataFrame, radius: int, k: int, rows: int, asked: int) -> DataFrame:
    """(query, node, score): the k best of every scanned list for each query, within the radius. index, queries: (node, vector, words)."""
    near = radius // WORDS
    lists = 1 << LIST_BITS
    head = lambda c: F.shiftrightunsigned(c, BITS - LIST_BITS).cast("int")
    spread = max(1, -(-rows // (lists * ROWS)))
    blocks = max(1, -(-asked // QUERIES))
    every = index.select("node", "vector", "words", F.posexplode("words").alias("word", "own"))
    every = every.select("node", "vector", "words", "word", head(F.col("own")).alias("list"), F.pmod(F.xxhash64("node"), F.lit(spread)).alias("slice"))
    every = every.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    probes = queries.select("node", "vector", "words", F.posexplode("words").alias("word", "own"), F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    probes = probes.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1)))).filter(F.bit_count(head(F.col("own")).bitwiseXOR(F.col("list"))) <= near)
    probes = probes.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    keys = ["word", "list", "slice", "block"]

    def scan(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            word = key[0].as_py()
            node, asker = np.asarray(left.column("node")), np.asarray(right.column("node"))
            x, q = matrix(left.column("vector")), matrix(right.column("vector"))
            codes = matrix_words(left.column("words"))
            q_codes = matrix_words(right.column("words"))
            for i in range(0, len(asker), 128):
                j = slice(i, i + 128)
                per = [distances(q_codes[j, w], codes[:, w]) for w in range(WORDS)]
                ok = (per[word] <= near) & (sum(p.astype(np.int16) for p in per) <= radius) & (asker[j, None] != node[None, :])
                for w in range(word):
                    ok &= per[w] > near
                score = np.where(ok, q[j] @ x.T, -np.inf)
                least = np.partition(score, max(0, len(node) - k), axis=1)[:, max(0, len(node) - k)] if len(node) > k else np.full(len(score), -np.inf)
                a, b = np.nonzero(ok & (score >= least[:, None] - 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))[:, None]))
                exact = (q[a + i] * x[b]).sum(1)
                order = np.lexsort((node[b], -exact, a))
                a, b, exact = a[order], b[order], exact[order]
                first = np.searchsorted(a, a)
                best = np.arange(len(a)) - first < k
                out[0].append(asker[a[best] + i]), out[1].append(node[b[best]]), out[2].append(exact[best])
        cat = lambda v, t: np.concatenate([np.zeros(0, t), *v])
        return pa.table({"query": cat(out[0], np.int64), "node": cat(out[1], np.int64), "score": cat(out[2], np.float64)})

    return probes.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(lambda key, right, left: scan(key, left, right), "query long, node long, score double")


def matrix_words(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(np.int64).view(np.uint64).reshape(len(column), WORDS)


def best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "node")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, id, score): for each row whose id is divisible by ``every``, the k rows of largest inner product that the index
    finds, its own row left out; ties go to the smaller id.

    Null or zero vectors, those with null or non-finite components, those of another length than most of the sample's first row, and
    rows with a null id take no part. Repeated ids are not told apart: the one of them that is met first stays. Other columns
    are left out; an empty table gives an empty one. The score is the inner product of the given vectors in double precision."""
    good = rows.select(F.col(id).cast("long").alias("node"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("vector")).filter(F.col("node").isNotNull())
    good = good.filter(usable("vector"))
    width = good.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    empty = rows.sparkSession.createDataFrame([], f"query_id long, rank int, {id} long, score double")
    if width is None:
        return empty
    good = good.filter(F.size("vector") == width["width"]).dropDuplicates(["node"])
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, most, asked = good.agg(F.count("*"), F.max(norm), F.sum((F.col("node") % every == 0).cast("long"))).first()
    sample = good.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toArrow()
    x = matrix(sample.column("vector"))
    directions, radius = fitted(x, most, k)
    tools = rows.sparkSession.sparkContext.broadcast((directions, most))

    def encode(batches):
        directions, most = tools.value
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                own = code_words(unit_rows(x, most), directions)
                asks = code_words(np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))]), directions)
                yield pa.record_batch([*batch.columns, pa.array(list(own.view(np.int64))), pa.array(list(asks.view(np.int64)))], names=["node", "vector", "words", "asks"])

    coded = saved(good.mapInArrow(encode, "node long, vector array<double>, words array<long>, asks array<long>"), "codes")
    index = coded.select("node", "vector", "words")
    queries = coded.filter(F.col("node") % every == 0).select("node", "vector", F.col("asks").alias("words"))
    found = saved(best(search(index, queries, radius, k, n, asked), k), "nearest")
    full = found.groupBy("query").count().filter(F.col("count") >= min(k, n - 1)).select("query")
    lacking = queries.join(full, queries["node"] == full["query"], "left_anti")
    few = lacking.count()
    if few:
        again = best(search(index, lacking, WORDS * BITS, k, n, few), k)
        found = found.join(lacking.select(F.col("node").alias("query")), "query", "left_anti").unionByName(again)
    return found.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("node").alias(id), "score")
