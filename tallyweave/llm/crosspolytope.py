"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; the nearest corner of the cross-polytope, that is
its largest coordinate and the sign of it, is one hash. FUNCTIONS of them make the bucket of a table. A vector is indexed in
one bucket of each of TABLES tables and also looks into the buckets that its second largest coordinates name. Pairs that meet are
compared in double precision; a pair that meets several times counts at its first meeting only, which both vectors' codes
tell. Equal vectors are one class with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, saved

TABLES = 12
FUNCTIONS = 2
THRESHOLD = 0.9
#: Entries of a bucket that are compared as one block; a larger bucket is dealt into blocks, and pairs of blocks are compared apart.
BLOCK = 2048
#: Entries that one group holds.
GROUP = 40_000
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    width, h = x.shape[1], 1
    while h < width:
        y = x.reshape(len(x), width // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), width)
        h *= 2
    return x


def corner_codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket per table, buckets to look into per table) of unit vectors."""
    width = max(2, 1 << (x.shape[1] - 1).bit_length())
    wide = np.zeros((len(x), width))
    wide[:, : x.shape[1]] = x
    signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (TABLES, FUNCTIONS, 3, width))
    codes = np.zeros((len(x), TABLES), np.int64)
    looks = np.zeros((len(x), TABLES, FUNCTIONS), np.int64)
    row = np.arange(len(x))
    for t in range(TABLES):
        best, other = [], []
        for f in range(FUNCTIONS):
            y = wide
            for s in signs[t, f]:
                y = hadamard(y * s) / np.sqrt(width)
            size = np.abs(y)
            first = size.argmax(1)
            size[row, first] = -1
            second = size.argmax(1)
            best.append(2 * first + (y[row, first] < 0))
            other.append(2 * second + (y[row, second] < 0))
        for f in range(FUNCTIONS):
            codes[:, t] = codes[:, t] * 2 * width + best[f]
        for g in range(FUNCTIONS):
            for f in range(FUNCTIONS):
                looks[:, t, g] = looks[:, t, g] * 2 * width + (other if f == g else best)[f]
    return codes, looks


def usable(vector: str):
    """Vectors with a direction: no null, no null or non-finite component, not all zero."""
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return v.isNotNull() & F.coalesce(~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def coded(classes: DataFrame) -> DataFrame:
    """Add codes and looks to (node, copies, vector); vectors are scaled to length one."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2).to_pylist()
            widths = np.array([len(v) for v in lists])
            for width in np.unique(widths).tolist():
                pick = np.flatnonzero(widths == width)
                x = np.array([lists[i] for i in pick], np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                codes, looks = corner_codes(x)
                some = batch.take(pa.array(pick))
                salt = width << 40  # vectors of different lengths never meet
                yield pa.record_batch([some.column(0), some.column(1), pa.array(list(x)), pa.array(list(codes + salt)), pa.array(list((looks + salt).reshape(len(pick), -1)))], names=["node", "copies", "unit", "codes", "looks"])

    return classes.select("node", "copies", "vector").mapInArrow(run, "node long, copies long, unit array<double>, codes array<long>, looks array<long>")


def meetings(vectors: DataFrame) -> DataFrame:
    """(part, place, low, high, side, home, node): the entries of each bucket, home: indexed there, not only looking in. A bucket of more than BLOCK
    entries is dealt into blocks, and an entry goes to every pair of blocks that has its own; side: in the first of them."""
    table = lambda c: F.posexplode(c)
    home = vectors.select("node", table("codes").alias("table", "bucket"), F.lit(True).alias("home"))
    look = vectors.select("node", table("looks").alias("at", "bucket")).select("node", F.floor(F.col("at") / FUNCTIONS).cast("int").alias("table"), "bucket", F.lit(False).alias("home"))
    rows = saved(home.union(look), "entries")
    sizes = rows.groupBy("table", "bucket").agg(F.count("*").alias("n"), F.max("home").alias("any")).filter("any AND n > 1")
    rows = rows.join(sizes.select("table", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), ["table", "bucket"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other"), "side": F.col("own") <= F.col("other")})
    return rows.select(F.xxhash64("table", "bucket", "low", "high").alias("place"), "table", "bucket", (F.col("low") == F.col("high")).alias("alone"), "side", "home", "node")


def linked(vectors: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): for the pairs that first meet in a place, how many rows each vector is linked with, and an edge to the least vector of
    its local component."""
    entries = saved(meetings(vectors), "meetings")
    groups = max(16, -(-entries.count() // GROUP))
    rows = entries.withColumn("part", F.pmod("place", F.lit(groups))).join(vectors, "node")

    def first_meeting(codes, looks, x, y):
        """Number of the first table and kind of meeting: both at home, x at home, y at home."""
        c, d = codes[x], codes[y]
        event = np.stack([c == d, (looks[y] == c[:, :, None]).any(2), (looks[x] == d[:, :, None]).any(2)], 2)
        return event.reshape(len(x), -1).argmax(1)

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("node", "ascending"), ("home", "descending")])
        get = lambda n: np.asarray(table.column(n))
        node, copies, place, which, bucket, home, side, alone = map(get, ("node", "copies", "place", "table", "bucket", "home", "side", "alone"))
        units, codes = matrix_by_width(table.column("unit")), matrix(table.column("codes")).astype(np.int64)
        looks = matrix(table.column("looks")).astype(np.int64).reshape(len(node), TABLES, FUNCTIONS)
        cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        xs, ys = [], []
        for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(node)]):
            if e - b < 2 or not home[b:e].any():
                continue
            for i in range(b, e, BLOCK):
                close = units[i : min(e, i + BLOCK)] @ units[b:e].T >= threshold - 1e-9
                x, y = np.nonzero(close)
                x, y = x + i, y + b
                ok = (node[x] < node[y]) & (home[x] | home[y]) & (alone[x] | (side[x] != side[y]))
                xs.append(x[ok]), ys.append(y[ok])
        x, y = (np.concatenate(v) if v else np.zeros(0, int) for v in (xs, ys))
        near = np.concatenate([np.zeros(0, bool), *((units[x[i : i + 100_000]] * units[y[i : i + 100_000]]).sum(1) >= threshold for i in range(0, len(x), 100_000))])
        x, y = x[near], y[near]
        mine = np.zeros(len(x), bool)
        for i in range(0, len(x), 50_000):
            p, q = x[i : i + 50_000], y[i : i + 50_000]
            kind = np.where(home[p] & home[q], 0, np.where(home[p], 1, 2))
            mine[i : i + 50_000] = first_meeting(codes, looks, p, q) == 3 * which[p] + kind
        x, y = x[mine], y[mine]
        nodes, at = np.unique(node, return_inverse=True)
        many = np.zeros(len(nodes), np.int64)
        np.add.at(many, at[x], copies[y])
        np.add.at(many, at[y], copies[x])
        root = np.arange(len(nodes))
        a, b = at[x], at[y]
        while len(a):
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], least)
            np.minimum.at(root, root[b], least)
            root = root[root]
            if (root == before).all() and (root[a] == root[b]).all():
                break
        some = many > 0
        return pa.table({"node": nodes[some], "links": many[some], "root": nodes[root[some]]})

    def matrix_by_width(column) -> np.ndarray:
        lists = column.combine_chunks()
        widths = np.diff(np.asarray(lists.offsets))
        out = np.zeros((len(lists), max(1, int(widths.max()) if len(widths) else 1)))
        flat = np.asarray(lists.flatten())
        at = np.arange(len(flat)) - np.repeat(np.cumsum(widths) - widths, widths)
        out[np.repeat(np.arange(len(lists)), widths), at] = flat
        return out

    return rows.groupBy("part").applyInArrow(compare, "node long, links long, root long")


def near_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: pairs with a cosine of at least ``threshold`` that the tables bring together are
    linked, none below it; component_id is the smallest id that links reach.

    Null or zero vectors and those with null or non-finite components are linked with nothing. Rows with equal vectors
    are linked with each other, also if their ids are equal or null; vectors of different lengths never are. A null id stands after
    all others. Other columns are left out; an empty table gives an empty one."""
    all_rows = rows.select(F.col(id).alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("vector")).withColumn("usable", usable("vector"))
    all_rows = all_rows.withColumn("node", F.when(F.col("usable"), F.xxhash64("vector")))
    good = all_rows.filter("usable")
    classes = good.groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("least"), F.first("vector").alias("vector"))
    classes = saved(classes, "classes")
    found = saved(linked(saved(coded(classes), "codes"), threshold), "links")
    labels = components(found.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = classes.drop("vector").join(counts, "node", "left").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(smallest, "component").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    out = all_rows.join(classes, "node", "left").withColumn("component_id", F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id")).cast("long"))
    return out.select(F.col("id").alias(id), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
