"""Bottom-up Ward clustering on a neighbour graph, in rounds that merge all reciprocal nearest groups."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from .neighbors import knn
from .scale import global_position, join_hot, materialise, require

TASK_GROUPS, TASK_BYTES, TASK_EDGES = 1 << 15, 1 << 26, 1 << 20
"""Groups, bytes of their sums and edges between them that one task may hold; with no more, it goes through all further rounds by itself."""


def ward_tree(emb: DataFrame, neighbours: int = 15) -> DataFrame:
    """(hi, lo, h, round): the group named ``hi`` went into the one named ``lo`` at height ``h``; a group bears its least cell id.

    Groups merge only along edges of the graph of the ``neighbours`` nearest cells.  The cost of a merge is the growth of the
    sum of squares, ``n1 n2 / (n1 + n2)`` times the squared distance of the means.  In a round each group looks at its cheapest
    edge, and the pairs that agree on one merge.  For Ward's cost that gives the tree of the one-by-one procedure when all cells
    are neighbours; with fewer a merge can cost less than those inside it, and then takes their height.  Ties go by a hash of the
    pair, so that a lattice of equal costs does not merge one pair a round.  Where the graph falls apart, the means of what is
    left are searched for neighbours in turn.  Equal vectors merge first, in round 0 at height 0.  Only edges at a group that
    has just merged have their cost computed anew.  A round is a few jobs on written tables until what is left fits one task
    (``TASK_GROUPS``); that one makes the same rounds, so that many small ones late cost no jobs.
    """
    require(emb, "cell_id", "vec")
    if neighbours < 1:
        raise ValueError("neighbours must be at least 1")
    points = materialise(emb.select("cell_id", "vec").where("vec IS NOT NULL"))
    distinct = materialise(points.groupBy("vec").agg(F.min("cell_id").alias("id"), F.count(F.lit(1)).alias("n")))
    groups = distinct.select("id", F.col("n").cast("double").alias("n"), F.transform("vec", lambda v: v * F.col("n")).alias("s"), F.lit(0.0).alias("h"))
    copies = join_hot(points, distinct, ["vec"], "n").where("cell_id <> id")
    log = [materialise(copies.select(F.col("cell_id").alias("hi"), F.col("id").alias("lo"), F.lit(0.0).alias("h"), F.lit(0).alias("round")))]
    odd = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > 1e100))
    left, narrow, wide, some_odd = distinct.agg(F.count(F.lit(1)), F.min(F.size("vec")), F.max(F.size("vec")), F.max(odd)).first()
    plain = narrow == wide and not some_odd and isinstance(emb.schema["cell_id"].dataType, (IntegerType, LongType, StringType))
    edges, rounds = None, 0
    while left > 1:
        if edges is None:
            edges = _mean_edges(groups, min(neighbours, left - 1))
        if plain and left <= TASK_GROUPS and 8 * left * wide <= TASK_BYTES and edges.count() <= TASK_EDGES:
            done = materialise(_in_one_task(groups, edges, rounds))
            log.append(done.where("round IS NOT NULL").select("hi", F.col("id").alias("lo"), "h", "round"))
            groups, edges = done.where("round IS NULL").select("id", "n", "s", "h"), None
            left, last = done.agg(F.count_if(F.col("round").isNull()), F.max("round")).first()
            rounds = last or rounds
            continue
        rounds += 1
        moved = materialise(_agreed(edges))
        grown = materialise(_merge(groups, moved))
        log.append(grown.where("hi IS NOT NULL").select("hi", F.col("id").alias("lo"), "h", F.lit(rounds).alias("round")))
        edges = materialise(_carry(edges, moved, grown))
        groups, left = grown.select("id", "n", "s", "h"), grown.count()
        if not edges.take(1):
            edges = None
    return reduce(DataFrame.unionByName, log)


def cut_tree(emb: DataFrame, tree: DataFrame, k: int) -> DataFrame:
    """(cell_id, cluster): the tree without its ``k - 1`` highest merges; clusters are numbered from 0 by their least cell id.

    A merge is never lower than those inside it and comes in a later round, so the highest ones are the top of the tree.
    With fewer than ``k`` cells each is a cluster.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    top = tree.orderBy(F.desc("h"), F.desc("round"), F.desc("hi")).limit(k - 1).select("hi")
    kept = tree.join(top, "hi", "left_anti").select(F.col("hi").alias("node"), "lo")
    cells = emb.where("vec IS NOT NULL").select(F.col("cell_id").alias("node"))
    roots = materialise(cells.join(kept, "node", "left").select("node", F.coalesce("lo", "node").alias("up")))
    moving = True
    while moving:  # the way to the root halves each time
        rows = roots.groupBy("up").agg(F.count(F.lit(1)).alias("rows"))
        above = roots.select(F.col("node").alias("up"), F.col("up").alias("next")).join(rows, "up")
        jumped = materialise(join_hot(roots, above, ["up"], "rows").select("node", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved")))
        moving = bool(jumped.where("moved").take(1))
        roots = jumped.select("node", "up")
    sizes = roots.groupBy("up").agg(F.count(F.lit(1)).alias("rows"))
    numbered = global_position(sizes, ["up"], "place")
    return join_hot(roots, numbered, ["up"], "rows").select(F.col("node").alias("cell_id"), (F.col("place") - 1).cast("long").alias("cluster"))


def _cost(n1: Column, n2: Column, squared: Column) -> Column:
    return n1 * n2 / (n1 + n2) * squared


def _mean_edges(groups: DataFrame, neighbours: int) -> DataFrame:
    """(lo, hi, d): cost of merging each group with its nearest means."""
    near = knn(groups.select(F.col("id").alias("cell_id"), F.transform("s", lambda v: v / F.col("n")).alias("vec")), neighbours)
    pairs = near.select(F.least("cell_id", "nbr_id").alias("lo"), F.greatest("cell_id", "nbr_id").alias("hi")).distinct()
    degree = pairs.select(F.explode(F.array("lo", "hi")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    return materialise(_priced(materialise(pairs), groups.join(degree, "id")))


def _priced(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Cost of each pair; ``rows`` of a group is at least the number of its pairs."""
    one = groups.select(F.col("id").alias("lo"), F.col("n").alias("n1"), F.col("s").alias("s1"), "rows")
    two = groups.select(F.col("id").alias("hi"), F.col("n").alias("n2"), F.col("s").alias("s2"), "rows")
    both = join_hot(join_hot(pairs, one, ["lo"], "rows"), two, ["hi"], "rows")
    steps = F.zip_with("s1", "s2", lambda a, b: F.pow(a / F.col("n1") - b / F.col("n2"), 2))
    return both.select("lo", "hi", _cost(F.col("n1"), F.col("n2"), F.aggregate(steps, F.lit(0.0), lambda t, v: t + v)).alias("d"))


def _agreed(edges: DataFrame) -> DataFrame:
    """(id, rows, to, joined, d): where each group with an edge goes; at most its two ends name an edge as their cheapest."""
    ranked = edges.withColumn("e", F.struct("d", F.xxhash64("lo", "hi").alias("tie"), "lo", "hi"))
    best = ranked.select(F.explode(F.array("lo", "hi")).alias("id"), "e").groupBy("id").agg(F.min("e").alias("e"), F.count(F.lit(1)).alias("rows"))
    ends = best.groupBy("e").agg(F.collect_list(F.struct("id", "rows")).alias("ends"))
    ends = ends.select("e", (F.size("ends") == 2).alias("joined"), F.explode("ends").alias("x"))
    return ends.select("x.id", "x.rows", F.when(F.col("joined"), F.col("e.lo")).otherwise(F.col("x.id")).alias("to"), "joined", "e.d")


def _merge(groups: DataFrame, moved: DataFrame) -> DataFrame:
    """(id, n, s, h, hi, rows): the groups after a round, each made of at most two."""
    went = groups.join(moved, "id", "left").withColumn("to", F.coalesce("to", "id"))
    new = went.groupBy("to").agg(
        F.sum("n").alias("n"),
        F.collect_list("s").alias("parts"),
        F.greatest(F.max("h"), F.max(F.when(F.col("joined"), F.col("d")))).alias("h"),
        F.max(F.when(F.col("id") != F.col("to"), F.col("id"))).alias("hi"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )
    total = F.when(F.size("parts") == 2, F.zip_with(F.get("parts", F.lit(0)), F.get("parts", F.lit(1)), lambda a, b: a + b)).otherwise(F.get("parts", F.lit(0)))
    return new.select(F.col("to").alias("id"), "n", total.alias("s"), "h", "hi", "rows")


def _carry(edges: DataFrame, moved: DataFrame, grown: DataFrame) -> DataFrame:
    """The edges between the groups after a round."""
    one = moved.select(F.col("id").alias("lo"), F.col("to").alias("a"), F.col("joined").alias("j1"), "rows")
    two = moved.select(F.col("id").alias("hi"), F.col("to").alias("b"), F.col("joined").alias("j2"), "rows")
    both = join_hot(join_hot(edges, one, ["lo"], "rows"), two, ["hi"], "rows").where("a <> b")
    both = both.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "d", (F.col("j1") | F.col("j2")).alias("anew"))
    return both.where("NOT anew").select("lo", "hi", "d").unionByName(_priced(both.where("anew").select("lo", "hi").distinct(), grown))


def _in_one_task(groups: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """(id, hi, n, s, h, round): the merges of all rounds while there are edges, and with no round the groups that are left."""
    kind = groups.schema["id"].dataType

    def run(mine: pa.Table, pairs: pa.Table) -> pa.Table:
        order = pc.sort_indices(mine.column("id"))
        mine = mine.take(order)
        ids = mine.column("id").combine_chunks()
        n, h = np.asarray(mine.column("n")).copy(), np.asarray(mine.column("h")).copy()
        s = np.asarray(mine.column("s").combine_chunks().flatten()).astype(float).reshape(len(n), -1)
        lo, hi = (np.asarray(pc.index_in(pairs.column(c).combine_chunks(), ids)).astype(np.int64) for c in ("lo", "hi"))
        gone, into, high, when, alive = _rounds(n, s, h, lo, hi, np.asarray(pairs.column("d")).copy(), _pair_hash(ids, kind))
        kept = np.flatnonzero(alive)
        whole = lambda values, none: pa.array(np.concatenate(values), mask=np.concatenate([np.full(len(v), x) for v, x in zip(values, none)]))
        return pa.table({
            "id": pa.concat_arrays([ids.take(pa.array(into)), ids.take(pa.array(kept))]),
            "hi": pa.concat_arrays([ids.take(pa.array(gone)), pa.nulls(len(kept), ids.type)]),
            "n": whole([np.zeros(len(into)), n[kept]], [True, False]),
            "s": pa.concat_arrays([pa.nulls(len(into), pa.list_(pa.float64())), pa.array(list(s[kept]), pa.list_(pa.float64()))]),
            "h": np.concatenate([high, h[kept]]),
            "round": whole([(when + rounds).astype(np.int32), np.zeros(len(kept), np.int32)], [False, True]),
        })

    one = F.lit(0).alias("_all")
    both = groups.select(one, "id", "n", "s", "h").groupBy("_all").cogroup(edges.select(one, "lo", "hi", "d").groupBy("_all"))
    id_kind = kind.simpleString()
    return both.applyInArrow(run, f"id {id_kind}, hi {id_kind}, n double, s array<double>, h double, round int")


def _rounds(n: np.ndarray, s: np.ndarray, h: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: np.ndarray, tie) -> tuple[np.ndarray, ...]:
    """(hi, lo, height, round) of every merge and which groups are left, by the rules of :func:`_agreed`, :func:`_merge` and :func:`_carry`; n, s and h are brought up to date."""
    alive, found, turn = np.ones(len(n), bool), [], 0
    at = np.arange(len(n))
    while len(lo):
        turn += 1
        least = np.full(len(n), np.inf)
        np.minimum.at(least, lo, d)
        np.minimum.at(least, hi, d)
        best = np.full(len(n), -1)
        close = np.flatnonzero((d == least[lo]) | (d == least[hi]))
        for end in (lo, hi):
            mine = close[d[close] == least[end[close]]]
            best[end[mine]] = mine
        equal = np.bincount(lo[close], d[close] == least[lo[close]], len(n)) + np.bincount(hi[close], d[close] == least[hi[close]], len(n)) > 1
        if equal.any():
            some = close[equal[lo[close]] | equal[hi[close]]]
            some = some[np.lexsort((hi[some], lo[some], tie(lo[some], hi[some])))][::-1]  # of several, what is set last stays
            ends, some = np.column_stack([lo[some], hi[some]]).ravel(), np.repeat(some, 2)
            mine = equal[ends] & (d[some] == least[ends])
            best[ends[mine]] = some[mine]
        joined = close[(best[lo[close]] == close) & (best[hi[close]] == close)]
        a, b = lo[joined], hi[joined]
        h[a] = np.maximum(np.maximum(h[a], h[b]), d[joined])
        n[a] += n[b]
        s[a] += s[b]
        alive[b] = False
        found.append((b, a, h[a], np.full(len(a), turn)))
        to = at.copy()
        to[b] = a
        grew = np.zeros(len(n), bool)
        grew[a] = True
        p, q = to[lo], to[hi]
        inside = p == q
        anew = (grew[p] | grew[q]) & ~inside
        key = np.unique(np.minimum(p, q)[anew] * len(n) + np.maximum(p, q)[anew])
        first, second = key // len(n), key % len(n)
        same = ~anew & ~inside
        lo, hi, d = np.concatenate([lo[same], first]), np.concatenate([hi[same], second]), np.concatenate([d[same], _prices(n, s, first, second)])
    merges = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
    return *merges, alive


def _prices(n: np.ndarray, s: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cost of merging each pair, added up in the order of :func:`_priced`."""
    out = np.zeros(len(one))
    for begin in range(0, len(one), 1 << 16):
        i, j = one[begin : begin + (1 << 16)], two[begin : begin + (1 << 16)]
        n1, n2 = n[i], n[j]
        steps = (s[i] / n1[:, None] - s[j] / n2[:, None]) ** 2
        out[begin : begin + (1 << 16)] = n1 * n2 / (n1 + n2) * (np.cumsum(steps, axis=1)[:, -1] if steps.shape[1] else 0.0)
    return out


P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
WORD = (1 << 64) - 1


def _pair_hash(ids: pa.Array, kind):
    """``tie(lo, hi)`` of places in ``ids``: what Spark's xxhash64 gives for the two ids."""
    turned = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(P2)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(P3)
        return x ^ (x >> np.uint64(32))

    def whole(v: np.ndarray, seed) -> np.ndarray:
        if isinstance(kind, LongType):
            x = (seed + np.uint64((P5 + 8) & WORD)) ^ (turned(v * np.uint64(P2), 31) * np.uint64(P1))
            return mixed(turned(x, 27) * np.uint64(P1) + np.uint64(P4))
        x = (seed + np.uint64((P5 + 4) & WORD)) ^ ((v & np.uint64(0xFFFFFFFF)) * np.uint64(P1))
        return mixed(turned(x, 23) * np.uint64(P2) + np.uint64(P3))

    if isinstance(kind, StringType):
        names = [x.encode() for x in ids.to_pylist()]
        return lambda lo, hi: np.array([_bytes_hash(names[j], _bytes_hash(names[i], 42)) for i, j in zip(lo, hi)], np.uint64).view(np.int64)
    v = np.asarray(ids).astype(np.int64).view(np.uint64)
    return lambda lo, hi: whole(v[hi], whole(v[lo], np.uint64(42))).view(np.int64)


def _bytes_hash(data: bytes, seed: int) -> int:
    """XXH64."""
    turned = lambda x, r: ((x << r) | (x >> (64 - r))) & WORD
    lane = lambda x, v: turned((x + v * P2) & WORD, 31) * P1 & WORD
    at, size = 0, len(data)
    if size >= 32:
        parts = [(seed + P1 + P2) & WORD, (seed + P2) & WORD, seed, (seed - P1) & WORD]
        while at + 32 <= size:
            parts = [lane(x, int.from_bytes(data[at + 8 * i : at + 8 * i + 8], "little")) for i, x in enumerate(parts)]
            at += 32
        x = sum(turned(v, r) for v, r in zip(parts, (1, 7, 12, 18))) & WORD
        for v in parts:
            x = ((x ^ lane(0, v)) * P1 + P4) & WORD
    else:
        x = (seed + P5) & WORD
    x = (x + size) & WORD
    for at in range(at, size - 7, 8):
        x = (turned(x ^ lane(0, int.from_bytes(data[at : at + 8], "little")), 27) * P1 + P4) & WORD
    at = size - size % 8
    if at + 4 <= size:
        x = (turned(x ^ (int.from_bytes(data[at : at + 4], "little") * P1 & WORD), 23) * P2 + P3) & WORD
        at += 4
    for v in data[at:]:
        x = turned(x ^ (v * P5 & WORD), 11) * P1 & WORD
    x = ((x ^ (x >> 33)) * P2) & WORD
    x = ((x ^ (x >> 29)) * P3) & WORD
    return x ^ (x >> 32)
