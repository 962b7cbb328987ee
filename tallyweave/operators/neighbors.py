"""Nearest neighbours and the cell graphs built from them.

The neighbour search never emits pairs of cells as rows.  Vectors are packed into tiles of bounded size around a
bounded number of pivots; a row of work is a pair of tiles, read from the written tiles and not shuffled.  A task keeps the k best
of its queries over all tiles that it goes through, and only they leave it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .scale import any_hot, join_hot, lookup_join, materialise, require

MAX_PIVOTS = 2048
"""Largest number of pivots; their distance matrix is the only search structure held by the driver."""

TILE_ROWS = 512
"""Vectors per tile."""

SLAB_BYTES = 1 << 26
"""Bytes of vectors that a task goes through for its queries, and holds."""


def unit_centred(emb: DataFrame) -> DataFrame:
    """Centre and normalise each vector, so that half the squared distance is 1 - Pearson."""
    add = lambda a, v: a + v
    mean = F.aggregate("vec", F.lit(0.0), add) / F.size("vec")
    emb = emb.withColumn("_m", mean)
    emb = emb.withColumn("_c", F.transform("vec", lambda v: v - F.col("_m")))
    norm = F.sqrt(F.aggregate("_c", F.lit(0.0), lambda a, v: a + v * v))
    emb = emb.withColumn("_n", norm)
    unit = F.transform("_c", lambda v: F.when(F.col("_n") > 0, v / F.col("_n")).otherwise(0.0))
    return emb.select("cell_id", unit.alias("vec"))


def knn(
    emb: DataFrame, k: int, metric: str = "euclidean", probe: str | int = "all", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """(cell_id, nbr_id, rank, dist): the ``k`` nearest other cells, ties by id.

    ``probe='all'`` is exact: after the nearest blocks have given every query an upper bound, a tile is compared
    with all blocks the triangle inequality cannot rule out.  An integer compares each block only with that many
    nearest blocks, itself included, which is approximate and linear in the number of cells.
    Cells with equal vectors are searched once and share their candidates.
    """
    require(emb, "cell_id", "vec")
    if metric not in ("euclidean", "correlation"):
        raise ValueError(metric)
    if probe != "all" and int(probe) < 1:
        raise ValueError("probe must be 'all' or at least 1")
    points = emb.select("cell_id", "vec") if metric == "euclidean" else unit_centred(emb)
    copies = points.groupBy("vec").agg(F.min("cell_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    distinct = materialise(copies)
    n = distinct.count()
    if n == 0:
        raise ValueError("no vectors")
    repeated = distinct.where("copies > 1").limit(1).count() > 0
    reps = _search(distinct.select("rep", "vec"), n, k, probe, tile_rows)
    if not repeated:
        out = reps
    else:
        out = _spread_to_copies(points, distinct, materialise(reps), k)
    dist = F.col("dist") if metric == "euclidean" else F.col("dist") * F.col("dist") / 2
    return materialise(out.select("cell_id", "nbr_id", "rank", dist.alias("dist")))


def _search(reps: DataFrame, n: int, k: int, probe, tile_rows: int) -> DataFrame:
    import numpy as np

    n_pivots = max(1, min(MAX_PIVOTS, n // tile_rows))
    drawn = reps.orderBy(F.md5(F.col("rep").cast("string")), "rep").limit(n_pivots).collect()  # <= MAX_PIVOTS rows
    pivots = np.array([r["vec"] for r in drawn], dtype=float)
    dim = pivots.shape[1]
    id_kind = reps.schema["rep"].dataType.simpleString()

    def assign(frames):
        import numpy as np

        half = (pivots * pivots).sum(1) / 2
        for pdf in frames:
            v = np.stack(pdf["vec"].to_numpy()) if len(pdf) else np.empty((0, dim))
            near = np.argmin(half - v @ pivots.T, axis=1)
            out = pdf.copy()
            out["block"] = near.astype("int32")
            out["radius"] = np.sqrt(((v - pivots[near]) ** 2).sum(1))
            yield out

    placed = materialise(reps.mapInPandas(assign, f"rep {id_kind}, vec array<double>, block int, radius double"))
    sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("size"))  # <= MAX_PIVOTS rows
    tiled = placed.join(F.broadcast(sizes), "block")
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / tile_rows)).cast("int")).drop("size")
    wide = len(pivots) if probe == "all" else min(len(pivots), int(probe))
    first = min(wide, 4)
    exact_later = probe == "all" and first < len(pivots)

    def pack(pdf):
        import numpy as np
        import pandas as pd

        block = int(pdf["block"].iloc[0])
        gap = np.sqrt(((pivots - pivots[block]) ** 2).sum(1))
        near = np.argsort(gap, kind="stable")[: first if exact_later else wide].astype("int32")
        return pd.DataFrame({
            "block": [block], "tile": [pdf["tile"].iloc[0]], "radius": [pdf["radius"].max()], "near": [near], "gap": [gap],
            "ids": [pdf["rep"].to_numpy()], "mat": [np.stack(pdf["vec"].to_numpy()).astype(float).tobytes()],
        })

    # about tile_rows vectors in each group, by hash
    packed = tiled.groupBy("block", "tile").applyInPandas(
        pack, f"block int, tile int, radius double, near array<int>, gap array<double>, ids array<{id_kind}>, mat binary"
    )
    files = max(1, min(n // tile_rows, 2 * reps.sparkSession.sparkContext.defaultParallelism))
    packed = materialise(packed.repartition(files))
    slabs = max(1, math.ceil(8 * n * dim / SLAB_BYTES))
    listed = F.array_contains("q_near", F.col("d_block"))
    found = _best(_compare(packed.withColumn("limit", F.lit(float("inf"))), packed, listed, slabs, k, dim, id_kind), k)
    if not exact_later:
        return found
    found = materialise(found)
    # upper bound per query tile: its worst k-th distance so far, endless when its queries have fewer than k
    per_cell = found.groupBy("block", "tile", "cell_id").agg(F.count(F.lit(1)).alias("have"), F.max("dist").alias("worst"))
    limit = F.when(F.min("have") >= k, F.max("worst"))
    bounds = materialise(per_cell.groupBy("block", "tile").agg(limit.alias("limit")))
    bounded = lookup_join(packed, bounds, ["block", "tile"])
    bounded = bounded.withColumn("limit", F.coalesce(F.col("limit") * (1 + 1e-9), F.lit(float("inf"))))
    gap = F.col("q_gap")[F.col("d_block")]
    open_ = ~listed & (gap - F.col("q_radius") - F.col("d_radius") <= F.col("q_limit"))
    more = _compare(bounded, packed, open_, slabs, k, dim, id_kind)
    return _best(found.drop("rank").unionByName(more), k)


def _compare(queries: DataFrame, packed: DataFrame, route, slabs: int, k: int, dim: int, id_kind: str) -> DataFrame:
    """Candidates (block, tile, cell_id, nbr_id, dist): the k best of every query among the tiles of every slab that ``route`` leads to.

    Tiles meet by a product of two written tables, which reads them and shuffles nothing.  A task goes through one slab of tiles for
    each of its query tiles and keeps the k best of all of them, so what leaves it does not grow with the pairs of tiles.
    """
    named = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    d = named(packed.select("block", "tile", "radius", "ids", "mat").coalesce(slabs), "d")
    work = named(queries, "q").join(d.hint("shuffle_replicate_nl"), route)
    work = work.select("q_block", "q_tile", "q_limit", "q_ids", "q_mat", "d_block", "d_tile", "d_ids", "d_mat")

    def nearest(batches):
        import numpy as np
        import pyarrow as pa

        names = ["block", "tile", "cell_id", "nbr_id", "dist"]
        home = None

        def numbers(batch, name, row):
            return np.asarray(batch.column(name)[row].values.to_pylist())

        def told():
            at, dist, nbr = best
            kind = pa.string() if id_kind == "string" else None
            fixed = [pa.array(np.full(len(at), v, dtype="int32")) for v in home]
            return pa.record_batch([*fixed, pa.array(q_ids[at], kind), pa.array(nbr, kind), pa.array(dist)], names=names)

        for batch in batches:
            q_homes = list(zip(batch.column("q_block").to_pylist(), batch.column("q_tile").to_pylist()))
            d_homes = list(zip(batch.column("d_block").to_pylist(), batch.column("d_tile").to_pylist()))
            for row, (q_home, d_home) in enumerate(zip(q_homes, d_homes)):
                if q_home != home:
                    if home is not None and len(best[0]):
                        yield told()
                    home = q_home
                    q = np.frombuffer(batch.column("q_mat")[row].as_buffer()).reshape(-1, dim).copy()
                    q_ids, qq = numbers(batch, "q_ids", row), (q * q).sum(1)
                    worst = np.full(len(q), batch.column("q_limit")[row].as_py())
                    best = (np.empty(0, int), np.empty(0), q_ids[:0])
                d = np.frombuffer(batch.column("d_mat")[row].as_buffer()).reshape(-1, dim)
                dd = (d * d).sum(1)
                rough = q @ d.T
                rough *= -2
                rough += qq[:, None]
                rough += dd[None, :]
                if q_home == d_home:
                    np.fill_diagonal(rough, np.inf)
                # everything that rounding could still place among the k best is measured exactly
                slack = 1e-11 * (1 + qq + dd.max())
                cut = worst * worst + slack
                unsure = np.flatnonzero(~np.isfinite(cut))
                if len(unsure):
                    kk = min(k, len(d))
                    cut[unsure] = np.partition(rough[unsure], kk - 1, axis=1)[:, kk - 1] + slack[unsure]
                cut = np.minimum(cut, np.finfo(float).max)
                at, of = np.nonzero(rough <= cut[:, None])
                if not len(at):
                    continue
                dist = np.sqrt(((q[at] - d[of]) ** 2).sum(1))
                moved = np.zeros(len(q), bool)
                moved[at] = True
                again = moved[best[0]]
                at = np.concatenate([best[0][again], at])
                dist = np.concatenate([best[1][again], dist])
                nbr = np.concatenate([best[2][again], numbers(batch, "d_ids", row)[of]])
                rank = np.lexsort((nbr, dist, at))
                at, dist, nbr = at[rank], dist[rank], nbr[rank]
                place = np.arange(len(at)) - np.searchsorted(at, at, side="left")
                last = place == k - 1
                worst[at[last]] = np.minimum(worst[at[last]], dist[last])
                keep = place < k
                best = tuple(np.concatenate([old[~again], new[keep]]) for old, new in zip(best, (at, dist, nbr)))
        if home is not None and len(best[0]):
            yield told()

    return work.mapInArrow(nearest, f"block int, tile int, cell_id {id_kind}, nbr_id {id_kind}, dist double")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("cell_id").orderBy("dist", "nbr_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _spread_to_copies(points: DataFrame, distinct: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """Neighbours of all cells from those of the distinct vectors.

    A cell's candidates are the first k + 1 cells with its own vector and the first k cells of each neighbouring
    vector, so a crowd of copies costs k + 1 candidates, not its square.
    """
    members = join_hot(points, distinct, ["vec"], "copies").select("cell_id", "rep")
    members = materialise(members)
    w = Window.partitionBy("rep").orderBy("cell_id")
    firsts = members.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= k + 1)
    firsts = materialise(firsts.select("rep", F.col("cell_id").alias("nbr_id")))
    own = firsts.select("rep", "nbr_id", F.lit(0.0).alias("dist"))
    indegree = reps.groupBy("nbr_id").agg(F.count(F.lit(1)).alias("_rows"))
    listed = firsts.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("nbr_id")), 1, k).alias("ids"))
    listed = listed.withColumnRenamed("rep", "nbr_id").join(indegree, "nbr_id")
    near = join_hot(reps, listed, ["nbr_id"], "_rows")
    near = near.select(F.col("cell_id").alias("rep"), F.explode("ids").alias("nbr_id"), "dist")
    best = Window.partitionBy("rep").orderBy("dist", "nbr_id")
    pool = own.unionByName(near).withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= k + 1)
    pool = pool.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("dist", "nbr_id"))).alias("pool"))
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("_rows"))
    every = join_hot(members, pool.join(sizes, "rep"), ["rep"], "_rows")
    others = F.slice(F.filter("pool", lambda c: c["nbr_id"] != F.col("cell_id")), 1, k)
    return every.select("cell_id", F.posexplode(others).alias("_p", "c")).select(
        "cell_id", F.col("c.nbr_id").alias("nbr_id"), F.col("c.dist").alias("dist"), (F.col("_p") + 1).alias("rank")
    )


HUB_ROWS = 20_000
"""Cells that share a neighbour, above which that neighbour's self-join is cut into pieces."""


def snn(knn_table: DataFrame, k: int = 10, prune: float = 1 / 15, hub_rows: int = HUB_ROWS) -> DataFrame:
    """Shared-neighbour graph: edges (src, dst, w), src < dst, w = s / (2k - s) for s shared neighbours.

    A cell's set is itself and its k - 1 nearest.  Edges below ``prune`` need s below some t, so two cells with an
    edge share one of the k - t + 1 rarest members of their sets: only those are joined on.  A pair is kept at the
    rarest member it shares, so each edge leaves the join once and nothing else does.
    """
    require(knn_table, "cell_id", "nbr_id", "rank")
    need = max(1, math.ceil(2 * k * prune / (1 + prune) - 1e-12))
    near = knn_table.where(F.col("rank") <= k - 1).select("cell_id", "nbr_id")
    near = near.unionByName(near.select("cell_id", F.col("cell_id").alias("nbr_id")).distinct())
    degree = materialise(near.groupBy("nbr_id").agg(F.count(F.lit(1)).alias("deg")))
    marked = join_hot(near, degree.withColumn("_rows", F.col("deg")), ["nbr_id"], "_rows", hot=any_hot(degree, "deg"))
    sets = marked.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("deg", "nbr_id"))).alias("s"))  # k entries
    sets = sets.select("cell_id", F.col("s.nbr_id").alias("ids"), F.col("s.deg").alias("degs"))
    rare = F.slice(F.arrays_zip("ids", "degs"), F.lit(1), F.greatest(F.size("ids") - (need - 1), F.lit(1)))
    rows = sets.select("cell_id", "ids", F.explode(rare).alias("r"))
    rows = materialise(
        rows.select("cell_id", "ids", F.col("r.ids").alias("key"), F.ceil(F.col("r.degs") / hub_rows).cast("int").alias("pieces"))
    )
    a = rows.select(
        F.col("cell_id").alias("src"), F.col("ids").alias("a"), "key", F.pmod(F.xxhash64("cell_id"), F.col("pieces")).cast("int").alias("piece")
    )
    b = rows.select(
        F.col("cell_id").alias("dst"), F.col("ids").alias("b"), "key", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
    )
    common = F.array_intersect("a", "b")
    shared = F.size(common)
    return (
        a.join(b, ["key", "piece"])
        .where((F.col("src") < F.col("dst")) & (shared >= need) & (F.element_at(common, 1) == F.col("key")))
        .select("src", "dst", (shared / (2.0 * k - shared)).alias("w"))
    )


def _both_ends(knn_table: DataFrame, per_cell: DataFrame) -> DataFrame:
    """Attach a per-cell table to both ends of each neighbour row, as ``a_*`` and ``b_*``."""
    cols = [c for c in per_cell.columns if c != "cell_id"]
    mine = per_cell.select("cell_id", *[F.col(c).alias(f"a_{c}") for c in cols])
    theirs = per_cell.select(F.col("cell_id").alias("nbr_id"), *[F.col(c).alias(f"b_{c}") for c in cols])
    indegree = materialise(knn_table.groupBy("nbr_id").agg(F.count(F.lit(1)).alias("_rows")))
    hot = any_hot(indegree, "_rows")
    return join_hot(knn_table.join(mine, "cell_id"), theirs.join(indegree, "nbr_id"), ["nbr_id"], "_rows", hot=hot)


def _undirected(rows: DataFrame) -> DataFrame:
    """One row per unordered pair from a symmetric weight; drops self loops."""
    pair = rows.where("cell_id <> nbr_id").select(F.least("cell_id", "nbr_id").alias("src"), F.greatest("cell_id", "nbr_id").alias("dst"), "w")
    return pair.groupBy("src", "dst").agg(F.max("w").alias("w"))


def gauss_graph(knn_table: DataFrame) -> DataFrame:
    """Adaptive Gaussian weights; sigma is half the distance to the last neighbour."""
    require(knn_table, "cell_id", "nbr_id", "dist")
    sigma = knn_table.groupBy("cell_id").agg((F.max("dist") / 2).alias("s"))
    rows = _both_ends(knn_table, sigma)
    a, b = F.col("a_s"), F.col("b_s")
    both = a * a + b * b
    w = F.sqrt(2 * a * b / both) * F.exp(-F.col("dist") * F.col("dist") / both)
    return _undirected(rows.select("cell_id", "nbr_id", F.when(both > 0, w).otherwise(1.0).alias("w")))


def umap_weights(knn_table: DataFrame, rounds: int = 64) -> DataFrame:
    """Directed weights exp(-max(0, d - rho) / sigma), with sigma such that they sum to log2(k)."""
    lists = knn_table.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("dist", "nbr_id"))).alias("near"))  # k entries
    gaps = F.transform("near", lambda c: F.greatest(c["dist"] - F.col("near")[0]["dist"], F.lit(0.0)))
    lists = lists.select("cell_id", "near", gaps.alias("gaps"), F.log2(F.size("near").cast("double")).alias("target"))
    total = lambda s: F.aggregate("gaps", F.lit(0.0), lambda acc, g: acc + F.exp(-g / s["mid"]))

    def halve(s, _):
        s2 = F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"), s["mid"].alias("mid"), total(s).alias("sum"))
        return F.element_at(F.transform(F.array(s2), _narrow), 1)

    def _narrow(s):
        over = s["sum"] > F.col("target")
        lo = F.when(over, s["lo"]).otherwise(s["mid"])
        hi = F.when(over, s["mid"]).otherwise(s["hi"])
        mid = F.when(hi < 0, lo * 2).otherwise((lo + hi) / 2)
        return F.struct(lo.alias("lo"), hi.alias("hi"), mid.alias("mid"))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(-1.0).alias("hi"), F.lit(1.0).alias("mid"))
    sigma = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, halve, lambda s: s["mid"])
    lists = lists.withColumn("sigma", sigma)
    pairs = F.arrays_zip("near", "gaps")
    rows = lists.select("cell_id", "sigma", F.explode(pairs).alias("p"))
    return rows.select("cell_id", F.col("p.near.nbr_id").alias("nbr_id"), F.exp(-F.col("p.gaps") / F.col("sigma")).alias("w"))


def umap_graph(knn_table: DataFrame) -> DataFrame:
    """Union of the directed weights of both ends: a + b - ab."""
    rows = umap_weights(knn_table)
    pair = rows.select(
        F.least("cell_id", "nbr_id").alias("src"), F.greatest("cell_id", "nbr_id").alias("dst"), "w"
    ).groupBy("src", "dst")
    top, low = F.max("w"), F.when(F.count(F.lit(1)) > 1, F.min("w")).otherwise(0.0)
    return pair.agg((top + low - top * low).alias("w"))
