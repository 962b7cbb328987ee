"""Graph analytics on edge lists (src, dst, w) with src < dst: communities, group graph, diffusion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.formulas import ratio
from .scale import LOOKUP_ROWS, any_hot, global_position, join_hot, lookup_join, materialise, require


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge."""
    require(edges, "src", "dst", "w")
    both = F.array(F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.where("src <> dst").select(F.explode(both).alias("e"), "w").select("e.src", "e.dst", "w")


def _rows_per(sym: DataFrame, key: str, *more: Column) -> DataFrame:
    return sym.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *more)


# --- communities -----------------------------------------------------------------------------------------------


def _level(edges: DataFrame, labels: DataFrame):
    """Symmetric edges that carry the source's strength, node states, twice the weight, and whether a node is hot.

    A loop counts twice in its node's strength, and is kept aside as ``loop``.
    """
    loops = edges.where("src = dst").groupBy(F.col("src").alias("node")).agg((2 * F.sum("w")).alias("loop"))
    plain = materialise(symmetric(edges))
    strength = _rows_per(plain, "src", F.sum("w").alias("k")).withColumnRenamed("src", "node")
    zero = F.lit(0.0)
    state = labels.join(strength, "node", "left").join(loops, "node", "left").select(
        "node", "comm", (F.coalesce("k", zero) + F.coalesce("loop", zero)).alias("k"), F.coalesce("loop", zero).alias("loop"),
        F.coalesce("_rows", F.lit(0)).cast("long").alias("_rows"),
    )
    state = materialise(state)
    hot = any_hot(state, "_rows")
    sym = materialise(join_hot(plain, state.select(F.col("node").alias("src"), "k", "_rows"), ["src"], "_rows", hot=hot))
    return sym, state, float(state.agg(F.sum("k")).first()[0] or 0.0), hot


def _best_moves(sym: DataFrame, state: DataFrame, resolution: float, two_m: float, hot: bool, groups: int | None = None) -> DataFrame:
    """(node, comm, best, k, loop, _rows, inner): each node's best neighbouring community.

    ``inner`` is the node's weight into its own community.  Gains are compared to ten digits so that equal ones
    tie whatever the order of summing; ties go to the smallest community, and staying wins over an equal move.
    """
    at = state.select(F.col("node").alias("dst"), F.col("comm").alias("to"), "_rows")
    hops = join_hot(sym, at, ["dst"], "_rows", hot=hot).select(F.col("src").alias("node"), "to", "w", "k")
    nothing = F.lit(None)
    hops = hops.select("*", nothing.cast("double").alias("loop"), nothing.cast("long").alias("_rows"), F.lit(False).alias("own"))
    home = state.select("node", F.col("comm").alias("to"), F.lit(0.0).alias("w"), "k", "loop", "_rows", F.lit(True).alias("own"))
    links = hops.unionByName(home).groupBy("node", "to").agg(
        F.sum("w").alias("w"), F.max("k").alias("k"), F.max("loop").alias("loop"), F.max("_rows").alias("_rows"), F.max("own").alias("own")
    )
    totals = state.groupBy(F.col("comm").alias("to")).agg(F.sum("k").alias("tot"))
    # the caller may know the number of communities from the round before
    small = groups is not None and groups <= LOOKUP_ROWS
    links = links.join(F.broadcast(totals), "to") if small else lookup_join(links, totals, ["to"], "inner")
    rest = F.col("tot") - F.when(F.col("own"), F.col("k")).otherwise(0.0)
    links = links.withColumn("gain", F.round((F.col("w") - resolution * F.col("k") * rest / two_m) / two_m, 10))
    at_home = lambda c: F.max(F.when(F.col("own"), F.col(c)))
    best = links.groupBy("node").agg(
        at_home("to").alias("comm"), at_home("gain").alias("stay"), at_home("w").alias("inner"),
        F.min(F.struct((-F.col("gain")).alias("g"), F.col("to").alias("to"))).alias("b"),
        F.max("k").alias("k"), F.max("loop").alias("loop"), F.max("_rows").alias("_rows"),
    )
    move = F.when(-F.col("b.g") > F.col("stay"), F.col("b.to")).otherwise(F.col("comm"))
    return best.select("node", "comm", move.alias("best"), "k", "loop", "_rows", "inner")


def _turn(parity: int) -> Column:
    even = F.substring(F.md5(F.col("node").cast("string")), 1, 1).isin(*"02468ace")  # ids may be numbers or strings
    return F.when(even == F.lit(parity % 2 == 0), F.col("best")).otherwise(F.col("comm"))


def louvain_round(edges: DataFrame, labels: DataFrame, resolution: float = 1.0, parity: int = 0) -> DataFrame:
    """One round of moves from ``labels(node, community)``: nodes whose id hashes to this parity take their best community."""
    sym, state, two_m, hot = _level(materialise(edges), labels.select("node", F.col("community").alias("comm")))
    return _best_moves(sym, state, resolution, two_m, hot).select("node", _turn(parity).alias("community"))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row (q): sum over communities of w_in / 2m - resolution * (tot / 2m)^2; ``labels(node, community)``."""
    edges = materialise(edges)
    both = F.when(F.col("src") == F.col("dst"), 2.0 * F.col("w")).otherwise(F.col("w"))
    ends = symmetric(edges).unionByName(edges.where("src = dst").select("src", "dst", both.alias("w")))
    degree = _rows_per(ends, "src")
    at = materialise(labels.select(F.col("node").alias("src"), F.col("community").alias("c1")).join(degree, "src"))
    hot = any_hot(at, "_rows")
    other = at.select(F.col("src").alias("dst"), F.col("c1").alias("c2"), "_rows")
    ends = join_hot(join_hot(ends, at, ["src"], "_rows", hot=hot), other, ["dst"], "_rows", hot=hot)
    per = materialise(
        ends.groupBy(F.col("c1").alias("c")).agg(
            F.sum("w").alias("tot"), F.sum(F.when(F.col("c1") == F.col("c2"), F.col("w")).otherwise(0.0)).alias("w_in")
        )
    )
    per = per.withColumn("m", per.agg(F.sum("tot").alias("m")).scalar())
    share = F.col("tot") / F.col("m")
    return per.agg(F.sum(F.col("w_in") / F.col("m") - resolution * share * share).alias("q"))


def louvain(edges: DataFrame, resolution: float = 1.0, rounds: int = 8, levels: int = 4, nodes: DataFrame | None = None) -> DataFrame:
    """Modularity communities: (node, community), the community named by its smallest node.

    Every level runs rounds of simultaneous moves in which only nodes of one parity of the hashed id move, keeps the best
    labelling seen, and contracts communities to nodes.  A round's own aggregates give the modularity of the
    labelling it started from.  Stops when a level no longer raises it.
    """
    require(edges, "src", "dst", "w")
    graph = materialise(edges)
    every = graph.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    if nodes is not None:
        every = every.unionByName(nodes.select("node")).distinct()
    final = materialise(every.select("node", F.col("node").alias("community")))
    reached = None
    for _ in range(levels):
        singles = final.select(F.col("community").alias("node")).distinct().select("node", F.col("node").alias("comm"))
        sym, state, two_m, hot = _level(graph, singles)
        if two_m == 0:
            return final
        best, best_q, quiet, groups = None, reached, 0, None
        for turn in range(rounds + 1):
            moved = materialise(_best_moves(sym, state, resolution, two_m, hot, groups).withColumn("next", _turn(turn)))
            inner, changed, squares, groups = (
                moved.groupBy("comm")
                .agg(F.sum("k").alias("t"), F.sum(F.col("inner") + F.col("loop")).alias("i"), F.count_if(F.col("next") != F.col("comm")).alias("c"))
                .agg(F.sum("i"), F.sum("c"), F.sum(F.col("t") * F.col("t")), F.count(F.lit(1)))
                .first()
            )
            q = inner / two_m - resolution * squares / two_m**2
            gained = best_q is not None and q > best_q + 1e-6
            if best_q is None:
                best_q = q
            elif q > best_q:
                best, best_q = moved, q
            quiet = 0 if changed and (gained or turn < 2) else quiet + 1
            if quiet == 2:
                break
            state = moved.select("node", F.col("next").alias("comm"), "k", "loop", "_rows")
        if best is None:
            break
        names = best.groupBy("comm").agg(F.min("node").alias("up"))
        named = materialise(lookup_join(best.select("node", "comm"), names, ["comm"], "inner").select("node", "up"))
        final = materialise(
            lookup_join(final, named.withColumnRenamed("node", "community"), ["community"], "inner").select("node", F.col("up").alias("community"))
        )
        graph = materialise(contract(graph, named))
        gained = reached is None or best_q - reached > 1e-7
        reached = best_q
        if not gained:
            break
    return final


def contract(edges: DataFrame, named: DataFrame) -> DataFrame:
    """Edges between the groups of ``named(node, up)``; inner weight becomes a loop."""
    a = named.select(F.col("node").alias("src"), F.col("up").alias("a"))
    b = named.select(F.col("node").alias("dst"), F.col("up").alias("b"))
    up = lookup_join(lookup_join(edges, a, ["src"], "inner"), b, ["dst"], "inner")
    return up.groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg(F.sum("w").alias("w"))


def overcluster(edges: DataFrame, resolution: float = 1.0, rounds: int = 8) -> DataFrame:
    """(node, parent, cluster): communities, then communities inside every community in one run."""
    edges = materialise(edges)
    parent = louvain(edges, resolution, rounds)
    a = parent.select(F.col("node").alias("src"), F.col("community").alias("ca"))
    b = parent.select(F.col("node").alias("dst"), F.col("community").alias("cb"))
    inside = lookup_join(lookup_join(edges, a, ["src"], "inner"), b, ["dst"], "inner")
    inside = inside.where("ca = cb").select("src", "dst", "w")
    child = louvain(inside, resolution, rounds, nodes=parent.select("node")).withColumnRenamed("community", "child")
    both = parent.join(child, "node")
    name = F.concat_ws(",", F.col("community").cast("string"), F.col("child").cast("string"))
    return both.select("node", F.col("community").alias("parent"), name.alias("cluster"))


# --- group graph -------------------------------------------------------------------------------------------------


def paga(knn_table: DataFrame, cells: DataFrame, label: str, threshold: float = 0.05) -> DataFrame:
    """(a, b, w), a < b: observed over expected links between groups of the symmetrised neighbour graph.

    Weights are capped at 1 and set to 0 below ``threshold``.
    """
    links = knn_table.where("cell_id <> nbr_id").select(
        F.least("cell_id", "nbr_id").alias("src"), F.greatest("cell_id", "nbr_id").alias("dst")
    ).distinct()
    links = materialise(links)
    named = cells.select("cell_id", F.col(label).alias("g"))
    a = named.select(F.col("cell_id").alias("src"), F.col("g").alias("ga"))
    b = named.select(F.col("cell_id").alias("dst"), F.col("g").alias("gb"))
    between = lookup_join(lookup_join(links, a, ["src"], "inner"), b, ["dst"], "inner")
    pair = between.groupBy(F.least("ga", "gb").alias("a"), F.greatest("ga", "gb").alias("b")).agg(F.count(F.lit(1)).alias("m"))
    # every undirected link is two directed ones; both start in the group when it lies inside
    ends = F.explode(F.array("a", "b")).alias("g")
    strength = pair.select(ends, "m").groupBy("g").agg(F.sum("m").cast("double").alias("es"))
    sizes = named.groupBy("g").agg(F.count(F.lit(1)).cast("double").alias("size"))
    groups = sizes.join(strength, "g", "left").select("g", "size", F.coalesce("es", F.lit(0.0)).alias("es"))
    n = cells.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    side = lambda p: groups.select(F.col("g").alias(p), F.col("size").alias(f"n{p}"), F.col("es").alias(f"e{p}"))
    pair = lookup_join(lookup_join(pair.where("a <> b"), side("a"), ["a"], "inner"), side("b"), ["b"], "inner")
    expected = (F.col("ea") * F.col("nb") + F.col("eb") * F.col("na")) / (F.col("n") - 1)
    w = F.least(F.lit(1.0), F.when(expected != 0, 2.0 * F.col("m") / expected).otherwise(1.0))
    pair = pair.withColumn("n", n).withColumn("w", w)
    return pair.select("a", "b", F.when(F.col("w") < threshold, 0.0).otherwise(F.col("w")).alias("w"))


def group_segments(group_edges: DataFrame, groups: DataFrame) -> DataFrame:
    """Drawn lines (xi, yi, xf, yf, w) of the positive upper-triangle edges."""
    require(groups, "label", "x", "y")
    a = groups.select(F.col("label").alias("a"), F.col("x").alias("xi"), F.col("y").alias("yi"))
    b = groups.select(F.col("label").alias("b"), F.col("x").alias("xf"), F.col("y").alias("yf"))
    drawn = group_edges.where((F.col("a") <= F.col("b")) & (F.col("w") > 0))
    return lookup_join(lookup_join(drawn, a, ["a"], "inner"), b, ["b"], "inner").select("a", "b", "xi", "yi", "xf", "yf", "w")


# --- diffusion ----------------------------------------------------------------------------------------------------


def transition(edges: DataFrame) -> DataFrame:
    """(src, dst, t): density-normalised weights in symmetric form, both directions."""
    sym = materialise(symmetric(edges).withColumnRenamed("w", "v"))
    q = materialise(_rows_per(sym, "src", F.sum("v").alias("s")))
    hot = any_hot(q, "_rows")
    scaled = materialise(_divide(sym, q, lambda a, b: F.col("v") / (a * b), hot))
    z = materialise(_rows_per(scaled, "src", F.sum("v").alias("s")))
    return _divide(scaled, z, lambda a, b: F.col("v") / (F.sqrt(a) * F.sqrt(b)), hot).withColumnRenamed("v", "t")


def _divide(sym: DataFrame, per: DataFrame, value, hot: bool) -> DataFrame:
    a = per.select("src", F.col("s").alias("_a"), "_rows")
    b = per.select(F.col("src").alias("dst"), F.col("s").alias("_b"), "_rows")
    both = join_hot(join_hot(sym, a, ["src"], "_rows", hot=hot), b, ["dst"], "_rows", hot=hot)
    return both.select("src", "dst", value(F.col("_a"), F.col("_b")).alias("v"))


def spread(t: DataFrame, values: DataFrame, width: int, rows: DataFrame | None = None, hot: bool = True) -> DataFrame:
    """(node, y): the product of the symmetric matrix ``t`` with the block of columns ``values(node, v)``."""
    rows = rows if rows is not None else _rows_per(t, "dst")
    at = values.select(F.col("node").alias("dst"), "v")
    hit = t.join(at, "dst") if not hot else join_hot(t, at.join(rows, "dst"), ["dst"], "_rows")
    sums = hit.groupBy(F.col("src").alias("node")).agg(
        *[F.sum(F.col("t") * F.col("v")[i]).alias(f"_{i}") for i in range(width)]
    )
    return sums.select("node", F.array(*[f"_{i}" for i in range(width)]).alias("y"))


BLOCK_NODES = 1 << 14
"""Nodes of a block of vectors."""

SLAB_BYTES = 1 << 28
"""Bytes of vectors that a task meets with its tiles, and holds."""

ENTRIES_AT_ONCE = 1 << 17


def _in_tiles(t: DataFrame, nodes: DataFrame, hot: bool) -> tuple[DataFrame, DataFrame]:
    """The symmetric matrix ``t`` in tiles (p, s, size, at, of, t), and its nodes in blocks (p, ids, mat) that hold the columns ``v``.

    nodes: (node, v, _rows).  Blocks follow the order of nodes; a tile holds the entries between two blocks, in order of ``at``.  All
    tiles of a block p lie one after another."""
    import numpy as np
    import pyarrow as pa

    placed = materialise(global_position(nodes, ["node"], "_no").withColumn("_no", F.col("_no") - 1))
    n = placed.count()
    per = max(1, min(BLOCK_NODES, max(1024, -(-n // (2 * t.sparkSession.sparkContext.defaultParallelism)))))
    block = F.floor(F.col("_no") / per).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(np.asarray(table.column("_no")))))
        mat = np.asarray(table.column("v").combine_chunks().flatten()).astype(float)
        ids = table.column("node").combine_chunks()
        listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.table({"p": table.column("p").slice(0, 1), "ids": listed, "mat": pa.array([mat.tobytes()], pa.binary())})

    kind = nodes.schema["node"].dataType.simpleString()
    blocks = placed.select(block.alias("p"), "_no", "node", "v").groupBy("p").applyInArrow(pack, f"p int, ids array<{kind}>, mat binary")
    side = lambda end, no: placed.select(F.col("node").alias(end), F.col("_no").alias(no), "_rows")
    both = join_hot(join_hot(t, side("src", "_i"), ["src"], "_rows", hot=hot), side("dst", "_j"), ["dst"], "_rows", hot=hot)
    of = lambda no: F.floor(F.col(no) / per).cast("int")
    entries = both.select(of("_i").alias("p"), of("_j").alias("s"), (F.col("_i") % per).cast("int").alias("at"), (F.col("_j") % per).cast("int").alias("of"), "t")

    def tile(table: pa.Table) -> pa.Table:
        at, of, t = (np.asarray(table.column(c)) for c in ("at", "of", "t"))
        order = np.lexsort((of, at))
        p = table.column("p")[0].as_py()
        raw = [pa.array([np.ascontiguousarray(v[order]).tobytes()], pa.binary()) for v in (at.astype(np.int32), of.astype(np.int32), t.astype(float))]
        return pa.table([table.column("p").slice(0, 1), table.column("s").slice(0, 1), pa.array([min(per, n - p * per)], pa.int32()), *raw], names=["p", "s", "size", "at", "of", "t"])

    tiles = entries.groupBy("p", "s").applyInArrow(tile, "p int, s int, size int, at binary, of binary, t binary")
    tiles = tiles.repartition(max(1, -(-n // per)), "p").sortWithinPartitions("p", "s")
    return materialise(tiles), materialise(blocks)


def _times(tiles: DataFrame, blocks: DataFrame, width: int, slabs: int) -> DataFrame:
    """(p, mat): the product of the matrix with the ``width`` columns of ``blocks``.

    A task reads a slab of the vectors from where they are written and keeps the sums of one block of nodes at a time, so vectors are not
    shuffled, and partial sums only where there are several slabs."""
    side = blocks.select(F.col("p").alias("_s"), "mat").coalesce(slabs)
    met = tiles.join(side.hint("shuffle_replicate_nl"), F.col("s") == F.col("_s")).select("p", "size", "at", "of", "t", "mat")

    def multiply(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        home, total = None, None
        told = lambda: pa.record_batch([pa.array([home], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["p", "mat"])
        for batch in batches:
            read = lambda name, row, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)  # noqa: B023, E731
            for row, p in enumerate(batch.column("p").to_pylist()):
                if p != home:
                    if home is not None:
                        yield told()
                    home, total = p, np.zeros((batch.column("size")[row].as_py(), width))
                at, of, t = read("at", row, np.int32), read("of", row, np.int32), read("t", row, float)
                mat = read("mat", row, float).reshape(-1, width)
                for begin in range(0, len(at), ENTRIES_AT_ONCE):
                    some = slice(begin, begin + ENTRIES_AT_ONCE)
                    head = np.flatnonzero(np.r_[True, at[some][1:] != at[some][:-1]])
                    total[at[some][head]] += np.add.reduceat(t[some, None] * mat[of[some]], head)
        if home is not None:
            yield told()

    found = materialise(met.mapInArrow(multiply, "p int, mat binary"))
    if found.count() == blocks.count():
        return found
    return materialise(_side_by_side([(found, None)], width))  # parts of a block from several slabs, or a file read in pieces


def _side_by_side(tables: list[tuple[DataFrame, object]], width: int) -> DataFrame:
    """(p, mat): of every block the sum of its rows, each times the small matrix that goes with its table; None leaves it."""
    import numpy as np
    import pyarrow as pa

    small = [matrix for _, matrix in tables]

    def add(table: pa.Table) -> pa.Table:
        total = 0.0
        for i, raw in zip(table.column("_of").to_pylist(), table.column("mat")):
            mat = np.frombuffer(raw.as_buffer()).reshape(-1, width)
            total = total + (mat if small[i] is None else mat @ small[i])
        return pa.table({"p": table.column("p").slice(0, 1), "mat": pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())})

    rows = [df.select("p", F.lit(i).alias("_of"), "mat") for i, (df, _) in enumerate(tables)]
    return reduce(DataFrame.unionByName, rows).groupBy("p").applyInArrow(add, "p int, mat binary")


def _gram(tables: list[DataFrame], width: int):
    """Cross-products of the columns of all ``tables`` (p, mat) side by side, summed by Spark, as a numpy array."""
    import numpy as np
    import pyarrow as pa

    wide = width * len(tables)

    def partial(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("_of")))
        m = np.column_stack([np.frombuffer(table.column("mat")[int(i)].as_buffer()).reshape(-1, width) for i in order])
        return pa.table({"data": pa.array([(m.T @ m).tobytes()], pa.binary())})

    def add(batches: Iterator) -> Iterator:
        total = np.zeros(wide * wide)
        for batch in batches:
            for raw in batch.column("data"):
                total += np.frombuffer(raw.as_buffer())
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["data"])

    rows = [df.select("p", F.lit(i).alias("_of"), "mat") for i, df in enumerate(tables)]
    parts = reduce(DataFrame.unionByName, rows).groupBy("p").applyInArrow(partial, "data binary")
    few = parts.coalesce(parts.sparkSession.sparkContext.defaultParallelism).mapInArrow(add, "data binary")  # a square for each task
    out = sum(np.frombuffer(r[0]) for r in few.collect()).reshape(wide, wide)
    return (out + out.T) / 2


def _unpacked(blocks: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(node, v) from blocks."""
    kind = ids.schema["ids"].dataType.elementType.simpleString()

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                flat = np.frombuffer(batch.column("mat")[i].as_buffer())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), pa.array(flat))
                yield pa.record_batch([batch.column("ids")[i].values, lists], names=["node", "v"])

    return blocks.join(ids.select("p", "ids"), "p").select("ids", "mat").mapInArrow(rows, f"node {kind}, v array<double>")


def diffusion_map(edges: DataFrame, n: int = 20, steps: int = 5, restarts: int = 8, tolerance: float = 1e-4):
    """Top ``n`` eigenpairs of the transition matrix: (cell_id, vec) and (idx, eigenvalue).

    Block Krylov iteration: each step is one product of written tiles and blocks; the small projected problem is solved from
    cross-products that Spark sums.  Restarts from the best vectors until the residuals are below ``tolerance``.
    Signs: the largest component of a vector is positive.
    """
    import numpy as np

    spark = edges.sparkSession
    t = materialise(transition(edges))
    rows = materialise(_rows_per(t, "dst"))
    hot = any_hot(rows, "_rows")
    size = rows.count()
    n = min(n, size)
    m = min(n + 5, size)
    steps = max(1, min(steps, size // m))
    noise = [(F.xxhash64("node", F.lit(i)) / float(1 << 63)).alias(f"_{i}") for i in range(m)]
    nodes = rows.withColumnRenamed("dst", "node")
    tiles, blocks = _in_tiles(t, nodes.select("node", F.array(*noise).alias("v"), "_rows"), hot)
    slabs = max(1, -(-8 * size * m // SLAB_BYTES))
    start, values = blocks, None
    for _ in range(max(1, restarts)):
        # V, TV, ..., T^steps V
        chain = [start]
        for _ in range(steps):
            chain.append(_times(tiles, chain[-1], m, slabs))
        width = m * steps
        both = _gram(chain, m)
        # scale the columns before looking for directions
        size_of = np.sqrt(np.maximum(np.diag(both), 1e-300))
        g, h, yy = both[:width, :width], both[:width, m:], both[m:, m:]
        h = (h + h.T) / 2
        unit = 1 / size_of[:width]
        s, u = np.linalg.eigh(g * unit[:, None] * unit[None, :])
        keep = s > s.max() * 1e-11
        white = unit[:, None] * u[:, keep] / np.sqrt(s[keep])
        lam, vec = np.linalg.eigh(white.T @ h @ white)
        top = np.argsort(-lam)[:m]
        lam, vec = lam[top], white @ vec[:, top]
        resid = np.einsum("ij,ij->j", vec, yy @ vec) - 2 * lam * np.einsum("ij,ij->j", vec, h @ vec) + lam**2
        resid = np.sqrt(np.maximum(resid, 0))
        start = materialise(_side_by_side([(block, vec[i * m : (i + 1) * m]) for i, block in enumerate(chain[:-1])], m))
        values = lam
        if resid[:n].max() < tolerance or len(lam) < m:
            break
    width = len(values)
    vectors = materialise(_unpacked(start, blocks, width))
    ends = vectors.agg(*[F.max_by(F.col("v")[i], F.abs(F.col("v")[i])).alias(f"_{i}") for i in range(width)]).first()
    signed = F.array(*[F.col("v")[i] * (1.0 if ends[i] >= 0 else -1.0) for i in range(min(n, width))])
    emb = vectors.select(F.col("node").alias("cell_id"), signed.alias("vec"))
    table = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values[:n])], "idx int, eigenvalue double")
    return emb, table


def diffusion_pseudotime(emb: DataFrame, eigenvalues: DataFrame, cells: DataFrame, label: str, root: str) -> DataFrame:
    """(cell_id, pseudotime): distance from the first cell labelled ``root``, scaled to a maximum of 1.

    Component weights are l / (1 - l), and 1 for l of at least 0.9994.
    """
    first = cells.where(F.col(label) == root).agg(F.min("cell_id").alias("cell_id"))
    origin = emb.join(first, "cell_id", "left_semi").select("vec").scalar()
    lam = F.col("eigenvalue")
    weight = F.when(lam < 0.9994, lam / (1 - lam)).otherwise(1.0)
    listed = eigenvalues.select("idx", weight.alias("w")).agg(F.array_sort(F.collect_list(F.struct("idx", "w")))["w"].alias("l")).scalar()
    rows = emb.withColumns({"_o": origin, "_l": listed})
    steps = F.zip_with(F.zip_with("vec", "_o", lambda a, b: a - b), F.col("_l"), lambda d, w: d * w)
    dist = F.sqrt(F.aggregate(steps, F.lit(0.0), lambda a, s: a + s * s))
    rows = materialise(rows.select("cell_id", dist.alias("d")))
    return rows.select("cell_id", ratio(F.col("d"), rows.agg(F.max("d").alias("m")).scalar(), 0.0).alias("pseudotime"))
