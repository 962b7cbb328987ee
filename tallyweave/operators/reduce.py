"""Linear and two-dimensional reductions, and batch mixing in the reduced space."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import sparse
from .scale import materialise


def _of_vectors(vecs: DataFrame, k: int | None, share: float | None) -> tuple[DataFrame, DataFrame]:
    rows, widths = sparse.from_dense(vecs)
    scores, loadings = sparse.components(rows, widths, k, share)
    return scores.select("cell_id", "vec"), loadings.select("component", "share", "loading", "eigenvalue")


def pca(vecs: DataFrame | sparse.Scaled, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """Scores (cell_id, vec) and loadings (component, share, loading, eigenvalue) of centred vectors or scaled cells.

    The largest entry of each loading is positive.  Nothing sized by cells leaves the executors."""
    if isinstance(vecs, sparse.Scaled):
        scores, loadings = sparse.pca(vecs, k)
        return scores.select("cell_id", "vec"), loadings.select("component", "share", "loading", "eigenvalue")
    return _of_vectors(vecs, k, None)


def pca_variance(vecs: DataFrame | sparse.Scaled, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The fewest components that explain ``share`` of the variance."""
    if isinstance(vecs, sparse.Scaled):
        scores, loadings = sparse.pca(vecs, share=share)
        return scores.select("cell_id", "vec"), loadings.select("component", "share", "loading", "eigenvalue")
    return _of_vectors(vecs, None, share)


MAX_BATCHES = 1000


def harmony(
    emb: DataFrame, cells: DataFrame, batch: str, theta: float = 3.0, clusters: int | None = None, rounds: int = 10,
    sigma: float = 0.1, ridge: float = 1.0, inner: int = 5,
) -> DataFrame:
    """(cell_id, vec): embedding with batch effects removed inside soft clusters.

    Each pass over the cells is a map that needs only the centroids, the cluster-by-batch tallies and the
    corrections, and returns sums of that size, which Spark adds up.  Those tables are clusters x batches x
    width; the number of batches is checked.
    """
    import numpy as np

    joined = emb.join(cells.select("cell_id", F.col(batch).alias("batch")), "cell_id")
    names = [r[0] for r in joined.select("batch").distinct().orderBy("batch").limit(MAX_BATCHES + 1).collect()]
    if len(names) > MAX_BATCHES:
        raise ValueError(f"more than {MAX_BATCHES} batches")
    spark = emb.sparkSession
    index = spark.createDataFrame([(n, i) for i, n in enumerate(names)], ["batch", "b"])
    kind = joined.schema["batch"].dataType
    index = index.withColumn("batch", F.col("batch").cast(kind)).withColumn("b", F.col("b").cast("int"))
    rows = materialise(joined.join(F.broadcast(index), "batch").select("cell_id", "vec", "b"))  # <= MAX_BATCHES rows
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    k = clusters or max(1, min(100, n // 30))
    nb = len(names)
    share = np.zeros(nb)
    for b, c in rows.groupBy("b").agg(F.count(F.lit(1))).collect():
        share[b] = c / n
    seeds = rows.orderBy(F.md5(F.col("cell_id").cast("string")), "cell_id").limit(k).collect()  # k rows
    k = len(seeds)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    centres = unit(np.array([r["vec"] for r in seeds], dtype=float))
    shift = np.zeros((k, nb, dim))
    observed = None

    def responsible(z, b, centres, observed):
        import numpy as np

        z = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        score = -2 * (1 - z @ centres.T) / sigma
        if observed is not None:
            expected = observed.sum(1, keepdims=True) * share[None, :]
            score = score + theta * np.log((expected + 1) / (observed + 1)).T[b]
        score = np.exp(score - score.max(1, keepdims=True))
        return z, score / score.sum(1, keepdims=True)

    def totals(table: DataFrame, centres, observed, raw: bool):
        """Sums over cells: responsibilities per cluster and batch, and weighted vectors per cluster and batch."""

        def partial(frames):
            import numpy as np
            import pandas as pd

            o, s = np.zeros((k, nb)), np.zeros((k, nb, dim))
            for pdf in frames:
                if not len(pdf):
                    continue
                z = np.stack(pdf["fixed"].to_numpy())
                b = pdf["b"].to_numpy()
                cos, resp = responsible(z, b, centres, observed)
                base = np.stack(pdf["vec"].to_numpy()) if raw else cos
                for at in np.unique(b):
                    mine = b == at
                    o[:, at] += resp[mine].sum(0)
                    s[:, at] += resp[mine].T @ base[mine]
            yield pd.DataFrame({
                "k": np.repeat(np.arange(k), nb), "b": np.tile(np.arange(nb), k),
                "v": list(np.concatenate([o[..., None], s], axis=2).reshape(k * nb, dim + 1)),
            })

        parts = table.mapInPandas(partial, "k int, b int, v array<double>").select("k", "b", F.posexplode("v").alias("j", "x"))
        out = np.zeros((k, nb, dim + 1))
        for i, b, j, x in parts.groupBy("k", "b", "j").agg(F.sum("x")).collect():  # k x batches x width
            out[i, b, j] = x
        return out[..., 0], out[..., 1:]

    table = rows.withColumn("fixed", F.col("vec"))
    id_kind = rows.schema["cell_id"].dataType.simpleString()
    for _ in range(rounds):
        for _ in range(inner):
            observed, sums = totals(table, centres, observed, raw=False)
            moved = unit(sums.sum(1))
            settled = np.abs(moved - centres).max() < 1e-3
            centres = moved
            if settled:
                break
        observed, _ = totals(table, centres, observed, raw=False)
        weights, sums = totals(table, centres, observed, raw=True)
        for c in range(k):
            # ridge regression of the vectors on intercept and batch, weighted by the cluster
            design = np.zeros((nb + 1, nb + 1))
            design[0, 0] = weights[c].sum()
            design[0, 1:] = design[1:, 0] = weights[c]
            design[1:, 1:] = np.diag(weights[c] + ridge)
            target = np.vstack([sums[c].sum(0), sums[c]])
            shift[c] = np.linalg.lstsq(design, target, rcond=None)[0][1:]
        now = (centres.copy(), observed.copy(), shift.copy())

        def correct(frames, now=now):
            import numpy as np

            centres, observed, shift = now
            for pdf in frames:
                if not len(pdf):
                    continue
                b = pdf["b"].to_numpy()
                _, resp = responsible(np.stack(pdf["fixed"].to_numpy()), b, centres, observed)
                vec = np.stack(pdf["vec"].to_numpy())
                fixed = vec - np.einsum("nk,nkd->nd", resp, shift.transpose(1, 0, 2)[b])
                yield pdf[["cell_id", "vec", "b"]].assign(fixed=list(fixed))

        before = table
        table = materialise(before.mapInPandas(correct, f"cell_id {id_kind}, vec array<double>, b int, fixed array<double>"))
        moved = F.aggregate(F.zip_with("fixed", "was", lambda a, c: a - c), F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
        change = table.join(before.select("cell_id", F.col("fixed").alias("was")), "cell_id").agg(F.max(moved)).first()[0]
        if change < 1e-3:
            break
    return table.select("cell_id", F.col("fixed").alias("vec"))
