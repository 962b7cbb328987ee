"""Quality of texts from trusted positives and unlabelled web text: positive-unlabelled learning.

A small network on counts of the text's form minimises the non-negative unbiased risk: with class prior p,
p * loss(positives, +) + max(0, loss(unlabelled, -) - p * loss(positives, -)), the last term kept from going below zero,
where it would only reward overfitting. The prior is the share of positives among the trusted labels that may be learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import small_batches, text_blocks
from .words import word_bounds, word_hashes

#: Rows that train the model: at most about this many positives, and as many unlabelled ones.
SAMPLE = 8192
HIDDEN = 24
EPOCHS = 60
BATCH = 512
#: Characters are sorted into these classes by their first byte; all other bytes have a class each by kind.
SIGNS = [" \t\r", "\n", ".", ",", ";:", "!?", "|", "#$%&*@^~=+<>\\/_", "\"'`", "()[]{}", "-", "0123456789"]
CLASSES = len(SIGNS) + 4  # and capital, small, first byte above ASCII, any other byte


def classes() -> np.ndarray:
    out = np.full(256, CLASSES - 1, np.uint8)
    for k, signs in enumerate(SIGNS):
        out[[ord(c) for c in signs]] = k
    out[65:91], out[97:123], out[192:] = len(SIGNS), len(SIGNS) + 1, len(SIGNS) + 2
    return out


CLASS = classes()
WIDTH = CLASSES * CLASSES + 10


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: shares of pairs of neighbouring character classes, and how words repeat."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    sizes = np.diff(offsets)
    of = np.repeat(np.arange(n), sizes)
    kind = CLASS[raw].astype(np.int64)
    inside = np.ones(len(raw), bool)
    inside[offsets[:-1][sizes > 0]] = False
    pair = np.flatnonzero(inside)
    count = np.bincount(of[pair] * CLASSES**2 + kind[pair - 1] * CLASSES + kind[pair], minlength=n * CLASSES**2).reshape(n, -1)
    out[:, : CLASSES**2] = np.sqrt(count / np.maximum(1, sizes - 1)[:, None])
    start, end, doc = word_bounds(raw, offsets)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(1, words)
    if len(start):
        h = word_hashes(raw, start, end)
        order = np.lexsort((h, doc))
        new = np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])]
        distinct = np.bincount(doc[order][new], minlength=n)
        first = np.flatnonzero(new)
        times = np.diff(np.r_[first, len(order)])
        most = np.zeros(n)
        np.maximum.at(most, doc[order][first], times)
        twice = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
        length = np.bincount(doc, end - start, minlength=n)
        long = np.bincount(doc, (end - start) ** 2, minlength=n)
        tail = out[:, CLASSES**2 :]
        tail[:, 0], tail[:, 1], tail[:, 2] = distinct / some, most / some, twice / some
        tail[:, 3], tail[:, 4] = length / some / 10, np.sqrt(np.maximum(0, long / some - (length / some) ** 2)) / 10
        tail[:, 5] = np.log1p(words) / 10
        tail[:, 6] = np.log1p(distinct) / np.maximum(1, np.log1p(words))
        tail[:, 7] = np.log1p(most) / 10
    out[:, -2] = np.log1p(sizes) / 10
    out[:, -1] = sizes == 0
    return out


def moments(*parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of all rows in double precision, without a second copy of them."""
    n = sum(map(len, parts))
    blocks = [x[i : i + BATCH] for x in parts for i in range(0, len(x), BATCH)]
    mean = sum(b.sum(0, dtype=np.float64) for b in blocks) / n
    return mean, np.sqrt(sum(((b - mean) ** 2).sum(0) for b in blocks) / n) + 0.02


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> dict[str, np.ndarray]:
    """The network's weights after EPOCHS passes of Adam over the non-negative risk. Rows are scaled, in double precision, a step at a time."""
    rng = np.random.default_rng(seed)
    p, u, width = positive, unlabelled, positive.shape[1]
    mean, scale = moments(p, u)
    w = {"a": rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), "b": np.zeros(HIDDEN), "c": rng.normal(0, 0.1, HIDDEN), "d": np.zeros(1)}
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    steps, step = max(1, -(-max(len(p), len(u)) // BATCH)), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(max(EPOCHS, 600 // steps)):
        order_p, order_u = rng.permutation(len(p)), rng.permutation(len(u))
        for i in range(steps):
            x = (np.concatenate([p[order_p[i::steps]], u[order_u[i::steps]]]) - mean) / scale
            k = len(order_p[i::steps])
            if k == 0 or k == len(x):
                continue
            hidden = np.tanh(x @ w["a"] + w["b"])
            s = sigmoid(hidden @ w["c"] + w["d"][0])
            minus = -np.log(np.maximum(1e-12, 1 - s))
            negative = minus[k:].mean() - prior * minus[:k].mean()
            g = np.zeros(len(x))
            if negative >= 0:
                g[:k] += prior * (s[:k] - 1) / k
                g[:k] -= prior * s[:k] / k
                g[k:] += s[k:] / (len(x) - k)
            else:  # step back: undo what pushed the estimate of the negatives' loss below zero
                g[:k] += prior * s[:k] / k
                g[k:] -= s[k:] / (len(x) - k)
            back = np.outer(g, w["c"]) * (1 - hidden**2)
            grad = {"a": x.T @ back + 1e-4 * w["a"], "b": back.sum(0), "c": hidden.T @ g + 1e-4 * w["c"], "d": np.array([g.sum()])}
            step += 1
            for name, value in grad.items():
                m1[name] = 0.9 * m1[name] + 0.1 * value
                m2[name] = 0.999 * m2[name] + 0.001 * value**2
                w[name] = w[name] - 0.005 * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.999**step)) + 1e-8)
    return w | {"mean": mean, "scale": scale}


def probability(model: dict[str, np.ndarray] | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.ones(len(x))
    hidden = np.tanh(((x - model["mean"]) / model["scale"]) @ model["a"] + model["b"])
    return 1 / (1 + np.exp(-np.clip(hidden @ model["c"] + model["d"][0], -30, 30)))


def held_out(id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, sample: int) -> dict[str, np.ndarray] | None:
    """Fit on a bounded sample: rows with the smallest hashes of their ids, ``sample`` trusted positives and as many without a label. Of rows of one id
    that with the least hash of its text is taken."""
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    row = known.agg(F.avg((F.col("label") == 1).cast("double")).alias("prior")).first()
    prior = row["prior"]
    if not prior:
        return None
    prior = min(prior, 0.98)
    ids = docs.select(F.col(id).alias("id")).filter("id IS NOT NULL").distinct()
    least = lambda df, flag: df.select("id", F.lit(flag).alias("positive")).orderBy(F.xxhash64("id"), "id").limit(sample)
    trusted = least(known.groupBy("id").agg(F.min("label").alias("label")).filter("label = 1").join(ids, "id", "left_semi"), True)
    unlabelled = least(ids.join(labels.select(F.col(id).alias("id")), "id", "left_anti"), False)
    picked = F.broadcast(trusted.union(unlabelled))  # at most 2 * sample ids

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in text_blocks(batches):
            x = features(raw, offsets)
            yield pa.record_batch([rows.column(0), rows.column(1), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), WIDTH).cast(pa.list_(pa.float32()))], names=["id", "positive", "x"])

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(picked, "id")
    rows = rows.groupBy("id", "positive").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one row an id, however often it is repeated
    got = rows.mapInArrow(describe, rows.select("id", "positive").schema.add("x", T.ArrayType(T.FloatType()))).toArrow()
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(-1, WIDTH)
    flag = np.asarray(got.column("positive"))
    order = np.lexsort((*x.T[:3], np.asarray(got.column("id").cast(pa.string())).astype(str)))
    del got
    flag = flag[order]
    return fit(x[order[flag]], x[order[~flag]], prior) if flag.any() and not flag.all() else None


def quality_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.7, sample: int = SAMPLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, held_out, score, predicted, kept columns) of every row; the score is the probability of label 1.

    Null text counts as empty; null ids are never learnt from; repeated rows are scored alike. Without a trusted positive, or without
    an unlabelled row, nothing can be learnt and every score is 1. An empty table gives an empty one. Inputs of a
    score come from the text alone. Columns beside the named ones are left out unless ``keep`` names them."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(train(docs, labels, id, text, label, sample))
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("__text"), F.col(id).alias("__id"), *keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, raw, offsets in text_blocks(batches, "__text"):
            s = probability(model.value, features(raw, offsets).astype(np.float64))
            yield pa.record_batch([*block.columns[1:], pa.array(s)], names=[*block.schema.names[1:], "score"])

    out = rows.mapInArrow(score, rows.drop("__text").schema.add("score", "double"))
    return out.select(F.col("__id").alias(id), held_out(F.col("__id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *keep)
