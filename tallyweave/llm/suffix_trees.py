"""Removing repeated runs of words with prefix-partitioned suffix trees.

Sampled suffixes are first parted by their leading words; those whose prefix occurs with one content only are leaves of
their own, equal ones are one leaf. Where a prefix branches, every suffix of the branch goes into a tree: the
trees are parted by prefixes of variable length, as many leading words as it takes to make a group fit into memory, and
each group builds its subtree by sorting. An inner node as deep as a window is a maximal repeat: all its leaves but those of its
smallest document are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import repeats as R
from .anchors import running, span_hashes
from .common import saved, small_batches

WIDTH = 13
#: Leading words by which sampled suffixes are parted.
LEAD = 5
#: Suffixes that a subtree may have in memory, and the cells into which prefixes of one length are counted.
SUBTREE = 200_000
CELLS = 4096


def branches(docs: DataFrame, width: int) -> DataFrame:
    """Spans to remove, and suffixes to examine, from the packed sampled suffixes."""

    def group(table: pa.Table) -> pa.Table:
        rows, hot, passing = R.group_of(table)
        rows, repeated, new = R.thin(rows, False, ("prefix", "whole"))
        return R.found_batch(passing, rows[repeated], rows[R.examined(rows, repeated, new, hot)])

    packed = R.sampled(docs, True, False, min(LEAD, width), width, R.buckets_for(docs))
    return packed.groupBy("bucket").applyInArrow(group, R.FOUND)


def paths(docs: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """(short, middle, deep, doc, tag, first): the windows of the spans, as hashes of their leading words at three depths. In a task only
    the smallest document of a window goes on; the others come out with ``deep`` null, to be removed."""
    depths = [max(1, width // 3), max(1, 2 * width // 3), width]

    def cut(raw, offsets, firsts, lasts):
        values, text, begin, _ = R.values_of(raw, offsets, True)
        sums = running(values)
        at = [np.concatenate([np.arange(f, e + 1) for f, e in zip(firsts[i], lasts[i])]) + begin[i] for i in range(len(firsts))]
        of = np.repeat(np.arange(len(at)), [len(a) for a in at])
        at = np.concatenate(at).astype(np.int64)
        return of, at - begin[of], [span_hashes(sums, at, at + d).view(np.int64) for d in depths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([("short", "<i8"), ("middle", "<i8"), ("deep", "<i8"), ("doc", "<i8"), ("tag", "<i8"), ("first", "<i8")])
        held: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            rows, repeated, _ = R.thin(np.concatenate(held), False, ("deep",))
            held.clear()
            arrays = [pa.array(rows[n]) for n in ("short", "middle")] + [pa.array(rows["deep"], mask=repeated)] + [pa.array(rows[n]) for n in ("doc", "tag", "first")]
            return pa.record_batch(arrays, names=list(kind.names))

        for block, (of, first, hashes) in R.each_text(batches, cut):
            rows = np.empty(len(of), kind)
            for name, h in zip(("short", "middle", "deep"), hashes):
                rows[name] = h
            rows["doc"], rows["tag"], rows["first"] = np.asarray(block.column(1))[of], np.asarray(block.column(2))[of], first
            held.append(rows)
            if sum(map(len, held)) >= R.HELD:
                yield emit()
        if held:
            yield emit()

    joined = R.with_spans(docs, spans, True)
    return joined.mapInArrow(run, "short long, middle long, deep long, doc long, tag long, first long")


def parted_by_prefix(suffixes: DataFrame, most: int) -> DataFrame:
    """Add the group of each suffix: the cell of its short prefix, or of its middle one where that cell has more than ``most``
    suffixes, or of the whole window. Counts of cells decide; the lists of crowded cells are at most suffixes / most long,
    and are joined."""
    cell = lambda c: F.pmod(F.col(c), F.lit(CELLS))
    rows = suffixes.withColumns({"a": cell("short"), "b": F.lit(-1).cast("long"), "c": F.lit(-1).cast("long")})
    for finer, by in (("b", "middle"), ("c", "deep")):
        keys = ["a", "b"] if finer == "c" else ["a"]
        crowded = rows.groupBy(*keys).count().filter(F.col("count") > most).select(*keys, F.lit(True).alias("crowded"))
        rows = rows.join(crowded, keys, "left").withColumn(finer, F.when(F.col("crowded"), cell(by)).otherwise(F.col(finer))).drop("crowded")
    return rows


def deep_nodes(suffixes: DataFrame, most: int = SUBTREE) -> DataFrame:
    """Windows below a deep inner node, but those of its smallest document."""

    def subtree(table: pa.Table) -> pa.Table:
        names = ("short", "middle", "deep", "doc", "tag", "first")
        rows = np.empty(table.num_rows, [(n, "<i8") for n in names])
        for n in names:
            rows[n] = np.asarray(table.column(n))
        rows, repeated, _ = R.thin(rows, False, ("short", "middle", "deep"))
        gone = rows[repeated]
        return pa.table({"doc": gone["doc"], "tag": gone["tag"], "first": gone["first"], "last": gone["first"]})

    return parted_by_prefix(suffixes, most).groupBy("a", "b", "c").applyInArrow(subtree, "doc long, tag long, first long, last long")


def without_repeated_words(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, texts: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, kept]) of every row: words covered by a window of ``width`` words that also
    starts in a document with a smaller id are removed; windows are judged on the input.

    Null text has no words; a text shorter than a window keeps all. Null ids come last in the order. Rows of one id never
    remove from each other, repeated rows are answered alike, and other columns are left out. An empty table gives an
    empty one. kept: the words left, joined by one space. Words are compared by 64-bit hashes."""
    rows = R.keyed(docs, id, text)
    small_batches(docs.sparkSession)
    found = saved(branches(rows, width), "branches")
    examine = found.filter(F.col("kind") == R.EXAMINE).select("doc", "tag", "first", "last")
    suffixes = saved(paths(rows, examine, width), "paths")
    own = suffixes.filter("deep IS NULL").select("doc", "tag", "first", F.col("first").alias("last"))
    deep = deep_nodes(suffixes.filter("deep IS NOT NULL"))
    spans = found.filter(F.col("kind") == R.REMOVED).select("doc", "tag", "first", "last").union(own).union(deep)
    spans = saved(spans, "spans")

    def cut(raw, offsets, firsts, lasts):
        _, text_of, begin, (start, end) = R.values_of(raw, offsets, True)
        sizes = np.bincount(text_of, minlength=len(firsts)) if len(text_of) else np.zeros(len(firsts), np.int64)
        data, out = raw.tobytes(), []
        for i, n in enumerate(sizes.tolist()):
            gone = R.covered(n, firsts[i], lasts[i], width)
            left = np.flatnonzero(~gone) + begin[i]
            whole = b" ".join([data[b:e] for b, e in zip(start[left].tolist(), end[left].tolist())])
            out.append((n, n - len(left), hashlib.sha256(whole).hexdigest(), whole))
        return out

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, out in R.each_text(batches, cut):
            n, gone, digest, kept = zip(*out)
            columns = [block.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest)]
            yield pa.record_batch(columns + ([pa.array([k.decode() for k in kept])] if texts else []), names=kind.names)

    joined = R.with_spans(rows, spans, False)
    kind = joined.select("id").schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    if texts:
        kind = kind.add("kept", "string")
    return joined.mapInArrow(finish, kind).withColumnRenamed("id", id)
