"""Removing repeated byte strings with a logarithmic family of suffix arrays.

Documents come in batches, in order of their ids. The sampled suffixes of a batch are sorted into an array and merge-scanned against the
arrays of the levels so far: an equal suffix of an older level, or an earlier one of the batch, settles all its windows;
where only the prefix is shared, both are examined window by window. Then the batch becomes a level of its own, and as long
as two levels have equal rank they merge into one of the next, so there are never more than logarithmically many. An array
is a set of rows, one for each range of prefix hashes, each holding its suffixes in sorted order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import repeats as R
from .anchors import PLACE_BITS, running, span_hashes
from .common import forget, saved, small_batches
from .words import VALUE

WIDTH = 100
#: Leading bytes by which sampled suffixes are sorted.
LEAD = 32
#: Batches into which a table is cut by its ids; with a fixed number the work stays in proportion to the table.
BATCHES = 4
#: Suffixes to examine with one prefix that one group may hold; more are examined one window each.
CROWDED = 1 << 16
OLD = 10


def merge_scan(new: DataFrame, levels: list[DataFrame], merge: int) -> DataFrame:
    """(kind, doc, tag, first, last, bucket, data): spans to remove, suffixes to examine, and as kind SUFFIX or HOT_PREFIX the
    array that the batch makes together with the last ``merge`` levels. Levels are older than the batch, so of equal
    suffixes the level's stays."""

    def scan(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        kinds = table.column("kind").to_pylist()
        ages = table.column("age").to_pylist()
        data = table.column("data").to_pylist()
        rows, hot, passing = R.group_of(table)
        rows, repeated, first = R.thin(rows, True, ("prefix", "whole"))
        newest = R.unpack([d for k, a, d in zip(kinds, ages, data) if k == R.SUFFIX and a == 0], R.ENTRY)
        known = np.unique(np.concatenate([newest["prefix"], *(np.frombuffer(d, "<u4") for k, a, d in zip(kinds, ages, data) if k == R.HOT_PREFIX and a == 0)]))
        look = R.examined(rows, repeated, first, hot) & np.isin(rows["prefix"], known)  # what the batch does not touch was examined before
        out = R.found_batch(passing, rows[repeated], rows[look])
        n = out.num_rows
        out = out.append_column("bucket", pa.nulls(n, pa.int32())).append_column("data", pa.nulls(n, pa.binary()))
        kept = R.unpack([d for k, a, d in zip(kinds, ages, data) if k == R.SUFFIX and a <= merge], R.ENTRY)
        kept, again, _ = R.thin(kept, True, ("prefix", "whole"))
        heat = np.unique(np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(d, "<u4") for k, a, d in zip(kinds, ages, data) if k == R.HOT_PREFIX and a <= merge)]))
        made = [(R.SUFFIX, R.pack(kept[~again])), *([(R.HOT_PREFIX, heat.tobytes())] if len(heat) else [])] if merge >= 0 else []
        level = pa.table({"kind": pa.array([k for k, _ in made], pa.int32()), **{c: pa.nulls(len(made), t) for c, t in (("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int64()), ("last", pa.int64()))}, "bucket": pa.array([bucket] * len(made), pa.int32()), "data": pa.array([d for _, d in made], pa.binary())})
        return pa.concat_tables([out, level])

    every = new.withColumn("age", F.lit(0))
    for age, level in enumerate(reversed(levels), 1):
        every = every.union(level.select("bucket", "kind", "data", F.lit(age)))
    return every.groupBy("bucket").applyInArrow(scan, R.FOUND + ", bucket int, data binary")


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper ids of all batches but the last, so that each has about the same bytes: the bytes of 4096 ranges of ids are added up."""
    low, high = docs.agg(F.min("key"), F.max(F.when(F.col("key") < R.NULL_ID, F.col("key")))).first()
    if low is None or high is None:
        return []
    step = max(1, -(-(high - low + 1) // 4096))
    at = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(step)), F.lit(4096)).cast("int")
    sizes = np.zeros(4097)
    for row in docs.groupBy(at.alias("at")).agg(F.sum(F.octet_length("text")).alias("n")).collect():
        sizes[row["at"]] = row["n"]
    share = np.cumsum(sizes) / max(1, sizes.sum())
    ends = {int(np.searchsorted(share, i / batches)) for i in range(1, batches)}
    return [low + (e + 1) * step - 1 for e in sorted(ends)]


def indexed(docs: DataFrame, width: int, batches: int) -> DataFrame:
    """(kind, doc, tag, first, last) found by taking the table in, batch after batch."""
    buckets = R.buckets_for(docs)
    uppers = batch_bounds(docs, batches)
    found: list[DataFrame] = []
    levels: list[tuple[int, DataFrame]] = []
    for i, (low, high) in enumerate(zip([None, *uppers], [*uppers, None])):
        some = docs if low is None else docs.filter(F.col("key") > low)
        some = some if high is None else some.filter(F.col("key") <= high)
        rank = merge = 0
        while merge < len(levels) and levels[-1 - merge][0] == rank:
            rank, merge = rank + 1, merge + 1
        last = high is None
        new = R.sampled(some, False, True, min(LEAD, width), width, buckets)
        out = saved(merge_scan(new, [t for _, t in levels], -1 if last else merge), f"batch{i}")
        found.append(out.filter(F.col("kind").isin(R.REMOVED, R.EXAMINE)).select("kind", "doc", "tag", "first", "last"))
        if not last:
            del levels[len(levels) - merge :]
            levels.append((rank, out.filter(F.col("kind").isin(R.SUFFIX, R.HOT_PREFIX)).select("bucket", "kind", "data")))
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    return every


def windows_to_examine(docs: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """(prefix, doc, tag, first, content): the bytes under each span, by the hash of its sampled prefix."""

    def cut(raw, offsets, firsts, lasts):
        sums = running(VALUE[raw])
        n = [len(f) for f in firsts]
        of = np.repeat(np.arange(len(n)), n)
        first = np.concatenate(firsts).astype(np.int64) if n else np.zeros(0, np.int64)
        last = np.concatenate(lasts).astype(np.int64) if n else np.zeros(0, np.int64)
        begin, end = first + offsets[of], last + offsets[of] + width
        values = VALUE[raw]
        return of, first, end - begin, raw, begin, prefix_of(values, sums, begin, end, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (of, first, size, raw, begin, prefix) in R.each_text(batches, cut):
            data = raw.tobytes()
            yield pa.record_batch(
                [pa.array(prefix), pa.array(np.asarray(block.column(1))[of], pa.int64()), pa.array(np.asarray(block.column(2))[of], pa.int64()), pa.array(first), pa.array([data[b : b + n] for b, n in zip(begin.tolist(), size.tolist())], pa.binary())],
                names=["prefix", "doc", "tag", "first", "content"],
            )

    return R.with_spans(docs, spans, True).mapInArrow(run, "prefix long, doc long, tag long, first long, content binary")


def prefix_of(values: np.ndarray, sums: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Hash of the sampled prefix that all windows of a span share, chosen in its first window as ``sample`` does."""
    lead = min(LEAD, width)
    out = np.zeros(len(begin), np.int64)
    for i in range(0, len(begin), 4096):
        at = begin[i : i + 4096, None] + np.arange(width - lead + 1)
        h = span_hashes(sums, at, at + lead)
        lowest = (h >> np.uint64(PLACE_BITS)).argmin(1)
        out[i : i + 4096] = h[np.arange(len(h)), lowest].view(np.int64)
    return out


def repeated_windows(contents: DataFrame, width: int) -> DataFrame:
    """Windows that start earlier too, from the sorted windows of each prefix. A prefix with more than CROWDED
    suffixes is taken apart: each of its windows goes by its own hash."""
    counts = contents.groupBy("prefix").count().filter(F.col("count") > CROWDED).select("prefix", F.lit(True).alias("crowded"))
    rows = contents.join(counts, "prefix", "left")
    single = rows.filter("crowded").select("doc", "tag", "content", "first", F.explode(F.sequence(F.lit(0), F.octet_length("content") - width)).alias("at"))
    window = F.substring("content", F.col("at") + 1, F.lit(width))
    single = single.select(F.xxhash64(window).alias("prefix"), "doc", "tag", (F.col("first") + F.col("at")).alias("first"), window.alias("content"))
    rows = rows.filter("crowded IS NULL").select("prefix", "doc", "tag", "first", "content").union(single.dropDuplicates(["prefix", "doc", "tag", "first"]))
    total = contents.count()
    groups = max(16, -(-total // 20_000))

    def scan(table: pa.Table) -> pa.Table:
        content = table.column("content").combine_chunks()
        raw, offsets = R_text(content)
        sums = running(VALUE[raw])
        sizes = np.diff(offsets)
        n = np.maximum(0, sizes - width + 1)
        of = np.repeat(np.arange(len(sizes)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        where = offsets[of] + at
        rows = np.empty(len(of), [("window", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("first", "<i8"), ("count", "<i8")])
        rows["window"] = span_hashes(sums, where, where + width)
        rows["doc"], rows["tag"] = np.asarray(table.column("doc"))[of], np.asarray(table.column("tag"))[of]
        rows["first"], rows["count"] = np.asarray(table.column("first"))[of] + at, 0
        rows, repeated, _ = R.thin(rows, True, ("window",))
        same = np.zeros(len(rows), bool)  # one place may be there twice
        if len(rows):
            same[1:] = np.all([rows[c][1:] == rows[c][:-1] for c in ("window", "doc", "tag", "first")], axis=0)
            start = np.flatnonzero(~np.r_[False, rows["window"][1:] == rows["window"][:-1]])
            head = start[np.cumsum(~np.r_[False, rows["window"][1:] == rows["window"][:-1]]) - 1]
            same |= np.all([rows[c] == rows[c][head] for c in ("doc", "tag", "first")], axis=0)
        gone = R.spans_of(rows[repeated & ~same])
        return pa.table({"doc": gone["doc"].astype(np.int64), "tag": gone["tag"].astype(np.int64), "first": gone["first"].astype(np.int64), "last": gone["last"].astype(np.int64)})

    return rows.withColumn("group", F.pmod("prefix", F.lit(groups))).groupBy("group").applyInArrow(scan, "doc long, tag long, first long, last long")


def R_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def without_repeated_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, batches: int = BATCHES, texts: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row: bytes covered by a string of ``width`` bytes that also
    starts earlier (smaller id, or the same document and an earlier start) are removed; strings are judged on the input.

    Null text is empty; a text shorter than a window keeps all. Null ids come last in the order; rows of one id are
    ordered by a hash of their text, and rows that are wholly equal are answered alike. Other columns are left out; an
    empty table gives an empty one. n_spans: maximal removed runs. kept: the bytes left, which may cut a character. Strings are
    compared by 64-bit hashes."""
    rows = R.keyed(docs, id, text)
    small_batches(docs.sparkSession)
    found = indexed(rows, width, batches)
    contents = saved(windows_to_examine(rows, found.filter(F.col("kind") == R.EXAMINE).distinct(), width), "contents")
    spans = saved(found.filter(F.col("kind") == R.REMOVED).select("doc", "tag", "first", "last").union(repeated_windows(contents, width)), "spans")
    forget(contents)

    def cut(raw, offsets, firsts, lasts):
        out = []
        for i, n in enumerate(np.diff(offsets).tolist()):
            own = raw[offsets[i] : offsets[i + 1]]
            gone = R.covered(n, firsts[i], lasts[i], width)
            left = own[~gone].tobytes()
            out.append((n, int(gone.sum()), int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1)), hashlib.sha256(left).hexdigest(), left))
        return out

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, out in R.each_text(batches, cut):
            n, gone, runs, digest, kept = zip(*out)
            columns = [block.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(digest)]
            yield pa.record_batch(columns + ([pa.array(kept, pa.binary())] if texts else []), names=kind.names)

    joined = R.with_spans(rows, spans, False)
    kind = joined.select("id").schema
    for name, of in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), *([("kept", "binary")] if texts else [])):
        kind = kind.add(name, of)
    return joined.mapInArrow(finish, kind).withColumnRenamed("id", id)
