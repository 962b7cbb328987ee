"""What the two removers of repeated passages share: sampled suffixes as packed rows, and the texts without the removed windows.

A sampled suffix is (prefix, whole, doc, tag, first, count): hash of its leading values, hash of all that its windows cover,
the document, the first window and how many follow. ``tag``, the 64-bit hash of the text where ids repeat, tells rows of one id apart, so
repeated rows and any number of repeated or null ids do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .anchors import sample
from .common import text_blocks
from .words import VALUE, word_bounds, word_hashes

NULL_ID = (1 << 63) - 1
#: Suffixes that a task sorts and thins out together before it hands them on.
HELD = 400_000
#: Different suffixes with one prefix in one task that make the prefix hot: its suffixes are all examined, without being brought together first.
HOT = 4096
#: Bytes of text whose suffixes one group holds.
GROUP_BYTES = 4 << 20
#: Cells of the filter that tells which documents may have something to be joined.
CELLS = 1 << 20

ENTRY = np.dtype([("prefix", "<u4"), ("whole", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("first", "<u4"), ("count", "<u2")])
SPAN = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("first", "<u4"), ("last", "<u4")])
PACKED = "bucket int, kind int, data binary"
REMOVED, EXAMINE, SUFFIX, HOT_PREFIX = 1, 2, 3, 4


def pack(rows: np.ndarray) -> bytes:
    """Column after column, which compresses better than row after row."""
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)


def unpack(data: list[bytes], kind: np.dtype) -> np.ndarray:
    parts = []
    for d in data:
        n, at = len(d) // kind.itemsize, 0
        rows = np.empty(n, kind)
        for name in kind.names:
            size = kind[name].itemsize * n
            rows[name] = np.frombuffer(d, kind[name], n, at)
            at += size
        parts.append(rows)
    return np.concatenate(parts) if parts else np.empty(0, kind)


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, tag, text): null ids take the last place of the order, null text is empty. Where no id repeats, only rows of
    null ids need tags and the others have 0, which packs to nothing."""
    value = F.coalesce(F.col(text), F.lit(""))
    repeats = docs.groupBy(F.col(id).alias("id")).count().filter("id IS NOT NULL AND count > 1").limit(1).count()
    tag = F.xxhash64(value) if repeats else F.when(F.col(id).isNull(), F.xxhash64(value)).otherwise(F.lit(0).cast("long"))
    return docs.select(F.col(id).alias("id"), F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID)).alias("key"), tag.alias("tag"), value.alias("text"))


def buckets_for(docs: DataFrame) -> int:
    """So many groups that each has about GROUP_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(16, -(-size // GROUP_BYTES))


def values_of(raw: np.ndarray, offsets: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Values (hashes of words, or of bytes), the text of each, the first value of each text, and the words' bounds."""
    if words:
        start, end, text = word_bounds(raw, offsets)
        return word_hashes(raw, start, end), text, np.searchsorted(text, np.arange(len(offsets) - 1)), (start, end)
    return VALUE[raw], np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), offsets[:-1], ()


def same_doc_counts(own: bool) -> tuple[str, ...]:
    """Order among suffixes of one content; own: an earlier place in the same document counts too."""
    return ("doc", "tag", "first") if own else ("doc",)


def thin(rows: np.ndarray, own: bool, key: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows sorted by key and place, which of them have an earlier equal, where a new key begins)."""
    rows = rows[np.lexsort([rows[n] for n in ("first", "tag", "doc", *reversed(key))])]
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = np.any([rows[n][1:] != rows[n][:-1] for n in key], axis=0)
    if own:
        return rows, ~new, new
    least = rows["doc"][new][np.cumsum(new) - 1]
    return rows, rows["doc"] > least, new


def spans_of(rows: np.ndarray) -> np.ndarray:
    """Windows first to last of suffixes, neighbours joined."""
    rows = rows[np.lexsort([rows["first"], rows["tag"], rows["doc"]])]
    last = rows["first"].astype(np.int64) + rows["count"]
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = (rows["doc"][1:] != rows["doc"][:-1]) | (rows["tag"][1:] != rows["tag"][:-1]) | (rows["first"][1:] > last[:-1] + 1)
    at = np.flatnonzero(new)
    out = np.empty(len(at), SPAN)
    for name in ("doc", "tag", "first"):
        out[name] = rows[name][at]
    out["last"] = np.maximum.reduceat(last, at) if len(at) else 0
    return out


def sampled(docs: DataFrame, words: bool, own: bool, k: int, width: int, buckets: int) -> DataFrame:
    """Packed rows (bucket, kind, data). Suffixes travel by the hash of their leading values. Where one task has the same content
    more than once only the earliest goes on, and the others are spans to remove already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        places: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            rows, where = np.concatenate(held), np.concatenate(places)
            full = np.empty(len(rows), [("bucket", "<i4"), *ENTRY.descr])
            full["bucket"] = where
            for name in ENTRY.names:
                full[name] = rows[name]
            full, repeated, new = thin(full, own, ("bucket", "prefix", "whole"))
            kinds = [(REMOVED, s) for s in chunks(pack_spans(full[repeated]))]
            at = np.flatnonzero(new)
            head = np.ones(len(at), bool)
            head[1:] = (full["bucket"][at][1:] != full["bucket"][at][:-1]) | (full["prefix"][at][1:] != full["prefix"][at][:-1])
            group = np.cumsum(head) - 1
            hot = (np.bincount(group) > HOT)[group][np.cumsum(new) - 1] if len(at) else np.zeros(0, bool)
            out_bucket, out_kind, out_data = [], [], []
            kinds += [(EXAMINE, s) for s in chunks(entries(full[hot & ~repeated]))]
            for i, (kind, data) in enumerate(kinds):
                out_bucket.append(i % buckets), out_kind.append(kind), out_data.append(data)
            marks = full[hot & new]
            for b in np.unique(marks["bucket"]).tolist():
                out_bucket.append(b), out_kind.append(HOT_PREFIX), out_data.append(np.unique(marks["prefix"][marks["bucket"] == b]).astype("<u4").tobytes())
            left = full[~hot & ~repeated]
            cuts = np.flatnonzero(np.r_[True, left["bucket"][1:] != left["bucket"][:-1]]) if len(left) else np.zeros(0, int)
            for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(left)]):
                out_bucket.append(int(left["bucket"][b])), out_kind.append(SUFFIX), out_data.append(pack(left[b:e][list(ENTRY.names)]))
            held.clear(), places.clear()
            return pa.record_batch([pa.array(out_bucket, pa.int32()), pa.array(out_kind, pa.int32()), pa.array(out_data, pa.binary())], names=["bucket", "kind", "data"])

        def chunks(rows: np.ndarray) -> Iterator[bytes]:
            for i in range(0, len(rows), 1 << 16):
                yield pack(rows[i : i + (1 << 16)])

        for block, raw, offsets in text_blocks(batches):
            values, text, begin, _ = values_of(raw, offsets, words)
            prefix, whole, first, last = sample(values, text, k, width)
            rows = np.empty(len(prefix), ENTRY)
            of = text[first] if len(first) else np.zeros(0, int)
            rows["prefix"], rows["whole"] = prefix >> np.uint64(32), whole
            rows["doc"], rows["tag"] = np.asarray(block.column(0))[of], np.asarray(block.column(1))[of]
            rows["first"], rows["count"] = first - begin[of], last - first
            held.append(rows), places.append((prefix % np.uint64(buckets)).astype(np.int32))
            if sum(map(len, held)) >= HELD:
                yield emit()
        if held:
            yield emit()

    return docs.select("key", "tag", "text").mapInArrow(run, PACKED)


def entries(rows: np.ndarray) -> np.ndarray:
    return rows[list(ENTRY.names)].astype(ENTRY)


def pack_spans(rows: np.ndarray) -> np.ndarray:
    return spans_of(rows)


def group_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, bytes]]]:
    """(suffixes, which are new, hot prefixes, rows that only pass through) of one bucket's packed rows."""
    kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
    suffixes = unpack([d for k, d in zip(kinds, data) if k == SUFFIX], ENTRY)
    hot = np.unique(np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(d, "<u4") for k, d in zip(kinds, data) if k == HOT_PREFIX)]))
    return suffixes, hot, [(k, d) for k, d in zip(kinds, data) if k in (REMOVED, EXAMINE)]


def examined(rows: np.ndarray, repeated: np.ndarray, new: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which suffixes that have no earlier equal share their prefix with a different one, so that some of their windows may repeat."""
    head = np.ones(len(rows), bool)
    if len(rows):
        head[1:] = rows["prefix"][1:] != rows["prefix"][:-1]
    group = np.cumsum(head) - 1
    several = np.bincount(group, new) > 1
    return ~repeated & (several[group] | np.isin(rows["prefix"], hot))


def found_batch(passing: list[tuple[int, bytes]], removed: np.ndarray, examine: np.ndarray) -> pa.Table:
    """(kind, doc, tag, first, last) rows of a group."""
    spans = [(REMOVED, unpack([d for k, d in passing if k == REMOVED], SPAN)), (REMOVED, spans_of(removed))]
    for rows in (unpack([d for k, d in passing if k == EXAMINE], ENTRY), examine):
        some = np.empty(len(rows), SPAN)
        for name in ("doc", "tag", "first"):
            some[name] = rows[name]
        some["last"] = rows["first"].astype(np.int64) + rows["count"]
        spans.append((EXAMINE, some))
    every = np.concatenate([s for _, s in spans])
    kind = np.concatenate([np.full(len(s), k, np.int32) for k, s in spans])
    return pa.table({"kind": kind, **{n: every[n].astype(t) for n, t in (("doc", np.int64), ("tag", np.int64), ("first", np.int64), ("last", np.int64))}})


FOUND = "kind int, doc long, tag long, first long, last long"


def per_document(spans: DataFrame) -> DataFrame:
    """(key, tag, firsts, lasts): a document's spans as arrays."""
    got = spans.groupBy(F.col("doc").alias("key"), "tag").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    return got.select("key", "tag", F.col("spans.first").alias("firsts"), F.col("spans.last").alias("lasts"))


def parted(docs: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that may have spans, those that surely have none). The filter has CELLS bits whatever the size, so texts without
    spans are not shuffled; where most documents have some it passes nearly all."""
    cell = lambda key: F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int")
    bits = np.zeros(CELLS, bool)
    bits[np.asarray(spans.select(cell("doc").alias("cell")).distinct().toArrow().column("cell"))] = True
    table = F.lit(bytearray(np.packbits(bits, bitorder="little").tobytes()))
    place = cell("key")
    byte = F.conv(F.hex(F.substring(table, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    return docs.filter(marked), docs.filter(~marked)


def with_spans(docs: DataFrame, spans: DataFrame, only: bool) -> DataFrame:
    """(id, key, tag, text, firsts, lasts); only: leave out documents without spans."""
    some, none = parted(docs, spans)
    joined = some.join(per_document(spans), ["key", "tag"], "inner" if only else "left").select("id", "key", "tag", "text", "firsts", "lasts")
    empty = F.lit(None).cast("array<bigint>")
    return joined if only else joined.unionByName(none.select("id", "key", "tag", "text", empty.alias("firsts"), empty.alias("lasts")))


def covered(n: int, firsts: np.ndarray, lasts: np.ndarray, width: int) -> np.ndarray:
    """Which of n values some window covers."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, np.minimum(lasts + width, n), -1)
    return np.cumsum(change[:-1]) > 0


def each_text(batches: Iterator[pa.RecordBatch], use: Callable) -> Iterator[list]:
    """use(raw, offsets, firsts, lasts) for blocks of joined rows, spans as one array per row."""
    for block, raw, offsets in text_blocks(batches):
        lists = lambda name: [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in block.column(block.schema.get_field_index(name)).to_pylist()]
        yield block, use(raw, offsets, lists("firsts"), lists("lasts"))
