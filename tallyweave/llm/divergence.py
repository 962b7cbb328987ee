"""How far the sources of a language differ in their terms, with texts factorized into whitespace chunks.

Tasks count the chunks of each document and add the counts up by (language, source); only distinct chunks travel. A chunk's entries from
all tasks meet in one group, where the chunk is tokenized once and its terms are joined back to its entries. Documents of a term are told
apart without their list: each document lies in one task, so a chunk's documents add up, and where there are fewer than ``FEW`` of them
their least and greatest number name them all.

Distances need every kept term in every source, most of them not there. Sources are dealt into tiles and terms into blocks; a group holds two
tiles in one block and adds up the terms that are in neither from their number alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import repeats as R
from .collocations import cuts_of, ragged
from .common import saved, small_batches, text_blocks
from .words import mixed, word_bounds, word_hashes

#: Documents that a kept term needs at least. Two numbers name up to two documents, so the rule cannot ask for more.
FEW = 3
#: Runs of letters A-Z, a-z and of everything beyond ASCII, in UTF-8.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Chunks that a task counts together.
HELD = 1_000_000
#: Sources in a tile and kept terms in a block.
TILE, TERMS = 128, 2048
SCALE = 1_000_000_000
CHUNKS = "bucket int, data binary"
COUNTS = "kind int, gid long, lid long, term string, n long, low long, high long"
OCCURRENCES, DOCUMENTS = 0, 1


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of known kinds one after the other, their lengths first."""
    return b"".join([np.array([len(a) for a in arrays], "<u4").tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpacked(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    at, out = 4 * len(kinds), []
    for n, kind in zip(np.frombuffer(data, "<u4", len(kinds)).tolist(), kinds):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


#: Groups of a row; then per (language, chunk): language, chunk, documents, least and greatest of them, sources, bytes; then per source: group, count; then the bytes.
KINDS = ("<i8", "<i8", "<u8", "<u4", "<i8", "<i8", "<u4", "<u4", "<u4", "<u4", "u1")


class Held:
    """Chunk counts of one task since it last handed them on."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.blocks: list[tuple[np.ndarray, ...]] = []
        self.known: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def take(self, raw: np.ndarray, offsets: np.ndarray, number: np.ndarray, gid: np.ndarray, lid: np.ndarray) -> None:
        start, end, text = word_bounds(raw, offsets)
        if not len(start):
            return
        ids, place = np.unique(word_hashes(raw, start, end), return_inverse=True)
        at = np.zeros(len(ids), np.int64)
        at[place] = np.arange(len(place))
        size = (end - start)[at]
        self.known.append((ids, size, ragged(raw, start[at], size)))
        pairs, times = np.unique(text * len(ids) + place, return_counts=True)  # chunks of each document
        of, chunk = pairs // len(ids), ids[pairs % len(ids)]
        self.blocks.append((lid[of], chunk, gid[of], number[of], times))
        self.n += len(pairs)

    def counts(self) -> pa.RecordBatch:
        lid, chunk, gid, number, times = (np.concatenate(c) for c in zip(*self.blocks))
        ids, size, data = (np.concatenate(c) for c in zip(*self.known))
        begin = np.cumsum(size) - size
        known, at = np.unique(ids, return_index=True)
        bucket = (mixed(chunk) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((gid, chunk, lid, bucket))
        bucket, lid, chunk, gid, number, times = (c[order] for c in (bucket, lid, chunk, gid, number, times))
        outer, inner = cuts_of(lid, chunk), cuts_of(lid, chunk, gid)
        docs = np.diff(np.r_[outer, len(lid)])
        low, high = np.minimum.reduceat(number, outer), np.maximum.reduceat(number, outer)
        low, high = np.where(docs < FEW, low, 0), np.where(docs < FEW, high, 0)
        n = np.add.reduceat(times, inner)
        width = np.diff(np.r_[np.searchsorted(inner, outer), len(inner)])
        first = np.cumsum(width) - width
        where = at[np.searchsorted(known, chunk[outer])]
        rows: list[tuple[int, bytes]] = []
        cuts = cuts_of(bucket[outer])
        for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(outer)]):
            some = slice(b, e)
            entries = slice(first[b], first[e - 1] + width[e - 1])
            groups, code = np.unique(gid[inner[entries]], return_inverse=True)
            bytes_of = size[where[some]]
            rows.append((int(bucket[outer[b]]), packed([
                groups, lid[outer[some]], chunk[outer[some]], docs[some].astype("<u4"), low[some], high[some], width[some].astype("<u4"), bytes_of.astype("<u4"),
                code.astype("<u4"), n[entries].astype("<u4"), ragged(data, begin[where[some]], bytes_of),
            ])))
        self.clear()
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "data"])


def tokenized(packs: list[bytes]) -> pa.Table:
    """Term counts of one group of chunks: each distinct chunk is tokenized once, its terms join its entries."""
    parts = [unpacked(d, KINDS) for d in packs]
    lid, chunk, docs, low, high, width, size = (np.concatenate([p[k] for p in parts]) for k in range(1, 8))
    n = np.concatenate([p[9] for p in parts]).astype(np.int64)
    gid = np.concatenate([p[0][p[8]] for p in parts])
    raw, size = np.concatenate([p[10] for p in parts]), size.astype(np.int64)
    begin = np.cumsum(size) - size
    ids, at, place = np.unique(chunk, return_index=True, return_inverse=True)
    # terms of the distinct chunks: (chunk, term) with how often
    names: dict[bytes, int] = {}
    of, term = [], []
    data = raw.tobytes()
    for i, (b, s) in enumerate(zip(begin[at].tolist(), size[at].tolist())):
        for t in TERM.findall(data[b : b + s]):
            of.append(i)
            term.append(names.setdefault(t.lower(), len(names)))  # bytes lower A-Z alone
    spread, times = np.unique(np.array(of, np.int64) * max(1, len(names)) + np.array(term, np.int64), return_counts=True)
    of, term = spread // max(1, len(names)), spread % max(1, len(names))
    terms_of = np.bincount(of, minlength=len(ids))
    from_ = np.cumsum(terms_of) - terms_of

    def joined(entry_chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, row of the chunk-term table) for every term of every entry's chunk."""
        many = terms_of[entry_chunk]
        entry = np.repeat(np.arange(len(entry_chunk)), many)
        return entry, np.repeat(from_[entry_chunk] - (np.cumsum(many) - many), many) + np.arange(many.sum())

    outer = np.repeat(np.arange(len(lid)), width)
    entry, row = joined(place[outer])
    g, t, c = gid[entry], term[row], n[entry] * times[row]
    order = np.lexsort((t, g))
    cuts = cuts_of(g[order], t[order])
    total = np.add.reduceat(c[order], cuts) if len(cuts) else np.zeros(0, np.int64)
    head = order[cuts]
    # documents of a chunk add up over tasks
    order = np.lexsort((place, lid))
    cuts = cuts_of(lid[order], place[order])
    docs = np.add.reduceat(docs[order].astype(np.int64), cuts)
    low, high = np.minimum.reduceat(low[order], cuts), np.maximum.reduceat(high[order], cuts)
    own = order[cuts]
    entry2, row2 = joined(place[own])
    few = docs[entry2] < FEW
    l2, t2, d2 = lid[own[entry2]], term[row2], docs[entry2]
    low2, high2 = np.where(few, low[entry2], 0), np.where(few, high[entry2], 0)
    strings = pa.array([t.decode() for t in names], pa.string())
    a, b = len(head), len(entry2)
    nothing = pa.nulls(a, pa.int64())
    return pa.table({
        "kind": pa.array(np.r_[np.full(a, OCCURRENCES, np.int32), np.full(b, DOCUMENTS, np.int32)]),
        "gid": pa.chunked_array([pa.array(g[head], pa.int64()), pa.nulls(b, pa.int64())]),
        "lid": pa.array(np.r_[lid[outer[entry[head]]], l2], pa.int64()),
        "term": strings.take(pa.array(np.r_[t[head], t2], pa.int64())),
        "n": pa.array(np.r_[total, d2], pa.int64()),
        "low": pa.chunked_array([nothing, pa.array(low2, pa.int64())]),
        "high": pa.chunked_array([nothing, pa.array(high2, pa.int64())]),
    })


def term_counts(rows: DataFrame) -> DataFrame:
    """Partial counts: occurrences (gid, lid, term, n), and per chunk the documents of a term (lid, term, n, low, high)."""
    buckets = R.buckets_for(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(buckets)
        for block, raw, offsets in text_blocks(batches):
            number, gid, lid = (np.asarray(block.column(k)) for k in (1, 2, 3))
            held.take(raw, offsets, number, gid, lid)
            if held.n >= HELD:
                yield held.counts()
        if held.n:
            yield held.counts()

    packs = rows.select("text", "number", "gid", "lid").mapInArrow(count, CHUNKS)
    return packs.groupBy("bucket").applyInArrow(lambda table: tokenized(table.column("data").to_pylist()), COUNTS)


def kept_terms(counts: DataFrame) -> DataFrame:
    """(lid, term) of the terms in at least FEW documents of the language: some chunk alone has so many, or different documents of
    several chunks are."""
    docs = counts.filter(F.col("kind") == DOCUMENTS).select("lid", "term", (F.col("n") >= FEW).alias("many"), F.explode(F.array_distinct(F.array("low", "high"))).alias("doc"))
    each = docs.groupBy("lid", "term", "doc").agg(F.max("many").alias("many"))
    return each.groupBy("lid", "term").agg(F.max("many").alias("many"), F.count("*").alias("docs")).filter(F.col("many") | (F.col("docs") >= FEW)).select("lid", "term")


def share(count: Column, n: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (n + terms)), in whole numbers."""
    big = lambda c: c.cast("decimal(18,0)")
    return F.lit(1) + F.call_function("div", big(count + 1) * F.lit(SCALE).cast("decimal(10,0)"), big(n + terms))


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def distances(shares: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """(gid, other, value) of all pairs of sources of one language, both ways. shares: (lid, block, nth, term, p); groups:
    (lid, gid, nth, tiles, blocks, blank), nth numbering the sources of a language and blank the share of a term that
    is not there; blocks: (lid, block, terms)."""
    heads = groups.select("lid", "nth", "gid", "tiles", F.col("blank").alias("p"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    heads = heads.join(blocks, ["lid", "block"], "left").select("lid", "block", "nth", "gid", "tiles", F.lit(None).cast("long").alias("term"), "p", F.coalesce("terms", F.lit(0)).cast("long").alias("terms"))
    rows = heads.unionByName(shares.select("lid", "block", "nth", "gid", "tiles", "term", "p", F.lit(0).cast("long").alias("terms")))
    tile = F.floor(F.col("nth") / TILE).cast("int")
    rows = rows.withColumn("tile", tile).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("lid", "block", F.least("tile", "with").cast("int").alias("i"), F.greatest("tile", "with").cast("int").alias("j"), "tile", "gid", "term", "p", "terms")

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[2].as_py(), key[3].as_py()
        tile, gid, p = (np.asarray(table.column(c)) for c in ("tile", "gid", "p"))
        head = np.asarray(table.column("term").is_null())
        known = np.asarray(table.column("term").fill_null(0))
        ids, nth = np.unique(gid, return_inverse=True)
        blank, side = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        blank[nth[head]], side[nth[head]] = p[head], tile[head]
        terms, column = np.unique(known[~head], return_inverse=True)
        m = np.repeat(blank[:, None], len(terms), 1)
        m[nth[~head], column] = p[~head]
        absent = int(np.asarray(table.column("terms"))[head].max(initial=0)) - len(terms)
        of, other, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        for xs, ys in ((left, right),) if i == j else ((left, right), (right, left)):
            for x in xs.tolist():
                ys_ = ys[ys != x]
                d = m[x] - m[ys_]
                b = blank[x] - blank[ys_]
                of.append(np.full(len(ys_), ids[x])), other.append(ids[ys_])
                value.append((d * d // m[ys_]).sum(1) + absent * (b * b // blank[ys_]))
        return pa.table({"gid": np.concatenate(of), "other": np.concatenate(other), "value": np.concatenate(value)})

    sums = rows.groupBy("lid", "block", "i", "j").applyInArrow(add_up, "gid long, other long, value long")
    return sums.groupBy("gid", "other").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` gives each source's distance to every other of its language, part ``term``
    the first ``top`` terms that a source uses more than its language does.

    A term is a run of letters A-Z, a-z and of characters beyond ASCII, A-Z lower-cased; each language keeps the V terms in at
    least three of its documents. A source or language with N occurrences of kept terms gives one that occurs c times
    p = 1 + floor(10^9 (c + 1) / (N + V)). Distance of p from q: floor((p - q)^2 / q), added up over all kept terms for a pair, 0 if there are
    none. Ranks go by value downwards, then by item in byte order. All arithmetic is in whole numbers.

    Null text, language and source read as empty strings. Every row is a document of its own: repeated rows and ids count as often as they
    are there. Sources without any term have their pairs too; a source alone in its language has none. Other columns are left
    out; an empty table gives an empty one; a text of any length is read whole. Chunks, terms within a distance, sources and languages are told apart by 64-bit hashes."""
    small_batches(docs.sparkSession)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(filled(text).alias("text"), filled(lang).alias("lang"), filled(source).alias("source"), F.monotonically_increasing_id().alias("number"))
    ids = {"lid": F.xxhash64("lang"), "gid": F.xxhash64(F.length("lang"), "lang", "source")}
    counts = saved(term_counts(rows.withColumns(ids)), "term-counts")
    kept = saved(kept_terms(counts), "kept-terms")
    occurs = counts.filter(F.col("kind") == OCCURRENCES).groupBy("gid", "lid", "term").agg(F.sum("n").alias("n"))
    occurs = saved(occurs.join(kept, ["lid", "term"]), "occurrences")
    everywhere = saved(occurs.groupBy("lid", "term").agg(F.sum("n").alias("all")), "everywhere")
    langs = everywhere.groupBy("lid").agg(F.sum("all").alias("lang_n"), F.count("*").alias("v"))
    groups = rows.select("lang", "source").distinct().withColumns(ids)
    groups = groups.join(occurs.groupBy("gid").agg(F.sum("n").alias("group_n")), "gid", "left").join(langs, "lid", "left").na.fill(0, ["group_n", "lang_n", "v"])
    per_lang = W.partitionBy("lid")
    groups = groups.withColumn("nth", F.row_number().over(per_lang.orderBy("gid")) - 1).withColumns({
        "tiles": F.ceil(F.count("*").over(per_lang) / TILE).cast("int"), "blocks": F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int"),
        "blank": F.when(F.col("v") > 0, share(F.lit(0), F.col("group_n"), F.col("v"))).otherwise(1),
    })
    groups = saved(groups, "groups")
    facts = occurs.join(groups.drop("lid"), "gid").withColumn("p", share(F.col("n"), F.col("group_n"), F.col("v")))
    hashed = facts.withColumn("name", F.xxhash64("term"))
    shares = hashed.select("lid", F.pmod(F.hash("name"), F.col("blocks")).cast("int").alias("block"), "nth", "gid", "tiles", F.col("name").alias("term"), "p")
    blocks = everywhere.join(groups.select("lid", "blocks").distinct(), "lid").groupBy("lid", F.pmod(F.hash(F.xxhash64("term")), F.col("blocks")).cast("int").alias("block")).agg(F.count("*").alias("terms"))
    pairs = distances(shares, groups, blocks)
    names = groups.select("gid", "lang", "source")
    others = groups.select(F.col("gid").alias("other"), F.col("source").alias("item"))
    pairs = pairs.join(others, "other").join(names, "gid").select("gid", "lang", "source", F.lit("pair").alias("part"), "item", "value")
    q = share(F.col("all"), F.col("lang_n"), F.col("v"))
    terms = facts.join(everywhere, ["lid", "term"]).withColumn("q", q).filter("p > q")
    terms = terms.select("gid", "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(W.partitionBy("gid").orderBy(F.desc("value"), "item"))
    terms = terms.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
