"""Collocations of two and three words from merged stripes.

A stripe is an associative counter of next words, keyed by the words before them. Every task keeps stripes for no word (the word
counts), one word and two words; the last two are nested, word -> next word -> word after that, so that prefixes are written
once. Stripes of all tasks are merged elementwise in groups. The merged stripes hold all that scores need: a
prefix's total is the sum of its stripe, the end of a piece being one of its entries; its extensions are its entries; and the most frequent
extension of a candidate to either side, by which it may be subsumed, is the greatest entry that starts or ends with it.

Words are known by 64-bit hashes of language and bytes; the strings travel with the word counts. A first word's stripe is dealt into
SPLIT parts by the next word, so the most frequent word does not make one group large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.scale import join_hot
from . import repeats as R
from .common import saved, small_batches, text_blocks
from .words import BASE, mixed, word_bounds, word_hashes

#: Bytes as they are compared: A-Z lower-cased, every mark that ends a piece as a line feed.
SHOWN = np.arange(256, dtype=np.uint8)
SHOWN[65:91] += 32
SHOWN[[*b".,;:!?", *range(0x0A, 0x0E)]] = 0x0A
#: Words that a task counts together before it hands stripes on.
HELD = 1_000_000
#: Parts that one first word's stripe is dealt into.
SPLIT = 16
#: Keys with more than this share of all words are salted in joins, so there are at most so many.
HOT_KEYS = 1024
STRIPES = "bucket int, lang string, data binary"
MERGED = "level int, lang string, word string, w1 long, w2 long, w3 long, f long"
TOTAL, WORD, PAIR, TRIPLE = 0, 1, 2, 3


def cuts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def ragged(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pieces of data, one after the other."""
    return data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def packed_words(ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> bytes:
    return b"".join([np.array([len(ids)], "<u4").tobytes(), ids.astype("<u8").tobytes(), counts.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), data.tobytes()])


def unpacked_words(data: bytes) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ids, counts, sizes = np.frombuffer(data, "<u8", n, 4), np.frombuffer(data, "<i8", n, 4 + 8 * n), np.frombuffer(data, "<u4", n, 4 + 16 * n)
    return ids, counts, sizes.astype(np.int64), np.frombuffer(data, np.uint8, offset=4 + 20 * n)


def packed_stripes(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, counts: np.ndarray) -> bytes:
    """Nested stripes of entries sorted by first, second and third word."""
    outer, inner = cuts_of(w1), cuts_of(w1, w2)
    width = np.diff(np.r_[np.searchsorted(inner, outer), len(inner)])
    parts = [np.array([len(outer), len(inner), len(w3)], "<u4"), w1[outer], width.astype("<u4"), w2[inner], np.diff(np.r_[inner, len(w3)]).astype("<u4"), w3, counts.astype("<u4")]
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def unpacked_stripes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(w1, w2, w3, count) of each entry."""
    n1, n2, n3 = np.frombuffer(data, "<u4", 3).tolist()
    at, out = 12, []
    for n, kind in ((n1, "<u8"), (n1, "<u4"), (n2, "<u8"), (n2, "<u4"), (n3, "<u8"), (n3, "<u4")):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    first, width, second, depth, third, counts = out
    return np.repeat(np.repeat(first, width), depth), np.repeat(second, depth), third, counts.astype(np.int64)


class Held:
    """What one task has counted since it last handed stripes on."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.words: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.known: list[tuple[np.ndarray, ...]] = []
        self.langs: dict[str, int] = {}
        self.n = self.piece = 0

    def take(self, raw: np.ndarray, offsets: np.ndarray, langs: list[str], salts: np.ndarray) -> None:
        raw = SHOWN[raw]
        start, end, text = word_bounds(raw, offsets)
        if not len(start):
            return
        ids = mixed(word_hashes(raw, start, end) ^ salts[text])
        ids[ids == 0] = 1  # 0 stands for the end of a piece
        piece = np.cumsum((raw >= 0x0A) & (raw <= 0x0D))[start] + text + self.piece
        fresh, at = np.unique(ids, return_index=True)
        code = np.array([self.langs.setdefault(lang, len(self.langs)) for lang in langs], np.int64)
        size = (end - start)[at]
        self.words.append(ids), self.pieces.append(piece)
        self.known.append((fresh, code[text[at]], size, ragged(raw, start[at], size)))
        self.n, self.piece = self.n + len(ids), int(piece[-1]) + 1

    def stripes(self) -> pa.RecordBatch:
        rows: list[tuple[int, str | None, bytes]] = []
        h, piece = np.concatenate(self.words), np.concatenate(self.pieces)
        words, place = np.unique(h, return_inverse=True)
        counts = np.bincount(place, minlength=len(words))
        # words, each with its string, by bucket and language
        ids, code, size, data = (np.concatenate(c) for c in zip(*self.known))
        begin = np.cumsum(size) - size
        at = np.unique(ids, return_index=True)[1]
        bucket = (words % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((words, code[at], bucket))
        of = code[at][order]
        names = list(self.langs)
        cuts = cuts_of(bucket[order], of)
        for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            some = order[b:e]
            rows.append((int(bucket[some[0]]), names[of[b]], packed_words(words[some], counts[some], size[at[some]], ragged(data, begin[at[some]], size[at[some]]))))
        # next words, and words after those
        n = len(words)
        i = np.flatnonzero(piece[1:] == piece[:-1])
        after = np.zeros(len(i), np.int64)
        more = np.flatnonzero(i + 2 < len(h))
        more = more[piece[i[more] + 2] == piece[i[more]]]
        after[more] = place[i[more] + 2] + 1
        pairs, of_pair = np.unique(place[i] * n + place[i + 1], return_inverse=True)
        triples, times = np.unique(of_pair * (n + 1) + after, return_counts=True)
        pair, third = pairs[triples // (n + 1)], triples % (n + 1)
        w1, w2, w3 = words[pair // max(1, n)], words[pair % max(1, n)], np.where(third > 0, words[third - 1], np.uint64(0))
        bucket = (mixed(w1 + w2 % np.uint64(SPLIT) * BASE) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, w1, w2, w3, times = (c[order] for c in (bucket, w1, w2, w3, times))
        cuts = cuts_of(bucket)
        for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            rows.append((int(bucket[b]), None, packed_stripes(w1[b:e], w2[b:e], w3[b:e], times[b:e])))
        self.clear()
        return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.string(), pa.binary()))], names=["bucket", "lang", "data"])


def table_of(level: int, n: int, **columns: pa.Array | np.ndarray) -> pa.Table:
    out = {"level": pa.array(np.full(n, level, np.int32))}
    for name, kind in (("lang", pa.string()), ("word", pa.string()), ("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("f", pa.int64())):
        c = columns.get(name)
        out[name] = pa.nulls(n, kind) if c is None else pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) else c
    return pa.table(out)


def merged_words(langs: list[str], data: list[bytes], least: int) -> list[pa.Table]:
    """Words found at least so often, and the words of each language in this group."""
    if not data:
        return []
    parts = [unpacked_words(d) for d in data]
    ids, counts, size, raw = (np.concatenate(c) for c in zip(*parts))
    names = sorted(set(langs))
    of = np.repeat(np.array([names.index(x) for x in langs]), [len(p[0]) for p in parts])
    begin = np.cumsum(size) - size
    totals = np.zeros(len(names), np.int64)
    np.add.at(totals, of, counts)
    order = np.argsort(ids, kind="stable")
    cuts = cuts_of(ids[order])
    f = np.add.reduceat(counts[order], cuts)
    at, f = order[cuts][f >= least], f[f >= least]
    ends = np.r_[0, np.cumsum(size[at])].astype(np.int64)
    strings = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ragged(raw, begin[at], size[at]).tobytes())]).cast(pa.string())
    return [table_of(TOTAL, len(names), lang=pa.array(names), f=totals), table_of(WORD, len(at), lang=pa.array([names[k] for k in of[at]], pa.string()), word=strings, w1=ids[at], f=f)]


def merged_stripes(data: list[bytes], least: int) -> list[pa.Table]:
    """Pairs and triples found at least so often; the total of a pair counts all entries of its stripe."""
    if not data:
        return []
    w1, w2, w3, counts = (np.concatenate(c) for c in zip(*map(unpacked_stripes, data)))
    pair = mixed(w1 * BASE + w2)
    out = []
    for level, key in ((PAIR, pair), (TRIPLE, mixed(pair * BASE + w3))):
        order = np.argsort(key, kind="stable")
        cuts = cuts_of(key[order])
        f = np.add.reduceat(counts[order], cuts) if len(cuts) else np.zeros(0, np.int64)
        at = order[cuts]
        keep = (f >= least) & ((level == PAIR) | (w3[at] != 0))
        at, f = at[keep], f[keep]
        out.append(table_of(level, len(at), w1=w1[at], w2=w2[at], w3=w3[at] if level == TRIPLE else None, f=f))
    return out


def merged(docs: DataFrame, text: str, lang: str, least: int) -> DataFrame:
    """Merged stripes as rows (level, lang, word, w1, w2, w3, f), without what occurs less than ``least`` times."""
    name = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), name.alias("lang"), F.xxhash64(name).alias("salt"))
    buckets = R.buckets_for(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(buckets)
        for block, raw, offsets in text_blocks(batches):
            held.take(raw, offsets, block.column(1).to_pylist(), np.asarray(block.column(2)).view(np.uint64))
            if held.n >= HELD:
                yield held.stripes()
        if held.n:
            yield held.stripes()

    def merge(table: pa.Table) -> pa.Table:
        langs, data = table.column("lang").to_pylist(), table.column("data").to_pylist()
        words = [(k, d) for k, d in zip(langs, data) if k is not None]
        parts = merged_words([k for k, _ in words], [d for _, d in words], least) + merged_stripes([d for k, d in zip(langs, data) if k is None], least)
        return pa.concat_tables([table_of(TOTAL, 0), *parts])

    return rows.mapInArrow(count, STRIPES).groupBy("bucket").applyInArrow(merge, MERGED)


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (left right)) in whole numbers of up to 38 digits."""
    big = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * big(a) * big(a), big(left) * big(right))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, subsumed: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two or three words by score.

    Words are runs between spaces and tabs within pieces, which end at . , ; : ! ? and line breaks; A-Z is lower-cased. a: occurrences, at least ``least``; n: all words of the language.
    A phrase's score is the least of floor(10^6 a^2 / (l r)) over its cuts into a first part that occurs l times and a rest that occurs r times, the
    shortest first part among equals. A phrase is dropped if a longer one that holds it occurs at least ``subsumed`` percent as often. Ties go
    to the greater a, then to the phrase in byte order.

    Null and empty texts hold no words; null language is ``und`` and goes together with texts that say so. Repeated rows count as often as they are
    there; ids play no part, other columns are left out; an empty table gives an empty one. A text of any length is read whole. Words are told
    apart by 64-bit hashes; counts and scores are exact."""
    small_batches(docs.sparkSession)
    rows = saved(merged(docs, text, lang, least), "stripes")
    total = rows.filter(F.col("level") == TOTAL).groupBy("lang").agg(F.sum("f").alias("n"))
    hot = max(1, (rows.filter(F.col("level") == TOTAL).agg(F.sum("f")).first()[0] or 0) // HOT_KEYS)
    words = rows.filter(F.col("level") == WORD).select("lang", "word", "w1", "f")
    pairs = rows.filter(F.col("level") == PAIR).select("w1", "w2", F.col("f").alias("f12"))
    triples = rows.filter(F.col("level") == TRIPLE).select("w1", "w2", "w3", F.col("f").alias("a"))

    def named(facts: DataFrame, key: str, f: str, word: str, *more: str) -> DataFrame:
        side = words.select(F.col("w1").alias(key), F.col("f").alias(f), F.col("word").alias(word), F.col("f").alias("_rows"), *more)
        return join_hot(facts, side, [key], "_rows", hot_rows=hot)

    longest = triples.select(F.explode(F.array(F.struct("w1", "w2", "a"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))).alias("x")).select("x.*")
    longest = longest.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    known = saved(named(named(pairs, "w1", "f1", "word1", "lang"), "w2", "f2", "word2").join(longest, ["w1", "w2"], "left"), "pairs")
    stays = F.col("longer").isNull() | (100 * F.col("longer") < subsumed * F.col("f12"))
    two = known.filter(stays).select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("f12").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), exact_score(F.col("f12"), F.col("f1"), F.col("f2")).alias("score"),
    )
    head = known.select("w1", "w2", "lang", "word1", "word2", "f1", "f12", F.col("f12").alias("_rows"))
    tail = known.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("word2").alias("word3"), F.col("f2").alias("f3"), F.col("f12").alias("f23"), F.col("f12").alias("_rows"))
    three = join_hot(join_hot(triples, head, ["w1", "w2"], "_rows", hot_rows=hot), tail, ["w2", "w3"], "_rows", hot_rows=hot)
    three = three.withColumn("early", exact_score(F.col("a"), F.col("f1"), F.col("f23"))).withColumn("late", exact_score(F.col("a"), F.col("f12"), F.col("f3")))
    first = F.col("early") <= F.col("late")
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("early", "late").alias("score"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    best = two.unionByName(three).withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
