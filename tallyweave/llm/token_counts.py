"""Token counts of whole texts by a two-tier look-up of pre-token lengths; no pre-token is ever shuffled.

A SentencePiece BPE model never joins characters across a boundary that no vocabulary piece spans. Where no piece holds
a word mark after another character, or a line feed, texts fall apart at these places into pre-tokens whose numbers of
tokens simply add up. Tier one is a broadcast table of the most frequent pre-tokens; tier two is a cache in each worker,
filled by encoding what the first tier misses. Both hold what stands between single spaces, its space included. A model without this property is applied to whole texts.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import CACHES, saved, small_batches, text_blocks

#: Pre-tokens in the broadcast table: at most this many entries of at most LONGEST characters each.
FREQUENT = 1 << 16
LONGEST = 40
#: Pre-tokens that a task's summary keeps while it counts, and hands on at its end.
COUNTED = 300_000
HANDED = 1 << 16
#: Summaries that one task merges.
FAN_IN = 16
#: Pre-tokens encoded in one call.
TOGETHER = 512
#: Entries of a worker's cache; beyond it the cache starts anew from the broadcast table.
CACHED = 500_000
MARK = "▁"
PRE = re.compile(r" *[^ \n]+| +|\n")


def pre_tokens(text: str) -> list[str]:
    """Runs of spaces with the word they precede, and line feeds; the model puts a space before a text that is not empty."""
    return PRE.findall(" " + text.replace(MARK, " ")) if text else []


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What stands between single spaces in each text, laid end to end, and the n + 1 offsets into it."""
    lists = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
    offsets = np.asarray(lists.offsets).astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


class Lengths:
    """Numbers of tokens of chunks, each with the space before it, in one worker. A chunk is one pre-token, or several if it has line feeds."""

    open: dict[str, Lengths] = {}

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, plain = spec.normalizer_spec, [p.piece for p in spec.pieces if p.type in (1, 4)]
        self.splits = (
            spec.trainer_spec.model_type == 2 and not spec.trainer_spec.treat_whitespace_as_suffix
            and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces and not norm.precompiled_charsmap
            and not any(MARK in p.lstrip(MARK) or "\n" in p for p in plain) and not any(p.type == 4 for p in spec.pieces)
        )
        self.line_feed = self.model.encode("\n")[1:]
        self.splits = self.splits and len(self.line_feed) == 1 and self.line_feed[0] != self.model.unk_id()
        self.known: dict[str, int] = {}
        self.seed: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> Lengths:
        if path not in cls.open:
            cls.open[path] = cls(path)
        return cls.open[path]

    def encode(self, words: list[str]) -> dict[str, int]:
        """Numbers of tokens of pre-tokens, many in one call: each follows a line feed, which is one token that nothing joins."""
        out = {}
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            ids = np.array(self.model.encode("\n" + "\n".join(some) + "\n", num_threads=1))
            cuts = np.flatnonzero(ids == self.line_feed[0])
            out.update(zip(some, (np.diff(cuts) - 1).tolist(), strict=True))
        return out

    def fill(self, chunks: list[str]) -> dict[str, int]:
        parts = {w: pre_tokens(w) for w in chunks if "\n" in w}
        wanted = {p for x in parts.values() for p in x if p != "\n"}
        sizes = self.encode([*wanted, *(x for w in chunks if w not in parts and (x := " " + w) not in wanted)]) | {"\n": 1}
        return {w: sum(map(sizes.__getitem__, parts[w])) if w in parts else sizes[" " + w] for w in chunks}

    def lengths(self, chunks: list[str]) -> np.ndarray:
        found = list(map(self.known.get, chunks))
        missed = [w for w, n in zip(chunks, found) if n is None]
        new = self.fill(missed) if missed else {}
        if len(self.known) + len(new) > CACHED:
            self.known = dict(self.seed)
        self.known.update((w, n) for w, n in new.items() if len(w) <= LONGEST)
        return np.array([new[w] if n is None else n for w, n in zip(chunks, found)], np.int64)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text. Runs of spaces leave empty chunks between them; texts that have such are cut by the pattern."""
        if not self.splits:
            return np.array([len(ids) for ids in self.model.encode(texts.to_pylist(), num_threads=1)], np.int64)
        chunks, offsets = chunks_of(texts)
        codes = chunks.dictionary_encode()
        words = strings(codes.dictionary)
        at = np.asarray(codes.indices)
        total = np.r_[0, np.cumsum(self.lengths(words)[at])] if len(at) else np.zeros(1, np.int64)
        out = total[offsets[1:]] - total[offsets[:-1]]
        if "" in words:
            for i in np.unique(np.searchsorted(offsets, np.flatnonzero(at == words.index("")), "right") - 1).tolist():
                pre = pre_tokens(texts[i].as_py())
                sizes = self.encode(list(set(pre) - {"\n"})) | {"\n": 1}
                out[i] = sum(map(sizes.__getitem__, pre))
        return out


CACHES.append(Lengths.open)


def top(counts: dict[str, int], n: int) -> list[tuple[str, int]]:
    return heapq.nsmallest(n, counts.items(), key=lambda x: (-x[1], x[0]))


def frequent_chunks(texts: DataFrame, text: str, n: int = FREQUENT) -> list[str]:
    """The most frequent chunks of all texts, from summaries of bounded size: each task keeps the words that it meets most and writes them to
    the shared folder, tasks merge FAN_IN of these until as few are left, and the driver merges the last lists of at most
    HANDED words. The counts rank a cache and decide nothing else; a chunk counts for each of its lines."""

    def added(counts: Counter[str], words: list[str], times: list[int]) -> Counter[str]:
        for w, c in zip(words, times):
            counts[w] += c
        return Counter(dict(top(counts, COUNTED // 2))) if len(counts) > COUNTED else counts

    def summary(counts: dict[str, int]) -> pa.RecordBatch:
        best = top({w: c for w, c in counts.items() if len(w) <= LONGEST and c > 1}, HANDED)
        return pa.record_batch([pa.array([[w for w, _ in best]], pa.list_(pa.string())), pa.array([[c for _, c in best]], pa.list_(pa.int64()))], names=["words", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for rows, _, _ in text_blocks(batches, text, cache=Lengths.open):
            each = chunks_of(pc.replace_substring(rows.column(0), "\n", " "))[0].value_counts()
            counts = added(counts, strings(each.field("values")), each.field("counts").to_numpy().tolist())
        del counts[""]
        yield summary(counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for words, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = added(counts, words, times)
        yield summary(counts)

    kind = "words array<string>, counts array<bigint>"
    lists = saved(texts.select(text).mapInArrow(count, kind), "summaries")
    while (left := lists.count()) > FAN_IN:
        lists = saved(lists.coalesce(-(-left // FAN_IN)).mapInArrow(merge, kind), "summaries")
    total: Counter[str] = Counter()
    for row in lists.toLocalIterator():
        total = added(total, row["words"], row["counts"])
    return [w for w, _ in top(total, n)]


def token_counts(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    docs: one text a row; null text counts as empty, with 0 bytes and tokens. Repeated rows, null ids and other columns
    do no harm: rows are answered one by one. An empty table gives an empty table. model: path of a SentencePiece model
    that every worker can open. limit: ``over_limit`` says whether n_tokens is above it.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lengths = Lengths.of(model)
    words = frequent_chunks(rows, "text") if lengths.splits else []
    tier = spark.sparkContext.broadcast(lengths.fill(words) if words else {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Lengths.of(model)
        mine.seed = tier.value
        mine.known = {**mine.known, **mine.seed} if len(mine.known) < CACHED // 2 else dict(mine.seed)
        for block, _, offsets in text_blocks(batches, cache=Lengths.open):
            n = mine.count(block.column(1))
            yield pa.record_batch([block.column(0), pa.array(offsets[1:] - offsets[:-1]), pa.array(n)], names=["id", "n_bytes", "n_tokens"])

    kind = rows.select("id").schema.add("n_bytes", "long").add("n_tokens", "long")
    return rows.mapInArrow(count, kind).select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
