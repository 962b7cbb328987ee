"""Packing of tokenised documents into training windows by Karmarkar-Karp multiway differencing.

Documents are cut into full windows and a rest. Rests gather, within a task, into groups of about GROUP windows of
tokens. Differencing starts with one partial partition for each rest and keeps merging the two with the largest
imbalance, the largest sums of the one onto the smallest of the other, until one near-equal partition is left. Whenever a
window exceeds the capacity the number of windows rises, within SLACK of the least number; beyond that the least number is
kept and what sticks out of a window is cut off and fills the room of others. Nothing is shuffled, and the driver sees no
row: the groups are as many as the data needs, and each is of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from itertools import compress, count, repeat
from operator import add, is_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import CACHES, small_batches, text_blocks

CAPACITY = 4096
#: Windows in a group, and the share of further windows that balance may cost.
GROUP = 256
SLACK = 1 / 256
#: Bytes of token ids that a task holds before it packs them, full or not.
HELD_BYTES = 64 << 20
#: Words in a worker's cache, and the longest that it keeps.
CACHED = 600_000
LONGEST = 40


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The part, 0 to k - 1, of each size, by multiway differencing. A partial partition keeps its parts that are not
    empty, in descending order of sum; merging lays the ascending parts of one beside the descending parts of the other."""
    if len(sizes) == 0 or k == 1:
        return np.zeros(len(sizes), np.int64)
    sums: list[np.ndarray] = [np.array([s], np.int64) for s in sizes]
    made: list[tuple] = [()] * len(sizes)
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        x, y = sums[a], sums[b]
        p, q = len(x), len(y)
        n = min(k, p + q)
        at = n - 1 - np.arange(q)  # the slot of each part of b, largest last
        both = np.zeros(n, np.int64)
        both[:p] = x
        both[at] += y
        order = np.argsort(-both, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        sums.append(both[order])
        sums[a] = sums[b] = None
        made.append((a, b, rank[:p], rank[at]))
        least = int(sums[-1][-1]) if n == k else 0
        heapq.heappush(heap, (least - int(sums[-1][0]), len(made) - 1))
    slots: list = [None] * len(made)
    slots[heap[0][1]] = np.arange(k)
    part = np.zeros(len(sizes), np.int64)
    for i in range(len(made) - 1, -1, -1):
        if made[i]:
            a, b, of_a, of_b = made[i]
            slots[a], slots[b] = slots[i][of_a], slots[i][of_b]
            slots[i] = None
        else:
            part[i] = slots[i][0]
    return part


def windows(sizes: np.ndarray, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int, int, int]]:
    """(item, start, length, window) pieces: each item whole wherever balance allows, no window above the capacity.
    Items of size 0 have no piece; an item may be larger than the capacity, and is then cut into windows first."""
    pieces, rest = [], []
    used = 0
    for i, size in enumerate(sizes.tolist()):
        full = size // capacity
        pieces += [(i, j * capacity, capacity, used + j) for j in range(full)]
        used += full
        if size % capacity:
            rest.append((i, full * capacity, size % capacity))
    if not rest:
        return pieces
    left = np.array([r[2] for r in rest], np.int64)
    least = -(-int(left.sum()) // capacity)
    part = first = differencing(left, least)
    k = least
    while np.bincount(part, left, k).max() > capacity and k < least + int(least * slack):
        k += 1
        part = differencing(left, k)
    if np.bincount(part, left, k).max() <= capacity:
        return pieces + [(*r, used + int(p)) for r, p in zip(rest, part)]
    room = np.full(least, capacity, np.int64)
    cut = []
    for j in np.argsort(-left, kind="stable"):  # small items last: what sticks out is small
        (i, start, size), w = rest[j], int(first[j])
        kept = min(size, int(room[w]))
        if kept:
            pieces.append((i, start, kept, used + w))
            room[w] -= kept
        if kept < size:
            cut.append((i, start + kept, size - kept))
    free = iter(np.flatnonzero(room).tolist())
    w = next(free, None)
    for i, start, size in cut:
        while size:
            kept = min(size, int(room[w]))
            pieces.append((i, start, kept, used + w))
            room[w] -= kept
            start, size = start + kept, size - kept
            if not room[w]:
                w = next(free, None)
    return pieces


#: These count as white space for str.split and not for the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Text bytes whose words are looked up together: few enough that they stay in the processor's cache.
TOGETHER = 1 << 18


def json_text(*parts: str) -> list[str]:
    return [json.dumps(p)[1:-1] for p in parts]


#: A tokenizer of this kind takes a word's plain letters for one pre-token, and the signs after them for another.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
SIGNS = ".,;:!?|*#$%&"
#: The signs that stand for bytes above ASCII and are not the byte's own character, in tokenizers that work on bytes.
BYTE_SIGNS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173]) if b > 127}


class Words:
    """Ids of words as bytes, in one worker, for a tokenizer that drops white space and never merges across it."""

    open: dict[str, Words] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        end = rules["model"].get("end_of_word_suffix") or ""
        self.parts_letters = bool(end) and all(x in json.dumps(rules["pre_tokenizer"]) for x in json_text(r"[\p{L}]+", r"[^\s\p{L}\p{N}]+")) and "Lowercase" in json.dumps(rules["normalizer"])
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = bool(end) and token.endswith(end)
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.four = [x.tobytes() for x in np.arange(len(self.ends), dtype="<u4")]
        named = [t["content"] for t in rules.get("added_tokens") or []]
        straight = [n.get("type") for n in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])] == ["Split", "ByteLevel"] and not rules["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"]
        self.direct = self.parts_letters and straight and not any(map(str.isalpha, named))

    @classmethod
    def of(cls, path: str) -> Words:
        if path not in cls.open:
            cls.open[path] = cls(path)
        return cls.open[path]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def fill(self, words: list[str]) -> dict[str, bytes]:
        """Encode words. Plain ones are letters and signs, each encoded once; for all other words each is encoded for itself."""
        if not self.parts_letters:
            return {w: self.whole(w) for w in words}
        bare = [w.rstrip(SIGNS) for w in words]
        letters = [x.lower() if x.isalpha() and (x.isascii() or LETTERS(x)) else "" for x in bare]
        signs = [w[len(x) :] for w, x in zip(words, bare)]
        self.learn(set(letters).union(signs).difference(self.parts))
        of = self.parts.__getitem__
        out = dict(zip(words, map(add, map(of, letters), map(of, signs))))
        if "" in letters:
            out.update((w, self.whole(w)) for w, x in zip(words, letters) if not x)
        if len(self.parts) > CACHED:
            self.parts = {"": b""}
        return out

    def learn(self, new: set[str]) -> None:
        """Encode pre-tokens. The merges see lower-case letters by a sign for each byte, so these go straight there; the others are encoded
        many in one call and kept apart by the tokens that end a word, and one by one if their number is not as expected."""
        if self.direct:
            merged, four = self.tokenizer.model.tokenize, self.four
            plain = list(filter(str.isalpha, new))
            seen = [p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_SIGNS) for p in plain]
            self.parts.update(zip(plain, [b"".join([four[t.id] for t in merged(x)]) for x in seen]))
            new = new.difference(plain)
        rest = sorted(new)
        for i in range(0, len(rest), 512):
            some = rest[i : i + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                self.parts.update((p, ids[b:e].tobytes()) for p, b, e in zip(some, [0, *cuts], cuts))
            else:
                self.parts.update((p, self.whole(p)) for p in some)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts: each word is looked up once, and what the cache did not have is encoded and put in."""
        cut = [None if any(map(t.__contains__, SEPARATORS)) else t.split() for t in texts]
        get, nothing = self.known.get, repeat(None)
        found = [words and list(map(get, words)) for words in cut]
        holes = [ids and list(compress(count(), map(is_, ids, nothing))) for ids in found]
        new = self.fill(list({words[i] for words, at in zip(cut, holes) if at for i in at}))
        for words, ids, at in zip(cut, found, holes):
            for i in at or ():
                ids[i] = new[words[i]]
        if len(self.known) + len(new) > CACHED:
            self.known = {}
        self.known.update(new if max(map(len, new), default=0) <= LONGEST else {w: x for w, x in new.items() if len(w) <= LONGEST})
        return [self.whole(text) if ids is None else b"".join(ids) for text, ids in zip(texts, found)]


CACHES.append(Words.open)


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = 2, capacity: int = CAPACITY, group: int = GROUP, ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece.

    docs: one text a row; null text is empty. A document is the tokens of its text and then ``end_id``, so no document
    is without a piece; repeated rows are documents of their own, null ids stay null, other columns are left out and an
    empty table gives none. tokenizer: path of a tokenizers file that every worker can open, of the kind that drops
    white space. ids: also return the pieces' token ids as little-endian unsigned 32-bit bytes.
    sequence_id holds the task in its upper bits, so a task that runs again gives the same numbers.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    last = np.array([end_id], "<u4").tobytes()
    kind = rows.select("id").schema
    for name, of in (("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"), *([("ids", "binary")] if ids else [])):
        kind = kind.add(name, of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.of(tokenizer)
        base = TaskContext.get().partitionId() << 40
        given: list = []
        held: list[bytes] = []
        waiting = used = bulk = 0

        def emit() -> pa.RecordBatch:
            nonlocal given, held, waiting, used, bulk
            sizes = np.array([len(h) // 4 for h in held], np.int64)
            pieces = sorted(windows(sizes, capacity), key=lambda p: (p[3], p[0], p[1]))
            item, start, length, window = (np.array(c, np.int64) for c in zip(*pieces))
            before = np.cumsum(length) - length
            opens = np.r_[True, window[1:] != window[:-1]]
            offset = before - before[opens][np.cumsum(opens) - 1]
            parts = [held[i][4 * s : 4 * (s + n)] for i, s, n, _ in pieces]
            out = [pa.concat_arrays(given).take(pa.array(item)), *map(pa.array, (start, length, np.array([zlib.crc32(p) for p in parts], np.int64), sizes[item], base + used + window, offset))]
            used += int(window.max()) + 1
            given, held, waiting, bulk = [], [], 0, 0
            return pa.record_batch(out + ([pa.array(parts, pa.binary())] if ids else []), names=kind.names)

        for block, _, _ in text_blocks(batches, limit=TOGETHER, cache=Words.open):
            given.append(block.column(0))
            new = [x + last for x in words.encode(block.column(1).to_pylist())]
            held += new
            waiting += sum(len(x) // 4 % capacity for x in new)
            bulk += sum(map(len, new))
            if waiting >= group * capacity or bulk >= HELD_BYTES:
                yield emit()
        if held:
            yield emit()

    return rows.mapInArrow(run, kind).withColumnRenamed("id", id)
