"""Documents whose sets of word shingles have a high Jaccard similarity, by prefixes with token combinations.

All shingles have one order: rare ones first, then frequent ones by document frequency. A set of n shingles that shares
at least t = ceil(0.75 n) with another may lack n - t of them, so of any prefix that survives the loss of n - t shingles something
is shared. Rare shingles of the prefix are indexed one by one. Frequent ones are dealt into classes, and each pair within a class
is indexed: a class of c shingles survives c - 1 losses, so the prefix is extended until rare shingles and classes
together survive n - t. The number of classes goes by the size of the set (a power of two); sets near the next power are
indexed for both. Sets that share an index entry are candidates and are compared in full.

Equal sets are one class of copies from the start. Entries of up to SMALL sets give all their pairs; of a larger entry every
set is compared with one in each of several rounds, and what is not in one component after that is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import repeats as R
from .common import components, saved, small_batches, text_blocks
from .words import mixed, run_hashes, word_bounds, word_hashes

SHINGLE = 5
#: Similarity as a whole percentage: 100 * shared >= PERCENT * united.
PERCENT = 75
#: A shingle in so many different sets may count as frequent; of these the FREQUENT most frequent do, which bounds the broadcast table.
OFTEN = 16
FREQUENT = 1 << 19
#: Sets in an index entry that gives all its pairs.
SMALL = 8
HELD = 500_000
#: Rounds in which the sets of a large entry are compared with one of them.
ROUNDS = 4
#: Smallest entries of a set by which two sets know that they meet in an earlier entry too; a set in more entries may meet another twice.
LOWEST = 16
CELLS = 1 << 22


def lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw | 32, raw)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle, sorted, and the class of each text's set as one hash. A text of fewer words than
    a shingle has its whole sequence as one."""
    n = len(offsets) - 1
    raw = lower(raw)
    start, end, text = word_bounds(raw, offsets)
    words = word_hashes(raw, start, end)
    hashes, at = run_hashes(words, width, text)
    of = text[at]
    count = np.bincount(text, minlength=n)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        begin = np.searchsorted(text, short)
        whole = [run_hashes(words[b : b + c], int(c))[0][0] for b, c in zip(begin.tolist(), count[short].tolist())]
        hashes, of = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([of, short])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, of = hashes[new], of[new]
    sizes = np.bincount(of, minlength=n)
    sums = np.r_[np.uint64(0), np.cumsum(mixed(hashes))]
    ends = np.cumsum(sizes)
    total = sums[ends] - sums[ends - sizes]
    return of, hashes, mixed(total + sizes.astype(np.uint64)).view(np.int64)


def described(docs: DataFrame, id: str, text: str, width: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(__id, __row, kept columns, n, ref): size of each set and the class of its copies."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("__text"), F.col(id).alias("__id"), F.monotonically_increasing_id().alias("__row"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, raw, offsets in text_blocks(batches, "__text"):
            of, _, ref = shingle_sets(raw, offsets, width)
            yield pa.record_batch([*block.columns[1:], pa.array(np.bincount(of, minlength=block.num_rows).astype(np.int64)), pa.array(ref)], names=[*block.schema.names[1:], "n", "ref"])

    return rows.mapInArrow(run, rows.drop("__text").schema.add("n", "long").add("ref", "long"))


def distinct_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(set number, hash, ref) blocks of a task; equal sets that follow each other closely come once."""
    seen: set[int] = set()
    for _, raw, offsets in text_blocks(batches):
        of, hashes, ref = shingle_sets(raw, offsets, width)
        fresh = np.zeros(len(ref), bool)
        for i, r in enumerate(ref.tolist()):
            if r not in seen:
                seen.add(r)
                fresh[i] = True
        if len(seen) > 500_000:
            seen.clear()
        take = fresh[of]
        yield of[take], hashes[take], ref


def code_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Shingles in counts and in the broadcast table: the hash as far as bucket and packed rows keep it."""
    return (hashes >> np.uint64(32)) * np.uint64(buckets) + hashes % np.uint64(buckets)


def by_bucket(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        yield int(bucket[b]), b"".join(np.ascontiguousarray(c[b:e]).tobytes() for c in columns)


def frequent_shingles(docs: DataFrame, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, document frequencies) of the frequent shingles, at most FREQUENT, in order of code. All sets are counted; tasks add
    up their own shingles first and send four bytes for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            codes, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            bucket, rest = (codes % np.uint64(buckets)).astype(np.int32), (codes // np.uint64(buckets)).astype("<u4")
            once = times == 1
            rows = [(b, 0, d) for b, d in by_bucket(bucket[once], [rest[once]])] + [(b, 1, d) for b, d in by_bucket(bucket[~once], [rest[~once], times[~once].astype("<u4")])]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "data"])

        for _, hashes, _ in distinct_sets(batches, width):
            held.append(code_of(hashes, buckets))
            if sum(map(len, held)) >= HELD:
                yield emit()
        if held:
            yield emit()

    def often(key: tuple, table: pa.Table) -> pa.Table:
        codes, times = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()):
            x = np.frombuffer(data, "<u4")
            codes.append(x if kind == 0 else x[: len(x) // 2])
            times.append(np.ones(len(x), np.int64) if kind == 0 else x[len(x) // 2 :].astype(np.int64))
        rest, place = np.unique(np.concatenate(codes), return_inverse=True)
        df = np.bincount(place, np.concatenate(times), len(rest)).astype(np.int64)
        rest, df = rest[df >= OFTEN], df[df >= OFTEN]
        return pa.table({"code": rest.astype(np.int64) * buckets + key[0].as_py(), "df": df})

    counts = docs.select("text").mapInArrow(count, R.PACKED).groupBy("bucket").applyInArrow(often, "code long, df long")
    counts = saved(counts, "shingles")
    least, total = OFTEN, 0
    for row in counts.groupBy("df").count().orderBy(F.desc("df")).toLocalIterator():
        total += row["count"]
        if total > FREQUENT:
            least = row["df"] + 1
            break
    top = counts.filter(F.col("df") >= least).toArrow()  # at most FREQUENT rows
    codes, df = np.asarray(top.column("code")).astype(np.uint64), np.asarray(top.column("df"))
    order = np.argsort(codes)
    return codes[order], df[order]


def signatures(of: np.ndarray, hashes: np.ndarray, df: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set, entry) of rare shingles, (set, entry) of frequent ones: of, hashes: shingles of sets; df: 0 for rare ones."""
    if not len(of):
        return of, hashes, of, hashes
    order = np.lexsort((hashes, df, of))
    of, hashes, df = of[order], hashes[order], df[order]
    size = np.bincount(of)
    begin = np.cumsum(size) - size
    need = size - -(-percent * size // 100) + 1
    rank = np.arange(len(of)) - begin[of]
    rare = df == 0
    n_rare = np.bincount(of, rare, len(size)).astype(np.int64)
    single = rare & (rank < need[of])
    out_set, out_sig = [of[:0]], [hashes[:0]]
    log = lambda x: np.frexp(x)[1] - 1  # noqa: E731  whole part of the logarithm
    lacking = (need > n_rare)[of] & ~rare
    f_of, f_hash = of[lacking], hashes[lacking]
    f_rank = (np.arange(len(of)) - begin[of] - n_rare[of])[lacking]
    own, above = log(np.maximum(1, size)), log(np.maximum(1, 100 * size // percent))
    for scale in np.unique(np.concatenate([own, above])).tolist():
        here = ((own == scale) | (above == scale))[f_of]
        if not here.any():
            continue
        s_of, s_hash, s_rank = f_of[here], f_hash[here], f_rank[here]
        salt = np.uint64(scale + 1)
        if scale < 3:  # sets of a few shingles: one by one
            out_set.append(s_of), out_sig.append(mixed(s_hash + salt))
            continue
        classes = np.uint64(max(1, (1 << scale) // 6))
        kind = mixed(s_hash) % classes
        order = np.lexsort((s_rank, kind, s_of))
        opens = np.ones(len(order), bool)
        opens[1:] = (s_of[order][1:] != s_of[order][:-1]) | (kind[order][1:] != kind[order][:-1])
        gain = np.zeros(len(order), np.int64)
        gain[order] = ~opens
        total = np.cumsum(gain)  # s_of is sorted and s_rank runs within it
        head = np.r_[True, s_of[1:] != s_of[:-1]]
        base = (total - gain)[head][np.cumsum(head) - 1]
        taken = (total - gain - base) < (need - n_rare)[s_of]
        order = order[taken[order]]
        a_of, a_kind, a_hash = s_of[order], kind[order], s_hash[order]
        step = 1
        while True:
            same = (a_of[step:] == a_of[:-step]) & (a_kind[step:] == a_kind[:-step])
            if step >= len(a_of) or not same.any():
                break
            low, high = a_hash[:-step][same], a_hash[step:][same]
            out_set.append(a_of[step:][same]), out_sig.append(mixed(mixed(low) * np.uint64(3) + high + salt))
            step += 1
    return of[single], mixed(hashes[single]), np.concatenate(out_set), np.concatenate(out_sig)


RARE_ENTRY = np.dtype([("rest", "<u4"), ("ref", "<i8")])
#: Entries of frequent shingles also tell the set's size and how many of its shingles are frequent.
ENTRY = np.dtype([*RARE_ENTRY.descr, ("n", "<u4"), ("f", "<u4")])


def candidates(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """(a, b, entry, f): pairs a < b of classes with entry null; members a of a large entry with b null.

    A set with entries of frequent shingles has all its rare ones indexed. So two sets that share a rare one meet there, and
    where they meet by frequent ones they may be taken to share frequent ones alone: at most the smaller number of these, f."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_shingles(docs, width, buckets))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, dfs = table.value
        held: list[tuple[np.ndarray, ...]] = []

        def emit() -> pa.RecordBatch:
            rare_sig, rare_ref, sig, ref, n, f = (np.concatenate(c) for c in zip(*held))
            held.clear()
            split = lambda x: ((x % np.uint64(buckets)).astype(np.int32), (x >> np.uint64(32)).astype("<u4"))
            bucket, rest = split(rare_sig)
            rows = [(b, 0, d) for b, d in by_bucket(bucket, [rest, rare_ref.astype("<i8")])]
            bucket, rest = split(sig)
            rows += [(b, 1, d) for b, d in by_bucket(bucket, [rest, ref.astype("<i8"), n.astype("<u4"), f.astype("<u4")])]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "data"])

        for of, hashes, ref in distinct_sets(batches, width):
            own = code_of(hashes, buckets)
            df = np.zeros(len(own), np.int64)
            if len(codes):
                at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                hit = codes[at] == own
                df[hit] = dfs[at[hit]]
            rare_set, rare_sig, sets, sig = signatures(of, hashes, df, percent)
            n, f = np.bincount(of, minlength=len(ref)), np.bincount(of, df > 0, len(ref)).astype(np.int64)
            held.append((rare_sig, ref[rare_set], sig, ref[sets], n[sets], f[sets]))
            if sum(len(h[0]) + len(h[2]) for h in held) >= HELD // 2:
                yield emit()
        if held:
            yield emit()

    def of_kind(rows: np.ndarray, bucket: int, kind: int) -> pa.Table:
        rows = rows[np.lexsort((rows["ref"], rows["rest"]))]
        if len(rows):
            rows = rows[np.r_[True, (rows["rest"][1:] != rows["rest"][:-1]) | (rows["ref"][1:] != rows["ref"][:-1])]]
        head = np.ones(len(rows), bool)
        head[1:] = rows["rest"][1:] != rows["rest"][:-1]
        first = np.flatnonzero(head)
        size = np.diff(np.r_[first, len(rows)])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, SMALL):
            starts = first[(size > step) & (size <= SMALL)]
            many = size[(size > step) & (size <= SMALL)] - step
            at = np.repeat(starts, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            if kind:
                x, y = rows[at], rows[at + step]
                at = at[(100 + percent) * np.minimum(x["f"], y["f"]).astype(np.int64) >= percent * (x["n"].astype(np.int64) + y["n"])]
            a.append(rows["ref"][at]), b.append(rows["ref"][at + step])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        members = rows[np.repeat(size > SMALL, size)]
        m, p = len(members), len(pairs)
        entry = (members["rest"].astype(np.int64) * buckets + bucket) * 2 + kind
        f = members["f"].astype(np.int64) if kind else np.zeros(m, np.int64)
        nothing = np.zeros(p, np.int64)
        is_pair = np.r_[np.ones(p, bool), np.zeros(m, bool)]
        return pa.table({
            "a": np.concatenate([pairs[:, 0], members["ref"]]),
            "b": pa.array(np.concatenate([pairs[:, 1], np.zeros(m, np.int64)]), pa.int64(), mask=~is_pair),
            "entry": pa.array(np.concatenate([nothing, entry]), pa.int64(), mask=is_pair),
            "f": pa.array(np.concatenate([nothing, f]), pa.int64(), mask=is_pair | (kind == 0)),
        })

    def group(key: tuple, packed: pa.Table) -> pa.Table:
        kinds, data = packed.column("kind").to_pylist(), packed.column("data").to_pylist()
        each = [of_kind(R.unpack([d for k, d in zip(kinds, data) if k == kind], of), key[0].as_py(), kind) for kind, of in ((0, RARE_ENTRY), (1, ENTRY))]
        return pa.concat_tables(each)

    return docs.select("text").mapInArrow(index, R.PACKED).groupBy("bucket").applyInArrow(group, "a long, b long, entry long, f long")


def sets_of(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(ref, members): sets of the classes in pairs, as sorted five-byte hashes. A bit table of CELLS bits picks them out where texts are read; what it
    lets through needlessly finds no pair in the join."""
    cells = pairs.select(F.explode(F.array("a", "b")).alias("ref")).select(F.pmod("ref", F.lit(CELLS)).cast("int").alias("cell")).distinct().toArrow()
    wanted = np.zeros(CELLS, bool)
    wanted[np.asarray(cells.column("cell"))] = True
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(bits.value).astype(bool)
        for of, hashes, ref in distinct_sets(batches, width):
            pick = wanted[ref % CELLS]
            size = np.bincount(of, minlength=len(ref))
            end = np.cumsum(size)
            short = np.ascontiguousarray((hashes >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()
            some = np.flatnonzero(pick & (size > 0)).tolist()
            yield pa.record_batch([pa.array(ref[some]), pa.array([short[5 * (end[i] - size[i]) : 5 * end[i]] for i in some], pa.binary())], names=["ref", "members"])

    return docs.select("text").mapInArrow(run, "ref long, members binary").dropDuplicates(["ref"])


def near_in_size(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are not too unlike in size; sizes: (a, n) of every class."""
    of_b = sizes.select(F.col("a").alias("b"), F.col("n").alias("n_b"))
    close = 100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")
    return pairs.join(sizes, "a").join(of_b, "b").filter(close).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, of pairs near in size."""

    def members(column: pa.Array) -> list[np.ndarray]:
        out = []
        for data in column.to_pylist():
            wide = np.zeros((len(data) // 5, 8), np.uint8)
            wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
            out.append(wide.view("<u8").ravel())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(members(batch.column(2)), members(batch.column(3))):
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: sets.select(F.col("ref").alias(name), F.col("members").alias(f"of_{name}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "of_a", "of_b")
    return rows.mapInArrow(run, "a long, b long")


def distinct_entries(large: DataFrame) -> DataFrame:
    """Members (entry, a, f) of large entries; entries of one kind with the same members come once."""
    print_of = F.sum(F.pmod(F.xxhash64("a"), F.lit(1 << 40)))
    prints = large.groupBy("entry").agg(F.count("*").alias("n"), print_of.alias("p"), F.sum(F.pmod(F.xxhash64("a", F.lit(1)), F.lit(1 << 40))).alias("q"))
    return large.join(prints.groupBy("n", "p", "q", F.pmod("entry", F.lit(2))).agg(F.min("entry").alias("entry")).select("entry"), "entry")


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (entry, a, n, component) of the entries that are not in one component yet."""
    rows = members.join(labels.select(F.col("node").alias("a"), "component"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    several = rows.groupBy("entry").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("entry")
    return rows.join(several, "entry")


def with_lowest(rows: DataFrame) -> DataFrame:
    """The members with ``low``, the smallest entries of their set in order, LOWEST at most. Entries of rare and of frequent shingles
    are looked at apart, as pairs that only meet by frequent ones face a further bound."""
    kind = F.pmod("entry", F.lit(2))
    nth = F.row_number().over(Window.partitionBy("a", "kind").orderBy("entry"))
    low = rows.select("a", kind.alias("kind"), "entry").withColumn("nth", nth).filter(F.col("nth") <= LOWEST)
    low = low.groupBy("a", "kind").agg(F.sort_array(F.collect_list("entry")).alias("low"))
    return rows.withColumn("kind", kind).join(low, ["a", "kind"]).drop("kind")


def joined_up(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links, which are few: components of components."""
    at = lambda c: F.coalesce(c, F.col("x"))
    one = links.select(F.col("a").alias("x"), "b").join(labels.select(F.col("node").alias("x"), "component"), "x", "left").select(at("component").alias("a"), F.col("b").alias("x"))
    edges = one.join(labels.select(F.col("node").alias("x"), F.col("component").alias("other")), "x", "left").select("a", at("other").alias("b"))
    nodes = labels.unionByName(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("component")))
    up = components(edges).select(F.col("node").alias("component"), F.col("component").alias("above"))
    return saved(nodes.join(up, "component", "left").select("node", F.coalesce("above", "component").alias("component")), "labels")


def large_entries(members: DataFrame, sets: DataFrame, labels: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Labels once all links within large entries are known. In each round every entry's sets are compared with one of them, another each time,
    unless they are in its component; entries of near copies soon are one component. The set with the least share of rare shingles is
    taken, after the first round of a random half of the components: copies with changes of their own reach the bound by frequent shingles
    exactly where they are similar enough to the unchanged text. Sets that are still apart are compared pair by pair."""
    sizes = 100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")
    near = sizes & ((100 + percent) * F.least(F.coalesce("f", "n"), F.coalesce("f_b", "n_b")) >= percent * (F.col("n") + F.col("n_b")))
    for turn in range(ROUNDS + 1):
        rows = saved(apart(members, labels), "apart")
        if turn < ROUNDS:
            part = F.lit(0) if turn == 0 else F.pmod(F.xxhash64("component", F.lit(turn)), F.lit(2))
            order = F.struct(part.alias("part"), (F.lit(1.0) - F.coalesce("f", "n") / F.col("n")).alias("own"), F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("b"), F.col("n").alias("n_b"), F.col("f").alias("f_b"), F.col("component").alias("of_b"))
            hub = rows.groupBy("entry").agg(F.min(order).alias("hub")).select("entry", "hub.b", "hub.n_b", "hub.f_b", "hub.of_b")
            pairs = rows.join(hub, "entry").filter((F.col("component") != F.col("of_b")) & near)
        else:
            # two sets meet in many entries; those that are known to have met in a smaller one are not paired again
            rows = with_lowest(rows)
            first = F.coalesce(F.try_element_at(F.array_intersect("low", "low_b"), F.lit(1)), F.col("entry")) >= F.col("entry")
            other = rows.select(F.col("entry").alias("entry_b"), F.col("a").alias("b"), F.col("n").alias("n_b"), F.col("f").alias("f_b"), F.col("component").alias("of_b"), F.col("low").alias("low_b"))
            pairs = rows.join(other, (F.col("entry") == F.col("entry_b")) & (F.col("a") < F.col("b")) & (F.col("component") != F.col("of_b")) & near & first)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
        pairs = saved(pairs, "pairs")
        if not pairs.limit(1).count():
            if turn < ROUNDS and rows.limit(1).count():
                continue
            return labels
        links = saved(verified(pairs, sets, percent), "links")
        done = done.union(pairs)
        if links.limit(1).count():
            labels = joined_up(labels, links)
    return labels


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_shingles, component_id, stays, kept columns) of every row: the size of its set of distinct shingles, the smallest id
    that links reach, its own included, and whether the row is the one of its group that stays. Sets are linked when 100 * shared >= percent * united.

    Words are lower-cased in A-Z only. Null, empty and blank texts have an empty set, are linked with nothing and are their own
    component. Rows with one id and equal sets are linked like any others; null ids are never the smallest, unless there are
    only such. Other columns are left out unless ``keep`` names them; an empty table gives an empty one. Shingles are compared by
    hashes, five bytes of them in the last comparison."""
    small_batches(docs.sparkSession)
    rows = saved(described(docs, id, text, width, keep), "sets")
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = saved(candidates(texts, width, percent, R.buckets_for(texts)), "candidates")
    sizes = saved(rows.select(F.col("ref").alias("a"), "n").distinct(), "sizes")
    pairs = saved(near_in_size(found.filter("b IS NOT NULL").select("a", "b").distinct(), sizes, percent), "pairs")
    large = found.filter("entry IS NOT NULL").select("entry", "a", "f")
    links = saved(verified(pairs, sets_of(texts, pairs, width), percent), "links")
    labels = components(links)
    if large.limit(1).count():
        members = saved(distinct_entries(large).join(sizes, "a"), "members")
        members = saved(apart(members, labels).drop("component"), "members")
        sets = saved(sets_of(texts, members.select("a", F.col("a").alias("b")).distinct(), width), "members-sets")
        labels = large_entries(members, sets, labels, pairs, percent)
    labels = labels.withColumnRenamed("node", "ref")
    grouped = rows.filter("n > 0").select("__id", "__row", "ref").join(labels, "ref", "left").select("ref", "__id", "__row", F.coalesce("component", "ref").alias("component"))
    least = grouped.groupBy("component").agg(F.min(F.struct(F.col("__id").isNull().alias("last"), F.col("__id").alias("id"), F.col("__row").alias("row"))).alias("least"))
    # a class is known by its ref: one row for each, so that kept columns meet a narrow table
    classes = grouped.select("ref", "component").distinct().join(least, "component").select("ref", "least")
    out = rows.join(classes, (F.col("n") > 0) & (rows["ref"] == classes["ref"]), "left")
    some = F.col("n") > 0
    return out.select(
        F.col("__id").alias(id), F.col("n").alias("n_shingles"), F.when(some, F.col("least.id")).otherwise(F.col("__id")).alias("component_id"),
        F.when(some, F.col("least.row") == F.col("__row")).otherwise(F.lit(True)).alias("stays"), *[c for c in keep if c != id],
    )
