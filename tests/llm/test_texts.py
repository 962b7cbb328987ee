"""Operators on texts beside brute-force versions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tallyweave.llm import jaccard, mixing, packing, quality, secret_scan, suffix_levels, suffix_trees, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES, TOKENS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def by(rows, *names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def test_token_counts_equal_the_library(docs, rows, no_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in rows)
    got = token_counts.token_counts(docs, PIECES, limit=100).collect()
    assert by(got, "doc_id", "n_bytes", "n_tokens") == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert token_counts.token_counts(no_docs, PIECES).count() == 0


def test_token_counts_of_odd_white_space_over_many_tasks(spark):
    import sentencepiece

    rng = np.random.default_rng(1)
    texts = ["", " ", "  ", "\n", "a  b", "a \n b", "\n\na", "\u2581a\u2581b", "a\u2581 b", "<s> a</s>", "a\x00b", "\ta\r\n"]
    texts += ["".join(rng.choice(list(" \nab\u2581\u00e9.\u65e5<"), n)) for n in rng.integers(0, 30, 400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2 * token_counts.FAN_IN + 3)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(rows, PIECES).collect()} == dict(enumerate(map(len, model.encode(texts))))


def test_packing_round_trip(docs, rows, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENS)
    want = Counter((r[0], np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in rows)
    got = packing.pack(docs, TOKENS, capacity=256, group=8, ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)
    pieces, windows = {}, {}
    for r in got:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    for key, parts in pieces.items():
        same = [ids for (i, ids), n in want.items() for _ in range(n) if (i, len(ids) // 4) == key]
        spans = Counter()
        for r in parts:
            spans[r["start"]] += 1
        if len(same) == 1:
            assert b"".join(r["ids"] for r in sorted(parts, key=lambda r: r["start"])) == same[0]
        assert sum(r["length"] for r in parts) == sum(len(s) // 4 for s in same)
    assert packing.pack(no_docs, TOKENS).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_differencing_is_near_equal_and_windows_hold(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 4000, 300)
    part = packing.differencing(sizes, 40)
    sums = np.bincount(part, sizes, 40)
    assert sums.max() - sums.min() < 0.05 * sums.mean()
    pieces = packing.windows(rng.integers(0, 9000, 200), 4096)
    load = Counter()
    for _, _, n, w in pieces:
        load[w] += n
    assert max(load.values()) <= 4096
    assert len(load) * 4096 - sum(load.values()) < 4096 + 0.01 * sum(load.values())


def test_packing_of_nothing_and_one():
    assert packing.windows(np.zeros(3, np.int64)) == []
    assert packing.windows(np.array([4096])) == [(0, 0, 4096, 0)]


def test_mixing_targets_and_taken(docs, rows, no_docs):
    got = mixing.mixed(docs).collect()
    assert by(got, "doc_id", "size") == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    per = {}
    for r in got:
        s = per.setdefault(r["source"], [r["source_size"], r["target"], 0, 0])
        s[2] += r["size"]
        s[3] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert abs(sum(s[1] for s in per.values()) - 1.5 * sum(s[0] for s in per.values())) < 1e-6
    assert all(s[0] == s[2] and abs(s[1] - s[3]) <= 0.5 and s[1] <= 2 * s[0] for s in per.values())
    free = [(s[1] / w) for (_, s), w in zip(sorted(per.items(), key=lambda x: (x[0] is None, x[0])), [5, 2, 1, 5, 2]) if s[1] < 2 * s[0] - 1e-9]
    assert max(free) - min(free) < 1e-6
    assert mixing.mixed(no_docs).count() == 0
    assert by(mixing.mixed(docs.repartition(5)).collect(), "doc_id", "size", "taken") == by(got, "doc_id", "size", "taken")


def test_schedule_keeps_to_the_weights(spark):
    slots = spark.createDataFrame([(0, 500, 500), (1, 800, 300), (2, 1000, 200)], "place int, upto long, n long")
    got = sorted((r["slot"], r["place"], r["rank"]) for r in mixing.schedule(slots, 1000).collect())
    for n in (50, 200, 700, 1000):
        c = Counter(p for _, p, _ in got[:n])
        assert all(abs(c[p] - n * w) <= 6 for p, w in ((0, 0.5), (1, 0.3), (2, 0.2)))
    seen = Counter()
    for _, p, rank in got:
        assert rank == seen[p]
        seen[p] += 1


def components(sets):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("often,small,rounds", [(16, 8, 4), (2, 2, 4), (2, 2, 0)])  # the second makes most shingles frequent and entries large, the third pairs all in them
def test_jaccard_components(docs, rows, no_docs, monkeypatch, often, small, rounds):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "LOWEST", 16 if rounds else 2)
    monkeypatch.setattr(jaccard, "OFTEN", often)
    monkeypatch.setattr(jaccard, "SMALL", small)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = components(sets)
    least = {}
    for r, g in zip(rows, group):
        least[g] = min(least.get(g, 1 << 60), 1 << 60 if r[0] is None else r[0])
    want = Counter((r[0], len(s), least[g] if s else r[0]) for r, s, g in zip(rows, sets, group))
    got = jaccard.near_duplicates(docs).collect()
    assert by(got, "doc_id", "n_shingles", "component_id") == want
    stay = [r["component_id"] for r in got if r["stays"] and r["n_shingles"]]
    assert len(stay) == len(set(stay)) == len({g for g, s in zip(group, sets) if s})
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_secrets_equal_the_patterns(docs, rows, no_docs):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    want = Counter()
    for r in rows:
        t = r[1] or ""
        s = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        want[r[0], tuple(sorted(s))] += 1
    got = secret_scan.scan(docs).collect()
    assert Counter((r["doc_id"], tuple((x["start"], x["kind"], x["end"]) for x in r["found"] if x["kind"] < 3)) for r in got) == want
    assert secret_scan.scan(no_docs).count() == 0


def test_secrets_many_in_one_text(spark):
    text = " ".join(hashlib.sha256(str(i).encode()).hexdigest() + "é" for i in range(300))
    got = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["found"]
    assert [(x["start"], x["end"]) for x in got] == [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{64}", text)]


def test_markov_finds_keys_and_leaves_words(spark, docs):
    key, plain = "sk9QxZ2LmT7vB4nRw8KpYc3H", "internationalization_of_configuration"
    some = spark.createDataFrame([(1, f"words {key} here {plain}"), (2, "nothing but plain words in this one")], "doc_id long, text string")
    every = [v for r in secret_scan.scan(docs.select("doc_id", "text").union(some)).collect() for v in [x["value"] for x in r["found"] if x["kind"] == 3]]
    assert key in every and plain not in every


@pytest.mark.parametrize("alike", [True, False])  # copies of one text, or one key in texts of their own
def test_markov_finds_a_key_in_a_third_of_the_rows(spark, texts, alike):
    key = "sk9QxZ2LmT7vB4nRw8KpYc3H"
    plain = [t for t in texts if t and "key" not in t][:60]
    copied = [(1000 + i, f"{plain[0] if alike else plain[i]} {key} at the end") for i in range(30)]
    some = spark.createDataFrame([*enumerate(plain), *copied], "doc_id long, text string")
    got = {r["doc_id"]: [x["value"] for x in r["found"] if x["kind"] == 3] for r in secret_scan.scan(some).collect()}
    assert got == {i: [key] if i >= 1000 else [] for i in got} and len(got) == 90


def test_redaction(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("é token=abcdef0123456789abcdef0123 x",)], "text string").withColumn("s", secret_scan.base_spans(F.col("text")))
    assert df.select(secret_scan.redacted(F.col("text"), F.col("s"))).first()[0] == "é [SECRET] x"


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    right = sum(r["predicted"] == r["quality"] for r in got) / len(got)
    assert right > max(0.93, sum(r["quality"] for r in got) / len(got))


def test_quality_of_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([((i * 37) % 1009, int(i % 5 > 0), 0) for i in range(0, 60, 2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.quality_scores(no_docs, labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {1.0}


def test_quality_learns_from_one_row_an_id(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(quality, "fit", lambda positive, unlabelled, prior: sizes.append((len(positive), len(unlabelled))))
    rows = [(i, f"text {i} of its own") for i in range(40)] + [(i % 2 * 39, f"other text {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    quality.quality_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), labels)
    assert sizes == [(sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(20)), 20)]


def keyed(rows):
    return [(r, r[0] if r[0] is not None else 1 << 62, r[1] or "") for r in rows]


def test_repeated_words(docs, rows, no_docs):
    least = {}
    for _, key, t in keyed(rows):
        w = WORD.findall(t)
        for i in range(len(w) - 12):
            x = tuple(w[i : i + 13])
            least[x] = min(key, least.get(x, key))
    want = Counter()
    for r, key, t in keyed(rows):
        w = WORD.findall(t)
        gone = set()
        for i in range(len(w) - 12):
            if least[tuple(w[i : i + 13])] < key:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = suffix_trees.without_repeated_words(docs, texts=True).collect()
    assert by(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)
    assert suffix_trees.without_repeated_words(no_docs).count() == 0


def test_crowded_prefixes_are_parted(spark):
    rows = [(i % 3, i % 5, i, 1, 0, 0) for i in range(300)]
    df = suffix_trees.parted_by_prefix(spark.createDataFrame(rows, "short long, middle long, deep long, doc long, tag int, first long"), 15)
    sizes = Counter((r["a"], r["b"], r["c"]) for r in df.collect())
    assert max(sizes.values()) <= 15


@pytest.mark.parametrize("batches,crowded,hot", [(1, 1 << 16, 4096), (4, 1 << 16, 4096), (3, 2, 1)])
def test_repeated_bytes(spark, rows, no_docs, monkeypatch, batches, crowded, hot):
    monkeypatch.setattr(suffix_levels, "CROWDED", crowded)
    monkeypatch.setattr(suffix_levels.R, "HOT", hot)
    unique = {r[0]: r for r in rows}.values()  # the order among rows of one id is by a hash
    seen, want = set(), Counter()
    for r, _, t in sorted(keyed(unique), key=lambda x: x[1]):
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            x = b[i : i + 100]
            if x in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(x)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[r[0], len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    docs = spark.createDataFrame(list(unique), "doc_id long, text string, lang string, source string, n_chars long, id string, n long")
    got = suffix_levels.without_repeated_bytes(docs.repartition(3), batches=batches).collect()
    assert by(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    if batches == 1:
        assert suffix_levels.without_repeated_bytes(no_docs).count() == 0


@pytest.fixture(scope="module")
def no_ids(spark):
    """One long text with an id, and 3,000 of many lengths without, most of which hold a passage of it."""
    rng = np.random.default_rng(5)
    words = lambda n: ["%08x" % x for x in rng.integers(0, 1 << 32, n)]
    first = words(400)
    texts = []
    for n in rng.integers(0, 60, 3000).tolist():
        w, at = words(n), int(rng.integers(0, 380))
        texts.append(" ".join([*w[: n // 3], *(first[at : at + 20] if n % 4 else []), *w[n // 3 :]]))
    rows = [(1, " ".join(first)), *((None, t) for t in texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_repeated_words_of_many_null_ids(no_ids):
    rows, docs = no_ids
    first = rows[0][1].split()
    known = {tuple(first[i : i + 13]) for i in range(len(first) - 12)}
    want = Counter()
    for key, t in rows:
        w, gone = t.split(), set()
        for i in range(len(w) - 12):
            if key is None and tuple(w[i : i + 13]) in known:
                gone.update(range(i, i + 13))
        want[key, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()] += 1
    assert by(suffix_trees.without_repeated_words(docs).collect(), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_repeated_bytes_of_many_null_ids(no_ids):
    rows, docs = no_ids
    order = [(r["doc_id"], r["text"].encode()) for r in docs.selectExpr("*", "doc_id IS NULL AS last", "xxhash64(text) AS h").orderBy("last", "h").collect()]
    seen, want = set(), Counter()
    for key, b in order:
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(b[i : i + 100])
        want[key, len(b), sum(gone), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()] += 1
    assert by(suffix_levels.without_repeated_bytes(docs).collect(), "doc_id", "n_bytes", "n_removed", "kept_sha256") == want


def test_a_worker_keeps_the_cache_of_one_operator():
    import pyarrow as pa

    from tallyweave.llm.common import text_blocks

    packing.Words.open["a"], token_counts.Lengths.open["b"] = "words", "lengths"
    batch = pa.record_batch([pa.array(["x y", None])], names=["text"])
    assert sum(rows.num_rows for rows, _, _ in text_blocks([batch], cache=packing.Words.open)) == 2
    assert "a" in packing.Words.open and not token_counts.Lengths.open
    list(text_blocks([batch]))
    assert not packing.Words.open
