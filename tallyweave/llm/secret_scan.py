"""Secrets in texts: fixed patterns, and strings that a Markov model of random characters explains better than one of
ordinary identifiers. DataFrame functions only; nothing here runs Python on the executors.

Both models are first-order chains over the characters that keys are written in, with counts shrunk towards the
frequency of the single character. Random samples: values that the fixed patterns find, and digests of the sample's own ids in
hexadecimal, base 64 and capital letters with digits. Ordinary samples: the words of the same documents outside those values that
occur at more than one place, copies of a text taken as one. Every string counts once, however often it occurs. A copied key
occurs at several places too, so strings as long as a candidate are ordinary only if a trial model of the shorter ones does not call them random.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import forget, saved

#: Kinds in their order, the patterns, and how long a find must be.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGNED = 6
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: A run of these characters as long as this is a candidate; shorter ones say too little about their origin.
SHORTEST = 16
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % SHORTEST
ORDINARY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{6,}"
#: About so many documents train the models, picked by a hash of the id; all are scanned.
SAMPLE = 4096
#: Counts that the single-character frequency is worth in a chain.
SHRINK = 8.0
#: Log-likelihood ratio that a candidate needs, whole and per step.
WHOLE, STEP = 12.0, 0.5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times and compute it once."""
    return F.transform(F.array(value), use)[0]


def finds(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<start, kind, end, value>> of the leftmost matches that do not overlap; offsets in code points. The text between
    matches gives their places: lengths are summed in blocks of 64, then within a block."""

    def placed(hits: Column, parts: Column) -> Column:
        steps = F.transform(hits, lambda h, i: F.length(h) + F.length(parts[i]))
        add = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

        def ends(n: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / 64).cast("int")), lambda b: add(F.slice(n, b * 64 + 1, F.lit(64))))
            return let(sums, lambda s: F.transform(n, lambda _, i: add(F.slice(s, F.lit(1), F.floor(i / 64).cast("int"))) + add(F.slice(n, F.floor(i / 64).cast("int") * 64 + 1, F.pmod(i, F.lit(64)) + 1))))

        return let(let(steps, ends), lambda e: F.transform(hits, lambda h, i: F.struct((e[i] - F.length(h)).alias("start"), F.lit(kind).alias("kind"), e[i].alias("end"), h.alias("value"))))

    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) == 0, nothing).otherwise(let(F.split(text, pattern, -1), lambda parts: placed(hits, parts))))


def base_spans(text: Column) -> Column:
    """What the fixed patterns find, in order of start and kind."""
    value = lambda x: F.regexp_extract(x["value"], ASSIGN, 2)
    assign = F.filter(finds(text, ASSIGN, 0), lambda x: F.length(value(x)) >= ASSIGNED)
    return F.array_sort(F.concat(assign, finds(text, ACCESS, 1), finds(text, HEX, 2)))


def samples(docs: DataFrame) -> DataFrame:
    """(random, string) for training, each once; docs: (id, text) of the sample."""
    found = docs.select("id", "text", base_spans(F.col("text")).alias("base"))
    values = found.select(F.explode("base").alias("x")).select(F.regexp_replace(F.col("x.value"), ASSIGN, "$2").alias("string"))
    digest = F.sha2(F.coalesce(F.col("id").cast("string"), F.lit("")), 256)
    known = docs.select(F.explode(F.array(
        F.substring(digest, 1, 32), F.translate(F.base64(F.unhex(digest)), "=", ""), F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)), F.conv(F.substring(digest, 17, 15), 16, 36),
    )).alias("string"))
    rest = F.aggregate("base", F.col("text"), lambda t, x: F.replace(t, x["value"], F.lit(" ")))
    words = found.select(F.xxhash64("text").alias("of"), F.posexplode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("at", "string"))
    words = words.select("string", F.xxhash64("of", "at").alias("place"))  # the same in all copies of a text
    ordinary = words.groupBy("string").agg((F.min("place") < F.max("place")).alias("recurs")).filter("recurs")
    return values.union(known).distinct().select(F.lit(True).alias("random"), "string").union(ordinary.select(F.lit(False), "string")).filter(F.length("string") > 1)


def log_ratios(docs: DataFrame) -> list[float]:
    """For each pair of characters, the log of its probability in random strings over that in ordinary ones: of a trial model
    first, without ordinary strings of a candidate's length, then with those of them that it does not call random."""
    strings = saved(samples(docs), "strings")
    short = F.col("random") | (F.length("string") < SHORTEST)
    trial = F.lit(chain(strings.filter(short)))
    table = chain(strings.filter(short | ~likely(F.col("string"), trial)))
    forget(strings)
    return table


def chain(strings: DataFrame) -> list[float]:
    """The log ratios of a model of these strings. The counts that reach the driver are at most two for each pair."""
    pairs = strings.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("string") - 1), lambda i: F.substring("string", i, F.lit(2)))).alias("pair"))
    size = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = {True: [[0.0] * size for _ in ALPHABET], False: [[0.0] * size for _ in ALPHABET]}
    for row in pairs.filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_-]{2}$")).groupBy("random", "pair").agg(F.count("*").alias("n")).collect():
        counts[row["random"]][place[row["pair"][0]]][place[row["pair"][1]]] += row["n"]
    logs = {}
    for kind, n in counts.items():
        single = [sum(row[b] for row in n) + 0.5 for b in range(size)]
        whole = sum(single)
        logs[kind] = [[math.log((n[a][b] + SHRINK * single[b] / whole) / (sum(n[a]) + SHRINK)) for b in range(size)] for a in range(size)]
    return [round(logs[True][a][b] - logs[False][a][b], 6) for a in range(size) for b in range(size)]


def ratio(string: Column, table: Column) -> Column:
    """Log-likelihood ratio of a string over its steps from character to character."""
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(string, i, F.lit(1))) - 1
    return F.aggregate(F.sequence(F.lit(2), F.length(string)), F.lit(0.0), lambda s, i: s + table[at(i - 1) * len(ALPHABET) + at(i)])


def likely(string: Column, table: Column) -> Column:
    """Whether the models call a string random."""
    return let(ratio(string, table), lambda r: (r >= WHOLE) & (r >= STEP * (F.length(string) - 1)))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, found, kept columns): found is array<struct<start, kind, end, value>> of every row's secrets in order of
    start, then kind; ``kind`` numbers KINDS, offsets count code points, the end is exclusive.

    Finds of the fixed patterns all stay; a candidate of the models that overlaps none of them is added. Null text counts
    as empty and has none; repeated rows and null ids are answered row by row; other columns are left out unless
    ``keep`` names them; an empty table gives an empty one. sample: documents that train the models, about."""
    rows = docs.select(F.col(id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), *keep)
    share = min(1.0, sample / max(1, rows.count()))
    picked = rows.select(F.col("__id").alias("id"), F.col("__text").alias("text")).filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    table = F.lit(log_ratios(picked))
    out = rows.select("__id", base_spans(F.col("__text")).alias("__base"), finds(F.col("__text"), CANDIDATE, 3).alias("__more"), *keep)
    apart = lambda x: ~F.exists("__base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    more = F.filter("__more", lambda x: apart(x) & likely(x["value"], table))
    return out.select(F.col("__id").alias(id), F.array_sort(F.concat("__base", more)).alias("found"), *keep)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, overlapping ones together, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, x: Column) -> Column:
        fresh = F.concat(done["out"], F.substring(text, done["at"] + 1, x["start"] - done["at"]), F.lit(mark))
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"), F.when(x["start"] >= done["at"], fresh).otherwise(done["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
