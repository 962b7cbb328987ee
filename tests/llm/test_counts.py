"""Collocations, personal data and source divergence beside plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tallyweave.llm import collocations, divergence, personal

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, least, subsumed, top):
    f, total = Counter(), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (r[1] or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = defaultdict(list)
    longer = defaultdict(int)
    for (lang, g), a in f.items():
        if len(g) == 3 and a >= least:
            for part in (g[:2], g[1:]):
                longer[lang, part] = max(longer[lang, part], a)
    for (lang, g), a in f.items():
        if len(g) > 1 and a >= least and not (len(g) == 2 and longer[lang, g] and 100 * longer[lang, g] >= subsumed * a):
            score, _, left, right = min((10**6 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
            out[lang].append((-score, -a, " ".join(g).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1))


@pytest.mark.parametrize("least, top", [(2, 50), (10, 2000)])
def test_collocations_equal_plain_counts(spark, docs, rows, monkeypatch, least, top):
    monkeypatch.setattr(collocations, "HELD", 4000)
    got = collocations.collocations(docs, least=least, top=top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, least, 50, top) and got


def test_collocations_of_overlaps_ties_and_no_rows(spark, no_docs):
    assert collocations.collocations(no_docs).count() == 0
    rows = [(1, "a a a a. A\tA;b c", None), (None, "x y! y x, X Y", "und"), (1, "x y! y x, X Y", "und"), (2, None, "en"), (3, "", "en"), (4, " . ", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, collocations.collocations(df, least=1).collect())) == plain_collocations(rows, 1, 50, 2000)


def test_scores_pass_64_bits(spark):
    df = spark.createDataFrame([(4_000_000_000_001, 4_000_000_000_003, 4_000_000_000_007), (3_037_000_500, 3_037_000_501, 3_037_000_499)], "a long, l long, r long")
    got = df.select("a", "l", "r", collocations.exact_score(df["a"], df["l"], df["r"]).alias("s")).collect()
    assert all(s == 10**6 * a * a // (left * right) for a, left, right, s in got)


def plain_divergence(rows, top=200):
    fill = lambda x: "" if x is None else x
    count, docs, groups = Counter(), defaultdict(set), set()
    for i, r in enumerate(rows):
        lang, source = fill(r[2]), fill(r[3])
        groups.add((lang, source))
        for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", fill(r[1])):
            t = t.translate(LOWER)
            count[lang, source, t] += 1
            docs[lang, t].add(i)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (k, t), d in docs.items() if k == lang and len(d) >= 3]
        sources = sorted(s for k, s in groups if k == lang)
        v = len(kept)
        p = {}
        for s in sources:
            n = sum(count[lang, s, t] for t in kept)
            p[s] = {t: 1 + 10**9 * (count[lang, s, t] + 1) // (n + v) for t in kept}
        every = {t: sum(count[lang, s, t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (every[t] + 1) // (sum(every.values()) + v) for t in kept}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(items, 1)]
    return sorted(out)


def test_divergence_equals_plain_counts(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 2000)
    monkeypatch.setattr(divergence, "TERMS", 50)
    monkeypatch.setattr(divergence, "TILE", 2)
    got = divergence.source_divergence(docs).collect()
    assert sorted(map(tuple, got)) == plain_divergence(rows)


def test_divergence_of_sources_without_terms_and_no_rows(spark, no_docs):
    assert divergence.source_divergence(no_docs).count() == 0
    rows = [(1, "A-a b1c É", "x", "s"), (1, "a B c é", "x", None), (None, "the a,c É", "x", "t"), (2, None, "x", "u"), (3, "", "y", "s"), (4, "12 ;", "y", "t"), (5, "z", None, None), (6, "z z", "", ""), (7, "z", None, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert sorted(map(tuple, divergence.source_divergence(df).collect())) == plain_divergence(rows)


def plain_personal(text):
    """The fixed patterns as they are given, and their checks."""
    text, out = text or "", []
    luhn = lambda d: sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    only = lambda s: re.sub("[^0-9]", "", s)
    for k, (name, pattern, ok) in enumerate([
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(only(s)) <= 19 and luhn(only(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(only(s)) <= 15),
    ]):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, re.ASCII) if ok(m.group())]
    return [x for _, _, x in sorted(out)]


ODD = [
    "a@b.c@d.e a@b.c_x@d.e .@x.y x@y a.b@c-d.e..f é@x.y@z.w", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.001 1.2.3 1..2.3.4.5 99999999999999999999.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 00000000000000 4111  1111 1111 1111",
    "+1 (521) 555-2373 +49 30 1234567890123 ++1 222 333 4444 +1 2 +1 (((( +1-222-333-44445)", "é\U0001f600 me@x.org +1 (521) 555-2373\n10.0.0.1", "1" * 3_000 + "x" * 3_000 + "@" + "1." * 3_000 + "1 " * 3_000, "", None,
]


def test_base_spans_equal_plain_patterns(spark, rows):
    every = [(i, t, "x") for i, t in enumerate(ODD + [r[1] for r in rows])]
    df = spark.createDataFrame(every, "doc_id long, text string, found string")
    got = {r["doc_id"]: r["spans"] for r in personal.scan(df).selectExpr("doc_id", "filter(found, x -> x.kind < 4) found").select("doc_id", personal.as_text(personal.F.col("found")).alias("spans")).collect()}
    for i, text, _ in every:
        assert got[i] == ",".join(plain_personal(text)), text and text[:80]
    assert hashlib.sha256(b"").hexdigest()  # the digest of no spans is that of the empty string


def test_labelers_are_told_apart():
    """Votes drawn with known reliabilities: two good labelers, one fair, one that guesses, one that often abstains."""
    rng = random.Random(5)
    right, speaks = [0.95, 0.9, 0.75, 0.5, 0.9], [1.0, 0.9, 0.9, 1.0, 0.4]
    counts, truth = Counter(), Counter()
    for _ in range(20_000):
        y = rng.random() < 0.3
        code = 0
        for i in range(5):
            v = 0 if rng.random() > speaks[i] else (1 if y == (rng.random() < right[i]) else -1)
            code += (v + 1) * 3**i
        counts[code] += 1
        truth[code, y] += 1
    share, table, p = personal.reliabilities(counts)
    assert abs(share - 0.3) < 0.02
    for i in range(5):
        for y, v in ((1, 2), (0, 0)):
            assert abs(table[i][y][v] / (table[i][y][0] + table[i][y][2]) - right[i]) < 0.05
    agree = sum(truth[c, p[c] > 0.5] for c in counts) / 20_000
    majority = sum(truth[c, sum(c // 3**i % 3 - 1 for i in range(5)) > 0] for c in counts) / 20_000
    assert agree > 0.95 and agree >= majority
    assert personal.reliabilities({})[0] == 0.5


def planted(rng, n):
    """(text, start, end, personal) of looser spans in plain words."""
    words = "river stone amber willow copper linen harbour meadow timber saddle lantern velvet".split()
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    yes = [
        lambda: ("phone ", f"0{num(3)} {num(3)} {num(4)}"), lambda: ("call me at ", f"({rng.randint(2, 9)}{num(2)}) {num(3)}-{num(4)}"), lambda: ("ssn: ", f"{num(3)}-{num(2)}-{num(4)}"),
        lambda: ("mail ", f"{rng.choice(words)}.{rng.choice(words)} (at) {rng.choice(words)}.org"), lambda: ("contact ", f"{rng.choice(words)}{num(2)}[at]{rng.choice(words)}[dot]com"), lambda: ("dear ", f"{rng.choice(personal.TITLES)} {rng.choice(words).title()} {rng.choice(words).title()}"),
    ]
    no = [
        lambda: ("version ", f"{num(2)}.{num(3)}.{num(3)}"), lambda: ("date ", f"20{num(2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}"), lambda: ("order ", num(10)), lambda: ("total ", f"1{num(2)} {num(3)} {num(3)}"), lambda: ("isbn ", f"97{num(1)}-{num(1)}-{num(4)}-{num(2)}"), lambda: ("", num(12)),
    ]
    for _ in range(n):
        good = rng.random() < 0.4
        cue, span = rng.choice(yes if good else no)()
        head = " ".join(rng.choice(words) for _ in range(rng.randint(3, 9))) + " " + cue
        yield head + span + " " + rng.choice(words) + " " + rng.choice(words), len(head), len(head) + len(span), good


def test_added_spans_hit_planted_ones(spark):
    rng = random.Random(8)
    cases = list(planted(rng, 1200))
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(cases)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: [x for x in r["found"] if x["kind"] >= 4] for r in personal.scan(df).collect()}
    hit = sum(any(x["start"] <= s and x["end"] >= e for x in got[i]) for i, (_, s, e, good) in enumerate(cases) if good)
    wrong = sum(bool(got[i]) for i, c in enumerate(cases) if not c[3])
    good = sum(c[3] for c in cases)
    assert hit / good >= 0.9 and hit / max(1, hit + wrong) >= 0.9, (hit, good, wrong)


def test_personal_data_of_odd_rows_and_no_rows(spark, no_docs):
    assert personal.scan(no_docs).count() == 0
    rows = [(None, "me@x.org"), (1, "me@x.org"), (1, "me@x.org"), (2, None)]
    got = personal.scan(spark.createDataFrame(rows, "doc_id long, text string"), keep=("text",)).collect()
    assert sorted((r["doc_id"] is None, len(r["found"])) for r in got) == [(False, 0), (False, 1), (False, 1), (True, 1)]
