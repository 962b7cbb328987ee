"""Personal data in texts: fixed patterns, and further spans by weak supervision. DataFrame functions only; nothing here runs Python
on the executors.

Finds of the fixed patterns and of three looser ones are candidates. Five labelers vote on each: what form it has, whether
gazetteers know a part of it, what the words before it say, whether its parts fit together, and whether it hangs on to other
characters. Expectation-maximisation over the table of vote patterns estimates how reliable each labeler is and how likely each pattern is
personal. These probabilities, not labels, train the span classifier, a naive Bayes model of the span and its surroundings, from all candidates.
Finds of the fixed patterns stay whatever it says; looser candidates are added where it is sure.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import saved
from .secret_scan import finds, let

#: Kinds in their order and the patterns. Guards and possessive repeats only keep long runs from being tried again.
KINDS = ("email", "ip", "card", "phone", "handle", "number", "name")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

#: Gazetteers: ends of domains, issuers of cards, first digits of dialled numbers, given names and titles.
DOMAINS = "com org net edu gov info biz io de fr es it uk nl at ch be eu us ca".split()
GIVEN = (
    "Alice Anna Antonio Bob Carlos Carmen Charles Claire Daniel David Elena Emily Emma Eva Frank George Hans Helen Isabel Jack James Jane Jean Johann John Jose Juan "
    "Julia Karl Klaus Laura Louis Lucia Luis Maria Marie Mark Martin Mary Michael Miguel Otto Paul Peter Pierre Robert Sarah Sophie Susan Thomas William"
).split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Madame Monsieur".split()
#: Words before a span that speak for personal data, or against it.
FOR = r"(?i)\b(phone|telephone|tel|call|mobile|cell|fax|dial|whatsapp|mail|e-?mail|contact|reach|write to|card|visa|mastercard|ssn|social security|passport|address|name|named|dear|regards|telefon|anrufen|kontakt|nombre|llame|teléfono|appelez|téléphone|nom)\b[^A-Za-z0-9]{0,6}(?:(?:is|me|at|number|no|at|us|no\.)[^A-Za-z0-9]{1,4}){0,3}$"
AGAINST = r"(?i)(\b(version|release|isbn|issn|order|invoice|page|pages|chapter|section|total|price|date|year|from|id|serial|model|part|population|score|row|line|build)\b[^A-Za-z0-9]{0,6}(?:(?:is|of|number|no|no\.)[^A-Za-z0-9]{1,4}){0,2}|[$€£=/_]\x20?)$"

#: Looser patterns: a mail address with the signs spelled out, grouped digits, a title or given name with a name after it.
HANDLE = r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[A-Za-z0-9-]++)++"
NUMBER = r"(?<![A-Za-z0-9+.])\(?[0-9][0-9().\x20/-]{5,30}[0-9](?![A-Za-z0-9])"
NAME = r"(?<![\p{L}0-9])(?:%s)\.?\x20\p{Lu}\p{L}{1,30}(?:\x20\p{Lu}\p{L}{1,30})?" % "|".join(TITLES + GIVEN)
#: Grouped digits that people dial or are numbered by; and dates, versions and plain runs.
DIALLED = r"^(\(?0[0-9]{1,5}\)?[\x20/-][0-9]{2,}([\x20-][0-9]{2,}){0,4}|\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|([0-9]{2}[\x20.]){4}[0-9]{2})$"
PLAIN = r"^([0-9]+|([0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-]([0-9]{2}|[0-9]{4}))([\x20][0-9].*)?|[0-9]+(\.[0-9]+)+|(19|20)[0-9]{2}\x20?[-/]\x20?(19|20)[0-9]{2}|[0-9]{1,3}([\x20.][0-9]{3})+)$"
#: Characters before and after a span that are looked at.
BEFORE, AFTER = 32, 4
LABELERS = 5
#: Cells of the classifier's table, and how sure it must be.
CELLS = 4096
SURE = 0.9
#: Observations that the first belief in a labeler is worth: it is right where it votes three times in four.
TRUST = 30.0


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def byte_sized(value: Column) -> Column:
    """Whether the four parts of an address are at most 255 each."""
    part = lambda x: F.regexp_replace(x, "^0+", "")
    return F.forall(F.split(value, r"\."), lambda x: (F.length(part(x)) < 3) | ((F.length(part(x)) == 3) & (part(x) <= F.lit("255"))))


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test: from the right, every second digit counts twice, less 9 if that is above 9."""

    def worth(i: Column) -> Column:
        d = F.ascii(F.substring(number, F.length(number) - i, F.lit(1))) - F.lit(48)
        return F.when(F.pmod(i, F.lit(2)) == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def within(n: Column, bounds: tuple[int, int]) -> Column:
    return (n >= bounds[0]) & (n <= bounds[1])


def sided(text: Column, pattern: str, kind: int) -> Column:
    """Finds with the characters between them and their neighbours, up to BEFORE before and AFTER after."""
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,before:string,after:string>>")

    def sides(hits: Column, parts: Column) -> Column:
        return F.transform(hits, lambda h, i: F.struct(
            h["start"].alias("start"), h["kind"].alias("kind"), h["end"].alias("end"), h["value"].alias("value"), F.right(parts[i], F.lit(BEFORE)).alias("before"), F.left(parts[i + 1], F.lit(AFTER)).alias("after"),
        ))

    return let(finds(text, pattern, kind), lambda hits: F.when(F.size(hits) == 0, nothing).otherwise(let(F.split(text, pattern, -1), lambda parts: sides(hits, parts))))


def base_spans(text: Column) -> Column:
    """What the fixed patterns find and the checks let through, in order of start and kind."""
    card = lambda x: let(digits(x["value"]), lambda d: F.when(within(F.length(d), CARD_DIGITS), luhn(d)).otherwise(False))
    phone = lambda x: within(F.length(digits(x["value"])), PHONE_DIGITS)
    return F.array_sort(F.concat(
        sided(text, EMAIL, 0), F.filter(sided(text, IP, 1), lambda x: byte_sized(x["value"])), F.filter(sided(text, CARD, 2), card), F.filter(sided(text, PHONE, 3), phone),
    ))


def votes(c: Column) -> list[Column]:
    """The labelers' votes on a candidate: 1 for personal, -1 against, 0 for none."""
    kind, value = c["kind"], c["value"]
    of = lambda *names: kind.isin([KINDS.index(n) for n in names])
    pick = lambda *cases: _cases(cases)
    count = F.length(digits(value))
    form = pick((of("email", "ip", "card", "phone", "handle"), 1), (of("number") & value.rlike(DIALLED), 1), (of("number") & value.rlike(PLAIN), -1))
    domain = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(DOMAINS)
    known = pick(
        (of("email", "handle") & domain, 1), (of("email", "handle"), -1), (of("ip") & value.rlike(r"^(0|10|127|22[4-9]|2[3-5][0-9])\."), -1), (of("ip"), 1),
        (of("card") & value.rlike("^[3-6]"), 1), (of("card"), -1), (of("name"), 1), (of("number") & value.rlike(r"^\(?(0[1-9]|00)"), 1),
    )
    said = pick((c["before"].rlike(FOR), 1), (c["before"].rlike(AGAINST), -1))
    groups = F.size(F.split(value, r"[^0-9]+"))
    fits = pick(
        (of("email", "handle") & value.rlike("^[^@(\\[]*[A-Za-z]"), 1), (of("number") & (F.length(digits(value)) >= 7) & (count <= 15) & (groups >= 3) & (groups <= 6), 1), (of("number"), -1),
        (of("name") & value.rlike(r"\x20\p{Lu}\p{L}+\x20\p{Lu}"), 1), (of("phone"), 1), (of("card") & value.rlike(r"^([0-9]{4}[\x20-]){3}"), 1),
    )
    hangs = pick((c["before"].rlike(r"[A-Za-z0-9_/=#&@-]$") | c["after"].rlike(r"^[A-Za-z0-9_/=#&@-]"), -1))
    return [form, known, said, fits, hangs]


def _cases(cases: tuple[tuple[Column, int], ...]) -> Column:
    out = F.when(cases[0][0], F.lit(cases[0][1]))
    for condition, vote in cases[1:]:
        out = out.when(condition, F.lit(vote))
    return out.otherwise(F.lit(0))


def features(c: Column) -> Column:
    """Cells of what the classifier looks at: the form of the span, the word before, what follows, digits and length."""
    form = F.regexp_replace(F.regexp_replace(F.substring(c["value"], 1, 80), "[0-9]+", "9"), r"\p{L}+", "a")
    word = F.regexp_extract(F.lower(c["before"]), r"(\p{L}+)[^\p{L}]*$", 1)
    near = F.regexp_replace(F.regexp_replace(F.concat(F.right(c["before"], F.lit(1)), F.lit("|"), F.left(c["after"], F.lit(1))), "[0-9]", "9"), r"\p{L}", "a")
    size = F.concat_ws(":", F.least(F.length(digits(c["value"])), F.lit(20)).cast("string"), F.floor(F.least(F.length(c["value"]), F.lit(60)) / 6).cast("string"))
    named = [F.concat(F.lit(f"{i}:"), c["kind"].cast("string"), F.lit(":"), x) for i, x in enumerate((form, near, size))] + [F.concat(F.lit("w:"), word)]
    return F.array(*[F.pmod(F.xxhash64(x), F.lit(CELLS)).cast("int") for x in named])


def code_of(votes: list[Column]) -> Column:
    out = F.lit(0)
    for i, v in enumerate(votes):
        out = out + (v + 1) * 3**i
    return out


def reliabilities(counts: dict[int, int], labelers: int = LABELERS, trust: float = TRUST) -> tuple[float, list[list[list[float]]], list[float]]:
    """(share of personal candidates, [labeler][class][vote + 1] probabilities, probability of each vote pattern to be personal), by
    expectation-maximisation until nothing moves. counts: how often each pattern was cast, patterns being numbers to base 3.
    The first belief, worth ``trust`` votes, is that a labeler that votes is right three times in four; without candidates it is all that is known."""
    cast = [[code // 3**i % 3 for i in range(labelers)] for code in range(3**labelers)]
    belief = [[0.45, 0.4, 0.15], [0.15, 0.4, 0.45]]
    share, table = 0.5, [[list(belief[y]) for y in (0, 1)] for _ in range(labelers)]
    personal: list[float] = []
    for _ in range(100_000):
        before, personal = personal, []
        for votes in cast:
            odds = math.log(share / (1 - share)) + sum(math.log(table[i][1][v] / table[i][0][v]) for i, v in enumerate(votes))
            personal.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
        if before and max(abs(a - b) for a, b in zip(before, personal)) < 1e-9:
            break
        weight = [[0.0, 0.0] for _ in cast]
        for code, n in counts.items():
            weight[code] = [n * (1 - personal[code]), n * personal[code]]
        totals = [sum(w[y] for w in weight) for y in (0, 1)]
        share = (totals[1] + 1) / (totals[0] + totals[1] + 2)
        for i in range(labelers):
            for y in (0, 1):
                seen = [trust * b for b in belief[y]]
                for code in counts:
                    seen[cast[code][i]] += weight[code][y]
                table[i][y] = [s / sum(seen) for s in seen]
    return share, table, personal


def span_classifier(candidates: DataFrame) -> tuple[float, list[float]]:
    """(log odds of any candidate, what each cell adds to them), from all candidates. At most 3^LABELERS vote patterns and CELLS cells reach
    the driver, whatever the size."""
    counts = {r["code"]: r["n"] for r in candidates.groupBy("code").agg(F.count("*").alias("n")).collect()}
    share, _, personal = reliabilities(counts)
    p = F.lit(personal)[F.col("code")]
    cells = candidates.select(p.alias("p"), F.explode("features").alias("cell")).groupBy("cell").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    yes = sum(n * personal[code] for code, n in counts.items())
    no = sum(counts.values()) - yes
    adds = [math.log((1 / (yes + 2)) / (1 / (no + 2)))] * CELLS
    for r in cells.collect():
        adds[r["cell"]] = math.log(((r["yes"] + 1) / (yes + 2)) / ((r["no"] + 1) / (no + 2)))
    return math.log(share / (1 - share)), [round(a, 9) for a in adds]


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", sure: float = SURE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, found, kept columns): found is array<struct<start, kind, end>> of every row's personal data in order of start, then kind;
    ``kind`` numbers KINDS, offsets count code points, the end is exclusive.

    Finds of the first four kinds all stay. A looser candidate is added where the classifier is at least so ``sure`` and no find of the
    first four overlaps it. Null text counts as empty and has none; repeated rows and null ids are answered row by row and each trains; texts of
    any length are read whole; other columns are left out unless ``keep`` names them; an empty table gives an empty one."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("__id"), value.alias("__text"), *keep)
    loose = F.concat(sided(F.col("__text"), HANDLE, 4), sided(F.col("__text"), NUMBER, 5), sided(F.col("__text"), NAME, 6))
    spans = rows.select("__id", "__text", base_spans(F.col("__text")).alias("__base"), loose.alias("__loose"), *keep)
    apart = F.filter("__loose", lambda x: ~F.exists("__base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    described = F.transform(F.concat("__base", apart), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), code_of(votes(c)).alias("code"), features(c).alias("features")))
    found = saved(spans.select("__id", described.alias("__found"), *keep), "personal")
    candidates = found.select(F.explode("__found").alias("c")).select("c.code", "c.features")
    prior, adds = span_classifier(candidates)
    table, least = F.split(F.lit(",".join(map(repr, adds))), ",").cast("array<double>"), math.log(sure / (1 - sure))  # one literal once planned
    odds = lambda x: F.aggregate(x["features"], F.lit(prior), lambda s, f: s + table[f])
    stays = F.filter("__found", lambda x: (x["kind"] < 4) | (odds(x) >= F.lit(least)))
    return found.select(F.col("__id").alias(id), F.array_sort(F.transform(stays, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))).alias("found"), *keep)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
