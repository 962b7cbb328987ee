"""The registered queries over the given tables, one for each operator, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import collocations, crosspolytope, divergence, jaccard, mixing, multiindex, packing, personal, quality, secret_scan, suffix_levels, suffix_trees, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_mix_sources", """
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, 2.0::DOUBLE * source_size AS most,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM per),
ranked AS (SELECT *, row_number() OVER (ORDER BY most / w, place) AS nth, sum(source_size) OVER () * 1.5::DOUBLE
    - coalesce(sum(most) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free FROM weighed),
level AS (SELECT nth AS level_nth, rest AS level_rest, free AS level_free FROM ranked WHERE most * free >= rest * w ORDER BY nth LIMIT 1),
targets AS (SELECT source, source_size, least(most, CASE WHEN nth < level_nth THEN most ELSE w * level_rest / level_free END) AS target FROM ranked, level),
streams AS (SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
  CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(start + size, quota) - start)
  + greatest(0, least(source_size + start + size, quota) - source_size - start) AS BIGINT) AS taken FROM streams""")
def mix_sources(spark, folder):
    return mixing.mixed(table(spark, folder, "documents")).drop("source", "first_slot")


@query("op2_token_counts")
def count_tokens(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op3_ngram_jaccard_join")
def ngram_jaccard_join(spark, folder):
    return jaccard.near_duplicates(table(spark, folder, "documents")).drop("stays")


@query("op4_secret_scan")
def secrets(spark, folder):
    rows = secret_scan.scan(table(spark, folder, "documents"))
    base = F.filter("found", lambda x: x["kind"] < 3)
    n = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    counts = [n(k).alias(f"n_{kind}") for k, kind in enumerate(secret_scan.KINDS)]
    return rows.select("doc_id", *counts, F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"), secret_scan.as_text(F.col("found")).alias("spans"))


@query("op5_quality_classifier")
def quality_classifier(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_substring_dedup")
def substring_dedup(spark, folder):
    return suffix_trees.without_repeated_words(table(spark, folder, "documents"))


@query("op7_suffix_array_dedup")
def suffix_array_dedup(spark, folder):
    return suffix_levels.without_repeated_bytes(table(spark, folder, "documents"))


@query("op8_embedding_near_dedup")
def embedding_near_dedup(spark, folder):
    return crosspolytope.near_vectors(table(spark, folder, "embeddings"))


@query("op9_nearest_neighbours")
def nearest_neighbours(spark, folder):
    return multiindex.nearest(table(spark, folder, "embeddings"))


@query("op10_pack_windows")
def pack_windows(spark, folder):
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query("op11_phrase_collocations", """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS g FROM words, range(1, 4) t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 10),
halves AS MATERIALIZED (SELECT c.*, cut, c.g[1:cut] AS head, c.g[cut + 1:] AS tail FROM candidates c, range(1, 3) t(cut) WHERE cut < c.k),
first AS MATERIALIZED (SELECT h.*, x.f AS l FROM halves h JOIN f x ON x.lang = h.lang AND x.g = h.head),
cuts AS (SELECT h.*, y.f AS r, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * y.f) AS BIGINT) AS score FROM first h JOIN f y ON y.lang = h.lang AND y.g = h.tail),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
longer AS (SELECT lang, g, max(a) AS a FROM (SELECT lang, g[1:2] AS g, a FROM candidates WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (SELECT s.lang, array_to_string(s.g, ' ') AS phrase, s.a, l, r, score FROM scored s LEFT JOIN longer o ON s.lang = o.lang AND s.g = o.g WHERE o.a IS NULL OR 100 * o.a < 50 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000""")
def phrase_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query("op12_personal_data")
def personal_data(spark, folder):
    rows = personal.scan(table(spark, folder, "documents"))
    base = F.filter("found", lambda x: x["kind"] < 4)
    n = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    counts = [n(k).alias(f"n_{kind}") for k, kind in enumerate(personal.KINDS[:4])]
    return rows.select("doc_id", *counts, F.sha2(personal.as_text(base), 256).alias("base_sha256"), personal.as_text(F.col("found")).alias("spans"))


@query("op13_source_divergence", """
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS all_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
totals AS (SELECT lang, count(*) AS v, CAST(sum(all_n) AS BIGINT) AS lang_n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(CAST(n AS BIGINT), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) USING (lang, source)),
shares AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (g.n + v) AS p, 1 + (1000000000::HUGEINT * (all_n + 1)) // (lang_n + v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN totals USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
QUALIFY part = 'pair' OR rank <= 200""")
def source_audit(spark, folder):
    return divergence.source_divergence(table(spark, folder, "documents"))
