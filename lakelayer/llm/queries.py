"""Registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.llm.backoff import score_documents
from lakelayer.llm.decontaminate import scan
from lakelayer.llm.jaccard import link_groups
from lakelayer.llm.kneser_ney import judge_by_perplexity
from lakelayer.llm.packing import pack_documents
from lakelayer.llm.pii import KINDS, find_personal_data
from lakelayer.llm.quality_rules import judge
from lakelayer.llm.secret_scan import KINDS as SECRET_KINDS
from lakelayer.llm.secret_scan import find_secrets
from lakelayer.llm.shuffle import shuffle_into_shards
from lakelayer.llm.simhash import fingerprint_groups
from lakelayer.llm.spelling import group_variants
from lakelayer.llm.tokens import public_path
from lakelayer.llm.va_file import cluster_vectors
from lakelayer.llm.wavelet import token_shards


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in windows of 2048, placed by histogram packing."""
    placed = pack_documents(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids of every document, written as wavelet matrices and read back."""
    return token_shards(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base kinds, and what the network finds."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "network")
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in SECRET_KINDS]
    return found.select("doc_id", *counts, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))


def op4_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards, uniformly at random, with shard counts at most one apart."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("size", F.coalesce("size", F.lit(1)).cast("long"))
    dealt = shuffle_into_shards(rows, 8, ["doc_id", "size", "text_crc32"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_perplexity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of trusted text, and the verdict by language."""
    return judge_by_perplexity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def spelled(spans: Column) -> Column:
    """Spans as kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def of_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base kinds, and identifiers found by their context."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "context")
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 13-word windows of the benchmark, and the verdict."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 3-word shingles, and its group at Jaccard 0.9 or more."""
    return link_groups(table(spark, sf_dir, "documents"), 3, 9, 10).select("doc_id", "n_shingles", "component_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and the cascade's verdict of every document."""
    return judge(table(spark, sf_dir, "documents"))


def op10_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document against the rest of the corpus."""
    return score_documents(table(spark, sf_dir, "documents"), order=3)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, each with its more frequent form one edit away and the root forms lead to."""
    return group_variants(table(spark, sf_dir, "documents"))


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after ten rounds, with distances and sums."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and its group at three or fewer differing bits."""
    return fingerprint_groups(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pack_sequences, op2_wavelet_tokens, op3_secret_scan, op4_shuffle_shards, op5_perplexity_quality, op6_personal_data, op7_decontaminate,
                                  op8_jaccard_join, op9_quality_rules, op10_backoff_scores, op11_spelling_variants,
                                  op12_va_clusters, op13_simhash_groups)}
# DuckDB SQL of the queries that SQL can express. The others hold random permutations, token
# ids, trained models or sums of logarithms; tests hold them against brute force.
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[ \t\n\r\x0b\x0c]"



def _spelling_sql() -> str:
    """CRC-32 by its table, each byte of a run folded in; words one edit apart by what is left without one letter."""
    crc = "range(256)"
    for _ in range(8):
        crc = f"list_transform({crc}, lambda x: xor(x >> 1, 3988292384 * (x & 1)))"
    step = "xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return rf"""WITH RECURSIVE tbl AS (SELECT {crc} AS crc
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id,
         unnest(regexp_extract_all({_LOW}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), counted AS (SELECT id, run, count(*) AS times FROM runs GROUP BY id, run
), hashed AS (
  SELECT run, times, xor(list_reduce(list_transform(flatten(list_transform(string_split(id || run, ''),
           lambda l: CASE WHEN ord(l) < 128 THEN [ord(l)] ELSE [195, ord(l) - 64] END)), lambda b: CAST(b AS BIGINT)),
         lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM counted, tbl
), slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, times FROM hashed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), less AS (
  SELECT word, n, place, word[:place] || word[place + 2:] AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS place FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT less.word, words.word, words.n FROM less JOIN words ON rest = words.word
  UNION SELECT words.word, less.word, less.n FROM less JOIN words ON rest = words.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)
), reach AS (
  SELECT word, word AS root, form AS ahead FROM forms
  UNION ALL SELECT reach.word, forms.word, forms.form FROM reach JOIN forms ON reach.ahead = forms.word
)
SELECT word, form, reach.root, n, n_near, form_n FROM forms JOIN reach USING (word) WHERE reach.ahead IS NULL"""


def _clusters_sql(rounds: int = 10) -> str:
    """One pair of tables for each round: every vector's cluster, and the centroids' next components."""

    def nearest(t: int) -> str:
        return f"""d{t} AS MATERIALIZED (
  SELECT id, c, sum((x - y) * (x - y)) AS distance FROM tall JOIN c{t} USING (d) GROUP BY id, c
), a{t} AS MATERIALIZED (
  SELECT id, c, distance FROM d{t} QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, c) = 1
)"""

    moves = ", ".join(f"""{nearest(t)}, s{t} AS (
  SELECT c, d, sum(x) AS s, count(*) AS k FROM tall JOIN a{t} USING (id) GROUP BY c, d
), c{t + 1} AS MATERIALIZED (
  SELECT c, d, coalesce((s - ((s % k) + k) % k) // k, y) AS y FROM c{t} LEFT JOIN s{t} USING (c, d)
)""" for t in range(rounds))
    return f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), tall AS MATERIALIZED (SELECT id, unnest(v) AS x, unnest(range(64)) AS d FROM kept
), seeds AS (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM kept
), c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, unnest(range(64)) AS d FROM seeds WHERE c < 8
), {moves}, {nearest(rounds)}, digests AS (
  SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (id) JOIN digests USING (c)"""


ORACLE_SQL: dict[str, str] = {
    "op7_decontaminate": rf"""WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, span, array_to_string(w[pos:pos + span - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - span + 2)) AS pos FROM (SELECT *, least(13, len(w)) AS span FROM items WHERE len(w) > 0))
), docs AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, span, pos, array_to_string(w[pos:pos + span - 1], ' ') AS words
  FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS pos
        FROM docs, (SELECT DISTINCT span FROM windows) WHERE len(w) >= span)
), met AS (SELECT doc_id, pos, span, item FROM places JOIN windows USING (span, words)
), hits AS (
  SELECT doc_id, count(DISTINCT at_word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + span)) AS at_word FROM met) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS own FROM met GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(own, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op8_jaccard_join": rf"""WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex({_LOW}, '{_SPACE}+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM docs
), elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
       AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id""",
    "op9_quality_rules": rf"""WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\r\x0b\x0c]')) AS l FROM documents
), windows AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words) AS times
  FROM (SELECT doc_id, unnest(range(1, len(w) - 1)) AS pos,
               unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS words
        FROM docs WHERE len(w) >= 3)
), repeated AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS word FROM windows WHERE times > 1) GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines
  FROM docs LEFT JOIN repeated USING (doc_id)
), based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 35 * n_words OR 100 * n_dup_lines > 60 * n_lines
            OR word_chars > 20 * n_words OR word_chars < 2 * n_words) AS kept
FROM based""",
    "op11_spelling_variants": _spelling_sql(),
    "op12_va_clusters": _clusters_sql(),
}
