"""The registered queries of the numbered operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.llm import (
    common, decontaminate, labelled, masked_lm, mixing, phrases, piece_tokens, quality, sharding, simhash, spelling,
    token_file, topk, toxicity, warc,
)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), simhash.hex_digits().alias("fingerprint"), "component_id"
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(common.table(spark, sf_dir, "embeddings"))


OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * cast(x AS double))) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.vec, c.vec) AS bigint) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 20
"""


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


OP4 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS m,
         unnest(list_transform(range(1, greatest(len(words) - 12, 1) + 1), lambda i: array_to_string(words[i:i + 12], ' '))) AS w
  FROM bw WHERE len(words) > 0),
sizes AS (SELECT DISTINCT m FROM win),
grams AS (
  SELECT doc_id, m, unnest(range(1, len(words) - m + 2)) AS i, words FROM dw, sizes WHERE len(words) >= m),
found AS (
  SELECT g.doc_id, g.i, g.m, win.item_id
  FROM (SELECT doc_id, m, i, array_to_string(words[i:i + m - 1], ' ') AS w FROM grams) g
  JOIN win ON win.m = g.m AND win.w = g.w),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM found) GROUP BY doc_id)
SELECT dw.doc_id, cast(len(words) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
       cast(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op5_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(common.table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    path = common.staging(docs).folder("tokens")
    token_file.write_tokens(docs, path)
    return token_file.read_tokens(spark, path)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    path = common.staging(pages).folder("archives")
    warc.write_archives(pages, path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT *, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS original FROM p)
SELECT page_id, cast(octet_length(encode(body)) AS bigint) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast((cast('0x' || substr(hex, cast(5 * (i // 4) + 1 AS bigint), 5) AS bigint) >> cast(15 - 5 * (i % 4) AS bigint)) & 31 AS bigint) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM d
"""


def _judged(found: DataFrame, cut: float) -> DataFrame:
    return found.select("row.doc_id", "score").select(
        "doc_id",
        labelled.is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = quality.learned(docs, common.table(spark, sf_dir, "labels"))
    return _judged(quality.scored(docs, model, keep=["doc_id"]), quality.CUT)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.learned(docs, common.table(spark, sf_dir, "labels"))
    return _judged(toxicity.scored(docs, model, keep=["doc_id"]), toxicity.CUT)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = masked_lm.pseudo_likelihood(docs, keep=["doc_id"])
    per_word = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return found.select("row.doc_id", "n_words", "log_likelihood", per_word.alias("per_word"))


def op11_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = piece_tokens.encoded(docs, keep=["doc_id"], decode=True)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(common.table(spark, sf_dir, "documents"))


OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::bigint AS n FROM w GROUP BY lang),
starts AS (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) s(m)),
f AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM starts GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM cand),
cut AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         (2000000::hugeint * c.a // (x.f::hugeint + y.f))::bigint AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1:c.m], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_sizes AS (SELECT *, unnest(range(2, m)) AS im FROM cand),
inner_starts AS (SELECT *, unnest(range(1, m - im + 2)) AS i FROM inner_sizes),
held AS (SELECT lang, array_to_string(ws[i:i + im - 1], ' ') AS phrase, max(a) AS most FROM inner_starts GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN held USING (lang, phrase)
  WHERE most IS NULL OR 100::hugeint * most < 80::hugeint * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = spelling.vocabulary(common.table(spark, sf_dir, "documents"))
    return spelling.variants(vocabulary)


def queries() -> dict:
    return {
        "op1_source_mixing": op1_source_mixing,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_exact_top_k": op3_exact_top_k,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_stratified_sharding": op5_stratified_sharding,
        "op6_token_output": op6_token_output,
        "op7_warc": op7_warc,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_toxicity": op9_toxicity,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_piece_tokens": op11_piece_tokens,
        "op12_phrases": op12_phrases,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_top_k": OP3, "op4_benchmark_decontamination": OP4, "op7_warc": OP7, "op12_phrases": OP12}
