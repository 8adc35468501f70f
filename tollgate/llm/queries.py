"""The registered queries of the operators, and their SQL where SQL can express one."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import best_fit, decontaminate, embed_dedup, extract, hard_negatives, langid, ngram_join, packing, phrases, secrets, token_count, toxicity, warc
from tollgate.llm.storage import settle, table


def _bucket(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), _bucket(4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract.main_text(pages, extract.learn(pages))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the captures, with what their request and metadata records say."""
    captures = warc.round_trip(table(spark, sf_dir, "pages")).select(
        F.regexp_extract("metadata.fields", r"page-id: (-?[0-9]+)", 1).try_cast("long").alias("page_id"), "capture_id", "record_type",
        "response.refers_to", "response.payload_bytes", F.regexp_replace("response.payload_digest", "^sha256:", "").alias("payload_digest"),
        F.substring_index("request.http", "\r\n", 1).alias("request_line"), F.rtrim(F.regexp_replace("metadata.fields", "[\r\n]+", "")).alias("metadata_fields"))
    captures = settle(captures, "captures")
    responses = captures.where("record_type = 'response'")
    target = responses.select(F.col("capture_id").alias("refers_to"), F.col("page_id").alias("target"))
    columns, said = ["page_id", "payload_bytes", "payload_digest", "record_type"], ["request_line", "metadata_fields"]
    revisits = captures.where("record_type = 'revisit'").join(target, "refers_to", "left").select(*columns, F.col("target").alias("refers_to"), *said)
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to"), *said).union(revisits)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), _bucket(3) == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                              (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "evidence")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = best_fit.pieces(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return best_fit.place(best_fit.keyed(pieces)).drop("key")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", noisy), F.col("id") % 100 == 0)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontaminate, op3_html_extraction, op4_ngram_jaccard_join, op5_warc, op6_secrets,
                                   op7_toxicity, op8_embedding_dedup, op9_packing, op10_token_counts, op11_best_fit_packing,
                                   op12_hard_negatives, op13_phrases)}

#: Positions, tokenizers and learned models are beyond one SQL text; the tests hold those operators against brute force.
ORACLE: dict[str, str] = {
    "op4_ngram_jaccard_join": r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS shingles FROM listed),
shingles AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS n, count(*) AS both_have
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * both_have >= 80 * (n - both_have)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT doc_id, y FROM reached JOIN ways ON other = x)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c USING (doc_id)""",
    "op5_warc": """
WITH payloads AS (
  SELECT page_id, coalesce(url, '') AS url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
leaders AS (SELECT payload_digest, min(page_id) AS leader FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN coalesce(leader, page_id) = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN leader <> page_id THEN leader END AS refers_to, 'GET ' || url || ' HTTP/1.1' AS request_line, 'page-id: ' || page_id AS metadata_fields
FROM payloads LEFT JOIN leaders USING (payload_digest)""",
    "op8_embedding_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT vec_id, y FROM reached JOIN ways ON other = x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id) c LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM ways GROUP BY x) w USING (vec_id)""",
    "op12_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS "rank", n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 5""",
    "op13_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM listed WHERE len(w) > 0),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM placed, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a FROM counted WHERE k > 1 AND f >= 100),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.k > c.k AND o.a >= c.a AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT c.*, j, array_to_string(string_split(phrase, ' ')[1 : j], ' ') AS head, array_to_string(string_split(phrase, ' ')[j + 1 :], ' ') AS tail
  FROM kept c, (SELECT unnest([1, 2, 3, 4]) AS j) WHERE j < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, CAST(CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f), j) = 1)
SELECT lang, row_number() OVER best AS "rank", phrase, a, l, r, n, score FROM scored
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000""",
}
