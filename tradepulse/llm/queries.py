"""The operators over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.llm import bpe, decontam, html_text, langid, licenses, linededup, negatives, simhash, spm, topk, toxicity, warc, whitening
from tradepulse.llm.shared import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LICENSES_SQL = f"""
WITH t(license, text) AS (VALUES {licenses.templates_sql()}),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS ps
          FROM documents WHERE text IS NOT NULL),
units AS (SELECT doc_id, unnest(ls || list_filter(ps, lambda p: contains(p, chr(10))) || CASE WHEN len(ps) > 1 THEN [text] ELSE [] END) AS u FROM split
          UNION ALL SELECT doc_id, array_to_string(ps[i:i + k - 1], chr(10)) FROM split, range(2, {licenses.RUN + 1}) AS a(k), range(1, len(ps)) AS b(i)
          WHERE k < len(ps) AND i + k - 1 <= len(ps)),
worded AS (SELECT doc_id, u, regexp_extract_all({LOWER.format("u")}, '[a-z0-9]+') AS w FROM units),
grams AS (SELECT doc_id, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g FROM worded),
tw AS (SELECT license, regexp_extract_all({LOWER.format("text")}, '[a-z0-9]+') AS w FROM t),
tg AS (SELECT license, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g FROM tw),
scored AS (SELECT doc_id, license, 2 * len(list_intersect(a.g, b.g)) AS common, len(a.g) + len(b.g) AS total
           FROM grams a JOIN tg b ON 2 * least(len(a.g), len(b.g)) >= 0.8 * (len(a.g) + len(b.g)))
SELECT doc_id, license, max(CAST(common AS DOUBLE) / CAST(total AS DOUBLE)) AS score, count(*) AS passages
FROM scored WHERE common >= 0.8 * total GROUP BY doc_id, license
"""


@query("op1_license_scan", LICENSES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


LINES_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM split),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {BLANKS})")} AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
           GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, s.key IS NOT NULL AND s.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op3_line_dedup", LINES_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    rows = bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""


@query("op6_top_k", TOP_K_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.where("vec_id % 20 = 0"), rows)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.classify(docs, toxicity.trained_on_labels(spark, sf_dir))
    return rows.select("doc_id", (toxicity.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                       (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(F.col("doc_id"), 5) == 0
    rows = langid.identify(docs, langid.train(docs.where(~held_out)))
    return rows.withColumnRenamed("id", "doc_id").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score", "first_word", "last_word")


@query("op7_html_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_text.extract(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN first END AS refers_to
FROM f
"""


@query("op8_warc", WARC_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive_round_trip(table(spark, sf_dir, "pages")).where("error is null")
    return rows.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("type").alias("record_type"), warc.page_of(F.col("refers_to")).alias("refers_to"))


@query("op12_sentencepiece")
def op12(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    rows = spm.encode_decode(table(spark, sf_dir, "documents"), model_file or public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])) AS BIGINT) AS score
      FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", negatives.moved_label(F.col("label"), F.col("vec_id")).alias("label"))
    return negatives.mine(rows.where("vec_id % 100 = 0"), rows)


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("bigint"))
