"""The registered query of every operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm import (
    conversation_repair, exact_dedup, filter_audit, fingerprints, html_text, language_id, mixing, ngram_join, packing,
    pq_dedup, token_records, toxicity, warc,
)
from lakeshelf.llm.common import table
from lakeshelf.llm.registry import query

OP1 = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), grouped AS (
    SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
    FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM grouped
"""


@query("op1_exact_dedup", OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


OP4 = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5('20:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
           [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source
), placed AS (
    SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM placed WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
    SELECT level FROM levels WHERE level <= cap / weight ORDER BY place LIMIT 1
), targets AS (
    SELECT source, source_size, coalesce(CASE WHEN final.level * weight <= cap THEN final.level * weight ELSE cap END, 0) AS target
    FROM levels LEFT JOIN final ON true
), epochs AS (
    SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole FROM targets
), spots AS (
    SELECT source, h, sum(size) AS words FROM sized GROUP BY source, h
), walked AS (
    SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM spots
), cuts AS (
    SELECT e.source, max(w.h) AS cut
    FROM epochs e JOIN walked w ON e.source IS NOT DISTINCT FROM w.source
    WHERE e.target > e.whole * e.source_size AND w.upto - w.words / 2 <= e.target - e.whole * e.source_size
    GROUP BY e.source
)
SELECT s.doc_id, s.size, e.source_size, CAST(e.target AS DOUBLE) AS target,
       CAST(s.size * (e.whole + CASE WHEN s.h <= c.cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source
LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""


@query("op4_mix_to_targets", OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query("op2_imatch_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op3_html_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, mixing.word_count(F.col("text")))


@query("op6_token_records")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_records.write_and_read(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op10_warc_round_trip")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    read = warc.records(warc.read_archives(archives, with_payload=False))
    return read.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to_id")).alias("refers_to"),
    )


OP7 = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                                        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id
FROM documents d JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY x) m ON m.x = d.doc_id
LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@query("op7_ngram_jaccard_join", OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def _crc(doc_id, parts: int):
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = _crc(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs, ~held_out)
    return language_id.classify(docs, model, "doc_id").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = _crc(F.col("doc_id"), 3) == 1
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held_out)
    return toxicity.score(docs, scorer, "doc_id").select("doc_id", held_out.alias("held_out"), "score", "predicted")


OP11 = r"""
WITH worded AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), firsts AS (
    SELECT coalesce(text, '') AS body, min(doc_id) AS least FROM documents GROUP BY 1
), marks AS (
    SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT d.part, CAST(len(d.w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(d.w)) < 50 * len(d.w) AS INT)
           + 4 * CAST(100 * length(regexp_replace(d.body, '[^A-Z]', '', 'g')) > 2 * length(d.body) AS INT)
           + 8 * CAST(regexp_matches(d.body, '[#$%&*|]') AS INT)
           + 16 * CAST(coalesce(d.doc_id > f.least, false) AS INT) AS fails,
           count(*) AS n, count(*) FILTER (WHERE m.good) AS good, count(*) FILTER (WHERE m.toxic) AS toxic
    FROM worded d JOIN firsts f ON f.body = d.body LEFT JOIN marks m ON m.doc_id = d.doc_id
    GROUP BY 1, 2
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
    SELECT filter_order, CAST(s AS INT) AS step, bits[s] AS own, coalesce(list_sum(bits[1:s - 1]), 0) AS before
    FROM orders, range(1, 6) t(s)
), summed AS (
    SELECT part, filter_order, step, own,
           CAST(sum(n) FILTER (WHERE (fails & CAST(own + before AS INT)) = 0) AS BIGINT) AS kept,
           CAST(sum(n) FILTER (WHERE (fails & own) <> 0 AND (fails & CAST(before AS INT)) = 0) AS BIGINT) AS removed,
           CAST(sum(n) FILTER (WHERE (fails & own) <> 0 AND (fails & CAST(before AS INT)) <> 0) AS BIGINT) AS redundant,
           CAST(sum(n) FILTER (WHERE fails = own) AS BIGINT) AS unique_fails,
           CAST(sum(good) FILTER (WHERE (fails & own) <> 0 AND (fails & CAST(before AS INT)) = 0) AS BIGINT) AS good_lost,
           CAST(sum(toxic) FILTER (WHERE (fails & own) <> 0 AND (fails & CAST(before AS INT)) = 0) AS BIGINT) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
       coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
       coalesce(toxic_lost, 0) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM summed
"""


@query("op11_filter_audit", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damage(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return conversation_repair.summaries(conversation_repair.edits(rows))


OP13 = """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reached AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), grouped AS (
    SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, g.component_id, e.vec_id = g.component_id AS kept
FROM embeddings e JOIN grouped g ON g.x = e.vec_id LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) n ON n.x = e.vec_id
"""


@query("op13_embedding_near_dedup", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
