"""The operators' registered queries, each over its whole table with production parameters, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scoped
from . import (bpe, chat_pairs, clean_rules, cover_tree, host_reputation, impact_search, line_dedup, lm_mixing,
               mixing, oracles, quality_model, simhash, turn_repair, warc)
from .common import table, unsigned_crc_mod


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by context mixing, and by the unigram base model."""
    doc = F.col("doc_id")
    held_out = F.coalesce(unsigned_crc_mod(doc, 5) == 1, F.lit(False))
    in_fit = F.coalesce(F.crc32(F.concat(F.lit("f"), doc.cast("string")).cast("binary")) % 2 == 0, F.lit(False))
    scored = lm_mixing.score(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out, in_fit)
    return scored.withColumn("held_out", held_out)


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference examples of all conversations, each against its neighbour's last answer."""
    pairs = chat_pairs.format_preferences(*chat_pairs.answer_swaps(table(spark, sf_dir, "conversations")))
    return pairs.withColumnRenamed("pair_id", "conv_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary_path: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """Byte-level BPE of every document, decoded again."""
    import public_tokenizers
    vocab = bpe.vocabulary(spark, vocabulary_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocab, pattern or public_tokenizers.PATTERN)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels are learnt outside the held-out quarter."""
    held_out = F.coalesce(unsigned_crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    scored = quality_model.score(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that belong to runs repeating an earlier document's, or an earlier place's, lines."""
    marked = line_dedup.mark_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "n_lines", "n_removed", "removed_words",
                         F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.9."""
    found = cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_rules.clean(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "base_failed", "lost_words", "kept")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents to the sources' target weights."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as a content-addressed WARC archive and read back."""
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
                          "payload_digest", "record_type", "refers_to")


def op11_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return impact_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by rule or by its host's reputation."""
    judged = host_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and their cheapest repair."""
    given = table(spark, sf_dir, "conversations")
    return turn_repair.repair_all(given, turn_repair.damage(given))


QUERIES = {
    "op1_context_mixing": op1_context_mixing,
    "op2_preference_pairs": op2_preference_pairs,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_cover_tree": op7_cover_tree,
    "op8_quality_rules": op8_quality_rules,
    "op9_source_mix": op9_source_mix,
    "op10_warc_archive": op10_warc_archive,
    "op11_impact_search": op11_impact_search,
    "op12_host_reputation": op12_host_reputation,
    "op13_turn_repair": op13_turn_repair,
}

QUERIES = {name: scoped(query) for name, query in QUERIES.items()}  # tables that no result reads are deleted

_WORDS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+'))"

ORACLE: dict[str, str] = {
    "op11_impact_search": oracles.IMPACT_SEARCH,
    "op12_host_reputation": oracles.HOST_REPUTATION,
    "op13_turn_repair": oracles.TURN_REPAIR,
    "op9_source_mix": oracles.SOURCE_MIX,
    "op2_preference_pairs": """
WITH t AS (SELECT conv_id, turn, role, text FROM conversations),
last AS (
  SELECT conv_id, max(turn) AS stop, arg_max(text, turn) AS answer FROM t WHERE role = 'assistant' GROUP BY conv_id),
c AS (
  SELECT t.conv_id, t.turn, t.role, t.text, l.stop FROM t LEFT JOIN last l ON t.conv_id = l.conv_id
  WHERE l.stop IS NULL OR t.turn <= l.stop),
sides AS (
  SELECT conv_id, 'chosen' AS side, turn, role, text FROM c
  UNION ALL
  SELECT c.conv_id, 'rejected', c.turn, c.role, CASE WHEN c.turn = c.stop THEN o.answer ELSE c.text END
  FROM c LEFT JOIN last o ON o.conv_id = xor(c.conv_id, 1)
  WHERE c.stop IS NULL OR c.turn < c.stop OR o.conv_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn) AS k FROM sides),
split AS (
  SELECT conv_id, min(k) FILTER (n < 2 OR kinds > 1) AS at
  FROM (SELECT conv_id, k, count(*) AS n, count(DISTINCT (role, text)) AS kinds FROM k GROUP BY conv_id, k)
  GROUP BY conv_id),
seg AS (
  SELECT k.conv_id, CASE WHEN s.at IS NULL OR k.k < s.at THEN 'prompt' ELSE side END AS part, side, k.k, k.role,
         '<|' || replace(k.role, '<|', '< |') || '|>' || chr(10) AS head,
         replace(k.text, '<|', '< |') || '<|end|>' AS body
  FROM k JOIN split s ON k.conv_id = s.conv_id),
placed AS (
  SELECT *, head || body || chr(10) AS rendered,
         coalesce(sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, part, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + length(head) AS first
  FROM seg WHERE part <> 'prompt' OR side = 'chosen')
SELECT conv_id, count(*) FILTER (part = 'prompt') AS n_prompt_turns,
       coalesce(string_agg(rendered, '' ORDER BY k) FILTER (part = 'prompt'), '') AS prompt,
       coalesce(string_agg(rendered, '' ORDER BY k) FILTER (part = 'chosen'), '') AS chosen,
       coalesce(string_agg(CAST(first AS BIGINT) || '-' || CAST(first + length(body) AS BIGINT), ',' ORDER BY k)
                FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(rendered, '' ORDER BY k) FILTER (part = 'rejected'), '') AS rejected,
       coalesce(string_agg(CAST(first AS BIGINT) || '-' || CAST(first + length(body) AS BIGINT), ',' ORDER BY k)
                FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id""",
    "op5_line_dedup": f"""
WITH raw AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT *, CAST({_WORDS.format('line')} AS BIGINT) AS w FROM raw),
ln AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS e FROM counted WHERE w > 0),
win AS (
  SELECT doc_id, i AS a, max(i) OVER f AS b, max(e) OVER f - (e - w) >= 50 AS ok, list(line) OVER f AS content
  FROM ln WINDOW f AS (PARTITION BY doc_id ORDER BY e - w RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, min(i) OVER p, i, e - min(e - w) OVER p >= 50, list(line) OVER p
  FROM ln WINDOW p AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
ranked AS (
  SELECT doc_id, a, b, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS nth FROM win WHERE ok),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS i FROM ranked WHERE nth > 1),
lines AS (
  SELECT c.doc_id, c.i, c.line, c.w, g.i IS NOT NULL AS gone
  FROM counted c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.i = g.i)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       CAST(coalesce(sum(w) FILTER (gone), 0) AS BIGINT) AS removed_words,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM lines GROUP BY doc_id""",
    "op7_cover_tree": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL),
u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE list_dot_product(e, e) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9e0),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
d AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(d.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN d ON d.a = e.vec_id""",
    "op10_warc_archive": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hx FROM pages),
d AS (
  SELECT page_id, html, hx, CAST(strlen(html) AS BIGINT) AS payload_bytes,
         min(page_id) OVER (PARTITION BY hx) AS first_id FROM p),
g AS (
  SELECT page_id, g AS i, CAST(('0x' || substr(hx, 5 * CAST(g AS INTEGER) + 1, 5)) AS INTEGER) AS v
  FROM d, range(8) r(g)),
b AS (
  SELECT page_id, string_agg(
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) % 32 + 1, 1) ||
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1) ||
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) ||
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1), '' ORDER BY i) AS payload_digest
  FROM g GROUP BY page_id)
SELECT d.page_id, payload_bytes, payload_digest,
       CASE WHEN d.page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d JOIN b ON d.page_id = b.page_id""",
}
