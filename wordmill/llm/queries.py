"""The training-data operators as queries over the given tables, with DuckDB
SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import chat, exact_dedup, license_scan, line_dedup, mixing, near_dedup, packing, pieces, pii, quality, repair, search, simhash
from wordmill.llm.common import table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def hex_sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", hex_sha256(F.col("text")).alias("kept_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = exact_dedup.dedup_exact(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return done.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    words = F.transform(base, lambda p: p["word"])
    return done.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        license_scan.labels(base_only=True).alias("base_labels"),
        license_scan.labels().alias("labels"),
        "score",
        license_scan.strictest("level").alias("license_level"),
        license_scan.strictest("reduced").alias("license_expression"),
    )


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, pii.pii_key(spark)).select("doc_id", "n_pii", "pii", "text")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = near_dedup.mark_near_duplicates(docs, words=3, percent=85)
    return done.select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    done = quality.score_quality(docs, model)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return done.select("doc_id", *counts, "base_failed", "kept", "probability")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    proto = pieces.read_model(PIECE_MODEL)
    done = pieces.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), proto)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


# A conversation whose texts look like the template's own control strings.
HOSTILE_ID = -7
HOSTILE_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = [(HOSTILE_ID, 0, "user", HOSTILE_TEXT), (HOSTILE_ID, 1, "assistant", HOSTILE_TEXT)]
    turns = turns.unionByName(spark.createDataFrame(hostile, turns.schema))
    examples = chat.expand_examples(turns)
    read = examples.select(
        "conv_id",
        "example",
        F.length("formatted").cast("bigint").alias("chars"),
        chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
        F.when(F.col("whole"), chat.read_turns(F.col("formatted"))).alias("turns"),
    )
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    said = F.first("turns", ignorenulls=True)
    talks = read.groupBy("conv_id").agg(
        said.alias("turns"), loss.alias("loss"), F.sum("chars").alias("formatted_chars")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return talks.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        hex_sha256(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        hex_sha256(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


MIX_SHARE = 0.5


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, mixing.document_levels(), mixing.DOCUMENT_WEIGHTS, share=MIX_SHARE)
    return mixed.select("doc_id", "lang", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("estimated_tokens"))


END_ID = 2  # </s> of the piece model


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_texts(docs, pieces.read_model(PIECE_MODEL), end_id=END_ID)


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.mark_similar(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.repair_report(repair.damaged(turns), turns)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_pii_pseudonyms": op4_pii_pseudonyms,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_chat_format": op8_chat_format,
    "op9_source_mixing": op9_source_mixing,
    "op10_packed_ids": op10_packed_ids,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op1_line_dedup": r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split
), keyed AS (
  SELECT doc_id, place, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.place, k.line, r.key IS NOT NULL AND k.doc_id < r.keeper AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op2_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
""",
    "op8_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 4 + length(regexp_replace(role, '([\\<#:])', '\\\1', 'g')) + 2
      + length(regexp_replace(text, '([\\<#:])', '\\\1', 'g')) + 8 AS chars,
    role = 'assistant' OR row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS example
  FROM turns
), grown AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (WHERE example))::BIGINT AS formatted_chars
FROM grown GROUP BY conv_id
""",
    "op9_source_mixing": r"""
WITH based AS (
  SELECT doc_id, lang, source,
    coalesce('domain' || (try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS BIGINT) % 4), 'unknown') AS d,
    coalesce(lang, 'unknown') AS l, coalesce(source, 'unknown') AS s,
    (strlen(coalesce(text, '')) + 3) // 4 AS tokens
  FROM documents
), leaves AS (
  SELECT d, l, s, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * 3 AS cap FROM based GROUP BY d, l, s
), w1 AS (
  SELECT d, sum(cap)::BIGINT AS cap,
    CASE d WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END::BIGINT AS weight
  FROM leaves GROUP BY d
), b1 AS (
  SELECT *, least((SELECT floor(sum(tokens) * 0.5)::BIGINT FROM leaves), (SELECT sum(cap)::BIGINT FROM leaves)) AS budget FROM w1
), r1 AS (
  SELECT *, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS rest_w, budget - coalesce(sum(cap) OVER b, 0) AS rest_b
  FROM b1 WINDOW b AS (ORDER BY cap / weight, d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f1 AS (
  SELECT d, CASE WHEN cap * rest_w <= weight * rest_b THEN cap
    ELSE (weight * max(rest_b) FILTER (WHERE cap * rest_w > weight * rest_b) OVER ())
      // max(rest_w) FILTER (WHERE cap * rest_w > weight * rest_b) OVER () END AS budget
  FROM r1
), w2 AS (
  SELECT d, l, sum(cap)::BIGINT AS cap,
    CASE l WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END::BIGINT AS weight
  FROM leaves GROUP BY d, l
), r2 AS (
  SELECT w2.*, budget, sum(weight) OVER (PARTITION BY d) - coalesce(sum(weight) OVER b, 0) AS rest_w,
    budget - coalesce(sum(cap) OVER b, 0) AS rest_b
  FROM w2 JOIN f1 USING (d)
  WINDOW b AS (PARTITION BY d ORDER BY cap / weight, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f2 AS (
  SELECT d, l, CASE WHEN cap * rest_w <= weight * rest_b THEN cap
    ELSE (weight * max(rest_b) FILTER (WHERE cap * rest_w > weight * rest_b) OVER (PARTITION BY d))
      // max(rest_w) FILTER (WHERE cap * rest_w > weight * rest_b) OVER (PARTITION BY d) END AS budget
  FROM r2
), r3 AS (
  SELECT leaves.*, budget, count(*) OVER (PARTITION BY d, l) - coalesce(count(*) OVER b, 0) AS rest_w,
    budget - coalesce(sum(cap) OVER b, 0) AS rest_b
  FROM leaves JOIN f2 USING (d, l)
  WINDOW b AS (PARTITION BY d, l ORDER BY cap, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f3 AS (
  SELECT d, l, s, tokens, CASE WHEN cap * rest_w <= rest_b THEN cap
    ELSE max(rest_b) FILTER (WHERE cap * rest_w > rest_b) OVER (PARTITION BY d, l)
      // max(rest_w) FILTER (WHERE cap * rest_w > rest_b) OVER (PARTITION BY d, l) END AS budget
  FROM r3
), plan AS (
  SELECT d, l, s, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END::BIGINT AS whole,
    (budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens)::BIGINT AS rest
  FROM f3
), keyed AS (
  SELECT doc_id, lang, source, d, l, s, tokens, whole, rest,
    md5('20240229/' || whole || '/' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM based JOIN plan USING (d, l, s)
), run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY d, l, s ORDER BY key) AS upto FROM keyed
)
SELECT doc_id, lang, source, unnest(CASE WHEN whole < 3 AND upto <= rest THEN range(whole + 1) ELSE range(whole) END) AS epoch,
  tokens::BIGINT AS estimated_tokens
FROM run
""",
    "op12_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), counted AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0
), total AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM counted
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), held AS (
  SELECT r, doc_id, n, unnest(terms) AS term FROM counted
), placed AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM held SEMI JOIN asked USING (term) GROUP BY ALL
), weighed AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM placed, total GROUP BY term, nd
), scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nt))))::BIGINT AS score
  FROM placed JOIN weighed USING (term) JOIN asked USING (term), total GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
