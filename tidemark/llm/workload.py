"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from tidemark import files
from tidemark.llm import chat, exact_dedup, filter_audit, line_dedup, mixing, packing, periodic_runs, repair, sharding, simhash, topk, toxicity, warc


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).drop("row_no")


def op2_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, _table(spark, sf_dir, "labels")).drop("text")


def op3_best_fit_packing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.tokenised(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # the digest is taken before the pieces move
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op4_warc_revisits(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = files.scratch(spark, "warc")
    warc.write(warc.resolve(pages), path)
    return warc.with_referred(warc.read(spark, path, with_payload=False)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_exact_top_k(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


# shares of words in the mixture; the languages are the domains
MIXTURE = {"de": 0.175, "en": 0.5, "es": 0.125, "fr": 0.2}


def languages(docs, labels):
    """(key, domain) of the labelled documents of good quality."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    return docs.join(good, "doc_id", "left_semi").select(F.col("doc_id").alias("key"), F.col("lang").alias("domain"))


def op6_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = languages(docs, _table(spark, sf_dir, "labels"))
    return mixing.mix(docs.drop("lang"), labelled, MIXTURE, keep_text=False)


def op7_exact_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs, keep_text=False)


def op8_sharding(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard(docs, sharding.byte_size(F.col("text")), [F.col("doc_id")], shards=40)
    return placed.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_chat_windows(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.windows(turns, limit=chat.BUDGET))


def op10_simhash(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_groups(docs, keep_text=False).select("doc_id", "fingerprint", "component_id")


def op11_token_ids(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = files.scratch(spark, "token-ids")
    repair.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return repair.read(spark, path).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_periodic_runs(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(docs)))


def op13_filter_audit(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.quality_audit(docs, _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_toxicity, op3_best_fit_packing, op4_warc_revisits, op5_exact_top_k, op6_mixing, op7_exact_dedup, op8_sharding,
        op9_chat_windows, op10_simhash, op11_token_ids, op12_periodic_runs, op13_filter_audit,
    )
}



def _escaped(text: str) -> str:
    """SQL for the text as a template writes it."""
    out = f"replace({text}, chr(92), chr(92) || '0')"
    for code, controls in (("1", ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>")), ("2", ("[INST]", "[/INST]"))):
        for c in controls:
            out = f"replace({out}, '{c}', chr(92) || '{code}{c[1:]}')"
    return out


ORACLE = {
    "op13_filter_audit": """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d
), l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         concat(CASE WHEN len(words) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > least THEN 'E' END) AS fails
  FROM w LEFT JOIN l USING (doc_id)
), c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT x AS o FROM letters UNION ALL SELECT o || x FROM orders, letters WHERE length(o) < 5 AND NOT contains(o, x)
), s AS (
  SELECT o AS filter_order, step::INT AS step, substr(o, step, 1) AS x, substr(o, 1, step - 1) AS before
  FROM (SELECT o FROM orders WHERE length(o) = 5), range(1, 6) AS r(step)
), m AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS hit,
         before <> '' AND regexp_matches(fails, '[' || CASE before WHEN '' THEN '-' ELSE before END || ']') AS gone
  FROM s, c
), e AS (
  SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = x), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM m GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM e
""",
    "op9_chat_windows": f"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn, ceil(strlen(text) / 4)::BIGINT + 8 AS cost,
         length('<|im_start|>') + length(replace({_escaped('role')}, chr(10), chr(92) || '3')) + 1 + length({_escaped('text')}) + length('<|im_end|>') + 1 AS chars
  FROM all_turns
), placed AS (
  SELECT *, sum(cost) OVER (PARTITION BY conv_id ORDER BY rn) - cost AS pre, sum(cost) OVER (PARTITION BY conv_id) <= {chat.BUDGET} AS whole,
         first_value(role) OVER (PARTITION BY conv_id ORDER BY rn) = 'system' AS lead, first_value(cost) OVER (PARTITION BY conv_id ORDER BY rn) AS first_cost
  FROM numbered
), spaced AS (SELECT *, greatest({chat.BUDGET} - CASE WHEN lead THEN first_cost ELSE 0 END, 1) AS beside FROM placed),
roomy AS (SELECT *, least({chat.BUDGET}, beside - least({chat.HISTORY}, beside // 2)) AS room FROM spaced),
sized AS (SELECT *, (NOT whole AND cost > room / 2)::INT AS large FROM roomy),
counted AS (
  SELECT *, sum(large) OVER (PARTITION BY conv_id ORDER BY rn) - large AS larges,
         coalesce(max(cost) FILTER (large = 0) OVER (PARTITION BY conv_id), 1) AS widest FROM sized
), spans AS (SELECT *, CASE WHEN whole THEN 0 ELSE pre // (room - widest + 1) END + 2 * larges + large AS span FROM counted),
starts AS (
  SELECT conv_id, span, min(pre) AS start, least({chat.HISTORY}, greatest(any_value(beside) - sum(cost), 0)) AS reach FROM spans GROUP BY ALL
), repeated AS (
  SELECT s.conv_id, s.chars FROM spans s JOIN starts n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.pre < n.start AND n.start - s.pre <= n.reach
  WHERE NOT (s.lead AND s.rn = 1)
  UNION ALL
  SELECT s.conv_id, s.chars FROM spans s JOIN starts n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND n.start > 0 WHERE s.lead AND s.rn = 1
), more AS (SELECT conv_id, sum(chars) AS chars FROM repeated GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars) AS chars
  FROM spans GROUP BY conv_id
)
SELECT w.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (w.chars + coalesce(m.chars, 0))::BIGINT AS formatted_chars
FROM whole w LEFT JOIN more m ON w.conv_id IS NOT DISTINCT FROM m.conv_id
""",
    "op5_exact_top_k": """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::DOUBLE FOR x IN embedding] AS t FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.t, c.t)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op4_warc_revisits": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, b, octet_length(b) AS n, sha1(b) AS hex, max(page_id) OVER (PARTITION BY b) AS last FROM p),
d AS (
  SELECT *, list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)) AS c FROM h
)
SELECT page_id, n AS payload_bytes, array_to_string(c, '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d
""",
    "op7_exact_dedup": """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
""",
}
