"""Queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import audit, chat, decontam, fim, langid, licenses, neardup, packing, quality, rans, secrets, toxicity, warc
from tidewater.llm.common import read
from tidewater.session import apply_core_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_core_conf(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, Jaccard 0.85; no SQL: all pairs of whole texts are too slow there."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids of ``word_bpe_49k.json``; SQL has no tokenizer."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows of ``benchmark``; SQL over all word positions of whole tables is too slow."""
    found = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are sources, repositories are documents; SQL has no leftmost non-overlapping match positions."""
    rows = secrets.scan(read(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = rows.withColumn("base", F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex")))
    return base.select("row.doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.listed("base"), 256).alias("base_sha256"),
                       secrets.listed("spans").alias("spans"),
                       F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
                       F.size(F.filter("spans", lambda s: s["random"] & ~s["live"])).cast("long").alias("n_copied"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the labels call good."""
    return read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted are the documents labelled good, copies count once; SQL elsewhere lacks the bucket hash."""
    judged = quality.judge(read(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir), distinct_texts=True)
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "score")


#: The digest's 40 hexadecimal digits in four groups of 40 bits, each written as eight digits of base 32.
_WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS holder,
         list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST(((('0x' || substr(hex, CAST(i // 8 AS INT) * 10 + 1, 10))::BIGINT >> CAST(35 - 5 * (i % 8) AS INT)) & 31) AS INT) + 1,
                  1)), 'string_agg', '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM d
"""


@query("op8_warc_dictionary_archive", _WARC_SQL)
def op8_warc_dictionary_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over whole texts; SQL elsewhere lacks the look-arounds of the patterns."""
    return licenses.scan(read(spark, sf_dir, "documents")).drop("detections")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained outside the held-out fold; held-out accuracy stands in for SQL."""
    docs = read(spark, sf_dir, "documents")
    fold = langid.bucket(F.col("doc_id"), 4)
    network = langid.fit(docs.filter(fold != 2))
    return langid.identify(docs, network).select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op3_toxicity_weak_supervision")
def op3_toxicity_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns outside the held-out fold; held-out accuracy stands in for SQL."""
    fold = langid.bucket(F.col("doc_id"), 5)
    scored = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), fold != 0)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


_TURN = "'<|' || coalesce(role, '') || '|>' || chr(10) || coalesce({text}, '') || '<|end|>' || chr(10)"
_CHAT_SQL = f"""
WITH last AS (
  SELECT conv_id, max(turn) AS last, max_by(text, turn) AS reply FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), head AS (
  SELECT c.conv_id, l.last, l.reply, o.conv_id IS NOT NULL AS answered, o.reply AS other,
         count(*) FILTER (l.last IS NULL OR c.turn < l.last) AS n_head,
         coalesce(string_agg({_TURN.format(text='c.text')}, '' ORDER BY c.turn)
                  FILTER (l.last IS NULL OR c.turn < l.last), '') AS head
  FROM conversations c LEFT JOIN last l USING (conv_id) LEFT JOIN last o ON o.conv_id = xor(c.conv_id, 1)
  GROUP BY ALL
), made AS (
  SELECT *, last IS NOT NULL AND answered AND reply IS NOT DISTINCT FROM other AS equal,
         CASE WHEN last IS NULL THEN '' ELSE {_TURN.replace("coalesce(role, '')", "'assistant'").format(text='reply')} END AS mine,
         CASE WHEN last IS NULL OR NOT answered THEN '' ELSE {_TURN.replace("coalesce(role, '')", "'assistant'").format(text='other')} END AS theirs
  FROM head
)
SELECT conv_id, n_head + CASE WHEN equal THEN 1 ELSE 0 END AS n_prompt_turns,
       head || CASE WHEN equal THEN mine ELSE '' END AS prompt,
       CASE WHEN equal THEN '' ELSE mine END AS chosen,
       CASE WHEN equal THEN '' ELSE theirs END AS rejected,
       CASE WHEN equal OR mine = '' THEN '' ELSE '14:' || (length(mine) - 1) END AS chosen_mask,
       CASE WHEN equal OR theirs = '' THEN '' ELSE '14:' || (length(theirs) - 1) END AS rejected_mask
FROM made
"""


@query("op5_preference_formatting", _CHAT_SQL)
def op5_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against the reply of its neighbour."""
    made = chat.format_preferences(chat.reply_pairs(read(spark, sf_dir, "conversations")))
    return made.select(F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", "rejected",
                       chat.spans_text("chosen_mask").alias("chosen_mask"), chat.spans_text("rejected_mask").alias("rejected_mask"))


_FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), d AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:], '') AS suffix
  FROM d
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query("op13_fill_in_middle", _FIM_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents arranged, four fifths of them suffix first; each rebuilt from its output."""
    made = fim.transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return fim.restore(made).select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query("op11_rans_token_files")
def op11_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written and read back; SQL has no tokenizer."""
    folder, manifest = rans.write(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rans.read(folder, manifest)


_AUDIT_SQL = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), l AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM t LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
), s AS (
  SELECT c.*, filter_order, step, substr(filter_order, CAST(step AS INT), 1) AS f,
         len(regexp_replace(substr(filter_order, 1, CAST(step - 1 AS INT)), '[^' || fails || '_]', '', 'g')) > 0 AS earlier,
         contains(fails, substr(filter_order, CAST(step AS INT), 1)) AS bad
  FROM c, orders, range(1, 6) AS r(step)
), r AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, any_value(f) AS f,
         CAST(coalesce(sum(n) FILTER (NOT earlier AND NOT bad), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT earlier AND bad), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (earlier AND bad), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (fails = f), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (NOT earlier AND bad), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (NOT earlier AND bad), 0) AS BIGINT) AS toxic_lost
  FROM s GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""


@query("op12_filter_interaction_audit", _AUDIT_SQL)
def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the documents through the stream, then every order of the five filters."""
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    return audit.interactions(audit.counters(spark, path, read(spark, sf_dir, "labels")))
