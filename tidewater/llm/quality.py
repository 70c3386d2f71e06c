"""Quality rules: simple document statistics and a hashed n-gram log-likelihood ratio.

Unigrams and bigrams of every document are hashed into a fixed number of
buckets.  Two multinomials are counted over all documents: the raw corpus and
its trusted part (documents labelled as good).  A document's score is the mean
over its n-grams of log(trusted / raw); the same threshold holds for every
document.  Copies of a text can share the weight of one document, so that no
group of copies moves the verdict on others.  All of it is DataFrame and SQL
functions.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_up_to, written

BUCKETS = 8192  # for each n-gram order
SHRINKAGE = 30.0
THRESHOLD = -0.08
BROADCAST_IDS = 2_000_000
BROADCAST_COPIED = 2_000_000
_SPACE = r"[\\x20\\x09-\\x0D]"


def _rows(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows as the struct ``row`` with their words; a null text has none."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                         F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    return packed.withColumn("words", F.expr(f"array_remove(split(text, '{_SPACE}+', -1), '')"))


def _hashes(rows: DataFrame) -> DataFrame:
    """``h1`` and ``h2``: 64-bit hashes of the words and of the pairs of neighbours."""
    one = rows.withColumn("h1", F.expr("transform(words, w -> xxhash64(w))"))
    return one.withColumn("h2", F.expr("transform(slice(h1, 1, greatest(size(h1) - 1, 0)), (h, i) -> xxhash64(h, get(h1, i + 1)))"))


def _copied(grams: DataFrame) -> DataFrame:
    """(copied_text, copies, trusted_copy) of every text that several rows have; trusted if one of them is."""
    return (grams.select(F.xxhash64("text").alias("copied_text"), F.col("trusted_id").isNotNull().alias("trusted"))
            .groupBy("copied_text").agg(F.count("*").alias("copies"), F.bool_or("trusted").alias("trusted_copy"))
            .filter("copies > 1"))


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        distinct_texts: bool = False) -> list[float]:
    """Weights log(trusted / raw) of the 2 * BUCKETS n-gram buckets, counted over all documents.

    ``trusted`` holds the ids (``doc_id``) of the trusted documents.  A bucket's
    ratio is shrunk towards 1 by SHRINKAGE expected n-grams.  With
    ``distinct_texts`` every text counts once, however many rows have it, and
    is trusted if one of them is: n copies count 1 / n each.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).filter("trusted_id is not null").distinct()
    ids = broadcast_up_to(ids, BROADCAST_IDS)
    rows = _rows(docs, text_col).join(ids, F.col(f"row.`{id_col}`").cast("long") == F.col("trusted_id"), "left")
    if distinct_texts:
        copied = broadcast_up_to(written(_copied(rows), "quality-copied"), BROADCAST_COPIED)
        rows = rows.join(copied, F.xxhash64("text") == F.col("copied_text"), "left")
        weight, good = F.expr("1D / coalesce(copies, 1L)"), F.coalesce("trusted_copy", F.col("trusted_id").isNotNull())
    else:
        weight, good = F.lit(1.0), F.col("trusted_id").isNotNull()
    marked = _hashes(rows.withColumns({"weight": weight, "good_weight": F.when(good, weight).otherwise(0.0)}))
    # the sums are whole numbers but for the rounding of 1 / n
    counts = (marked.select("weight", "good_weight", F.explode(F.expr(
        f"concat(transform(h1, h -> cast(pmod(h, {BUCKETS}) as int)), transform(h2, h -> cast(pmod(h, {BUCKETS}) as int) + {BUCKETS}))"))
        .alias("bucket")).groupBy("bucket").agg(F.round(F.sum("weight")).alias("raw"), F.round(F.sum("good_weight")).alias("good")).collect())
    raw, good = sum(r.raw for r in counts), sum(r.good for r in counts)
    share = good / raw if raw else 0.0
    weights = [0.0] * (2 * BUCKETS)
    for r in counts:
        weights[r.bucket] = math.log((r.good + SHRINKAGE) / (r.raw * share + SHRINKAGE)) if good else 0.0
    return weights


def _repeated(tri: str) -> Column:
    """Words inside 3-word windows that occur twice or more, from the windows' hashes in order."""
    return F.expr(f"""
        case when size(array_distinct({tri})) = size({tri}) then 0L else
          aggregate(
            transform(
              array(sort_array(transform(
                array(sort_array(transform({tri}, (x, i) -> struct(x, i)))),
                s -> filter(transform(s, (e, k) -> if(e.x = get(s, k - 1).x or e.x = get(s, k + 1).x, e.i, null)),
                            i -> i is not null))[0])),
              m -> transform(m, (p, k) -> least(3, coalesce(get(m, k + 1) - p, 3))))[0],
            0L, (total, x) -> total + x)
        end""")


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text", distinct_texts: bool = False) -> DataFrame:
    """One row per row of ``docs``: its columns as the struct ``row``, the statistics, the score and the verdict.

    (row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept).  Words lie between ASCII white space.
    ``base_failed``: fewer than 50 words, or more than half of them inside
    repeated 3-word windows.  ``kept``: not ``base_failed`` and a score of at
    least ``threshold``.

    A null, empty or wordless text has zeros, score 0 and fails the base rule.
    Repeated rows each get their row, with the same verdict.  Without trusted
    documents every score is 0.  With ``distinct_texts`` the copies of a text
    count as one document in the multinomials; every row is still judged.  Extra
    columns are only carried in ``row``; an empty table gives no rows.  Windows
    and texts are told apart by 64-bit hashes.
    """
    weights = F.from_json(F.lit(json.dumps(fit(docs, trusted, id_col, text_col, distinct_texts))), "array<double>")
    rows = _hashes(_rows(docs, text_col))
    rows = rows.withColumn("lines", F.expr(rf"filter(split(text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    stats = rows.select(
        "row", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(slice(h2, 1, greatest(size(h2) - 1, 0)), (h, i) -> xxhash64(h, get(h1, i + 2)))").alias("tri"),
        (_total("h1", weights, 0) + _total("h2", weights, BUCKETS)).alias("sum_of_weights"))
    # The generator keeps filters on the verdict above it: pushed below, they would repeat the work of every projection.
    judged = stats.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.explode(F.array(F.struct(
        _repeated("tri").alias("n_repeat_words"), F.expr("sum_of_weights / greatest(2 * n_words - 1, 1)").alias("score")))).alias("j"))
    judged = judged.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "j.n_repeat_words", "j.score")
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return judged.select("*", failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"))


def _total(hashes: str, weights: Column, offset: int) -> Column:
    return F.aggregate(hashes, F.lit(0.0), lambda total, h: total + F.get(weights, F.pmod(h, F.lit(BUCKETS)).cast("int") + offset))
