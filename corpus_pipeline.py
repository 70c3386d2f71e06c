"""The training-corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all the rows it gets and
returns the rows it keeps with the columns of ``documents`` (the last one the
packed pieces); ``run`` writes each result as Parquet and reads it back as the
next stage's input.

Null, empty and very short texts fail the quality rules; the later stages, on
inputs of their own, keep them.  A row without id is judged like any other and
keeps its null.  Repeated rows are judged each; near_dedup keeps one row of an id and
text, and of a group of near duplicates those of the smallest id.  Columns
beyond those of ``documents``, whatever their names, are carried along.  Empty
``documents`` give empty stages; without ``labels`` or ``benchmark`` rows nothing
is trusted or contaminated.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontam, neardup, packing, quality, secrets
from tidewater.llm.common import read, written
from tidewater.llm.queries import trusted_ids
from tidewater.session import apply_core_conf

WINDOW = 13


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality rules keep, unchanged."""
    return quality.judge(docs, trusted_ids(spark, sf_dir), distinct_texts=True).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, Jaccard 0.8), the one with the smallest id."""
    found = neardup.near_duplicates(docs, shingle=5, percent=80, with_text_key=True)
    kept = found.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    rows = docs.select(_row(docs), docs["doc_id"].alias("id"), F.xxhash64(docs["text"].cast("string")).alias("key"))
    joined = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key")), "left_semi")
    return joined.dropDuplicates(["id", "key"]).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents; cuts every hit span of WINDOW or more words out of the others."""
    found = decontam.contamination(docs, read(spark, sf_dir, "benchmark"), WINDOW, max_span=WINDOW - 1)
    return _with_text(found.filter("not contaminated"), "cleaned")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking credentials; keeps every document."""
    return _with_text(secrets.redact(secrets.scan(docs)), "redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _row(docs: DataFrame) -> Column:
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def _with_text(rows: DataFrame, column: str) -> DataFrame:
    """The documents in the struct ``row`` with ``column`` as their text, and its characters counted anew where it differs."""
    fields = rows.schema["row"].dataType.names
    new, old = F.col(column), F.col("row.text")
    out = []
    for c in fields:
        value = F.col("row").getField(c)
        if c == "text":
            value = new
        elif c == "n_chars":
            value = F.when(new.eqNullSafe(old), value).otherwise(F.length(new).cast(rows.schema["row"].dataType[c].dataType))
        out.append(value.alias(c))
    return rows.select(*out)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: SQL has neither the tokenizer nor the hashes of the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_core_conf(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
