"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns of the two conversations is rendered once
as the prompt; the turns after it are the completions.  A completion carries a
mask of the stretches that count for training: the words of the assistant and
the mark that ends its turn.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches

END = "<|end|>\n"
TRAINED_ROLE = "assistant"
IGNORED = 0


def rendered(role: Column, text: Column) -> Column:
    """One turn as text; a null role or text is empty."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit(END))


def _sides(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): each side's turns in order."""
    turn = F.struct("turn", "role", "text")

    def side(name: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("side") == name, turn))).alias(name)

    return turns.groupBy("pair_id").agg(side("chosen"), side("rejected"))


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair of the long table (pair_id, side, turn, role, text).

    (pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask): masks are arrays of (start, end) in characters of their
    completion, end exclusive.  ``side`` is ``chosen`` or ``rejected``; turns
    go by number, then role and text, so repeated turn numbers have an order.
    Turns are equal when role and text are (null equals null).

    Equal conversations are all prompt, with empty completions; a missing side
    leaves an empty prompt and an empty completion.  Null roles and texts read
    as empty, empty texts keep their frame.  Other columns are ignored; an empty
    table gives no rows.
    """
    pairs = _sides(turns.select("pair_id", "side", F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")))
    same = F.expr("""zip_with(slice(chosen, 1, least(size(chosen), size(rejected))), slice(rejected, 1, least(size(chosen), size(rejected))),
                              (c, r) -> c.role <=> r.role and c.text <=> r.text)""")
    first = F.array_position(same, F.lit(False))
    shared = F.when(first > 0, first - 1).otherwise(F.least(F.size("chosen"), F.size("rejected"))).cast("int")
    pairs = pairs.withColumn("shared", shared)

    def completion(name: str) -> Column:
        return F.slice(name, F.col("shared") + 1, F.greatest(F.size(name) - F.col("shared"), F.lit(0)))

    out = pairs.select("pair_id", "shared", F.slice("chosen", F.lit(1), F.col("shared")).alias("head"),
                       completion("chosen").alias("chosen"), completion("rejected").alias("rejected"))
    return out.select("pair_id", F.col("shared").cast("long").alias("n_prompt_turns"), _text("head").alias("prompt"),
                      _text("chosen").alias("chosen"), _text("rejected").alias("rejected"),
                      _mask("chosen").alias("chosen_mask"), _mask("rejected").alias("rejected_mask"))


def _text(turns: str) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")


def _mask(turns: str) -> Column:
    """(start, end) of the trained stretches: each turn's place is the length of the turns before it."""
    sizes = F.transform(turns, lambda t: F.struct(
        F.length(rendered(t["role"], t["text"])).alias("all"),
        (F.length(F.coalesce(t["text"], F.lit(""))) + len(END) - 1).alias("own"),
        F.coalesce(t["role"] == TRAINED_ROLE, F.lit(False)).alias("trained")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        end = state["at"] + turn["all"] - 1
        span = F.struct((end - turn["own"]).alias("start"), end.alias("end"))
        return F.struct((state["at"] + turn["all"]).alias("at"),
                        F.when(turn["trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(sizes, start, add, lambda state: state["spans"])


def spans_text(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")


def tokenize(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Adds token ids and 0/1 masks: prompt_ids, chosen_ids, chosen_mask_ids, rejected_ids, rejected_mask_ids.

    Masked and unmasked stretches are encoded apart, so no token crosses a
    mask's edge; special strings of the tokenizer are ordinary text.
    """
    from pyspark.sql import types as T

    ids = T.ArrayType(T.IntegerType())
    names = ["prompt_ids", "chosen_ids", "chosen_mask_ids", "rejected_ids", "rejected_mask_ids"]
    schema = T.StructType([*formatted.schema.fields, *[T.StructField(n, ids) for n in names]])
    columns = formatted.columns
    at = {c: i for i, c in enumerate(columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(tokenizer)
        coder.encode_special_tokens = True

        def encode(text: str) -> list[int]:
            return coder.encode(text, add_special_tokens=False).ids if text else []

        def masked(text: str, spans: list[dict]) -> tuple[list[int], list[int]]:
            out, mask, end = [], [], 0
            for s in spans:
                for part, trained in ((text[end:s["start"]], 0), (text[s["start"]:s["end"]], 1)):
                    piece = encode(part)
                    out += piece
                    mask += [trained] * len(piece)
                end = s["end"]
            piece = encode(text[end:])
            return out + piece, mask + [IGNORED] * len(piece)

        for batch in batches:
            made: list[list] = [[] for _ in names]
            sides = [batch.column(at[c]).to_pylist() for c in ("prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")]
            for prompt, chosen, cm, rejected, rm in zip(*sides, strict=True):
                for i, v in enumerate([encode(prompt), *masked(chosen, cm), *masked(rejected, rm)]):
                    made[i].append(v)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(m, pa.list_(pa.int32())) for m in made]],
                                             names=[*columns, *names])

    return small_batches(formatted).mapInArrow(run, schema)


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs of a table of single conversations (conv_id, turn, role, text), in long form.

    A conversation up to its last assistant turn is chosen; rejected are the
    same turns with that reply exchanged for the last reply of the conversation
    with the neighbouring id (``conv_id`` xor 1), or without it if there is
    none.  A conversation without an assistant turn stands whole on both sides.
    Turns without ``conv_id`` belong to no conversation and are left out.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).filter("pair_id is not null")
    last = (rows.filter(F.col("role") == TRAINED_ROLE).groupBy("pair_id")
            .agg(F.max(F.struct("turn", "text")).alias("reply")).select("pair_id", F.col("reply.turn").alias("last"), F.col("reply.text").alias("reply")))
    other = last.select(F.expr("pair_id ^ 1").alias("pair_id"), F.struct("reply").alias("other"))
    joined = rows.join(last.select("pair_id", "last"), "pair_id", "left").filter("last is null or turn <= last").join(other, "pair_id", "left")
    chosen = joined.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    replaced = F.expr(f"last is not null and turn = last and role = '{TRAINED_ROLE}'")
    rejected = joined.filter(F.coalesce(~replaced, F.lit(True)) | F.col("other").isNotNull()).select(
        "pair_id", F.lit("rejected").alias("side"), "turn", "role",
        F.when(replaced, F.col("other.reply")).otherwise(F.col("text")).alias("text"))
    return chosen.unionByName(rejected)
