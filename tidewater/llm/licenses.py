"""Licence scan: ordered signature rules over whole texts, in DataFrame and SQL functions alone.

A text is first tested for any gate word; only a text that has one is tested
for the rules' keywords, and a rule's pattern runs only where its keyword
occurs.  A match's place is the length of the pieces and matches before it,
summed up by a window.  Overlapping detections are resolved per document in
one pass by position: a detection inside the interval of one of higher
priority (or of an equal one that is longer or listed first) is suppressed.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import written
from tidewater.llm.license_rules import KEYWORDS, RULES, gates

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.8
BASE = rf"(?i)(?<!{_WORD})(" + "|".join(rf"{_GAP}+".join(p.split()) for p in PHRASES) + rf")(?!{_WORD})"


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_WORD + "+")).cast("long")


def _rules() -> Column:
    """The rules by keyword, as a constant."""
    groups = [{"keyword": k, "rules": [{"rule": i, "pattern": f"(?i){r.pattern}"} for i, r in enumerate(RULES) if r.keyword == k]}
              for k in KEYWORDS]
    return F.from_json(F.lit(json.dumps(groups)), "array<struct<keyword:string,rules:array<struct<rule:int,pattern:string>>>>")


def _of_rule(field: str, kind: str) -> Column:
    return F.get(F.from_json(F.lit(json.dumps([getattr(r, field) for r in RULES])), f"array<{kind}>"), F.col("rule"))


def _matches(text: Column, plain: Column) -> Column:
    """For each rule that matches: the lengths of the pieces around its matches and of the matches.

    ``plain`` is the text in lower case with runs of white space and hyphens as one blank.
    """

    def tried(rule: Column) -> Column:
        return F.struct(rule["rule"].alias("rule"),
                        F.transform(F.split(text, rule["pattern"], -1), F.length).alias("gaps"),
                        F.transform(F.regexp_extract_all(text, rule["pattern"], F.lit(0)), F.length).alias("hits"))

    usable = F.flatten(F.transform(F.filter(_rules(), lambda g: F.contains(plain, g["keyword"])), lambda g: g["rules"]))
    return F.filter(F.transform(usable, tried), lambda m: F.size(m["hits"]) > 0)


def _placed(found: DataFrame) -> DataFrame:
    """(doc_id, text_key, rule, start, end) of every match, in characters."""
    each = found.select("doc_id", "text_key", F.explode("found").alias("m")).select(
        "doc_id", "text_key", "m.rule", "m.gaps", F.posexplode("m.hits").alias("k", "size"))
    each = each.select("doc_id", "text_key", "rule", "k", "size", F.get("gaps", F.col("k")).alias("gap"))
    upto = Window.partitionBy("doc_id", "text_key", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).select(
        "doc_id", "text_key", "rule", (F.col("end") - F.col("size")).alias("start"), "end")


def resolve(found: DataFrame) -> DataFrame:
    """The placed matches that no other contains: (doc_id, text_key, rule, start, end, label, score)."""
    known = found.select("*", _of_rule("priority", "int").alias("priority"), _of_rule("label", "string").alias("label"),
                         _of_rule("score", "double").alias("score"))
    before = (Window.partitionBy("doc_id", "text_key").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    levels = sorted({r.priority for r in RULES})
    for p in levels:
        known = known.withColumn(f"reach_{p}", F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before))
    reach = F.coalesce(*[F.when(F.col("priority") == p, F.col(f"reach_{p}")) for p in levels], F.lit(-1))
    return known.filter(reach < F.col("end")).drop("priority", *[f"reach_{p}" for p in levels])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``.

    (doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, detections).  Words are runs of letters, digits and non-ASCII
    characters, A-Z in lower case.  ``n_base`` counts the places where a base
    phrase's words stand consecutively, ``first_word`` and ``last_word`` are
    their smallest and largest start (null without one).  ``labels`` adds those
    of the signature rules to ``base_labels``; both are sorted, distinct and
    comma-joined.  ``score`` is the highest score of a detection, or 0;
    ``detections`` are the surviving (start, end, label) by position.

    A null text is empty: no words, no labels, score 0.  Repeated rows each get
    their row; rows that share an id but not a text are scanned apart.  Columns
    besides the two named are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text, plain = F.col("text"), F.col("plain")
    rows = rows.withColumn("plain", F.regexp_replace(F.lower(text), r"[-\s]+", " "))
    gated = reduce(lambda a, b: a | b, [F.contains(plain, F.lit(g)) for g in gates()])
    based = text.rlike(BASE)
    pieces = F.when(based, F.split(text, BASE, -1))
    rows = rows.select("doc_id", "text", _words(text).alias("n_words"), pieces.alias("pieces"),
                       F.when(based, F.transform(F.regexp_extract_all(text, F.lit(BASE), F.lit(1)),
                                                 lambda m: F.lower(F.substring(m, 1, 1)))).alias("phrases"),
                       F.when(gated, _matches(text, plain)).alias("found"))
    label = F.create_map(*[F.lit(x) for p, y in PHRASES.items() for x in (p[0], y)])
    length = F.create_map(*[x for p in PHRASES for x in (F.lit(p[0]), F.lit(len(p.split())))])
    last = F.element_at("phrases", -1)
    base = rows.select(
        "doc_id", F.xxhash64("text", F.lit(1)).alias("text_key"), "n_words",
        F.coalesce(F.size("phrases"), F.lit(0)).cast("long").alias("n_base"),
        _words(F.element_at("pieces", 1)).alias("first_word"),
        (F.col("n_words") - _words(F.element_at("pieces", -1)) - F.element_at(length, last)).cast("long").alias("last_word"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("phrases", lambda p: F.element_at(label, p)))),
                   F.array().cast("array<string>")).alias("base"),
        F.coalesce("found", F.array().cast("array<struct<rule:int,gaps:array<int>,hits:array<int>>>")).alias("found"))
    base = written(base, "licences")
    matched = base.filter("size(found) > 0").select("doc_id", "text_key", "found").distinct()
    kept = resolve(_placed(matched)).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("signed"), F.max("score").alias("best"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label"))).alias("detections"))
    kept = kept.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "signed", "best", "detections")
    out = base.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("signed", F.array().cast("array<string>"))))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                      F.array_join(labels, ",").alias("labels"),
                      F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
                      "detections")
