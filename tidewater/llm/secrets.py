"""Secret scan with corpus-wide ownership frequency.

Pattern rules find candidate spans in every whole text.  Each candidate value
is hashed; its distinct repositories and owners over the whole corpus are
counted.  A value that many owners or very many repositories hold is an example
copied around; one of few that looks random is a live-looking credential, and so
is a phrase behind a password keyword that one owner holds in few repositories.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import map_arrow, written

#: Base kinds, in the order they are listed for equal starts.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a greedy run of fewer than 16 would be dropped
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: The method's own kinds: (kind, a literal that every match contains, pattern).
MORE = tuple((kind, literal, re.compile(pattern)) for kind, literal, pattern in (
    ("github", "gh", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack", "xox", r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}"),
    ("google", "AIza", r"\bAIza[0-9A-Za-z_-]{35}"),
    ("stripe", "_live_", r"\b[sr]k_live_[0-9A-Za-z]{24,}"),
    ("jwt", "eyJ", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    ("pem", "PRIVATE KEY-----", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----)?"),
    ("url", "://", r"\b[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:([^\s:/@]{6,128})@[A-Za-z0-9.-]+"),
))
KINDS = ("assign", "access", "hex", *(k for k, _, _ in MORE))
_BASE = frozenset(KINDS[:3])


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) in code points, by start and then by kind as listed."""
    out = []
    lower = text.lower()
    if any(w in lower for w in _KEYWORDS):
        out += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    for kind, literal, pattern in MORE:
        if literal in text:
            out += [(m.start(), m.end(), kind, m[1] if pattern.groups else m[0]) for m in pattern.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def entropy(value: str) -> float:
    """Shannon bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(kind: str, value: str) -> bool:
    """Whether a value reads like a generated credential: mixed letters and digits, or a format of its own."""
    if kind not in ("assign", "hex"):
        return True
    return (any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= 2.5)


def looks_phrase(kind: str, value: str) -> bool:
    """Whether a value behind a password keyword is varied enough for a passphrase, digits or not."""
    return kind == "assign" and any(c.isalpha() for c in value) and entropy(value) >= 3.0


_SPAN = "struct<start:int,end:int,kind:string,hash:string,random:boolean,phrase:boolean>"


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as the struct ``row``, with their candidate ``spans``."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in batch.column(1):
            spans = find(text.as_py() or "")
            found.append([{"start": s, "end": e, "kind": k, "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32],
                           "random": looks_random(k, v), "phrase": looks_phrase(k, v)} for s, e, k, v in spans])
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("hash", pa.string()),
                          ("random", pa.bool_()), ("phrase", pa.bool_())])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], names=["row", "spans"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       docs[f"`{text_col}`"].cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("spans", T._parse_datatype_string(f"array<{_SPAN}>"))])
    return map_arrow(rows, fn, schema, most="2m")


def ownership(spans: DataFrame, repository_col: str, owner_col: str) -> DataFrame:
    """(hash, repositories, owners): distinct counts of a candidate's holders over the corpus.

    Reduced per (hash, owner, repository), then per (hash, owner), then per hash, each with a
    partial aggregate before its shuffle, so a value in a third of all rows stays spread out.
    """
    each = spans.select(F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"),
                        F.explode(F.array_distinct("spans.hash")).alias("hash")).distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def scan(docs: DataFrame, repository_col: str = "doc_id", owner_col: str = "source", text_col: str = "text",
         copied_owners: int = 5, copied_repositories: int = 100) -> DataFrame:
    """(row, spans): each row of ``docs`` as a struct and its spans, every span with its verdict.

    A span has start, end (code points, end exclusive), kind, hash, random, phrase,
    repositories, owners and ``live``: it looks random and fewer than
    ``copied_owners`` owners and ``copied_repositories`` repositories hold its
    value, or it is a phrase behind a password keyword of one owner and fewer
    than ``copied_owners`` repositories; else it is a copied example or a plain
    number.  A null owner or repository counts as one more holder.

    Null and empty texts have no spans.  Repeated rows each get their row and
    count once as holders.  An empty table gives no rows.  Other columns,
    whatever their names, are only carried in ``row``.
    """
    found = written(candidates(docs, text_col), "secret-candidates")
    held = found.filter("size(spans) > 0")

    def of_row(name: str) -> Column:
        return F.col("row").getField(name)

    counts = written(ownership(held.select(of_row(repository_col).alias("repository"), of_row(owner_col).alias("owner"),
                                           "spans"), "repository", "owner"), "secret-owners")
    # a verdict for each document and hash, by the rows' repository and spans: repeated rows share it
    key = held.select(of_row(repository_col).alias("repository"), F.col("spans").alias("found")).distinct()
    few = F.col("s.random") & (F.col("owners") < copied_owners) & (F.col("repositories") < copied_repositories)
    rare = F.col("s.phrase") & (F.col("owners") == 1) & (F.col("repositories") < copied_owners)
    verdicts = (key.select("repository", "found", F.explode("found").alias("s"))
                .join(counts.withColumnRenamed("hash", "h"), F.col("s.hash") == F.col("h"))
                .select("repository", "found", F.struct(
                    "s.start", "s.kind", "s.end", "s.hash", "s.random", "s.phrase", "repositories", "owners",
                    (few | rare).alias("live")).alias("s"))
                .groupBy("repository", "found").agg(F.collect_list("s").alias("judged")))
    none = found.filter("size(spans) = 0").select("row", F.array().cast(verdicts.schema["judged"].dataType).alias("spans"))
    some = held.join(verdicts, of_row(repository_col).eqNullSafe(verdicts["repository"])
                     & (held["spans"] == verdicts["found"])).select("row", F.col("judged").alias("spans"))
    return some.unionByName(none)


def listed(spans: str) -> Column:
    """``kind:start:end`` of an array of spans by start, then kind as listed, comma-joined."""
    order = F.transform(F.col(spans), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(rows: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """(row, redacted): the original rows, and their text with ``mark`` for every live-looking span; overlapping spans share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, spans in enumerate(batch.column(2).to_pylist()):
                text, parts, end = texts[i], [], 0
                for s in sorted((s["start"], s["end"]) for s in spans if s["live"]):
                    if s[0] >= end:
                        parts += [text[end:s[0]], mark]
                    end = max(end, s[1])
                if parts:
                    texts[i] = "".join(parts) + text[end:]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "redacted"])

    schema = T.StructType([rows.schema["row"], T.StructField("redacted", T.StringType())])
    return rows.select("row", F.col("row").getField(text_col).cast("string").alias("text"), "spans").mapInArrow(run, schema)
