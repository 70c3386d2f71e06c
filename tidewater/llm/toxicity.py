"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Terms (words and beginnings of words) are counted over all labelled
   training rows; those that stand almost only in toxic ones form learned
   lexicons, by kind and strength.  Together with hand-written lexicons and
   patterns they make the voters; a voter votes toxic or abstains.
2. A generative label model explains the votes: given the hidden label voters
   fire independently, each at its own two rates (its accuracy).  EM estimates
   them from the counts of all vote combinations over the whole training
   corpus, labelled or not.  Voters that still fire together more often than
   the label explains are correlated, and share their evidence accordingly.
3. A logistic regression over terms and hand-written votes is trained on the
   posterior labels of a bounded sample; it scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_up_to, small_batches, written
from tidewater.llm.wordhash import NON_WORD, U64, Words, blocks

#: Hand-written lexicons of insults, by group.
LEXICONS = {
    "insult_nouns": "idiot idiots moron morons loser losers clown clowns scum fool fools dumbass jerk jackass imbecile cretin",
    "insult_adjectives": "stupid pathetic worthless disgusting dumb useless filthy vile repulsive braindead",
    "contempt": "trash garbage vermin parasite parasites filth subhuman maggot maggots",
    "romance": "idiota idiotas imbécil estúpido estúpida basura asqueroso imbécile connard connasse ordure salaud",
    "german": "dummkopf abschaum arschloch trottel drecksack widerlich wertlos vollidiot",
}
#: Patterns; a text is only tried if one of its words is in TRIGGERS.
PATTERNS = {
    "direct": r"(?i)\b(?:you|he|she|they)(?:'re| are| is|'s)? (?:such )?(?:an? |the )?(?:\w+ )?(?:idiot|moron|loser|clown|scum|trash|fool)s?\b",
    "command": r"(?i)\b(?:shut up|get lost|go to hell|drop dead|kill yourself)\b",
}
TRIGGERS = "idiot idiots moron morons loser losers clown clowns scum scums trash trashs fool fools up lost hell dead yourself"
PREFIXES = (4, 6, 8)  # bytes from the start of a word
LEAST_ROWS = 3
GRADES = {"weak": 2.0, "fair": 2.8, "strong": 3.6}  # least log odds of a learned lexicon
SAMPLE_ROWS = 20_000
BROADCAST_LABELS = 2_000_000
HAND = [*LEXICONS, *PATTERNS]
VOTERS = [*HAND, *(f"{grade}_{kind}" for kind in ("words", "starts") for grade in GRADES), "two_terms", "five_terms"]


def _hashes(text: str) -> np.ndarray:
    return np.unique(Words([text.encode()], NON_WORD).hash)


class Lookup:
    """Membership of hashes in a sorted list: a bit table first, then a binary search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        size = 1 << min(max(20, (16 * len(hashes)).bit_length()), 26)
        self.mask = U64(size - 1)
        self.table = np.zeros(size, dtype=bool)
        self.table[(hashes & self.mask).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h`` that are members, their places in the list)."""
        at = np.flatnonzero(self.table[(h & self.mask).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = self.hashes[place] == h[at]
        return at[hit], place[hit]


def _kinds(words: Words) -> Iterator[tuple[int, np.ndarray]]:
    yield 0, words.hash
    for n in PREFIXES:
        yield n, words.prefix(n)


def _pairs(words: Words, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, place) of the terms in a block."""
    docs, places = [], []
    for _, h in _kinds(words):
        at, place = lookup.find(h)
        docs.append(words.documents(at))
        places.append(place)
    key = np.unique(np.concatenate(docs) * (len(lookup.hashes) + 1) + np.concatenate(places))
    return key // (len(lookup.hashes) + 1), key % (len(lookup.hashes) + 1)


@dataclass
class Terms:
    """Learned terms in order of hash: log odds of toxic against clean rows, and kind (0 word, else bytes)."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=U64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    kinds: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))


def learn_terms(rows: DataFrame) -> tuple[Terms, float]:
    """Terms of the labelled rows (text, toxic), and the share of toxic rows.

    Every term of every labelled row is counted, in the toxic and the clean
    rows at once, and tested where it is counted.  Only those whose odds reach
    the lowest grade are brought together, all of them: about 28 bytes each.
    """
    totals = {bool(r.toxic): r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        return Terms(), (bad + 1) / (bad + good + 2) if bad + good else 0.1

    def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for begin, run in blocks(batch.column(0).to_pylist()):
                words = Words(run, NON_WORD)
                doc = words.documents(np.arange(len(words.hash)))
                for kind, h in _kinds(words):
                    order = np.lexsort((doc, h))
                    h_, d_ = h[order], doc[order]
                    new = np.ones(len(h_), dtype=bool)
                    new[1:] = (h_[1:] != h_[:-1]) | (d_[1:] != d_[:-1])
                    h_, mark = h_[new], marks[begin + d_[new]]
                    first = np.flatnonzero(np.append(True, h_[1:] != h_[:-1])[:len(h_)])
                    toxic = np.add.reduceat(mark, first) if len(first) else mark
                    counts = np.diff(np.append(first, len(h_)))
                    yield pa.RecordBatch.from_arrays([pa.array(h_[first].view(np.int64)), pa.array(np.full(len(first), kind, dtype=np.int32)),
                                                      pa.array(toxic), pa.array(counts - toxic)], names=["term", "kind", "toxic", "clean"])

    counts = (rows.select("text", "toxic").mapInArrow(term_counts, "term long, kind int, toxic long, clean long")
              .groupBy("term", "kind").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= LEAST_ROWS))
    # a cautious bound: a term of few rows must not look strong by chance
    few = F.greatest(F.col("toxic") - 1.64 * F.sqrt("toxic"), F.lit(0.0))
    many = F.col("clean") + 1.64 * F.sqrt("clean")
    odds = F.log((few + 0.5) / (bad + 1)) - F.log((many + 1.5) / (good + 1))
    learned = counts.select("term", "kind", odds.alias("odds")).filter(F.col("odds") >= min(GRADES.values())).toArrow()
    hashes = learned["term"].to_numpy().view(U64)
    order = np.argsort(hashes)
    return Terms(hashes[order], learned["odds"].to_numpy()[order], learned["kind"].to_numpy()[order].astype(np.int64)), bad / (bad + good)


def votes(docs: DataFrame, terms: Terms) -> DataFrame:
    """(row, votes, terms): per row of ``docs`` its columns but the text, the voters that fire as bits, and its learned terms."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    carried = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in carried]).alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = sent.value
        lookup = Lookup(learned.hashes)
        hand = {name: Lookup(_hashes(text)) for name, text in LEXICONS.items()}
        triggers = Lookup(_hashes(TRIGGERS))
        patterns = {name: re.compile(p) for name, p in PATTERNS.items()}
        bit = {name: 1 << i for i, name in enumerate(VOTERS)}
        grade = np.searchsorted(list(GRADES.values()), learned.odds, side="right") - 1
        lexicon = np.array([[bit[f"{g}_{kind}"] for g in GRADES] for kind in ("words", "starts")])
        mark = lexicon[(learned.kinds > 0).astype(int), grade] if len(grade) else grade
        for batch in batches:
            texts = batch.column(1).to_pylist()
            fired, found = np.zeros(len(texts), dtype=np.int64), [[] for _ in texts]
            for begin, block in blocks(texts):
                words = Words(block, NON_WORD)
                for name, members in hand.items():
                    fired[begin + np.unique(words.documents(members.find(words.hash)[0]))] |= bit[name]
                for doc in np.unique(words.documents(triggers.find(words.hash)[0])).tolist():
                    for name, pattern in patterns.items():
                        if pattern.search(texts[begin + doc]):
                            fired[begin + doc] |= bit[name]
                doc, place = _pairs(words, lookup)
                for d, p in zip((begin + doc).tolist(), place.tolist(), strict=True):
                    found[d].append(p)
            for i, places in enumerate(found):
                if places:
                    fired[i] |= np.bitwise_or.reduce(mark[places])
                    sure = (grade[places] > 0).sum()
                    fired[i] |= (bit["two_terms"] if sure >= 2 else 0) | (bit["five_terms"] if sure >= 5 else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fired), pa.array(found, pa.list_(pa.int32()))],
                                             names=["row", "votes", "terms"])

    from pyspark.sql import types as T

    schema = T.StructType([rows.schema["row"], T.StructField("votes", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


@dataclass
class LabelModel:
    """Firing rates of the voters in toxic and clean rows, the share each keeps of its evidence, and the prior."""

    toxic: np.ndarray
    clean: np.ndarray
    share: np.ndarray
    prior: float

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """P(toxic) of rows of votes (n, voters)."""
        yes = np.log(self.toxic / self.clean)
        no = np.log((1 - self.toxic) / (1 - self.clean))
        z = np.log(self.prior / (1 - self.prior)) + (fired * yes + (1 - fired) * no) @ self.share
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def bits(patterns: np.ndarray) -> np.ndarray:
    return ((patterns[:, None] >> np.arange(len(VOTERS))[None, :]) & 1).astype(float)


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 60) -> LabelModel:
    """EM over the vote combinations and their counts, with correlations from the residuals."""
    fired, n = bits(patterns), counts.astype(float)
    m = fired.shape[1]
    model = LabelModel(np.full(m, 0.5), np.full(m, 0.01), np.ones(m), min(max(prior, 0.001), 0.5))
    for k in range(rounds):
        q = model.posterior(fired) * n
        p = n - q
        model.toxic = np.clip((q @ fired + 0.5) / (q.sum() + 1), 1e-4, 1 - 1e-4)
        model.clean = np.clip((p @ fired + 0.05) / (p.sum() + 1), 1e-5, model.toxic * 0.9)
        if k % 10 == 9:
            rest = [fired - model.toxic, fired - model.clean]
            joint = sum((r * w[:, None]).T @ r for r, w in zip(rest, (q, p), strict=True)) / n.sum()
            spread = np.sqrt(np.maximum(np.diag(joint), 1e-12))
            related = np.clip(joint / np.outer(spread, spread), 0, 1)
            np.fill_diagonal(related, 0)
            model.share = 1 / (1 + related.sum(axis=1))
    return model


def fit_classifier(features: list[np.ndarray], targets: np.ndarray, weights: np.ndarray, size: int, steps: int = 400) -> np.ndarray:
    """Weights of ``size`` binary features and, last, the bias: logistic regression by Adam with a small L2 penalty."""
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    col = np.concatenate(features).astype(np.int64) if len(row) else np.zeros(0, dtype=np.int64)
    w, a, b = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    share = weights / weights.sum()
    w[-1] = np.log((share @ targets + 1e-6) / (1 - share @ targets + 1e-6))
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=len(features)) + w[-1]
        g = share * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - targets)
        grad = np.append(np.bincount(col, g[row], minlength=size), g.sum()) + 1e-6 * w
        a, b = 0.9 * a + 0.1 * grad, 0.999 * b + 0.001 * grad * grad
        w -= 0.1 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-9)
    return w


def score(docs: DataFrame, labels: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, score, predicted), one row per row of ``docs``, from the text alone.

    ``labels`` (doc_id, toxic) teach the lexicons and the share of toxic rows;
    only rows for which ``trained`` (over doc_id) holds teach anything, the
    label model included.  Labels that are null or of no document are left out;
    a document labelled twice counts twice.  ``score`` is P(toxic), ``predicted``
    1 from 0.5 on.

    A null or empty text has no evidence and the score of such texts.  Repeated
    rows each get their row.  Without labels the hand-written voters remain.
    Other columns are ignored; an empty table gives no rows.
    """
    base = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = base.withColumn("trained", F.coalesce(trained, F.lit(False)))
    known = broadcast_up_to(labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
                            .filter("doc_id is not null and toxic is not null"), BROADCAST_LABELS)
    terms, prior = learn_terms(base.filter("trained").join(known, "doc_id").select("text", "toxic"))
    voted = written(votes(base, terms), "toxicity-votes").select("row.doc_id", "row.trained", "votes", "terms")
    teaching = voted.filter("trained")
    combos = teaching.groupBy("votes").count().collect()
    if combos:
        order = sorted((r.votes, r["count"]) for r in combos)
        model = fit_label_model(np.array([v for v, _ in order], dtype=np.int64), np.array([c for _, c in order]), prior)
        weights = _classifier(teaching, model, dict(order), len(terms.hashes), sample_rows)
    else:
        weights = np.zeros(len(terms.hashes) + len(HAND) + 1)
    return _scored(voted, weights, len(terms.hashes))


def _scored(voted: DataFrame, weights: np.ndarray, n_terms: int) -> DataFrame:
    """(doc_id, score, predicted) by the classifier's weights: terms, hand-written votes and, last, the bias."""
    sent = voted.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            fired = batch.column(1).to_numpy(zero_copy_only=False)
            found = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
            z = np.bincount(row, w[found.flatten().to_numpy(zero_copy_only=False)], minlength=batch.num_rows)
            z = z + ((fired[:, None] >> np.arange(len(HAND))) & 1) @ w[n_terms:-1] + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return voted.select("doc_id", "votes", "terms").mapInArrow(run, "doc_id long, score double, predicted int")


def _classifier(teaching: DataFrame, model: LabelModel, counts: dict[int, int], n_terms: int, sample_rows: int) -> np.ndarray:
    """Trains on about half ``sample_rows`` rows with votes and half without, each weighted by how many it stands for."""
    silent = counts.get(0, 0)
    loud = sum(counts.values()) - silent
    share = F.when(F.col("votes") == 0, sample_rows / 2 / max(silent, 1)).otherwise(sample_rows / 2 / max(loud, 1))
    chosen = (teaching.filter(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < share * 1_000_000)
              .select("doc_id", "votes", "terms").limit(2 * sample_rows).collect())
    if not chosen:
        return np.zeros(n_terms + len(HAND) + 1)
    chosen.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.votes))
    fired = np.array([r.votes for r in chosen], dtype=np.int64)
    hand = [[n_terms + i for i in range(len(HAND)) if v >> i & 1] for v in fired.tolist()]
    features = [np.array([*r.terms, *h], dtype=np.int64) for r, h in zip(chosen, hand, strict=True)]
    stands = np.where(fired == 0, silent / max((fired == 0).sum(), 1), loud / max((fired != 0).sum(), 1))
    return fit_classifier(features, model.posterior(bits(fired)), stands, n_terms + len(HAND))
