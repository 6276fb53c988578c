"""Operator 10, toxicity by nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled rows; terms are the words whose occurrence depends on the
label (chi-squared), at most TERMS of them; document frequencies are counted over the whole corpus. The
choice of terms departs from plain TF-IDF over all words, which finds the wrong neighbours here (see the
README). Statistics of the examples are aggregated where their texts are; the driver sees terms and counts.
Examples lie in blocks of an inverted index that knows each term's largest weight per block, so a
query adds up an upper bound per block and opens only blocks that can still hold one of its K nearest
neighbours: the result is exact, ties with the last neighbour included. Neighbours vote with their
similarity, weighted back to the labels' real proportions; a text without any of the terms gets the
rate of examples without them. Index and terms have fixed bounds and go to every task.

Null and empty texts have no terms. Null labels are no labels; a document labelled twice is toxic if
one label says so. Rows that repeat an id are scored by their own text; extra columns are not read;
with no labels, or labels of one kind, every score is the (smoothed) rate of toxic labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm import common

EXAMPLES = 6000  # most labelled rows of either label in the index
TERMS = 2048  # most terms
NEIGHBOURS = 15
BLOCK = 64
CHI_SQUARED = 24.0  # a term's least chi-squared (chance: one in a million) ...
CHI_SHARE = 0.01  # ... and its least share of the number of examples
PRIOR = 0.5  # votes of the base rate
FOLDS = 5
WORD = re.compile(r"\w+")


def held_out(doc_id: str = "doc_id"):
    """Rows of the fold that is never learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class Index:
    """Block-max inverted index of unit vectors, examples ordered so that like ones share blocks."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: list[int]
    votes: np.ndarray  # weight of an example's vote
    toxic: np.ndarray
    vectors: list[dict[int, float]]
    base: float
    bare: float  # score of a text without terms
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    most: np.ndarray | None = None
    known: dict = field(default_factory=dict)

    def build(self) -> Index:
        n_blocks = -(-len(self.ids) // BLOCK)
        self.most = np.zeros((len(self.terms), n_blocks))
        own: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for e, vector in enumerate(self.vectors):
            for t, w in vector.items():
                own[t].append((e, w))
        for t, entries in enumerate(own):
            at = np.array([e for e, _ in entries], np.int64)
            weight = np.array([w for _, w in entries])
            self.postings.append((at, weight, np.searchsorted(at, np.arange(n_blocks + 1) * BLOCK)))
            np.maximum.at(self.most[t], at // BLOCK, weight)
        return self

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        weights = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()}

    def counts(self, text: str) -> dict[int, int]:
        terms = self.terms
        return Counter([terms[w] for w in words_of(text) if w in terms])

    def nearest(self, vector: dict[int, float], k: int = NEIGHBOURS) -> list[tuple[int, float]]:
        """The k most similar examples, and all as similar as the last of them; none of similarity 0."""
        query = list(vector.items())
        bounds = sum(q * self.most[t] for t, q in query)
        found: list[tuple[int, float]] = []
        least = 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or bounds[b] < least - 1e-9:
                break
            sums = np.zeros(BLOCK)
            for t, q in query:
                at, weight, cuts = self.postings[t]
                lo, hi = cuts[b], cuts[b + 1]
                sums[at[lo:hi] - b * BLOCK] += q * weight[lo:hi]
            hits = np.flatnonzero((sums > 0) & (sums >= least - 1e-9))
            found += [(int(b) * BLOCK + int(e), float(sums[e])) for e in hits]
            if len(found) >= k:
                found.sort(key=lambda x: (-x[1], x[0]))
                least = found[k - 1][1]
                found = [x for x in found if x[1] >= least - 1e-9]
        return sorted(found, key=lambda x: (-x[1], x[0]))

    def score(self, text: str) -> tuple[float, list[tuple[int, float]]]:
        """Share of toxic votes among the neighbours, and the nearest three as evidence."""
        counts = self.counts(text)
        if not counts or not self.ids:
            return self.bare, []
        key = tuple(sorted(counts.items()))
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            near = self.nearest(self.vector(counts))
            at = np.array([e for e, _ in near], np.int64)
            votes = self.votes[at] * np.array([s for _, s in near])
            toxic = float((votes * self.toxic[at]).sum()) + PRIOR * self.base
            score = toxic / (float(votes.sum()) + PRIOR)
            self.known[key] = min(1.0, max(0.0, score)), [(self.ids[e], round(s, 6)) for e, s in near[:3]]
        return self.known[key]


def _examples(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """`doc_id, toxic, h, text` of the sampled rows; the sample is bounded, its texts stay on the executors."""
    return docs.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", F.xxhash64("text").alias("h"), "text")


def choose_terms(examples: DataFrame, n: int, n_toxic: int) -> list[str]:
    """Words whose occurrence in an example depends on its label, strongest first."""

    def count(piece: pa.RecordBatch) -> dict:
        seen: dict[str, list[int]] = {}
        for toxic, text in zip(piece.column("toxic").to_pylist(), piece.column("text").to_pylist()):
            for word in set(words_of(text)):
                own = seen.setdefault(word, [0, 0])
                own[0] += 1
                own[1] += toxic
        counts = list(seen.values())
        return {
            "word": pa.array(list(seen), pa.string()),
            "df": pa.array([c[0] for c in counts], pa.int64()),
            "a": pa.array([c[1] for c in counts], pa.int64()),
        }

    counted = common.map_slices(examples.select("toxic", "text"), count, "word string, df long, a long")
    df, a = F.sum("df").cast("double"), F.sum("a").cast("double")
    b, c = F.col("df") - F.col("a"), n_toxic - F.col("a")
    d = n - n_toxic - b
    below = F.col("df") * (n - F.col("df")) * float(n_toxic) * (n - n_toxic)
    chi = F.when(below > 0, n * F.pow(F.col("a") * d - b * c, 2) / below).otherwise(0.0)
    found = (
        counted.groupBy("word")
        .agg(df.alias("df"), a.alias("a"))
        .withColumn("chi", chi)
        .where(F.col("chi") >= max(CHI_SQUARED, CHI_SHARE * n))
        .orderBy(F.desc("chi"), "word")
        .limit(TERMS)
    )
    return [row["word"] for row in found.collect()]


def _term_counts(examples: DataFrame, index: Index) -> list[tuple[int, int, dict[int, int]]]:
    """`doc_id, toxic` and the counts of the terms of every example; bounded by the sample and the terms."""

    def count(piece: pa.RecordBatch) -> dict:
        found = [index.counts(text) for text in piece.column("text").to_pylist()]
        return {
            "doc_id": piece.column("doc_id"),
            "toxic": piece.column("toxic"),
            "h": piece.column("h"),
            "terms": pa.array([list(c) for c in found], pa.list_(pa.int32())),
            "counts": pa.array([list(c.values()) for c in found], pa.list_(pa.int32())),
        }

    schema = "doc_id long, toxic int, h long, terms array<int>, counts array<int>"
    rows = sorted(common.map_slices(examples, count, schema).collect(), key=lambda r: (r["doc_id"], r["h"]))
    return [(r["doc_id"], r["toxic"], dict(zip(r["terms"], r["counts"]))) for r in rows]


def document_frequencies(docs: DataFrame, terms: list[str]) -> dict[str, int]:
    """Documents of the whole corpus that hold each term; partial counts per slice."""

    def count(piece: pa.RecordBatch) -> dict:
        known, seen = set(terms), Counter()
        for text in piece.column("text").to_pylist():
            seen.update(known.intersection(words_of(text)))
        return {"term": pa.array(list(seen), pa.string()), "df": pa.array(list(seen.values()), pa.int64())}

    counted = common.map_slices(docs.select("text"), count, "term string, df long")
    return {r["term"]: r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def fit(docs: DataFrame, labels: DataFrame) -> Index:
    """Index from labelled rows outside the held-out fold; `docs` is `doc_id, text`, all of the corpus."""
    learned = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(~held_out())
    )
    totals = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit("example"))
    sample = None
    for label in (0, 1):
        part = learned.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(EXAMPLES)
        sample = part if sample is None else sample.unionByName(part)
    examples = common.staged(_examples(docs, sample), "labelled-examples")
    n, n_toxic = sum(totals.values()), totals.get(1, 0)
    base = (n_toxic + 0.1) / (n + 1)  # few are toxic where nothing is known
    sampled = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    terms = choose_terms(examples, sum(sampled.values()), sampled.get(1, 0))
    if not terms:
        return Index({}, np.zeros(0), [], np.zeros(0), np.zeros(0), [], base, base)
    seen = document_frequencies(docs, terms)
    n_docs = docs.count()
    idf = np.array([math.log((1 + n_docs) / (1 + seen.get(t, 0))) + 1 for t in terms])
    index = Index({t: i for i, t in enumerate(terms)}, idf, [], np.zeros(0), np.zeros(0), [], base, base)
    weight = {y: totals.get(y, 0) / sampled[y] for y in sampled}
    rows, bare = [], Counter()
    for doc_id, toxic, counts in _term_counts(examples, index):
        if counts:
            vector = index.vector(counts)
            rows.append((max(vector, key=lambda t: (vector[t], -t)), toxic, doc_id, vector))
        else:
            bare[toxic] += weight[toxic]
    rows.sort(key=lambda r: (r[0], r[1], -r[3][r[0]], r[2]))
    index.ids = [r[2] for r in rows]
    index.toxic = np.array([r[1] for r in rows], float)
    index.votes = np.array([weight[r[1]] for r in rows])
    index.votes /= max(1e-12, index.votes.max(initial=0.0))
    index.vectors = [r[3] for r in rows]
    index.bare = (bare[1] + base) / (bare[0] + bare[1] + 1)
    return index.build()


EVIDENCE = "array<struct<doc_id:long,similarity:double>>"


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with `score` and `evidence`: the nearest examples' ids and their similarity."""
    corpus = common.texts(docs, id_col, text_col)
    index = docs.sparkSession.sparkContext.broadcast(fit(corpus, labels))

    def run(texts: list[str]) -> dict:
        scored = [index.value.score(t) for t in texts]
        evidence = [[{"doc_id": i, "similarity": s} for i, s in e] for _, e in scored]
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64())]))
        return {
            "score": pa.array([s for s, _ in scored], pa.float64()),
            "evidence": pa.array(evidence, kind),
        }

    return common.with_columns(docs, text_col, run, f"score double, evidence {EVIDENCE}")
