"""Ranked lexical search: the best documents of all for every item, by a hybrid of term- and document-at-a-time.

Documents are cut into segments of some megabytes of text, each an inverted index of the items' terms: for
every term its documents in ascending id with occurrences. The corpus statistics are sums over segments. A
segment is then searched item by item:

* Short lists are added up term at a time into accumulators. The documents touched, with the accumulator's
  maximum per block of documents, are from then on one list like the others.
* Long lists are walked document at a time, a block of documents after the other. A block whose bound (the
  accumulators' maximum plus every long list's) is below the worst score kept so far is skipped; within a
  block the lists are taken in descending order of their bounds and left as soon as no document can still
  get there.

A task keeps its best documents over all its segments, so later ones skip more, and ships at most `k` rows
an item; the best of these are the result. No bound is ever below a true score, so nothing is lost.

Defined cases: a null text has no term and is not counted; a null id stands behind all others at equal
scores; every row is a document, also where ids repeat (rows alike in id and score may stand in any order,
which the result doesn't show); every row of the items is an item, also where item ids repeat or are null.
Other columns are not read. Empty tables and items without terms give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from signalmart.llm import common, terms

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of text in a segment.
SEGMENT_BYTES = 8 << 20
#: Documents in a block of a list.
BLOCK_BITS = 6
#: Lists of less than this share of a segment's documents are short: 1 / SHORT.
SHORT = 16
#: Bytes of item texts that are searched at once; more items take several passes.
ITEM_BYTES = 4 << 20

SEGMENT = (
    "n_docs long, n_terms long, ids array<long>, sizes array<long>,"
    " term array<int>, n array<int>, docs array<int>, tfs array<long>"
)


def _index(piece: pa.RecordBatch, vocabulary: terms.Vocabulary) -> dict:
    """Inverted index of one segment; documents in ascending id, null ids last."""
    piece = piece.take(pc.sort_indices(piece, sort_keys=[("doc_id", "ascending")]))
    texts = [t.encode() for t in piece.column("text").to_pylist()]
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    sizes = np.zeros(len(texts), np.int64)
    found = []
    for part, start, first, lengths, hashes in terms.spans(data):
        doc = np.searchsorted(ends, first + start, "right")
        sizes += np.bincount(doc, minlength=len(texts))
        hit, word = vocabulary.find(part, first, lengths, hashes)
        found.append(word * len(texts) + doc[hit])
    pairs, tfs = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
    term, n = np.unique(pairs // len(texts), return_counts=True)
    return {
        "n_docs": [int((sizes > 0).sum())],
        "n_terms": [int(sizes.sum())],
        "ids": [piece.column("doc_id")],
        "sizes": [sizes],
        "term": [term],
        "n": [n],
        "docs": [pairs % len(texts)],
        "tfs": [tfs],
    }


def _segments(docs: DataFrame, vocabulary: terms.Vocabulary) -> DataFrame:
    kinds = {"ids": pa.int64(), "sizes": pa.int64(), "term": pa.int32(), "n": pa.int32(),
             "docs": pa.int32(), "tfs": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.gathered(batches, SEGMENT_BYTES):
            made = _index(piece, vocabulary)
            yield pa.RecordBatch.from_pydict(
                {
                    name: pa.array([pa.array(v, kinds[name]) for v in values], pa.list_(kinds[name]))
                    if name in kinds
                    else pa.array(values, pa.int64())
                    for name, values in made.items()
                }
            )

    return common.staged(docs.mapInArrow(run, SEGMENT), "segments")


class _Best:
    """The best k documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        ids, null = np.concatenate((self.ids, ids)), np.concatenate((self.null, null))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


class _Segment:
    """A segment's lists with the impact of each posting and the maxima of their blocks."""

    def __init__(self, row: dict[str, np.ndarray], null: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.null = row["ids"], null
        self.n = len(self.ids)
        m = 75 + (25 * row["sizes"] * n_docs) // max(n_terms, 1)
        self.docs = row["docs"]
        tfs = row["tfs"]
        self.impacts = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[self.docs])
        ends = np.cumsum(row["n"])
        self.lists = dict(zip(row["term"].tolist(), zip((ends - row["n"]).tolist(), ends.tolist())))
        self.blocks = (self.n >> BLOCK_BITS) + 1
        self.edges = np.arange(self.blocks + 1) << BLOCK_BITS
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block_bounds(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a long list's blocks begin, and the greatest impact in each."""
        if term not in self.bounds:
            start, stop = self.lists[term]
            most = np.zeros(self.blocks, np.int64)
            np.maximum.at(most, self.docs[start:stop] >> BLOCK_BITS, self.impacts[start:stop])
            self.bounds[term] = start + np.searchsorted(self.docs[start:stop], self.edges), most
        return self.bounds[term]

    def search(self, query: list[tuple[int, int]], best: _Best) -> None:
        here = [(t, w) for t, w in query if t in self.lists]
        if not here:
            return
        # Term at a time: short lists into accumulators.
        sums = np.zeros(self.blocks << BLOCK_BITS, np.int64)
        long = []
        for term, weight in here:
            start, stop = self.lists[term]
            if (stop - start) * SHORT > self.n:
                long.append((weight, *self.block_bounds(term)))
            else:
                sums[self.docs[start:stop]] += weight * self.impacts[start:stop]
        bound = sums.reshape(-1, 1 << BLOCK_BITS).max(axis=1)
        for weight, _, most in long:
            bound = bound + weight * most
        # Document at a time: the accumulators as one bounded list among the long ones.
        for block in np.flatnonzero(bound >= best.least).tolist():
            if bound[block] < best.least:
                continue
            first = block << BLOCK_BITS
            scores = sums[first : first + (1 << BLOCK_BITS)].copy()
            rest = [(int(weight * most[block]), weight, starts) for weight, starts, most in long if most[block]]
            rest.sort(key=lambda x: -x[0])
            open_ = sum(x[0] for x in rest)
            for top, weight, starts in rest:
                if int(scores.max()) + open_ < best.least:
                    break
                a, b = starts[block], starts[block + 1]
                scores[self.docs[a:b] - first] += weight * self.impacts[a:b]
                open_ -= top
            else:
                good = np.flatnonzero(scores >= best.least)
                if len(good):
                    best.add(scores[good], self.ids[first + good], self.null[first + good])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    for row in range(batch.num_rows):
        ids = batch.column("ids")[row].values
        lists = {
            name: batch.column(name)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
            for name in ("sizes", "term", "n", "docs", "tfs")
        }
        lists["ids"] = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        yield lists, pc.is_null(ids).to_numpy(zero_copy_only=False)


def _search(segments: DataFrame, queries: list[list[tuple[int, int]]], n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in queries]
        for batch in batches:
            for row, null in _rows(batch):
                segment = _Segment(row, null, n_docs, n_terms)
                for query, kept in zip(queries, best):
                    segment.search(query, kept)
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.repeat(np.arange(len(best)), [len(b.scores) for b in best]), pa.int64()),
                "doc_id": pa.array(np.concatenate([b.ids for b in best]), pa.int64(),
                                   mask=np.concatenate([b.null for b in best])),
                "score": pa.array(np.concatenate([b.scores for b in best]), pa.int64()),
            }
        )

    return segments.mapInArrow(run, "item long, doc_id long, score long")


def _block(docs: DataFrame, items: list[Row], k: int) -> DataFrame:
    """Rank all documents for some items."""
    spark = docs.sparkSession
    if not items:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    counts = [Counter(TERM.findall((row["text"] or "").encode().translate(LOWER))) for row in items]
    words = sorted(set().union(*counts))
    place = {w: i for i, w in enumerate(words)}
    segments = _segments(docs, terms.Vocabulary(words))
    n_docs, n_terms = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = {
        row["t"]: row["df"]
        for row in segments.select(F.explode(F.arrays_zip("term", "n")).alias("p"))
        .groupBy(F.col("p.term").alias("t"))
        .agg(F.sum("p.n").alias("df"))
        .collect()  # one row a term of the items at most
    }
    weight = {t: int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * n + 1)))) for t, n in df.items()}
    queries = [
        [(place[w], times * weight[place[w]]) for w, times in sorted(count.items()) if weight.get(place[w])]
        for count in counts
    ]
    found = _search(segments, queries, n_docs or 0, n_terms or 0, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(items)], "item long, item_id long")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `k` best documents (`doc_id, text`) of each item (`item_id, text`).

    Items are read by the driver in blocks of about `ITEM_BYTES` of text, and all documents for each block.
    """
    docs = common.texts(docs)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.octet_length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = -(-size // ITEM_BYTES) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    found = [_block(docs, items.where(block == i).collect(), k) for i in range(n_blocks)]
    return reduce(DataFrame.unionByName, found)
