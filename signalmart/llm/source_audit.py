"""Source divergence audit: how far the words of each source stand from those of every other of its language.

Texts are factored into chunks, the runs between ASCII whitespace, which no term crosses:

1. Slices of documents count the chunks of each document; a slice keeps its distinct chunks once and per
   document only their places and counts.
2. Chunks are dealt to buckets of their hash, and each globally distinct chunk is split into terms once; the
   terms go back to the slices.
3. Each slice, with its own chunks' terms, sums occurrences and distinct documents per language, source and
   term. A document lies in one slice, so both add up over slices: per bucket of the terms' hash, where a
   term's languages and sources meet and terms in too few documents go.
4. Every bucket adds up its terms' part of the divergence of each pair of sources, for a block of sources
   against another, and keeps the best terms of each source.

What is shuffled are rows of arrays, one per slice and bucket, not single chunks or terms. A task holds one
slice, or the distinct chunks or terms of one bucket, at a time; `buckets` should grow with the vocabulary. A
source that holds a third of the rows is one column like any other.

Defined cases: null `text`, `lang` and `source` count as ''. Every row is a document, repeated ids and rows
included; ids and other columns are not read. A group without terms takes part with counts of zero; in a
language without kept terms all pairs have the value 0 and there are no terms. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmart.llm import common, terms

#: Letters and all beyond ASCII.
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Bytes of text in a slice.
SLICE_BYTES = 12 << 20
#: Buckets of chunks and of terms.
BUCKETS = 1024
#: Sources in a block, and terms that a task compares at once.
SOURCES, STEP = 128, 2048
#: Entries that a task puts together before it sums them up.
HELD = 1 << 22
BILLION = 1_000_000_000

#: Words in one text, chunks or terms, stand between blanks, terms of different chunks in lines; numbers that
#: don't repeat go as two arrays, lower and upper half, which leaves less to write and to send.
SLICE = (
    "slice long, bucket int, start int, chunks string, langs array<string>, sources array<string>,"
    " doc_group array<int>, doc_n array<int>, low array<smallint>, high array<smallint>, times array<int>"
)
SPLIT = "slice long, start int, terms string"
COUNTS = (
    "bucket int, langs array<string>, sources array<string>, terms string, n_src array<int>,"
    " low array<smallint>, high array<smallint>, docs array<int>, more array<int>"
)
KEPT = (
    "lang string, v long, lang_total long, sources array<string>, totals array<long>, terms array<string>,"
    " lang_n array<long>, src array<int>, term array<int>, n array<long>"
)


def _ints(batch: pa.RecordBatch | pa.Table, name: str, row: int = 0) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _strings(batch: pa.RecordBatch | pa.Table, name: str, row: int = 0) -> list[str]:
    return batch.column(name)[row].as_py()


def _buckets(words: pa.StringArray, buckets: int) -> np.ndarray:
    """Bucket of each word (none is empty), by a hash of its bytes."""
    edges = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    if not len(words):
        return np.zeros(0, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)
    return (terms._hashes(data, edges[:-1], np.diff(edges)) % np.uint64(buckets)).astype(np.int64)


def _halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (values & 0xFFFF).astype(np.uint16).view(np.int16), (values >> 16).astype(np.int16)


def _whole(batch: pa.RecordBatch | pa.Table, row: int = 0) -> np.ndarray:
    return (_ints(batch, "high", row) << 16) | (_ints(batch, "low", row) & 0xFFFF)


def _sums(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    if not len(keys):
        return keys, *weights
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], *(np.add.reduceat(w[order], first) for w in weights)


def _edges(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ascending values, and where the run of each begins, with the end of all."""
    if not len(values):
        return values, np.zeros(1, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.append(first, len(values))


def _runs(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values in ascending ones."""
    found, edges = _edges(values)
    for value, start, stop in zip(found.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
        yield value, slice(start, stop)


def _lists(edges: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    """Values cut into lists."""
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def _slices(docs: DataFrame, buckets: int) -> DataFrame:
    """A row a slice with its documents' chunks, and a row per bucket with the distinct chunks in it.

    Chunks are numbered by bucket, so a bucket's chunks have the numbers from `start` on.
    """
    lists = {"langs": pa.string(), "sources": pa.string(), "doc_group": pa.int32(), "doc_n": pa.int32(),
             "low": pa.int16(), "high": pa.int16(), "times": pa.int32()}
    schema = pa.schema(
        [("slice", pa.int64()), ("bucket", pa.int32()), ("start", pa.int32()), ("chunks", pa.string()),
         *[(name, pa.list_(kind)) for name, kind in lists.items()]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for piece in common.gathered(batches, SLICE_BYTES):
            groups: dict[tuple[str, str], int] = {}
            named = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist())
            doc_group = [groups.setdefault(group, len(groups)) for group in named]
            lists = pc.ascii_split_whitespace(piece.column("text"))
            doc = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            flat = lists.flatten()
            solid = pc.not_equal(flat, "")  # around leading and trailing whitespace
            coded = flat.filter(solid).dictionary_encode()
            doc = doc[solid.to_numpy(zero_copy_only=False)]
            del lists, flat, solid
            bucket = _buckets(coded.dictionary, buckets)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            width = max(len(order), 1)
            keys, times = np.unique(doc * width + rank[coded.indices.to_numpy()], return_counts=True)
            del doc
            low, high = _halves(keys % width)
            whole = {"slice": number, "langs": [g[0] for g in groups], "sources": [g[1] for g in groups],
                     "doc_group": doc_group, "doc_n": np.bincount(keys // width, minlength=len(doc_group)),
                     "low": low, "high": high, "times": times}
            yield pa.RecordBatch.from_pylist([whole], schema)
            found, edges = _edges(bucket[order])
            chunks = pc.binary_join(_lists(edges, coded.dictionary.take(pa.array(order))), " ")
            parts = {"slice": pa.array(np.full(len(found), number)), "bucket": pa.array(found, pa.int32()),
                     "start": pa.array(edges[:-1], pa.int32()), "chunks": chunks}
            yield pa.RecordBatch.from_arrays(
                [parts[f.name] if f.name in parts else pa.nulls(len(found), f.type) for f in schema], schema=schema
            )
            number += 1
            del coded, keys, times, whole, chunks, parts, low, high, rank, order
            pa.default_memory_pool().release_unused()

    return common.staged(docs.mapInArrow(run, SLICE), "chunk-slices")


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each chunk; buckets come one after the other, and a chunk is split when first met."""
    known, now = {}, None
    for batch in batches:
        out = []
        for bucket, chunks in zip(batch.column("bucket").to_pylist(), batch.column("chunks").to_pylist()):
            if bucket != now:
                known, now = {}, bucket
            lines = []
            for chunk in chunks.split(" "):
                line = known.get(chunk)
                if line is None:
                    line = known[chunk] = " ".join(TERM.findall(chunk.translate(LOWER)))
                lines.append(line)
            out.append("\n".join(lines))
        yield pa.RecordBatch.from_arrays(
            [batch.column("slice"), batch.column("start"), pa.array(out, pa.string())],
            names=["slice", "start", "terms"],
        )


def _slice_counts(buckets: int):
    """Occurrences and documents per group and term of one slice, a row per bucket of terms."""
    lists = {"n_src": pa.int32(), "low": pa.int16(), "high": pa.int16(), "docs": pa.int32(), "more": pa.int32()}
    schema = pa.schema(
        [("bucket", pa.int32()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string())),
         ("terms", pa.string()), *[(name, pa.list_(kind)) for name, kind in lists.items()]]
    )

    def count(slices: pa.Table, split: pa.Table) -> pa.Table:
        if not slices.num_rows or not split.num_rows:
            return schema.empty_table()
        doc_group, doc_n, times = (_ints(slices, c) for c in ("doc_group", "doc_n", "times"))
        chunk = _whole(slices)
        # In the order of the chunks' numbers: a line a chunk.
        lines = pc.split_pattern(split.sort_by("start").column("terms").combine_chunks(), "\n").flatten()
        n_terms = pc.list_value_length(cells := pc.split_pattern(lines, " ")).to_numpy()
        n_terms = n_terms - pc.equal(lines, "").to_numpy(zero_copy_only=False)
        flat = cells.flatten()
        coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary
        del lines, cells, flat, coded
        starts = np.cumsum(n_terms) - n_terms

        width = max(len(words), 1)
        reps = n_terms[chunk]
        # Place of each term of each document's chunks among all lines' terms.
        at = np.arange(int(reps.sum())) + np.repeat(starts[chunk] - (np.cumsum(reps) - reps), reps)
        keys = codes[at].astype(np.int64)
        del at, codes
        keys += np.repeat(np.repeat(np.arange(len(doc_n)) * width, doc_n), reps)
        keys, n = _sums(keys, np.repeat(times, reps))  # once a document and term
        del chunk, times, reps
        bucket = _buckets(words, buckets)
        # Ascending by bucket, term and group.
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(width, np.int64)
        rank[order] = np.arange(len(order))
        langs, sources = _strings(slices, "langs"), _strings(slices, "sources")
        keys, n, docs = _sums(
            rank[keys % width] * len(langs) + doc_group[keys // width], n, np.ones(len(n), np.int64)
        )
        term, group = order[keys // len(langs)], keys % len(langs)
        found, edges = _edges(bucket[term])
        first = np.flatnonzero(np.concatenate((np.ones(min(len(term), 1), bool), term[1:] != term[:-1])))
        term_edges = np.searchsorted(first, edges)
        groups = [np.unique(group[a:b], return_inverse=True) for a, b in zip(edges[:-1], edges[1:])]
        low, high = _halves(np.concatenate([src for _, src in groups] or [edges[:0]]))
        columns = {
            "langs": pa.array([[langs[g] for g in own] for own, _ in groups], pa.list_(pa.string())),
            "sources": pa.array([[sources[g] for g in own] for own, _ in groups], pa.list_(pa.string())),
            "terms": pc.binary_join(_lists(term_edges, words.take(pa.array(term[first]))), " "),
            "n_src": _lists(term_edges, np.diff(np.append(first, len(term)))),
            "low": _lists(edges, low),
            "high": _lists(edges, high),
            "docs": _lists(edges, docs),
            "more": _lists(edges, n - docs),
        }
        return pa.Table.from_arrays(
            [pa.array(found, pa.int32()), *(columns[f.name].cast(f.type) for f in list(schema)[1:])], schema=schema
        )

    return count


class _Bucket:
    """The terms of one bucket, summed over slices."""

    def __init__(self):
        self.terms: dict[str, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch, row: int) -> None:
        groups = zip(_strings(batch, "langs", row), _strings(batch, "sources", row))
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in groups], np.int64)
        words = batch.column("terms")[row].as_py().split(" ")
        term = np.array([self.terms.setdefault(t, len(self.terms)) for t in words], np.int64)
        docs = _ints(batch, "docs", row)
        self.held.append((np.repeat(term, _ints(batch, "n_src", row)), group[_whole(batch, row)],
                          docs + _ints(batch, "more", row), docs))
        self.size += len(self.held[-1][0])
        if self.size > HELD:
            self.held = [self.summed()]
            self.size = len(self.held[0][0])
            self.size = 0 if self.size > HELD // 2 else self.size  # else every row would sum again

    def summed(self) -> tuple[np.ndarray, ...]:
        term, group, n, docs = (np.concatenate(c) for c in zip(*self.held))
        keys, n, docs = _sums(term * len(self.groups) + group, n, docs)
        return keys // len(self.groups), keys % len(self.groups), n, docs

    def kept(self, least_docs: int) -> Iterator[dict]:
        """A row per language: its terms in enough documents, with their counts by source."""
        term, group, n, docs = self.summed()
        words, groups = list(self.terms), list(self.groups)
        langs = sorted({lang for lang, _ in groups})
        lang_of = np.array([langs.index(lang) for lang, _ in groups])[group]
        for number, lang in enumerate(langs):
            mine = lang_of == number
            t, g, count = term[mine], group[mine], n[mine]
            found, lang_docs, lang_n = _sums(t, docs[mine], count)
            good = lang_docs >= least_docs
            found, lang_n = found[good], lang_n[good]
            if not len(found):
                continue
            at = np.minimum(np.searchsorted(found, t), len(found) - 1)
            here = found[at] == t
            at, g, count = at[here], g[here], count[here]
            own, src = np.unique(g, return_inverse=True)
            totals = np.zeros(len(own), np.int64)
            np.add.at(totals, src, count)
            yield {"lang": lang, "v": len(found), "lang_total": int(lang_n.sum()),
                   "sources": [groups[i][1] for i in own], "totals": totals, "terms": [words[i] for i in found],
                   "lang_n": lang_n, "src": src, "term": at, "n": count}


def _merged(least_docs: int):
    schema = pa.schema(
        [("lang", pa.string()), ("v", pa.int64()), ("lang_total", pa.int64()), ("sources", pa.list_(pa.string())),
         ("totals", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("lang_n", pa.list_(pa.int64())),
         ("src", pa.list_(pa.int32())), ("term", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column("bucket")[row].as_py()
                if bucket != now:
                    if held:
                        yield pa.RecordBatch.from_pylist(list(held.kept(least_docs)), schema)
                    held, now = _Bucket(), bucket
                held.add(batch, row)
        if held:
            yield pa.RecordBatch.from_pylist(list(held.kept(least_docs)), schema)

    return run


def kept_terms(docs: DataFrame, least_docs: int, buckets: int) -> DataFrame:
    """Rows of arrays, per language and bucket: terms in at least `least_docs` documents, counts by source."""
    slices = _slices(docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                   for c in ("text", "lang", "source")]), buckets)
    split = (
        slices.where("bucket IS NOT NULL")
        .select("slice", "bucket", "start", "chunks")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_split, SPLIT)
        .withColumnRenamed("slice", "of")
    )
    counted = (
        slices.where("bucket IS NULL")
        .drop("bucket", "start", "chunks")
        .groupBy("slice")
        .cogroup(split.groupBy("of"))
        .applyInArrow(_slice_counts(buckets), COUNTS)
    )
    summed = counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merged(least_docs), KEPT)
    return common.staged(summed, "kept-terms")


def _shares(n: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """Smoothed shares in billionths; in Python's integers where 64 bits don't do."""
    if n.max(initial=0) < 9_000_000_000:
        return 1 + BILLION * (n + 1) // total
    return (1 + BILLION * (n.astype(object) + 1) // total).astype(np.int64)


class _Row:
    """The terms of one bucket in one language, with the totals of the whole language."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.lang = batch.column("lang")[row].as_py()
        self.names = _strings(batch, "all_sources", row)
        place = {name: i for i, name in enumerate(self.names)}
        self.v = batch.column("all_v")[row].as_py()
        self.lang_total = batch.column("all_total")[row].as_py()
        self.totals = _ints(batch, "all_totals", row)
        own = np.array([place[s] for s in _strings(batch, "sources", row)], np.int64)
        self.src = own[_ints(batch, "src", row)]
        self.term, self.n = _ints(batch, "term", row), _ints(batch, "n", row)
        self.n_terms = batch.column("v")[row].as_py()
        if self.v:
            self.zero = _shares(np.zeros(len(self.names), np.int64), self.totals + self.v)
            self.p = _shares(self.n, self.totals[self.src] + self.v)


PAIRS = "lang string, source string, item string, value long"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed divergences, both ways, of the sources of two blocks, over all terms this task sees."""
    held: dict[tuple[str, int, int], tuple[list[str], np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, lo, hi), (names, value) in held.items():
            left, right = _block(len(names), lo), _block(len(names), hi)
            pairs = [(g, h) for g in left for h in right if g != h]
            pairs += [(h, g) for g, h in pairs] if lo != hi else []
            at = {g: i for i, g in enumerate([*left, *([] if lo == hi else right)])}
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(pairs), pa.string()),
                    "source": pa.array([names[g] for g, _ in pairs], pa.string()),
                    "item": pa.array([names[h] for _, h in pairs], pa.string()),
                    "value": pa.array([int(value[at[g], at[h]]) for g, h in pairs], pa.int64()),
                }
            )
        held.clear()

    for batch in batches:
        for number in range(batch.num_rows):
            row = _Row(batch, number)
            lo, hi = batch.column("lo")[number].as_py(), batch.column("hi")[number].as_py()
            own = np.array([*_block(len(row.names), lo), *([] if lo == hi else _block(len(row.names), hi))], np.int64)
            if (row.lang, lo, hi) not in held and len(held) * SOURCES * SOURCES > HELD:
                yield from flush()
            _, value = held.setdefault((row.lang, lo, hi), (row.names, np.zeros((len(own), len(own)), np.int64)))
            if row.v:
                _add_pairs(row, own, value)
    yield from flush()


def _block(n: int, number: int) -> range:
    return range(number * SOURCES, min(n, (number + 1) * SOURCES))


def _add_pairs(row: _Row, own: np.ndarray, value: np.ndarray) -> None:
    place = np.full(len(row.names), -1)
    place[own] = np.arange(len(own))
    here = place[row.src] >= 0
    seen, term = np.unique(row.term[here], return_inverse=True)
    at, p, zero = place[row.src[here]], row.p[here], row.zero[own]
    # Terms that none of these sources has add the same each.
    away = (zero[:, None] - zero[None, :]) ** 2
    value += (row.n_terms - len(seen)) * (away // zero[None, :])
    order = np.argsort(term, kind="stable")
    at, term, p = at[order], term[order], p[order]
    for start in range(0, len(seen), STEP):
        a, b = np.searchsorted(term, [start, start + STEP])
        shares = np.repeat(zero[:, None], min(STEP, len(seen) - start), axis=1)
        shares[at[a:b], term[a:b] - start] = p[a:b]
        for g in range(len(own)):
            value[g] += ((shares - shares[g]) ** 2 // shares).sum(axis=1)


def _best_terms(most: int):
    """The terms of each source that stand out most, of all this task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[str, str], list] = {}
        least: dict[tuple[str, str], int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(*group, -value, item) for group, found in best.items()
                    for value, item in heapq.nsmallest(most, found)]
            if rows:
                lang, source, value, item = zip(*rows)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array(lang, pa.string()), "source": pa.array(source, pa.string()),
                     "item": pa.array([i.decode() for i in item], pa.string()), "value": pa.array(value, pa.int64())}
                )
            best.clear()
            least.clear()

        for batch in batches:
            for number in range(batch.num_rows):
                row = _Row(batch, number)
                if not row.v or not len(row.n):
                    continue
                words = _strings(batch, "terms", number)
                q = _shares(_ints(batch, "lang_n", number), row.lang_total + row.v)[row.term]
                value = (row.p - q) ** 2 // q
                order = np.flatnonzero(row.p > q)
                order = order[np.argsort(row.src[order], kind="stable")]
                for src, run_ in _runs(row.src[order]):
                    group, mine = (row.lang, row.names[src]), order[run_]
                    mine = mine[value[mine] >= least.get(group, -1)]
                    found = best.setdefault(group, [])
                    found += [(-v, words[t].encode()) for v, t in zip(value[mine].tolist(), row.term[mine].tolist())]
                    if len(found) > 8 * most:
                        found[:] = heapq.nsmallest(most, found)
                        least[group] = -found[-1][0]
            if len(best) * 8 * most > HELD:
                yield from flush()
        yield from flush()

    return run


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return values.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def divergence(
    docs: DataFrame, least_docs: int = 3, top_terms: int = 200, buckets: int = BUCKETS
) -> DataFrame:
    """`lang, source, part, item, value, rank`: other sources (`pair`) and own terms (`term`) by divergence."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    kept = kept_terms(docs, least_docs, buckets)
    totals = (
        kept.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("s"))
        .groupBy("lang", F.col("s.sources").alias("source"))
        .agg(F.sum("s.totals").alias("total"))
    )
    langs = (
        groups.join(totals, ["lang", "source"], "left")
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("s"))
        .join(
            kept.groupBy("lang").agg(F.sum("v").alias("all_v"), F.sum("lang_total").alias("all_total")), "lang", "left"
        )
        .select(
            "lang", F.col("s.source").alias("all_sources"), F.col("s.total").alias("all_totals"),
            F.coalesce("all_v", F.lit(0)).alias("all_v"), F.coalesce("all_total", F.lit(0)).alias("all_total"),
        )
    )
    langs = common.staged(langs, "language-totals")
    # A language without kept terms has pairs all the same.
    nothing = {f.name: f.dataType for f in kept.schema.fields if f.name not in ("lang", "v")}
    empty = langs.select("lang", F.lit(0).cast("long").alias("v"),
                         *[(F.array() if t.typeName() == "array" else F.lit(0)).cast(t).alias(n) for n, t in nothing.items()])
    n_blocks = F.ceil(F.size("all_sources") / SOURCES).cast("int")
    pairs = (
        kept.unionByName(empty)
        .join(langs, "lang")
        .withColumn("lo", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .withColumn("hi", F.explode(F.sequence("lo", n_blocks - 1)))
        .mapInArrow(_pairs, PAIRS)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    best = kept.join(langs, "lang").mapInArrow(_best_terms(top_terms), PAIRS)
    return _ranked(pairs, "pair").unionByName(_ranked(best, "term").where(F.col("rank") <= top_terms))
