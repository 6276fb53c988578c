"""Operator 7, exact substring deduplication over blockwise sorted suffixes.

A byte is removed if a string of SPAN bytes over it also starts in a document with a smaller id.
Every string of SPAN bytes belongs to the smallest GRAM-byte hash inside it (its anchor), which equal
strings share, so the suffixes are dealt to buckets by anchor and each bucket is sorted by itself:

1. Texts are packed into slices, one row each. Slices send the hashes of their anchors, once each and
   cut to 48 bits, to the buckets; those seen in one document only need no sorting (one bit goes back).
2. For the others a slice sends the bytes around the anchor, once per different surrounding, with the
   smallest id that has them.
3. A bucket sorts the suffixes of its surroundings, one block of leading bytes at a time. Suffixes
   that agree in 8 bytes are ordered by the ranks of a difference-cover sample (residues 0, 1, 3 of 7):
   any two of them reach sample places after the same 0 to 6 bytes, and those places were ranked
   before by doubling. Neighbours that agree in SPAN bytes share the smallest id.
4. The slices get these ids back and mark what is covered.

Sizes: buckets grow in number with the input, not in size; a string in a third of all documents is
one entry per slice. A task holds one slice (or one very long text) or one bucket.

Null and empty texts and those under SPAN bytes lose nothing. Rows that repeat an id never cover each
other; null ids come before all others. Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm import common, wordhash

SPAN = 50
GRAM = 20
SLICE_BYTES = 400 << 10
BUCKET_BYTES = 4 << 20  # bytes of text per bucket
BLOCK = 1 << 18  # window starts looked at together
SORT_BLOCK = 1 << 16  # suffixes sorted together
SORT_BYTES = 1 << 20  # surroundings sorted together, all of an anchor's at least
COVER, RESIDUES = 7, (0, 1, 3)
#: For two residues the shift that brings both into the sample.
SHIFT = [[next(d for d in range(COVER) if (a + d) % COVER in RESIDUES and (b + d) % COVER in RESIDUES)
          for b in range(COVER)] for a in range(COVER)]
HASH_MASK = (1 << 48) - 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place on."""
    m = int(wordhash.P)
    parts, size, total, at = {1: data.astype(np.uint64) + np.uint64(1)}, 1, None, 0
    while size * 2 <= GRAM:
        one = parts[size]
        factor = np.uint64(pow(m, size, 1 << 64))
        parts[size * 2] = one[:-size] * factor + one[size:]
        size *= 2
    n = len(data) - GRAM + 1
    while at < GRAM:
        if GRAM - at >= size:
            part = parts[size][at : at + n]
            total = part.copy() if total is None else total * np.uint64(pow(m, size, 1 << 64)) + part
            at += size
        else:
            size //= 2
    return wordhash.mix(total)


def last_minimum(values: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest of every w neighbours, the last of equals, by doubling."""
    best, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < w:
        step = min(size, w - size)
        left, right = best[:-step], best[step:]
        later = right <= left
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, right, left)
        size += step
    return at


class Slice:
    """Texts of one slice, and the runs of window starts that share an anchor."""

    def __init__(self, texts: list[str]):
        encoded = [t.encode() for t in texts]
        self.text = b"".join(encoded)
        self.ends = np.cumsum([len(t) for t in encoded])
        self.begins = self.ends - [len(t) for t in encoded]
        found = [self._runs(a) for a in range(0, len(self.text), BLOCK)]
        found = [f for f in found if f is not None]
        empty = np.zeros(0, np.int64)
        self.first, self.last, self.owner, self.gram = (
            [np.concatenate(x) for x in zip(*found, strict=True)] if found else [empty, empty, empty, np.zeros(0, np.uint64)]
        )

    def _runs(self, a: int):
        data = np.frombuffer(self.text, np.uint8)[a : a + BLOCK + SPAN - 1]
        n = len(data) - SPAN + 1
        if n <= 0:
            return None
        hashes = gram_hashes(data)
        at = last_minimum((hashes >> np.uint64(32)).astype(np.uint32), SPAN - GRAM + 1)
        lo, hi = np.searchsorted(self.ends, (a, a + n - 1), "right")
        owner = np.repeat(
            np.arange(lo, hi + 1),
            np.diff(np.concatenate(([a], np.minimum(self.ends[lo : hi + 1], a + n)))),
        )
        whole = np.arange(a, a + n) + SPAN <= self.ends[owner]
        change = np.ones(n, bool)
        change[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n) - 1
        keep = whole[first]
        first, last = first[keep], last[keep]
        return first + a, last + a, owner[first], hashes[at[first]]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The different anchors, sorted, and whether two documents of the slice have one."""
        order = np.argsort(self.gram, kind="stable")
        gram, owner = self.gram[order], self.owner[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = gram[1:] != gram[:-1]
        start = np.flatnonzero(fresh)
        if not len(start):
            return gram, fresh
        other = np.zeros(len(gram), bool)
        other[1:] = (owner[1:] != owner[:-1]) & ~fresh[1:]
        return gram[start], np.add.reduceat(other.astype(np.int32), start) > 0

    def surroundings(self, ids: list[int], shared: np.ndarray, n_buckets: int):
        """Runs of shared anchors (sorted); per bucket the different surroundings with their smallest id.

        Returns the runs, the `(bucket, ordinal)` of each, and `bucket -> (grams, surroundings, ids)`.
        """
        chosen = np.zeros(len(self.gram), bool)
        if len(shared):
            at = np.minimum(np.searchsorted(shared, self.gram), len(shared) - 1)
            chosen = shared[at] == self.gram
        runs = np.flatnonzero(chosen)
        places, lists = [], {}
        known: dict[bytes, int] = {}
        for first, last, owner, b, gram in zip(
            *(x[runs].tolist() for x in (self.first, self.last, self.owner)),
            bucket_of(self.gram[runs], n_buckets).tolist(),
            self.gram[runs].view(np.int64).tolist(),
            strict=True,
        ):
            around, own = self.text[first : last + SPAN], ids[owner]
            grams, arounds, least = lists.setdefault(b, ([], [], []))
            k = known.get(around)
            if k is None:
                k = known[around] = len(grams)
                grams.append(gram)
                arounds.append(around)
                least.append(own)
            elif own < least[k]:
                least[k] = own
            places.append((b, k))
        return runs, places, lists


def bucket_of(gram: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket by leading bits, so sorted anchors lie bucket by bucket."""
    return ((gram >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _by_bucket(gram: np.ndarray, n_buckets: int) -> list[tuple[int, int, int]]:
    """`bucket, begin, end` of sorted anchors."""
    bucket = bucket_of(gram, n_buckets)
    begin = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(gram) else np.zeros(0, np.int64)
    end = np.append(begin[1:], len(gram))[: len(begin)]
    return list(zip(bucket[begin].tolist(), begin.tolist(), end.tolist(), strict=True))


def _dense(keys: np.ndarray) -> np.ndarray:
    """Rank of every value, from 1, equal values alike."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


def cover_ranks(data: np.ndarray) -> np.ndarray:
    """Rank of the 8 * COVER bytes from each sample place on; 0 elsewhere and behind the end."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8 * COVER, np.uint8)))
    sample = np.flatnonzero(np.isin(np.arange(n) % COVER, RESIDUES))
    key = np.zeros(len(sample), np.int64)
    for d in range(COVER):
        key = key << 8 | padded[sample + d]
    ranks = np.zeros(n + 8 * COVER, np.int32)
    ranks[sample] = _dense(key)
    for step in (COVER, 2 * COVER, 4 * COVER):
        ranks[sample] = _dense(ranks[sample].astype(np.int64) << 32 | ranks[sample + step])
    return ranks


def sorted_block(starts: np.ndarray, lead: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first SPAN bytes; `lead` is their first 8, big-endian."""
    order = np.argsort(lead, kind="stable")
    starts, lead = starts[order], lead[order]
    group = np.cumsum(np.concatenate(([0], lead[1:] != lead[:-1])))
    tied = np.bincount(group)[group] > 1
    own, residue = starts[tied], starts[tied] % COVER
    groups = group[tied].astype(np.int64) << 32
    below = np.zeros(len(own), np.int64)
    classes = [np.flatnonzero(residue == r) for r in range(COVER)]
    for a in range(COVER):
        for b in range(COVER):
            shift = SHIFT[a][b]
            theirs = np.sort(groups[classes[b]] | ranks[own[classes[b]] + shift])
            below[classes[a]] += np.searchsorted(theirs, groups[classes[a]] | ranks[own[classes[a]] + shift])
    # Groups are in order already; inside one the number of smaller suffixes decides.
    key = np.zeros(len(starts), np.int64)
    key[tied] = below
    return starts[np.lexsort((key, group))]


def least_ids(arounds: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For every window of every (different) surrounding the smallest id of any that has it."""
    text = b"".join(arounds)
    data = np.frombuffer(text, np.uint8)
    sizes = np.array([len(a) for a in arounds])
    windows = sizes - SPAN + 1
    begin = np.cumsum(sizes) - sizes
    cut = np.cumsum(windows) - windows
    starts = np.arange(int(windows.sum())) - np.repeat(cut - begin, windows)
    owner = np.repeat(np.arange(len(arounds)), windows)
    ranks = cover_ranks(data)
    lead = np.zeros(len(starts), np.uint64)
    for d in range(8):
        lead = lead << np.uint64(8) | data[starts + d]
    result = ids[owner].copy()
    # Blocks of suffixes by leading bytes, of about SORT_BLOCK each; equal leads stay together.
    n_blocks = -(-len(starts) // SORT_BLOCK)
    splitters = np.unique(np.sort(lead[:: max(1, len(lead) // 4096)])[:: max(1, 4096 // n_blocks)])
    block = np.searchsorted(splitters, lead, "right")
    inverse = np.zeros(len(data), np.int32)
    inverse[starts] = np.arange(len(starts))
    for b in np.unique(block).tolist():
        mine = np.flatnonzero(block == b)
        ordered = sorted_block(starts[mine], lead[mine], ranks)
        fresh = np.ones(len(ordered), bool)
        for p in range(0, len(ordered) - 1, 1 << 16):
            q = min(len(ordered) - 1, p + (1 << 16))
            span = np.arange(SPAN)
            fresh[p + 1 : q + 1] = (data[ordered[p:q, None] + span] != data[ordered[p + 1 : q + 1, None] + span]).any(axis=1)
        first = np.flatnonzero(fresh)
        at = inverse[ordered]
        result[at] = np.repeat(np.minimum.reduceat(result[at], first), np.diff(np.append(first, len(ordered))))
    return np.split(result, cut[1:])


def _steps(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Run lengths and values of an array."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return np.diff(np.append(first, len(values))).tolist(), values[first].tolist()


def resolve(grams: list[int], arounds: list[bytes], ids: list[int]) -> list[tuple[list[int], list[int]]]:
    """Smallest id per window of each entry of a bucket, as run lengths and values."""
    different: dict[bytes, int] = {}
    which = [different.setdefault(a, len(different)) for a in arounds]
    least = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(least, which, np.array(ids, np.int64))
    gram = np.zeros(len(different), np.int64)
    gram[which] = grams
    _, inverse, counts = np.unique(gram, return_inverse=True, return_counts=True)
    several = counts[inverse] > 1
    names = list(different)
    found: list[tuple[list[int], list[int]]] = [
        ([len(a) - SPAN + 1], [m]) for a, m in zip(names, least.tolist(), strict=True)
    ]
    # An anchor with one surrounding is settled; the rest is sorted, some anchors at a time.
    rest = np.flatnonzero(several)
    rest = rest[np.argsort(gram[rest], kind="stable")]
    if len(rest):
        size = np.cumsum([len(names[k]) for k in rest.tolist()])
        part = np.maximum.accumulate(np.where(np.diff(gram[rest], prepend=gram[rest[0]]) != 0, size // SORT_BYTES, 0))
        for own in np.split(rest, np.flatnonzero(np.diff(part)) + 1):
            for k, ids_ in zip(own.tolist(), least_ids([names[k] for k in own.tolist()], least[own]), strict=True):
                found[k] = _steps(ids_)
    return [found[k] for k in which]


SLICES = "sid long, n_bytes long, ids array<long>, texts array<string>"


def _slices(docs: DataFrame) -> DataFrame:
    def run(batches):
        n = 0
        for piece in common.slices(batches, SLICE_BYTES):
            sid = TaskContext.get().partitionId() << 32 | n
            texts = piece.column("text")
            size = sum(len(t.as_buffer()) for t in texts)
            ids = pa.array([piece.column("k").to_pylist()], pa.list_(pa.int64()))
            n += 1
            yield pa.RecordBatch.from_pydict(
                {"sid": pa.array([sid], pa.int64()), "n_bytes": pa.array([size], pa.int64()), "ids": ids,
                 "texts": pa.array([texts.to_pylist()], pa.list_(pa.string()))}
            )

    return docs.select("k", "text").mapInArrow(run, SLICES)


def _rows(batch: pa.RecordBatch | pa.Table, *columns: str):
    """Rows as tuples, one at a time: a slice is large."""
    for k in range(batch.num_rows):
        yield tuple(batch.column(c)[k].as_py() for c in columns)


def _anchors(slices: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for sid, texts in _rows(batch, "sid", "texts"):
                gram, several = Slice(texts).anchors()
                low = (gram & np.uint64(HASH_MASK)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                parts = _by_bucket(gram, n_buckets)
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([b for b, _, _ in parts], pa.int64()),
                        "sid": pa.array([sid] * len(parts), pa.int64()),
                        "grams": pa.array([low[p:q].tobytes() for _, p, q in parts], pa.binary()),
                        "several": pa.array([np.packbits(several[p:q]).tobytes() for _, p, q in parts], pa.binary()),
                    }
                )

    return slices.select("sid", "texts").mapInArrow(run, "bucket long, sid long, grams binary, several binary")


def _shared(anchors: DataFrame) -> DataFrame:
    """`sid, bucket, bits`: which anchors of a slice stand in two documents or more."""

    def run(table: pa.Table) -> pa.Table:
        keys, flags, sizes = [], [], []
        for raw, several in _rows(table, "grams", "several"):
            low = np.zeros((len(raw) // 6, 8), np.uint8)
            low[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
            keys.append(low.view("<u8").ravel())
            sizes.append(len(low))
            flags.append(np.unpackbits(np.frombuffer(several, np.uint8), count=len(low)).astype(bool))
        _, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        mark = counts > 1
        mark[inverse[np.concatenate(flags)]] = True
        bits = np.split(mark[inverse], np.cumsum(sizes)[:-1])
        return pa.table(
            {"sid": table["sid"], "bucket": table["bucket"],
             "bits": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())}
        )

    return anchors.groupBy("bucket").applyInArrow(run, "sid long, bucket long, bits binary")


def _chosen(own: Slice, bits: list[dict], n_buckets: int) -> np.ndarray:
    """Anchors of a slice whose bit is set, sorted."""
    by_bucket = {x["bucket"]: x["bits"] for x in bits or ()}
    gram, _ = own.anchors()
    mask = np.zeros(len(gram), bool)
    for b, p, q in _by_bucket(gram, n_buckets):
        mask[p:q] = np.unpackbits(np.frombuffer(by_bucket[b], np.uint8), count=q - p)
    return gram[mask]


def _surroundings(slices: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for sid, ids, texts, bits in _rows(batch, "sid", "ids", "texts", "bits"):
                own = Slice(texts)
                _, _, lists = own.surroundings(ids, _chosen(own, bits, n_buckets), n_buckets)
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(list(lists), pa.int64()),
                        "sid": pa.array([sid] * len(lists), pa.int64()),
                        "grams": pa.array([x[0] for x in lists.values()], pa.list_(pa.int64())),
                        "arounds": pa.array([x[1] for x in lists.values()], pa.list_(pa.binary())),
                        "least": pa.array([x[2] for x in lists.values()], pa.list_(pa.int64())),
                    }
                )

    return slices.select("sid", "ids", "texts", "bits").mapInArrow(
        run, "bucket long, sid long, grams array<long>, arounds array<binary>, least array<long>"
    )


def _resolved(surroundings: DataFrame) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        rows = list(_rows(table, "grams", "arounds", "least"))
        flat = [[x for row in rows for x in row[c]] for c in range(3)]
        found, at, out = resolve(*flat), 0, {"counts": [], "lengths": [], "values": []}
        for row in rows:
            own = found[at : at + len(row[0])]
            at += len(row[0])
            out["counts"].append([len(n) for n, _ in own])
            out["lengths"].append([x for n, _ in own for x in n])
            out["values"].append([x for _, v in own for x in v])
        kinds = {"counts": pa.int32(), "lengths": pa.int32(), "values": pa.int64()}
        return pa.table(
            {"sid": table["sid"], "bucket": table["bucket"]}
            | {c: pa.array(v, pa.list_(kinds[c])) for c, v in out.items()}
        )

    return surroundings.groupBy("bucket").applyInArrow(
        run, "sid long, bucket long, counts array<int>, lengths array<int>, values array<long>"
    )


def covered(own: Slice, ids: list[int], runs, places, found: dict[int, list]) -> np.ndarray:
    """Bytes of a slice's text to remove."""
    edges = np.zeros(len(own.text) + 1, np.int32)
    for first, owner, (b, k) in zip(own.first[runs].tolist(), own.owner[runs].tolist(), places, strict=True):
        for n, least in found[b][k]:
            if least < ids[owner]:
                edges[first] += 1
                edges[first + n + SPAN - 1] -= 1
            first += n
    return np.cumsum(edges[:-1]) > 0


def _documents(slices: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for ids, texts, bits, answers in _rows(batch, "ids", "texts", "bits", "answers"):
                own = Slice(texts)
                runs, places, _ = own.surroundings(ids, _chosen(own, bits, n_buckets), n_buckets)
                found = {}
                for x in answers or ():
                    steps = list(zip(x["lengths"], x["values"], strict=True))
                    cuts = np.cumsum([0, *x["counts"]]).tolist()
                    found[x["bucket"]] = [steps[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                gone = covered(own, ids, runs, places, found)
                data = np.frombuffer(own.text, np.uint8)
                out: dict[str, list] = {c: [] for c in ("k", "n_bytes", "n_removed", "n_spans", "kept")}
                for k, a, b in zip(ids, own.begins.tolist(), own.ends.tolist(), strict=True):
                    mask = gone[a:b]
                    out["k"].append(k)
                    out["n_bytes"].append(b - a)
                    out["n_removed"].append(int(mask.sum()))
                    out["n_spans"].append(int((mask & ~np.concatenate(([False], mask[:-1]))).sum()) if b > a else 0)
                    out["kept"].append(data[a:b][~mask].tobytes())
                kinds = {"kept": pa.binary()}
                yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    return slices.select("ids", "texts", "bits", "answers").mapInArrow(
        run, "k long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept` of every row; `kept` are the remaining bytes."""
    own = common.keyed(docs, id_col, text_col)
    slices = common.staged(_slices(own), "slices", compression="zstd")
    total = slices.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_buckets = max(1, -(-total // BUCKET_BYTES))
    bits = common.staged(
        _shared(_anchors(slices, n_buckets))
        .groupBy("sid").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits")),
        "anchors",
    )
    marked = slices.drop("n_bytes").join(bits, "sid", "left")
    answers = common.staged(
        _resolved(_surroundings(marked, n_buckets))
        .groupBy("sid").agg(F.collect_list(F.struct("bucket", "counts", "lengths", "values")).alias("answers")),
        "answers",
    )
    done = _documents(marked.join(answers, "sid", "left"), n_buckets)
    return done.select(
        F.when(F.col("k") != common.SMALLEST, F.col("k")).alias("doc_id"),
        "n_bytes", "n_removed", "n_spans", "kept",
    )
