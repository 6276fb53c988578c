"""Operator 4, line deduplication by pairwise alignment.

A line of a few words meets others by chance, so a line is taken with the lines behind or before it until
there are MIN_WORDS words: such a run is rare. Documents overlap if they share the hash of a run. Every
document is paired with the first holder of each of its runs, whatever their number, so pairs grow with
lines and never with the square of a group, and no run is too frequent to count. A pair is aligned with
patience diff over the shared runs: the longest series that stands in the same order in both; what is left,
moved blocks, is aligned again until nothing is. The aligned common blocks are deleted from the later document.

So a line goes if and only if it lies in a run of consecutive lines, of MIN_WORDS words or more in all, that
also stands in an earlier document; aligning with every earlier document that shares a line finds no more
(any aligned block is covered by its shortest runs, taken forward and backward). Blank lines don't count
between lines; they go where the lines on both sides go, or stand at an end. Whole copies lose all their lines.

Documents are ordered by id, null first; rows that repeat an id are told apart by their text and ordered by
its hash; rows equal in id and text are one document, with one result each. Null and empty texts have one
empty line and lose nothing. A text of fewer than MIN_WORDS words loses nothing. Extra columns are kept by
`dedup`, but for those named like its own; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalmart.llm import common

MIN_WORDS = 5
RUNS = "k long, h long, start int, size int, run binary"
BLOCKS = "array<struct<k: long, h: long, start: int, size: int, earlier: int>>"


def solid_lines(text: bytes) -> list[tuple[int, bytes, int]]:
    """Place, bytes and number of words of every line that isn't blank."""
    found = ((place, line, len(line.split())) for place, line in enumerate(text.split(b"\n")))
    return [x for x in found if x[2]]


def shortest_runs(words: list[int], least: int) -> list[tuple[int, int]]:
    """First line and number of lines of the shortest runs of `least` words from every line on, and up to it."""
    runs = set()
    start = stop = total = 0
    while True:
        while total < least and stop < len(words):
            total += words[stop]
            stop += 1
        if total < least:
            break
        runs.add((start, stop - start))
        total -= words[start]
        start += 1
    stop, start, total = len(words), len(words), 0
    while True:
        while total < least and start > 0:
            start -= 1
            total += words[start]
        if total < least:
            break
        runs.add((start, stop - start))
        stop -= 1
        total -= words[stop]
    return sorted(runs)


def _increasing(pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Longest series of pairs, sorted by the first, whose seconds increase."""
    tails, at, back = [], [], []
    for k, (_, j, _) in enumerate(pairs):
        p = bisect_left(tails, j)
        back.append(at[p - 1] if p else -1)
        tails[p : p + 1], at[p : p + 1] = [j], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def aligned_blocks(shared: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Common blocks (first line, number, first line in the earlier) from shared runs (later, earlier, size).

    Each round is one patience alignment; its runs that go on in both documents are one block.
    """
    rest = sorted(set(shared))
    while rest:
        series = _increasing(rest)
        start, earlier, size = series[0]
        for i, j, n in series[1:]:
            if i - start == j - earlier and i <= start + size:
                size = max(size, i + n - start)
            else:
                yield start, size, earlier
                start, earlier, size = i, j, n
        yield start, size, earlier
        taken = set(series)
        rest = [pair for pair in rest if pair not in taken]


def _runs_of(docs: DataFrame, min_words: int) -> DataFrame:
    def run(batches):
        for piece in (p for batch in batches for p in common.slices([batch])):
            out = ([], [], [], [], [])
            named = zip(piece.column("k").to_pylist(), piece.column("h").to_pylist(), piece.column("text"))
            for k, h, text in named:
                lines = solid_lines(text.as_buffer().to_pybytes())
                for start, size in shortest_runs([w for _, _, w in lines], min_words):
                    whole = b"\n".join([line for _, line, _ in lines[start : start + size]])
                    for column, value in zip(out, (k, h, start, size, xxhash.xxh3_128_digest(whole))):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(out, kinds)], names=["k", "h", "start", "size", "run"]
            )

    return docs.select("k", "h", "text").mapInArrow(run, RUNS)


def repeated_blocks(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`k, h, blocks` of documents that lose lines: places among their lines that aren't blank."""
    runs = common.staged(_runs_of(common.keyed(docs, id_col, text_col), min_words), "line-runs")
    firsts = common.staged(
        runs.groupBy("run")
        .agg(F.min(F.struct("k", "h", "start")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("run", "first"),
        "first-runs",
    )
    shared = (
        runs.join(firsts, "run")
        .where(F.struct("k", "h") > F.struct("first.k", "first.h"))
        .groupBy("k", "h")
        .agg(F.collect_list(F.struct("first.k", "first.h", "start", "size", F.col("first.start").alias("earlier"))).alias("shared"))
    )

    def align(batches):
        for batch in batches:
            out = []
            for rows in batch.column("shared"):
                by_document: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
                for row in rows.as_py():
                    by_document.setdefault((row["k"], row["h"]), []).append((row["start"], row["earlier"], row["size"]))
                out.append(
                    [
                        {"k": k, "h": h, "start": start, "size": size, "earlier": earlier}
                        for (k, h), pairs in sorted(by_document.items())
                        for start, size, earlier in aligned_blocks(pairs)
                    ]
                )
            kind = pa.list_(pa.struct([("k", pa.int64()), ("h", pa.int64()),
                                       *((name, pa.int32()) for name in ("start", "size", "earlier"))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("h"), pa.array(out, kind)], names=["k", "h", "blocks"]
            )

    return shared.mapInArrow(align, f"k long, h long, blocks {BLOCKS}")


def _kept(text: str, blocks: list[dict]) -> tuple[int, int, str]:
    """Number of lines, of lines deleted, and what is left."""
    lines = text.split("\n")
    if not blocks:
        return len(lines), 0, text
    solid = [place for place, _, _ in solid_lines(text.encode())]
    gone = [False] * len(solid)
    for block in blocks:
        gone[block["start"] : block["start"] + block["size"]] = [True] * block["size"]
    out, before, at = [], True, 0
    for place, line in enumerate(lines):
        if at < len(solid) and solid[at] == place:
            before = gone[at]
            at += 1
            stays = not before
        else:  # blank: with the lines around it
            stays = not (before and (at == len(solid) or gone[at]))
        if stays:
            out.append(line)
    return len(lines), len(lines) - len(out), "\n".join(out)


def dedup(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with `n_lines, n_removed, kept_text, blocks`; every row stays, a whole copy with an empty text."""
    found = repeated_blocks(docs, min_words, id_col, text_col)
    old = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    joined = (
        docs.toDF(*old.values())
        .withColumn("k", F.coalesce(F.col(old[id_col]).cast("long"), F.lit(common.SMALLEST)))
        .withColumn("h", F.xxhash64(F.coalesce(F.col(old[text_col]), F.lit(""))))
        .join(found, ["k", "h"], "left")
        .drop("k", "h")
    )

    def rebuild(batches):
        for piece in (p for batch in batches for p in common.slices([batch], column=old[text_col])):
            done = [
                _kept(text or "", blocks or [])
                for text, blocks in zip(piece.column(old[text_col]).to_pylist(), piece.column("blocks").to_pylist())
            ]
            n_lines, n_removed, kept = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_pydict(
                {c: piece.column(c) for c in old.values()}
                | {
                    "n_lines": pa.array(n_lines, pa.int64()),
                    "n_removed": pa.array(n_removed, pa.int64()),
                    "kept_text": pa.array(kept, pa.string()),
                    "blocks": piece.column("blocks"),
                }
            )

    added = T.StructType.fromDDL(f"n_lines long, n_removed long, kept_text string, blocks {BLOCKS}")
    schema = T.StructType(joined.select(*old.values()).schema.fields + added.fields)
    return joined.mapInArrow(rebuild, schema).select(
        *[F.col(new).alias(c) for c, new in old.items() if c not in added.names], *added.names
    )
