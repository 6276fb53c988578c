"""Operator 5, SimHash near-duplicates by multi-index hashing.

64-bit fingerprints of word shingles; equal fingerprints are one class before anything is paired. A
fingerprint is two 32-bit segments. If two differ in at most 2 bits, either the first segments differ
in at most 1 (the query looks up its segment and the 32 values around it), or the second ones are
equal; full distances are then checked. Segment values that more than HOT classes share are not
paired: their members look up the whole ball of 2,080 fingerprints around them, which gives the same
links by exact keys. A fingerprint has at most 2,080 neighbours, so links stay linear.

Null and empty texts and texts of white space have fingerprint 0, linked like any other. Rows that
repeat an id or a text each get a row. A component without any id has a null id; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm import common, components

SHINGLE = 3
DISTANCE = 2
HOT = 2048
SEED = 42
BLOCK = 1 << 16
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_HASH = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits set in over half the shingle hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros((8, 256), np.int64)
    for start in range(0, n, BLOCK):
        part = words[start : start + BLOCK + shingle - 1]
        own = min(BLOCK, n - start)
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
        octets = np.fromiter(map(_HASH, grams), np.uint64, own).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[k] += np.bincount(octets[:, k], minlength=256)
    bits = (counts @ BITS).ravel() * 2 > n
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, k, h, fp` of every row; `fp` as a signed long."""

    def run(piece: pa.RecordBatch) -> dict:
        own = np.array([fingerprint(t, shingle) for t in piece.column("text").to_pylist()], np.uint64)
        return {c: piece.column(c) for c in ("doc_id", "k", "h")} | {"fp": pa.array(own.view(np.int64))}

    return common.map_slices(
        common.keyed(docs, id_col, text_col), run, "doc_id long, k long, h long, fp long"
    )


def _flips(bits: int, most: int) -> list[int]:
    """Masks of up to `most` of the lowest `bits` bits, as signed 64-bit values."""
    masks = [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(bits), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs `(a, b)`, a < b, of the distinct fingerprints `fp` that differ in at most `distance` (2) bits."""
    if distance != 2:
        raise ValueError("two segments with balls of 1 and 0 are for a distance of 2")
    first, second = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    table = classes.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), first.alias("value")),
        F.struct(F.lit(1).alias("seg"), second.alias("value")),
    )).alias("s")).select("fp", "s.seg", "s.value")
    hot = table.groupBy("seg", "value").count().where(F.col("count") > HOT).select("seg", "value")
    crowded = table.join(hot, ["seg", "value"], "left_semi").select("fp").distinct()
    cold = table.join(hot, ["seg", "value"], "left_anti")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near_first = F.bit_count(F.shiftrightunsigned(F.col("a").bitwiseXOR(F.col("b")), 32))

    one = F.array(*[F.lit(m).cast("long") for m in _flips(32, 1)])
    asked = classes.select(
        F.col("fp").alias("a"), F.explode(F.transform(one, lambda m: first.bitwiseXOR(m))).alias("value")
    ).withColumn("seg", F.lit(0)).unionByName(
        classes.select(F.col("fp").alias("a"), second.alias("value"), F.lit(1).alias("seg"))
    )
    paired = (
        asked.join(cold.withColumnRenamed("fp", "b"), ["seg", "value"])
        .where((F.col("a") < F.col("b")) & (apart <= distance) & ((F.col("seg") == 0) | (near_first == distance)))
        .select("a", "b")
    )
    ball = F.array(*[F.lit(m).cast("long") for m in _flips(64, distance) if m])
    whole = (
        crowded.select(F.col("fp").alias("x"), F.explode(F.transform(ball, lambda m: F.col("fp").bitwiseXOR(m))).alias("fp"))
        .join(classes.select("fp"), "fp")
        .select(F.least("x", "fp").alias("a"), F.greatest("x", "fp").alias("b"))
    )
    return paired.unionByName(whole)


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, k, h, fp, root, component_id` of every row: the smallest fingerprint and id it reaches."""
    marked = common.staged(fingerprints(docs, shingle, id_col, text_col), "simhash")
    classes = common.staged(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes"
    )
    roots = components.connected(links(classes, distance)).withColumnRenamed("node", "fp")
    grouped = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    placed = grouped.join(least, "root").select("fp", "root", "component_id")
    return marked.join(placed, "fp").select("doc_id", "k", "h", "fp", "root", "component_id")


def hex_of(fp: str = "fp"):
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
