"""Embedding near-dedup over a pivot-permutation index.

1. Equal vectors become one class with its number of copies, so a vector that holds a third of the rows is
   one entry from here on.
2. Reference points are taken from a bounded sample of the classes, told by a hash of the vector, so that no
   two of them would link: a crowd of near copies gives one point and isn't cut up by several.
   Their number grows with the root of the classes, up to `MOST_PIVOTS` (and `PIVOT_BYTES`).
3. Every class is described by its `NEAREST` reference points, nearest first, and entered in the inverted
   list of each.
4. Classes that share `SHARED` reference points at least are verified by their cosine in double precision.
   A list is compared in blocks of `BLOCK` rows, block against block, so a hot list is many tasks. A pair is
   taken in the list of the smallest point that it shares, and so counted once. Links leave a task as counts
   and as the spanning links of the components, never as pairs.

No list, candidate or partner is capped. Work within a group of g near copies that are all different is
g * g / 2 products, spread over blocks. Recall is that of the lists: tests measure it against brute force.

Defined cases: vectors that are null, empty or zero, or hold a null or non-finite component, link with
nothing: no links, their own id as component, kept. Vectors of different lengths don't link. A length that
the sample misses has one list of its own, compared whole. Every row is a vector, repeated ids and rows
included; a component's id is its smallest one, null only where all are null (`kept` compares nulls as
equal). Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm import common, components

NEAREST = 8
SHARED = 2
LEAST_PIVOTS, MOST_PIVOTS = 64, 8192
PIVOT_BYTES = 64 << 20
#: Sampled classes for each reference point wanted.
SAMPLE = 4
BLOCK = 2048
#: Pairs looked at together.
STEP = 1 << 17


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that no square overflows or vanishes."""
    values = values.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length, and their vectors as unit rows."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, _unit(flat.reshape(len(rows), int(length)))


def _spread(vectors: np.ndarray, most: int, apart: float) -> np.ndarray:
    """The first vectors, in their order, that are no closer than `apart` to one taken before; `most` at most."""
    taken = np.empty((0, vectors.shape[1]))
    for start in range(0, len(vectors), 256):
        some = vectors[start : start + 256]
        some = some[(some @ taken.T < apart).all(axis=1)]
        own = some @ some.T < apart
        free = np.ones(len(some), bool)
        for i in range(len(some)):
            if free[i]:
                free[i + 1 :] &= own[i, i + 1 :]
        taken = np.concatenate((taken, some[free]))[:most]
        if len(taken) == most:
            break
    return taken


def _pivots(classes: DataFrame, apart: float) -> dict[int, tuple[int, np.ndarray]]:
    """Per vector length the number of its first reference point and the points."""
    n = classes.count()
    length = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    most = int(min(max(LEAST_PIVOTS, 2 * n**0.5), MOST_PIVOTS, max(NEAREST, PIVOT_BYTES // (8 * length))))
    place = F.xxhash64("embedding")
    share = min(1.0, SAMPLE * most / max(n, 1))
    sample = (
        classes.where(F.pmod(place, F.lit(1 << 32)) <= int(share * (1 << 32)))
        .select(place.alias("h"), "embedding")
        .limit(2 * SAMPLE * most)  # twice what the share gives
        .toArrow()
        .sort_by("h")
    )
    found, first = {}, 0
    if sample.num_rows:
        for _, vectors in _matrices(sample.column("embedding").combine_chunks()):
            points = _spread(vectors, most, apart)
            found[vectors.shape[1]] = (first, points)
            first += len(points)
    return found


def _described(classes: DataFrame, pivots: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """Classes with their nearest reference points, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                near: list = [None] * piece.num_rows
                for rows, vectors in _matrices(piece.column("embedding")):
                    first, points = pivots.get(vectors.shape[1], (-vectors.shape[1], None))
                    if points is None:
                        order = np.full((len(rows), 1), first)
                    else:
                        likeness = vectors @ points.T
                        order = first + np.argsort(-likeness, axis=1, kind="stable")[:, :NEAREST]
                    for row, own in zip(rows.tolist(), order):
                        near[row] = own
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(near, pa.list_(pa.int32()))], names=[*piece.schema.names, "near"]
                )

    kept = classes.select("c", "copies", "embedding")
    kind = kept.schema["embedding"].dataType.simpleString()
    return common.staged(kept.mapInArrow(run, f"c long, copies long, embedding {kind}, near array<int>"), "described")


def _compare(threshold: float):
    """Links within one list between two of its blocks."""

    def links(table: pa.Table) -> pa.Table:
        p, lo, hi = (table.column(name)[0].as_py() for name in ("p", "lo", "hi"))
        table = table.combine_chunks()
        block = table.column("block").to_numpy()
        ids, copies = table.column("c").to_numpy(), table.column("copies").to_numpy()
        n = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        for rows, vectors in _matrices(table.column("embedding").chunk(0)):
            lists = table.column("near").chunk(0).take(pa.array(rows))
            near = lists.flatten().to_numpy().reshape(len(rows), -1)
            need = min(SHARED, near.shape[1])
            a, b = np.flatnonzero(block[rows] == lo), np.flatnonzero(block[rows] == hi)
            step = max(1, (8 << 20) // max(len(b), 1))
            ends = []
            for start in range(0, len(a), step):
                some = a[start : start + step]
                i, j = np.nonzero(vectors[some] @ vectors[b].T >= threshold)
                i, j = some[i], b[j]
                if lo == hi:
                    i, j = i[i < j], j[i < j]
                for at in range(0, len(i), STEP):
                    x, y = i[at : at + STEP], j[at : at + STEP]
                    shared = (near[x][:, :, None] == near[y][:, None, :]).any(axis=2)
                    least = np.where(shared, near[x], np.iinfo(np.int32).max).min(axis=1)
                    good = (shared.sum(axis=1) >= need) & (least == p)
                    ends.append((rows[x[good]], rows[y[good]]))
            if ends:
                x, y = (np.concatenate(e) for e in zip(*ends))
                np.add.at(n, x, copies[y])
                np.add.at(n, y, copies[x])
                while True:  # to the smallest place linked, until nothing moves
                    before = root.copy()
                    np.minimum.at(root, x, root[y])
                    np.minimum.at(root, y, root[x])
                    root = root[root]
                    if (root == before).all():
                        break
        linked = n > 0
        return pa.table({"c": ids[linked], "n": n[linked], "root": ids[root[linked]]})

    return links


def _links(described: DataFrame, threshold: float) -> DataFrame:
    """`c, n, root`: linked classes with vectors linked to, and one they are connected with; several rows a class."""
    lists = described.select("c", "copies", "embedding", "near", F.explode("near").alias("p"))
    sizes = (
        described.select(F.explode("near").alias("p"))
        .groupBy("p")
        .agg(F.count("*").alias("size"))
        .where(F.col("size") > 1)
        .select("p", F.ceil(F.col("size") / BLOCK).alias("n_blocks"))
    )
    dealt = (
        lists.join(sizes, "p")
        .withColumn("block", F.pmod(F.xxhash64("c"), F.col("n_blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .drop("other", "n_blocks")
    )
    return dealt.groupBy("p", "lo", "hi").applyInArrow(_compare(threshold), "c long, n long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row of `vec_id, embedding`."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # In this order: a null component makes the second test null.
    usable = F.coalesce(~wrong & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = common.staged(
        rows.where(usable)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("c", F.monotonically_increasing_id()),
        "vector-classes",
    )
    found = common.staged(_links(_described(classes, _pivots(classes, threshold)), threshold), "vector-links")
    roots = components.connected(found.where("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    parts = classes.select("c", "least").join(roots.withColumnRenamed("node", "c"), "c")
    least = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    judged = (
        classes.join(found.groupBy("c").agg(F.sum("n").alias("n")), "c", "left")
        .join(parts.select("c", "root").join(least, "root").drop("root"), "c", "left")
        .select(
            "embedding",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where(usable).join(judged, "embedding").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
