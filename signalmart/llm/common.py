"""What the operators share: shared scratch tables, Arrow batches, text cut at word gaps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalmart.sources.files import Folder

SLICE_BYTES = 2 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession) -> str:
    """Folder all executors share: `spark.checkpoint.dir`; where it is unset, one of our own (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="signalmart-checkpoint-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder for a staged table; all of an application's go when it ends."""
    base = f"{scratch(spark)}/llm/{spark.sparkContext.applicationId}"
    Folder(spark, base).delete_at_end()
    return f"{base}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: a cut in the lineage that survives executors.

    The shuffle files of this one write are let go with it; nothing reads them again.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just `doc_id` and `text`, a null text as the empty one; other columns are not read."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


SMALLEST = -(1 << 63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, k, h, text`: a key `(k, h)` of id and text for joins, also where ids repeat or are null.

    Rows equal in id and text have one key, and so one result each.
    """
    return texts(docs, id_col, text_col).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(SMALLEST)).alias("k"),
        F.xxhash64("text").alias("h"),
        "text",
    )


def slices(
    batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about `most` bytes of text, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for row, length in enumerate(lengths):
            if size and size + length > most:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += int(length)
        if start < batch.num_rows:
            yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of about `most` bytes of text each: large ones cut, small ones put together."""
    held, size = [], 0
    for piece in slices(batches, most, column):
        here = pc.sum(pc.binary_length(piece.column(column))).as_py() or 0
        if held and size + here > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(piece)
        size += here
    if held:
        yield pa.concat_batches(held)


def map_slices(
    df: DataFrame, row_function: Callable[[pa.RecordBatch], dict], schema: str
) -> DataFrame:
    """Apply a function of an Arrow slice that returns columns; no rows are exchanged."""

    def run(batches):
        for piece in slices(batches):
            yield pa.RecordBatch.from_pydict(row_function(piece))

    return df.mapInArrow(run, schema)


def with_columns(
    docs: DataFrame, text_col: str, function: Callable[[list[str]], dict], added: str
) -> DataFrame:
    """`docs`, all columns and rows, with what `function` makes of the texts (null: empty).

    `added` is the schema of the new columns; one named like an old one takes its place.
    """
    old = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.toDF(*old.values())
    new = {f.name: f"_out_{i}" for i, f in enumerate(T.StructType.fromDDL(added).fields)}
    schema = T.StructType(
        inner.schema.fields
        + [T.StructField(new[f.name], f.dataType) for f in T.StructType.fromDDL(added).fields]
    )

    def run(batches):
        for piece in slices(batches, column=old[text_col]):
            made = function([t or "" for t in piece.column(old[text_col]).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, *(made[c] for c in new)], names=[*piece.schema.names, *new.values()]
            )

    done = inner.mapInArrow(run, schema)
    kept = [F.col(i).alias(c) for c, i in old.items() if c not in new]
    return done.select(*kept, *[F.col(i).alias(c) for c, i in new.items()])


def cut(text: str, most: int = 1 << 20) -> Iterator[str]:
    """Pieces of a long text, cut at single spaces between other characters: " ".join gives it back."""
    start = 0
    while len(text) - start > most:
        at = start + most
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                at = -1
                break
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:] if start else text
