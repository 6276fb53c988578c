"""Key semantics: first wins, insert if absent, latest per key, lag inside hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in a total order.

    `row_number() = 1` is planned with a group limit below the exchange, so each task ships at
    most one row per key and a key that holds a third of the input stays cheap.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def arrival_order() -> list[Column]:
    return [F.col("partition").asc(), F.col("offset").asc()]


def shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: met in a shuffled join, never broadcast through the driver.

    Spark weighs a side by its packed size; as a broadcast table it takes up to twenty times that.
    """
    return side.hint("merge")


def insert_if_absent(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of `new` whose key is not stored yet.

    The stored side is first reduced to the keys that occur in `new`: that semi join can broadcast
    a small batch and then never shuffles the history.
    """
    clashes = stored.select(key).join(new.select(key), key, "left_semi")
    return new.join(clashes, key, "left_anti")


def id_bytes(column: str) -> Column:
    """An id as sixteen bytes: those of a UUID, the digest of any other text."""
    text = F.lower(column)
    uuid = text.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return F.unhex(F.when(uuid, F.replace(text, F.lit("-"), F.lit(""))).otherwise(F.md5(column)))


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The newest row of every key; `order` must put the winner first."""
    return first_per_key(df, [key], order)


def lag_within(
    df: DataFrame, keys: list[str], order: str, values: list[str], buckets: list[Column]
) -> DataFrame:
    """Previous row's `order` and `values` per key, as `prev_<name>`.

    Exactly the window function `lag`, but no task sees a whole key: rows are windowed per key and
    time bucket, and each bucket starts with the last row of the bucket before it. Those last rows
    are found the same way in the next coarser bucket. `buckets` go from fine to coarse and must
    not decrease in `order`; rows equal in `order` are ranked by their values.
    """
    names = [order, *values]
    if not buckets:
        whole = Window.partitionBy(*keys).orderBy(*names)
        return df.withColumns({f"prev_{name}": F.lag(name).over(whole) for name in names})

    level = f"_bucket_{len(buckets)}"
    bucketed = df.withColumn(level, buckets[0])
    tails = (
        bucketed.groupBy(*keys, level)
        .agg(F.max(F.struct(*names)).alias("_tail"))
        .select(*keys, level, "_tail.*")
    )
    carried = (
        lag_within(tails, keys, order, values, buckets[1:])
        .where(F.col(f"prev_{order}").isNotNull())
        .select(*keys, level, *[F.col(f"prev_{name}").alias(name) for name in names])
        .withColumn("_carried", F.lit(True))
    )
    within = Window.partitionBy(*keys, level).orderBy(*names)
    return (
        bucketed.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumns({f"prev_{name}": F.lag(name).over(within) for name in names})
        .where(~F.col("_carried"))
        .drop(level, "_carried")
    )
