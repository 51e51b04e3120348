"""Newest row per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _winners(rows: DataFrame, keys: Sequence[str], order: Sequence[str], *more) -> DataFrame:
    """Keys and order columns of the last row per key."""
    if len(order) == 1:
        # A maximum of one number is kept in a hash table; one of a struct is sorted for.
        return rows.groupBy(*keys).agg(F.max(order[0]).alias(order[0]), *more)
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last"), *more)
    return last.select(
        *keys, *(F.col("_last")[o].alias(o) for o in order),
        *(c for c in last.columns if c not in (*keys, "_last")))


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row that is last in `order`; the order must be distinct per key.

    The winners are found on keys and order columns alone, with partial aggregation
    before the shuffle, and the rows are picked by a join on keys and order. A key with
    many rows is therefore spread over all tasks by its order values. (A semi-join would
    be pushed below unions and find the winners once per branch.)
    """
    return rows.join(_winners(rows, keys, order), [*keys, *order])


def newest_with_copies(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`newest`, with the number of rows each winner stands for in `copies`."""
    copies = F.count(F.lit(1)).alias("copies")
    return rows.join(_winners(rows, keys, order, copies), [*keys, *order])


#: Ids written more than once that are told to all tasks, under 200 bytes each there.
TOLD = 500_000


def newest_of_batches(rows: DataFrame, key: str = "point_id", told: int = TOLD) -> DataFrame:
    """Rows of the last `batch_id` of each key; a batch holds a key once, keys are not null.

    Keys of several batches are counted first, on keys alone. Up to `told` of them are
    broadcast, so that the other columns are not shuffled; more are joined.
    """
    several = rows.groupBy(key).agg(
        F.max("batch_id").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    if several.count() > told:
        return newest(rows, [key], ["batch_id"])
    return rows.join(F.broadcast(several), key, "left").where(
        F.col("_last").isNull() | (F.col("batch_id") == F.col("_last"))).drop("_last")
