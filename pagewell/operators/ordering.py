"""Dense numbering without a single-task sort.

Rows are numbered inside buckets; only the bucket sizes are summed up across
buckets. Buckets must follow the wanted order and hold a bounded number of rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows with distinct ordinals: at most this many fall into one bucket.
BUCKET_BITS = 20


def number_rows(
    rows: DataFrame, name: str, levels: Sequence[Column], order: Sequence[Column],
) -> DataFrame:
    """Adds `name`, the 0-based position of each row in the order.

    `levels` are bucket columns from coarse to fine. Each level sums the sizes of
    its buckets within the bucket above, so no sum runs over more buckets than one
    coarser bucket holds.
    """
    keys = [f"_level{i}" for i in range(len(levels))]
    leveled = rows.select("*", *(c.alias(k) for c, k in zip(levels, keys)))
    sizes = leveled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes
    for depth, key in enumerate(keys):
        above = keys[:depth]
        totals = sizes
        if depth < len(keys) - 1:
            totals = sizes.groupBy(*above, key).agg(F.sum("_rows").alias("_rows"))
        before = (Window.partitionBy(*above).orderBy(key)
                  .rowsBetween(Window.unboundedPreceding, -1))
        starts = totals.select(
            *above, key,
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(f"_start{depth}"))
        offsets = offsets.join(starts, [*above, key])
    start = sum((F.col(f"_start{d}") for d in range(len(keys))), F.lit(0))
    offsets = offsets.select(*keys, start.alias("_start"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        leveled.withColumn("_row", within)
        .join(offsets, keys)
        .withColumn(name, (F.col("_start") + F.col("_row") - 1).cast("long"))
        .drop(*keys, "_row", "_start"))


def number_by_ordinal(rows: DataFrame, name: str, ordinal: str = "ordinal") -> DataFrame:
    """Number rows by a distinct integer column, whatever its gaps."""
    value = F.col(ordinal).cast("long")
    levels = [F.shiftright(value, 2 * BUCKET_BITS), F.shiftright(value, BUCKET_BITS)]
    return number_rows(rows, name, levels, [value])


def number_by_id(rows: DataFrame, name: str, key: str = "point_id") -> DataFrame:
    """Number rows by a distinct hashed id; its first eight hex digits are the bucket,
    the first four the bucket above."""
    levels = [F.substring(F.col(key), 1, 4), F.substring(F.col(key), 1, 8)]
    return number_rows(rows, name, levels, [F.col(key)])


def rank_offsets(keys: DataFrame, offsets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`collection, point_id` numbered from 0 in that order as `_rank`, and `offsets` with the
    rank of the first key from each on (`_from`) and past the collection's last (`_end`).

    `offsets` has `collection, offset` and other columns; a null offset is before all ids,
    a collection without keys has `_from = _end`. Keys and offsets are merged in buckets of
    the beginnings of their ids, of which only the numbers of keys are summed up.
    """
    other = [c for c in offsets.columns if c not in ("collection", "offset")]
    asked = offsets.select(
        "collection", F.coalesce("offset", F.lit("")).alias("_id"), F.lit(0).alias("_key"), F.struct(*other).alias("_asked"))
    merged = keys.select("collection", F.col("point_id").alias("_id"), F.lit(1).alias("_key")).unionByName(
        asked, allowMissingColumns=True)
    levels = {"_level0": F.substring("_id", 1, 4), "_level1": F.substring("_id", 1, 8)}
    merged = merged.select("*", *(c.alias(n) for n, c in levels.items()))
    fine = merged.groupBy("collection", *levels).agg(F.sum("_key").alias("_n"))
    coarse = fine.groupBy("collection", "_level0").agg(F.sum("_n").alias("_n"))
    whole = coarse.groupBy("collection").agg(F.sum("_n").alias("_n"))

    def before(*partition, order):
        window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    starts = (
        fine.select("collection", *levels, before("collection", "_level0", order="_level1").alias("_s1"))
        .join(coarse.select("collection", "_level0", before("collection", order="_level0").alias("_s0")),
              ["collection", "_level0"])
        .join(whole.select("collection", before(order="collection").alias("_s"), F.col("_n").alias("_size")), "collection")
        .select("collection", *levels, (F.col("_s") + F.col("_s0") + F.col("_s1")).alias("_start"),
                (F.col("_s") + F.col("_size")).alias("_end")))
    within = Window.partitionBy("collection", *levels).orderBy("_id", "_key").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = merged.withColumn("_row", F.coalesce(F.sum("_key").over(within), F.lit(0))).join(
        starts, ["collection", *levels]).withColumn("_rank", F.col("_start") + F.col("_row"))
    return (ranked.where("_key = 1").select("collection", F.col("_id").alias("point_id"), "_rank"),
            ranked.where("_key = 0").select("collection", F.col("_rank").alias("_from"), "_end", "_asked.*"))
