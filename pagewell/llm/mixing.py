"""Mixing sources to target weights by systematic sampling.

Within a source every document is expected `target / source size` times. Documents are
ordered by size, the expected copies are summed up along that order from one random
offset, and a document is taken once for each integer that its step crosses. Because of
the order the words taken differ from the target by about the largest document.

The running sum needs a document's place within its source. Places are counted inside
buckets of (source, size, hash of the id), whose number follows the row count, and only
bucket sizes are summed up; a source with a third of all rows is many buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.llm.quality import sketch_bin
from pagewell.llm.shared import materialise, table
from pagewell.llm.words import count_words

#: Expected copies are kept in multiples of 2^-24, so that sums are exact.
BITS = 24
#: Rows that a bucket of places is meant to hold.
BUCKET_ROWS = 20_000
#: Sources so many at most are broadcast (about 100 bytes each); more are joined.
BROADCAST_SOURCES = 50_000
#: Weights of the sources in order, repeating; share of all sizes; most copies.
WEIGHTS, SHARE_PERCENT, MOST = (5, 2, 1), 150, 2
SEED = 42
ADDED = ("size", "source_size", "target", "copies")


def source_sizes(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))


def cycled_weights(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """`sources` with `weight`, repeating along the order of code points, null last.

    Sources are numbered in one task: one row per source, not per document.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*(F.lit(w) for w in weights))
    return sources.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))))


def targets(weighted: DataFrame, share_percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """`source, source_size, weight` rows with `target`, in the unit of the sizes.

    The targets share `share_percent` of all sizes by weight; none goes beyond `most`
    times its source's size, and what is cut off is shared among the others by weight
    until none is above. Sources are filled up in order of cap per weight; the first at
    which the rest, shared by weight, stays within its cap sets the level of the rest.
    """
    cap = F.col("source_size") * most
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goal = F.sum("source_size").over(everything) * F.lit(share_percent / 100)
    rest = (goal - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(onward)
    leveled = weighted.select("*", cap.alias("_cap"), rest.alias("_level"))
    fits = F.col("_level") * F.col("weight") <= F.col("_cap")
    found = leveled.select("*", F.first(F.when(fits, F.col("_level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_rest"))
    full = F.col("_cap").cast("double")
    return found.select(
        "source", "source_size", "weight",
        F.coalesce(F.least(full, F.col("_rest") * F.col("weight")), full).alias("target"))


def _digits(value: Column, seed: int) -> Column:
    """32 even bits that SQL can compute too."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("-")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, size: Column | None = None, weights: DataFrame | None = None,
        key: str = "doc_id", seed: int = SEED, share_percent: int = SHARE_PERCENT,
        most: int = MOST) -> DataFrame:
    """The rows of `docs` with `size, source_size, target, copies`.

    size: a document's size, by default the number of words of `text` (null: 0).
    weights: `source, weight` (above 0; a source without one is not taken); by default
    `WEIGHTS` repeated along the sources. A null source is a source of its own. Ties in
    size are ordered by a hash of the key; repeated rows, and rows with equal or null
    keys, are documents of their own. Documents and sources of size 0 get no more than
    their source's share of copies, which is 0 for an empty source. An empty table gives
    an empty one. Columns named as the added ones are replaced. The same table and seed
    give the same copies.
    """
    size = count_words(F.col("text")) if size is None else size
    sizes = materialise(docs.select("source", F.col(key).alias("_key"), size.cast("long").alias("size")), "sizes")
    sources = source_sizes(sizes)
    if weights is None:
        weighted = cycled_weights(sources)
    else:
        given = weights.select(F.col("source").alias("_source"), "weight")
        weighted = sources.join(given, sources["source"].eqNullSafe(F.col("_source"))).drop("_source")
    step = F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size") * (1 << BITS))).otherwise(0)
    aims = materialise(targets(weighted, share_percent, most).select(
        F.col("source").alias("_source"), "source_size", "target", step.cast("long").alias("_step"),
        F.shiftright(_digits(F.coalesce("source", F.lit("\0")), seed), 32 - BITS).alias("_offset")), "aims")

    largest = sizes.groupBy("source", sketch_bin(F.col("size"))).count().agg(F.max("count")).first()[0] or 1
    bits = min(32, math.ceil(math.log2(max(1.0, largest / BUCKET_ROWS))))

    def bucket(value: Column, id_: Column) -> list[Column]:
        return [-sketch_bin(value).alias("_bin"),
                F.shiftright(_digits(id_, seed), 32 - bits).alias("_part")]

    # Places before each bucket, from the counts of buckets alone.
    counts = sizes.select("source", *(c.alias(n) for c, n in zip(
        bucket(F.col("size"), F.col("_key")), ("_bin", "_part")))
    ).groupBy("source", "_bin", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    back = (Window.unboundedPreceding, -1)
    bins = counts.groupBy("source", "_bin").agg(F.sum("_rows").alias("_rows")).select(
        F.col("source").alias("_source"), F.col("_bin").alias("_bin2"), F.coalesce(F.sum("_rows").over(
            Window.partitionBy("source").orderBy("_bin").rowsBetween(*back)), F.lit(0)).alias("_above"))
    parts = counts.select("source", "_bin", "_part", F.coalesce(F.sum("_rows").over(
        Window.partitionBy("source", "_bin").orderBy("_part").rowsBetween(*back)), F.lit(0)).alias("_beside"))
    starts = parts.join(bins, parts["source"].eqNullSafe(bins["_source"]) & (
        F.col("_bin") == F.col("_bin2"))).select(
        F.col("source").alias("_source2"), F.col("_bin").alias("_bin2"), F.col("_part").alias("_part2"),
        (F.col("_above") + F.col("_beside")).alias("_start"))

    rows = docs.select(F.struct("*").alias("_doc"), F.col("source").alias("_s"), F.col(key).alias("_key"),
                       size.cast("long").alias("size"))
    rows = rows.select("*", *(c.alias(n) for c, n in zip(
        bucket(F.col("size"), F.col("_key")), ("_bin", "_part"))))
    within = F.row_number().over(Window.partitionBy("_s", "_bin", "_part").orderBy(
        _digits(F.col("_key"), seed), F.col("size").desc(), F.col("_key")))
    placed = rows.select("*", (within - 1).alias("_within")).join(
        starts, F.col("_s").eqNullSafe(F.col("_source2")) & (F.col("_bin") == F.col("_bin2"))
        & (F.col("_part") == F.col("_part2")))
    small = F.broadcast(aims) if aims.count() <= BROADCAST_SOURCES else aims
    aimed = placed.join(small, F.col("_s").eqNullSafe(F.col("_source")), "left")
    place = F.col("_start") + F.col("_within")

    def crossed(steps: Column) -> Column:
        return F.shiftright(F.col("_offset") + F.col("_step") * steps, BITS)

    taken = F.coalesce(crossed(place + 1) - crossed(place), F.lit(0)).cast("long")
    kept = [F.col(f"_doc.`{c}`") for c in docs.columns if c not in ADDED]
    return aimed.select(*kept, "size", "source_size", "target", taken.alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as it is taken, with its number `copy` from 0; added columns go."""
    kept = [F.col(f"`{c}`") for c in mixed.columns if c not in (*ADDED, "copy")]
    return mixed.where(F.col("copies") > 0).select(
        *kept, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "sized")
    return mix(sized, F.col("size")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL = {"op1_mixing": rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    list_extract([{', '.join(map(str, WEIGHTS))}], 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1)
      % {len(WEIGHTS)}) AS weight
  FROM sized GROUP BY source),
leveled AS (
  SELECT *, {MOST} * source_size AS cap,
    (sum(source_size) OVER () * {SHARE_PERCENT / 100}::DOUBLE - coalesce(sum({MOST} * source_size) OVER (
      ORDER BY {MOST} * source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY {MOST} * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    {MOST} * source_size / weight AS ratio
  FROM sources),
aims AS (
  SELECT source, source_size, weight, coalesce(least(cap::DOUBLE, weight * (
    SELECT level FROM leveled WHERE level * weight <= cap ORDER BY ratio, source NULLS LAST LIMIT 1)),
    cap::DOUBLE) AS target
  FROM leveled),
stepped AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * {1 << BITS})::BIGINT ELSE 0 END AS step,
    ('0x' || substr(md5('{SEED}:' || coalesce(source, chr(0))), 1, 8))::BIGINT >> {32 - BITS} AS u FROM aims),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
    greatest(length(bin(size)) - 7, 0) * 64 + (size >> greatest(length(bin(size)) - 7, 0)) DESC,
    ('0x' || substr(md5('{SEED}:' || doc_id), 1, 8))::BIGINT, size DESC, doc_id) - 1 AS place
  FROM sized)
SELECT doc_id, size, source_size, target,
  (((u + step * (place + 1)) >> {BITS}) - ((u + step * place) >> {BITS})) * size AS taken
FROM placed p JOIN stepped s ON p.source IS NOT DISTINCT FROM s.source"""}
QUERIES = {"op1_mixing": op1_mixing}
