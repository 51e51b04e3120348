"""Collections as a function of two append-only tables.

The catalog holds one row per creation, write or deletion, the point log the points
of every batch. What is live follows from both; nothing is ever changed in place.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.operators.joins import SALTS
from pagewell.operators.ordering import number_by_id

COSINE = "cosine"
DEFAULT_LIMIT = 10


def _since_deletion(catalog: DataFrame) -> DataFrame:
    """Per name the batch of its last deletion (-1: never) and of its last row."""
    return catalog.groupBy("name").agg(
        F.coalesce(F.max(F.when(F.col("deleted"), F.col("batch_id"))), F.lit(-1))
        .alias("dropped"),
        F.max(F.when(~F.col("deleted"), F.col("batch_id"))).alias("written"))


def live_collections(catalog: DataFrame) -> DataFrame:
    """`name, vector_size, distance, dropped` of the collections that exist.

    The definition is the first one after the last deletion.
    """
    state = _since_deletion(catalog).where(F.col("written") > F.col("dropped"))
    definitions = (
        catalog.where(~F.col("deleted"))
        .select("name", "vector_size", "distance", "batch_id")
        .join(state.select("name", "dropped"), "name")
        .where(F.col("batch_id") > F.col("dropped")))
    return definitions.groupBy("name", "dropped").agg(
        F.min_by("vector_size", "batch_id").alias("vector_size"),
        F.min_by("distance", "batch_id").alias("distance"),
    ).select("name", "vector_size", "distance", "dropped")


def cosine_only(distance: Column) -> Column:
    """The distance in lower case; an error for any other than cosine."""
    lower = F.lower(distance)
    return F.when(lower == COSINE, lower).otherwise(F.raise_error(
        F.concat(F.lit("Unsupported distance: "), F.coalesce(distance, F.lit("null")))))


def create_collections(catalog: DataFrame, definitions: DataFrame) -> DataFrame:
    """Catalog rows for those definitions whose names do not exist yet.

    `definitions` has `name, vector_size, distance, batch_id`. A name defined twice
    is created once, by its first batch.
    """
    first = definitions.groupBy("name").agg(
        F.min_by("vector_size", "batch_id").alias("vector_size"),
        F.min_by("distance", "batch_id").alias("distance"),
        F.min("batch_id").alias("batch_id"))
    missing = first.join(live_collections(catalog).select("name"), "name", "left_anti")
    return missing.select(
        "name", F.col("vector_size").cast("int").alias("vector_size"),
        cosine_only(F.col("distance")).alias("distance"),
        F.col("batch_id").cast("long").alias("batch_id"), F.lit(False).alias("deleted"))


def ensure_collections(catalog: DataFrame, writes: DataFrame, vector_size: int) -> DataFrame:
    """Catalog rows for the collections that `name, batch_id` writes to and are missing."""
    return create_collections(catalog, writes.select(
        "name", F.lit(vector_size).alias("vector_size"), F.lit(COSINE).alias("distance"),
        "batch_id"))


def delete_collections(names: DataFrame) -> DataFrame:
    """Catalog rows that delete the collections `name` as of `batch_id`.

    Whether they exist is not checked.
    """
    return names.select(
        "name", F.lit(None).cast("int").alias("vector_size"),
        F.lit(None).cast("string").alias("distance"),
        F.col("batch_id").cast("long").alias("batch_id"), F.lit(True).alias("deleted"))


def live_keys(log: DataFrame, catalog: DataFrame) -> DataFrame:
    """`collection, point_id` and the order columns of the rows that are live.

    Those are the newest of every point written since its collection was last deleted.
    A point whose newest row is older than the deletion has no live row at all, so
    the deletions are looked up for the winners only. Vectors and payloads are not read.
    The few names are copied to SALTS groups, as one collection may hold most of the points.
    """
    order = ["batch_id", "ordinal", "part"]
    live = _since_deletion(catalog).select(
        F.col("name").alias("collection"), "dropped",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    last = log.groupBy("collection", "point_id").agg(
        F.max(F.struct(*order)).alias("_last")
    ).withColumn("_salt", F.pmod(F.xxhash64("point_id"), F.lit(SALTS)))
    winners = last.join(live, ["collection", "_salt"]).where(
        F.col("_last")["batch_id"] > F.col("dropped"))
    return winners.select(
        "collection", "point_id", *(F.col("_last")[o].alias(o) for o in order))


def live_points(log: DataFrame, catalog: DataFrame) -> DataFrame:
    """The live rows of the log, whole; to count or page them, `live_keys` will do."""
    keys = live_keys(log, catalog)
    return log.join(keys, keys.columns)


def stored_count(points: DataFrame, *keys: str) -> DataFrame:
    """Number of points sent, duplicates counted."""
    return points.groupBy(*keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("stored_count"))


def list_collections(catalog: DataFrame) -> DataFrame:
    """Names of the collections, empty ones too, in order."""
    return live_collections(catalog).select("name").orderBy("name")


def collection_info(catalog: DataFrame, points: DataFrame) -> DataFrame:
    """`name, vector_size, distance, points_count` of the collections."""
    counts = points.groupBy(F.col("collection").alias("name")).agg(
        F.count(F.lit(1)).alias("_n"))
    return live_collections(catalog).join(counts, "name", "left").select(
        "name", "vector_size", "distance",
        F.coalesce(F.col("_n"), F.lit(0)).alias("points_count"))


def scroll_page(
    points: DataFrame, limit: int = DEFAULT_LIMIT, offset: str | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Up to `limit` points from the id `offset` on, in id order, without vectors.

    Every row carries `next_offset`, the id after the page, null on the last one.
    `keys` names the rows of `points` that are live, by `point_id` and maybe other
    columns of it; the page is then found on keys alone and payloads are fetched for
    its rows only.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    rows = points.select("point_id", "payload") if keys is None else keys
    if offset is not None:
        rows = rows.where(F.col("point_id") >= offset)
    page = rows.orderBy("point_id").limit(limit + 1)
    whole = Window.partitionBy()
    page = (
        page.withColumn("_row", F.row_number().over(Window.orderBy("point_id")))
        .withColumn("next_offset", F.max(
            F.when(F.col("_row") == limit + 1, F.col("point_id"))).over(whole))
        .where(F.col("_row") <= limit).drop("_row"))
    if keys is not None:
        page = points.select(*keys.columns, "payload").join(page, keys.columns)
    return page.select("point_id", "payload", "next_offset")


def scroll_all(
    points: DataFrame, limit: int = DEFAULT_LIMIT, keys: DataFrame | None = None,
) -> DataFrame:
    """All pages of a collection: the points with `page`, `row` and `next_offset`.

    `keys` is as in `scroll_page`.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    keys = points.select("point_id") if keys is None else keys
    ranked = number_by_id(keys, "_rank").select(
        F.floor(F.col("_rank") / limit).alias("page"),
        (F.col("_rank") % limit).alias("row"), *keys.columns)
    heads = ranked.where(F.col("row") == 0).select(
        (F.col("page") - 1).alias("page"), F.col("point_id").alias("next_offset"))
    return ranked.join(heads, "page", "left").join(
        points.select(*keys.columns, "payload"), keys.columns
    ).select("page", "row", "point_id", "payload", "next_offset")


def count_documents(points: DataFrame) -> DataFrame:
    """Number of live points per collection."""
    return points.groupBy("collection").agg(F.count(F.lit(1)).alias("documents"))
