"""Answers to a table of requests."""

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.operators import collections as C
from pagewell.operators.embed import Embedder
from pagewell.operators.ordering import rank_offsets
from pagewell.operators.requests import decode_requests, deleted_json, documents_json, hits_json, stored_json
from pagewell.operators.search import search_batch


def _good(requests: DataFrame, tool: str, enabled: Collection[str] | None) -> DataFrame:
    return decode_requests(requests, enabled).where((F.col("tool") == tool) & F.col("reason").isNull())


def answer_searches(
    points: DataFrame, requests: DataFrame, embedder: Embedder | None = None,
    enabled: Collection[str] | None = None,
) -> DataFrame:
    """`request_id, result` of all good search requests of `request_id, tool, args`.

    `points` has `collection, point_id, vector, payload`. Each request searches its own
    collection with its own limit; all of them share one scan. A collection without
    points gives an empty list.
    """
    asked = _good(requests, "search", enabled).select(
        F.col("request_id").alias("query_id"), F.col("collection_name").alias("collection"),
        "query", "limit")
    hits = search_batch(points, asked, None, embedder, ["collection"])
    return asked.select("query_id").join(hits_json(hits), "query_id", "left").select(
        F.col("query_id").alias("request_id"),
        F.coalesce(F.col("result"), F.lit("[]")).alias("result"))


def answer_lists(catalog: DataFrame, requests: DataFrame, enabled: Collection[str] | None = None) -> DataFrame:
    """`request_id, result` of all good list_collections requests: the names in order."""
    names = C.list_collections(catalog).agg(F.to_json(F.sort_array(F.collect_list("name"))).alias("result"))
    return _good(requests, "list_collections", enabled).select("request_id").crossJoin(names)  # one row


def answer_pages(
    points: DataFrame, keys: DataFrame, requests: DataFrame, enabled: Collection[str] | None = None,
) -> DataFrame:
    """`request_id, result` of all good get_documents requests: a page each and the next offset.

    `keys` are the live `collection, point_id` and maybe other columns that name a row of
    `points`, which have them and `payload`. Offsets are merged with the ids, so all pages
    are found at once; payloads are fetched for rows of pages only. A collection without
    points gives an empty page.
    """
    asked = _good(requests, "get_documents", enabled).select(
        "request_id", F.col("collection_name").alias("collection"), "offset", F.col("limit").cast("long").alias("limit"))
    ranked, places = rank_offsets(keys.select("collection", "point_id"), asked)
    upto = F.least(F.col("_from") + F.col("limit"), F.col("_end") - 1)
    rows = places.where(F.col("_from") < F.col("_end")).select(
        "request_id", "limit", F.col("_from"), F.explode(F.sequence("_from", upto)).alias("_rank"))
    found = rows.join(ranked, "_rank").withColumn("_next", F.col("_rank") - F.col("_from") == F.col("limit"))
    following = found.where("_next").select("request_id", F.col("point_id").alias("next_offset"))
    shown = found.where("not _next").select("request_id", "collection", "point_id").join(
        keys, ["collection", "point_id"]).join(points.select(*keys.columns, "payload"), keys.columns)
    pages = shown.groupBy("request_id").agg(F.sort_array(F.collect_list(
        F.struct(F.col("point_id").alias("id"), "payload"))).alias("documents"))
    return asked.select("request_id").join(pages, "request_id", "left").join(
        following, "request_id", "left").select("request_id", documents_json(
            F.coalesce(F.to_json("documents"), F.lit("[]")), F.col("next_offset")).alias("result"))


def answer_additions(requests: DataFrame, enabled: Collection[str] | None = None) -> DataFrame:
    """`request_id, result` of all good add_documents requests: how many documents were sent."""
    sent = _good(requests, "add_documents", enabled)
    return stored_json(sent.select("request_id", F.size("documents").alias("stored_count")))


def answer_deletions(requests: DataFrame, enabled: Collection[str] | None = None) -> DataFrame:
    """`request_id, result` of all good delete_collection requests."""
    told = _good(requests, "delete_collection", enabled)
    return deleted_json(told.select(F.col("request_id").alias("name"))).withColumnRenamed("name", "request_id")


def answer_requests(
    points: DataFrame, keys: DataFrame, catalog: DataFrame, requests: DataFrame, embedder: Embedder | None = None,
    enabled: Collection[str] | None = None,
) -> DataFrame:
    """`request_id, result` of all good requests, reads as of the given tables.

    `points` has `collection, point_id, vector, payload` and what else `keys` has; see the
    answers of each tool. What additions and deletions change is up to the caller, by
    `operators.requests.requested_documents` and `operators.collections`.
    """
    live = points.join(keys, keys.columns)
    answers = answer_searches(live, requests, embedder, enabled)
    for more in (answer_lists(catalog, requests, enabled), answer_pages(points, keys, requests, enabled),
                 answer_additions(requests, enabled), answer_deletions(requests, enabled)):
        answers = answers.unionByName(more)
    return answers
