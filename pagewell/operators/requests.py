"""Tables of requests: decoding, and results as JSON."""

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell import schemas
from pagewell.functions.text import strip
from pagewell.operators.collections import DEFAULT_LIMIT

# The tools and the arguments they need.
REQUIRED = {
    "search": ("collection_name", "query"),
    "list_collections": (),
    "get_documents": ("collection_name",),
    "delete_collection": ("collection_name",),
    "add_documents": ("collection_name", "documents"),
}


def decode_requests(requests: DataFrame, enabled: Collection[str] | None = None) -> DataFrame:
    """Arguments of `request_id, tool, args` as columns, and `reason` for bad ones.

    `args` is a JSON object. A request is bad when its tool is unknown or not in
    `enabled` (null: all are), when the JSON is not valid, when an argument it needs
    is missing, or when `limit` is not a whole number from 0.
    """
    tools = [t for t in REQUIRED if enabled is None or t in enabled]
    raw = F.coalesce(F.col("args"), F.lit("{}"))
    parsed = requests.select(
        "request_id", "tool", F.from_json(raw, schemas.SEARCH_ARGS).alias("_a"),
        (F.try_parse_json(raw).isNotNull() & strip(raw).startswith("{")).alias("_json"))
    given = F.col("_a")["limit"]
    limit = F.coalesce(given.try_cast("int"), F.lit(DEFAULT_LIMIT))
    whole = given.isNull() | (F.regexp_like(given, F.lit("^[0-9]+$")) & (
        given.try_cast("int").isNotNull()))
    complete = F.lit(False)
    for tool in tools:
        needed = F.lit(True)
        for name in REQUIRED[tool]:
            needed &= F.col("_a")[name].isNotNull()
        complete |= (F.col("tool") == tool) & needed
    texts = F.coalesce(
        F.forall(F.col("_a")["documents"], lambda d: F.coalesce(
            d["text"].isNotNull(), F.lit(False))), F.lit(True))
    good = F.coalesce(F.col("_json") & complete & whole & texts, F.lit(False))
    return parsed.select(
        "request_id", "tool",
        F.col("_a")["collection_name"].alias("collection_name"),
        F.col("_a")["query"].alias("query"),
        F.when(F.col("tool").isin("search", "get_documents"), limit).alias("limit"),
        F.col("_a")["offset"].alias("offset"),
        F.col("_a")["documents"].alias("documents"),
        F.when(~good, F.lit("bad_request")).alias("reason"))


def requested_documents(decoded: DataFrame) -> DataFrame:
    """The documents of good add_documents requests, one row each, in request order."""
    return decoded.where(
        (F.col("tool") == "add_documents") & F.col("reason").isNull()
    ).select(
        "request_id", F.col("collection_name").alias("collection"),
        F.posexplode("documents").alias("position", "_document")
    ).select(
        "request_id", "collection", "position",
        F.col("_document")["text"].alias("text"), F.col("_document")["metadata"].alias("metadata"))


def result_json(result: Column) -> Column:
    """A result as JSON text; null fields of payloads are left out."""
    return F.to_json(result)


def _sorted_by(rows: Column, field: str) -> Column:
    """An array of structs in the order of one field; payloads have no order."""
    return F.array_sort(rows, lambda a, b: F.when(a[field] < b[field], -1)
                        .when(a[field] > b[field], 1).otherwise(0))


def hits_json(hits: DataFrame) -> DataFrame:
    """Per query the list of its hits as JSON, best first; a query has k hits at most."""
    hit = F.struct(F.col("point_id").alias("id"), "score", "payload")
    ranked = hits.groupBy("query_id").agg(
        _sorted_by(F.collect_list(F.struct("rank", hit.alias("hit"))), "rank").alias("_hits"))
    return ranked.select("query_id", result_json(
        F.transform("_hits", lambda h: h["hit"])).alias("result"))


def page_json(page: DataFrame) -> DataFrame:
    """A scroll page as one JSON object; a page has at most `limit` rows."""
    document = F.struct(F.col("point_id").alias("id"), "payload")
    collected = page.agg(
        _sorted_by(F.collect_list(document), "id").alias("documents"),
        F.max("next_offset").alias("next_offset"))
    return collected.select(documents_json(F.to_json("documents"), F.col("next_offset")).alias("result"))


def documents_json(documents: Column, next_offset: Column) -> Column:
    """A page of documents, given as JSON; payloads leave out their nulls, a page shows that
    there is no next one."""
    following = F.coalesce(
        F.regexp_extract(F.to_json(F.array(next_offset)), r"^\[(.+)\]$", 1), F.lit("null"))
    return F.concat(F.lit('{"documents":'), documents, F.lit(',"next_offset":'), following, F.lit("}"))


def stored_json(stored: DataFrame) -> DataFrame:
    """Counts of stored documents as JSON objects."""
    others = [c for c in stored.columns if c != "stored_count"]
    return stored.select(*others, F.to_json(F.struct("stored_count")).alias("result"))


def deleted_json(names: DataFrame) -> DataFrame:
    """The answer to each deletion."""
    return names.select("name", F.to_json(F.struct(F.lit(True).alias("deleted"))).alias("result"))
