"""The ingest job: sources to points of a collection."""

import os
from collections.abc import Mapping, Sequence
from datetime import datetime
from hashlib import md5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.operators.embed import Embedder
from pagewell.operators.newest import newest_with_copies
from pagewell.operators.parse import parse_pages
from pagewell.operators.points import points_from_documents
from pagewell.operators.reports import report_sketches
from pagewell.plans.registry import PARSERS, Parser
from pagewell.plans.store import CollectionStore
from pagewell.sources.content import fetched_content, missing_content
from pagewell.sources.listing import accepted, rejected, route_sources

DEFAULT_COLLECTION = "documents"


def parse_sources(
    sources: DataFrame, pages: DataFrame | None = None, source_type: str | None = None,
    timestamp: datetime | str | None = None, parsers: Mapping[str, Parser] | None = None,
    distinct: bool = False, exclude_elements: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents and rejects of a source list (`ordinal, source`).

    The content comes from `pages` (`source, content`, one row per source), or from
    a `content` column of the sources themselves. A column `copies` of the sources
    is passed on. `distinct` says that no source comes twice. `exclude_elements` are left out
    of HTML by the library's own parser.
    """
    parsers = PARSERS if parsers is None else parsers
    routed = route_sources(sources, list(parsers), source_type)
    known = accepted(routed)
    if pages is not None:
        fetched = fetched_content(known, pages, distinct)
        missing = missing_content(known, pages)
    else:
        fetched = known.where(F.col("content").isNotNull())
        missing = known.where(F.col("content").isNull()).withColumn(
            "reason", F.lit("not_fetched"))
    rejects = rejected(routed).unionByName(rejected(missing))
    documents = None
    for name, parser in parsers.items():
        settings = {"exclude_elements": exclude_elements} if parser is parse_pages else {}
        found = parser(fetched.where(F.col("source_type") == name).drop("source_type"),
                       timestamp=timestamp, **settings)
        if isinstance(found, tuple):
            found, failed = found
            rejects = rejects.unionByName(failed)
        documents = found if documents is None else documents.unionByName(found)
    return documents, rejects


def distinct_sources(sources: DataFrame) -> DataFrame:
    """Each source once, with its last `ordinal`, and in `copies` how often it came."""
    return sources.groupBy("source").agg(
        F.max("ordinal").alias("ordinal"), F.count(F.lit(1)).alias("copies"))


def every_copy(rejects: DataFrame, sources: DataFrame) -> DataFrame:
    """Rejects of distinct sources, once for each time that a source was listed."""
    listed = sources.select(F.col("ordinal").alias("_ordinal"), F.col("source").alias("_source"))
    return rejects.join(listed, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "ordinal", F.col("_ordinal")).select(*rejects.columns)


def ingest_points(
    sources: DataFrame, pages: DataFrame | None = None, source_type: str | None = None,
    timestamp: datetime | str | None = None, embedder: Embedder | None = None,
    parsers: Mapping[str, Parser] | None = None, exclude_elements: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Points and rejects of a source list, the points distinct by id.

    Of several documents with one source the last one stays, as they share an id;
    `copies` counts them all. Where a repeated source must give the same documents
    again, it is read once: when the content comes from `pages`, or when parsing
    cannot fail.
    """
    certain = set(PARSERS if parsers is None else parsers) == {"html"}
    gone = None
    if pages is not None:
        once = distinct_sources(sources)
    elif certain:
        gone = sources.where(F.col("content").isNull())
        there = sources.where(F.col("content").isNotNull())
        once = newest_with_copies(there, ["source"], ["ordinal"])
    else:
        once = sources.withColumn("copies", F.lit(1).cast("long"))
    documents, rejects = parse_sources(
        once, pages, source_type, timestamp, parsers, distinct=True, exclude_elements=exclude_elements)
    if pages is not None or gone is not None:
        rejects = every_copy(rejects, sources if gone is None else there)
    if gone is not None:
        _, missing = parse_sources(gone, None, source_type, timestamp, parsers)
        rejects = rejects.unionByName(missing)
    return points_from_documents(documents if certain else last_of_source(documents), embedder), rejects


def ingest(
    store: CollectionStore, sources: DataFrame, pages: DataFrame | None = None,
    collection: str = DEFAULT_COLLECTION, source_type: str | None = None,
    timestamp: datetime | str | None = None, parsers: Mapping[str, Parser] | None = None,
    origin: str | None = None, rejects_path: str | None = None,
    exclude_elements: Sequence[str] | None = None, report_path: str | None = None,
) -> int:
    """Parse, embed and store the sources; returns the number of documents sent.

    With `rejects_path` every source that gave no document is added to the table there, and
    with `report_path` the report of this run (`operators.reports`) to that one; a repeated
    write with the same `origin` replaces what it added before.
    """
    points, rejects = ingest_points(
        sources, pages, source_type, timestamp, store.embedder, parsers, exclude_elements)
    part = md5(origin.encode()).hexdigest() if origin is not None else os.urandom(16).hex()
    if rejects_path:
        folder = f"{rejects_path}/write={part}"
        rejects.withColumn("origin", F.lit(origin).cast("string")).write.mode("overwrite").parquet(folder)
        rejects = store.spark.read.schema(rejects.schema).parquet(folder)
    if report_path:
        report_sketches(sources, rejects).write.mode("overwrite").parquet(f"{report_path}/write={part}")
    return store.upsert(collection, points, distinct=True, origin=origin)


def last_of_source(documents: DataFrame) -> DataFrame:
    """The last document of each source in input order; `copies` adds up. Found before
    anything is embedded, on the columns that tell the order alone."""
    counted = documents if "copies" in documents.columns else documents.withColumn("copies", F.lit(1).cast("long"))
    keys = counted.groupBy(F.col("source").alias("_source")).agg(
        F.max(F.struct("ordinal", "part")).alias("_last"), F.sum("copies").alias("_all"))
    same = (F.col("source").eqNullSafe(F.col("_source")) & F.col("ordinal").eqNullSafe(F.col("_last")["ordinal"])
            & F.col("part").eqNullSafe(F.col("_last")["part"]))
    return counted.join(keys, same).withColumn("copies", F.col("_all")).drop("_source", "_last", "_all")
