"""Incremental ingest: new files of pages become writes to a collection."""

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pagewell import schemas
from pagewell.plans.ingest import DEFAULT_COLLECTION, ingest
from pagewell.plans.registry import Parser
from pagewell.plans.store import CollectionStore
from pagewell.streaming.changes import STATE_STORE, page_changes


def stream_pages(
    spark: SparkSession, path: str, schema: StructType = schemas.PAGE,
    max_files: int | None = None,
) -> DataFrame:
    """Parquet files of pages as a stream, `max_files` per micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def ingest_stream(
    store: CollectionStore, pages: DataFrame, name: str, checkpoint: str,
    collection: str = DEFAULT_COLLECTION, timestamp: datetime | str | None = None,
    rejects_path: str | None = None, source_type: str | None = None,
    parsers: Mapping[str, Parser] | None = None, exclude_elements: Sequence[str] | None = None,
    report_path: str | None = None, changes_only: bool = False,
) -> StreamingQuery:
    """Ingest all pages that have arrived (`ordinal, source, content`), then stop.

    Every micro-batch is one write, recorded under the stream's name and the number
    of the micro-batch. A replay of a recorded one does nothing; a replay of one that
    failed half-way writes it anew, its rejects too. The other settings are those of `ingest`.

    With `changes_only` only pages that are new or changed since their source came last
    go on, by `page_changes`, whose state is in the checkpoint; a micro-batch without any
    writes no batch. It cannot be switched for a checkpoint that exists.
    """

    def write(batch: DataFrame, number: int) -> None:
        local = CollectionStore(batch.sparkSession, "", store.embedder)
        local.points_path, local.catalog_path = store.points_path, store.catalog_path
        local.codes_path = store.codes_path
        local.rejects_path = store.rejects_path
        ingest(local, batch, collection=collection, source_type=source_type, timestamp=timestamp, parsers=parsers,
               origin=f"{name}/{number}", rejects_path=rejects_path, exclude_elements=exclude_elements,
               report_path=report_path)

    def start(rows: DataFrame) -> StreamingQuery:
        return (
            rows.writeStream.queryName(name).foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

    if not changes_only:
        return start(pages.withColumn("ordinal", F.col("ordinal").cast("long")))
    # The query takes its own copy of the settings when it starts.
    setting, settings = "spark.sql.streaming.stateStore.providerClass", pages.sparkSession.conf
    before = settings.get(setting)
    settings.set(setting, STATE_STORE)
    try:
        return start(page_changes(pages).where(F.col("change").isin("insert", "update")).drop("change"))
    finally:
        settings.set(setting, before)
