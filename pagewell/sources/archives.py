"""Folders of zip archives of pages as a Spark data source.

    spark.dataSource.register(PageArchives)
    pages.write.format("page_archives").mode("append").save("/shared/archives")
    spark.read.format("page_archives").load("/shared/archives")
    read_archives(spark, "/shared/archives", sources=["https://a/b"])

Reading plans from the names and sizes of the archives alone; a task opens one, finds in
its directory the members that begin in its range of bytes and unpacks only those that are
asked for. Archives written here are named after the hash bucket of their sources, so those
without a source asked for stay closed. Archives of other origin are read too.

What is asked for is an option of the read and not a pushed filter: Spark 4.1 keeps what it
has pushed into a Python source for later queries on the same DataFrame and for its other
scans in one query, which then miss rows.
"""

import json
import os
import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage)

#: Bytes of an archive that one task reads; bytes of content that are handed on together.
RANGE_BYTES, BATCH_BYTES = 128 << 20, 8 << 20
#: Comment of archives whose members are named by percent-encoded sources.
MARK = b"pagewell sources"
_NAMED = re.compile(r"-(\d+)-of-(\d+)\.zip$")


def bucket_of(source: str, buckets: int) -> int:
    return zlib.crc32(source.encode()) % buckets


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else os.path.abspath(path))


@dataclass
class Range(InputPartition):
    """The members of an archive whose headers are at `start` up to before `end`."""
    archive: str
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, sources: list[str] | None, beginning: str):
        self.path, self.range_bytes, self.beginning = path, range_bytes, beginning
        self.sources = None if sources is None else set(sources)

    def _wants(self, source: str) -> bool:
        return (self.sources is None or source in self.sources) and source.startswith(self.beginning)

    def _may_hold(self, archive: str) -> bool:
        named = _NAMED.search(archive)
        if self.sources is None or not named:
            return True
        at, buckets = int(named[1]), int(named[2])
        return any(bucket_of(s, buckets) == at for s in self.sources if s.startswith(self.beginning))

    def partitions(self) -> list[InputPartition]:
        system, folder = _place(self.path)
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [Range(f.base_name, start, start + self.range_bytes)
                for f in sorted(found, key=lambda f: f.base_name)
                if f.is_file and f.base_name.endswith(".zip") and not f.base_name.startswith((".", "_"))
                and self._may_hold(f.base_name)
                for start in range(0, max(1, f.size), self.range_bytes)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Range):  # a folder without a fitting archive
            return
        system, folder = _place(self.path)
        rows, size = [], 0
        with system.open_input_file(f"{folder}/{partition.archive}") as file, zipfile.ZipFile(file) as packed:
            ours = packed.comment == MARK
            for member in packed.infolist():
                if not partition.start <= member.header_offset < partition.end:
                    continue
                if not ours and member.is_dir():
                    continue
                source = unquote(member.filename) if ours else member.filename
                if not self._wants(source):
                    continue
                content = packed.read(member).decode("utf-8", "replace")
                rows.append((source, content))
                size += len(content)
                if size >= BATCH_BYTES:
                    yield _batch(partition.archive, rows)
                    rows, size = [], 0
        if rows:
            yield _batch(partition.archive, rows)


def _batch(archive: str, rows: list) -> pa.RecordBatch:
    sources, contents = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(sources, pa.string()), pa.array(contents, pa.string()), pa.array([archive] * len(rows), pa.string())],
        names=["source", "content", "archive"])


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceWriter):
    """Tasks write under hidden names; the job renames what its tasks have told it."""

    def __init__(self, path: str, buckets: int, columns: list[str], overwrite: bool):
        self.path, self.buckets, self.overwrite = path, buckets, overwrite
        self.job = os.urandom(6).hex()
        self.source, self.content = columns.index("source"), columns.index("content")

    def write(self, iterator) -> WriterCommitMessage:
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        attempt = f"{TaskContext.get().taskAttemptId()}-{os.urandom(4).hex()}"
        names, stream, packed, current = [], None, None, None
        try:
            for row in iterator:
                source, content = row[self.source], row[self.content]
                if source is None or content is None:
                    continue
                bucket = bucket_of(source, self.buckets)
                if bucket != current:
                    if packed:
                        packed.close()
                        stream.close()
                    current = bucket
                    names.append(f"_{self.job}-{attempt}-{len(names)}-{bucket:06d}-of-{self.buckets:06d}.zip")
                    stream = system.open_output_stream(f"{folder}/{names[-1]}")
                    packed = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
                    packed.comment = MARK
                # A fixed date, so that equal pages give equal bytes.
                member = zipfile.ZipInfo(quote(source, safe=""), (1980, 1, 1, 0, 0, 0))
                member.compress_type = zipfile.ZIP_DEFLATED
                packed.writestr(member, content.encode() if isinstance(content, str) else bytes(content))
        finally:
            if packed:
                packed.close()
                stream.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        old = [f.path for f in system.get_file_info(fs.FileSelector(folder))
               if f.is_file and f.base_name.endswith(".zip") and not f.base_name.startswith("_")]
        for message in messages:
            for name in message.names if message else ():
                system.move(f"{folder}/{name}", f"{folder}/pages{name}")
        for path in old if self.overwrite else ():
            system.delete_file(path)

    def abort(self, messages: list) -> None:
        system, folder = _place(self.path)
        for message in messages:
            for name in message.names if message else ():
                system.delete_file(f"{folder}/{name}")


class PageArchives(DataSource):
    """`source, content, archive` of the members of a folder's zip archives.

    Options: `path`; `sources`, a JSON list of those to read; `beginning`, what they begin
    with; `rangebytes`, the bytes of an archive that a task reads; `buckets`, the number that
    the names of written archives tell. Contents are UTF-8, other bytes are
    replaced. Repeated sources are rows of their own. Pages without source or content are
    not written. An empty or missing folder has no rows; a damaged archive is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "page_archives"

    def schema(self) -> str:
        return "source string, content string, archive string"

    def reader(self, schema) -> DataSourceReader:
        sources = self.options.get("sources")
        return _Reader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)),
                       None if sources is None else json.loads(sources), self.options.get("beginning", ""))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], int(self.options.get("buckets", 1)), schema.names, overwrite)


def write_archives(pages: DataFrame, path: str, buckets: int, mode: str = "append") -> None:
    """`source, content` as archives, one per hash bucket; each is written by one task."""
    pages.sparkSession.dataSource.register(PageArchives)
    bucket = F.crc32(F.col("source").cast("binary")) % buckets
    rows = pages.select("source", F.col("content"), F.lit(None).cast("string").alias("archive"))
    rows = rows.where("source is not null and content is not null")
    (rows.repartition(buckets, bucket).sortWithinPartitions(bucket).write
     .format("page_archives").option("buckets", buckets).mode(mode).save(path))


def read_archives(
    spark: SparkSession, path: str, sources: Sequence[str] | None = None, beginning: str = "",
) -> DataFrame:
    """All members, or those of a short list of sources (for a long one join) or that begin so."""
    spark.dataSource.register(PageArchives)
    reader = spark.read.format("page_archives").option("beginning", beginning)
    if sources is not None:
        reader = reader.option("sources", json.dumps(list(sources)))
    return reader.load(path)
