"""Token ids in Parquet files made for selective reads.

A file holds documents in ascending order of id. Ids are list columns with dictionary
encoding, the numbers beside them are delta-encoded; row groups hold about `GROUP_TOKENS`
ids and pages have an index, so a read of some documents opens few pages and a read of
the numbers alone opens none of the ids.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewell.llm.shared import materialise, shared_folder, table
from pagewell.llm.tokens import default_path, encoder

GROUP_TOKENS, PAGE_BYTES = 1 << 20, 1 << 16
SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()),
                    ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
MANIFEST = "path string, part int, documents long, tokens long"
DELTA = ("doc_id", "part", "part_start", "n_tokens")
#: Files so many at most have their places broadcast; more are joined.
BROADCAST_FILES = 100_000


def open_output(path: str):
    """A new file in any file system that the tasks can write to."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        system, inside = fs.LocalFileSystem(), path
    else:
        system, inside = fs.FileSystem.from_uri(path.replace("file:///", "/", 1) if path.startswith("file:///") else path)
    system.create_dir(os.path.dirname(inside), recursive=True)
    return system.open_output_stream(inside)


def _write(folder: str, path: str, end_id: int | None):
    def run(batches):
        context = TaskContext.get()
        part, name = context.partitionId(), ""
        tokens = documents = 0
        writer = sink = None
        held: list[tuple] = []

        def flush():
            nonlocal held
            keys = [k for h in held for k in h[0]]
            sizes = np.concatenate([h[1] for h in held])
            starts = np.concatenate([h[2] for h in held])
            ids = np.concatenate([h[3] for h in held]).view(np.int32)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            writer.write_table(pa.table([
                pa.array(keys, pa.int64()), pa.array(np.full(len(keys), part, np.int32)), pa.array(starts),
                pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(ids))], schema=SCHEMA))
            held = []

        for batch in batches:
            keys = batch.column(0).to_pylist()
            at = 0
            for ids, sizes in encoder(path).encode(batch.column(1)):
                if end_id is not None:  # one more id after each document
                    ids = np.insert(ids, np.cumsum(sizes), end_id)
                    sizes = sizes + 1
                if writer is None:
                    name = f"{folder}/part-{part:06d}-{context.taskAttemptId()}.parquet"
                    sink = open_output(name)
                    writer = pq.ParquetWriter(
                        sink, SCHEMA, compression="zstd", use_dictionary=["ids.list.element"],
                        column_encoding=dict.fromkeys(DELTA, "DELTA_BINARY_PACKED"),
                        dictionary_pagesize_limit=1 << 20, data_page_size=PAGE_BYTES, write_page_index=True,
                        sorting_columns=[pq.SortingColumn(0)])
                held.append((keys[at:at + len(sizes)], sizes, tokens + np.cumsum(sizes) - sizes, ids))
                at += len(sizes)
                documents += len(sizes)
                tokens += int(sizes.sum())
                if sum(len(h[3]) for h in held) >= GROUP_TOKENS:
                    flush()
        if writer is not None:
            if held:
                flush()
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({
                "path": [name], "part": pa.array([part], pa.int32()), "documents": [documents], "tokens": [tokens]})
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int | None = 0,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of every text to files in `folder`; gives the table of the files.

    `path, part, documents, tokens`: files follow each other in order of `part`, and
    documents in ascending order of the key, null first. Null texts are empty; rows with
    equal keys follow each other in order of their text. `end_id` ends each document.
    A file of a task that failed or ran twice is in no table and is never read. An empty
    table of documents gives no file. Other columns are not written.
    """
    path = tokenizer or default_path()
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    return materialise(ordered.mapInArrow(_write(folder, path, end_id), MANIFEST), "token-files")


def read_tokens(files: DataFrame, ids: bool = True) -> DataFrame:
    """`doc_id, start, n_tokens` and maybe `ids` of the documents in the files.

    start: ids of all documents before. A filter on `doc_id` reads only the pages that may
    hold it; without `ids` only the numbers are read.
    """
    spark = files.sparkSession
    paths = [r.path for r in files.select("path").collect()]  # names of files, not rows
    schema = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
    if not paths:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids array<int>").drop(
            *(() if ids else ("ids",)))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select(F.col("part").alias("_part"),
                          F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("_before"))
    if len(paths) <= BROADCAST_FILES:
        places = F.broadcast(places)
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.join(places, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("_before") + F.col("part_start")).alias("start"), "n_tokens", *(["ids"] if ids else []))


def _crc(batches):
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy().astype("<u4", copy=False)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    files = write_tokens(table(spark, sf_dir, "documents"), shared_folder(spark, "tokens"))
    return read_tokens(files).mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


QUERIES = {"op7_token_files": op7_token_files}
