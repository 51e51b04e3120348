"""Token counts through a cache keyed by digests of content and tokenizer.

Texts are joined to stored counts by the SHA-256 of their content and the tokenizer's
version digest; only distinct texts without a count are encoded, and their counts are
appended. A count is the same wherever it comes from.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import materialise, shared_folder, table
from pagewell.llm.tokens import default_path, encoder, version

CACHE = "digest binary, n_tokens long, tokenizer string"
LIMIT = 1024


def _encode(path: str):
    def run(batches):
        for batch in batches:
            sizes = [n for _, part in encoder(path).encode(batch.column(1)) for n in part.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())],
                                             names=["digest", "n_tokens"])
    return run


def cached(spark, cache: str, tokenizer: str) -> DataFrame:
    """`digest, n_tokens` of one tokenizer version; a cache that is not there yet is made.

    Digests that two jobs appended at the same time are given once.
    """
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, tokenizer: str | None = None, key: str = "doc_id",
                 text: str = "text", limit: int = LIMIT) -> DataFrame:
    """`key, n_bytes, n_tokens, over_limit` of every row, whatever its key.

    cache: a folder that all executors see; counts that it lacks are added to it. A null
    text is the empty one. Repeated texts are encoded once, repeated rows and null keys
    are kept. Other columns are not carried.
    """
    spark = docs.sparkSession
    path = tokenizer or default_path()
    name = version(path)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), content.alias("content"),
                       F.unhex(F.sha2(content, 256)).alias("digest"))
    misses = (rows.select("digest", "content").join(cached(spark, cache, name), "digest", "left_anti")
              .groupBy("digest").agg(F.first("content").alias("content")))
    (misses.mapInArrow(_encode(path), "digest binary, n_tokens long")
     .withColumn("tokenizer", F.lit(name))
     .write.mode("append").partitionBy("tokenizer").parquet(cache))
    # A table of its own, as Spark splits a hot digest only where the join reads a plain shuffle.
    known = materialise(cached(spark, cache, name).withColumnRenamed("digest", "_digest"), "counts")
    sized = rows.select("key", "digest", F.octet_length("content").cast("long").alias("n_bytes"))
    return sized.join(known, F.col("digest") == F.col("_digest")).select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), shared_folder(spark, "token-counts"))


QUERIES = {"op10_token_counts": op10_token_counts}
