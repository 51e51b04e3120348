"""Embedding of text columns and checks of vectors."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.functions.hashing import hashed_embedder

Embedder = Callable[[Column], Column]

PROBE = "test"


def embed_text(
    rows: DataFrame, text: str, embedder: Embedder | None = None, vector: str = "vector",
) -> DataFrame:
    """Adds the vector of the whole text of every row."""
    embed = embedder or hashed_embedder()
    return rows.withColumn(vector, embed(F.coalesce(F.col(text), F.lit(""))))


def vector_size(spark: SparkSession, embedder: Embedder | None = None) -> DataFrame:
    """One row with the length of the embedder's vectors, found by embedding a word."""
    probe = spark.range(1).select(F.lit(PROBE).alias("text"))
    return embed_text(probe, "text", embedder).select(F.size("vector").alias("vector_size"))


def check_vectors(rows: DataFrame, size: int, vector: str = "vector") -> DataFrame:
    """Adds `reason`: `bad_vector` for a wrong length, a null or a value not finite."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    good = F.coalesce((F.size(value) == size) & finite, F.lit(False))
    return rows.withColumn("reason", F.when(~good, F.lit("bad_vector")))
