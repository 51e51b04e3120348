"""Approximate search: points are kept in cells, a query looks at a few of them.

A cell is the sign pattern of a vector against fixed planes. A query looks at its
own cell and at those that differ in up to `radius` signs; hits found there have
exact scores. Stored with `partitionBy("cell")`, only those cells are read.
"""

from collections.abc import Iterator
from hashlib import md5
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewell.operators.collections import DEFAULT_LIMIT
from pagewell.operators.search import find_top_k

PLANES = 6
RADIUS = 2

# With up to so many planes, the cells looked at (2 ** 12 at most) become a filter.
PRUNED_PLANES = 12


def planes(count: int, dimension: int) -> np.ndarray:
    """Plane p at position i: +1 when md5('p:i') starts with a digit below 8, else -1."""
    return np.array([
        [1.0 if md5(f"{p}:{i}".encode()).hexdigest()[0] < "8" else -1.0
         for i in range(dimension)] for p in range(count)])


def cell_of(vector: Column, dimension: int, count: int = PLANES) -> Column:
    """Bit p of the cell is set where the vector is on the positive side of plane p."""
    normals = planes(count, dimension)
    weights = 1 << np.arange(count, dtype=np.int64)

    @F.arrow_udf(T.LongType())
    def cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lengths = np.unique(np.diff(batch.offsets.to_numpy()))
            if batch.null_count or (lengths != dimension).any():
                raise ValueError(f"Vectors must have {dimension} values: null or {lengths[:5].tolist()}")
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            sides = rows.astype(np.float64) @ normals.T > 0
            yield pa.array(sides @ weights, pa.int64())

    return cells.asNondeterministic()(vector)


def probed_cells(cell: Column, count: int = PLANES, radius: int = RADIUS) -> Column:
    """The cells that differ from the given one in at most `radius` bits."""
    masks = [
        sum(1 << bit for bit in bits)
        for size in range(radius + 1) for bits in combinations(range(count), size)]
    return F.transform(
        F.array(*(F.lit(m).cast("long") for m in masks)), lambda m: cell.bitwiseXOR(m))


def add_cells(points: DataFrame, dimension: int, count: int = PLANES) -> DataFrame:
    """Points with their `cell`."""
    return points.withColumn("cell", cell_of(F.col("vector"), dimension, count))


def search_nearby(
    points: DataFrame, queries: DataFrame, dimension: int, k: int = DEFAULT_LIMIT,
    count: int = PLANES, radius: int = RADIUS,
) -> DataFrame:
    """k hits of every query among the points of the cells it looks at.

    `points` may bring their `cell`; `queries` has `query_id, query_vector`.
    """
    placed = points if "cell" in points.columns else add_cells(points, dimension, count)
    own = queries.select(
        "query_id", "query_vector", cell_of(F.col("query_vector"), dimension, count).alias("_own"))
    looking = own.select(
        "query_id", "query_vector", probed_cells(F.col("_own"), count, radius).alias("_cells"))
    if "cell" in points.columns and count <= PRUNED_PLANES:
        # Where points are stored by cell, the other cells are not read.
        wanted = looking.select(F.explode("_cells").alias("cell")).distinct().collect()
        placed = placed.where(F.col("cell").isin(*(row["cell"] for row in wanted)))
    return find_top_k(placed, looking, k, cells=F.col("_cells")).hits


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that were found, over all queries."""
    marks = exact.select("query_id", "point_id").join(
        found.select("query_id", "point_id", F.lit(1).alias("_found")),
        ["query_id", "point_id"], "left")
    return marks.agg(
        F.count(F.lit(1)).alias("exact_hits"),
        F.coalesce(F.sum("_found"), F.lit(0)).alias("found_hits"),
        F.coalesce(F.try_divide(F.sum("_found"), F.count(F.lit(1))), F.lit(0.0)).alias("recall"))
