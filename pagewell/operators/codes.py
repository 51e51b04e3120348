"""Search on compressed vectors with a proven error.

Beside each vector stands its code: the unit vector in steps of a 127th of its largest
component, one byte each, the step, and the length of what the rounding left out. A
product with a unit query differs from that of the code by no more than this length, so
bounds on all scores follow from codes alone. They are scanned; only points whose upper
bound reaches the k-th best lower bound of a query have their vectors fetched and scored.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagewell.operators.collections import DEFAULT_LIMIT
from pagewell.operators.search import (
    BROADCAST_BYTES, BROADCAST_QUERIES, HIT_BYTES, POINT_SLICE, QUERY_BLOCK, SCORE_DIGITS, SCORES_HELD, SLACK, _cast,
    _from_ipc, _ipc, _unit_rows, block_join, rounding)

STEPS = 127

# Candidates that a task is expected to keep for each hit wanted.
CANDIDATES = 4
CODE_TYPE = T.StructType([
    T.StructField("code", T.BinaryType()), T.StructField("step", T.DoubleType()), T.StructField("error", T.DoubleType())])


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, steps and errors of unit rows."""
    step = np.abs(units).max(axis=1, initial=0.0) / STEPS
    step[step == 0] = 1.0
    codes = np.rint(units / step[:, None]).astype(np.int8)
    return codes, step, np.sqrt(((units - codes * step[:, None]) ** 2).sum(axis=1))


def add_codes(points: DataFrame, vector: str = "vector") -> DataFrame:
    """Points with `code, step, error`. Vectors must have one length and no null; zero vectors
    have a code of zeros."""
    @F.arrow_udf(CODE_TYPE)
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            codes, step, error = encode(_unit_rows(batch))
            data = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.StructArray.from_arrays([data, pa.array(step), pa.array(error)], names=CODE_TYPE.names)

    told = points.withColumn("_coded", coded.asNondeterministic()(F.col(vector)))
    return told.select(*points.columns, *(F.col("_coded")[c].alias(c) for c in CODE_TYPE.names))


def _width(codes: pa.Array) -> int:
    widths = set(pa.compute.binary_length(codes).unique().to_pylist())
    if None in widths or len(widths) > 1:
        raise ValueError(f"Codes differ in length or are null: {sorted(map(str, widths))[:5]}")
    return widths.pop()


class _Bounds:
    """Candidates per query of the codes that have been added."""

    def __init__(self, queries: pa.Table, k: int):
        self.ids = queries["query_id"].combine_chunks()
        units = _unit_rows(queries["query_vector"].combine_chunks())
        self.width = units.shape[1]
        # A last column of ones adds the errors, so that products are upper bounds.
        self.units = np.concatenate([units, np.ones((len(units), 1))], axis=1).astype(np.float32)
        self.k = k
        self.floor = np.full(len(self.ids), -np.inf)  # the k-th highest lower bound
        self.found: list[tuple] = []
        self.waiting = self.kept = 0

    def add(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows or not len(self.ids):
            return
        codes = batch.column("code")
        width = _width(codes)
        if width != self.width:
            raise ValueError("Vectors and queries differ in length")
        error = batch.column("error").to_numpy() + SLACK + rounding(width)
        rows = np.empty((len(codes), width + 1), np.float32)
        rows[:, :width] = np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(-1, width)
        rows[:, :width] *= batch.column("step").to_numpy()[:, None].astype(np.float32)
        rows[:, width] = error
        point_id = batch.column("point_id")
        step = max(1, SCORES_HELD // len(rows))
        for start in range(0, len(self.ids), step):
            upper = self.units[start:start + step] @ rows.T
            floor = self.floor[start:start + step]
            fresh = np.flatnonzero(np.isneginf(floor))
            if len(fresh) and len(rows) >= self.k:
                kth = len(rows) - self.k
                floor[fresh] = np.partition(upper[fresh] - 2 * error, kth, axis=1)[:, kth]
            query, point = np.divmod(
                np.flatnonzero(upper >= floor[:, None].astype(np.float32)), len(rows))
            high = upper[query, point].astype(np.float64)
            self.found.append((query + start, point_id.take(pa.array(point)), high - 2 * error[point], high))
            self.waiting += len(query)
            if self.waiting > 2 * self.kept + SCORES_HELD // 4:
                self._keep()

    def _keep(self) -> None:
        """Raises the floors to what has been found, and drops what is below them."""
        if not self.found:
            return
        query, lower, upper = (np.concatenate([f[n] for f in self.found]) for n in (0, 2, 3))
        point = pa.chunked_array([f[1] for f in self.found])
        order = np.lexsort((-lower, query))
        of = query[order]
        last = order[np.arange(len(of)) - np.searchsorted(of, of) == self.k - 1]
        self.floor[query[last]] = np.maximum(self.floor[query[last]], lower[last])
        stays = np.flatnonzero(upper >= self.floor[query].astype(np.float32))
        self.found = [(query[stays], point.take(pa.array(stays)).combine_chunks(), lower[stays], upper[stays])]
        self.waiting = self.kept = len(stays)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        self._keep()
        for query, point, lower, upper in self.found:
            yield from _cast([self.ids.take(pa.array(query)), point, pa.array(lower), pa.array(upper)], schema)


def candidates(
    codes: DataFrame, queries: DataFrame, k: int = DEFAULT_LIMIT,
    broadcast_queries: int = BROADCAST_QUERIES, broadcast_bytes: int = BROADCAST_BYTES,
    query_block: int = QUERY_BLOCK, point_slice: int = POINT_SLICE,
) -> DataFrame:
    """`query_id, point_id, lower, upper` of all pairs that may be among the k best.

    `codes` has `point_id, code, step, error`, `queries` distinct `query_id` and
    `query_vector`. Up to `broadcast_queries` queries, and so many bytes of them, go to
    every task of one scan; more are joined block by block, as in `search.top_k_pairs`.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    kind = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("point_id", codes.schema["point_id"].dataType),
        T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())])
    schema = to_arrow_schema(kind)
    asked = queries.select("query_id", "query_vector")
    scanned = codes.select("point_id", "code", "step", "error")
    local = asked.limit(broadcast_queries + 1).toArrow()
    if local.num_rows <= broadcast_queries and local.nbytes <= broadcast_bytes:
        shared = codes.sparkSession.sparkContext.broadcast(_ipc(local))

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds = _Bounds(_from_ipc(shared.value), k)
            for batch in batches:
                bounds.add(batch)
            yield from bounds.batches(schema)

        found = scanned.mapInArrow(scan, kind)
    else:
        held = 4 * F.size("query_vector") + CANDIDATES * HIT_BYTES * k
        found = block_join(
            asked, scanned, held, kind, lambda asking: _Bounds(asking, k), _Bounds.add, query_block, point_slice)
    # The k-th best lower bound over all tasks rules out most of what single tasks had to keep.
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    floor = F.coalesce(F.nth_value("lower", k).over(by_lower), F.lit(float("-inf")))
    return found.withColumn("_floor", floor).where(F.col("upper") >= F.col("_floor")).drop("_floor")


def score_candidates(points: DataFrame, queries: DataFrame, pairs: DataFrame, k: int = DEFAULT_LIMIT) -> DataFrame:
    """`query_id, rank, point_id, score` of the k best candidates by their own vectors."""
    def unit(vector):
        double = vector.cast("array<double>")
        norm = F.sqrt(F.aggregate(double, F.lit(0.0), lambda s, x: s + x * x))
        return F.when(norm > 0, F.transform(double, lambda x: x / norm)).otherwise(double)

    wanted = pairs.select("query_id", "point_id")
    vectors = points.select("point_id", unit(F.col("vector")).alias("_point"))
    asked = queries.select("query_id", unit(F.col("query_vector")).alias("_query"))
    scored = wanted.join(vectors, "point_id").join(asked, "query_id").select(
        "query_id", "point_id", F.round(F.aggregate(
            F.zip_with("_point", "_query", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x), SCORE_DIGITS).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "point_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "point_id", "score")


def search_codes(
    codes: DataFrame, points: DataFrame, queries: DataFrame, k: int = DEFAULT_LIMIT, **options,
) -> DataFrame:
    """The k best points of every query, exactly, as `search.top_k_pairs` finds them.

    `codes` may be stored apart from `points` (`point_id, vector`), whose vectors are
    joined to the candidates only.
    """
    return score_candidates(points, queries, candidates(codes, queries, k, **options), k)


def cost(codes: DataFrame, queries: DataFrame, k: int = DEFAULT_LIMIT) -> DataFrame:
    """`pairs, scored, share`: all pairs, those whose vectors are scored, and their share."""
    pairs = codes.agg(F.count(F.lit(1)).alias("_p")).crossJoin(  # two rows of one number each
        queries.agg(F.count(F.lit(1)).alias("_q"))).select((F.col("_p") * F.col("_q")).alias("pairs"))
    scored = candidates(codes, queries, k).agg(F.count(F.lit(1)).alias("scored"))
    return pairs.crossJoin(scored).withColumn("share", F.try_divide("scored", "pairs"))
