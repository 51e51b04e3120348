"""Top-k search by cosine similarity.

One query is scored by expressions. Many queries are scored in blocks by matrix
products inside the tasks that scan the points; a task gives out at most k hits per
query, so neither all pairs nor a whole collection ever meet in one place.

Scores are rounded to SCORE_DIGITS before ranking, so that sums taken in another
order do not change the ranks; equal scores rank by point id.
"""

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagewell.operators.collections import DEFAULT_LIMIT
from pagewell.operators.embed import Embedder, embed_text

SCORE_DIGITS = 9

# Rounding and matrix products may move a score by this much; candidates within it
# of the k-th best are scored exactly.
SLACK = 1e-8

# Queries, and bytes of them, that are broadcast to all tasks.
BROADCAST_QUERIES = 16_384
BROADCAST_BYTES = 128 << 20

# Beyond that: queries and points that make a group of the block join worth its while.
QUERY_BLOCK = 8_192
POINT_SLICE = 200_000

# Groups of the block join for each core, and bytes of queries and their hits in one.
GROUPS_PER_CORE = 4
HELD_BYTES = 128 << 20

# Bytes that a hit takes in a task beside its query.
HIT_BYTES = 100

# Hits that are broadcast to fetch their payloads.
BROADCAST_HITS = 500_000

# Products held at once per task.
SCORES_HELD = 4 << 20

# Pairs scored at once when candidates are scored exactly.
PAIR_CHUNK = 50_000

# Hits given out at once.
BATCH_ROWS = 65_536


def cosine(vector: Column, query: Sequence[float]) -> Column:
    """Cosine similarity of a vector column to one vector; 0 for zero vectors."""
    length = math.sqrt(math.fsum(float(x) * float(x) for x in query))
    unit = [float(x) / length if length else 0.0 for x in query]
    wanted = F.lit(unit) if unit else F.array().cast("array<double>")
    double = vector.cast("array<double>")
    dot = F.aggregate(
        F.zip_with(double, wanted, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(double, F.lit(0.0), lambda s, x: s + x * x))
    score = F.coalesce(F.try_divide(dot, norm), F.lit(0.0))
    return F.round(F.when(F.size(vector) == len(unit), score).otherwise(
        F.raise_error(F.lit("Vector and query differ in length"))), SCORE_DIGITS)


def search_vector(
    points: DataFrame, query: Sequence[float], limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """The `limit` points most similar to one vector; all columns but the vector."""
    kept = [c for c in points.columns if c != "vector"]
    hits = points.select(*kept, cosine(F.col("vector"), query).alias("score")).orderBy(
        F.desc("score"), "point_id").limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "point_id"))
    return hits.withColumn("rank", rank)


@dataclass
class Queries:
    """A block of queries: ids, unit vectors, hits wanted, and the cells each looks at."""

    ids: pa.Array
    units: np.ndarray
    limits: np.ndarray
    looking: pd.DataFrame

    @classmethod
    def read(cls, table: pa.Table) -> "Queries":
        cells = _chunk(table["cells"])
        limits = table["limit"].to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
        looking = pd.DataFrame({
            "cell": cells.flatten().to_numpy(), "limit": limits[row], "row": row})
        return cls(_chunk(table["query_id"]), _unit_rows(_chunk(table["query_vector"])),
                   limits, looking)


def _chunk(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    """Rows of length 1 (zero rows stay zero) of a list array."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks)
    if len(vectors) == 0:
        return np.zeros((0, 0))
    if vectors.null_count:
        raise ValueError("Vectors must not be null")
    lengths = np.unique(np.diff(vectors.offsets.to_numpy()))
    if len(lengths) > 1:
        raise ValueError(f"Vectors differ in length: {lengths[:5].tolist()}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), int(lengths[0]))
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    norms[norms == 0] = 1.0
    return rows / norms


def rounding(width: int) -> float:
    """More than what two products of unit rows in single precision are off by."""
    return (width + 8) * 2.0 ** -22


class TopK:
    """Best points per query of what has been added."""

    def __init__(self, queries: Queries):
        self.queries = queries
        self.quick = queries.units.astype(np.float32)
        self.slack = SLACK + rounding(queries.units.shape[1])
        self.found: list[pd.DataFrame] = []
        self.waiting = 0
        self.floor = np.full(len(queries.limits), -np.inf)
        # Queries at one cell that want equally many hits are scored together.
        self.members: dict = {}
        for (cell, limit), group in queries.looking.groupby(["cell", "limit"])["row"]:
            if limit > 0:
                self.members.setdefault(cell, []).append((int(limit), group.to_numpy()))

    def add(self, ids: pa.Array, vectors: pa.Array, cells: np.ndarray) -> None:
        if len(ids) == 0 or not self.members:
            return
        units = _unit_rows(vectors)
        if units.shape[1] != self.queries.units.shape[1]:
            raise ValueError("Vectors and queries differ in length")
        for cell in np.unique(cells):
            rows = np.flatnonzero(cells == cell)
            quick = units[rows].astype(np.float32).T
            step = max(1, SCORES_HELD // len(rows))
            for limit, members in self.members.get(cell, ()):
                for start in range(0, len(members), step):
                    self._candidates(ids, units, quick, rows, members[start:start + step], limit)

    def _candidates(self, ids, units, quick, rows, columns, limit) -> None:
        approximate = self.quick[columns] @ quick
        fresh = np.flatnonzero(np.isneginf(self.floor[columns]))
        if len(fresh) and len(rows) >= limit:
            kth = len(rows) - limit
            best = np.partition(approximate[fresh], kth, axis=1)[:, kth]
            self.floor[columns[fresh]] = best - self.slack
        floor = (self.floor[columns] - self.slack).astype(np.float32)
        of, at = np.divmod(np.flatnonzero(approximate >= floor[:, None]), len(rows))
        for start in range(0, len(at), PAIR_CHUNK):
            row = rows[at[start:start + PAIR_CHUNK]]
            query = columns[of[start:start + PAIR_CHUNK]]
            # Summed row by row in a fixed order: equal vectors get equal scores.
            exact = (units[row] * self.queries.units[query]).sum(axis=1)
            self.found.append(_hits(query, np.round(exact, SCORE_DIGITS) + 0.0, ids.take(pa.array(row))))
            self.waiting += len(row)
            if self.waiting > max(PAIR_CHUNK, self.queries.limits.sum()):
                self._keep()

    def _keep(self) -> None:
        if not self.found:
            return
        hits = pa.Table.from_pandas(pd.concat(self.found, ignore_index=True), preserve_index=False)
        hits = hits.take(pc.sort_indices(
            hits, [("query", "ascending"), ("score", "descending"), ("point_id", "ascending")]))
        query, score = hits["query"].to_numpy(), hits["score"].to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        wanted = self.queries.limits[query]
        last, stays = place == wanted - 1, place < wanted
        self.floor[query[last]] = score[last]
        ids = hits["point_id"].filter(pa.array(stays)).combine_chunks()
        self.found = [_hits(query[stays], score[stays], ids)]
        self.waiting = 0

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        self._keep()
        for best in self.found:
            rows = pa.array(best["query"].to_numpy(), pa.int64())
            yield from _cast([
                self.queries.ids.take(rows), pa.array(self.queries.limits).take(rows),
                pa.array(best["point_id"]), pa.array(best["score"].to_numpy(), pa.float64())], schema)


def _hits(query: np.ndarray, score: np.ndarray, ids: pa.Array) -> pd.DataFrame:
    return pd.DataFrame({
        "query": query, "score": score, "point_id": pd.arrays.ArrowExtensionArray(ids)})


def _cast(columns: Sequence[pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Columns as batches of a schema."""
    table = pa.Table.from_arrays([_chunk(c.cast(f.type)) for c, f in zip(columns, schema)], schema=schema)
    yield from table.to_batches(BATCH_ROWS)


def _add_batch(top: TopK, batch) -> None:
    top.add(
        batch.column("point_id"), batch.column("vector"),
        batch.column("cell").to_numpy(zero_copy_only=False))


def _rank(hits: DataFrame, k: int | None) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "point_id")
    wanted = F.col("limit") if k is None else F.lit(k)
    return hits.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= wanted).select("query_id", "rank", "point_id", "score")


def _cells(match: Sequence[str]) -> Column:
    """A number that is equal where all `match` columns are equal."""
    return F.xxhash64(*match) if match else F.lit(0).cast("long")


@dataclass
class Found:
    """Hits, and for queries that were broadcast: how many at most, and the queries."""

    hits: DataFrame
    most: int | None = None
    asked: pa.Table | None = None


def find_top_k(
    points: DataFrame, queries: DataFrame, k: int | None = DEFAULT_LIMIT,
    match: Sequence[str] = (), cells: Column | None = None,
    broadcast_queries: int = BROADCAST_QUERIES, broadcast_bytes: int = BROADCAST_BYTES,
    query_block: int = QUERY_BLOCK, point_slice: int = POINT_SLICE,
) -> Found:
    """See `top_k_pairs`; `cells` are the cells a query looks at, for points with `cell`."""
    hits_type = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("limit", T.LongType()),
        T.StructField("point_id", points.schema["point_id"].dataType),
        T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(hits_type)
    limit = (F.col("limit") if k is None else F.lit(k)).cast("long").alias("limit")
    looking = F.array(_cells(match)) if cells is None else cells
    wanted = queries.select(
        "query_id", "query_vector", looking.alias("cells"), limit, *match)
    scanned = points.select(
        "point_id", "vector",
        (_cells(match) if cells is None else F.col("cell").cast("long")).alias("cell"))

    local = wanted.limit(broadcast_queries + 1).toArrow()
    if local.num_rows <= broadcast_queries and local.nbytes <= broadcast_bytes:
        shared = points.sparkSession.sparkContext.broadcast(_ipc(local.drop_columns([*match])))

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top = TopK(Queries.read(_from_ipc(shared.value)))
            for batch in batches:
                _add_batch(top, batch)
            yield from top.batches(schema)

        most = int(np.maximum(local["limit"].to_numpy(zero_copy_only=False), 0).sum())
        return Found(_rank(scanned.mapInArrow(scan, hits_type), k), most, local)

    # Vectors in both precisions, the cells looked at, and hits.
    held = (12 * F.size("query_vector") + 24 * F.size("cells")
            + HIT_BYTES * F.greatest("limit", F.lit(0)))
    found = block_join(
        wanted.drop(*match), scanned, held, hits_type,
        lambda asking: TopK(Queries.read(asking)), _add_batch, query_block, point_slice)
    return Found(_rank(found, k))


def block_join(
    queries: DataFrame, points: DataFrame, held: Column, kind: T.StructType,
    start: Callable, add: Callable, query_block: int, point_slice: int,
) -> DataFrame:
    """Rows of `kind` that come of every query meeting every point once.

    A group holds a block of the queries, from which `start` makes what finds the hits, and
    a slice of the points, given to `add` batch by batch. There are a few groups for each
    core, whatever the number of rows, so both sides are copied equally often at all
    sizes; only queries of more than HELD_BYTES (`held`: bytes of one, with its hits) a block
    make more blocks. Fewer than `query_block` queries or `point_slice` points are not split.
    """
    groups = GROUPS_PER_CORE * points.sparkSession.sparkContext.defaultParallelism
    asked, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(held.cast("long")), F.lit(0))).first()
    blocks = max(1, min(math.ceil(asked / query_block), max(math.isqrt(groups), math.ceil(size / HELD_BYTES))))
    slices = max(1, min(math.ceil(points.count() / point_slice), math.ceil(groups / blocks)))

    def dealt(rows: DataFrame, key: str, own: int, each: int, other: int, other_each: int) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(own)) * each
        copies = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("_copy")
        return rows.select(F.struct("*").alias(key), part.alias("_part"), copies).select(
            key, (F.col("_part") + F.col("_copy") * other_each).cast("int").alias("_group"))

    left = dealt(queries, "query_id", blocks, slices, slices, 1)
    right = dealt(points, "point_id", slices, 1, blocks, slices)
    met = left.unionByName(right, allowMissingColumns=True).repartitionById(
        blocks * slices, "_group").sortWithinPartitions(F.col("point_id").isNotNull())
    schema = to_arrow_schema(kind)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking, top = [], None
        for batch in batches:
            asked, offered = (
                pa.RecordBatch.from_struct_array(batch.column(c).drop_null()) for c in ("query_id", "point_id"))
            if asked.num_rows:
                asking.append(asked)
            if offered.num_rows and asking:
                if top is None:
                    top = start(pa.Table.from_batches(asking))
                add(top, offered)
        if top is not None:
            yield from top.batches(schema)

    return met.mapInArrow(meet, kind)


def top_k_pairs(
    points: DataFrame, queries: DataFrame, k: int | None = DEFAULT_LIMIT,
    match: Sequence[str] = (), **options,
) -> DataFrame:
    """`query_id, rank, point_id, score` of the k best points of every query, exactly.

    `points` has `point_id, vector`, `queries` has distinct `query_id` and
    `query_vector`, and a `limit` of its own for each query when `k` is None. A query
    only sees points with equal `match` columns. Up to `broadcast_queries` queries go
    to every task of one scan of the points. More queries than that are joined block
    by block, see `block_join`.
    """
    return find_top_k(points, queries, k, match, **options).hits


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all()


def with_payload(
    hits: DataFrame, points: DataFrame, most: int | None = None, match: Sequence[str] = (),
) -> DataFrame:
    """Adds the payload of the hit points, found by id and the `match` columns.

    `most` is a proven upper bound on the number of hits. Hits known to be few are
    broadcast to the scan of the payloads; others are joined by id, where a point hit
    by very many queries is split up by the adaptive skew join.
    """
    few = most is not None and most <= BROADCAST_HITS
    return points.select("point_id", *match, "payload").join(
        F.broadcast(hits) if few else hits, ["point_id", *match]
    ).select("query_id", "rank", "point_id", "score", "payload")


def embed_queries(queries: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Adds `query_vector`, by the same embedder as the documents."""
    return embed_text(queries, "query", embedder, "query_vector")


def search_batch(
    points: DataFrame, queries: DataFrame, k: int | None = DEFAULT_LIMIT,
    embedder: Embedder | None = None, match: Sequence[str] = (), payload: bool = True,
) -> DataFrame:
    """k hits for every query text of `query_id, query`, or as many as its `limit` says."""
    found = find_top_k(points, embed_queries(queries, embedder), k, match)
    hits = found.hits
    if not payload:
        return hits
    kept = [m for m in match if m != "point_id"]
    if kept:
        columns = ["query_id", *kept]
        asked = queries.select(columns) if found.asked is None else (
            queries.sparkSession.createDataFrame(found.asked.select(columns)))
        hits = hits.join(asked, "query_id")
    return with_payload(hits, points, found.most, kept)


def search_text(
    points: DataFrame, query: str, limit: int = DEFAULT_LIMIT, embedder: Embedder | None = None,
) -> DataFrame:
    """The `limit` points most similar to one text."""
    probe = points.sparkSession.range(1).select(F.lit(query).alias("query"))
    vector = embed_queries(probe, embedder).first()["query_vector"]
    return search_vector(points, vector, limit)
