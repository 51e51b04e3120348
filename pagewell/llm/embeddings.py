"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors are scaled to length 1; a cosine of at least c is a squared distance of at most
2 - 2c. After one rotation, which spreads the distance evenly, the coordinates are cut
into `BLOCKS` blocks; a pair within the whole budget is within the proportional budget in
one block at least. Each block is joined by range: a grid over its first two coordinates
with cells as wide as the block's radius, where a vector meets its own cell and, once, each
neighbouring one. Candidates are verified by their cosine in double precision, and a pair
counts only in the first block that finds it, so no pair leaves a task: what leaves are
link counts and links thinned to trees.

Equal vectors are one row from the start. A cell of many vectors is split into chunks and
pairs of chunks go to tasks of their own.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.components import components
from pagewell.llm.shared import materialise, table

COSINE, BLOCKS, CHUNK, TILE = 0.95, 4, 8192, 1024
#: Neighbouring cells that a vector visits; the others come to it.
VISITED = ((1, -1), (1, 0), (1, 1), (0, 1))


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _edges(dim: int) -> list[int]:
    blocks = min(BLOCKS, dim)
    return [dim * k // blocks for k in range(blocks + 1)]


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _budgets(dim: int, cosine: float) -> np.ndarray:
    """The squared distance that each block may have, in proportion to its coordinates."""
    return (2 - 2 * cosine) * np.diff(_edges(dim)) / dim


def _cells(vectors: np.ndarray, cosine: float) -> np.ndarray:
    """Grid cells (rows x blocks x 2)."""
    dim = vectors.shape[1]
    turned, edges = _units(vectors) @ rotation(dim), _edges(dim)
    width = np.sqrt(_budgets(dim, cosine)) * (1 + 1e-9) + 1e-9
    second = [min(e + 1, f - 1) for e, f in zip(edges, edges[1:])]
    return np.stack([np.floor(turned[:, edges[:-1]] / width), np.floor(turned[:, second] / width)],
                    axis=2).astype(np.int64)


def _read(column) -> list[np.ndarray]:
    return [np.frombuffer(v, "<f8") for v in column]


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """`key, digest, dim, vec` of every row; dim is 0 for vectors that can link with nothing."""
    def run(batches):
        for batch in batches:
            digests, dims, vectors = [], [], []
            for v in batch.column(1).to_pylist():
                x = np.array([np.nan if e is None else e for e in v], "<f8") if v else np.zeros(0)
                ok = len(x) > 0 and bool(np.isfinite(x).all()) and bool((x != 0).any())
                dims.append(len(x) if ok else 0)
                data = (x + 0.0).astype("<f8").tobytes() if ok else b""
                vectors.append(data)
                digests.append(hashlib.md5(data).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(dims, pa.int32()),
                 pa.array(vectors, pa.binary())], names=["key", "digest", "dim", "vec"])

    return rows.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(
        run, "key long, digest binary, dim int, vec binary")


def _place(cosine: float):
    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for dim, part in frame.groupby("dim"):
                at = _cells(np.stack(_read(part["vec"])), cosine)
                rows = [(dim, b, x, y) for one in at.tolist() for b, (x, y) in enumerate(one)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                    zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["dim", "block", "x", "y"])
    return run


def _deal(counts: dict, cosine: float):
    """Rows `dim, block, x, y, i, j, side, ...` for every pair of chunks that a vector is part of."""
    chunks = {cell: -(-n // CHUNK) for cell, n in counts.items()}

    def run(frames):
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                at = _cells(np.stack(_read(part["vec"])), cosine)
                keys = []
                for r, (node, one) in enumerate(zip(part["node"].tolist(), at.tolist())):
                    spread = hash(node)
                    for b, (x, y) in enumerate(one):
                        own = chunks[dim, b, x, y]
                        c = spread % own
                        # Chunks of a cell are numbered; those of its visitors follow.
                        keys += [(r, b, x, y, min(c, j), max(c, j), int(c > j)) for j in range(own)]
                        first = own
                        for dx, dy in VISITED:
                            coming = chunks.get((dim, b, x - dx, y - dy), 0)
                            keys += [(r, b, x, y, c, first + j, 0) for j in range(coming)]
                            first += coming
                        for k, (dx, dy) in enumerate(VISITED):
                            there = chunks.get((dim, b, x + dx, y + dy), 0)
                            before = there + sum(chunks.get((dim, b, x + dx - ex, y + dy - ey), 0)
                                                 for ex, ey in VISITED[:k])
                            keys += [(r, b, x + dx, y + dy, i, before + c, 1) for i in range(there)]
                for start in range(0, len(keys), 20_000):
                    row, *columns = (np.array(c) for c in zip(*keys[start:start + 20_000]))
                    out = pd.DataFrame(dict(zip(("block", "x", "y", "i", "j", "side"), columns)))
                    out.insert(0, "dim", dim)
                    for name in ("node", "copies", "vec"):
                        out[name] = part[name].to_numpy()[row]
                    yield out
    return run


def _compare(cosine: float):
    def run(key, frame):
        dim, block = int(key[0]), int(key[1])
        edges, budgets = _edges(dim), _budgets(dim, cosine)
        unit = _units(np.stack(_read(frame["vec"])))
        turned = unit @ rotation(dim)
        home = np.flatnonzero(frame["side"].to_numpy() == 0)
        guest = np.flatnonzero(frame["side"].to_numpy() == 1)
        same = not len(guest)
        if same and key[4] != key[5]:
            return pd.DataFrame({"node": [], "n": [], "root": []})
        guest = home if same else guest
        near = turned[:, edges[block]:edges[block + 1]].astype(np.float32)
        square = (near * near).sum(axis=1)
        copies = frame["copies"].to_numpy()
        links = np.zeros(len(frame), np.int64)
        tree = np.arange(len(frame))
        for start in range(0, len(home), TILE):
            tile = home[start:start + TILE]
            apart = square[tile, None] + square[guest] - 2 * near[tile] @ near[guest].T
            a, b = np.nonzero(apart <= budgets[block] * 1.001 + 1e-5)
            a, b = tile[a], guest[b]
            if same:
                a, b = a[a < b], b[a < b]
            for at in range(0, len(a), 100_000):
                p, q = a[at:at + 100_000], b[at:at + 100_000]
                keep = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
                p, q = p[keep], q[keep]
                gap = (turned[p] - turned[q]) ** 2
                within = np.add.reduceat(gap, edges[:-1], axis=1) <= budgets + 1e-9
                first = within.argmax(axis=1) == block
                p, q = p[first], q[first]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                while len(p):  # the smaller root of each link takes over the other's tree
                    s, t = tree[p], tree[q]
                    open_ = s != t
                    if not open_.any():
                        break
                    p, q, s, t = p[open_], q[open_], s[open_], t[open_]
                    np.minimum.at(tree, np.maximum(s, t), np.minimum(s, t))
                    while (tree != tree[tree]).any():
                        tree = tree[tree]
        node = frame["node"].to_numpy()
        touched = np.flatnonzero(links)
        return pd.DataFrame({"node": node[touched], "n": links[touched], "root": node[tree[touched]]})
    return run


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """`key, n_links, component, kept` of every row.

    n_links: the other rows whose vector has a cosine of at least `cosine`; component: the
    smallest key reachable over links. Vectors that are null, empty, zero or hold null or
    non-finite values link with nothing, nor do those of different lengths or with a null
    key. Rows with equal keys should have equal vectors; such rows are linked as equal
    vectors. An empty table gives an empty one. Other columns are not carried.
    """
    read = materialise(distinct_vectors(rows, key, vector), "vectors")
    able = read.where((F.col("dim") > 0) & F.col("key").isNotNull())
    classes = materialise(able.groupBy("digest").agg(
        F.min("key").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"),
        F.first("vec").alias("vec")), "vectors")
    # A row per cell: at most (2 / width)^2 per block, whatever the number of vectors.
    counts = {tuple(r[:4]): r[4] for r in classes.select("dim", "vec").mapInArrow(
        _place(cosine), "dim int, block int, x long, y long").groupBy("dim", "block", "x", "y").count().collect()}
    cells = "dim int, block long, x long, y long, i long, j long, side long, node long, copies long, vec binary"
    dealt = classes.select("dim", "node", "copies", "vec").mapInPandas(_deal(counts, cosine), cells)
    met = materialise(dealt.groupBy("dim", "block", "x", "y", "i", "j").applyInPandas(
        _compare(cosine), "node long, n long, root long"), "links")
    found = components(met.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "_node")
    links = met.groupBy(F.col("node").alias("_linked")).agg(F.sum("n").alias("n"))
    named = (classes.select("digest", "node", "copies").join(links, F.col("node") == F.col("_linked"), "left")
             .join(found, F.col("node") == F.col("_node"), "left")
             .select(F.col("digest").alias("_digest"),
                     (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_links"),
                     F.coalesce("component", "node").alias("_component")))
    able = (F.col("dim") > 0) & F.col("key").isNotNull()
    out = read.select("key", F.when(able, F.col("digest")).alias("digest")).join(
        named, F.col("digest") == F.col("_digest"), "left").select(
        "key", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_component", "key").alias("component"))
    return out.select("*", F.coalesce(F.col("key") == F.col("component"), F.lit(True)).alias("kept"))


def op4_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).select(
        F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


QUERIES = {"op4_embeddings": op4_embeddings}
