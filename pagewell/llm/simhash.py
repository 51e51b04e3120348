"""Near-duplicates by SimHash, compared bit-sliced.

Two ways to ask: by a radius (fingerprints of 64 bits that differ in at most so many
bits, exact) and by a similarity (texts that share so large a part of their shingles).

Which fingerprints meet is decided by keys. For a radius r the bits are cut into more
than r blocks; two fingerprints within r agree in all blocks but r, so each choice of the
others is a key, and nothing is missed. The number of blocks follows the number of
fingerprints, so that a bucket is expected to hold few. For a similarity of 0.8 too many
bits differ for that; there the least of several independent hashes of the shingles are
the keys (a pair at 0.8 misses all eight with 0.2^8), the fingerprints have 256 bits, and
links are verified on the shingles themselves.

A bucket beyond `CHUNK` rows is split into chunks, and pairs of chunks go to tasks of
their own; within a task distances are counted from bit planes, and links are thinned to
trees before they leave it. Equal fingerprints or texts are one row from the start.

By similarity, what is thinned are candidates. Trees join what the candidates join, so
where all links of a tree are verified nothing is lost. Where one is rejected, the texts
that the candidates join go through their buckets again with their shingles, and every
candidate between different groups is verified before anything is thinned.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.bitslice import group_links
from pagewell.llm.components import components
from pagewell.llm.shared import give_back, materialise, table

CHUNK = 2048
#: Shingles of a chunk, unless a text has more, where shingles are compared.
CHUNK_SHINGLES = 1_000_000
#: Rows that a bucket is expected to hold at most when blocks are chosen.
BUCKET_ROWS = 256
#: Keys per text, words of 64 bits per fingerprint, and the bits out of all of them that
#: may differ for a sure and for a possible candidate, in the search by similarity.
#: A pair at 0.8 is expected to differ in 38 bits, or 48 if it has few shingles; it exceeds
#: 80 with 1 in 10^6 or less, and texts that share nothing differ in 128.
KEYS, WORDS, SURE, POSSIBLE = 8, 4, 38, 80
#: So many ids (8 bytes each) are broadcast to fetch texts; more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of so many words, repeats included.

    A-Z are lower-cased; fewer words are one shingle; no word gives no hash.
    """
    w = text.encode().lower().split() if text else []
    if len(w) < words:
        runs = [b" ".join(w)] if w else []
    else:
        runs = map(b" ".join, zip(*(w[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, 42) for s in runs), np.uint64)


def mixed(h: np.ndarray, stream: int) -> np.ndarray:
    """The stream-th independent hash made of a hash; stream 0 is itself."""
    if not stream:
        return h
    h = h ^ np.uint64(stream * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(h: np.ndarray, words: int = 1) -> np.ndarray:
    """A bit is 1 if set in over half of the hashes; `words` words of 64 bits."""
    out = np.zeros(words, "<u8")
    for k in range(words if len(h) else 0):
        ones = np.zeros(64, np.int64)
        for start in range(0, len(h), 1 << 16):
            part = mixed(h[start:start + (1 << 16)], k).astype("<u8", copy=False)
            ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """`key, fp`: the 64-bit fingerprint of every text as a signed long."""
    def run(batches):
        for batch in batches:
            fp = [fingerprint(shingle_hashes(t.as_py(), words))[0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], names=["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, fp long")


def _signatures(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """`key, digest, keys, fp`: what decides about a text in the search by similarity.

    Keys and fingerprint are of the distinct shingles, as is the similarity.
    """
    def run(batches):
        for batch in batches:
            digests, keys, fps = [], [], []
            for t in (x.as_py() for x in batch.column(1)):
                h = np.unique(shingle_hashes(t, words))
                digests.append(hashlib.md5(b" ".join(t.encode().lower().split()) if t else b"").digest())
                keys.append([int(np.min(mixed(h, 101 + k)).view(np.int64)) if len(h) else 0 for k in range(KEYS)])
                fps.append(fingerprint(h, WORDS).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(fps, pa.binary())], names=["key", "digest", "keys", "fp"])
        batch = None
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, digest binary, keys array<long>, fp binary")


def _pairs_of_chunks(met: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with chunks `i` and `j` and the `side` in that pair, once for each of `_chunks`."""
    chunk = F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda j: F.struct(
        F.least(F.col("_c"), j).alias("i"), F.greatest(F.col("_c"), j).alias("j"),
        F.when(F.col("_c") > j, 1).otherwise(0).alias("side")))
    return met.select("*", chunk.alias("_c")).select(*columns, F.explode(pairs).alias("p")).select(
        *columns, "p.i", "p.j", "p.side")


def bucket_links(rows: DataFrame, radii: tuple[int, ...]) -> DataFrame:
    """Links `a, b` between the nodes of `table, bucket, node, fp` whose `fp` differ little.

    fp: the fingerprint's words in little-endian bytes.
    """
    counts = rows.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        F.col("table").alias("_t"), F.col("bucket").alias("_b"),
        F.ceil(F.col("_n") / CHUNK).cast("int").alias("_chunks"))
    met = rows.join(counts, (F.col("table") == F.col("_t")) & (F.col("bucket") == F.col("_b")))
    keys = ["table", "bucket", "i", "j"]
    dealt = _pairs_of_chunks(met, ["table", "bucket", "node", "fp"])

    def compare(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            rest = None
            changed = (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1)
            cuts = np.flatnonzero(changed) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            rest = frame.iloc[last:]
            yield from solve(frame.iloc[:last], cuts[:-1])
        if rest is not None and len(rest):
            yield from solve(rest, np.array([], int))
        frame = rest = None
        give_back()

    def solve(frame, cuts):
        if not len(frame):
            return
        node = frame["node"].to_numpy()
        words = np.frombuffer(b"".join(frame["fp"]), "<u8").reshape(len(frame), -1)
        bounds = np.r_[0, cuts, len(frame)]
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        side = frame["side"].to_numpy()
        start = 0
        for k in range(1, len(bounds)):  # so many groups at a time that their planes stay small
            if k == len(bounds) - 1 or k - start >= 1024 or bounds[k + 1] - bounds[start] > 2 * CHUNK:
                part = slice(bounds[start], bounds[k])
                found = group_links(node[part], words[part], group[part], side[part], radii)
                if found:
                    yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
                start = k

    return (dealt.repartition(*keys).sortWithinPartitions(*keys, "side", "node")
            .mapInPandas(compare, "a long, b long").distinct())


def radius_rows(distinct: DataFrame, radius: int, count: int) -> DataFrame:
    """`table, bucket, node, fp` of distinct 64-bit fingerprints `fp` for a search by radius."""
    blocks = next((b for b in range(radius + 1, radius + 4)
                   if count / 2 ** (64 * (b - radius) / b) <= BUCKET_ROWS), radius + 4)
    edges = [64 * k // blocks for k in range(blocks + 1)]
    mask = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    tables = []
    for t, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        bits = sum(mask[k] for k in chosen)
        signed = bits - (1 << 64) if bits >> 63 else bits
        tables.append(F.struct(F.lit(t).alias("table"),
                               F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("bucket")))
    # reverse() of the big-endian bytes gives little-endian ones.
    little = F.unhex(F.concat(*(F.substring(F.lpad(F.hex("fp"), 16, "0"), 15 - 2 * k, 2) for k in range(8))))
    return distinct.select(F.explode(F.array(*tables)).alias("t"), F.col("fp").alias("node"),
                           little.alias("fp")).select("t.table", "t.bucket", "node", "fp")


def groups_by_radius(prints: DataFrame, radius: int = 3) -> DataFrame:
    """`key, fp` rows with `component`: the smallest key reachable over links of the radius.

    prints: `key, fp`, as `fingerprints` gives it. Null keys are in groups, but name none
    while another key is there. An empty table gives an empty one.
    """
    least = materialise(prints.groupBy("fp").agg(F.min("key").alias("least")), "fingerprints")
    links = bucket_links(radius_rows(least.select("fp"), radius, least.count()), (radius,))
    found = components(links)
    labelled = least.join(found, least["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label"))
    names = labelled.groupBy("label").agg(F.min("least").alias("component"))
    named = labelled.join(names, "label").select(F.col("fp").alias("_fp"), "component")
    return prints.join(named, prints["fp"] == F.col("_fp")).select("key", "fp", "component")


def _similar(words: int, similarity: float):
    def run(batches):
        last = (None, None)
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.column("a").to_pylist(), batch.column("left"), batch.column("right")):
                if last[0] != a:
                    last = (a, set(shingle_hashes(left.as_py(), words).tolist()))
                other = set(shingle_hashes(right.as_py(), words).tolist())
                shared = len(last[1] & other)
                whole = len(last[1]) + len(other) - shared
                keep.append(shared >= similarity * whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], names=["a", "b", "similar"])
        batch = None
        give_back()
    return run


def _sets(words: int):
    """`_set, shingles, size`: the distinct hashes of a text's shingles."""
    def run(batches):
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in sets], pa.binary()),
                 pa.array([len(x) for x in sets], pa.int64())], names=["_set", "shingles", "size"])
    return run


def _similar_of_group(node, label, words, sets, left, right, similarity):
    """Verified links between rows of `left` and of `right`, thinned to trees of the labels."""
    codes, flat = [None] * len(sets), np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(x) for x in sets])
    for k, part in enumerate(np.split(flat, np.cumsum(sizes)[:-1])):
        codes[k] = part
    mark = np.zeros(len(flat), np.int32)
    links, label = [], label.copy()
    for a in left:
        near = np.bitwise_count(words[right] ^ words[a]).sum(1) <= POSSIBLE
        near &= label[right] != label[a]
        near &= np.minimum(sizes[right], sizes[a]) >= similarity * np.maximum(sizes[right], sizes[a])
        to = right[near]
        if not len(to):
            continue
        mark[codes[a]] = 1
        ends = np.cumsum(sizes[to])
        shared = np.add.reduceat(mark[np.concatenate([codes[k] for k in to])], ends - sizes[to])
        mark[codes[a]] = 0
        for k in to[shared >= similarity * (sizes[to] + sizes[a] - shared)]:
            if label[k] != label[a]:
                links.append((node[a], node[k]))
                label[label == label[k]] = label[a]
    return links


def similar_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Links `a, b` that join the nodes with different labels in a bucket as all similar pairs do.

    rows: `table, bucket, part, node, label, size, fp, shingles`; a bucket holds the rows
    of one part. Pairs are verified before they are thinned.
    """
    place = ["table", "bucket", "part"]
    keys = [*place, "i", "j"]
    counts = rows.groupBy(*place).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_size"), F.min("label").alias("_min"),
        F.max("label").alias("_max")).where("_min <> _max").select(
        *(F.col(c).alias(f"_{c}") for c in place),
        F.ceil(F.greatest(F.col("_n") / CHUNK, F.col("_size") / CHUNK_SHINGLES)).cast("int").alias("_chunks"))
    met = rows.join(counts, [F.col(c) == F.col(f"_{c}") for c in place])
    dealt = _pairs_of_chunks(met, [*place, "node", "label", "fp", "shingles"])

    def compare(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            changed = (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1)
            bounds = np.r_[0, np.flatnonzero(changed) + 1]
            for start, stop in zip(bounds[:-1], bounds[1:]):
                yield from solve(frame.iloc[start:stop])
            rest = frame.iloc[bounds[-1]:]
        if rest is not None and len(rest):
            yield from solve(rest)

    def solve(frame):
        side = frame["side"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if frame["i"].iloc[0] == frame["j"].iloc[0]:
            right = left
        if not len(left) or not len(right):
            return
        words = np.frombuffer(b"".join(frame["fp"]), "<u8").reshape(len(frame), -1)
        found = _similar_of_group(frame["node"].to_numpy(), frame["label"].to_numpy(), words,
                                  [np.frombuffer(x, np.uint64) for x in frame["shingles"]], left, right, similarity)
        if found:
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "side", "node").mapInPandas(compare, "a long, b long")


def groups_by_similarity(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                         similarity: float = 0.8) -> DataFrame:
    """`key, component` rows of documents in groups, except each group's smallest key.

    Two texts are linked if their distinct shingles have a Jaccard similarity of at least
    `similarity`; every link is verified. Texts with equal words are linked. Texts of
    fewer words are one shingle; texts without a word are linked with each other. Rows
    with a null key are left out; rows with equal keys count as one document.
    """
    signed = materialise(_signatures(docs, key, text, words).where(F.col("key").isNotNull()), "signatures")
    least = signed.groupBy("digest").agg(
        F.min("key").alias("node"), F.min_by("keys", "key").alias("keys"), F.min_by("fp", "key").alias("fp"))
    nodes = materialise(least, "texts")
    rows = nodes.select(F.posexplode("keys").alias("table", "bucket"), "node", "fp").distinct()
    links = materialise(bucket_links(rows, (SURE, POSSIBLE)).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    ids = links.select(F.col("a").alias("_id")).unionByName(links.select(F.col("b").alias("_id"))).distinct()
    few = materialise(ids, "ids")
    asked = F.broadcast(few) if few.count() <= BROADCAST_IDS else few
    texts = materialise(
        docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
        .join(asked, F.col("_key") == F.col("_id"), "left_semi").dropDuplicates(["_key"]), "asked")
    paired = (links.join(texts.select(F.col("_key").alias("a"), F.col("_text").alias("left")), "a")
              .join(texts.select(F.col("_key").alias("b"), F.col("_text").alias("right")), "b"))
    judged = materialise(paired.mapInArrow(_similar(words, similarity), "a long, b long, similar boolean"), "judged")
    sure = judged.where("similar").select("a", "b")
    found = components(sure)
    rejected = judged.where("not similar").select(F.col("a").alias("_a"))
    if not rejected.isEmpty():
        parts = components(links).withColumnRenamed("component", "part")
        open_ = parts.join(rejected, F.col("node") == F.col("_a")).select(F.col("part").alias("_part")).distinct()
        parts = materialise(parts.join(open_, F.col("part") == F.col("_part"), "left_semi").join(
            found.select(F.col("node").alias("_node"), "component"), F.col("node") == F.col("_node"), "left").select(
            F.col("node").alias("_node"), "part", F.coalesce("component", "node").alias("label")), "open")
        sets = texts.select("_key", "_text").join(parts, F.col("_key") == F.col("_node"), "left_semi").mapInArrow(
            _sets(words), "_set long, shingles binary, size long")
        sets = materialise(sets.join(parts, F.col("_set") == F.col("_node")).select(
            "_set", "part", "label", "size", "shingles"), "sets")
        more = similar_links(rows.join(sets, F.col("node") == F.col("_set")), similarity)
        found = components(sure.unionByName(more))
    copies = signed.select(F.col("key").alias("_key"), "digest").join(
        nodes.select(F.col("digest").alias("_digest"), "node"), F.col("digest") == F.col("_digest"))
    named = copies.join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    return named.select(F.col("_key").alias("key"), F.coalesce("component", "node").alias("component")).where(
        F.col("key") != F.col("component")).distinct()


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                         similarity: float = 0.8) -> DataFrame:
    """The rows of `docs` without the documents of each group but that with the smallest key.

    Of rows with equal keys, and of rows with a null key, all stay or go together; null
    keys stay.
    """
    gone = materialise(groups_by_similarity(docs, key, text, words, similarity).select(
        F.col("key").alias("_gone")).distinct(), "dropped")
    asked = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(asked, docs[key].cast("long") == F.col("_gone"), "left_anti")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prints = materialise(fingerprints(docs), "prints")
    return groups_by_radius(prints).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


QUERIES = {"op3_simhash": op3_simhash}
