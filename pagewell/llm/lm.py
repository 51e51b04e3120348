"""Stupid-backoff scores of documents from the corpus's own n-gram counts.

A document's n-grams are exploded and aggregated by blocks of documents, a block being
one row; each block asks every partition of the count tables for its n-grams there. The
tables are partitioned by hash: a partition adds up what all blocks hold of each n-gram
and joins the totals back to what each block asked, whence they return to the block and
are summed per document. An n-gram comes from a block once however frequent it is, so no
key is hot, and tables grow with the corpus.

The counts that score a document are those of the other documents: what a document adds
to a count itself is taken off, or every n-gram would be known.

An n-gram is its 64-bit hash. Words are lower-cased in A-Z and stand between blanks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import materialise, table

ORDER, BACKOFF = 2, 0.4
#: Words of a block, unless a document is longer; n-grams of a partition of the tables.
BLOCK_WORDS, PARTITION_GRAMS = 1_500_000, 500_000
SCORES = "doc_id long, n_words long, log_score double"


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned 64-bit values as compressed byte planes, the steps between ascending ones."""
    values = values.astype("<u8", copy=False)
    if ascending and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view("<u8").reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def _blocks(batches):
    """`block, docs, sizes, words, vocabulary`: words are places in the ascending hashes."""
    number = TaskContext.get().partitionId() << 32
    docs, texts, count = [], [], 0

    def block():
        places: dict[bytes, int] = {}
        flat = [places.setdefault(w, len(places)) for t in texts for w in t]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in places), np.uint64, len(places))
        vocabulary, rank = np.unique(hashes, return_inverse=True)
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "docs": pa.array([docs], pa.list_(pa.int64())),
            "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
            "n": pa.array([len(flat)], pa.int64()),
            "words": pa.array([_packed(rank[np.array(flat, np.int64)])], pa.binary()),
            "vocabulary": pa.array([_packed(vocabulary, True)], pa.binary())})

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = text.encode().lower().split() if text else []
            if docs and count + len(words) > BLOCK_WORDS:
                yield block()
                number, docs, texts, count = number + 1, [], [], 0
            docs.append(key)
            texts.append(words)
            count += len(words)
    if docs:
        yield block()


def _grams(words: bytes, vocabulary: bytes, sizes: np.ndarray, order: int):
    """For k = 1 to order: the hash of the k-gram that ends at each word, and whether it is
    inside its document."""
    hashes = _unpacked(vocabulary, True)[_unpacked(words).astype(np.int64)]
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(hashes)) - np.repeat(starts, sizes)
    grams, inside = [hashes], [np.ones(len(hashes), bool)]
    for k in range(2, order + 1):
        longer = np.zeros(len(hashes), np.uint64)
        h = grams[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        longer[1:] = h ^ (h >> np.uint64(29))
        grams.append(longer)
        inside.append(place >= k - 1)
    return grams, inside


def _ask(order: int, bits: int):
    def run(frames):
        for frame in frames:
            for row in frame.itertuples():
                sizes = np.array(row.sizes, np.int64)
                grams, inside = _grams(row.words, row.vocabulary, sizes, order)
                asked = []
                for g, ok in zip(grams, inside):
                    key, n = np.unique(g[ok], return_counts=True)
                    cut = np.searchsorted(key >> np.uint64(64 - bits), np.arange((1 << bits) + 1)) if bits else [0, len(key)]
                    asked.append((key, n.astype(np.uint64), cut))
                for start in range(0, 1 << bits, 256):
                    yield pd.DataFrame([
                        (p, row.block, [_packed(k[c[p]:c[p + 1]], True) for k, _, c in asked],
                         [_packed(n[c[p]:c[p + 1]]) for _, n, c in asked])
                        for p in range(start, min(1 << bits, start + 256))], columns=["part", "block", "keys", "counts"])
    return run


def _answer(order: int):
    def run(frame):
        """The totals of one partition of the tables, joined to what each block asked."""
        totals = [[] for _ in range(len(frame))]
        for k in range(order):
            keys = [_unpacked(x[k], True) for x in frame["keys"]]
            counts = np.concatenate([_unpacked(x[k]) for x in frame["counts"]]).astype(np.int64)
            _, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(int(at.max()) + 1 if len(at) else 0, np.int64)
            np.add.at(total, at, counts)
            for out, one in zip(totals, np.split(total[at], np.cumsum([len(x) for x in keys])[:-1])):
                out.append(_packed(one.astype(np.uint64)))
        return pd.DataFrame({"block": frame["block"], "part": frame["part"], "totals": totals})
    return run


def _score(order: int, all_words: int):
    def run(blocks, answers):
        if not len(blocks):
            return pd.DataFrame({"doc_id": pd.Series([], dtype="Int64"), "n_words": [], "log_score": []})
        row = next(blocks.itertuples())
        sizes = np.array(row.sizes, np.int64)
        grams, inside = _grams(row.words, row.vocabulary, sizes, order)
        answers = answers.sort_values("part")
        doc = np.repeat(np.arange(len(sizes)), sizes)
        seen = []  # of each k-gram how often the other documents have it
        for k in range(order):
            total = np.concatenate([_unpacked(x[k]) for x in answers["totals"]]).astype(np.int64)
            _, at = np.unique(grams[k][inside[k]], return_inverse=True)
            _, own_at, own = np.unique(doc[inside[k]] * max(1, len(total)) + at, return_inverse=True, return_counts=True)
            others = np.zeros(len(doc), np.int64)
            others[inside[k]] = total[at] - own[own_at]
            seen.append(others)
        words = np.maximum(1, all_words - sizes)[doc]
        value = np.zeros(len(doc))
        open_ = np.ones(len(doc), bool)
        penalty = np.zeros(len(doc))
        for k in range(order, 1, -1):
            before = np.r_[0, seen[k - 2][:-1]]
            found = open_ & inside[k - 1] & (seen[k - 1] > 0) & (before > 0)
            value[found] = np.log(seen[k - 1][found] / before[found])
            open_ &= ~found
            penalty[open_ & inside[k - 1]] += math.log(BACKOFF)
        known = open_ & (seen[0] > 0)
        value[known] = np.log(seen[0][known] / words[known])
        strange = open_ & ~known
        value[strange] = math.log(BACKOFF) - np.log(words[strange])
        score = np.bincount(doc, value + penalty, minlength=len(sizes))
        return pd.DataFrame({"doc_id": pd.array(row.docs, dtype="Int64"), "n_words": sizes, "log_score": score})
    return run


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """`key, n_words, log_score, lm_score` of every row, whatever its key.

    log_score sums ln S over the words: S is the count of the longest n-gram (up to
    `order` words) that other documents hold, over the count of its first words, times
    `BACKOFF` for each longer one tried; for single words over the number of all other
    words. A word that no other document has counts `BACKOFF` over that number. lm_score
    is the mean per word, null without words. Null texts have no words. Copies are other
    documents, so they vouch for each other. An empty table gives an empty one.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    blocks = materialise(rows.mapInArrow(
        _blocks, "block long, docs array<long>, sizes array<int>, n long, words binary, vocabulary binary"), "blocks")
    words = blocks.agg(F.sum("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, words * order / PARTITION_GRAMS))))
    asked = blocks.select("block", "sizes", "words", "vocabulary").mapInPandas(
        _ask(order, bits), "part long, block long, keys array<binary>, counts array<binary>")
    answered = asked.groupBy("part").applyInPandas(_answer(order), "block long, part long, totals array<binary>")
    scored = blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(_score(order, words), SCORES)
    return scored.select(F.col("doc_id").alias(key), "n_words", "log_score",
                         F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("lm_score"))


def op2_lm_scores(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op2_lm_scores_order3(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), order=3)


QUERIES = {"op2_lm_scores": op2_lm_scores, "op2_lm_scores_order3": op2_lm_scores_order3}
