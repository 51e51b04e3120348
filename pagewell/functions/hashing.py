"""The default embedder: a hashed bag of words.

It is deterministic and lexical, not semantic: two texts are close when they share
words. Register a model of your own for semantic search (see `plans.registry`).
"""

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSION = 64

# What separates words: anything but letters and digits.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"

# Bytes of text taken apart at once (the words take some ten times as much), and words
# remembered per Python worker.
CHUNK_BYTES = 4 << 20
REMEMBERED = 1 << 18


class _Slots(dict):
    """Word to slot: twice its bucket, plus one when its sign is negative."""

    def __init__(self, dimension: int):
        super().__init__()
        self.dimension = dimension

    def __missing__(self, word: bytes) -> int:
        eight_digits = int.from_bytes(md5(word).digest()[:4], "big")
        bucket = (eight_digits >> 4) % self.dimension
        slot = 2 * bucket + (eight_digits % 16 >= 8)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = slot
        return slot


def _vectors(texts: pa.Array, slots: _Slots) -> np.ndarray:
    width = 2 * slots.dimension
    words = pc.split_pattern_regex(pc.utf8_lower(texts), pattern=BETWEEN_WORDS)
    coded = words.flatten().dictionary_encode()
    known = np.array(
        [slots[w] if w else -1 for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.int64)
    at = known[coded.indices.to_numpy()]
    row = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    real = at >= 0
    counts = np.bincount(
        row[real] * width + at[real], minlength=len(texts) * width).reshape(-1, width)
    signed = (counts[:, 0::2] - counts[:, 1::2]).astype(np.float64)
    norms = np.sqrt((signed * signed).sum(axis=1, keepdims=True))
    norms[norms == 0] = 1.0
    return (signed / norms).astype(np.float32)


def hashed_embedder(dimension: int = DIMENSION) -> Callable[[Column], Column]:
    """Column function from a text to its vector; text without words gives zeros.

    A word counts into bucket `first 7 hex digits of its md5 mod dimension`, with
    the sign of the 8th digit (below 8: plus); the result has length 1.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slots = _Slots(dimension)
        for batch in batches:
            rows = max(1, len(batch) * CHUNK_BYTES // max(batch.nbytes, 1))
            made = [
                _vectors(batch.slice(start, rows), slots)
                for start in range(0, len(batch), rows)]
            flat = np.concatenate(made).ravel() if made else np.empty(0, np.float32)
            offsets = np.arange(0, len(flat) + 1, dimension, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float32()))

    # Keeps filters on the vector from being pushed below, where they would repeat it.
    return embed.asNondeterministic()


def batch_model() -> Callable[[list[str]], np.ndarray]:
    """The same as a model of batches, see `functions.batches`."""
    slots = _Slots(DIMENSION)
    return lambda texts: _vectors(pa.array(texts, pa.string()), slots)
