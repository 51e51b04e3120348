"""Embedding by a model that takes batches of texts.

A model pads the texts of a batch to the longest one, so a batch costs its rows times that
length. Texts are grouped by length and dealt to batches within a budget of that cost.
"""

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[list[str]], np.ndarray]

# Models of this Python worker, which outlives its tasks.
_LOADED: dict[str, Model] = {}


def _loaded(key: str, load: Callable[[], Model]) -> Model:
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]


def text_bytes(texts: pa.Array) -> np.ndarray:
    """Bytes of UTF-8 of each text, which bound the tokens of a byte-level tokenizer."""
    return pc.binary_length(texts).to_numpy(zero_copy_only=False)


def deal(lengths: np.ndarray, budget: int) -> Iterator[np.ndarray]:
    """Rows of each batch: by length, as many as rows times longest keep within the budget.

    A row longer than the budget is a batch of its own; a length of 0 counts as 1.
    """
    order = np.argsort(lengths, kind="stable")
    sizes = np.maximum(lengths[order], 1)
    start = 0
    while start < len(order):
        cost = sizes[start:] * np.arange(1, len(order) - start + 1)
        end = start + max(1, int(np.searchsorted(cost, budget, side="right")))
        yield order[start:end]
        start = end


def batched_embedder(
    load: Callable[[], Model], budget: int, length: Callable[[pa.Array], np.ndarray] = text_bytes,
) -> Callable[[Column], Column]:
    """Column function from a text to the vector that a model gives it.

    `load()` makes the model, once per Python worker; `model(texts)` gives a matrix with a
    row per text. `length` measures the texts in what the budget counts. Vectors come in
    the order of the texts; null is embedded as the empty text. What is grouped by length
    is one Arrow batch (`spark.sql.execution.arrow.maxRecordsPerBatch`).
    """
    if budget < 1:
        raise ValueError("budget must be at least 1")
    key = os.urandom(8).hex()

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _loaded(key, load)
        for batch in batches:
            texts = pc.fill_null(batch, "")
            made: list = [None] * len(texts)
            for rows in deal(np.asarray(length(texts)), budget):
                vectors = np.asarray(model(texts.take(pa.array(rows)).to_pylist()), np.float32)
                if vectors.ndim != 2 or len(vectors) != len(rows):
                    raise ValueError(f"{len(rows)} texts gave vectors of shape {vectors.shape}")
                for row, vector in zip(rows, vectors):
                    made[row] = vector
            yield pa.array(made, pa.list_(pa.float32()))

    # Keeps filters on the vector from being pushed below, where they would repeat it.
    return embed.asNondeterministic()
