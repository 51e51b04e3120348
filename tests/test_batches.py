"""Batches for a model, and the newest rows of batches."""

import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewell.functions import hashing
from pagewell.functions.batches import batched_embedder, deal
from pagewell.functions.hashing import hashed_embedder
from pagewell.operators.embed import embed_text
from pagewell.operators.newest import newest_of_batches
from pagewell.plans.store import CollectionStore


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=60), st.integers(1, 100))
def test_batches_hold_each_row_once_within_the_budget(lengths, budget):
    found = list(deal(np.array(lengths, np.int64), budget))
    assert sorted(r for batch in found for r in batch) == list(range(len(lengths)))
    for batch in found:
        assert len(batch) == 1 or len(batch) * max(1, *(lengths[r] for r in batch)) <= budget
    # Not one batch more than needed in the order of lengths: the next row did not fit.
    for batch, following in zip(found, found[1:]):
        assert (len(batch) + 1) * max(1, lengths[following[0]]) > budget


def counting(folder):
    """A model that writes down what it sees: the load of each worker, and the batches."""
    def load():
        def told(line):
            with open(f"{folder}/{os.getpid()}", "a") as out:
                out.write(line + "\n")

        def model(texts):
            told(f"batch {len(texts)} {max(len(t.encode()) for t in texts)}")
            return np.array([[len(t), t.count("a")] for t in texts])

        told("load")
        return model

    return load


def test_model_is_loaded_once_per_worker_and_sees_no_batch_over_the_budget(spark, rows, tmp_path):
    texts = [None, "", "a" * 500, "é"] + ["ba" * (i % 37) for i in range(3000)]
    table = rows("n long, text string", *enumerate(texts)).repartition(12)
    made = embed_text(table, "text", batched_embedder(counting(str(tmp_path)), 256))
    for _ in range(2):
        got = {r.n: list(r.vector) for r in made.collect()}
        assert got == {n: [len(t or ""), (t or "").count("a")] for n, t in enumerate(texts)}
    lines = {f.name: f.read_text().split("\n")[:-1] for f in tmp_path.iterdir()}
    assert lines
    for seen in lines.values():
        assert seen[0] == "load" and seen.count("load") == 1
        for _, count, longest in (line.split() for line in seen[1:]):
            assert int(count) == 1 or int(count) * int(longest) <= 256


def test_model_of_a_wrong_number_of_vectors_fails(rows):
    short = embed_text(rows("text string", ("a",), ("b",)).coalesce(1), "text",
                       batched_embedder(lambda: lambda texts: np.zeros((1, 4)), 100))
    with pytest.raises(Exception, match="2 texts gave vectors"):
        short.collect()
    with pytest.raises(ValueError):
        batched_embedder(lambda: None, 0)


def test_no_rows(rows):
    made = embed_text(rows("text string").where("false"), "text", batched_embedder(lambda: None, 10))
    assert made.collect() == []


def test_newest_of_batches_both_ways(rows):
    table = rows("point_id string, batch_id long, vector array<float>",
                 ("a", 0, [1.0]), ("b", 0, [2.0]), ("a", 1, [3.0]), ("c", 1, [4.0]), ("a", 4, [5.0]))
    want = {("b", 0), ("c", 1), ("a", 4)}
    for told in (0, 1, 100):
        got = [(r.point_id, r.batch_id) for r in newest_of_batches(table, told=told).collect()]
        assert len(got) == 3 and set(got) == want
    assert newest_of_batches(table.where("false")).count() == 0


def test_points_of_two_batches_are_read_without_moving_vectors(rows, spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path / "store"), hashed_embedder())
    text = "ordinal long, text string, metadata map<string,string>"
    store.add_documents("c", rows(text, (0, "one", None), (1, "two", None)))
    store.add_documents("c", rows(text, (0, "two", {"k": "v"}), (1, "three", None)))
    points = store.points("c")
    assert {(r.payload.text, r.batch_id) for r in points.collect()} == {("one", 0), ("two", 1), ("three", 1)}
    plan = points._jdf.queryExecution().executedPlan().toString().split("AdaptiveSparkPlan")[-1]
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert moved and "BroadcastHashJoin" in plan
    above = plan.split("BroadcastHashJoin")[0]
    assert "Exchange" not in above


def test_hashed_words_take_a_batch_apart_in_small_chunks(monkeypatch):
    sizes, vectors = [], hashing._vectors
    monkeypatch.setattr(hashing, "_vectors", lambda texts, slots: (sizes.append(texts.nbytes), vectors(texts, slots))[1])
    texts = pa.array([f"word {n} " * 120 for n in range(20_000)])
    made = pa.concat_arrays(hashing.hashed_embedder().func(iter([texts])))
    assert texts.nbytes > 20 << 20 and max(sizes) < 5 << 20
    want = vectors(texts, hashing._Slots(hashing.DIMENSION))
    assert (made.flatten().to_numpy().reshape(want.shape) == want).all()


def test_hashed_words_are_forgotten_beyond_a_bound():
    slots = hashing._Slots(hashing.DIMENSION)
    words = [b"%d" % n for n in range(600_000)]
    first = [slots[w] for w in words[:1000]]
    most = 0
    for word in words:
        slots[word]
        most = max(most, len(slots))
    assert most <= 300_000 and [slots[w] for w in words[:1000]] == first
