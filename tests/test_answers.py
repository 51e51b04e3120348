"""Answers to tables of requests against plain Python on a few collections."""

import json
import random

import pytest

from pagewell.functions.hashing import hashed_embedder
from pagewell.operators.ordering import rank_offsets
from pagewell.plans import answers as A
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def held(spark):
    made = random.Random(2)
    ids = {c: sorted({"".join(made.choice("abé\U0001F600z") for _ in range(made.randint(0, 11))) for _ in range(n)},
                     key=lambda i: i.encode()) for c, n in (("one", 60), ("two", 9), ("three", 1))}
    keys = spark.createDataFrame([(c, i) for c in ids for i in ids[c]], "collection string, point_id string")
    return ids, keys


def test_ranks_of_offsets(spark, held):
    ids, keys = held
    asked = [(c, o) for c in (*ids, "none") for o in (None, "", "a", "ab", "zz", "\U0001F600" * 20, *ids["one"][:9])]
    ranked, places = rank_offsets(keys, spark.createDataFrame(
        [(n, *a) for n, a in enumerate(asked)], "n long, collection string, offset string"))
    order = {(r["collection"], r["point_id"]): r["_rank"] for r in ranked.collect()}
    assert sorted(order.values()) == list(range(len(order)))
    found = {r["n"]: r for r in places.collect()}
    for n, (collection, offset) in enumerate(asked):
        later = [i for i in ids.get(collection, ()) if i.encode() >= (offset or "").encode()]
        assert found[n]["_end"] - found[n]["_from"] == len(later)
        if later:
            assert found[n]["_from"] == order[collection, later[0]]


def test_all_tools(spark, held):
    ids, keys = held
    points = keys.withColumn("payload", F.struct(F.concat(F.lit("text "), "point_id").alias("text"))).withColumn(
        "vector", hashed_embedder()(F.col("point_id")))
    catalog = spark.createDataFrame(
        [(c, 64, "cosine", 0, False) for c in ids] + [("gone", 64, "cosine", 0, False), ("gone", None, None, 1, True)],
        "name string, vector_size int, distance string, batch_id long, deleted boolean")
    calls = [("l", "list_collections", None), ("d", "delete_collection", {"collection_name": "any"}),
             ("d0", "delete_collection", {}), ("a", "add_documents", {"collection_name": "x", "documents": [{"text": "p"}, {"text": "q"}]}),
             ("a0", "add_documents", {"collection_name": "x", "documents": []}), ("s", "search", {"collection_name": "none", "query": "a"}),
             ("?", "no such tool", {})]
    pages = [(c, o, n) for c in (*ids, "none") for o in (None, "b", "zzzz") for n in (0, 1, 9, 10, 100)]
    calls += [(f"g{k}", "get_documents", {"collection_name": c, "limit": n, **({"offset": o} if o else {})})
              for k, (c, o, n) in enumerate(pages)]
    requests = spark.createDataFrame(
        [(r, t, a if a is None else json.dumps(a)) for r, t, a in calls], "request_id string, tool string, args string")
    got = {r["request_id"]: json.loads(r["result"]) for r in A.answer_requests(points, keys, catalog, requests).collect()}
    want = {"l": sorted(ids), "d": {"deleted": True}, "a": {"stored_count": 2}, "a0": {"stored_count": 0}, "s": []}
    for k, (c, o, n) in enumerate(pages):
        later = [i for i in ids.get(c, ()) if i.encode() >= (o or "").encode()]
        want[f"g{k}"] = {"documents": [{"id": i, "payload": {"text": f"text {i}"}} for i in later[:n]],
                         "next_offset": later[n] if len(later) > n else None}
    assert got == want
    none = A.answer_requests(points.where("false"), keys.where("false"), catalog.where("false"), requests).collect()
    assert {r["request_id"] for r in none} == set(want)
    assert [r["request_id"] for r in A.answer_requests(points, keys, catalog, requests, enabled=["delete_collection"]).collect()] == ["d"]
