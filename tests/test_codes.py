"""Search on codes: bounds hold, nothing is lost, few vectors are fetched."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewell.operators import codes as K
from pagewell.operators import nearby as N
from pagewell.operators import search as S
from pagewell.plans.store import CollectionStore


@pytest.fixture(scope="module")
def vectors(spark):
    made = random.Random(8)
    rows = [[made.gauss(0, 1) for _ in range(24)] for _ in range(600)]
    rows += [[2 * x for x in rows[k]] for k in range(40)] + [rows[5]] * 30 + [[0.0] * 24] * 3
    rows += [[1e-30 * x for x in rows[7]], [1e30] + [0.0] * 23]
    return spark.createDataFrame([(f"p{n:04d}", r) for n, r in enumerate(rows)], "point_id string, vector array<double>").repartition(5).cache()


def test_errors_bound_products():
    made = np.random.default_rng(1)
    units = made.normal(size=(300, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes, step, error = K.encode(units)
    told = codes * step[:, None]
    assert (np.abs(units @ units.T - told @ units.T) <= error[:, None] + 1e-12).all() and error.max() < 0.02


@pytest.mark.parametrize("k", [1, 7, 100, 1000])
@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "query_block": 30, "point_slice": 90}])
def test_hits_are_the_exact_ones(vectors, k, options):
    asked = vectors.where(F.substring("point_id", -1, 1).isin("3", "5")).select(
        F.col("point_id").alias("query_id"), F.col("vector").alias("query_vector"))
    found = K.search_codes(K.add_codes(vectors), vectors, asked, k, **options)
    want = S.top_k_pairs(vectors, asked, k)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_blocks_find_candidates_once(vectors):
    asked = vectors.select(F.col("point_id").alias("query_id"), F.col("vector").alias("query_vector"))
    found = K.candidates(K.add_codes(vectors), asked, 3, broadcast_bytes=0, query_block=30, point_slice=90)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("CoGroupsInArrow") == 1


def test_few_candidates(vectors):
    asked = vectors.limit(50).select(F.col("point_id").alias("query_id"), F.col("vector").alias("query_vector"))
    row = K.cost(K.add_codes(vectors), asked, 5).first()
    assert row["pairs"] == 50 * vectors.count() and row["share"] < 0.1
    assert K.search_codes(K.add_codes(vectors.limit(0)), vectors, asked, 5).count() == 0
    assert K.search_codes(K.add_codes(vectors), vectors, asked.limit(0), 5).count() == 0


def test_bad_vectors_are_errors(rows, vectors):
    for bad in ([[1.0], [1.0, 2.0]], [[1.0, 2.0], None]):
        frame = rows("point_id string, vector array<double>", *((str(n), v) for n, v in enumerate(bad))).coalesce(1)
        with pytest.raises(Exception, match="differ in length|null"):
            K.add_codes(frame).collect()
    asked = rows("query_id string, query_vector array<double>", ("a", [1.0, 2.0]))
    with pytest.raises(Exception, match="differ in length"):
        K.search_codes(K.add_codes(vectors), vectors, asked, 3).collect()
    lengths = rows("point_id string, vector array<double>", ("a", [1.0] * 3), ("b", [1.0] * 5), ("c", [1.0] * 4))
    with pytest.raises(Exception, match="must have 4 values"):
        N.add_cells(lengths.coalesce(1), 4).collect()


def test_store_after_writes_and_compaction(rows, spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    store.add_documents("c", rows("ordinal long, text string", *((n, f"text number {n} of many") for n in range(60))))
    store.add_documents("c", rows("ordinal long, text string", *((n, f"text number {n} of more") for n in range(30))))
    store.add_documents("c", rows("ordinal long, text string", *((n, f"text number {n} of many") for n in range(20))))
    asked = S.embed_queries(rows("query_id long, query string", (1, "number 7 of many"), (2, "more"), (3, "")))

    def both():
        want = S.top_k_pairs(store.points("c").select("point_id", "vector"), asked, 6).collect()
        assert sorted(map(tuple, store.search_nearby("c", asked, 6).collect())) == sorted(map(tuple, want))
        return sorted(map(tuple, want))

    before = both()
    assert store.codes("c").count() == 90
    store.compact("c")
    assert both() == before
    plan = K.candidates(store.codes("c"), asked, 6)._jdf.queryExecution().executedPlan().toString()
    assert "vector" not in plan.replace("query_vector", "")
    store.delete("c")
    store.create("c", 64)
    assert store.search_nearby("c", asked, 6).count() == 0
