import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from pagewell.functions.hashing import BETWEEN_WORDS, hashed_embedder
from pagewell.operators import nearby as N
from pagewell.operators import search as S
from pagewell.operators.embed import check_vectors, embed_text, vector_size


def brute(points, queries, k):
    def cosine(a, b):
        la, lb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b)) / (la * lb), 9) if la and lb else 0.0
    out = []
    for q, v in queries:
        best = sorted((-cosine(v, p), i) for i, p in points)[:k]
        out += [(q, n + 1, i, -s + 0.0) for n, (s, i) in enumerate(best)]
    return sorted(out)


def got(hits):
    return sorted((r.query_id, r["rank"], r.point_id, round(r.score, 9) + 0.0) for r in hits.collect())


def want(points, queries, k):
    return [(q, n, i, round(s, 9) + 0.0) for q, n, i, s in brute(points, queries, k)]


@pytest.fixture
def sets(spark):
    """Vectors a third of which are equal, some of them zero."""
    rng = random.Random(3)
    hot = [1.0, 2.0, 0.0, -1.0]
    points = [(f"p{i:04d}", hot if i % 3 == 0 else [0.0] * 4 if i % 50 == 1 else
               [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(900)]
    queries = [(i, [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(30)]
    queries += [(30, hot), (31, [0.0] * 4)]
    return (points, queries,
            spark.createDataFrame(points, "point_id string, vector array<float>").repartition(5),
            spark.createDataFrame(queries, "query_id long, query_vector array<float>"))


@pytest.mark.parametrize("k", [1, 7, 1000])
def test_many_queries_like_brute_force(sets, k):
    points, queries, frame, asked = sets
    assert got(S.top_k_pairs(frame, asked, k)) == want(points, queries, k)


def test_block_join_like_brute_force(sets):
    points, queries, frame, asked = sets
    hits = S.top_k_pairs(frame, asked, 7, broadcast_bytes=0, query_block=5, point_slice=100)
    assert got(hits) == want(points, queries, 7)


def test_block_join_copies_do_not_grow_with_the_blocks(sets, spark, monkeypatch):
    points, queries, frame, asked = sets
    seen, add = spark.sparkContext.accumulator(0), S._add_batch

    def counted(top, batch):
        seen.add(batch.num_rows)
        add(top, batch)

    monkeypatch.setattr(S, "_add_batch", counted)
    hits = S.top_k_pairs(frame, asked, 7, broadcast_bytes=0, query_block=1, point_slice=1)
    assert got(hits) == want(points, queries, 7)
    side = math.isqrt(4 * spark.sparkContext.defaultParallelism)
    assert seen.value <= side * len(points) < len(queries) * len(points)


def test_small_chunks_give_the_same(sets, monkeypatch):
    points, queries, frame, asked = sets
    top = S.TopK(S.Queries.read(
        asked.withColumn("cells", F.array(F.lit(0))).withColumn("limit", F.lit(5)).toArrow()))
    monkeypatch.setattr(S, "PAIR_CHUNK", 64)
    monkeypatch.setattr(S, "SCORES_HELD", 100)
    for batch in frame.withColumn("cell", F.lit(0)).toArrow().to_batches(37):
        S._add_batch(top, batch)
    top._keep()
    found = [(int(q), p, round(s, 9) + 0.0) for q, s, p in
             top.found[0][["query", "score", "point_id"]].itertuples(index=False)]
    assert found == [(q, i, s) for q, _, i, s in want(points, queries, 5)]


def test_one_query_is_the_first_of_many(sets):
    points, queries, frame, asked = sets
    for number, vector in queries[:3] + queries[-2:]:
        hits = S.search_vector(frame, vector, 5).withColumn("query_id", F.lit(number))
        assert got(hits) == want(points, [(number, vector)], 5)


def test_fewer_points_than_asked_for_and_none(sets, spark):
    _, _, frame, asked = sets
    few = frame.where("point_id = 'p0004'")
    assert S.top_k_pairs(few, asked, 10).count() == 32
    assert S.top_k_pairs(frame.limit(0), asked, 10).count() == 0
    assert S.top_k_pairs(frame, asked.limit(0), 10).count() == 0
    assert S.top_k_pairs(frame, asked, 0).count() == 0
    assert S.search_vector(frame.limit(0), [1.0] * 4, 10).count() == 0


def test_queries_see_only_their_collection(sets, spark):
    points, queries, frame, asked = sets
    parted = frame.withColumn("collection", F.when(F.col("point_id") < "p0300", "a").otherwise("b"))
    hits = S.top_k_pairs(parted, asked.withColumn("collection", F.lit("a")), 4, ["collection"])
    assert got(hits) == want([p for p in points if p[0] < "p0300"], queries, 4)
    other = S.top_k_pairs(parted, asked.withColumn("collection", F.lit("none")), 4, ["collection"])
    assert other.count() == 0


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "query_block": 5, "point_slice": 100}])
def test_every_query_has_its_own_limit(sets, options):
    points, queries, frame, asked = sets
    limited = asked.withColumn("limit", F.col("query_id") % 4)
    hits = S.top_k_pairs(frame, limited, None, **options)
    assert got(hits) == sorted(
        row for q, v in queries for row in want(points, [(q, v)], q % 4))


def test_wrong_length_is_an_error(sets):
    _, _, frame, _ = sets
    with pytest.raises(Exception, match="differ in length"):
        S.search_vector(frame, [1.0, 2.0], 3).collect()


def test_nearby_with_full_radius_is_exact(sets):
    points, queries, frame, asked = sets
    hits = N.search_nearby(frame, asked, 4, 7, count=3, radius=3)
    assert got(hits) == want(points, queries, 7)
    some = N.search_nearby(frame, asked, 4, 7, count=3, radius=1)
    exact = S.top_k_pairs(frame, asked, 7)
    row = N.recall(some, exact).first()
    assert 0.2 < row.recall <= 1.0 and row.exact_hits == 32 * 7
    assert N.recall(exact, exact).first().recall == 1.0


def test_points_stored_by_cell_are_read_by_cell(sets, spark, tmp_path):
    points, queries, frame, asked = sets
    path = str(tmp_path / "cells")
    N.add_cells(frame, 4, 3).write.partitionBy("cell").parquet(path)
    stored = spark.read.parquet(path)
    hits = N.search_nearby(stored, asked.where("query_id < 2"), 4, 7, count=3, radius=1)
    fresh = N.search_nearby(frame, asked.where("query_id < 2"), 4, 7, count=3, radius=1)
    assert got(hits) == got(fresh)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan


def test_words_are_letters_and_digits(rows):
    """Of a text with one character of every kind between marks."""
    import pyarrow as pa
    import pyarrow.compute as pc
    chars = [chr(c) for c in range(1, 0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    parts = pc.split_pattern_regex(pa.array(chars), pattern=BETWEEN_WORDS).to_pylist()
    for char, part in zip(chars, parts):
        assert (part == [char]) == (unicodedata.category(char)[0] in "LN"), hex(ord(char))


def test_chunks_do_not_change_vectors(rows, monkeypatch):
    import pyarrow as pa

    from pagewell.functions import hashing
    texts = pa.array(["a b a", "", "c-d", "Ä ö 1x"] * 5)
    slots = hashing._Slots(8)
    whole = hashing._vectors(texts, slots)
    monkeypatch.setattr(hashing, "REMEMBERED", 2)
    small = [hashing._vectors(texts.slice(i, 1), hashing._Slots(8)) for i in range(len(texts))]
    assert (whole == [s[0] for s in small]).all()


def test_embedder(rows, spark):
    frame = rows("id long, text string", (0, "Hello, hello world"), (1, ""), (2, None), (3, "!?"),
                 (4, "hello WORLD hello"))
    out = {r.id: r.vector for r in embed_text(frame, "text", hashed_embedder(16)).collect()}
    assert all(len(v) == 16 for v in out.values())
    assert math.isclose(sum(x * x for x in out[0]), 1.0, abs_tol=1e-6)
    assert out[1] == out[2] == out[3] == [0.0] * 16
    assert out[0] == out[4]
    assert vector_size(spark).first().vector_size == 64
    assert vector_size(spark, hashed_embedder(384)).first().vector_size == 384


def test_any_column_function_is_an_embedder(rows):
    def lengths(text):
        return F.array(F.length(text).cast("float"), F.lit(1.0).cast("float"))
    points = embed_text(rows("point_id string, text string", ("a", "x"), ("b", "xxx")), "text", lengths)
    hits = S.search_text(points, "xxxx", 1, lengths)
    assert hits.first().point_id == "b"


def test_long_text_is_embedded_whole(rows):
    frame = rows("id long, text string", (0, "a " * 100_000 + "end"), (1, "a " * 100_000))
    first, second = [r.vector for r in embed_text(frame, "text").orderBy("id").collect()]
    assert first != second


def test_bad_vectors(rows):
    nan, inf = float("nan"), float("inf")
    frame = rows("id long, vector array<float>", (0, [1.0, 2.0]), (1, [1.0]), (2, None),
                 (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0]))
    reasons = {r.id: r.reason for r in check_vectors(frame, 2).collect()}
    assert {i for i, r in reasons.items() if r is None} == {0, 6}
