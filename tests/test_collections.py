import json

import pytest
from pyspark.sql import functions as F

from pagewell.operators import collections as C
from pagewell.operators import points as P
from pagewell.operators import requests as R
from pagewell.operators.ordering import number_by_ordinal
from pagewell.plans.answers import answer_searches
from pagewell.plans.ingest import ingest, ingest_points
from pagewell.plans.registry import PARSERS
from pagewell.plans.store import CollectionStore
from pagewell.streaming.ingest import ingest_stream, stream_pages

LOG = "collection string, point_id string, batch_id long, ordinal long, part long, text string"
CATALOG = "name string, vector_size int, distance string, batch_id long, deleted boolean"


@pytest.fixture
def store(spark, tmp_path):
    return CollectionStore(spark, str(tmp_path / "store"))


@pytest.fixture
def texts(rows):
    def make(*values):
        return rows("ordinal long, text string, metadata map<string,string>",
                    *[(i, t, m) for i, (t, m) in enumerate(values)])
    return make


def html(n):
    return f"<title>t{n}</title><main>text {n}</main>"


def pages_of(rows, *sources):
    return rows("ordinal long, source string, content string",
                *[(i, s, html(i)) for i, s in enumerate(sources)])


def test_batches_of_two(rows):
    plan = P.batch_plan(pages_of(rows, *(f"https://example.com/{i}" for i in range(5))), 2)
    assert [r.batch for r in plan.orderBy("ordinal").collect()] == [0, 0, 1, 1, 2]


def test_numbers_are_dense_whatever_the_gaps(rows):
    values = [-(1 << 62), -5, 0, 1, (1 << 20) - 1, 1 << 20, 1 << 41, (1 << 62) + 1, (1 << 62) + 2]
    got = number_by_ordinal(rows("ordinal long", *[(v,) for v in reversed(values)]), "n")
    assert [tuple(r) for r in got.orderBy("n").collect()] == [(v, i) for i, v in enumerate(values)]


def test_live_points_and_deletion(rows):
    log = rows(LOG, ("c", "x", 0, 0, 0, "old"), ("c", "x", 0, 1, 0, "later"), ("c", "y", 0, 2, 0, "y"),
               ("c", "x", 1, 0, 0, "new"), ("d", "x", 1, 0, 0, "gone"), ("d", "z", 3, 0, 0, "back"),
               ("lost", "x", 0, 0, 0, "no catalog"))
    catalog = rows(CATALOG, ("c", 4, "cosine", 0, False), ("c", 5, "cosine", 1, False),
                   ("d", 4, "cosine", 1, False), ("d", None, None, 2, True), ("d", 7, "cosine", 3, False),
                   ("e", 4, "cosine", 0, False), ("f", 4, "cosine", 0, False), ("f", None, None, 4, True))
    live = {(r.collection, r.point_id): r.text for r in C.live_points(log, catalog).collect()}
    assert live == {("c", "x"): "new", ("c", "y"): "y", ("d", "z"): "back"}
    assert [r.name for r in C.list_collections(catalog).collect()] == ["c", "d", "e"]
    info = {r.name: (r.vector_size, r.points_count) for r in
            C.collection_info(catalog, C.live_points(log, catalog)).collect()}
    assert info == {"c": (4, 2), "d": (7, 1), "e": (4, 0)}
    made = C.create_collections(catalog, rows(
        "name string, vector_size int, distance string, batch_id long",
        ("c", 9, "Cosine", 5), ("f", 9, "Cosine", 5), ("f", 8, "Cosine", 6)))
    assert [(r.name, r.vector_size, r.distance, r.batch_id) for r in made.collect()] == [
        ("f", 9, "cosine", 5)]


def test_only_cosine(rows, store):
    with pytest.raises(Exception, match="Unsupported distance: Dot"):
        C.create_collections(rows(CATALOG).limit(0) if False else rows(CATALOG, ("c", 4, "cosine", 0, False)),
                             rows("name string, vector_size int, distance string, batch_id long",
                                  ("x", 9, "Dot", 5))).collect()
    with pytest.raises(ValueError, match="Unsupported distance"):
        store.create("x", 3, "Euclid")


def test_scroll(rows):
    points = rows("point_id string, payload struct<text:string>, vector array<float>",
                  *[(f"{i:02x}00", (str(i),), [1.0]) for i in range(10)])
    page = C.scroll_page(points, 4).orderBy("point_id").collect()
    assert [r.point_id for r in page] == ["0000", "0100", "0200", "0300"]
    assert {r.next_offset for r in page} == {"0400"}
    assert "vector" not in C.scroll_page(points, 4).columns
    last = C.scroll_page(points, 4, "0600").collect()
    assert len(last) == 4 and {r.next_offset for r in last} == {None}
    assert C.scroll_page(points, 4, "0a00").count() == 0
    assert C.scroll_page(points, 0).count() == 0
    with pytest.raises(ValueError):
        C.scroll_page(points, -1)
    pages = C.scroll_all(points, 4).orderBy("page", "row").collect()
    assert [r.point_id for r in pages] == [f"{i:02x}00" for i in range(10)]
    assert [r.next_offset for r in pages] == ["0400"] * 4 + ["0800"] * 4 + [None] * 2
    offset, seen = None, []
    while True:
        got = C.scroll_page(points, 3, offset).orderBy("point_id").collect()
        seen += [r.point_id for r in got]
        offset = got[0].next_offset
        if offset is None:
            break
    assert seen == [r.point_id for r in pages]


def test_scroll_by_keys_reads_live_rows(rows):
    log = rows("point_id string, batch_id long, payload struct<text:string>",
               *[(f"{i:02x}00", b, (f"{i} of {b}",)) for i in range(10) for b in range(1 + i % 2)])
    keys = log.groupBy("point_id").agg(F.max("batch_id").alias("batch_id"))
    page = C.scroll_page(log, 4, "0100", keys).orderBy("point_id").collect()
    assert [r.payload.text for r in page] == ["1 of 1", "2 of 0", "3 of 1", "4 of 0"]
    assert {r.next_offset for r in page} == {"0500"}
    pages = C.scroll_all(log, 4, keys).orderBy("page", "row").collect()
    assert [r.payload.text for r in pages] == [f"{i} of {i % 2}" for i in range(10)]


def test_live_keys_read_no_payload(rows):
    log = rows(LOG, ("c", "x", 0, 0, 0, "old"), ("c", "x", 1, 0, 0, "new"))
    keys = C.live_keys(log, rows(CATALOG, ("c", 4, "cosine", 0, False)))
    assert [tuple(r) for r in keys.collect()] == [("c", "x", 1, 0, 0)]


def test_store_counts_what_was_sent(store, texts):
    many = texts(("hello", {"a": "1"}), ("world", None), ("hello", {"a": "2"}))
    assert store.add_documents("c", many) == 3
    assert store.info("c").first().points_count == 2
    payload = {r.payload.text: r.payload.metadata for r in store.points("c").collect()}
    assert payload == {"hello": {"a": "2"}, "world": {}}
    assert store.add_documents("c", many) == 3
    assert store.count("c") == 2


def test_upsert_replaces_the_whole_payload_and_compaction_keeps_it(store, texts, spark):
    store.add_documents("c", texts(("a", {"x": "1"}), ("b", None)))
    store.add_documents("c", texts(("a", {"y": "2"})))
    store.add_documents("other", texts(("z", None)))
    want = {"a": {"y": "2"}, "b": {}}

    def now():
        return {r.payload.text: r.payload.metadata for r in store.points("c").collect()}
    assert now() == want
    store.compact("c")
    assert now() == want
    plan = store.points("c")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    store.add_documents("c", texts(("c", None)))
    assert set(now()) == {"a", "b", "c"}
    assert [r.name for r in store.list().collect()] == ["c", "other"]


def test_delete_then_write_again(store, texts):
    store.add_documents("c", texts(("a", None), ("b", None)))
    assert store.delete("c") is True
    assert store.delete("never there") is True
    assert store.list().count() == 0
    with pytest.raises(ValueError, match="Unknown collection: c"):
        store.points("c")
    with pytest.raises(ValueError, match="Unknown collection"):
        store.search("c", "a")
    assert store.add_documents("c", texts(("z", None))) == 1
    assert [r.payload.text for r in store.points("c").collect()] == ["z"]


def test_empty_collections(store, texts):
    assert store.add_documents("none", texts(("a", None)).limit(0)) == 0
    assert store.list().count() == 0
    store.create("empty", 64)
    store.create("empty", 32)
    row = store.info("empty").first()
    assert (row.vector_size, row.distance, row.points_count) == (64, "cosine", 0)
    assert store.search("empty", "x").count() == 0
    assert store.scroll("empty").count() == 0
    store.ensure("empty")
    store.ensure("probed")
    assert store.info("probed").first().vector_size == 64


@pytest.mark.parametrize("name", ["007", "1.0", "true", "a b/c=d", "null", "ü", "2024-01-01"])
def test_names_are_kept_as_they_are(store, texts, name):
    store.add_documents(name, texts(("a", None)))
    store.add_documents(name, texts(("b", None)))
    assert [r.name for r in store.list().collect()] == [name]
    assert {r.payload.text for r in store.points(name).collect()} == {"a", "b"}


def test_search_in_the_store(store, texts):
    store.add_documents("c", texts(("red apple", {"n": "1"}), ("green pear", None), ("blue sky", None)))
    hit = store.search("c", "apple", 1).first()
    assert (hit.payload.text, hit.payload.metadata, hit["rank"]) == ("red apple", {"n": "1"}, 1)
    assert store.search("c", "apple", 50).count() == 3
    assert [r["rank"] for r in store.search("c", "apple pear", 3).orderBy("rank").collect()] == [1, 2, 3]


def test_checked_vectors(store, texts):
    store.add_documents("c", texts(("a", None)))
    points = store.points("c").withColumn("vector", F.slice("vector", 1, 3))
    good, bad = store.checked("c", points)
    assert good.count() == 0 and bad.first().reason == "bad_vector"


def test_ingest_twice_is_ingest_once(rows, store):
    pages = pages_of(rows, "https://example.com/a", "https://example.com/b")
    sources = rows("ordinal long, source string", (0, "https://example.com/a"), (1, "https://example.com/b"),
                   (2, "https://example.com/a"), (3, "https://no.invalid/"), (4, "x.pdf"))
    assert ingest(store, sources, pages, timestamp="T") == 3
    assert ingest(store, sources, pages, timestamp="T") == 3
    assert store.count("documents") == 2
    point = store.points("documents").where("payload.source = 'https://example.com/a'").first()
    assert point.payload.asDict() == {
        "source": "https://example.com/a", "title": "t0", "content": "text 0", "text": None,
        "metadata": {"domain": "example.com", "path": "/a"}, "timestamp": "T", "source_type": "html"}


def test_nothing_parsed_makes_no_collection(rows, store):
    pages = pages_of(rows, "https://example.com/a")
    assert ingest(store, rows("ordinal long, source string", (0, "x.pdf")), pages) == 0
    assert store.list().count() == 0


def test_last_content_of_a_source_wins_and_failures_do_not_count(rows, store):
    pages = rows("ordinal long, source string, content string", (0, "s", html(0)), (1, "s", html(1)),
                 (2, "s", None))
    assert ingest(store, pages, timestamp="T") == 2
    assert [r.payload.title for r in store.points("documents").collect()] == ["t1"]
    _, rejects = ingest_points(pages, timestamp="T")
    assert [(r.ordinal, r.reason) for r in rejects.collect()] == [(2, "not_fetched")]


def test_custom_parser_of_many_documents(rows, store):
    def parse(pages, timestamp=None):
        parts = pages.select("*", F.posexplode(F.split("content", ",")).alias("p", "c"))
        return parts.select(
            "ordinal", F.col("p").cast("long").alias("part"), "source", F.lit("").alias("title"),
            F.col("c").alias("content"), F.create_map().cast("map<string,string>").alias("metadata"),
            F.lit(timestamp).alias("timestamp"), F.lit("csv").alias("source_type"), "copies")
    sources = rows("ordinal long, source string, content string", (0, "a.csv", "x,y,z"),
                   (1, "http://e.com", html(1)))
    assert ingest(store, sources, timestamp="T", parsers={**PARSERS, "csv": parse}) == 4
    assert {r.payload.content for r in store.points("documents").collect()} == {"z", "text 1"}


def test_row_parser_in_the_job(rows, store):
    from pagewell.functions.lines import line_documents
    from pagewell.plans import registry
    registry.register_row_parser("txt", line_documents)
    try:
        sources = rows("ordinal long, source string", (0, "a.txt"), (1, "a.txt"), (2, "b.html"))
        pages = rows("source string, content string", ("a.txt", "one\n\ntwo"), ("b.html", html(3)))
        assert ingest(store, sources, pages, timestamp="T") == 5
    finally:
        registry.PARSERS.pop("txt")
    assert {r.payload.content: r.payload.source_type for r in store.points("documents").collect()} == {
        "two": "txt", "text 3": "html"}


def test_stream_replay_changes_nothing(rows, spark, store, tmp_path):
    drop = str(tmp_path / "in")
    pages_of(rows, "https://e.com/0", "https://e.com/1").coalesce(1).write.parquet(drop)

    def run(checkpoint="cp"):
        ingest_stream(store, stream_pages(spark, drop, max_files=1), "pages",
                      str(tmp_path / checkpoint), timestamp="T").awaitTermination()
    run()
    assert store.count("documents") == 2
    pages_of(rows, "https://e.com/1", "https://e.com/2").coalesce(1).write.mode("append").parquet(drop)
    run()
    run()
    state = {r.payload.source: r.payload.title for r in store.points("documents").collect()}
    assert state == {"https://e.com/0": "t0", "https://e.com/1": "t0", "https://e.com/2": "t1"}
    rows_before = store.catalog().count()
    run("lost checkpoint")
    assert store.catalog().count() == rows_before
    assert store.count("documents") == 3


def test_a_write_that_failed_is_invisible_and_is_replaced(rows, store, texts, monkeypatch):
    monkeypatch.setattr(store, "_record", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.add_documents("c", texts(("a", None), ("b", None)))
    monkeypatch.undo()
    assert store.list().count() == 0
    store.add_documents("c", texts(("z", None)))
    assert [r.payload.text for r in store.points("c").collect()] == ["z"]


def test_requests(rows):
    frame = rows(
        "request_id long, tool string, args string",
        (0, "search", '{"collection_name": "c", "query": "q"}'),
        (1, "search", '{"collection_name": "c", "query": "q", "limit": 3}'),
        (2, "search", '{"query": "x"}'),
        (3, "search", '{"collection_name": "c", "query": "q", "limit": "many"}'),
        (4, "search", '{"collection_name": "c", "query": "q", "limit": -1}'),
        (5, "search", '{"collection_name": "c", "query": "q", "limit": null}'),
        (6, "list_collections", None),
        (7, "list_collections", "{"),
        (8, "unknown", "{}"),
        (9, "get_documents", '{"collection_name": "c", "offset": "ab"}'),
        (10, "add_documents", '{"collection_name": "c", "documents": [{"text": "hello"},'
                              ' {"text": "world", "metadata": {"n": 1, "o": {"p": 2}}}]}'),
        (11, "add_documents", '{"collection_name": "c", "documents": [{"metadata": {}}]}'),
        (12, "add_documents", '{"collection_name": "c", "documents": []}'),
        (13, "delete_collection", '{"collection_name": "c"}'),
        (14, "search", "[1]"),
        (15, None, "{}"),
    )
    got = {r.request_id: r for r in R.decode_requests(frame).collect()}
    assert {i for i, r in got.items() if r.reason == "bad_request"} == {2, 3, 4, 7, 8, 11, 14, 15}
    assert [got[i].limit for i in (0, 1, 5, 9)] == [10, 3, 10, 10]
    assert got[9].offset == "ab" and got[0].offset is None
    allowed = R.decode_requests(frame, ["search", "list_collections"])
    assert {r.request_id for r in allowed.where("reason is null").collect()} == {0, 1, 5, 6}
    documents = R.requested_documents(R.decode_requests(frame)).orderBy("position").collect()
    assert [(d.text, d.metadata) for d in documents] == [
        ("hello", None), ("world", {"n": "1", "o": '{"p":2}'})]


def test_json(rows, store, texts):
    store.add_documents("c", texts(("hello", {"a": "1"})))
    queries = rows("query_id long, query string", (7, "hello"))
    row = R.hits_json(store.search_batch("c", queries, 3)).first()
    hit, = json.loads(row.result)
    assert row.query_id == 7 and set(hit) == {"id", "score", "payload"}
    assert hit["payload"] == {"text": "hello", "metadata": {"a": "1"}}
    page = json.loads(R.page_json(store.scroll("c")).first().result)
    assert page == {"documents": [{"id": hit["id"], "payload": hit["payload"]}], "next_offset": None}
    empty = json.loads(R.page_json(store.scroll("c", 10, "z")).first().result)
    assert empty == {"documents": [], "next_offset": None}
    assert R.stored_json(rows("stored_count long", (2,))).first().result == '{"stored_count":2}'
    assert R.deleted_json(rows("name string", ("c",))).first().result == '{"deleted":true}'


def test_search_requests_of_several_collections(rows):
    texts = rows("collection string, ordinal long, text string", ("a", 0, "red apple"), ("a", 1, "red sky"),
                 ("b", 2, "red apple"), ("b", 3, "green"))
    points = P.points_from_texts(texts).join(texts.select("ordinal", "collection"), "ordinal")
    requests = rows(
        "request_id long, tool string, args string",
        (1, "search", '{"collection_name": "a", "query": "red apple", "limit": 1}'),
        (2, "search", '{"collection_name": "b", "query": "red apple", "limit": 2}'),
        (3, "search", '{"collection_name": "none", "query": "red"}'),
        (4, "search", '{"query": "red"}'),
        (5, "search", '{"collection_name": "a", "query": "sky", "limit": 0}'))
    got = {r.request_id: [h["payload"]["text"] for h in json.loads(r.result)]
           for r in answer_searches(points, requests).collect()}
    assert got == {1: ["red apple"], 2: ["red apple", "green"], 3: [], 5: []}


def test_store_search_is_the_same_at_every_limit(spark, rows, tmp_path):
    store = CollectionStore(spark, str(tmp_path / "store"))
    store.add_documents("notes", rows("ordinal long, text string", *((k, f"bread number {k}") for k in range(30))))
    hits = {n: store.search("notes", "bread number 7", limit=n) for n in (10, 11, 20)}
    assert {tuple(h.columns) for h in hits.values()} == {("point_id", "payload", "score", "rank")}
    found = {n: [r.point_id for r in h.collect()] for n, h in hits.items()}
    assert found[20][:11] == found[11] and found[11][:10] == found[10]


def test_bad_vectors_are_not_written(spark, rows, tmp_path):
    from pagewell.operators.points import points_from_texts
    store = CollectionStore(spark, str(tmp_path / "store"))
    store.add_documents("notes", rows("ordinal long, text string", (0, "rye bread")))
    points = points_from_texts(rows("ordinal long, text string", (1, "wheat"), (2, "oats")), store.embedder)
    short = points.withColumn("vector", F.when(F.col("ordinal") == 1, F.slice("vector", 1, 2)).otherwise(F.col("vector")))
    assert store.upsert("notes", short) == 1
    assert store.count("notes") == 2 and store.search("notes", "wheat").count() == 2
    assert [(r.ordinal, r.reason) for r in spark.read.parquet(store.rejects_path).collect()] == [(1, "bad_vector")]
