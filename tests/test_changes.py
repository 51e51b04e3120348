"""Streams of changed pages, and reports of runs added up."""

import pytest
from pyspark.sql import functions as F

from pagewell.operators.reports import merge_reports, read_report, report_sketches
from pagewell.plans.store import CollectionStore
from pagewell.streaming.changes import STATE_STORE, page_changes
from pagewell.streaming.ingest import ingest_stream, stream_pages

PAGE = "ordinal long, source string, content string"


def page(n):
    return f"<title>t{n}</title><main>text {n}</main>"


@pytest.fixture
def state_store(spark):
    settings = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE, "spark.sql.shuffle.partitions": "2"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_kinds_of_change(rows, spark, tmp_path, state_store):
    drops = [
        [(0, "a", "1"), (1, "b", "1"), (2, "b", "2"), (3, None, "x"), (None, "n", None), (4, "", "")],
        [(5, "a", "1"), (6, "b", "3"), (0, "n", "1"), (9, "c", "1"), (9, "c", "2")],
        [(4, "a", "2"), (6, "b", "3"), (7, "b", "1"), (9, "c", "2"), (9, "c", "1"), (8, "n", None)],
        [(0, "c", "1"), (9, "b", "1"), (10, "b", "1")],
    ]
    want = [
        {("a", 0, "1", "insert"), ("b", 2, "2", "insert"), ("n", -1, None, "insert"), ("", 4, "", "insert")},
        {("a", 5, "1", "unchanged"), ("b", 6, "3", "update"), ("n", 0, "1", "update"), ("c", 9, "2", None)},
        {("a", 4, "2", "late"), ("b", 7, "1", "update"), ("c", 9, "2", None), ("n", 8, None, "update")},
        {("c", 0, "1", "late"), ("b", 10, "1", "unchanged")},
    ]
    # Of equal ordinals the greater digest stays: that of "1" or of "2".
    import hashlib
    tie = max("12", key=lambda c: hashlib.sha256(c.encode()).hexdigest())
    want[1] = {(*w[:2], tie, "insert") if w[3] is None else w for w in want[1]}
    want[2] = {(*w[:2], tie, "unchanged") if w[3] is None else w for w in want[2]}
    want[3] = {(*w[:3], "unchanged" if w[0] == "c" and tie == "1" else w[3]) for w in want[3]}
    got = []
    for number, drop in enumerate(drops):
        rows(PAGE, *drop).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        found = set()

        def take(batch, _):
            found.update((r.source, r.ordinal, r.content, r.change) for r in batch.collect())

        page_changes(stream_pages(spark, str(tmp_path / "in"))).writeStream.foreachBatch(take).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        got.append(found)
    assert got == want


def test_replayed_files_write_no_batch_and_report_once(rows, spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path / "store"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def run(*pages):
        rows(PAGE, *pages).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest_stream(store, stream_pages(spark, str(tmp_path / "in")), "pages", str(tmp_path / "cp"),
                      timestamp="T", rejects_path=str(tmp_path / "rejects"),
                      report_path=str(tmp_path / "report"), changes_only=True).awaitTermination()

    a, b, c = "https://e.com/0", "https://e.com/1", "https://f.com/x.pdf"
    run((0, a, page(0)), (1, b, page(1)), (2, c, "x"))
    run((0, a, page(0)), (1, b, page(1)), (2, c, "x"))
    assert store.catalog().count() == 1
    run((3, a, page(0)), (4, b, page(2)))
    assert {(r.payload.source, r.payload.title, r.batch_id) for r in store.points("documents").collect()} == {
        (a, "t0", 0), (b, "t2", 1)}
    assert spark.read.parquet(str(tmp_path / "rejects")).select("source").collect() == [(c,)]
    told = {r.reason: r for r in read_report(spark.read.parquet(str(tmp_path / "report"))).collect()}
    assert told["parsed"].sources == 3 and told["parsed"].distinct_sources == 2
    assert told["no_parser"].stage == "route" and told["no_parser"].sources == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_reports_of_two_runs_are_the_report_of_both(rows):
    sources = [(i, f"https://d{i % 40 if i % 3 else 0}.com/{i % 700}") for i in range(2000)] + [
        (2000, None), (2001, ""), (2002, "no url")]
    failed = [(i, s, "html", "no_parser" if i % 2 else "parse_error", None) for i, s in sources if i % 5 == 0]
    shape = "ordinal long, source string, source_type string, reason string, detail string"
    table, rejects = rows("ordinal long, source string", *sources), rows(shape, *failed)
    early = F.col("ordinal") < 900
    parts = [report_sketches(table.where(c), rejects.where(c)) for c in (early, ~early)]
    both = parts[0].unionByName(parts[1])
    whole = read_report(report_sketches(table, rejects), 3).collect()

    def told(report):
        return {(r.stage, r.reason, r.sources, r.distinct_sources,
                 r.top_domains[0]["item"], r.top_domains[0]["count"]) for r in report}

    assert told(whole) == told(read_report(both, 3).collect())
    assert told(whole) == told(read_report(merge_reports(both).unionByName(both.where("false")), 3).collect())
    reasons = {i: reason for i, _, _, reason, _ in failed}
    for row in whole:
        mine = [s for i, s in sources if reasons.get(i, "parsed") == row.reason]
        assert row.sources == len(mine)
        assert abs(row.distinct_sources - len(set(mine) - {None})) <= 0.02 * len(mine) + 1
        assert row.top_domains[0]["item"] == "d0.com"
        assert row.top_domains[0]["count"] == sum((s or "").startswith("https://d0.com") for s in mine)


def test_report_of_nothing(rows):
    none = rows("ordinal long, source string").where("false")
    rejects = rows("ordinal long, source string, source_type string, reason string, detail string").where("false")
    assert read_report(report_sketches(none, rejects)).count() == 0
    # Without any domain the sketch is empty.
    only = read_report(report_sketches(rows("ordinal long, source string", (0, None)), rejects)).first()
    assert (only.sources, only.distinct_sources, list(only.top_domains)) == (1, 0, [])
