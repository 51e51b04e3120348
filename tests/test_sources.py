import pytest
from pyspark.sql import functions as F

from pagewell.functions import urls
from pagewell.plans.ingest import parse_sources
from pagewell.sources.content import latest_content, load_content, read_binary_files, read_files
from pagewell.sources.listing import (
    ingest_report, list_sources, read_source_lines, rejected, route_sources, source_list)

TYPES = [
    ("mill/plans/1902.PDF", "pdf"),
    ("http://rye.org/a.b/list.html?sort=name&dir=up", "html"),
    ("http://rye.org", "html"),
    ("https://rye.org/grain/dark", "html"),
    ("a.tar.GZ", "gz"),
    (".html", "html"),
    ("file.", "html"),
    ("", "html"),
    ("a/", "html"),
    ("p.HTM", "htm"),
    ("https://x.ai", "ai"),
    ("http://a.com#f", "com#f"),
    ("https://a.com/?u=http://b.com/x.pdf", "pdf"),
]


def test_source_types(rows):
    frame = rows("source string, want string", *TYPES).withColumn(
        "got", urls.detect_source_type(F.col("source")))
    assert [(r.source, r.got) for r in frame.collect()] == TYPES


URLS = [
    ("http://u@h:8080/a/b;c?q#f", "u@h:8080", "/a/b"),
    ("input/doc.html", "", "input/doc.html"),
    ("https://example.com", "example.com", ""),
    ("https://example.com/page#top", "example.com", "/page"),
    ("https://h/a;x/b;y;z", "h", "/a;x/b"),
    ("mailto:a;b", "", "a;b"),
    ("//h/p", "h", "/p"),
    ("1a:b/c", "", "1a:b/c"),
    ("  https://h/p", "h", "/p"),
    ("", "", ""),
]


def test_url_parts(rows):
    frame = rows("source string, d string, p string", *URLS)
    got = frame.select("source", urls.url_domain(F.col("source")), urls.url_path(F.col("source")))
    assert [tuple(r) for r in got.collect()] == URLS


def test_url_parts_like_the_standard_library(rows):
    from urllib.parse import urlparse
    cases = [u for u, _, _ in URLS if not u.startswith(" ")] + [
        "ftp://a/b;c", "HTTP://A/B", "x://", "a:b:c", "http:/a", "http://a?b/c", "?x", "#y",
        "http://a/b/;p", "http://a;b/c", "unknown://a/b;c"]
    frame = rows("source string", *[(c,) for c in cases])
    got = frame.select("source", urls.url_domain(F.col("source")), urls.url_path(F.col("source")))
    for source, domain, path in got.collect():
        assert (domain, path) == (urlparse(source).netloc, urlparse(source).path), source


def test_source_list_of_arguments_and_files(spark, tmp_path):
    file = tmp_path / "sources.txt"
    file.write_text("  https://example.com/1  \n\n \t\nhttps://example.com/2\nhttps://example.com/1\n")
    got = source_list(spark, ["b", "a", "b"], str(file)).orderBy("ordinal").collect()
    assert [tuple(r) for r in got] == list(enumerate(
        ["b", "a", "b", "https://example.com/1", "https://example.com/2", "https://example.com/1"]))
    assert source_list(spark).count() == 0


def test_lines_of_a_file_in_many_splits_keep_their_order(spark, tmp_path):
    file = tmp_path / "many.txt"
    wanted = [f"https://example.com/{i}" for i in range(20_000)]
    file.write_text("\n".join(wanted))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        lines = read_source_lines(spark, str(file))
        assert lines.rdd.getNumPartitions() > 4
        got = [r.source for r in list_sources(None, lines).orderBy("ordinal").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == wanted


def test_given_type_overrides_detection(rows):
    sources = rows("ordinal long, source string", (0, "a.pdf"), (1, "http://a.com"))
    assert [r.reason for r in route_sources(sources, ["html"]).orderBy("ordinal").collect()] == [
        "no_parser", None]
    assert route_sources(sources, ["html"], "html").where("reason is not null").count() == 0
    assert route_sources(sources, ["html"], "").where("reason is not null").count() == 1
    assert rejected(route_sources(sources, ["html"], "pdf")).count() == 2


def test_content_of_a_source_that_is_most_of_the_list(rows, spark):
    sources = spark.range(3000).select(
        F.col("id").alias("ordinal"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("source"))
    pages = rows("source string, content string", ("hot", "<p>x</p>"), ("0", "zero"), ("3", None))
    got = load_content(sources, pages)
    assert got.count() == 3000
    assert got.where("content = '<p>x</p>'").count() == 2000
    assert got.where("source = 'hot' and reason is null").count() == 2000
    assert got.where("reason = 'not_fetched'").count() == 999


def test_latest_content(rows):
    pages = rows("source string, content string, n long", ("a", "1", 1), ("a", "2", 2), ("b", "3", 1))
    assert sorted(map(tuple, latest_content(pages, "n").collect())) == [("a", "2"), ("b", "3")]


def test_files(spark, tmp_path):
    (tmp_path / "a b+c%.html").write_text("<p>one</p>\n<p>two</p>\n")
    got, = read_files(spark, str(tmp_path)).collect()
    assert got.content == "<p>one</p>\n<p>two</p>\n"
    assert got.source == str(tmp_path / "a b+c%.html")
    got, = read_binary_files(spark, str(tmp_path), str(tmp_path) + "/").collect()
    assert (got.source, got.content) == ("a b+c%.html", b"<p>one</p>\n<p>two</p>\n")


def test_listed_files_are_read(spark, tmp_path):
    (tmp_path / "input").mkdir()
    (tmp_path / "input" / "doc.html").write_text("<title>D</title><p>x")
    pages = read_files(spark, str(tmp_path / "input"), str(tmp_path) + "/")
    documents, rejects = parse_sources(
        source_list(spark, ["input/doc.html", "input/none.html"]), pages, timestamp="T")
    document, = documents.collect()
    assert (document.title, document.content) == ("D", "D\nx")
    assert document.metadata == {"domain": "", "path": "input/doc.html"}
    assert [r.source for r in rejects.collect()] == ["input/none.html"]


def test_report(rows):
    sources = rows("ordinal long, source string", (0, "http://a.com/x"), (1, "/tmp/t.unsupported"),
                   (2, "http://missing.invalid/"), (3, "http://a.com/x"))
    pages = rows("source string, content string", ("http://a.com/x", "<p>x</p>"))
    documents, rejects = parse_sources(sources, pages, timestamp="T")
    assert documents.count() == 2
    got = {r.reason: r.sources for r in ingest_report(sources, rejects).collect()}
    assert got == {"parsed": 2, "no_parser": 1, "not_fetched": 1}


def test_nothing_to_list(spark):
    with pytest.raises(ValueError):
        list_sources(None, None)


def test_report_counts_repeated_failures(rows):
    from pagewell.plans.ingest import ingest_points
    sources = rows("ordinal long, source string", (0, "http://a/"), (1, "/t.unsupported"), (2, "/t.unsupported"),
                   (3, "http://gone/"), (4, "http://gone/"))
    pages = rows("source string, content string", ("http://a/", "<p>x</p>"))
    _, rejects = ingest_points(sources, pages, timestamp="2025-01-01T00:00:00Z")
    assert {r.reason: r.sources for r in ingest_report(sources, rejects).collect()} == {
        "parsed": 1, "no_parser": 2, "not_fetched": 2}
