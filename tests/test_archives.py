"""Archives of pages: round trips, ranges, and what filters leave closed."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pagewell.sources import archives
from pagewell.sources.content import load_content


def pages_of(spark, count=200):
    return spark.range(count).select(
        F.concat(F.lit("https://a.example/"), "id", F.lit("?q=%20&x=/")).alias("source"),
        F.repeat(F.concat(F.lit("<p>é "), "id"), (F.col("id") % 50 + 1).cast("int")).alias("content"))


def same(left, right):
    return not left.exceptAll(right).count() and not right.exceptAll(left).count()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "archives")


def test_what_is_written_is_read(spark, folder):
    pages = pages_of(spark)
    odd = spark.createDataFrame(
        [("", "no name"), ("ends/", ""), ("nul\x00in", "x"), ("ü %2F", "twice"), ("ü %2F", "twice"),
         (None, "lost"), ("none", None), ("long", "wörd " * 500_000)], "source string, content string")
    archives.write_archives(pages.union(odd), folder, 8)
    read = archives.read_archives(spark, folder)
    assert same(read.select("source", "content"), pages.union(odd.dropna()))
    names = [n for n in os.listdir(folder) if n.endswith(".zip")]
    assert len(names) == 8 and not any(n.startswith("_") for n in names)
    assert read.select("archive").distinct().count() == 8


def test_ranges_of_bytes_hold_each_member_once(spark, folder):
    pages = pages_of(spark)
    archives.write_archives(pages, folder, 2)
    read = spark.read.format("page_archives").option("rangebytes", 500).load(folder)
    assert read.rdd.getNumPartitions() > 10
    assert same(read.select("source", "content"), pages)


def test_archives_without_a_wanted_source_stay_closed(spark, folder):
    pages = pages_of(spark)
    archives.write_archives(pages, folder, 16)
    wanted = [r["source"] for r in pages.limit(2).collect()]
    holds = {archives.bucket_of(s, 16) for s in wanted}
    for name in os.listdir(folder):
        if name.endswith(".zip") and int(name.split("-of-")[0][-6:]) not in holds:
            with open(os.path.join(folder, name), "wb") as broken:
                broken.write(b"no archive")
    found = archives.read_archives(spark, folder, wanted)
    assert sorted(r["source"] for r in found.collect()) == sorted(wanted)
    assert found.rdd.getNumPartitions() == len(holds)
    assert archives.read_archives(spark, folder, wanted, "https://b").count() == 0
    assert archives.read_archives(spark, folder, []).count() == 0
    with pytest.raises(Exception, match="zip"):
        archives.read_archives(spark, folder).count()


def test_filters_of_one_query_do_not_reach_another(spark, folder):
    pages = pages_of(spark)
    archives.write_archives(pages, folder, 4)
    read = archives.read_archives(spark, folder)
    for rule in (F.col("source").startswith("https://a.example/1"), F.col("source") > "https://a.example/5",
                 F.col("content").contains("7"), F.col("source").isNull(), F.lit(True)):
        assert same(read.where(rule).select("source", "content"), pages.where(rule))
    source = pages.first()["source"]
    both = read.where(F.col("source") == source).union(read.where(F.col("source") != source))
    assert same(both.select("source", "content"), pages)
    begin = archives.read_archives(spark, folder, beginning="https://a.example/1")
    assert same(begin.select("source", "content"), pages.where("source like 'https://a.example/1%'"))


def test_append_overwrite_and_empty(spark, folder):
    pages = pages_of(spark, 20)
    assert archives.read_archives(spark, folder).count() == 0
    archives.write_archives(pages.limit(0), folder, 2)
    assert archives.read_archives(spark, folder).count() == 0
    archives.write_archives(pages, folder, 2)
    archives.write_archives(pages, folder, 2)
    assert archives.read_archives(spark, folder).count() == 40
    archives.write_archives(pages, folder, 3, "overwrite")
    assert same(archives.read_archives(spark, folder).select("source", "content"), pages)


def test_a_failed_write_is_not_seen(spark, folder):
    pages = pages_of(spark, 20)
    archives.write_archives(pages, folder, 2)
    broken = pages.withColumn("content", F.when(F.col("source").contains("/7?"), F.raise_error(F.lit("bad page")))
                              .otherwise(F.col("content")))
    with pytest.raises(Exception, match="bad page"):
        archives.write_archives(broken, folder, 2, "overwrite")
    assert same(archives.read_archives(spark, folder).select("source", "content"), pages)


def test_archives_of_other_origin(spark, folder):
    os.makedirs(folder)
    with zipfile.ZipFile(os.path.join(folder, "other.zip"), "w") as packed:
        packed.writestr("dir/", "")
        packed.writestr("dir/a%20b.html", "plain")
        packed.writestr("bad.html", b"\xff\xfe")
    with open(os.path.join(folder, "notes.txt"), "w") as other:
        other.write("not an archive")
    read = archives.read_archives(spark, folder)
    assert {(r["source"], r["content"]) for r in read.collect()} == {
        ("dir/a%20b.html", "plain"), ("bad.html", "��")}
    assert read.where("source = 'bad.html'").count() == 1


def test_content_of_listed_sources(spark, folder):
    pages = pages_of(spark, 50)
    archives.write_archives(pages, folder, 4)
    sources = spark.createDataFrame([(0, "https://a.example/3?q=%20&x=/"), (1, "missing")], "ordinal long, source string")
    got = {r["source"]: r["reason"] for r in load_content(sources, archives.read_archives(spark, folder)).collect()}
    assert got == {"https://a.example/3?q=%20&x=/": None, "missing": "not_fetched"}
