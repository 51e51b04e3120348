"""Content of sources, from a table or from files."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.operators.joins import join_unique
from pagewell.operators.newest import newest


def latest_content(pages: DataFrame, order: str) -> DataFrame:
    """One row per source of a table that may hold several: the last one in `order`."""
    return newest(pages, ["source"], [order]).select("source", "content")


def load_content(sources: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds `content` and `reason`; `not_fetched` where there is no content.

    `pages` has `source, content`, one row per source. Sources may repeat, and one
    of them may be most of the list.
    """
    joined = join_unique(
        sources, pages.select("source", "content"), ["source"], F.col("ordinal"))
    return joined.withColumn(
        "reason", F.when(F.col("content").isNull(), F.lit("not_fetched")))


def fetched_content(sources: DataFrame, pages: DataFrame, distinct: bool) -> DataFrame:
    """Those sources that have content, with it.

    For `distinct` sources this is a plain inner join, so the smaller side may be
    broadcast: a short list of sources does not shuffle a large table of pages.
    """
    found = pages.where(F.col("content").isNotNull()).select("source", "content")
    if distinct:
        return sources.join(found, "source")
    return join_unique(sources, found, ["source"], F.col("ordinal"), "inner")


def missing_content(sources: DataFrame, pages: DataFrame) -> DataFrame:
    """Those sources that have none, with `reason`; content is read to see that it is there
    and not shuffled."""
    found = pages.where(F.col("content").isNotNull()).select("source")
    return sources.join(found, "source", "left_anti").withColumn(
        "reason", F.lit("not_fetched"))


def _file_source(base: str | None) -> Column:
    """The path of a file as one would write it: local ones without scheme; with `base`,
    what follows it."""
    path = F.col("_metadata.file_path")
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    plain = F.regexp_replace(decoded, "^file:(?://)?(?=/)", "")
    return F.substring_index(plain, base, -1) if base else plain


def read_files(
    spark: SparkSession, paths: str | Sequence[str], base: str | None = None,
) -> DataFrame:
    """Whole text files as `source, content`; the source is the path (after `base`)."""
    return spark.read.text(paths, wholetext=True).select(
        _file_source(base).alias("source"), F.col("value").alias("content"))


def read_binary_files(
    spark: SparkSession, paths: str | Sequence[str], base: str | None = None,
) -> DataFrame:
    """Whole binary files as `source, content`, for parsers of binary formats."""
    return spark.read.format("binaryFile").load(paths).select(
        _file_source(base).alias("source"), "content")


def spread(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows of a scan over at least so many tasks (default: one per core).

    Small tables come in fewer splits than there are cores, which leaves cores idle
    in costly steps that follow. A scan with enough splits is left as it is.
    """
    tasks = tasks or rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks)
