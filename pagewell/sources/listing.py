"""Source lists: reading, typing, routing, reporting."""

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell import schemas
from pagewell.functions.text import strip
from pagewell.functions.urls import detect_source_type
from pagewell.operators.ordering import number_rows


def read_source_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of source files with the columns that put them in order.

    A file may be split between tasks. Within a split the generated id grows line
    by line, so file, split and id together give the order of the lines.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("source"))


def list_sources(arguments: DataFrame | None, lines: DataFrame | None) -> DataFrame:
    """Arguments as they are, then file lines trimmed and without blank ones.

    `arguments` has `ordinal, source`; `lines` has `file, block, line, source`.
    Duplicates and order are kept; `ordinal` numbers the result from 0.
    """
    parts = []
    if arguments is not None:
        parts.append(arguments.select(
            F.lit(0).alias("door"), F.lit("").alias("file"),
            F.shiftright(F.col("ordinal"), 20).alias("block"),
            F.col("ordinal").cast("long").alias("line"), "source"))
    if lines is not None:
        parts.append(lines.select(
            F.lit(1).alias("door"), "file", F.col("block").cast("long").alias("block"),
            F.col("line").cast("long").alias("line"), strip(F.col("source")).alias("source"),
        ).where(F.col("source") != ""))
    if not parts:
        raise ValueError("Neither arguments nor lines given")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    numbered = number_rows(
        rows, "ordinal", [F.struct("door", "file"), F.col("block")], [F.col("line")])
    return numbered.select("ordinal", "source")


def source_list(
    spark: SparkSession, arguments: Sequence[str] = (), paths: str | Sequence[str] = (),
) -> DataFrame:
    """The sources of a command line: its arguments, then the lines of its files."""
    given = spark.createDataFrame(list(enumerate(arguments)), schemas.SOURCE)
    return list_sources(given, read_source_lines(spark, paths) if paths else None)


def with_source_type(sources: DataFrame, source_type: str | None = None) -> DataFrame:
    """Adds `source_type`: the given one for all sources, else detected."""
    typed = F.lit(source_type) if source_type else detect_source_type(F.col("source"))
    return sources.withColumn("source_type", typed)


def route_sources(
    sources: DataFrame, registered: Collection[str], source_type: str | None = None,
) -> DataFrame:
    """Adds `source_type` and `reason`, which is null where a parser is registered."""
    typed = with_source_type(sources, source_type)
    known = F.col("source_type").isin(*registered) if registered else F.lit(False)
    return typed.withColumn("reason", F.when(~known, F.lit("no_parser")))


def accepted(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("reason").isNull()).drop("reason")


def rejected(routed: DataFrame, detail: str | None = None) -> DataFrame:
    """Rows with a reason, in the shape of rejects."""
    note = F.col(detail) if detail else F.lit(None)
    return routed.where(F.col("reason").isNotNull()).select(
        "ordinal", "source", "source_type", "reason", note.cast("string").alias("detail"))


#: Where in the job a source is given up, by reason; others are at the store.
STAGES = {"no_parser": "route", "not_fetched": "load", "parse_error": "parse", "parsed": "done"}


def source_outcomes(sources: DataFrame, rejects: DataFrame) -> DataFrame:
    """`ordinal, source` with its `reason`, `parsed` where there is no reject, and `stage`."""
    reasons = rejects.groupBy("ordinal").agg(F.min("reason").alias("reason"))
    stages = F.create_map(*(F.lit(x) for pair in STAGES.items() for x in pair))
    return (
        sources.select("ordinal", "source").join(reasons, "ordinal", "left")
        .withColumn("reason", F.coalesce(F.col("reason"), F.lit("parsed")))
        .withColumn("stage", F.coalesce(stages[F.col("reason")], F.lit("store"))))


def ingest_report(sources: DataFrame, rejects: DataFrame) -> DataFrame:
    """Number of sources per outcome: each reject reason with its `stage`, and `parsed` for
    the rest. A source counts once, under its ordinal.
    """
    return source_outcomes(sources, rejects).groupBy("reason", "stage").agg(
        F.count(F.lit(1)).alias("sources"))
