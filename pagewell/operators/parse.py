"""Parsing of pages into documents."""

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime, timezone
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewell import schemas
from pagewell.functions import markup, urls, walker
from pagewell.functions.text import strip
from pagewell.plans.staging import written

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def utc_timestamp(when: datetime | str | Column | None = None) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ` of a moment; of now when none is given."""
    if when is None:
        when = datetime.now(timezone.utc)
    if isinstance(when, datetime):
        return F.lit(when.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    if isinstance(when, str):
        return F.lit(when)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), when.cast("timestamp_ntz"))
    return F.date_format(utc, TIMESTAMP_FORMAT)


def parse_pages(
    pages: DataFrame,
    timestamp: datetime | str | Column | None = None,
    exclude_elements: Sequence[str] | None = None,
) -> DataFrame:
    """One document per page that has content; other columns of `pages` are kept.

    Plain markup is read by expressions in the JVM. Only pages that are not plain
    are handed to Python, where null stands for all others.
    """
    extra = [c for c in pages.columns if c not in (*schemas.PARSED.fieldNames(), "content")]
    content, plain = F.col("content"), F.col("_plain")
    marks = ("_title", "_heading", "_text")

    def decoded(name: str) -> Column:
        # Most texts hold no entity at all.
        return F.when(F.contains(F.col(name), F.lit("&")), markup.decode(F.col(name))) \
            .otherwise(F.col(name)).alias(name)

    # Each step is a projection of its own, so that nothing is computed twice.
    kept = ["ordinal", "source", *extra]
    cut = (
        pages.where(content.isNotNull())
        .withColumn("_open", markup.strip_opaque(content))
        .withColumn("_bare", markup.bare_tags(F.col("_open")))
        .withColumn("_plain", markup.is_plain(
            content, F.col("_open"), F.col("_bare"), exclude_elements))
        .withColumn("_html", F.when(
            plain, markup.strip_named(F.col("_open"), exclude_elements)))
        .select(
            *kept, "_plain", F.when(~plain, content).alias("_hard"),
            markup.raw_title(F.col("_html")).alias("_title"),
            markup.mark_tags(markup.raw_heading(F.col("_html"))).alias("_heading"),
            markup.mark_tags(
                markup.main_region(F.col("_html"), F.col("_bare"))).alias("_text"),
            markup.meta_tags(F.col("_html")).alias("_tags")))
    native = (
        cut.select(*kept, "_plain", "_hard", "_tags", *(decoded(n) for n in marks))
        .select(
            *kept, "_plain", "_hard",
            F.when(F.col("_title") != "", strip(F.col("_title")))
            .otherwise(markup.join_nodes(F.col("_heading"), "")).alias("_title"),
            markup.join_nodes(F.col("_text"), "\n").alias("_text"),
            *(markup.meta_content(F.col("_tags"), a, v).alias(f"_{key}")
              for key, a, v in markup.META_KEYS)))
    read = native.withColumn(
        "_walked", walker.walked_page(F.col("_hard"), exclude_elements))

    def pick(name: str, key: str) -> Column:
        return F.when(plain, F.col(name)).otherwise(F.col("_walked")[key]).alias(key)

    meta = F.struct(*(pick(f"_{key}", key) for key, _, _ in markup.META_KEYS))
    return read.withColumn("_meta", meta).select(
        "ordinal",
        F.lit(0).cast("long").alias("part"),
        "source",
        pick("_title", "title"),
        pick("_text", "content"),
        markup.metadata_map(
            urls.url_domain(F.col("source")), urls.url_path(F.col("source")), F.col("_meta")
        ).alias("metadata"),
        utc_timestamp(timestamp).alias("timestamp"),
        F.lit("html").alias("source_type"),
        *extra,
    )


# What a user's parser takes and gives at once: pages, documents, and characters of these.
PAGES_HELD, ROWS_HELD, CHARACTERS_HELD = 100, 2_000, 4 << 20

Document = dict
RowParser = Callable[[str, str], "Iterable[Document] | Document | None"]


def parse_rows(
    pages: DataFrame, parser: RowParser, source_type: str,
    timestamp: datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents and rejects of a user's `parser(content, source)`.

    The parser returns any number of documents, each a dict with `content` and
    optionally `title` and `metadata`. An error drops its own source only; it is
    reported as `parse_error`. The parser runs once per page, at this call: what it gives is
    written, and documents and rejects are read from that.
    """
    fields = schemas.PARSED.fieldNames()
    extra = [f for f in pages.schema.fields if f.name not in (*fields, "content")]
    output = T.StructType([
        *schemas.PARSED.fields, *extra, T.StructField("error", T.StringType())])
    names = [f.name for f in extra]

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
        for batch in batches:
            parts = (batch.iloc[k:k + PAGES_HELD] for k in range(0, len(batch), PAGES_HELD))
            for page in chain.from_iterable(part.to_dict("records") for part in parts):
                kept = [page[n] for n in names]
                source, ordinal = page["source"], page["ordinal"]
                try:
                    found = parser(page["content"], source)
                    found = [found] if isinstance(found, dict) else list(found or ())
                    made = [
                        (ordinal, part, doc.get("source", source), doc.get("title", ""),
                         doc["content"],
                         {k: str(v) for k, v in (doc.get("metadata") or {}).items()},
                         None, source_type, *kept, None)
                        for part, doc in enumerate(found)]
                except Exception as error:  # one source must not stop the others
                    made = [(ordinal, None, source, None, None, None, None, source_type,
                             *kept, f"{type(error).__name__}: {error}")]
                yield made

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Given out in small parts, as documents in Python take many times their text.
        held, size = [], 0
        for made in parsed(batches):
            for row in made:
                held.append(row)
                size += len(row[4] or "")
                if len(held) >= ROWS_HELD or size >= CHARACTERS_HELD:
                    yield pd.DataFrame(held, columns=output.fieldNames(), dtype=object)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=output.fieldNames(), dtype=object)

    ran = written(pages.where(F.col("content").isNotNull()).mapInPandas(run, output))
    documents = ran.where(F.col("error").isNull()).drop("error").withColumn(
        "timestamp", utc_timestamp(timestamp))
    rejects = ran.where(F.col("error").isNotNull()).select(
        "ordinal", "source", "source_type",
        F.lit("parse_error").alias("reason"), F.col("error").alias("detail"))
    return documents, rejects
