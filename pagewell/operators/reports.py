"""Reports of ingest runs that can be added up.

A report has one row per stage and reason: how many sources, a sketch of the distinct ones
and one of the frequent domains. Reports of runs or micro-batches are merged without the
sources, and the result is that of one run over all of them (the frequent domains within
the error of their sketch, exact up to three quarters of DOMAINS).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.functions.urls import url_domain
from pagewell.sources.listing import source_outcomes

#: Domains that a sketch keeps apart, some 30 bytes each, and the bits of the distinct counts.
DOMAINS = 4096
DISTINCT_BITS = 14


def report_sketches(sources: DataFrame, rejects: DataFrame) -> DataFrame:
    """The report of one run: `stage, reason, sources, distinct_sketch, domain_sketch`.

    A source counts once, under its ordinal. Null sources count, but are neither distinct
    ones nor have a domain.
    """
    told = source_outcomes(sources, rejects).withColumn(
        "_domain", F.coalesce(url_domain(F.col("source")), F.lit("")))
    return told.groupBy("stage", "reason").agg(
        F.count(F.lit(1)).alias("sources"),
        F.hll_sketch_agg("source", DISTINCT_BITS).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate(CASE WHEN _domain <> '' THEN _domain END, {DOMAINS})")
        .alias("domain_sketch"))


def merge_reports(reports: DataFrame) -> DataFrame:
    """One report of many, of the same columns."""
    return reports.groupBy("stage", "reason").agg(
        F.sum("sources").alias("sources"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr(f"approx_top_k_combine(domain_sketch, {DOMAINS})").alias("domain_sketch"))


def read_report(reports: DataFrame, top: int = 10) -> DataFrame:
    """`stage, reason, sources, distinct_sources, top_domains` of any reports, merged.

    `top_domains` are `item, count`, the most frequent first.
    """
    # The sketch counts null, which is no domain, as one more item.
    told = F.expr(f"approx_top_k_estimate(domain_sketch, {int(top) + 1})")
    return merge_reports(reports).select(
        "stage", "reason", "sources", F.hll_sketch_estimate("distinct_sketch").alias("distinct_sources"),
        F.slice(F.filter(told, lambda t: t["item"].isNotNull()), 1, int(top)).alias("top_domains"))
