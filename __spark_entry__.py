"""Queries over the driver's tables, one per operator, and the SQL they must match."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import entry_sql
from pagewell import ship
from pagewell.functions import ids, pages, urls
from pagewell.functions.batches import batched_embedder
from pagewell.functions.hashing import batch_model
from pagewell.functions.lines import line_documents
from pagewell.operators import codes as K
from pagewell.operators import collections as C
from pagewell.operators import nearby as N
from pagewell.operators import points as P
from pagewell.operators import reports
from pagewell.operators import requests as R
from pagewell.operators import search as S
from pagewell.plans import answers as A
from pagewell.operators.embed import check_vectors, embed_text, vector_size
from pagewell.operators.parse import parse_pages, parse_rows
from pagewell.plans.ingest import ingest_points
from pagewell.plans.staging import shared_path
from pagewell.plans.store import CollectionStore
from pagewell.sources.archives import read_archives, write_archives
from pagewell.sources.content import load_content, spread
from pagewell.sources.listing import (
    ingest_report, list_sources, route_sources, source_outcomes, with_source_type)
from pagewell.streaming.ingest import ingest_stream, stream_pages

TIMESTAMP = "2025-01-01T00:00:00Z"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- inputs ------------------------------------------------------------------

def _pages(spark, d) -> DataFrame:
    return spread(_table(spark, d, "pages")).select(
        F.col("page_id").alias("ordinal"), F.col("url").alias("source"),
        F.col("html").alias("content"))


def _page_variants(spark, d) -> DataFrame:
    """All pages as they are; with main, header and meta tags; without title and article."""
    pages = spread(_table(spark, d, "pages"))
    html, url = F.col("html"), F.col("url")

    def swap(text, *pairs):
        for old, new in pairs:
            text = F.replace(text, F.lit(old), new if not isinstance(new, str) else F.lit(new))
        return text

    head = F.concat(
        F.lit('<meta name="description" content="D &amp; '), url,
        F.lit("\"><meta content='k1, k2' name='keywords'>"
              '<meta property="og:title" content=""><meta name="description" content="2nd"></head>'))
    first = pages.select(
        (F.col("page_id") * 3).alias("ordinal"), url.alias("source"), html.alias("content"))
    second = pages.select(
        (F.col("page_id") * 3 + 1).alias("ordinal"),
        F.concat(F.regexp_replace(url, "^(https?://)([^/?#]+)", "$1user@$2:8080"),
                 F.lit(";p=1")).alias("source"),
        swap(html, ("<article>", "<main>"), ("</article>", "</main>"), ("</head>", head),
             ("<body>", "<body><header><h1>Site &quot;head&quot;</h1></header>"),
             ).alias("content"))
    third = pages.select(
        (F.col("page_id") * 3 + 2).alias("ordinal"),
        F.concat(F.lit("input/"), F.replace(url, F.lit("://"), F.lit("_"))).alias("source"),
        swap(F.regexp_replace(html, "<title>[^<]*</title>", "<title></title>"),
             ("<article>", "<section>"), ("</article>", "</section>"),
             ("</head>", F.concat(F.lit('<meta property="og:title" content="OG '),
                                  F.col("page_id").cast("string"), F.lit('"></head>'))),
             ("<div class=\"ad\">", "<aside class=x>"), ("</div>", "</aside>"),
             ).alias("content"))
    return first.unionByName(second).unionByName(third)


def _lines(spark, d) -> DataFrame:
    return spread(_table(spark, d, "documents")).select(
        F.col("source").alias("file"), F.col("doc_id").alias("block"),
        F.posexplode(F.split("text", "\n")).alias("line", "source"))


def _sources(spark, d) -> DataFrame:
    return list_sources(_pages(spark, d).select("ordinal", "source"), _lines(spark, d))


def _mixed_sources(spark, d) -> DataFrame:
    """Page URLs, the same with a file name, and sources nobody has pages for."""
    pages = _table(spark, d, "pages")
    documents = _table(spark, d, "documents")
    return pages.select(
        (F.col("page_id") * 3).alias("ordinal"), F.col("url").alias("source")
    ).unionByName(pages.select(
        (F.col("page_id") * 3 + 1).alias("ordinal"),
        F.concat("url", F.lit("/paper.PDF")).alias("source"))
    ).unionByName(documents.select(
        (F.col("doc_id") * 3 + 2).alias("ordinal"), "source"))


def _texts(spark, d, spread_out: bool = False) -> DataFrame:
    documents = _table(spark, d, "documents")
    return (spread(documents) if spread_out else documents).select(
        F.col("doc_id").alias("ordinal"), "text",
        F.create_map(F.lit("source"), F.col("source")).alias("metadata"),
        F.col("lang").alias("collection"))


def _turns(spark, d) -> DataFrame:
    return _table(spark, d, "conversations").select(
        (F.col("conv_id") * 1048576 + F.col("turn")).alias("ordinal"), "text",
        F.create_map(F.lit("role"), F.col("role")).alias("metadata"),
        F.col("role").alias("collection"))


def _log(spark, d) -> DataFrame:
    """Writes in four batches: documents, conversations, the documents that have labels
    once more, and benchmark texts into the collection that was deleted before."""
    texts = _texts(spark, d)
    labels = _table(spark, d, "labels").select(F.col("doc_id").alias("ordinal"))
    first = _table(spark, d, "documents").agg(F.min("lang"))
    items = _table(spark, d, "benchmark").select(
        F.col("item_id").alias("ordinal"), "text",
        F.lit(None).cast("map<string,string>").alias("metadata"),
        first.scalar().alias("collection"))
    parts = [texts, _turns(spark, d), texts.join(labels, "ordinal", "left_semi"), items]
    log = None
    for part, batch in zip(parts, (0, 1, 2, 4)):
        rows = P.with_text_ids(part).select(
            "collection", "point_id", "ordinal", F.lit(0).cast("long").alias("part"),
            F.lit(1).cast("long").alias("copies"), "text", "metadata",
            F.lit(batch).cast("long").alias("batch_id"))
        log = rows if log is None else log.unionByName(rows)
    return log


def _deletions(spark, d) -> DataFrame:
    return C.delete_collections(_table(spark, d, "documents").agg(
        F.min("lang").alias("name")).withColumn("batch_id", F.lit(3)))


def _definitions(spark, d) -> DataFrame:
    return _table(spark, d, "documents").select(
        F.col("source").alias("name"), F.lit(128).alias("vector_size"),
        F.lit("Cosine").alias("distance"), F.lit(0).alias("batch_id"))


def _catalog(spark, d) -> DataFrame:
    """Every write, the deletion, and a definition per document source."""
    writes = _log(spark, d).select("collection", "batch_id").distinct().select(
        F.col("collection").alias("name"), F.lit(64).alias("vector_size"),
        F.lit("cosine").alias("distance"), "batch_id", F.lit(False).alias("deleted"))
    defined = _definitions(spark, d).distinct().select(
        "name", "vector_size", F.lower("distance").alias("distance"),
        F.col("batch_id").cast("long").alias("batch_id"), F.lit(False).alias("deleted"))
    return writes.unionByName(defined).unionByName(_deletions(spark, d))


def _live_keys(spark, d) -> DataFrame:
    return C.live_keys(_log(spark, d), _catalog(spark, d))


def _log_of(spark, d, name: str) -> tuple[DataFrame, DataFrame]:
    """Written points of a collection, and the keys of the live ones."""
    one = F.col("collection") == name
    keys = _live_keys(spark, d).where(one).drop("collection")
    log = _log(spark, d).where(one)
    return log.select(*keys.columns, F.struct("text", "metadata").alias("payload")), keys


def _text_points(spark, d) -> DataFrame:
    """Embedded documents, each text once."""
    return P.points_from_texts(
        _texts(spark, d, True).drop("collection"), distinct=True)


def _vectors(spark, d) -> DataFrame:
    return _table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("point_id"), F.col("embedding").alias("vector"))


def _vector_queries(spark, d) -> DataFrame:
    return _table(spark, d, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def _text_queries(spark, d) -> DataFrame:
    return _table(spark, d, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _sparse(rows: DataFrame, key: str, vector: str = "vector") -> DataFrame:
    return rows.select(key, F.posexplode(vector).alias("bucket", "_w")).where(
        F.col("_w") != 0).select(
        key, "bucket", F.round(F.col("_w").cast("double"), 6).alias("weight"))


def _vector_text(vector: str = "vector"):
    """A vector as text: `bucket:millionths` of what is not zero, in order."""
    parts = F.transform(vector, lambda w, i: F.when(w != 0, F.concat(
        i.cast("string"), F.lit(":"), F.round(w.cast("double") * 1e6).cast("long").cast("string"))))
    return F.coalesce(F.array_join(parts, " "), F.lit("")).alias("vector")


def _requests(spark, d) -> DataFrame:
    """Good and bad requests made of whole tables."""
    def call(table, number, key, tool, args):
        return _table(spark, d, table).select(
            F.concat(F.lit(f"{table}-{number}-"), F.col(key).cast("string"))
            .alias("request_id"), tool.alias("tool"), args.alias("args"))

    name = F.lit("c").alias("collection_name")
    parts = [
        call("benchmark", 1, "item_id", F.lit("search"), F.to_json(F.struct(
            name, F.col("text").alias("query"), F.col("item_id").alias("limit")))),
        call("benchmark", 2, "item_id", F.lit("search"), F.to_json(F.struct(
            name, F.col("text").alias("query")))),
        call("documents", 1, "doc_id", F.lit("add_documents"), F.to_json(F.struct(
            F.col("lang").alias("collection_name"),
            F.array(F.struct("text", F.struct("source").alias("metadata"))).alias("documents")))),
        call("documents", 2, "doc_id", F.lit("add_documents"), F.to_json(F.struct(
            name, F.array(F.struct("source")).alias("documents")))),
        call("documents", 3, "doc_id", F.lit("search"), F.col("text")),
        call("pages", 1, "page_id", F.lit("get_documents"), F.to_json(F.struct(
            name, F.md5("url").alias("offset"), F.lit("many").alias("limit")))),
        call("pages", 2, "page_id", F.lit("get_documents"), F.to_json(F.struct(
            name, F.md5("url").alias("offset")))),
        call("labels", 1, "doc_id", F.lit("list_collections"), F.lit(None).cast("string")),
        call("labels", 2, "doc_id", F.lit("delete_collection"), F.lit("{}")),
        call("conversations", 1, "conv_id", F.col("role"), F.lit("{}")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# -- queries -----------------------------------------------------------------

def source_list(spark, d):
    return _sources(spark, d)


def detect_source_type(spark, d):
    return with_source_type(_sources(spark, d))


def route(spark, d):
    return route_sources(_mixed_sources(spark, d), ["html"])


def load(spark, d):
    loaded = load_content(_mixed_sources(spark, d), _pages(spark, d))
    return loaded.select(
        "ordinal", "source", F.md5("content").alias("content_md5"), "reason")


def _archived(spark, d) -> str:
    """The table's pages as archives of about 64 MB of pages each."""
    pages = _table(spark, d, "pages").select(F.col("url").alias("source"), F.col("html").alias("content"))
    size = pages.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    path = f"{shared_path(spark)}/archives"
    write_archives(pages, path, buckets=1 + size // (64 << 20))
    return path


def load_archives(spark, d):
    """The content of sources out of archives of the pages."""
    loaded = load_content(_mixed_sources(spark, d), read_archives(spark, _archived(spark, d)))
    return loaded.select(
        "ordinal", "source", F.md5("content").alias("content_md5"), "reason")


def report(spark, d):
    """Outcomes of the job's sources, many of which are listed repeatedly and fail."""
    sources = _mixed_sources(spark, d)
    _, rejects = ingest_points(sources, _pages(spark, d), timestamp=TIMESTAMP)
    return ingest_report(sources, rejects)


def report_merged(spark, d):
    """Outcomes of two runs, of the pages' and of the documents' sources, from their reports;
    the estimate of distinct sources is held against the exact number."""
    sources, pages = _mixed_sources(spark, d), _pages(spark, d)
    of_documents = F.col("ordinal") % 3 == 2
    made = exact = None
    for run in (sources.where(~of_documents), sources.where(of_documents)):
        _, rejects = ingest_points(run, pages, timestamp=TIMESTAMP)
        report, told = reports.report_sketches(run, rejects), source_outcomes(run, rejects)
        made = report if made is None else made.unionByName(report)
        exact = told if exact is None else exact.unionByName(told)
    distinct = exact.groupBy("stage", "reason").agg(F.count_distinct("source").alias("_exact"))
    return reports.read_report(made, 1).join(distinct, ["stage", "reason"]).select(
        "stage", "reason", "sources",
        (F.abs(F.col("distinct_sources") - F.col("_exact")) <= 0.05 * F.col("_exact")).alias("distinct_close"),
        F.col("top_domains")[0]["count"].alias("top_count"))


def strip_elements(spark, d):
    return _page_variants(spark, d).select(
        "ordinal", F.md5(pages.strip_elements(F.col("content"))).alias("stripped_md5"))


def _stripped(spark, d):
    return _page_variants(spark, d).select(
        "ordinal", pages.strip_elements(F.col("content")).alias("html"))


def page_title(spark, d):
    return _stripped(spark, d).select("ordinal", pages.page_title(F.col("html")).alias("title"))


def page_text(spark, d):
    return _stripped(spark, d).select("ordinal", pages.page_text(F.col("html")).alias("content"))


def url_parts(spark, d):
    return _page_variants(spark, d).select(
        "ordinal", "source", urls.url_domain(F.col("source")).alias("domain"),
        urls.url_path(F.col("source")).alias("path"))


def _flat(documents):
    meta = F.col("metadata")
    return documents.select(
        "ordinal", "source", "title", "content", "timestamp", "source_type",
        *(meta[k].alias(k) for k in ("domain", "path", "description", "keywords", "og_title")))


def page_metadata(spark, d):
    return _flat(parse_pages(_page_variants(spark, d), TIMESTAMP)).drop(
        "title", "content", "timestamp", "source_type")


def pages_parsed(spark, d):
    return _flat(parse_pages(_page_variants(spark, d), TIMESTAMP))


def nested_pages_parsed(spark, d):
    """Nested elements, which the expressions leave to the walker."""
    nested = F.replace(
        F.replace(F.col("content"), F.lit("<nav>"), F.lit("<nav><nav>in</nav>")),
        F.lit("<footer>"), F.lit("<footer><footer></p>x</footer>"))
    return _flat(parse_pages(_pages(spark, d).withColumn("content", nested), TIMESTAMP))


def odd_page_parts(spark, d):
    """Title and text of stripped pages with nested elements, an odd attribute, unclosed
    elements and an entity in the place of a comma."""
    odd = F.col("content")
    for old, new in (("<nav>", "<nav><nav>in</nav>"), ("<footer>", "<footer><b title='a>b'><footer></p>x</footer>"),
                     ("</h1>", "</em></h1>"), (", ", "&comma; ")):
        odd = F.replace(odd, F.lit(old), F.lit(new))
    stripped = _pages(spark, d).select("ordinal", pages.strip_elements(odd).alias("html"))
    return stripped.select("ordinal", pages.page_title(F.col("html")).alias("title"),
                           pages.page_text(F.col("html")).alias("content"))


def custom_parser(spark, d):
    pages = spread(_table(spark, d, "documents")).select(
        F.col("doc_id").alias("ordinal"), "source", F.col("text").alias("content"))
    documents, _ = parse_rows(pages, line_documents, "txt", TIMESTAMP)
    return documents.select(
        "ordinal", "part", "source", "title", "content",
        F.col("metadata")["line"].alias("line"), "source_type")


def text_embedded(spark, d):
    rows = spread(_table(spark, d, "documents").select("doc_id", "text"))
    return _sparse(embed_text(rows, "text"), "doc_id")


def text_batched(spark, d):
    """The same by a model that takes batches of texts of at most 64 KB with their padding."""
    rows = spread(_table(spark, d, "documents").select("doc_id", "text"))
    return _sparse(embed_text(rows, "text", batched_embedder(batch_model, 65_536)), "doc_id")


def query_embedded(spark, d):
    return _sparse(S.embed_queries(_text_queries(spark, d)), "query_id", "query_vector")


def vector_sizes(spark, d):
    """The probe's size beside that of every document's vector."""
    documents = embed_text(spread(_table(spark, d, "documents").select("text")), "text")
    return documents.groupBy(F.size("vector").alias("document_size")).agg(
        F.count(F.lit(1)).alias("documents")
    ).withColumn("vector_size", vector_size(spark).scalar())


def vectors_checked(spark, d):
    """Vectors as they are, one value short, and with a value not finite."""
    rows = _table(spark, d, "embeddings").select(F.col("vec_id"), F.col("embedding"))
    variants = rows.select("vec_id", F.explode(F.array(
        F.struct(F.lit(0).alias("variant"), F.col("embedding").alias("vector")),
        F.struct(F.lit(1).alias("variant"), F.slice("embedding", 1, 63).alias("vector")),
        F.struct(F.lit(2).alias("variant"), F.transform(
            "embedding", lambda x: F.when(x > 0.2, F.lit(float("nan")).cast("float"))
            .otherwise(x)).alias("vector")),
        F.struct(F.lit(3).alias("variant"), F.transform(
            "embedding", lambda x: F.when(x < 0.2, x)).alias("vector")),
    )).alias("v")).select("vec_id", "v.variant", "v.vector")
    return check_vectors(variants, 64).select("vec_id", "variant", "reason")


def point_id_source(spark, d):
    return _table(spark, d, "pages").select(
        "page_id", ids.point_id(F.col("url")).alias("point_id"),
        ids.hex_to_uuid(ids.point_id(F.col("url"))).alias("uuid"))


def point_id_text(spark, d):
    return _table(spark, d, "documents").select(
        "doc_id", ids.point_id(F.col("text")).alias("point_id"))


def _page_points(points, *names):
    """Points of pages with their vectors and metadata."""
    metadata = F.col("payload")["metadata"]
    return points.select(
        "point_id", "ordinal", _vector_text(), *(F.col("payload")[n].alias(n) for n in names),
        *(metadata[n].alias(n) for n in ("domain", "path", "description", "keywords")),
        metadata["og_title"].alias("og_title"))


def points_from_pages(spark, d):
    points = P.points_from_documents(parse_pages(_pages(spark, d), TIMESTAMP))
    return _page_points(points, "source", "title", "content", "timestamp", "source_type")


def points_from_texts(spark, d):
    points = P.points_from_texts(_turns(spark, d).drop("collection"))
    return points.select(
        "point_id", "ordinal", _vector_text(), F.col("payload")["text"].alias("text"),
        F.to_json(F.col("payload")["metadata"]).alias("payload"))


def points_distinct(spark, d):
    return _text_points(spark, d).select("point_id", "ordinal", "copies", _vector_text())


def create_collection(spark, d):
    known = C.create_collections(
        _catalog(spark, d).where("false"), _definitions(spark, d).distinct())
    return known.select("name", "vector_size", "distance", "batch_id", "deleted")


def ensure_collection(spark, d):
    """Writes to every collection when only the document languages exist."""
    written = _texts(spark, d).select(F.col("collection").alias("name")).distinct().select(
        "name", F.lit(64).alias("vector_size"), F.lit("cosine").alias("distance"),
        F.lit(0).cast("long").alias("batch_id"), F.lit(False).alias("deleted"))
    catalog = written.unionByName(_deletions(spark, d))
    names = _log(spark, d).select(F.col("collection").alias("name")).distinct()
    return C.ensure_collections(catalog, names.withColumn("batch_id", F.lit(5)), 64)


def batch_plan(spark, d):
    planned = P.batch_plan(_turns(spark, d), 32)
    return planned.select("ordinal", "batch")


def upsert_latest(spark, d):
    return _live_keys(spark, d).select("collection", "point_id", "batch_id", "ordinal")


def stored_count(spark, d):
    return C.stored_count(_log(spark, d), "collection", "batch_id")


def delete_collection(spark, d):
    """Live points when the deletion is the last thing that happened."""
    log = _log(spark, d).where(F.col("batch_id") < 3)
    catalog = _catalog(spark, d).where(F.col("batch_id") <= 3)
    return C.live_keys(log, catalog).groupBy("collection").agg(
        F.count(F.lit(1)).alias("points"))


def list_collections(spark, d):
    return C.list_collections(_catalog(spark, d))


def collection_info(spark, d):
    return C.collection_info(_catalog(spark, d), _live_keys(spark, d))


def scroll_page(spark, d):
    log, keys = _log_of(spark, d, "en")
    page = C.scroll_page(log, 10, "8", keys)
    return page.select("point_id", F.col("payload")["text"].alias("text"), "next_offset")


def scroll_all(spark, d):
    log, keys = _log_of(spark, d, "en")
    return C.scroll_all(log, 10, keys).select(
        "page", "row", "point_id", F.md5(F.col("payload")["text"]).alias("text"), "next_offset")


def count_documents(spark, d):
    return C.count_documents(_live_keys(spark, d))


def search_vector(spark, d):
    probe = [(-1.0) ** i / (1 + i) for i in range(64)]
    return S.search_vector(_vectors(spark, d), probe, 10).select("rank", "point_id", "score")


def search_text(spark, d):
    hits = S.search_text(_text_points(spark, d), entry_sql.QUERY, 10)
    return hits.select("rank", "point_id", F.col("payload")["text"].alias("text"), "score")


def search_batch(spark, d):
    hits = S.search_batch(_text_points(spark, d), _text_queries(spark, d), 10)
    return hits.select(
        "query_id", "rank", "point_id", F.col("payload")["text"].alias("text"), "score")


def search_all_vectors(spark, d):
    """Every vector asks for its ten nearest."""
    return S.top_k_pairs(_vectors(spark, d), _vector_queries(spark, d), 10)


def search_blocks(spark, d):
    """The same by the block join for more queries than are broadcast."""
    return S.top_k_pairs(
        _vectors(spark, d), _vector_queries(spark, d), 10,
        broadcast_bytes=0, query_block=200, point_slice=250)


def search_approx(spark, d):
    return N.search_nearby(_vectors(spark, d), _vector_queries(spark, d), 64, 10)


def search_recall(spark, d):
    vectors, asked = _vectors(spark, d), _vector_queries(spark, d)
    return N.recall(
        N.search_nearby(vectors, asked, 64, 10), S.top_k_pairs(vectors, asked, 10)
    ).withColumn("recall", F.round("recall", 6))


def search_codes(spark, d):
    """Every vector asks for its ten nearest; codes are scanned, candidates scored."""
    vectors = _vectors(spark, d)
    return K.search_codes(K.add_codes(vectors), vectors, _vector_queries(spark, d), 10)


def search_codes_blocks(spark, d):
    """The same by the block join for more queries than are broadcast."""
    vectors = _vectors(spark, d)
    return K.search_codes(K.add_codes(vectors), vectors, _vector_queries(spark, d), 10,
                          broadcast_bytes=0, query_block=200, point_slice=250)


def search_codes_recall(spark, d):
    """What is found of the exact hits, and whether a tenth of all pairs was scored for it."""
    vectors, asked = _vectors(spark, d), _vector_queries(spark, d)
    found = N.recall(search_codes(spark, d), S.top_k_pairs(vectors, asked, 10))
    share = K.cost(K.add_codes(vectors), asked, 10).select((F.col("share") < 0.1).alias("under_a_tenth"))
    return found.withColumn("recall", F.round("recall", 6)).crossJoin(share)  # one row each


def _text_store(spark, d) -> CollectionStore:
    """All document texts in one collection, those with labels written once more."""
    store = CollectionStore(spark, shared_path(spark))
    store.add_documents("texts", _texts(spark, d, True).drop("collection"))
    labels = _table(spark, d, "labels").select(F.col("doc_id").alias("ordinal"))
    store.add_documents("texts", _texts(spark, d, True).drop("collection").join(labels, "ordinal", "left_semi"))
    return store


def store_search(spark, d):
    hits = _text_store(spark, d).search("texts", entry_sql.QUERY, 10)
    return hits.select("rank", "point_id", F.col("payload")["text"].alias("text"), "score")


def store_nearby(spark, d):
    """Every benchmark text asks a collection of two batches through its codes."""
    return _text_store(spark, d).search_nearby("texts", S.embed_queries(_text_queries(spark, d)), 10)


def store_checked(spark, d):
    """Points offered to a collection; those that stand for several documents lack a value."""
    store = CollectionStore(spark, shared_path(spark))
    store.create("texts", 64)
    short = F.when(F.col("copies") > 1, F.slice("vector", 1, 63)).otherwise(F.col("vector"))
    good, bad = store.checked("texts", _text_points(spark, d).withColumn("vector", short))
    return good.select("point_id", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.col("detail").alias("point_id"), "reason"))


def decode_requests(spark, d):
    decoded = R.decode_requests(_requests(spark, d))
    return decoded.select(
        "request_id", "tool", "reason",
        *(F.when(F.col("reason").isNull(), F.col(c)).cast("string").alias(c)
          for c in ("collection_name", "query", "limit", "offset")),
        F.when(F.col("reason").isNull(), F.col("documents")[0]["text"]).alias("document"),
        F.when(F.col("reason").isNull(), F.to_json(F.col("documents")[0]["metadata"]))
        .alias("metadata"))


def requested_documents(spark, d):
    found = R.requested_documents(R.decode_requests(_requests(spark, d), ["add_documents"]))
    return found.select("request_id", "collection", "position", "text")


def answer_searches(spark, d):
    """Every benchmark text asks twice, with its number as limit and with the default."""
    points = _text_points(spark, d).withColumn("collection", F.lit("c"))
    answers = A.answer_searches(points, _requests(spark, d))
    hits = answers.select("request_id", F.explode(F.from_json(
        "result", "array<struct<id:string,score:double>>")).alias("hit"))
    return hits.select("request_id", F.col("hit")["id"].alias("point_id"),
                       F.col("hit")["score"].alias("score"))


def _tool_requests(spark, d) -> DataFrame:
    """Requests of the tools other than search, good and bad, made of whole tables."""
    def call(table, key, tool, args):
        return _table(spark, d, table).select(
            F.concat(F.lit(f"{table}-{tool}-"), F.col(key).cast("string")).alias("request_id"),
            F.lit(tool).alias("tool"), args.alias("args"))

    name, lang = F.lit("en").alias("collection_name"), F.col("lang").alias("collection_name")
    parts = [
        call("labels", "doc_id", "list_collections", F.lit(None).cast("string")),
        call("pages", "page_id", "get_documents", F.to_json(F.struct(
            name, F.md5("url").alias("offset"), F.length(F.regexp_extract("url", "[0-9]+$", 0)).alias("limit")))),
        call("documents", "doc_id", "get_documents", F.to_json(F.struct(lang, F.md5("source").alias("offset")))),
        call("benchmark", "item_id", "get_documents", F.to_json(F.struct(
            F.lit("none such").alias("collection_name"), F.col("text").alias("offset")))),
        call("customer", "c_custkey", "get_documents", F.to_json(F.struct(name, F.lit("x").alias("limit")))),
        call("documents", "doc_id", "add_documents", F.to_json(F.struct(lang, F.transform(
            F.split("text", "\n"), lambda t: F.struct(t.alias("text"))).alias("documents")))),
        call("labels", "doc_id", "add_documents", F.lit('{"collection_name":"en"}')),
        call("documents", "doc_id", "delete_collection", F.to_json(F.struct(lang))),
        call("labels", "doc_id", "delete_collection", F.lit("{}")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def answer_lists(spark, d):
    return A.answer_lists(_catalog(spark, d), _tool_requests(spark, d))


def answer_pages(spark, d):
    """Pages of all documents' collections from every page's and source's digest on."""
    keys = _live_keys(spark, d)
    points = _log(spark, d).select(*keys.columns, F.struct(F.md5("text").alias("text")).alias("payload"))
    return A.answer_pages(points, keys, _tool_requests(spark, d))


def answer_additions(spark, d):
    return A.answer_additions(_tool_requests(spark, d))


def answer_deletions(spark, d):
    return A.answer_deletions(_tool_requests(spark, d))


def render_json(spark, d):
    """The hits of each vector that asks for its three nearest, as JSON."""
    hits = S.top_k_pairs(_vectors(spark, d), _vector_queries(spark, d), 3)
    return R.hits_json(hits.select(
        "query_id", "rank", "point_id", F.round(F.col("score") * 1000).cast("int").alias("score"),
        F.struct(F.lit(None).cast("string").alias("title"),
                 F.concat(F.lit('say "'), "point_id", F.lit('"')).alias("text"))
        .alias("payload")))


def render_page(spark, d):
    log, keys = _log_of(spark, d, "en")
    page = C.scroll_page(log, 10, keys=keys)
    return R.page_json(page.withColumn(
        "payload", F.struct(F.md5(F.col("payload")["text"]).alias("text"))))


def ingest_job(spark, d):
    points, _ = ingest_points(
        _mixed_sources(spark, d), _pages(spark, d), timestamp=TIMESTAMP)
    return _page_points(points, "source", "title", "content")


def ingest_twice(spark, d):
    """The job on all pages, twice, into a store; what is stored afterwards."""
    store = CollectionStore(spark, shared_path(spark))
    sources, pages = _mixed_sources(spark, d), _pages(spark, d)
    for _ in range(2):
        points, _ = ingest_points(sources, pages, timestamp=TIMESTAMP, embedder=store.embedder)
        store.upsert("documents", points, distinct=True)
    return _page_points(store.points("documents"), "source", "title", "content")


def ingest_streamed(spark, d):
    """All pages through the streaming ingest."""
    folder = shared_path(spark)
    _pages(spark, d).write.parquet(f"{folder}/in")
    store = CollectionStore(spark, f"{folder}/store")
    ingest_stream(store, stream_pages(spark, f"{folder}/in"), "pages", f"{folder}/checkpoint",
                  timestamp=TIMESTAMP).awaitTermination()
    return _page_points(store.points("documents"), "source", "title", "content")


def ingest_changes(spark, d):
    """All pages three times through the stream of changes: as they are, a later version with
    new titles on those whose source has a digest below 8, and the first ones again."""
    folder = shared_path(spark)
    store = CollectionStore(spark, f"{folder}/store")
    first = _pages(spark, d).withColumn("ordinal", F.col("ordinal") * 2)
    title = F.when(F.md5("source") < "8", F.lit("<title>New ")).otherwise(F.lit("<title>"))
    second = first.select((F.col("ordinal") + 1).alias("ordinal"), "source",
                          F.replace(F.col("content"), F.lit("<title>"), title).alias("content"))
    for pages in (first, second, first):
        pages.write.mode("append").parquet(f"{folder}/in")
        ingest_stream(store, stream_pages(spark, f"{folder}/in"), "pages", f"{folder}/checkpoint",
                      timestamp=TIMESTAMP, changes_only=True).awaitTermination()
    return store.points("documents").select(
        F.col("payload")["source"].alias("source"), F.col("payload")["title"].alias("title"), "ordinal", "batch_id")


def entry(spark: SparkSession) -> DataFrame:
    """Pages parsed, embedded and searched with every benchmark text."""
    d = "/root/testdata/sf0.001"
    points, _ = ingest_points(
        _pages(spark, d).select("ordinal", "source"), _pages(spark, d), timestamp=TIMESTAMP)
    hits = S.search_batch(points, _text_queries(spark, d), 10)
    return hits.select(
        "query_id", "rank", "point_id", "score", F.col("payload")["title"].alias("title"))


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data subpackage and its pipeline, where they are there."""
    try:
        import corpus_pipeline
        from pagewell.llm import registry
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "pagewell.llm", "pagewell.llm.registry"):
            raise
        return {}, {}
    found = {**registry.QUERIES, "pipeline": corpus_pipeline.run}
    sql = {**registry.SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return found, {name: text for name, text in sql.items() if text}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **_training_data()[0],
        "source_list": source_list,
        "detect_source_type": detect_source_type,
        "route_sources": route,
        "load_content": load,
        "load_archives": load_archives,
        "ingest_report": report,
        "report_merged": report_merged,
        "strip_elements": strip_elements,
        "page_title": page_title,
        "page_text": page_text,
        "odd_page_parts": odd_page_parts,
        "url_parts": url_parts,
        "page_metadata": page_metadata,
        "parse_pages": pages_parsed,
        "parse_nested_pages": nested_pages_parsed,
        "custom_parser": custom_parser,
        "embed_text": text_embedded,
        "embed_batched": text_batched,
        "embed_query": query_embedded,
        "vector_size": vector_sizes,
        "check_vectors": vectors_checked,
        "point_id_source": point_id_source,
        "point_id_text": point_id_text,
        "points_from_pages": points_from_pages,
        "points_from_texts": points_from_texts,
        "points_distinct": points_distinct,
        "ensure_collection": ensure_collection,
        "create_collection": create_collection,
        "batch_plan": batch_plan,
        "upsert_latest": upsert_latest,
        "stored_count": stored_count,
        "delete_collection": delete_collection,
        "list_collections": list_collections,
        "collection_info": collection_info,
        "scroll_page": scroll_page,
        "scroll_all": scroll_all,
        "count_documents": count_documents,
        "search_vector": search_vector,
        "search_text": search_text,
        "search_batch": search_batch,
        "search_all_vectors": search_all_vectors,
        "search_blocks": search_blocks,
        "search_approx": search_approx,
        "search_recall": search_recall,
        "search_codes": search_codes,
        "search_codes_blocks": search_codes_blocks,
        "search_codes_recall": search_codes_recall,
        "store_search": store_search,
        "store_nearby": store_nearby,
        "store_checked": store_checked,
        "decode_requests": decode_requests,
        "requested_documents": requested_documents,
        "answer_searches": answer_searches,
        "answer_lists": answer_lists,
        "answer_pages": answer_pages,
        "answer_additions": answer_additions,
        "answer_deletions": answer_deletions,
        "render_json": render_json,
        "render_page": render_page,
        "ingest_job": ingest_job,
        "ingest_twice": ingest_twice,
        "ingest_stream": ingest_streamed,
        "ingest_changes": ingest_changes,
    }


def oracle_sql() -> dict[str, str]:
    return {**_training_data()[1], **entry_sql.oracle_sql()}
