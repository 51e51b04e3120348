"""The SQL (DuckDB) that the queries of the entry must match."""

# The text that `search_text` looks for.
QUERY = "Et laou que la thes und die sichen on the hand"

WS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　")

TIMESTAMP = "2025-01-01T00:00:00Z"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_lit(WS)})"


# -- pages --------------------------------------------------------------------

VARIANTS = r"""
page_variants AS (
  SELECT page_id * 3 AS ordinal, url AS source, html AS content FROM pages
  UNION ALL
  SELECT page_id * 3 + 1,
    regexp_replace(url, '^(https?://)([^/?#]+)', '\1user@\2:8080') || ';p=1',
    replace(replace(replace(replace(html, '<article>', '<main>'), '</article>', '</main>'),
      '</head>', '<meta name="description" content="D &amp; ' || url
        || '"><meta content=''k1, k2'' name=''keywords''><meta property="og:title" content="">'
        || '<meta name="description" content="2nd"></head>'),
      '<body>', '<body><header><h1>Site &quot;head&quot;</h1></header>')
  FROM pages
  UNION ALL
  SELECT page_id * 3 + 2,
    'input/' || replace(url, '://', '_'),
    replace(replace(replace(replace(replace(
      regexp_replace(html, '<title>[^<]*</title>', '<title></title>'),
      '<article>', '<section>'), '</article>', '</section>'),
      '</head>', '<meta property="og:title" content="OG ' || page_id || '"></head>'),
      '<div class="ad">', '<aside class=x>'), '</div>', '</aside>')
  FROM pages
)"""

PAGES = "page_variants AS (SELECT page_id AS ordinal, url AS source, html AS content FROM pages)"


def _element(name: str) -> str:
    return rf"<{name}(?:[\s/][^>]*)?>.*?</{name}\s*>"


_OPAQUE = "(?is)<!--.*?-->|" + _element("script") + "|" + _element("style")
_NAMED = "(?is)" + "|".join(_element(n) for n in ("nav", "footer", "header", "aside"))
_STRIPPED = (
    f"regexp_replace(regexp_replace(content, {_lit(_OPAQUE)}, '<!---->', 'g'), "
    f"{_lit(_NAMED)}, '<!---->', 'g')")


def _decode(x: str) -> str:
    x = rf"regexp_replace({x}, '&amp([^-.;A-Za-z0-9]|$)', '&amp;\1', 'g')"
    for entity, char in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"),
        ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ):
        x = f"replace({x}, {_lit(entity)}, {_lit(char)})"
    return x


def _nodes(x: str, separator: str) -> str:
    return (
        f"array_to_string(list_filter(list_transform(regexp_split_to_array({x}, '<[^>]*>'), "
        f"lambda n: {_strip(_decode('n'))}), lambda n: n <> ''), {separator})")


def _region(name: str) -> str:
    return rf"regexp_extract(html, '(?is)<{name}(?:[\s/][^>]*)?>(.*?)(?:</{name}\s*>|\z)', 1)"


_RAW_TITLE = _decode(r"regexp_extract(html, '(?is)<title(?:[\s/][^>]*)?>([^<]*)</title\s*>', 1)")
_TITLE = (
    f"CASE WHEN {_RAW_TITLE} <> '' THEN {_strip(_RAW_TITLE)} ELSE "
    + _nodes(r"regexp_extract(html, '(?is)<h1(?:[\s/][^>]*)?>(.*?)</h1\s*>', 1)", "''") + " END")
_CONTENT = _nodes(
    "CASE " + " ".join(
        rf"WHEN regexp_matches(html, '(?i)<{n}[\s/>]') THEN {_region(n)}"
        for n in ("main", "article", "body")) + " ELSE html END", "chr(10)")


def _meta(attribute: str, value: str) -> str:
    tag = rf'''list_filter(regexp_extract_all(html, '(?i)<meta[\s/][^>]*>'), lambda t:
        regexp_matches(t, '(?i)\s{attribute}\s*=\s*["'']{value}["'']'))[1]'''
    got = rf"""regexp_extract({tag}, '(?i)\scontent\s*=\s*(?:"([^"]*)"|''[^'']*'')', 0)"""
    inner = (
        rf"""regexp_replace(regexp_replace({got}, '(?i)^\scontent\s*=\s*', ''), '^["'']|["'']$', '', 'g')""")
    return f"nullif({_decode(inner)}, '')"


_METAS = ", ".join(
    f"{_meta(a, v)} AS {k}" for k, a, v in (
        ("description", "name", "description"), ("keywords", "name", "keywords"),
        ("og_title", "property", "og:title")))

_URL = r"'^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)'"
_DOMAIN = f"regexp_extract(source, {_URL}, 2)"
_PATH = f"regexp_replace(regexp_extract(source, {_URL}, 3), ';[^/]*$', '')"


def _parsed(pages: str) -> str:
    """CTEs ending in `parsed`; needs the CTE of the pages."""
    return f"""{pages},
stripped AS (SELECT ordinal, source, {_STRIPPED} AS html FROM page_variants),
parsed AS (
  SELECT ordinal, source, {_TITLE} AS title, {_CONTENT} AS content,
    '{TIMESTAMP}' AS timestamp, 'html' AS source_type,
    {_DOMAIN} AS domain, {_PATH} AS path, {_METAS}
  FROM stripped)"""


def _with_vectors(table: str, key: str, columns: str, text: str = "text") -> str:
    """CTEs of the words of a table's texts and a SELECT of columns and the vector as text."""
    return f""",{_bag("bag", table, key, text)},
vectors AS (SELECT {key}, string_agg(bucket || ':' || round(weight * 1e6)::BIGINT, ' ' ORDER BY bucket) AS vector
  FROM bag GROUP BY {key})
SELECT {columns}, coalesce(vector, '') AS vector FROM {table} LEFT JOIN vectors USING ({key})"""


PAGE_POINT = "md5(source) AS point_id, ordinal, source, title, content, domain, path, description, keywords, og_title"


# -- sources ------------------------------------------------------------------

SOURCES = f"""
source_rows AS (
  SELECT 0 AS door, '' AS file, 0 AS block, page_id AS line, url AS source FROM pages
  UNION ALL
  SELECT 1, file, block, line, {_strip('value')} FROM (
    SELECT source AS file, doc_id AS block, unnest(string_split(text, chr(10))) AS value,
      generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents)
  WHERE {_strip('value')} <> ''
),
sources AS (
  SELECT row_number() OVER (ORDER BY door, file, block, line) - 1 AS ordinal, source
  FROM source_rows)"""

MIXED = """
sources AS (
  SELECT page_id * 3 AS ordinal, url AS source FROM pages
  UNION ALL SELECT page_id * 3 + 1, url || '/paper.PDF' FROM pages
  UNION ALL SELECT doc_id * 3 + 2, source FROM documents)"""

_NAME = "string_split(string_split(string_split(source, '://')[-1], '?')[1], '/')[-1]"
_SUFFIX = f"lower(regexp_extract({_NAME}, '(?s)^.+[.]([^.]+)$', 1))"
_TYPE = (
    f"CASE WHEN {_SUFFIX} IN ('', 'com', 'org', 'net', 'edu', 'gov', 'io', 'co', 'uk', 'de', "
    f"'fr', 'jp', 'au', 'ca') THEN 'html' ELSE {_SUFFIX} END")

LOADED = f"""{MIXED},
typed AS (SELECT ordinal, source, {_TYPE} AS source_type FROM sources),
loaded AS (
  SELECT t.*, p.html AS content,
    CASE WHEN source_type <> 'html' THEN 'no_parser' WHEN p.html IS NULL THEN 'not_fetched' END
      AS reason
  FROM typed t LEFT JOIN pages p ON p.url = t.source)"""


# -- vectors ------------------------------------------------------------------

def _bag(name: str, table: str, key: str, text: str = "text") -> str:
    """CTEs ending in `{name}`: key, bucket, weight of the words of a text."""
    return f"""
{name}_words AS (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS t
  FROM {table}),
{name}_signs AS (SELECT {key}, ('0x' || substr(md5(t), 1, 7))::BIGINT % 64 AS bucket,
    CASE WHEN substr(md5(t), 8, 1) < '8' THEN 1 ELSE -1 END AS s FROM {name}_words),
{name}_sums AS (SELECT {key}, bucket, sum(s)::DOUBLE AS w FROM {name}_signs GROUP BY ALL HAVING sum(s) <> 0),
{name}_norms AS (SELECT {key}, sqrt(sum(w * w)) AS n FROM {name}_sums GROUP BY ALL),
{name} AS (SELECT {key}, bucket, (w / n)::FLOAT::DOUBLE AS weight
  FROM {name}_sums JOIN {name}_norms USING ({key}))"""


def _dense(name: str, bag: str, table: str, key: str) -> str:
    """CTE with key and the vector of 64 values."""
    return f"""
{name} AS (SELECT {key}, list(coalesce(weight, 0.0) ORDER BY i) AS v
  FROM (SELECT {key}, i FROM (SELECT DISTINCT {key} FROM {table}), range(64) r(i)) g
  LEFT JOIN {bag} b ON b.{key} = g.{key} AND b.bucket = g.i GROUP BY {key})""".replace(
        f"SELECT {key}, list", f"SELECT g.{key} AS {key}, list").replace(
        f"GROUP BY {key})", f"GROUP BY g.{key})")


def _cosine(a: str, b: str) -> str:
    lengths = f"list_inner_product({a}, {a}) * list_inner_product({b}, {b})"
    return f"CASE WHEN {lengths} = 0 THEN 0.0 ELSE round(list_cosine_similarity({a}, {b}), 9) END"


TEXT_POINTS = """
text_points AS (SELECT md5(text) AS point_id, text, max(doc_id) AS ordinal, count(*) AS copies
  FROM documents GROUP BY text)"""

TEXT_VECTORS = (
    TEXT_POINTS + "," + _bag("doc_bag", "text_points", "point_id") + ","
    + _dense("doc_vectors", "doc_bag", "text_points", "point_id"))

BATCH = (
    TEXT_VECTORS + "," + _bag("asked_bag", "benchmark", "item_id") + ","
    + _dense("asked_vectors", "asked_bag", "benchmark", "item_id") + f""",
scored AS (SELECT item_id, point_id, {_cosine('d.v', 'a.v')} AS score
  FROM doc_vectors d, asked_vectors a),
ranked AS (SELECT *, row_number() OVER (
  PARTITION BY item_id ORDER BY score DESC, point_id)::INTEGER AS rank FROM scored)""")

VECTORS = """
vectors AS (SELECT vec_id, vec_id::VARCHAR AS point_id, embedding::DOUBLE[] AS v FROM embeddings)"""


def _ranked(k: int, condition: str = "") -> str:
    """CTE `hits` over `vectors` with all of them as queries."""
    return f"""
hits AS (SELECT * FROM (
  SELECT query_id, point_id, score,
    (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id))::INTEGER AS rank
  FROM (SELECT q.vec_id AS query_id, p.point_id, {_cosine('p.v', 'q.v')} AS score
    FROM vectors q, vectors p {condition})) WHERE rank <= {k})"""


_SIGNS = """
plane_signs AS (SELECT p, list(CASE WHEN substr(md5(p || ':' || i), 1, 1) < '8' THEN 1.0 ELSE -1.0
    END::DOUBLE ORDER BY i) AS s FROM range(6) a(p), range(64) b(i) GROUP BY p),
cells AS (SELECT vec_id, sum(CASE WHEN list_inner_product(v, s) > 0 THEN 1 << p ELSE 0 END)::BIGINT
    AS cell FROM vectors, plane_signs GROUP BY vec_id)"""

_NEAR = """JOIN cells cp ON cp.vec_id = p.vec_id JOIN cells cq ON cq.vec_id = q.vec_id
    WHERE bit_count(xor(cp.cell, cq.cell)) <= 2"""


def _named_hits(name: str, k: int, condition: str = "") -> str:
    return _ranked(k, condition).replace("hits AS", f"{name} AS", 1)


# -- collections --------------------------------------------------------------

LOG = """
log AS (
  SELECT lang AS collection, md5(text) AS point_id, doc_id AS ordinal, 0::BIGINT AS batch_id, text
  FROM documents
  UNION ALL
  SELECT role, md5(text), conv_id * 1048576 + turn, 1, text FROM conversations
  UNION ALL
  SELECT lang, md5(text), doc_id, 2, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT (SELECT min(lang) FROM documents), md5(text), item_id, 4, text FROM benchmark
),
catalog AS (
  SELECT DISTINCT collection AS name, 64 AS vector_size, batch_id, false AS deleted FROM log
  UNION ALL SELECT DISTINCT source, 128, 0, false FROM documents
  UNION ALL SELECT min(lang), NULL, 3, true FROM documents
),
dropped AS (SELECT name, coalesce(max(batch_id) FILTER (deleted), -1) AS dropped FROM catalog GROUP BY name),
live_names AS (
  SELECT c.name, arg_min(c.vector_size, c.batch_id) AS vector_size, 'cosine' AS distance
  FROM catalog c JOIN dropped d USING (name) WHERE NOT deleted AND batch_id > dropped
  GROUP BY c.name),
live AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT l.*, row_number() OVER (PARTITION BY collection, point_id
      ORDER BY batch_id DESC, ordinal DESC) AS n
    FROM log l JOIN dropped d ON d.name = l.collection WHERE batch_id > dropped)
  WHERE n = 1)"""


# -- requests -----------------------------------------------------------------

DECODED = """
decoded AS (
  SELECT 'benchmark-1-' || item_id AS request_id, 'search' AS tool, NULL AS reason,
    'c' AS collection_name, text AS query, item_id::VARCHAR AS "limit", NULL AS "offset",
    NULL AS document, NULL AS metadata FROM benchmark
  UNION ALL SELECT 'benchmark-2-' || item_id, 'search', NULL, 'c', text, '10', NULL, NULL, NULL
    FROM benchmark
  UNION ALL SELECT 'documents-1-' || doc_id, 'add_documents', NULL, lang, NULL, NULL, NULL, text,
    '{"source":"' || source || '"}' FROM documents
  UNION ALL SELECT 'documents-2-' || doc_id, 'add_documents', 'bad_request',
    NULL, NULL, NULL, NULL, NULL, NULL FROM documents
  UNION ALL SELECT 'documents-3-' || doc_id, 'search', 'bad_request',
    NULL, NULL, NULL, NULL, NULL, NULL FROM documents
  UNION ALL SELECT 'pages-1-' || page_id, 'get_documents', 'bad_request',
    NULL, NULL, NULL, NULL, NULL, NULL FROM pages
  UNION ALL SELECT 'pages-2-' || page_id, 'get_documents', NULL, 'c', NULL, '10', md5(url), NULL, NULL
    FROM pages
  UNION ALL SELECT 'labels-1-' || doc_id, 'list_collections', NULL,
    NULL, NULL, NULL, NULL, NULL, NULL FROM labels
  UNION ALL SELECT 'labels-2-' || doc_id, 'delete_collection', 'bad_request',
    NULL, NULL, NULL, NULL, NULL, NULL FROM labels
  UNION ALL SELECT 'conversations-1-' || conv_id, role, 'bad_request',
    NULL, NULL, NULL, NULL, NULL, NULL FROM conversations)"""


def oracle_sql() -> dict[str, str]:
    probe = "[" + ", ".join(repr((-1.0) ** i / (1 + i)) for i in range(64)) + "]::DOUBLE[]"
    job = f"""WITH {LOADED}, job AS (
        SELECT source AS s, max(ordinal) AS last FROM loaded WHERE reason IS NULL GROUP BY source),
      page_variants AS (SELECT last AS ordinal, url AS source, html AS content
        FROM pages JOIN job ON job.s = pages.url),
      {_parsed('').lstrip().removeprefix(',')}
      {_with_vectors("parsed", "source", PAGE_POINT, "content")}"""
    return {
        "source_list": f"WITH {SOURCES} SELECT ordinal, source FROM sources",
        "detect_source_type":
            f"WITH {SOURCES} SELECT ordinal, source, {_TYPE} AS source_type FROM sources",
        "route_sources": f"""WITH {LOADED} SELECT ordinal, source, source_type,
            CASE WHEN source_type <> 'html' THEN 'no_parser' END AS reason FROM typed""",
        "load_content": f"""WITH {MIXED} SELECT ordinal, s.source, md5(html) AS content_md5,
            CASE WHEN html IS NULL THEN 'not_fetched' END AS reason
            FROM sources s LEFT JOIN pages p ON p.url = s.source""",
        "load_archives": f"""WITH {MIXED} SELECT ordinal, s.source, md5(html) AS content_md5,
            CASE WHEN html IS NULL THEN 'not_fetched' END AS reason
            FROM sources s LEFT JOIN pages p ON p.url = s.source""",
        "ingest_report": f"""WITH {LOADED} SELECT coalesce(reason, 'parsed') AS reason,
            count(*) AS sources, CASE reason WHEN 'no_parser' THEN 'route' WHEN 'not_fetched' THEN 'load'
              ELSE 'done' END AS stage FROM loaded GROUP BY ALL""",
        "report_merged": f"""WITH {LOADED},
            told AS (SELECT *, coalesce(reason, 'parsed') AS why, CASE reason WHEN 'no_parser' THEN 'route'
              WHEN 'not_fetched' THEN 'load' ELSE 'done' END AS stage, {_DOMAIN} AS domain FROM loaded),
            domains AS (SELECT stage, why, count(*) AS n FROM told WHERE domain <> '' GROUP BY stage, why, domain),
            most AS (SELECT stage, why, max(n) AS top_count FROM domains GROUP BY ALL)
            SELECT stage, why AS reason, count(*) AS sources, true AS distinct_close, any_value(top_count) AS top_count
            FROM told LEFT JOIN most USING (stage, why) GROUP BY stage, why""",
        "strip_elements": f"""WITH {VARIANTS}
            SELECT ordinal, md5({_STRIPPED}) AS stripped_md5 FROM page_variants""",
        "page_title": f"WITH {_parsed(VARIANTS)} SELECT ordinal, title FROM parsed",
        "page_text": f"WITH {_parsed(VARIANTS)} SELECT ordinal, content FROM parsed",
        "url_parts": f"WITH {VARIANTS} SELECT ordinal, source, {_DOMAIN} AS domain, "
                     f"{_PATH} AS path FROM page_variants",
        "page_metadata": f"""WITH {_parsed(VARIANTS)}
            SELECT ordinal, source, domain, path, description, keywords, og_title FROM parsed""",
        "parse_pages": f"WITH {_parsed(VARIANTS)} SELECT * FROM parsed",
        "parse_nested_pages": f"WITH {_parsed(PAGES)} SELECT * FROM parsed",
        "odd_page_parts": f"WITH {_parsed(PAGES)} SELECT ordinal, title, content FROM parsed",
        "custom_parser": f"""WITH lines AS (
              SELECT doc_id, source, unnest(string_split(text, chr(10))) AS content,
                generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents)
            SELECT doc_id AS ordinal,
              row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS part, source,
              source || ' ' || line AS title, content, line::VARCHAR AS line, 'txt' AS source_type
            FROM lines WHERE {_strip('content')} <> ''""",
        "embed_text": f"""WITH {_bag('bag', 'documents', 'doc_id')}
            SELECT doc_id, bucket::INTEGER AS bucket, round(weight, 6) AS weight FROM bag""",
        "embed_batched": f"""WITH {_bag('bag', 'documents', 'doc_id')}
            SELECT doc_id, bucket::INTEGER AS bucket, round(weight, 6) AS weight FROM bag""",
        "embed_query": f"""WITH {_bag('bag', 'benchmark', 'item_id')}
            SELECT item_id AS query_id, bucket::INTEGER AS bucket, round(weight, 6) AS weight FROM bag""",
        "vector_size": """SELECT 64 AS document_size, count(*) AS documents, 64 AS vector_size
            FROM documents""",
        "check_vectors": """SELECT vec_id, variant::INTEGER AS variant, CASE variant
              WHEN 0 THEN NULL WHEN 1 THEN 'bad_vector'
              WHEN 2 THEN CASE WHEN list_max(embedding) > 0.2::FLOAT THEN 'bad_vector' END
              ELSE CASE WHEN list_max(embedding) >= 0.2::FLOAT THEN 'bad_vector' END END AS reason
            FROM embeddings, range(4) r(variant)""",
        "point_id_source": """SELECT page_id, md5(url) AS point_id,
            md5(url)::UUID::VARCHAR AS uuid FROM pages""",
        "point_id_text": "SELECT doc_id, md5(text) AS point_id FROM documents",
        "points_from_pages": f"WITH {_parsed(PAGES)} "
            + _with_vectors("parsed", "ordinal", PAGE_POINT + ", timestamp, source_type", "content"),
        "points_from_texts": """WITH turns AS (
            SELECT conv_id * 1048576 + turn AS ordinal, text, role FROM conversations)"""
            + _with_vectors("turns", "ordinal", """md5(text) AS point_id, ordinal, text,
            '{"role":"' || role || '"}' AS payload"""),
        "points_distinct": f"WITH {TEXT_POINTS}"
            + _with_vectors("text_points", "point_id", "point_id, ordinal, copies"),
        "ensure_collection": f"""WITH {LOG} SELECT DISTINCT collection AS name,
            64 AS vector_size, 'cosine' AS distance, 5::BIGINT AS batch_id, false AS deleted FROM log
            WHERE collection NOT IN (SELECT lang FROM documents
              WHERE lang <> (SELECT min(lang) FROM documents))""",
        "create_collection": """SELECT DISTINCT source AS name, 128 AS vector_size,
            'cosine' AS distance, 0::BIGINT AS batch_id, false AS deleted FROM documents""",
        "batch_plan": """SELECT conv_id * 1048576 + turn AS ordinal,
            (row_number() OVER (ORDER BY conv_id, turn) - 1) // 32 AS batch FROM conversations""",
        "upsert_latest":
            f"WITH {LOG} SELECT collection, point_id, batch_id, ordinal FROM live",
        "stored_count": f"""WITH {LOG} SELECT collection, batch_id, count(*) AS stored_count
            FROM log GROUP BY ALL""",
        "delete_collection": f"""WITH {LOG} SELECT collection, count(DISTINCT point_id) AS points
            FROM log WHERE batch_id < 3 AND collection <> (SELECT min(lang) FROM documents)
            GROUP BY ALL""",
        "list_collections": f"WITH {LOG} SELECT name FROM live_names ORDER BY name",
        "collection_info": f"""WITH {LOG} SELECT name, vector_size, distance,
            (SELECT count(*) FROM live WHERE collection = name) AS points_count FROM live_names""",
        "scroll_page": f"""WITH {LOG}, page AS (
              SELECT point_id, text, lead(point_id, 10 ) OVER (ORDER BY point_id) AS tenth,
                row_number() OVER (ORDER BY point_id) AS n
              FROM live WHERE collection = 'en' AND point_id >= '8')
            SELECT point_id, text, (SELECT tenth FROM page WHERE n = 1) AS next_offset
            FROM page WHERE n <= 10""",
        "scroll_all": f"""WITH {LOG}, ranked AS (
              SELECT point_id, md5(text) AS text, row_number() OVER (ORDER BY point_id) - 1 AS r
              FROM live WHERE collection = 'en')
            SELECT r // 10 AS page, r % 10 AS row, point_id, text, next.next_offset FROM ranked
            LEFT JOIN (SELECT r // 10 - 1 AS page, point_id AS next_offset FROM ranked
              WHERE r % 10 = 0) next ON next.page = r // 10""",
        "count_documents": f"""WITH {LOG} SELECT collection, count(*) AS documents FROM live
            GROUP BY ALL""",
        "store_checked": f"""WITH {TEXT_POINTS} SELECT point_id,
            CASE WHEN copies > 1 THEN 'bad_vector' END AS reason FROM text_points""",
        "store_nearby": f"""WITH {BATCH}
            SELECT item_id AS query_id, rank, point_id, score FROM ranked WHERE rank <= 10""",
        "search_codes_recall": f"""WITH {VECTORS}, {_ranked(10)}
            SELECT count(*) AS exact_hits, count(*) AS found_hits, 1.0::DOUBLE AS recall,
              true AS under_a_tenth FROM hits""",
        "search_vector": f"""WITH {VECTORS}, scored AS (
              SELECT point_id, {_cosine('v', probe)} AS score FROM vectors)
            SELECT (row_number() OVER (ORDER BY score DESC, point_id))::INTEGER AS rank, point_id,
              score FROM scored ORDER BY scored.score DESC, point_id LIMIT 10""",
        "search_text": f"""WITH {TEXT_VECTORS},
            asked AS (SELECT 0 AS id, {_lit(QUERY)} AS text), {_bag('asked_bag', 'asked', 'id')},
            {_dense('asked_vector', 'asked_bag', 'asked', 'id')},
            scored AS (SELECT point_id, {_cosine('d.v', 'a.v')} AS score
              FROM doc_vectors d, asked_vector a)
            SELECT (row_number() OVER (ORDER BY score DESC, point_id))::INTEGER AS rank, point_id, text,
              score FROM scored JOIN text_points USING (point_id)
            ORDER BY scored.score DESC, point_id LIMIT 10""",
        "store_search": f"""WITH {TEXT_VECTORS},
            asked AS (SELECT 0 AS id, {_lit(QUERY)} AS text), {_bag('asked_bag', 'asked', 'id')},
            {_dense('asked_vector', 'asked_bag', 'asked', 'id')},
            scored AS (SELECT point_id, {_cosine('d.v', 'a.v')} AS score
              FROM doc_vectors d, asked_vector a)
            SELECT (row_number() OVER (ORDER BY score DESC, point_id))::INTEGER AS rank, point_id, text,
              score FROM scored JOIN text_points USING (point_id)
            ORDER BY scored.score DESC, point_id LIMIT 10""",
        "search_batch": f"""WITH {BATCH}
            SELECT item_id AS query_id, rank, point_id, text, score
            FROM ranked JOIN text_points USING (point_id) WHERE rank <= 10""",
        "answer_searches": f"""WITH {BATCH}
            SELECT 'benchmark-1-' || item_id AS request_id, point_id, score
            FROM ranked WHERE rank <= item_id
            UNION ALL SELECT 'benchmark-2-' || item_id, point_id, score
            FROM ranked WHERE rank <= 10""",
        "search_all_vectors": f"""WITH {VECTORS}, {_ranked(10)}
            SELECT query_id, rank, point_id, score FROM hits""",
        "search_blocks": f"""WITH {VECTORS}, {_ranked(10)}
            SELECT query_id, rank, point_id, score FROM hits""",
        "search_codes": f"""WITH {VECTORS}, {_ranked(10)}
            SELECT query_id, rank, point_id, score FROM hits""",
        "search_codes_blocks": f"""WITH {VECTORS}, {_ranked(10)}
            SELECT query_id, rank, point_id, score FROM hits""",
        "search_approx": f"""WITH {VECTORS}, {_SIGNS}, {_ranked(10, _NEAR)}
            SELECT query_id, rank, point_id, score FROM hits""",
        "search_recall": f"""WITH {VECTORS}, {_SIGNS}, {_named_hits('exact', 10)},
            {_named_hits('near', 10, _NEAR)}
            SELECT count(*) AS exact_hits, count(n.point_id) AS found_hits,
              round(count(n.point_id) / count(*), 6) AS recall
            FROM exact e LEFT JOIN near n USING (query_id, point_id)""",
        "answer_lists": f"""WITH {LOG} SELECT 'labels-list_collections-' || doc_id AS request_id,
            (SELECT '["' || string_agg(name, '","' ORDER BY name) || '"]' FROM live_names) AS result FROM labels""",
        "answer_pages": f"""WITH {LOG}, asked AS (
              SELECT 'pages-get_documents-' || page_id AS request_id, 'en' AS collection, md5(url) AS start,
                length(regexp_extract(url, '[0-9]+$')) AS n FROM pages
              UNION ALL SELECT 'documents-get_documents-' || doc_id, lang, md5(source), 10 FROM documents
              UNION ALL SELECT 'benchmark-get_documents-' || item_id, 'none such', text, 10 FROM benchmark),
            starts AS (SELECT DISTINCT collection, start, n FROM asked),
            found AS (SELECT s.*, l.point_id, l.text,
                row_number() OVER (PARTITION BY s.collection, s.start, s.n ORDER BY l.point_id) AS r
              FROM starts s JOIN live l ON l.collection = s.collection AND l.point_id >= s.start),
            shown AS (SELECT collection, start, n, '{{"documents":[' || coalesce(string_agg('{{"id":"' || point_id
                || '","payload":{{"text":"' || md5(text) || '"}}}}', ',' ORDER BY r) FILTER (r <= n), '')
                || '],"next_offset":' || coalesce('"' || max(point_id) FILTER (r = n + 1) || '"', 'null') || '}}' AS result
              FROM found GROUP BY ALL)
            SELECT request_id, coalesce(result, '{{"documents":[],"next_offset":null}}') AS result
            FROM asked LEFT JOIN shown USING (collection, start, n)""",
        "answer_additions": """SELECT 'documents-add_documents-' || doc_id AS request_id,
            '{"stored_count":' || len(string_split(text, chr(10))) || '}' AS result FROM documents""",
        "answer_deletions": """SELECT 'documents-delete_collection-' || doc_id AS request_id,
            '{"deleted":true}' AS result FROM documents""",
        "decode_requests": f"WITH {DECODED} SELECT * FROM decoded",
        "requested_documents": """SELECT 'documents-1-' || doc_id AS request_id,
            lang AS collection, 0 AS position, text FROM documents""",
        "render_json": f"""WITH {VECTORS}, {_ranked(3)}
            SELECT query_id, '[' || string_agg('{{"id":"' || point_id || '","score":'
              || round(score * 1000)::INTEGER || ',"payload":{{"text":"say \\"' || point_id
              || '\\""}}}}', ',' ORDER BY rank) || ']' AS result FROM hits GROUP BY query_id""",
        "render_page": f"""WITH {LOG}, page AS (
              SELECT point_id, text, row_number() OVER (ORDER BY point_id) AS n
              FROM live WHERE collection = 'en')
            SELECT '{{"documents":[' || string_agg('{{"id":"' || point_id
              || '","payload":{{"text":"' || md5(text) || '"}}}}', ',' ORDER BY n)
              FILTER (n <= 10) || '],"next_offset":'
              || coalesce('"' || max(point_id) FILTER (n = 11) || '"', 'null') || '}}' AS result
            FROM page""",
        "ingest_job": job,
        "ingest_twice": job,
        "ingest_stream": f"WITH {_parsed(PAGES)} "
            + _with_vectors("parsed", "ordinal", PAGE_POINT, "content"),
        "ingest_changes": f"""WITH {_parsed("""page_variants AS (SELECT page_id AS ordinal, url AS source,
              CASE WHEN md5(url) < '8' THEN replace(html, '<title>', '<title>New ') ELSE html END AS content
              FROM pages)""")}
            SELECT source, title, ordinal * 2 + changed AS ordinal, changed AS batch_id FROM (SELECT parsed.*,
              CASE WHEN md5(url) < '8' AND contains(html, '<title>') THEN 1 ELSE 0 END AS changed
            FROM parsed JOIN pages ON page_id = ordinal)""",
    }
