"""The queries of the operations, and the SQL of those that SQL can express."""

from pagewell.llm import (
    alignment, chunks, conversations, embeddings, langid, lm, mixing, packing, quality, simhash, token_counts,
    token_files, warc)

MODULES = (mixing, lm, simhash, embeddings, langid, warc, token_files, quality, packing, token_counts,
           conversations, alignment, chunks)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}
