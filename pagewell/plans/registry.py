"""Parsers and embedders by name."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from pagewell.functions.hashing import hashed_embedder
from pagewell.operators.embed import Embedder
from pagewell.operators.parse import parse_pages, parse_rows

# A parser turns pages (`ordinal, source, content`) into documents and maybe rejects.
Parser = Callable[..., "DataFrame | tuple[DataFrame, DataFrame]"]

PARSERS: dict[str, Parser] = {"html": parse_pages}
EMBEDDERS: dict[str, Callable[[], Embedder]] = {"hashed": hashed_embedder}


def register_parser(source_type: str, parser: Parser) -> None:
    """`parser(pages, timestamp)` for a source type; replaces an earlier one."""
    PARSERS[source_type] = parser


def register_row_parser(source_type: str, parser: Callable) -> None:
    """`parser(content, source)` in Python, see `operators.parse.parse_rows`."""
    PARSERS[source_type] = lambda pages, timestamp=None: parse_rows(
        pages, parser, source_type, timestamp)


def register_embedder(name: str, make: Callable[[], Embedder]) -> None:
    """A function without arguments that makes an embedder; replaces an earlier one."""
    EMBEDDERS[name] = make


def _look_up(kind: str, table: dict, name: str):
    if name not in table:
        raise ValueError(f"No {kind} is registered as {name!r}, only {', '.join(sorted(table)) or 'none'}")
    return table[name]


def get_parser(source_type: str) -> Parser:
    return _look_up("parser", PARSERS, source_type)


def get_embedder(name: str = "hashed") -> Embedder:
    return _look_up("embedder", EMBEDDERS, name)()
