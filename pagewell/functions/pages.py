"""Stripping, title and text of any page, as columns.

Plain markup is read by the expressions of `markup`, other pages by the walker, with the
same results wherever both apply. To parse whole pages, `operators.parse` does all of it
in one pass.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.functions import markup, walker


def _by_kind(html: Column, names: Sequence[str] | None, plain: Column, walked: Callable[[Column], Column]) -> Column:
    """`plain` for plain pages, for others what `walked` makes of them; null pages give null."""
    opaque = markup.strip_opaque(html)
    is_plain = markup.is_plain(html, opaque, markup.bare_tags(opaque), names)
    return F.when(is_plain, plain).otherwise(walked(F.when(~is_plain, html)))


def strip_elements(html: Column, names: Sequence[str] | None = None) -> Column:
    """The page without comments and the named elements, however they are nested or closed."""
    return _by_kind(html, names, markup.strip_plain(html, names), lambda hard: walker.stripped_page(hard, names))


def page_title(html: Column, names: Sequence[str] | None = None) -> Column:
    """Text of the first title outside of the named elements; of the first h1 when there is
    none or it is empty."""
    title = markup.plain_title(markup.strip_named(markup.strip_opaque(html), names))
    return _by_kind(html, names, title, lambda hard: walker.walked_page(hard, names)["title"])


def page_text(html: Column, names: Sequence[str] | None = None) -> Column:
    """Text outside of the named elements of the first main, else article, else body, else
    the page, one text node per line."""
    text = markup.plain_text(markup.strip_named(markup.strip_opaque(html), names))
    return _by_kind(html, names, text, lambda hard: walker.walked_page(hard, names)["content"])
