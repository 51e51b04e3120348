"""Page reading by walking the tags, for markup the expressions cannot read.

The walk keeps the open elements on a stack: an end tag closes everything above
its own start tag and is ignored when there is none, void elements close at once.
"""

from collections import Counter
from collections.abc import Iterator, Sequence
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewell.functions import markup

# Elements whose text does not count as text of what is around them.
SILENT = frozenset({"script", "style", "template", "rt", "rp"})

# Windows code points that numbered characters often mean.
CP1252 = range(128, 160)

WALKED = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    *(T.StructField(key, T.StringType()) for key, _, _ in markup.META_KEYS),
])


class PageWalker(HTMLParser):
    """Collects the text nodes of a page in order, and which span belongs to what."""

    def __init__(self, excluded: Sequence[str]):
        super().__init__(convert_charrefs=False)
        self.excluded = frozenset(excluded)
        self.open: list[str] = []
        self.open_names = Counter()
        self.hidden_at: int | None = None
        self.silent = 0
        self.buffer: list[str] = []
        self.texts: list[str] = []
        self.spans: dict[str, list[int]] = {}
        self.span_depth: dict[str, int] = {}
        self.title_depth: int | None = None
        self.title_strings: list[tuple[int, str]] | None = None
        self.title_elements = 0
        self.meta: dict[str, str | None] = {}

    # -- events of the tokenizer -------------------------------------------

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in markup.VOID:
            self._element(tag, attrs)
        else:
            self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self._flush()
        if tag in markup.VOID:
            self._element(tag, attrs)
        else:
            self._push(tag, attrs)
            self._pop_to(tag)

    def handle_endtag(self, tag):
        self._flush()
        self._pop_to(tag)

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_entityref(self, name):
        self.buffer.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
            if code in CP1252:
                char = bytes([code]).decode("windows-1252")
            else:
                char = chr(code)
        except (ValueError, OverflowError, UnicodeDecodeError):
            char = "�"
        self.buffer.append(char)

    def handle_comment(self, data):
        self._flush()
        self._title_string(data)

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.buffer.append(data[len("CDATA["):])
            self._flush()

    # -- the open elements --------------------------------------------------

    def _element(self, tag, attrs):
        """A start tag that is not hidden, void or not."""
        if self.hidden_at is not None or tag in self.excluded:
            return
        if self.title_strings is not None and self.title_depth is not None:
            self.title_elements += 1
        if tag == "meta":
            values = dict(attrs)
            for key, name, wanted in markup.META_KEYS:
                if key not in self.meta and values.get(name) == wanted:
                    self.meta[key] = values.get("content")

    def _push(self, tag, attrs):
        self._element(tag, attrs)
        depth = len(self.open)
        self.open.append(tag)
        self.open_names[tag] += 1
        if tag in SILENT:
            self.silent += 1
        if self.hidden_at is not None:
            return
        if tag in self.excluded:
            self.hidden_at = depth
            return
        if tag == "title" and self.title_strings is None:
            self.title_depth, self.title_strings = depth, []
        if tag in (*markup.REGIONS, "h1") and tag not in self.spans:
            self.spans[tag] = [len(self.texts), -1]
            self.span_depth[tag] = depth

    def _pop_to(self, tag):
        if not self.open_names[tag]:
            return
        while True:
            top = self.open.pop()
            self.open_names[top] -= 1
            self._closed(top, top == tag)
            depth = len(self.open)
            if top in SILENT:
                self.silent -= 1
            if self.hidden_at == depth:
                self.hidden_at = None
            if self.title_depth == depth:
                self.title_depth = None
            if self.span_depth.get(top) == depth:
                self.spans[top][1] = len(self.texts)
                del self.span_depth[top]
            if top == tag:
                return

    def _closed(self, tag, own):
        """An element ends, by its own end tag or by that of one around it."""

    def _flush(self):
        if not self.buffer:
            return
        text = "".join(self.buffer)
        self.buffer.clear()
        if not text:
            return
        self._title_string(text)
        if self.hidden_at is None and not self.silent:
            stripped = text.strip()
            if stripped:
                self.texts.append(stripped)

    def _title_string(self, text):
        if self.title_depth is not None and self.hidden_at is None:
            self.title_strings.append((len(self.open) - self.title_depth - 1, text))

    # -- results ------------------------------------------------------------

    def _span(self, name):
        start, end = self.spans[name]
        return self.texts[start:] if end < 0 else self.texts[start:end]

    def title(self) -> str:
        strings = self.title_strings or []
        # A title counts when all it holds is one string, however deep.
        if len(strings) == 1 and strings[0][0] == self.title_elements:
            return strings[0][1].strip()
        return "".join(self._span("h1")) if "h1" in self.spans else ""

    def content(self) -> str:
        for name in markup.REGIONS:
            if name in self.spans:
                return "\n".join(self._span(name))
        return "\n".join(self.texts)


class StrippedPage(PageWalker):
    """Finds where a page's comments and excluded elements begin and end."""

    def __init__(self, html: str, excluded: Sequence[str]):
        super().__init__(excluded)
        self.lines = [0, *(at + 1 for at, char in enumerate(html) if char == "\n")]
        self.cuts: list[list[int]] = []
        self.ends_next = False  # the last cut ends where the next thing begins
        self.feed(html)
        self.close()

    def _next(self) -> int:
        """Where the construct that is being handled begins."""
        line, column = self.getpos()
        at = self.lines[line - 1] + column
        if self.ends_next:
            self.cuts[-1].append(at)
            self.ends_next = False
        return at

    def _start(self, handle, tag, attrs):
        at, seen = self._next(), self.hidden_at is None
        if seen and tag in self.excluded:
            self.cuts.append([at])
            self.ends_next = tag in markup.VOID
        handle(tag, attrs)

    def handle_starttag(self, tag, attrs):
        self._start(super().handle_starttag, tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self._start(super().handle_startendtag, tag, attrs)

    def handle_endtag(self, tag):
        self.tag_at = self._next()
        super().handle_endtag(tag)

    def _closed(self, tag, own):
        if self.hidden_at == len(self.open):
            if own:
                self.ends_next = True
            else:
                self.cuts[-1].append(self.tag_at)

    def handle_data(self, data):
        self._next()

    def handle_entityref(self, name):
        self._next()

    def handle_charref(self, name):
        self._next()

    def handle_comment(self, data):
        at = self._next()
        if self.hidden_at is None:
            self.cuts.append([at])
            self.ends_next = True

    def handle_decl(self, decl):
        self._next()

    def handle_pi(self, data):
        self._next()

    def unknown_decl(self, data):
        self._next()


def stripped(html: str, excluded: Sequence[str]) -> str:
    """The page as it is, with a gap for each comment and excluded element."""
    out, last = [], 0
    for begin, *end in StrippedPage(html, excluded).cuts:
        out += [html[last:begin], markup.GAP]
        last = end[0] if end else len(html)
    return "".join([*out, html[last:]])


def walk(html: str, excluded: Sequence[str]) -> tuple:
    """Title, main text and meta values of one page."""
    walker = PageWalker(excluded)
    walker.feed(html)
    walker.close()
    walker._flush()
    return (walker.title(), walker.content(),
            *(walker.meta.get(key) for key, _, _ in markup.META_KEYS))


def walked_page(html: Column, names: Sequence[str] | None = None) -> Column:
    """Struct of `walk` per page; null for null pages."""
    excluded = markup.excluded_names(names)

    @F.pandas_udf(WALKED)
    def read(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        empty = (None,) * len(WALKED.fields)
        for batch in pages:
            yield pd.DataFrame(
                [empty if html is None else walk(html, excluded) for html in batch],
                columns=WALKED.fieldNames(), dtype=object)

    # Keeps filters on the result from being pushed below, where they would repeat it.
    return read.asNondeterministic()(html)


def stripped_page(html: Column, names: Sequence[str] | None = None) -> Column:
    """`stripped` per page; null for null pages."""
    excluded = markup.excluded_names(names)

    @F.pandas_udf("string")
    def read(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([None if html is None else stripped(html, excluded) for html in batch], dtype=object)

    return read.asNondeterministic()(html)
