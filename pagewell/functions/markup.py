"""HTML as column expressions.

The expressions are exact for *plain* markup: tags nest properly once unclosed
elements are closed by their parents, no element to strip or to read contains
another of the same name, attribute values hold no angle brackets, and all
entities are in ENTITIES. `is_plain` decides that per page, with regular
expressions only; `operators.parse` and `functions.pages` send
the other pages to `functions.walker`.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.functions.text import strip

# Elements removed before anything is extracted.
DEFAULT_EXCLUDED = ("script", "style", "nav", "footer", "header", "aside")

# Elements whose content is never text.
OPAQUE = ("script", "style")

# Where the main text is looked for, in this order.
REGIONS = ("main", "article", "body")

# Elements without content or end tag.
VOID = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed",
    "frame", "hr", "image", "img", "input", "isindex", "keygen", "link",
    "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)

# Metadata key, the attribute that names the meta tag, its value.
META_KEYS = (
    ("description", "name", "description"),
    ("keywords", "name", "keywords"),
    ("og_title", "property", "og:title"),
)

# Named and numbered characters decoded here. `&amp;` comes last.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
    ("&#39;", "'"), ("&#34;", '"'), ("&#38;", "&"), ("&nbsp;", " "),
    ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"),
    ("&middot;", "·"), ("&bull;", "•"), ("&hellip;", "…"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"),
    ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&times;", "×"),
    ("&deg;", "°"), ("&euro;", "€"), ("&pound;", "£"),
    ("&amp;", "&"),
)

# Elements the tokenizer or the text rules treat in their own way.
SPECIAL = (
    "template", "rt", "rp", "textarea", "plaintext", "xmp", "iframe",
    "noembed", "noframes",
)

TAG = "<[^>]*>"

# Takes the place of stripped markup: still HTML, and still splits the text.
GAP = "<!---->"

# Stands for a tag while text nodes are put together.
MARK = "\x01"

# A truncated `&amp` counts as `&amp;` unless a longer name follows.
BARE_AMP = "&amp(?=[^-.;A-Za-z0-9]|$)"

ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+)"""

# Text and the tag after it; quotes must be closed and hold no angle brackets.
TEXT_AND_TAG = (
    r"""[^<]*+(?:<(/?[a-zA-Z][a-zA-Z0-9:-]*+|!----|!(?i:doctype))"""
    r"""(?:[^<>"'/]++|"[^"<>]*+"|'[^'<>]*+'|/(?!>))*+(/?)>|$)""")

# How often `is_plain` unwinds two levels of nesting.
PLAIN_PASSES = 12


def inside(name: str) -> str:
    """Pattern of everything up to the end tag, in runs instead of single characters."""
    return f"(?:[^<]++|<(?!/{name}\\s*>))*+"


def element(name: str) -> str:
    """Pattern of an element with its content, up to the first end tag, after its `<`."""
    if name in VOID:
        return f"{name}(?:[\\s/][^>]*)?>"
    return f"{name}(?:[\\s/][^>]*)?>{inside(name)}</{name}\\s*>"


def excluded_names(names: Sequence[str] | None) -> tuple[str, ...]:
    """The given element names in lower case; the defaults when there are none."""
    return tuple(n.lower() for n in names) if names else DEFAULT_EXCLUDED


def opaque_pattern(names: Sequence[str] = OPAQUE) -> str:
    """Comments and opaque elements, read in document order."""
    return "(?i)<(?:" + "|".join(["!--(?:[^-]++|-(?!->))*+-->", *(element(n) for n in names)]) + ")"


def strip_opaque(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, opaque_pattern(), GAP)


def strip_named(html: Column, names: Sequence[str] | None = None) -> Column:
    """A page without opaque elements, also without the other named elements."""
    named = [n for n in excluded_names(names) if n not in OPAQUE]
    if not named:
        return html
    return F.regexp_replace(html, "(?i)<(?:" + "|".join(element(n) for n in named) + ")", GAP)


def strip_plain(html: Column, names: Sequence[str] | None = None) -> Column:
    """A plain page without comments and the named elements."""
    opaque = [n for n in OPAQUE if n in excluded_names(names)]
    return strip_named(F.regexp_replace(html, opaque_pattern(opaque), GAP), names)


def decode(text: Column) -> Column:
    """Replace the entities of ENTITIES by their characters."""
    pairs = F.array(*(
        F.struct(F.lit(e).alias("entity"), F.lit(c).alias("char")) for e, c in ENTITIES))
    return F.aggregate(
        pairs, F.regexp_replace(text, BARE_AMP, "&amp;"),
        lambda out, pair: F.replace(out, pair["entity"], pair["char"]))


def mark_tags(html: Column) -> Column:
    """The text of the markup with a mark for every tag."""
    return F.regexp_replace(html, TAG, MARK)


def join_nodes(marked: Column, separator: str) -> Column:
    """Text nodes between the marks, trimmed, those with text joined."""
    nodes = F.transform(F.split(marked, MARK), strip)
    return F.array_join(F.filter(nodes, lambda node: node != ""), separator)


def text_nodes(html: Column, separator: str) -> Column:
    """Text nodes decoded and trimmed, those with text joined by the separator."""
    return join_nodes(decode(mark_tags(html)), separator)


def raw_title(stripped: Column) -> Column:
    """Markup of the first title."""
    return F.regexp_extract(
        stripped, r"(?i)<title(?:[\s/][^>]*)?>([^<]*+)</title\s*>", 1)


def raw_heading(stripped: Column) -> Column:
    """Markup inside the first h1."""
    return F.regexp_extract(
        stripped, rf"(?i)<h1(?:[\s/][^>]*)?>({inside('h1')})</h1\s*>", 1)


def plain_title(stripped: Column) -> Column:
    """Of a plain page: text of the first title; of the first h1 when there is none or it is empty."""
    title = raw_title(stripped)
    return F.when(title != "", strip(decode(title))).otherwise(
        text_nodes(raw_heading(stripped), ""))


def main_region(stripped: Column, bare: Column | None = None) -> Column:
    """Markup inside the first main, else article, else body, else the page.

    Tags that are not among the `bare` tags need not be looked for.
    """
    region = stripped
    for name in reversed(REGIONS):
        close = r"(?:</body\s*>|\z)" if name == "body" else f"</{name}\\s*>"
        pattern = f"(?i)<{name}(?:[\\s/][^>]*)?>({inside(name)}){close}"
        there = F.regexp_like(stripped, F.lit(f"(?i)<{name}[\\s/>]"))
        if bare is not None:
            there = F.contains(bare, F.lit(f"<{name}>")) & there
        region = F.when(there, F.regexp_extract(stripped, pattern, 1)).otherwise(region)
    return region


def plain_text(stripped: Column) -> Column:
    """Of a plain page: text nodes of the main region, one per line."""
    return text_nodes(main_region(stripped), "\n")


def meta_tags(stripped: Column) -> Column:
    """All meta tags as arrays of (name, value) attributes."""
    tags = F.regexp_extract_all(stripped, F.lit(r"(?i)<meta[\s/][^>]*>"), F.lit(0))

    def attribute(pair: Column) -> Column:
        value = F.regexp_extract(pair, ATTRIBUTE, 2)
        return F.struct(
            F.lower(F.regexp_extract(pair, ATTRIBUTE, 1)).alias("name"),
            decode(F.regexp_replace(value, """(?s)^(["'])(.*)["']$""", "$2")).alias("value"),
        )

    return F.transform(tags, lambda tag: F.transform(
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)), attribute))


def meta_content(tags: Column, attribute: str, value: str) -> Column:
    """Content of the first meta tag with the given attribute; null when missing."""

    def last(attributes: Column, name: str) -> Column:
        return F.try_element_at(
            F.filter(attributes, lambda a: a["name"] == name), F.lit(-1))["value"]

    first = F.try_element_at(
        F.filter(tags, lambda t: last(t, attribute) == value), F.lit(1))
    return last(first, "content")


def page_meta(stripped: Column) -> Column:
    """Struct with the meta values of META_KEYS; null where the tag is missing."""
    tags = meta_tags(stripped)
    return F.struct(*(meta_content(tags, a, v).alias(k) for k, a, v in META_KEYS))


def metadata_map(domain: Column, path: Column, meta: Column) -> Column:
    """Domain and path, and those meta values that are not empty."""
    pairs = [F.lit("domain"), domain, F.lit("path"), path]
    for key, _, _ in META_KEYS:
        pairs += [F.lit(key), meta[key]]
    always = F.array(F.lit("domain"), F.lit("path"))
    return F.map_filter(
        F.create_map(*pairs),
        lambda k, v: F.array_contains(always, k) | F.coalesce(v != "", F.lit(False)))


def bare_tags(opaque_stripped: Column) -> Column:
    """The page reduced to its tag names: `<html><p></p>`; odd markup stays as it is."""
    bare = F.regexp_replace(opaque_stripped, TEXT_AND_TAG, "<$1$2>")
    return F.lower(F.replace(bare, F.lit("<>"), F.lit("")))


def is_plain(
    html: Column, opaque_stripped: Column, bare: Column, names: Sequence[str] | None = None,
) -> Column:
    """Whether the expressions of this module read the page exactly.

    `bare` is the result of `bare_tags`. Elements are removed from it from the
    inside out, each together with unclosed ones in it; nothing is left when the
    tags nest properly. Elements to strip or to read must close themselves and may
    not hold another of their name.
    """
    excluded = [n for n in {*excluded_names(names), *OPAQUE} if n not in VOID]
    matched = "|".join(sorted({*excluded, "main", "article", "title", "h1"}))
    odd = [F.contains(html, F.lit(part)) for part in (MARK, "<!-->", "<!--->", "--!>")]
    known = "|".join(e[1:-1] for e, _ in ENTITIES)
    odd.append(F.contains(opaque_stripped, F.lit("&")) & F.regexp_like(
        opaque_stripped, F.lit(f"&(?!(?:{known});|amp[^-.;A-Za-z0-9])[a-zA-Z#]")))
    odd.append(F.regexp_like(opaque_stripped, F.lit(
        r"(?i)<title(?:[\s/][^>]*)?>[^<]*+<(?!/title)")))
    odd.append(F.regexp_like(bare, F.lit(
        f"<(?:({matched}|body)>(?:<(?!/?\\1>)[^<>]*>)*+<\\1>"
        f"|(?:{'|'.join((*SPECIAL, *OPAQUE))})/?>"
        f"|(?:{matched}|body)/>)")))
    void = "|".join((*VOID, "!----", "!doctype"))
    rest = F.regexp_replace(bare, f"<(?:(?:{void})/?|[^<>/]+/)>", "")
    start = f"<(?![/!]|(?:{matched})>)[^<>]*>"
    name = "[a-z][a-z0-9:-]*+"
    closing = (
        f"<({name})>(?:<({name})></\\2>|(?!<\\1>){start})*+</\\1>|(?:{start})++$")
    rest = F.aggregate(
        F.sequence(F.lit(1), F.lit(PLAIN_PASSES)), rest,
        lambda tags, _: F.when(tags == "", tags).otherwise(F.regexp_replace(tags, closing, "")))
    return ~F.array_contains(F.array(*odd, rest != ""), F.lit(True))
