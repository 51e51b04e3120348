"""Source strings and URLs as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes that are domain endings and not file types.
DOMAIN_SUFFIXES = (
    "com", "org", "net", "edu", "gov", "io", "co",
    "uk", "de", "fr", "jp", "au", "ca",
)

# Schemes whose last path segment may carry ;parameters.
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "sip", "sips", "mms", "sftp", "tel",
)

# Scheme, authority and path in the generic syntax of RFC 3986.
URL_PATTERN = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def detect_source_type(source: Column) -> Column:
    """File type by the suffix of the last path segment; 'html' when there is none."""
    path = F.substring_index(source, "://", -1)
    path = F.substring_index(path, "?", 1)
    name = F.substring_index(path, "/", -1)
    suffix = F.lower(F.regexp_extract(name, r"(?s)^.+[.]([^.]+)$", 1))
    return F.when((suffix == "") | suffix.isin(*DOMAIN_SUFFIXES), "html").otherwise(suffix)


def _cleaned(url: Column) -> Column:
    leading = "".join(chr(i) for i in range(0x21))
    return F.translate(F.ltrim(url, F.lit(leading)), "\t\r\n", "")


def url_domain(url: Column) -> Column:
    """Authority of the URL with user-info and port; '' when there is none."""
    return F.regexp_extract(_cleaned(url), URL_PATTERN, 2)


def url_path(url: Column) -> Column:
    """Path of the URL without the ;parameters of its last segment."""
    cleaned = _cleaned(url)
    path = F.regexp_extract(cleaned, URL_PATTERN, 3)
    scheme = F.lower(F.regexp_extract(cleaned, URL_PATTERN, 1))
    return F.when(
        scheme.isin(*PARAM_SCHEMES), F.regexp_replace(path, r"(?s);[^/]*$", "")
    ).otherwise(path)
