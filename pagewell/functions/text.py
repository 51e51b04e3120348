"""Small text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode-aware trimming removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space on both sides."""
    return F.btrim(text, F.lit(WHITESPACE))
