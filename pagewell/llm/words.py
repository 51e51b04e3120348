"""Words as the operators count them: what stands between blanks and \\t \\n \\v \\f \\r."""

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK + "+")), F.lit(0)).cast("long")
