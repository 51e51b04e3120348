"""Point ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def point_id(key: Column) -> Column:
    """Hex md5 of the UTF-8 bytes of a source or a text."""
    return F.md5(key)


def hex_to_uuid(hex_id: Column) -> Column:
    """The same 128 bits in the hyphenated form."""
    return F.regexp_replace(
        hex_id, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
