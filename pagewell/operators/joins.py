"""A join that stays balanced when one key holds much of the data."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def join_unique(
    rows: DataFrame, unique: DataFrame, keys: Sequence[str], spread: Column,
    how: str = "left", salts: int = SALTS,
) -> DataFrame:
    """Equi-join with a table that has one row per key.

    A key of `rows` may be arbitrarily frequent: its rows are spread over `salts`
    groups by `spread`, and the row of `unique` is copied to those groups that
    occur, which are never more than the rows themselves.
    """
    keys = list(keys)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    groups = salted.select(*keys, "_salt").distinct()
    copies = groups.join(unique, keys)
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
