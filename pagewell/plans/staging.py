"""Tables written once where several steps read the same rows."""

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`, which all executors see; a local session
    without it may use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/pagewell-{os.urandom(8).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="pagewell-")


def written(rows: DataFrame) -> DataFrame:
    """The rows as a table: what makes them runs once, also when executors are lost later."""
    path = f"{shared_path(rows.sparkSession)}/rows"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
