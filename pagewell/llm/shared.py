"""Folders and tables that the driver and all executors see."""

from __future__ import annotations

import ctypes
import os
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under `spark.checkpoint.dir`.

    Where that is unset, a local session gets a temporary folder as its checkpoint
    folder; on a cluster there is no place that all executors see, which is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pagewell-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/pagewell-{name}-{os.urandom(8).hex()}"


def materialise(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold of freed memory. A Python worker
    outlives its task, and keeps that while other stages run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from pagewell import ship

    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
