"""Document ingest and semantic search on Spark DataFrames."""

import os
import tempfile
import zipfile

_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package to the Python workers of the session, once per application.

    Not needed where the package is installed on all nodes or given by --py-files.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pagewell-"), "pagewell.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(root):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    packed.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
