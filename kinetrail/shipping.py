"""Sends this package to the executors, so that Python workers can import it wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package's source to the session's Python files, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_kinetrail_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="kinetrail-"), "kinetrail.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("kinetrail", os.path.relpath(full, here)))
    context.addPyFile(path)
    context._kinetrail_shipped = True
