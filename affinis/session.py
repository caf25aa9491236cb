"""Sessions, and getting this package to executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def session(app: str = "affinis", **config: str) -> SparkSession:
    """A session with the settings the operators are made for; the master and sizes come from spark-submit or config."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in config.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors' Python workers once per application, for clusters where it is not installed."""
    context = spark.sparkContext
    if not getattr(context, "_affinis_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "affinis"), "zip", root, "affinis")
        context.addPyFile(archive)
        context._affinis_shipped = True
    return spark
