"""Tables in the folder that the driver and all executors share: what several plans read is computed once."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_once: dict[tuple[str, ...], DataFrame] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a local session gets a temporary folder, and any other an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="affinis-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet to the shared folder and read from there: cuts the lineage, survives lost executors, and has a known size."""
    path = f"{shared_folder(df.sparkSession)}/affinis/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes the files of a table made by stored() that no plan reads any more; shuffle files that none reads go too, once the driver has collected its garbage."""
    for file in df.inputFiles()[:1]:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    df.sparkSession._jvm.System.gc()


def already(spark: SparkSession, label: str, source: str) -> DataFrame | None:
    """What once() has stored, if it has."""
    return _once.get((spark.sparkContext.applicationId, label, source))


def once(spark: SparkSession, label: str, source: str, make: Callable[[], DataFrame], store: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """stored(make()), once per application, label and source; with another ``store`` what make() has stored itself is not copied."""
    key = (spark.sparkContext.applicationId, label, source)
    if key not in _once:
        _once[key] = store(make(), label)
    return _once[key]
