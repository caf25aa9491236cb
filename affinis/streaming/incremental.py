"""Records as they arrive: normalised, and exploded to blocking keys, by the same column functions as in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinis.functions.text import normalize_unicode
from affinis.operators.blocking import CATALYST, keyed
from affinis.schema import SOURCE


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records of TSV files as they appear in a folder."""
    return spark.readStream.schema(SOURCE).option("sep", "\t").option("header", True).option("escape", '"').csv(folder)


def keyed_stream(records: DataFrame) -> DataFrame:
    """(entity_id, key) of a stream, ready for a join with stored postings."""
    named = records.select("entity_id", normalize_unicode("business_name").alias("norm_name"), normalize_unicode("business_address").alias("norm_address"))
    return keyed(named, CATALYST)
