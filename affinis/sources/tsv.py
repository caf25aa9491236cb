"""Tab-separated records, truth and results."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinis.operators.relational import id_lists
from affinis.schema import SOURCE, TRUTH


def read_tsv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """A quoted TSV file with a header: doubled quotes are one, "NA" stays a string, empty fields are ''.

    multiline also reads fields with line ends inside, at the price of one task a file.
    """
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    df = reader.option("nullValue", "\x00").option("emptyValue", "").csv(path)
    return df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in schema.names))


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """Business records."""
    return read_tsv(spark, path, SOURCE)


def read_truth(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, population): true (s1_id, s23_id), ids trimmed, and all (s1_id), also those without matches."""
    rows = read_tsv(spark, path, TRUTH).withColumnRenamed("source1_entity_id", "s1_id")
    ids = F.filter(F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select("s1_id", F.explode(ids).alias("s23_id")).distinct(), rows.select("s1_id").distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id): the distinct trimmed first fields below the header, without blank ones."""
    return lines_below(spark, path).select(F.trim(F.split("value", "\t")[0]).alias("entity_id")).where("entity_id <> ''").distinct()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def lines_below(spark: SparkSession, path: str) -> DataFrame:
    """(value): the raw lines below the header of every file of a path, but empty ones; files are split."""
    reader = spark.read.schema("value string").option("header", True).option("sep", "\x01").option("quote", "").option("nullValue", "\x00")
    return reader.csv(path).where("value is not null")


def result_lines(spark: SparkSession, path: str) -> tuple[str | None, DataFrame]:
    """(header, lines below it) of a result file as raw text, so that malformed rows can be seen."""
    first = spark.read.text(path).first()
    return first.value if first else None, lines_below(spark, path)


def write_id_lists(pairs: DataFrame, population: DataFrame, path: str, column: str, single: bool = False) -> None:
    """One unquoted row per S1 record, sorted: its id, a tab, and its sorted ids with commas between (none: nothing).

    Sorted parts, each with the header; single: one file, written by one task, for an export.
    """
    lists = id_lists(pairs, population, "s1_id", "s23_id", column).withColumnRenamed("s1_id", "source1_entity_id").orderBy("source1_entity_id")
    _writer(lists.coalesce(1) if single else lists).option("quote", "").csv(path)


def write_matching_results(pairs: DataFrame, population: DataFrame, path: str, single: bool = False) -> None:
    """The matches."""
    write_id_lists(pairs, population, path, "matched_entity_ids", single)


def write_candidate_pairs(pairs: DataFrame, population: DataFrame, path: str, single: bool = False) -> None:
    """The candidates."""
    write_id_lists(pairs, population, path, "candidate_entity_ids", single)


def write_source(records: DataFrame, path: str) -> None:
    """Quoted records."""
    _writer(records.select(*SOURCE.names)).option("quote", '"').option("escape", '"').csv(path)


def _writer(df: DataFrame):
    return df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "")


def find_dataset(root: str, name: str) -> str | None:
    """The first folder below root that holds a file of that name."""
    return next((folder for folder, _, files in sorted(os.walk(root)) if name in files), None)
