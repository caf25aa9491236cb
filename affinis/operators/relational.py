"""Small relational operators with a defined order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.schema import source_of


def first_by_key(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row per key: the first in the given order."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of the sources, by column name."""
    out = sources[0]
    for source in sources[1:]:
        out = out.unionByName(source)
    return out


def split_sources(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of S1, and those of S2 and S3."""
    own = source_of(F.col("entity_id")) == "S1"
    return entities.where(own), entities.where(~own)


def top_per_group(df: DataFrame, group: str, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of each group in the given order (the planner limits groups before the shuffle)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def with_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ids."""
    return df.join(ids.select(key), key, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ids."""
    return df.join(ids.select(key), key, "left_anti")


#: Bytes of a table, as the planner knows them, up to which a join may broadcast it.
BROADCAST_BYTES = 128 << 20


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """df, marked for broadcasting if the planner's size of it is at most BROADCAST_BYTES; else joins shuffle."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def id_lists(pairs: DataFrame, population: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """One row per member of the population: its distinct values sorted and comma-joined, '' where it has none."""
    lists = pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias(out))
    return population.select(key).distinct().join(lists, key, "left").select(key, F.coalesce(out, F.lit("")).alias(out))
