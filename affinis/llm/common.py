"""What the operators of this subpackage share: table access, shared-folder tables and connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset a local session gets a temporary one, and any other an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="affinis-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/affinis/{label}-{uuid.uuid4().hex}"


#: Paths of the tables that written() made and that nothing has removed yet, in order.
_paths: list[str] = []


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written_so_far() -> int:
    """A mark for forget_since()."""
    return len(_paths)


def forget_since(spark: SparkSession, mark: int, *kept: DataFrame) -> None:
    """Deletes the tables made by written() since a mark, but those kept: for a caller whose results no longer need them."""
    files = [file for df in kept for file in df.inputFiles()[:1]]
    for path in _paths[mark:]:
        if not any(path.rsplit("/", 1)[-1] in file for file in files):
            _remove(spark, path)
            _paths.remove(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, and is computed once however often it is read.

    The files outlive any executor, so a lost one costs only the tasks it was running.
    """
    path = shared_path(df.sparkSession, label)
    _paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a table made by written() that no live plan reads any more."""
    for file in df.inputFiles()[:1]:
        for path in [p for p in _paths if p.rsplit("/", 1)[-1] == file.rsplit("/", 2)[-2]]:
            _remove(df.sparkSession, path)
            _paths.remove(path)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row but maps and variants: rows alike in all columns have the same."""
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return F.xxhash64(*(F.col(f"`{name}`") for name, kind in kinds if "map<" not in kind and "variant" not in kind))


def without_rows(df: DataFrame, gone: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """df without the rows whose row_hash is in gone (hash); of rows alike whose hash is in repeated (hash) one stays.

    Both are written tables, so that Spark knows their size and broadcasts them only if small. Columns of any name stay.
    """
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), row_hash(df).alias("hash"))
    rows = rows.join(gone, "hash", "left_anti")
    if repeated is not None and not repeated.isEmpty():
        rows = rows.join(repeated, "hash", "left_anti").unionByName(rows.join(repeated, "hash", "left_semi").dropDuplicates(["hash"]))
    return rows.select("row.*")


#: Rows of one key that stay together at least, and the share of all rows that makes a key heavy.
HEAVY_ROWS, HEAVY_SHARE = 500, 0.001


def heavy_keys(many: DataFrame, key: str) -> DataFrame:
    """(key, _parts) of the keys that have over HEAVY_SHARE of the rows of many, at most 1 / HEAVY_SHARE of them: how many tasks each needs."""
    limit = max(HEAVY_ROWS, int(many.count() * HEAVY_SHARE))
    parts = many.groupBy(key).agg(F.ceil(F.count("*") / limit).cast("int").alias("_parts")).where("_parts > 1")
    return many.sparkSession.createDataFrame(parts.collect(), parts.schema)


def salted_join(many: DataFrame, one: DataFrame, key: str, heavy: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """many joined with one (a row per key) on a column; the rows of heavy keys are dealt to several tasks by the hash of ``by``.

    heavy comes from heavy_keys and is broadcast; of one only the rows of heavy keys are repeated, once per part.
    """
    if heavy.isEmpty():
        return many.join(one, key)
    marked = many.join(F.broadcast(heavy), key, "left")
    salted = marked.withColumn("_salt", F.when(F.col("_parts") > 1, F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int")).otherwise(0)).drop("_parts")
    spread = one.join(F.broadcast(heavy), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return salted.join(spread, [key, "_salt"]).drop("_salt")


def tokenizer_file(path: str) -> str:
    """The tokenizer file on this machine: the path itself, or where a worker has the public tokenizers elsewhere, its own file of that name."""
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(os.path.basename(path))


#: What releases the caches of the operator that this Python worker served last, and that operator.
_held: list = []


def holding(owner: str, release: Callable[[], None]) -> None:
    """Says at a task's start that owner's caches fill from now on: those of another operator that this worker served before are
    released, and memory that is free within the process goes back to the machine."""
    if _held and _held[0] != owner:
        _held[1]()
        gc.collect()
    _held[:] = owner, release
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def give_back(spark: SparkSession) -> None:
    """Lets the executors' JVMs collect their garbage, so that heap that the work before has touched goes back to the machine and Python
    workers have room: one short task a core, as a scheduler deals them to all that are free."""
    cores = spark.sparkContext.defaultParallelism
    collected = F.reflect(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, cores, 1, cores).select(collected.alias("collected")).write.format("noop").mode("overwrite").save()


#: Edges of which a task makes a spanning forest.
FOREST_ROWS = 250_000


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (a, b) of a spanning forest of a partition's edges."""
    held = [np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1) for batch in batches if batch.num_rows]
    if not held:
        return
    edges = np.concatenate(held)
    nodes, ends = np.unique(edges, return_inverse=True)
    root, kept = list(range(len(nodes))), np.zeros(len(edges), bool)
    for k, (a, b) in enumerate(ends.reshape(-1, 2).tolist()):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a != b:
            root[max(a, b)] = min(a, b)
            kept[k] = True
    yield pa.record_batch([pa.array(edges[kept, side]) for side in (0, 1)], ["lo", "hi"])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of edges (a long, b long): (node, component), component the smallest node reachable.

    Alternating large-star and small-star steps; every step is a grouped minimum (combined before its shuffle) and an
    equi-join, so no component is ever gathered in one place. Before, parts of FOREST_ROWS edges each are cut to spanning forests,
    as groups of copies come with many times the edges that connect them. Each round is written to the shared folder; the number of
    rounds grows with the logarithm of the largest component. Nodes without edges do not appear; loops are ignored.
    """
    all_edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), label
    )
    parts = -(-all_edges.count() // FOREST_ROWS)
    now = written(all_edges.repartition(max(1, parts)).mapInArrow(_spanning, "lo long, hi long"), label)
    forget(all_edges)
    mark = None
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        small = small.union(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).where("lo <> hi")
        after = written(small.select("lo", "hi").distinct(), label)
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        forget(now)
        now = after
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
