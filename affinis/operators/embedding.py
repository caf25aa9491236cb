"""Vectors of texts: a pluggable encoder, an incremental cache, and cosines of pairs.

No pretrained encoder comes with this library. hashed_encoder is a stand-in that hashes character n-grams; it is not a
multilingual sentence model. Any function from a list of texts to a matrix can take its place.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.similarity import cosine

Encoder = Callable[[list[str]], np.ndarray]


def hashed_encoder(texts: list[str], width: int = 64) -> np.ndarray:
    """Unit vectors of hashed character trigrams."""
    out = np.zeros((len(texts), width), "f4")
    for row, text in zip(out, texts):
        padded = f"  {text} "
        for k in range(len(padded) - 2):
            code = zlib.crc32(padded[k : k + 3].encode())
            row[code % width] += 1 if code & 65536 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def encode(texts: DataFrame, encoder: Encoder = hashed_encoder, batch: int = 128) -> DataFrame:
    """(eid, vector) of (eid, text), in batches of fixed size."""

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                vectors = encoder(part["text"].fillna("").tolist())
                yield pd.DataFrame({"eid": part["eid"], "vector": [v.astype("f4") for v in vectors]})

    return texts.select("eid", "text").mapInPandas(encoded, "eid string, vector array<float>")


def encode_missing(texts: DataFrame, cache: DataFrame, encoder: Encoder = hashed_encoder) -> DataFrame:
    """Vectors of texts: those in the cache (key, vector; key the SHA-256 of the text), and new ones only for the others."""
    keyed = texts.select("eid", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.sha2("text", 256))
    known = keyed.join(cache, "key").select("eid", "vector")
    return known.unionByName(encode(keyed.join(cache.select("key"), "key", "left_anti"), encoder))


def stored_vectors(texts: DataFrame, folder: str, name: str, encoder: Encoder = hashed_encoder) -> DataFrame:
    """(eid, vector) of texts through the stored cache of an encoder: texts that it lacks are encoded, once each, and appended to it.

    The cache is a Parquet folder below ``folder`` named after the encoder, keyed by the SHA-256 of the text, so neither another
    encoder nor a changed text ever meets a wrong vector.
    """
    spark, path, schema = texts.sparkSession, f"{folder}/vectors-{name}", "key string, vector array<float>"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    keyed = texts.select("eid", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.sha2("text", 256))
    lacking = keyed.select(F.col("key").alias("eid"), "text").dropDuplicates(["eid"])
    if known:
        lacking = lacking.join(spark.read.schema(schema).parquet(path).select(F.col("key").alias("eid")), "eid", "left_anti")
    encode(lacking, encoder).withColumnRenamed("eid", "key").write.mode("append").parquet(path)
    return keyed.join(spark.read.schema(schema).parquet(path), "key").select("eid", "vector")


def needed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of (eid, ..) that take part in pairs: only they are encoded."""
    ids = pairs.select(F.col("s1_id").alias("eid")).union(pairs.select("s23_id")).distinct()
    return texts.join(ids, "eid", "left_semi")


def pair_cosine(pairs: DataFrame, vectors: DataFrame, out: str) -> DataFrame:
    """pairs with the cosine of both vectors; missing ones 0."""
    left = vectors.select(F.col("eid").alias("s1_id"), F.col("vector").alias("_a"))
    right = vectors.select(F.col("eid").alias("s23_id"), F.col("vector").alias("_b"))
    return pairs.join(left, "s1_id", "left").join(right, "s23_id", "left").withColumn(out, cosine(F.col("_a"), F.col("_b"))).drop("_a", "_b")
