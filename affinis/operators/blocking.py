"""Candidate generation: blocking keys, postings with a cap on block size, and the best candidates by shared keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.phonetic import metaphone_keys, soundex_key
from affinis.functions.text import tokens
from affinis.operators.overlap import best_overlaps
from affinis.operators.relational import split_sources
from affinis.operators.words import record_words

#: Families that need no Python worker, and all of them.
CATALYST = ("n", "ph", "pfx", "addr", "sph", "tok", "bg", "an")
FAMILIES = (*CATALYST, "mph")


def _prefixed(prefix: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(prefix), v))


def keyed(named: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """(entity_id, key) of (entity_id, norm_name, norm_address), batch or stream."""
    return keyed_sets(named, families).select("entity_id", F.explode("keys").alias("key"))


def keyed_sets(named: DataFrame, families: Sequence[str] = FAMILIES, hashed: bool = False) -> DataFrame:
    """(entity_id, keys) of (entity_id, norm_name, norm_address): every row's distinct keys, or their 64-bit hashes."""
    name = F.coalesce("norm_name", F.lit(""))
    words = tokens(name)
    parts = named.select("entity_id", name.alias("name"), words.alias("words"), F.slice(words, 1, 10).alias("head"), tokens(F.col("norm_address")).alias("places"))
    keys = blocking_keys(F.col("name"), F.col("words"), F.col("head"), F.col("places"), families, hashed)
    return parts.select("entity_id", keys.alias("keys"))


def blocking_keys(name: Column, words: Column, head: Column, places: Column, families: Sequence[str] = FAMILIES, hashed: bool = False, addr: Column | None = None) -> Column:
    """The distinct blocking keys (or their 64-bit hashes) of a normalised name, its words, the first ten of them, and the words of the address.

    With ``addr``, the hashes of all address words that are keys, ``places`` needs the first two of these words and the first two numbers only.
    """
    is_number = lambda w: ~((w >= "a") & (w < "{")) & w.rlike(r"^\p{Nd}+$")  # noqa: E731  what begins with a letter of a-z needs no pattern
    distinctive = F.filter(places, lambda w: (F.length(w) >= 4) & ~is_number(w))
    none = F.array().cast("array<string>")
    made: dict[str, Column] = {}
    sorted_name = lambda n: F.array_join(F.array_sort(F.slice(words, 1, n)), "_")
    made["n"] = (
        F.when(F.size(words) >= 3, F.array(F.concat(F.lit("n3:"), sorted_name(3))))
        .when(F.size(words) == 2, F.array(F.concat(F.lit("n2:"), sorted_name(2))))
        .otherwise(none)
    )
    sounds = F.array_remove(F.transform(F.slice(words, 1, 3), soundex_key), "")
    made["ph"] = F.when(F.size(sounds) >= 2, F.array(F.concat(F.lit("ph:"), F.array_join(F.slice(sounds, 1, 2), "_")))).otherwise(none)
    made["pfx"] = (
        F.when(F.length(name) >= 5, F.array(F.concat(F.lit("pfx:"), F.substring(name, 1, 5))))
        .when(F.length(name) >= 3, F.array(F.concat(F.lit("pfx:"), F.substring(name, 1, 3))))
        .otherwise(none)
    )
    if hashed:
        made["addr"] = F.transform(distinctive, lambda w: F.xxhash64(F.lit("addr:"), w)) if addr is None else addr
    else:
        made["addr"] = _prefixed("addr:", distinctive)
    made["sph"] = _prefixed("sph:", F.array_remove(F.transform(words, soundex_key), ""))
    made["tok"] = _prefixed("tok:", F.filter(head, lambda w: F.length(w) >= 4))
    made["bg"] = F.flatten(
        F.transform(
            head,
            lambda w, i: F.transform(
                F.slice(head, i + 2, 3), lambda v: F.concat(F.lit("bg:"), F.least(w, v), F.lit("_"), F.greatest(w, v))
            ),
        )
    )
    numbers = F.slice(F.filter(places, is_number), 1, 2)
    two = F.array(F.slice(distinctive, 1, 2))  # a lambda's variable is computed once, a column within a lambda for every number
    made["an"] = F.flatten(F.flatten(F.transform(two, lambda ws: F.transform(numbers, lambda n: F.transform(ws, lambda w: F.concat(F.lit("an:"), n, F.lit("_"), w))))))
    if "mph" in families:
        made["mph"] = _prefixed("mph:", metaphone_keys(words))
    every = F.concat(none, *(made[f] for f in families if not (hashed and f == "addr")))
    if not hashed:
        return F.array_distinct(every)
    every = F.transform(every, lambda key: F.xxhash64(key))
    return F.array_distinct(F.concat(made["addr"], every) if "addr" in families else every)


def entity_keys(entities: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """(entity_id, key): every record's keys, from norm_name and norm_address."""
    return keyed(entities, families).distinct()


def capped_postings(keys: DataFrame, max_block_size: int = 2500) -> DataFrame:
    """Keys of at most max_block_size records; larger blocks say little and are left out, as the operator defines."""
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= max_block_size)
    return keys.join(sizes.select("key"), "key", "left_semi").select("entity_id", "key")


def candidates(s1_keys: DataFrame, postings: DataFrame, top_k: int = 100) -> DataFrame:
    """(s1_id, s23_id, overlap): of each S1 record the top_k records by shared keys, ties to the smaller id."""
    sets = (df.groupBy("entity_id").agg(F.collect_set(F.xxhash64("key")).alias("keys")) for df in (s1_keys, postings))
    return best_overlaps(*sets, top_k)


def key_sets(entities: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """(entity_id, keys): 64-bit hashes of every record's keys; the rows of a repeated id are taken together."""
    return _one_each(keyed_sets(entities, families, hashed=True), entities)


def text_key_sets(texts: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """key_sets() of document records, from (entity_id, text) and without records: the words of addresses never leave Arrow batches."""
    name = F.coalesce("norm_name", F.lit(""))
    parts = record_words(texts, "text").select("entity_id", name.alias("name"), tokens(name).alias("words"), "places", "addr")
    keys = blocking_keys(F.col("name"), F.col("words"), F.slice("words", 1, 10), F.col("places"), families, True, F.col("addr"))
    return _one_each(parts.select("entity_id", keys.alias("keys")), texts)


def _one_each(sets: DataFrame, entities: DataFrame) -> DataFrame:
    """A row an id of (entity_id, keys), which entities have been made into."""
    if entities.groupBy("entity_id").count().where("count > 1").isEmpty():
        return sets
    return sets.groupBy("entity_id").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))


def block(entities: DataFrame, max_block_size: int = 2500, top_k: int = 100, families: Sequence[str] = FAMILIES) -> DataFrame:
    """Candidates of all S1 records among those of S2 and S3; larger blocks are left out, as by capped_postings."""
    s1, s23 = split_sources(entities)
    return best_overlaps(key_sets(s1, families), key_sets(s23, families), top_k, max_block_size)


def block_texts(texts: DataFrame, max_block_size: int = 2500, top_k: int = 100, families: Sequence[str] = FAMILIES) -> DataFrame:
    """block() of document records, from (entity_id, text)."""
    s1, s23 = split_sources(texts)
    return best_overlaps(text_key_sets(s1, families), text_key_sets(s23, families), top_k, max_block_size)


def blocking_stats(found: DataFrame, population: DataFrame) -> DataFrame:
    """(n_s1, n_with_candidates, mean_candidates) over the whole population (s1_id)."""
    counts = population.select("s1_id").join(found.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left")
    return counts.agg(F.count("*").alias("n_s1"), F.count("n").alias("n_with_candidates"), (F.coalesce(F.sum("n"), F.lit(0)) / F.count("*")).alias("mean_candidates"))
