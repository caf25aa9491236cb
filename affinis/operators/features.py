"""The pairwise similarity features, computed for candidate pairs in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions import similarity as sim
from affinis.functions.phonetic import metaphone_code
from affinis.functions.text import tokens
from affinis.operators.embedding import Encoder, encode, hashed_encoder, needed, pair_cosine
from affinis.operators.overlap import shared_elements
from affinis.operators.relational import broadcast_if_small, split_sources
from affinis.operators.tfidf import fit_tfidf, tfidf_similarity
from affinis.sources.shared import stored

#: Names and order that a model's input has (fixed values).
FEATURES = (
    "jaccard_name", "jaccard_addr", "levenshtein_name", "levenshtein_addr", "jaro_winkler_name", "jaro_winkler_addr",
    "overlap_name", "overlap_addr", "overlap_ratio_name", "overlap_ratio_addr", "len_ratio_name", "len_ratio_addr",
    "prefix_match_3", "prefix_match_5", "exact_name_match", "exact_addr_match", "country_match", "tfidf_sim",
    "emb_name_cos", "emb_addr_cos", "soundex_name_match", "metaphone_name_match", "numeric_addr_match",
    "token_sort_ratio_name", "containment_name", "containment_addr",
)


def joined_pairs(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """pairs with both records' name, address, country and words (a_.. of S1, b_.. of the other); pairs of unknown ids are dropped."""
    for side, key in (("a", "s1_id"), ("b", "s23_id")):
        record = entities.select(
            F.col("entity_id").alias(key),
            F.coalesce("norm_name", F.lit("")).alias(f"{side}_name"),
            F.coalesce("norm_address", F.lit("")).alias(f"{side}_addr"),
            F.lower(F.trim(F.coalesce("country", F.lit("")))).alias(f"{side}_country"),
            tokens(F.col("norm_name")).alias(f"{side}_name_words"),  # split once a record, not once a pair
            tokens(F.col("norm_address")).alias(f"{side}_addr_words"),
        )
        pairs = pairs.join(broadcast_if_small(record), key)
    return pairs


def _first_alphabetic(words: Column) -> Column:
    """The smallest word if it is all letters, else null."""
    least = F.array_min(words)
    return F.when(least.rlike(r"^\p{L}+$"), least)


def catalyst_features() -> dict[str, Column]:
    """Features of joined pairs that need no Python worker."""
    out = {}
    for c in ("name", "addr"):
        a, b = F.col(f"a_{c}_words"), F.col(f"b_{c}_words")
        out |= {
            f"jaccard_{c}": sim.jaccard(a, b), f"overlap_{c}": sim.overlap(a, b), f"overlap_ratio_{c}": sim.overlap_ratio(a, b),
            f"containment_{c}": sim.containment(a, b), f"len_ratio_{c}": sim.length_ratio(F.col(f"a_{c}"), F.col(f"b_{c}")),
            f"exact_{c}_match": sim.exact_match(F.col(f"a_{c}"), F.col(f"b_{c}")),
        }
    for n in (3, 5):
        out[f"prefix_match_{n}"] = sim.prefix_match(F.col("a_name"), F.col("b_name"), n)
    out["country_match"] = sim.exact_match(F.col("a_country"), F.col("b_country"))
    out["numeric_addr_match"] = sim.numeric_match(F.col("a_addr_words"), F.col("b_addr_words"))
    a, b = _first_alphabetic(F.col("a_name_words")), _first_alphabetic(F.col("b_name_words"))
    out["soundex_name_match"] = F.when(F.soundex(a) == F.soundex(b), 1.0).otherwise(0.0)
    return out


def arrow_features() -> dict[str, Column]:
    """Features of joined pairs by Arrow functions."""
    out = {}
    for c in ("name", "addr"):
        a, b = F.col(f"a_{c}"), F.col(f"b_{c}")
        out |= {f"levenshtein_{c}": sim.indel_ratio(a, b), f"jaro_winkler_{c}": sim.jaro_winkler(a, b)}
    out["token_sort_ratio_name"] = sim.token_sort_ratio(F.col("a_name_words"), F.col("b_name_words"))
    a, b = _first_alphabetic(F.col("a_name_words")), _first_alphabetic(F.col("b_name_words"))
    same = metaphone_code(a) == metaphone_code(b)
    out["metaphone_name_match"] = F.when(a.isNotNull() & b.isNotNull() & same, 1.0).otherwise(0.0)
    return out


#: Features of joined pairs that shared_word_features gives from counts of shared words instead.
WORD_FEATURES = ("jaccard_name", "jaccard_addr", "overlap_name", "overlap_addr", "overlap_ratio_name", "overlap_ratio_addr", "containment_name", "containment_addr", "numeric_addr_match")


def shared_word_counts(pairs: DataFrame, entities: DataFrame, numbers: bool = False) -> DataFrame:
    """pairs with how many words (64-bit hashes) both records share and have, for name, addr and num (numbers of the address); ids must not repeat."""
    hashed = lambda words: F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))
    places = tokens(F.col("norm_address"))
    made = {"name": hashed(tokens(F.col("norm_name"))), "addr": hashed(places)}
    if numbers:
        made["num"] = hashed(F.filter(places, lambda w: w.rlike(r"^\p{Nd}+$")))
    sides = (side.select("entity_id", *(c.alias(n) for n, c in made.items())) for side in split_sources(entities))
    return shared_elements(pairs.select("s1_id", "s23_id"), *sides, list(made))


def shared_word_features(numbers: bool = False) -> dict[str, Column]:
    """WORD_FEATURES from the columns of shared_word_counts, by the same arithmetic as from joined pairs."""
    out = {}
    for c in ("name", "addr"):
        shared, a, b = (F.col(f"{c}_{x}").cast("double") for x in ("shared", "a", "b"))
        union, least = a + b - shared, F.least(a, b)
        out |= {
            f"jaccard_{c}": F.when(union == 0, 1.0).otherwise(shared / F.nullif(union, F.lit(0.0))),
            f"overlap_{c}": shared,
            f"overlap_ratio_{c}": F.when(least == 0, 0.0).otherwise(shared / F.nullif(least, F.lit(0.0))),
            f"containment_{c}": F.when(a == 0, F.when(b == 0, 1.0).otherwise(0.0)).otherwise(shared / F.nullif(a, F.lit(0.0))),
        }
    if numbers:
        shared, a, b = (F.col(f"num_{x}").cast("double") for x in ("shared", "a", "b"))
        out["numeric_addr_match"] = F.when((a == 0) | (b == 0), 0.0).otherwise(shared / F.nullif(F.greatest(a, b), F.lit(0.0)))
    return out


def joined_short(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """pairs with both records' name, country, words of the name, and length and 64-bit hash of the address."""
    for side, key in (("a", "s1_id"), ("b", "s23_id")):
        address = F.coalesce("norm_address", F.lit(""))
        record = entities.select(
            F.col("entity_id").alias(key),
            F.coalesce("norm_name", F.lit("")).alias(f"{side}_name"),
            F.lower(F.trim(F.coalesce("country", F.lit("")))).alias(f"{side}_country"),
            tokens(F.col("norm_name")).alias(f"{side}_name_words"),
            F.length(address).alias(f"{side}_addr_length"),
            F.xxhash64(address).alias(f"{side}_addr_hash"),
        )
        pairs = pairs.join(record, key)
    return pairs


def short_features() -> dict[str, Column]:
    """Features of pairs from joined_short that do not come from shared words."""
    made = catalyst_features()
    out = {n: made[n] for n in ("len_ratio_name", "exact_name_match", "prefix_match_3", "prefix_match_5", "country_match", "soundex_name_match")}
    a, b = (F.col(f"{s}_addr_length") for s in "ab")
    longer = F.greatest(a, b).cast("double")
    out["len_ratio_addr"] = F.when(longer == 0, 1.0).otherwise(F.least(a, b) / F.nullif(longer, F.lit(0.0)))
    out["exact_addr_match"] = F.when((a == b) & (a > 0) & (F.col("a_addr_hash") == F.col("b_addr_hash")), 1.0).otherwise(0.0)
    return out


def pair_features(pairs: DataFrame, entities: DataFrame, max_features: int = 100_000, encoder: Encoder = hashed_encoder) -> DataFrame:
    """(s1_id, s23_id, the 26 features) of candidate pairs, which are stored once, as six steps read them."""
    pairs = stored(pairs.select("s1_id", "s23_id"), "pairs")
    used = entities.join(
        pairs.select(F.col("s1_id").alias("entity_id")).union(pairs.select("s23_id")).distinct(), "entity_id", "left_semi"
    )
    base = joined_pairs(pairs.select("s1_id", "s23_id"), used).withColumns(catalyst_features() | arrow_features())
    texts = entities.select(F.col("entity_id").alias("eid"), tokens(F.col("norm_name")).alias("words"))
    base = base.join(tfidf_similarity(pairs, fit_tfidf(texts, max_features)), ["s1_id", "s23_id"])
    for column, out in (("norm_name", "emb_name_cos"), ("norm_address", "emb_addr_cos")):
        text = needed(entities.select(F.col("entity_id").alias("eid"), F.col(column).alias("text")), pairs)
        base = pair_cosine(base, encode(text, encoder), out)
    return base.select("s1_id", "s23_id", *FEATURES)


def with_labels(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 where (s1_id, s23_id) is in truth, else 0."""
    marked = truth.select("s1_id", "s23_id").distinct().withColumn("_true", F.lit(1))
    return pairs.join(marked, ["s1_id", "s23_id"], "left").withColumn("label", F.coalesce("_true", F.lit(0))).drop("_true")
