"""Character n-gram TF-IDF within words, as a long sparse table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_grams(words: Column, sizes: tuple[int, int] = (3, 4)) -> Column:
    """The n-grams of words padded by a blank on both sides; a padded word no longer than n gives itself once and no longer grams."""

    def of(word: Column, n: int) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
        grams = F.transform(starts, lambda i: F.substring(padded, i, n))
        if n == sizes[0]:
            return grams
        return F.when(F.length(padded) >= n, grams).otherwise(F.array().cast("array<string>"))

    def every(n: int) -> Column:
        return F.transform(words, lambda w: of(w, n))

    return F.flatten(F.concat(*(every(n) for n in range(sizes[0], sizes[1] + 1))))


def fit_tfidf(texts: DataFrame, max_features: int = 100_000) -> DataFrame:
    """(eid, gram, weight): sublinear tf times smoothed idf, each row of unit length.

    texts: (eid, words). The vocabulary is the max_features grams of largest total frequency, ties to the smaller gram; it has a
    fixed bound and so may be broadcast.
    """
    counts = texts.select("eid", F.explode(word_grams(F.col("words"))).alias("gram")).groupBy("eid", "gram").agg(F.count("*").alias("tf"))
    n = texts.agg(F.count("*").alias("n_texts"))
    vocabulary = counts.groupBy("gram").agg(F.sum("tf").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "gram").limit(max_features)
    idf = vocabulary.join(F.broadcast(n)).select("gram", (F.log((1 + F.col("n_texts")) / (1 + F.col("df"))) + 1).alias("idf"))
    weighted = counts.join(idf, "gram").select("eid", "gram", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    norms = weighted.groupBy("eid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "eid").select("eid", "gram", (F.col("w") / F.col("norm")).alias("weight"))


def tfidf_similarity(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """(s1_id, s23_id, tfidf_sim) of pairs: the product of their rows; unknown ids 0.

    Each record's weights are one map, joined once a side, so the pairs are never multiplied by their grams.
    """
    rows = weights.groupBy("eid").agg(F.map_from_entries(F.collect_list(F.struct("gram", "weight"))).alias("row"))
    both = pairs.select("s1_id", "s23_id")
    for key in ("s1_id", "s23_id"):
        both = both.join(rows.select(F.col("eid").alias(key), F.col("row").alias(f"of_{key}")), key, "left")
    products = F.map_values(F.map_zip_with("of_s1_id", "of_s23_id", lambda gram, x, y: F.coalesce(x * y, F.lit(0.0))))
    total = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
    return both.select("s1_id", "s23_id", F.coalesce(total, F.lit(0.0)).alias("tfidf_sim"))
