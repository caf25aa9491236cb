"""Metrics over S1 populations and the threshold sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.operators.relational import top_per_group


def tau_grid(least: float = 0.3, most: float = 0.99, step: float = 0.01) -> list[float]:
    """The thresholds of a sweep, rounded to four digits."""
    return [round(least + k * step, 4) for k in range(int(round((most - least) / step)) + 1)]


def f05(n_pred: Column, n_true: Column, n_tp: Column) -> Column:
    """F0.5 of one record: both empty 1, one empty 0."""
    precision, recall = n_tp / F.nullif(n_pred, F.lit(0)), n_tp / F.nullif(n_true, F.lit(0))
    score = 1.25 * precision * recall / F.nullif(0.25 * precision + recall, F.lit(0.0))
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0) | (n_tp == 0), 0.0).otherwise(score)


def record_counts(predictions: DataFrame, truth: DataFrame, population: DataFrame) -> DataFrame:
    """(s1_id, n_pred, n_true, n_tp) of every record of the population; predictions for others are ignored."""
    pred = predictions.select("s1_id", "s23_id").distinct().withColumn("p", F.lit(1))
    true = truth.select("s1_id", "s23_id").distinct().withColumn("t", F.lit(1))
    per_pair = pred.join(true, ["s1_id", "s23_id"], "full")
    per_record = per_pair.groupBy("s1_id").agg(F.count("p").alias("n_pred"), F.count("t").alias("n_true"), F.count(F.col("p") + F.col("t")).alias("n_tp"))
    filled = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_pred", "n_true", "n_tp")}
    return population.select("s1_id").distinct().join(per_record, "s1_id", "left").withColumns(filled)


def f05_macro(predictions: DataFrame, truth: DataFrame, population: DataFrame) -> DataFrame:
    """(f05): the mean over the population, 0 if that is empty."""
    counts = record_counts(predictions, truth, population)
    return counts.agg(F.coalesce(F.avg(f05(F.col("n_pred"), F.col("n_true"), F.col("n_tp"))), F.lit(0.0)).alias("f05"))


def singleton_accuracy(predictions: DataFrame, truth: DataFrame, population: DataFrame) -> DataFrame:
    """(singleton_acc): of records without true matches the share predicted empty, 1 if there are none."""
    counts = record_counts(predictions, truth, population).where("n_true = 0")
    return counts.agg(F.coalesce(F.avg((F.col("n_pred") == 0).cast("double")), F.lit(1.0)).alias("singleton_acc"))


def blocking_recall(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(n_found, n_true, recall): true pairs among the candidates, 1 without true pairs."""
    true = truth.select("s1_id", "s23_id").distinct()
    marked = true.join(candidates.select("s1_id", "s23_id").distinct().withColumn("c", F.lit(1)), ["s1_id", "s23_id"], "left")
    n = F.count("*")
    return marked.agg(F.count("c").alias("n_found"), n.alias("n_true"), F.coalesce(F.count("c") / F.nullif(n, F.lit(0)), F.lit(1.0)).alias("recall"))


def missed_pairs(candidates: DataFrame, truth: DataFrame, limit: int = 20) -> DataFrame:
    """The first true pairs, by ids, that are no candidates: a report."""
    return truth.join(candidates, ["s1_id", "s23_id"], "left_anti").select("s1_id", "s23_id").orderBy("s1_id", "s23_id").limit(limit)


def inference_stats(predictions: DataFrame, population: DataFrame) -> DataFrame:
    """(n_matched, n_singletons, mean_matches) over the population."""
    counts = population.select("s1_id").distinct().join(predictions.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left")
    return counts.agg(F.count("n").alias("n_matched"), F.count_if(F.col("n").isNull()).alias("n_singletons"), (F.coalesce(F.sum("n"), F.lit(0)) / F.count("*")).alias("mean_matches"))


def cap_matches(scored: DataFrame, tau: float, cap: int | None = None) -> DataFrame:
    """Pairs of at least tau; of each record only the cap likeliest, ties to the smaller id."""
    kept = scored.where(F.col("proba") >= tau)
    return kept if cap is None else top_per_group(kept, "s1_id", cap, F.desc("proba"), "s23_id")


def threshold_sweep(scored: DataFrame, truth: DataFrame, population: DataFrame, grid: Sequence[float], caps: Sequence[int | None] = (None,)) -> DataFrame:
    """(cap, tau, f05, singleton_acc) of every threshold and cap, in one pass over the pairs (a cross join adds a single row of totals).

    scored: (s1_id, s23_id, proba). A pair counts from the largest threshold at or below its probability downwards; what each record
    adds is summed from the top down, the change of its score is added up over records per threshold, and over the at most
    len(grid) thresholds at the end.
    """
    taus = sorted(grid)
    true = truth.select("s1_id", "s23_id").distinct().withColumn("t", F.lit(1))
    n_true = population.select("s1_id").distinct().join(true.groupBy("s1_id").agg(F.count("*").alias("n_true")), "s1_id", "left").select("s1_id", F.coalesce("n_true", F.lit(0)).alias("n_true"))
    # a lambda's variable, so that the score is computed once and not once per threshold
    at = F.get(F.transform(F.array("proba"), lambda p: F.size(F.filter(F.lit(taus), lambda tau: p >= tau)) - 1), F.lit(0))
    rank = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("proba"), "s23_id"))
    placed = scored.select("s1_id", "s23_id", "proba", at.alias("at")).where(F.col("proba") >= taus[0])
    placed = placed.withColumn("rank", rank).join(true, ["s1_id", "s23_id"], "left")
    base = n_true.agg(F.count("*").alias("n"), F.count_if(F.col("n_true") == 0).alias("n_single"))
    spark = scored.sparkSession
    steps = spark.range(len(taus)).select(F.col("id").cast("int").alias("at"), F.get(F.lit(list(taus)), F.col("id").cast("int")).alias("tau"))
    limits = F.array(*(F.lit(cap or 0) for cap in caps))
    kept = placed.withColumn("cap", F.explode(limits)).where((F.col("cap") == 0) | (F.col("rank") <= F.col("cap")))
    added = kept.groupBy("cap", "s1_id", "at").agg(F.count("*").alias("dp"), F.count("t").alias("dt"))
    down = Window.partitionBy("cap", "s1_id").orderBy(F.desc("at"))
    sums = added.withColumns({"n_pred": F.sum("dp").over(down), "n_tp": F.sum("dt").over(down)}).join(n_true, "s1_id")
    score = f05(F.col("n_pred"), F.col("n_true"), F.col("n_tp"))
    empty = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    first = (F.col("n_true") == 0) & (F.col("n_pred") == F.col("dp"))
    changed = sums.withColumn("score", score).select("cap", "at", (F.col("score") - F.coalesce(F.lag("score").over(down), empty)).alias("change"), F.when(first, 1).otherwise(0).alias("lost"))
    per_tau = changed.groupBy("cap", "at").agg(F.sum("change").alias("change"), F.sum("lost").alias("lost"))
    total = Window.partitionBy("cap").orderBy(F.desc("at"))  # one row per threshold
    grid_rows = steps.withColumn("cap", F.explode(limits))
    swept = grid_rows.join(per_tau, ["cap", "at"], "left").withColumns({"c": F.coalesce(F.sum("change").over(total), F.lit(0.0)), "l": F.coalesce(F.sum("lost").over(total), F.lit(0))})
    return swept.crossJoin(base).select(
        F.nullif("cap", F.lit(0)).alias("cap"),
        "tau",
        F.when(F.col("n") == 0, 0.0).otherwise((F.col("n_single") + F.col("c")) / F.nullif("n", F.lit(0))).alias("f05"),
        F.when(F.col("n_single") == 0, 1.0).otherwise(1.0 - F.col("l") / F.nullif("n_single", F.lit(0))).alias("singleton_acc"),
    )


def best_threshold(sweep: DataFrame) -> tuple[float, int | None, float]:
    """(tau, cap, f05) of the best row of a sweep; of equals the smallest tau."""
    row = sweep.orderBy(F.desc(F.round("f05", 12)), "tau", F.asc_nulls_first("cap")).first()
    return (row.tau, row.cap, row.f05) if row else (0.5, None, 0.0)
