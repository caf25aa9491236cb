"""Training and inference from files, and the command line."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.config import Config, load_config
from affinis.functions.text import normalize_unicode
from affinis.operators import blocking, evaluate, features, model, sampling, validate
from affinis.operators.relational import first_by_key, split_sources
from affinis.session import session, ship
from affinis.schema import CANDIDATES, TRUTH
from affinis.sources import tsv
from affinis.sources.cache import cached
from affinis.sources.shared import stored

#: The columns of result files.
TSV_COLUMNS = {"matching": TRUTH.names, "candidate": CANDIDATES.names}


def normalized(records: DataFrame) -> DataFrame:
    """Records, one per id, with norm_name and norm_address."""
    one = first_by_key(records, "entity_id", *records.columns)
    return one.withColumns({"norm_name": normalize_unicode("business_name"), "norm_address": normalize_unicode("business_address")})


def read_records(spark: SparkSession, folder: str, prefix: str, cache: str | None = None) -> DataFrame:
    """The normalised records of the three source files of a folder."""
    sources = [tsv.read_source(spark, f"{folder}/{prefix}_source{k}.tsv") for k in (1, 2, 3)]
    records = sources[0].unionByName(sources[1]).unionByName(sources[2])
    return cached(records, cache, "normalized", normalized) if cache else stored(normalized(records), "records")


def feature_table(records: DataFrame, found: DataFrame, config: Config) -> DataFrame:
    """Features of candidates."""
    return features.pair_features(found, records, config.features.tfidf_max_features)


def train(spark: SparkSession, config: Config) -> dict[str, float]:
    """Trains on a folder with truth, writes model and threshold, and returns what was measured on the validation records."""
    records = read_records(spark, config.paths.train_dir, "train")
    truth, population = tsv.read_truth(spark, f"{config.paths.train_dir}/train_ground_truth.tsv")
    found = stored(blocking.block(records, config.blocking.max_block_size, config.blocking.top_k_per_entity), "candidates")
    recall = evaluate.blocking_recall(found, truth).first().recall
    table = features.with_labels(feature_table(records, found, config), truth)
    split = stored(sampling.grouped_split(table, config.seed, config.training.val_size, config.training.val_min_entities), "split")
    kept = sampling.subsample_negatives(split.where("not validation"), config.training.neg_sample_ratio, config.seed)
    fitted = model.train_model(kept.unionByName(split.where("validation")), rounds=config.model.n_estimators, rate=config.model.learning_rate, leaves=config.model.num_leaves, min_rows=config.model.min_child_samples, seed=config.seed, positive_weight=config.model.scale_pos_weight)
    scored = stored(model.score_pairs(split.where("validation"), fitted).select("s1_id", "s23_id", "proba"), "scored")
    validated = scored.select("s1_id").distinct()
    own = truth.join(validated, "s1_id", "left_semi")
    t = config.threshold
    tau, cap, best = evaluate.best_threshold(evaluate.threshold_sweep(scored, own, validated, evaluate.tau_grid(t.min_tau, t.max_tau, t.step)))
    model.save_model(fitted, config.paths.artifacts_dir, tau, cap)
    whole = evaluate.f05_macro(evaluate.cap_matches(scored, tau, cap), own, validated).first().f05
    return {"blocking_recall": recall, "tau": tau, "f05_validation": best, "f05_at_tau": whole}


def infer(spark: SparkSession, config: Config, cap: int | None = None) -> DataFrame:
    """Links the records of a folder by the stored model; writes candidates and matches, and returns the findings of the checks."""
    fitted, tau, best = model.load_model(config.paths.artifacts_dir)
    records = read_records(spark, config.paths.test_dir, "test")
    population = split_sources(records)[0].select(F.col("entity_id").alias("s1_id"))
    found = stored(blocking.block(records, config.blocking.max_block_size, config.blocking.top_k_per_entity), "candidates")
    out = config.paths.output_dir
    tsv.write_candidate_pairs(found, population, f"{out}/candidate_pairs.tsv")
    scored = model.score_pairs(feature_table(records, found, config), fitted)
    matches = evaluate.cap_matches(scored, tau, cap or best)
    tsv.write_matching_results(matches, population, f"{out}/matching_results.tsv")
    return check_files(spark, f"{out}/matching_results.tsv", f"{out}/candidate_pairs.tsv", population, split_sources(records)[1])


def check_files(spark: SparkSession, matching: str, candidate: str | None, population: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(file, level, rule, subject): what is wrong with result files; only errors make them invalid, warnings do not."""
    notes, found, parsed = [], [], {}
    for name, path, columns in (("matching", matching, TSV_COLUMNS["matching"]), ("candidate", candidate, TSV_COLUMNS["candidate"])):
        if path is None or name == "candidate" and not tsv.exists(spark, path):
            notes.append((name, "warning", "file_absent", path or ""))
            continue
        if not tsv.exists(spark, path):
            notes.append((name, "error", "file_absent", path))
            continue
        header, lines = tsv.result_lines(spark, path)
        wrong = validate.header_errors(header, columns)
        notes += [(name, "error", "header", x) for x in wrong]
        if wrong:
            continue
        parsed[name] = validate.parse_lines(lines)
        own = validate.find_errors(parsed[name], population, targets).unionByName(validate.encoding_errors(spark.read.text(path)))
        found.append(own.select(F.lit(name).alias("file"), F.lit("error").alias("level"), "rule", "subject"))
    if len(parsed) == 2:
        unmatched = validate.unmatched_candidates(parsed["matching"], parsed["candidate"])
        found.append(unmatched.select(F.lit("matching").alias("file"), F.lit("warning").alias("level"), F.lit("no_candidate").alias("rule"), F.col("s1_id").alias("subject")))
    if targets is None:
        notes.append(("", "warning", "ids_unchecked", "no records of S2 and S3 were given"))
    out = spark.createDataFrame(notes, "file string, level string, rule string, subject string")
    for part in found:
        out = out.unionByName(part)
    return out


def validate_main(argv: list[str] | None = None) -> int:
    """affinis-validate: checks result files against the S1 records of a folder; 1 if there are errors."""
    parser = argparse.ArgumentParser(description="Check result files.")
    parser.add_argument("--matching", required=True)
    parser.add_argument("--candidate")
    parser.add_argument("--test-dir", required=True)
    parser.add_argument("--check-ids", action="store_true")
    args = parser.parse_args(argv)
    spark = ship(session())
    ids = [tsv.read_ids(spark, path) if tsv.exists(spark, path := f"{args.test_dir}/test_source{k}.tsv") else None for k in (1, 2, 3)]
    if ids[0] is None:
        print(f"error: {args.test_dir} has no test_source1.tsv")
        return 1
    known = [x for x in ids[1:] if x is not None] if args.check_ids else []
    if args.check_ids and len(known) < 2:
        print("warning: ids are checked only against the sources that are there")
    targets = known[0].union(known[1]) if len(known) == 2 else known[0] if known else None
    found = check_files(spark, args.matching, args.candidate, ids[0].withColumnRenamed("entity_id", "s1_id"), targets)
    found = stored(found, "findings")
    for row in found.groupBy("level", "file", "rule").agg(F.count("*").alias("n"), F.min("subject").alias("first")).orderBy("level", "file", "rule").collect():
        print(f"{row.level}: {row.file} {row.rule}: {row.n}, first {row['first']!r}")
    return int(not found.where("level = 'error'").isEmpty())


def dev_cohort(spark: SparkSession, config: Config, n: int = 1000) -> None:
    """Writes a self-consistent sample of the training folder to the artifacts folder."""
    folder = config.paths.train_dir
    sources = [tsv.read_source(spark, f"{folder}/train_source{k}.tsv") for k in (1, 2, 3)]
    truth, population = tsv.read_truth(spark, f"{folder}/train_ground_truth.tsv")
    records, own = sampling.dev_cohort(sources[0].unionByName(sources[1]).unionByName(sources[2]), truth, population, n, config.seed)
    out = f"{config.paths.artifacts_dir}/dev_cohort"
    for k in (1, 2, 3):
        tsv.write_source(records.where(F.col("entity_id").startswith(f"S{k}-")), f"{out}/train_source{k}.tsv")
    chosen = records.where(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("s1_id"))
    tsv.write_id_lists(own, chosen, f"{out}/train_ground_truth.tsv", "matched_entity_ids")


def main(argv: list[str] | None = None) -> None:
    """affinis.plans.linkage --stage all|train|infer|dev_cohort, or validate with the options of validate_main."""
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["validate"]:
        sys.exit(validate_main(argv[1:]))
    parser = argparse.ArgumentParser(description="Link business records of three sources.")
    parser.add_argument("--stage", choices=("all", "train", "infer", "dev_cohort"), default="all")
    parser.add_argument("--dev-size", type=int, default=1000)
    parser.add_argument("--config")
    args = parser.parse_args(argv)
    config = load_config(args.config)
    spark = ship(session())
    if args.stage == "dev_cohort":
        dev_cohort(spark, config, args.dev_size)
        config = replace(config, paths=replace(config.paths, train_dir=f"{config.paths.artifacts_dir}/dev_cohort"))
    if args.stage in ("all", "train", "dev_cohort"):
        print(train(spark, config))
    if args.stage in ("all", "infer"):
        infer(spark, config).orderBy("level", "rule", "subject").show(100, truncate=False)


if __name__ == "__main__":
    main()
