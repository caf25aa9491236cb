"""Training, inference and checks from files, as a user runs them."""

import random

import pytest
from pyspark.sql import functions as F

from affinis.config import Config, Paths, load_config, merged
from affinis.operators import embedding, model
from affinis.operators.sampling import hash_rank, smallest
from affinis.plans import linkage
from affinis.sources import tsv

HEADER = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Sixty businesses a source; every second one of S1 is in S2, every third in S3 under another spelling."""
    rnd, root = random.Random(4), tmp_path_factory.mktemp("data")
    word = lambda: "".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(4, 8)))
    own = [(f"{word()} {word()} {word()} Ltd", f"{rnd.randint(1, 99)} {word()} street {word()}", "France") for _ in range(60)]
    for part in ("train", "test"):
        (root / part).mkdir()
        lists = []
        rows = {1: [(f"S1-{k}", *r) for k, r in enumerate(own)], 2: [], 3: []}
        for k, (name, address, country) in enumerate(own):
            matched = []
            for source, every in ((2, 2), (3, 3)):
                if k % every == 0:
                    rows[source].append((f"S{source}-{k}", name.replace("Ltd", "limited"), address.replace("street", "st"), country))
                    matched.append(f"S{source}-{k}")
                else:
                    rows[source].append((f"S{source}-{k}", f"{name.split()[0]} {word()}", f"{word()} {word()}", country))
            lists.append(f"S1-{k}\t{','.join(matched)}\n")
        for source, records in rows.items():
            (root / part / f"{part}_source{source}.tsv").write_text(HEADER + "".join("\t".join(r) + "\n" for r in records))
        (root / part / f"{part}_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(lists))
    return root


@pytest.fixture(scope="module")
def config(folder):
    paths = Paths(str(folder / "train"), str(folder / "test"), str(folder / "out"), str(folder / "artifacts"))
    return merged(Config(paths=paths), {"model": {"n_estimators": 4, "min_child_samples": 2, "num_leaves": 8}, "training": {"val_min_entities": 10}})


def test_train_then_infer(spark, config):
    measured = linkage.train(spark, config)
    assert measured["blocking_recall"] == 1.0 and measured["f05_validation"] > 0.8 and measured["f05_at_tau"] == pytest.approx(measured["f05_validation"])
    fitted, tau, cap = model.load_model(config.paths.artifacts_dir)
    assert tau == measured["tau"] and len(model.feature_importance(fitted)) == 26
    findings = linkage.infer(spark, config).collect()
    assert [r for r in findings if r.level == "error"] == [] and all(r.rule != "no_candidate" for r in findings)
    rows = dict(line.value.split("\t") for line in tsv.lines_below(spark, f"{config.paths.output_dir}/matching_results.tsv").collect())
    assert len(rows) == 60
    true = {f"S1-{k}": {f"S{s}-{k}" for s in (2, 3) if k % s == 0} for k in range(60)}
    assert sum(set(filter(None, rows[k].split(","))) == v for k, v in true.items()) >= 48


def test_findings_of_bad_files(spark, folder, tmp_path):
    population = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    good, bad = tmp_path / "good.tsv", tmp_path / "bad.tsv"
    good.write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    bad.write_bytes(b"source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-2\nS1-\xff\tS2-1\nsource1_entity_id\tmatched_entity_ids\n")
    found = {(r.file, r.level, r.rule) for r in linkage.check_files(spark, str(bad), str(good), population).collect()}
    assert {("matching", "warning", "no_candidate"), ("matching", "error", "not_utf8"), ("matching", "error", "missing_s1"), ("matching", "error", "unexpected_s1"), ("", "warning", "ids_unchecked")} <= found
    assert {(r.level, r.rule) for r in linkage.check_files(spark, str(good), None, population).collect()} >= {("error", "header"), ("warning", "file_absent")}
    assert ("error", "file_absent") in {(r.level, r.rule) for r in linkage.check_files(spark, str(tmp_path / "none"), str(good), population).collect()}
    (tmp_path / "empty.tsv").write_text("")
    assert ("error", "header") in {(r.level, r.rule) for r in linkage.check_files(spark, str(tmp_path / "empty.tsv"), None, population).collect()}


def test_validator_exit_codes(spark, folder, capsys):
    truth = str(folder / "test" / "test_ground_truth.tsv")
    assert linkage.validate_main(["--matching", truth, "--test-dir", str(folder / "test"), "--check-ids"]) == 0
    assert linkage.validate_main(["--matching", str(folder / "test" / "test_source1.tsv"), "--test-dir", str(folder / "test")]) == 1
    assert linkage.validate_main(["--matching", truth, "--test-dir", str(folder)]) == 1
    assert "header" in capsys.readouterr().out


def test_dev_cohort_files(spark, config, folder):
    linkage.dev_cohort(spark, config, 20)
    out = f"{config.paths.artifacts_dir}/dev_cohort"
    chosen = tsv.read_source(spark, f"{out}/train_source1.tsv")
    truth, population = tsv.read_truth(spark, f"{out}/train_ground_truth.tsv")
    assert chosen.count() == population.count() <= 20
    records = tsv.read_source(spark, f"{out}/train_source2.tsv").union(tsv.read_source(spark, f"{out}/train_source3.tsv")).select("entity_id")
    assert truth.select(F.col("s23_id").alias("entity_id")).exceptAll(records).count() == 0


@pytest.mark.parametrize("n", [0, 1, 37, 150, 400])
def test_smallest_equals_a_sort(spark, n):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("g"))
    rank = hash_rank(42, "k")
    expected = [r.k for r in df.orderBy(rank, "k").limit(n).collect()]
    assert sorted(r.k for r in smallest(df, n, rank, "k").collect()) == sorted(expected)
    by = smallest(df, {0: n // 3, 1: 5}, rank, "k", group="g").collect()
    assert sum(r.g == 0 for r in by) == min(100, n // 3) and sum(r.g == 1 for r in by) == 5 and all(r.g < 2 for r in by)


def test_vectors_are_stored_once(spark, tmp_path):
    asked = []

    def encoder(texts):
        (tmp_path / "asked").open("a").write("".join(f"{t}\n" for t in texts))
        return embedding.hashed_encoder(texts)

    one = spark.createDataFrame([("a", "x y"), ("b", "z"), ("c", "x y")], "eid string, text string")
    two = spark.createDataFrame([("a", "z"), ("d", "new"), ("e", None)], "eid string, text string")
    first = {r.eid: r.vector for r in embedding.stored_vectors(one, str(tmp_path), "h", encoder).collect()}
    second = {r.eid: r.vector for r in embedding.stored_vectors(two, str(tmp_path), "h", encoder).collect()}
    asked = (tmp_path / "asked").read_text().split("\n")[:-1]
    assert sorted(asked) == ["", "new", "x y", "z"] and first["a"] == first["c"] and second["a"] == first["b"] and set(second) == {"a", "d", "e"}


def test_settings_reach_from_file(tmp_path):
    (tmp_path / "c.yaml").write_text("model: {num_leaves: 15, scale_pos_weight: 2.5}\nthreshold: {step: null}\n")
    own = load_config(str(tmp_path / "c.yaml"), {"OUTPUT_DIR": "/o"})
    assert own.model.num_leaves == 15 and own.model.scale_pos_weight == 2.5 and own.threshold.step == 0.01 and own.paths.output_dir == "/o"
