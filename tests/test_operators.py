import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from affinis.config import load_config
from affinis.functions.text import normalize_words, tokens
from affinis.operators import blocking, evaluate, features, model, overlap, sampling, validate, words
from affinis.operators.embedding import encode, encode_missing
from affinis.operators.relational import first_by_key
from affinis.sources import tsv
from affinis.plans.truth import similar_documents, similar_pairs
from affinis.sources.cache import cached
from affinis.schema import document_entities, document_id, folded_words
from affinis.sources.shared import removed, stored

ENT = "entity_id string, norm_name string, norm_address string, country string"


def keys_of(spark, name, address="", families=blocking.FAMILIES):
    df = spark.createDataFrame([("S1-1", name, address, "US")], ENT)
    return {r.key for r in blocking.entity_keys(df, families).collect()}


def test_blocking_keys(spark):
    assert keys_of(spark, "acme company", "", ("n", "pfx")) == {"n2:acme_company", "pfx:acme "}
    assert keys_of(spark, "abcd", "", ("pfx",)) == {"pfx:abc"} and keys_of(spark, "ab", "", ("pfx",)) == set()
    assert keys_of(spark, "c b a z", "", ("n",)) == {"n3:a_b_c"}
    assert keys_of(spark, "b a", "12 main street 34 56", ("an", "bg", "addr")) == {"an:12_main", "an:12_street", "an:34_main", "an:34_street", "bg:a_b", "addr:main", "addr:street"}
    assert keys_of(spark, "smith x jones 4u", "", ("ph", "sph", "mph")) == {"ph:S530_J520", "sph:S530", "sph:J520", "mph:SM0", "mph:JNS"}
    assert len(keys_of(spark, "a b c d e", "", ("bg",))) == 9


def test_block_cap_and_top_k(spark):
    rows = [(f"S2-{k}", "shared", "", "") for k in range(3)] + [("S3-9", "rare", "", "")]
    keys = blocking.entity_keys(spark.createDataFrame(rows, ENT), ("tok",))
    assert {r.key for r in blocking.capped_postings(keys, 3).collect()} == {"tok:shared", "tok:rare"}
    assert {r.key for r in blocking.capped_postings(keys, 2).collect()} == {"tok:rare"}
    own = blocking.entity_keys(spark.createDataFrame([("S1-1", "shared rare", "", "")], ENT), ("tok",))
    assert [tuple(r) for r in blocking.candidates(own, keys, 2).orderBy("s23_id").collect()] == [("S1-1", "S2-0", 1), ("S1-1", "S2-1", 1)]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, s23_id string")


def test_f05_and_singletons(spark):
    true, pred = pairs(spark, [("1", "a"), ("1", "c")]), pairs(spark, [("1", "a"), ("1", "b"), ("1", "c"), ("9", "x")])
    one = spark.createDataFrame([("1",)], "s1_id string")
    assert round(evaluate.f05_macro(pred, true, one).first().f05, 4) == 0.7143
    both = spark.createDataFrame([("1",), ("2",), ("3",)], "s1_id string")
    assert evaluate.singleton_accuracy(pairs(spark, [("2", "z")]), true, both).first().singleton_acc == 0.5
    assert evaluate.blocking_recall(pred, true.limit(0)).first().recall == 1.0
    assert evaluate.f05_macro(pred, true, one.limit(0)).first().f05 == 0.0


def test_sweep_equals_one_by_one(spark):
    rows = [(str(i), f"x{j}", ((i * 7 + j * 13) % 50) / 49) for i in range(12) for j in range(6)]
    scored = spark.createDataFrame(rows, "s1_id string, s23_id string, proba double")
    true = scored.where("hash(s1_id, s23_id) % 4 = 0").where("s1_id < '5'").select("s1_id", "s23_id")
    population = spark.createDataFrame([(str(i),) for i in range(14)], "s1_id string")
    grid = [0.3, 0.5, round(25 / 49, 4), 0.9]
    for r in evaluate.threshold_sweep(scored, true, population, grid, (None, 2)).collect():
        kept = evaluate.cap_matches(scored, r.tau, r.cap)
        assert r.f05 == pytest.approx(evaluate.f05_macro(kept, true, population).first().f05)
        assert r.singleton_acc == pytest.approx(evaluate.singleton_accuracy(kept, true, population).first().singleton_acc)


def test_split_sizes_and_sampling(spark):
    assert [sampling.validation_size(n) for n in (2, 100, 40000)] == [1, 50, 6000]
    with pytest.raises(ValueError):
        sampling.validation_size(1)
    df = spark.range(200).select((F.col("id") % 20).cast("string").alias("s1_id"), F.col("id").cast("string").alias("s23_id"), (F.col("id") % 50 == 0).cast("int").alias("label"))
    split = sampling.grouped_split(df)
    assert split.groupBy("s1_id").agg(F.count_distinct("validation").alias("n")).where("n > 1").isEmpty()
    assert sampling.subsample_negatives(df, 10).count() == 44


def test_validator_rules(spark):
    lines = ["S1-1\tS2-1,S2-1", "S1-1\tS2-2", "no tab", "  ", "S1-2\tS1-7", "S1-3\tS2-1, S2-2", "S1-4\t", "S1-8\tS2-99"]
    parsed = validate.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    required = spark.createDataFrame([(f"S1-{k}",) for k in (1, 2, 3, 4, 5)], "s1_id string")
    targets = spark.createDataFrame([("S2-1",), ("S2-2",)], "entity_id string")
    found = {(r.rule, r.subject) for r in validate.find_errors(parsed, required, targets).collect()}
    assert found == {
        ("malformed_row", "no tab"), ("duplicate_row", "S1-1"), ("repeated_id", "S1-1"), ("self_match", "S1-7"), ("wrong_prefix", " S2-2"),
        ("unknown_id", "S2-99"), ("missing_s1", "S1-5"), ("unexpected_s1", "S1-8"),
    }
    assert tuple(validate.row_counts(parsed).first()) == (6, 1, 5)
    assert validate.header_errors("a,b", ["a", "b"]) and validate.header_errors(None, ["a"]) and not validate.header_errors("A\tb", ["a", "b"])


def test_files_round_trip(spark, tmp_path):
    source = tmp_path / "s.tsv"
    source.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""b"" c"\tNA\t\nS2-1\tx\ty\tFrance\n')
    rows = [tuple(r) for r in tsv.read_source(spark, str(source)).orderBy("entity_id").collect()]
    assert rows == [("S1-1", 'a "b" c', "NA", ""), ("S2-1", "x", "y", "France")]
    truth = tmp_path / "t.tsv"
    truth.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2\nS1-2\t\n")
    found, population = tsv.read_truth(spark, str(truth))
    assert {tuple(r) for r in found.collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-2")} and population.count() == 2
    tsv.write_matching_results(found, population, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n"
    assert tsv.read_ids(spark, str(source)).count() == 2 and tsv.find_dataset(str(tmp_path), "s.tsv") == str(tmp_path)
    made = cached(population, str(tmp_path), "p", lambda df: df.withColumn("x", F.lit(1)))
    assert made.columns == ["s1_id", "x"]


def test_features_model_and_vectors(spark):
    rows = [(f"S1-{k}", f"name{k} alpha", f"{k} road east", "us") for k in range(30)] + [(f"S2-{k}", f"name{k} alpha", f"{k} road west", "us") for k in range(30)]
    ents = spark.createDataFrame(rows, ENT)
    cand = spark.createDataFrame([(f"S1-{i}", f"S2-{(i + j) % 30}") for i in range(30) for j in range(3)], "s1_id string, s23_id string")
    table = features.pair_features(cand, ents).persist()
    assert table.count() == 90 and set(features.FEATURES) <= set(table.columns) and len(features.FEATURES) == 26
    same = table.where("s1_id = 'S1-3' AND s23_id = 'S2-3'").first()
    assert same.exact_name_match == 1.0 and same.tfidf_sim == pytest.approx(1.0) and same.emb_name_cos == pytest.approx(1.0, abs=1e-6)
    labelled = features.with_labels(table, cand.where("substring(s1_id, 4) = substring(s23_id, 4)")).withColumn("validation", F.col("s1_id") < "S1-2")
    fitted = model.train_model(labelled, rounds=5, min_rows=1)
    scored = model.score_pairs(labelled, fitted)
    assert scored.where("label = 1").agg(F.min("proba")).first()[0] > scored.where("label = 0").agg(F.max("proba")).first()[0]
    assert fitted.stages[-1].getNumTrees >= 1 and len(model.feature_importance(fitted)) == 26
    texts = ents.select(F.col("entity_id").alias("eid"), F.col("norm_name").alias("text"))
    cache = encode(texts.limit(5)).join(texts, "eid").select(F.sha2("text", 256).alias("key"), "vector").dropDuplicates(["key"])
    assert encode_missing(texts, cache).count() == 60


def test_config_and_first_by_key(spark, tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("seed: 7\nblocking:\n  max_block_size: 9\n  top_k_per_entity: null\npaths:\n  train_dir: null\n")
    config = load_config(str(path), {"TEST_DIR": "/x"})
    assert (config.seed, config.blocking.max_block_size, config.blocking.top_k_per_entity, config.paths.test_dir) == (7, 9, 100, "/x")
    df = spark.createDataFrame([("k", 2), ("k", 1)], "id string, v int")
    assert [tuple(r) for r in first_by_key(df, "id", "v").collect()] == [("k", 1)]


def test_overlaps_in_blocks_equal_the_join(spark):
    records = spark.range(70_000).select(F.concat(F.lit("S2-"), "id").alias("entity_id"), F.array((F.col("id") % 701), 1000 + F.col("id") % 1009, 5000 + F.col("id") % 997, F.lit(-7)).alias("keys"))
    queries = spark.range(12).select(F.concat(F.lit("S1-"), "id").alias("entity_id"), F.array(F.col("id"), 1000 + F.col("id"), 5000 + F.col("id"), F.lit(-7), F.lit(-8)).alias("keys"))
    sizes = records.select(F.explode("keys").alias("key")).groupBy("key").count().where("count <= 100").select("key")
    both = queries.select(F.col("entity_id").alias("s1_id"), F.explode("keys").alias("key")).join(records.select(F.col("entity_id").alias("s23_id"), F.explode("keys").alias("key")), "key").join(sizes, "key")
    rank = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("overlap"), "s23_id"))
    wanted = both.groupBy("s1_id", "s23_id").agg(F.count("*").alias("overlap")).withColumn("r", rank).where("r <= 30").drop("r")
    rows = sorted(map(tuple, wanted.collect()))
    assert len(rows) == 360
    for postings in (1 << 30, 100_000):  # one block of two parts, two blocks
        assert sorted(map(tuple, overlap.best_overlaps(queries, records, 30, 100, block_postings=postings).collect())) == rows


def test_blocking_makes_no_rows_of_pairs(spark):
    names = [(f"S{s}-{k}", f"common words {k}", "", "") for s in (1, 2) for k in range(300)]
    plan = blocking.block(spark.createDataFrame(names, ENT), 2500, 3, ("n", "tok"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # pairs are counted beside the postings; a join of keys made 90,000 rows of these records


def test_shared_word_features_equal_joined_ones(spark):
    rows = [(f"S{1 + k % 3}-{k}", " ".join(f"n{(k * j) % 7}" for j in range(k % 6)), " ".join(str((k * j) % 11) if j % 3 == 0 else f"w{(k * j) % 13}" for j in range(k % 23)), "us") for k in range(60)]
    ents = spark.createDataFrame(rows, ENT)
    ids = [r[0] for r in rows]
    cand = spark.createDataFrame([(a, b) for a in ids for b in ids if a.startswith("S1-") and not b.startswith("S1-")] + [("S1-0", "S2-none")], "s1_id string, s23_id string")
    own, plain = features.shared_word_features(True), features.catalyst_features()
    rounded = lambda df, made: sorted(map(tuple, df.select("s1_id", "s23_id", *(F.round(made[n], 9).alias(n) for n in features.WORD_FEATURES)).collect()))
    found = rounded(features.shared_word_counts(cand, ents, True), own)
    assert len(found) == 800 and found == rounded(features.joined_pairs(cand, ents), plain)


def test_true_pairs_with_unknown_frequencies_and_copies(spark):
    texts = {k: " ".join(f"w{(k // 6 * 17 + j) % 90 if j > k % 6 else j * 100 + k}" for j in range(24)) for k in range(120)} | {120 + k: "same words in all copies of a text" for k in range(9)} | {130: "", 131: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {k: set((t or "").split()) for k, t in texts.items()}
    wanted = sorted((f"S1-{a}", f"S{b % 3 + 1}-{b}") for a in sets for b in sets if a % 3 == 0 and b % 3 and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7)
    assert len(wanted) > 100
    for known in (0, 20, 1_000_000):
        assert sorted(map(tuple, similar_documents(docs, 0.7, known).collect())) == wanted
    plan = similar_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "words" not in plan  # pairs carry ids and counts, never the words of both texts


@pytest.mark.parametrize("repeated", [False, True])
def test_similar_pairs_equal_brute_force(spark, repeated):
    size = lambda k: (3, 24, 190, 380, 2000)[k // 6 % 5]  # noqa: E731  parities of several lengths
    texts = [(k, " ".join(f"w{k // 6 * 17 + j if j > size(k) * (k % 6) // 40 else j * 1000 + k}" for j in range(size(k) + 7 * (k % 4)))) for k in range(90)]
    texts += [(90 + k, "same words in all copies of a text") for k in range(9)] + [(99, ""), (100, None), (101, "---"), (102, "one")]
    texts += [(0, "one"), (97, texts[0][1])] if repeated else []
    sets = [(k, set((t or "").replace("-", "").split())) for k, t in texts]
    asked = [(a, b) for a in range(0, 106, 3) for b in range(105) if b % 3 and (a + b) % 5]
    true = {(a, b) for a, x in sets for b, y in sets if x and y and len(x & y) / len(x | y) >= 0.7}
    name = lambda pairs: sorted((f"S1-{a}", f"S{b % 3 + 1}-{b}") for a, b in pairs)
    wanted, docs = name(true & set(asked)), spark.createDataFrame(texts, "doc_id long, text string")
    assert len(wanted) > 60
    pairs = spark.createDataFrame(name(asked), "s1_id string, s23_id string")
    assert sorted(map(tuple, similar_pairs(pairs, docs, 0.7).collect())) == wanted


def test_tables_of_a_step_are_removed(spark):
    made = stored(spark.range(3), "removed")
    path = made.inputFiles()[0].removeprefix("file:")
    removed(made)
    assert not os.path.exists(path)


def test_short_features_equal_joined_ones(spark):
    rows = [(f"S{1 + k % 3}-{k}", " ".join(f"n{'abc'[(k * j) % 3]}" for j in range(k % 5)), "" if k % 7 == 0 else f"{k % 4} road " * (k % 3), ("us", " US", None)[k % 3 if k % 2 else 0]) for k in range(48)]
    ents = spark.createDataFrame(rows, ENT)
    ids = [r[0] for r in rows]
    cand = spark.createDataFrame([(a, b) for a in ids for b in ids if a.startswith("S1-") and not b.startswith("S1-")], "s1_id string, s23_id string")
    own, plain = features.short_features(), features.catalyst_features()
    rounded = lambda df, made: sorted(map(tuple, df.select("s1_id", "s23_id", *(F.round(made[n], 9).alias(n) for n in own)).collect()))
    assert rounded(features.joined_short(cand, ents), own) == rounded(features.joined_pairs(cand, ents), plain)


def test_overlaps_without_records(spark):
    queries = spark.createDataFrame([("S1-1", [1, 2]), ("S1-2", [])], "entity_id string, keys array<long>")
    assert overlap.best_overlaps(queries, queries.limit(0), 5, 10).isEmpty()
    assert overlap.best_overlaps(queries.limit(0), queries, 5, 10).isEmpty()


def test_packed_index_rows_hold_all_postings(monkeypatch):
    """Keys of several parts in any order, in rows of few postings: counted as by hand."""
    monkeypatch.setattr(overlap, "ROW_POSTINGS", 5)
    rng = np.random.default_rng(4)
    sets = {(p, key): sorted(rng.choice(9, rng.integers(1, 9), replace=False).tolist()) for p in (0, 3) for key in rng.permutation(30).tolist()}
    half = overlap.PART_RECORDS >> 1
    batch = pa.record_batch([pa.array([p for p, _ in sets], pa.int32()), pa.array([k for _, k in sets], pa.int64()), pa.array([[x - half for x in v] for v in sets.values()], pa.list_(pa.int16()))], ["part", "key", "at"])
    rows = [r for b in overlap.packed(iter([batch])) for r in b.to_pylist()]
    assert len(rows) > 20 and sum(r["n"] for r in rows) == sum(map(len, sets.values()))
    for part in (0, 3):
        own = [r for r in rows if r["part"] == part]
        held = overlap.Part([np.arange(9)], *([np.frombuffer(r[c], kind) for r in own] for c, kind in (("keys", "i8"), ("sizes", "u4"), ("postings", "u2"))))
        asked = np.array([1, 4, 7, 8, 20, 99])
        wanted = np.bincount([x for k in asked.tolist() for x in sets.get((part, k), [])], minlength=9)
        names, counts = held.best(asked, 9)
        assert dict(zip(names.tolist(), counts.tolist())) == {k: n for k, n in enumerate(wanted.tolist()) if n}


def test_words_and_keys_of_texts_equal_those_of_records(spark):
    odd = ["", None, "  ", "Ltd", "the Ltd Co ACME acme Pvt pvt. 12 12 road 7 Road lane", "\u0130stanbul \u212aelvin \u00c9t\u00c9 \u00d1and\u00da na\u00efve \u00e5ngstr\u00f6m caf\u00e9", "a b c d e f sa ltd ltd limited 12 sas 12 rue rue 1234 rue5", "x" * 50, "one-two_three\n\u4e2d\u6587four five six seven seven\u00e9 eight limited"]
    texts = odd + [" ".join(f"{'Ww'[j % 2]}ord{(k * j) % 17}" if j % 3 else str(k * j % 5) for j in range(k)) for k in range(40)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    sizes = {r.doc_id: r.n for r in docs.select("doc_id", F.size(F.array_distinct(folded_words(F.col("text")))).alias("n")).collect()}
    found = {r.doc_id: r.words for r in words.word_sets(docs, "doc_id", "text").collect()}
    assert {k: len(v) for k, v in found.items()} == sizes and all(v == sorted(set(v)) for v in found.values())
    made = {f"norm_{c}": normalize_words(tokens(F.col(f"business_{c}"))) for c in ("name", "address")}
    records = document_entities(docs).withColumns(made)
    place = lambda w: len(w) >= 4 and not w.isdigit()
    plain = {r.entity_id: (r.norm_name, r.norm_address.split()) for r in records.collect()}
    texts = docs.select(document_id(F.col("doc_id")).alias("entity_id"), "text")
    for r in words.record_words(texts, "text").collect():
        name, address = plain[r.entity_id]
        assert r.norm_name == name and len(r.addr) == len({w for w in address if place(w)})
        assert [w for w in r.places if place(w)] == [w for w in address if place(w)][:2]
        assert [w for w in r.places if w.isdigit()] == [w for w in address if w.isdigit()][:2]
    rows = lambda df: sorted(map(tuple, df.collect()))
    families = ("n", "pfx", "addr", "tok", "bg", "an")
    assert rows(blocking.block_texts(texts, 20, 5, families)) == rows(blocking.block(records, 20, 5, families))
    plan = words.word_sets(docs, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "translate(" not in plan  # words were split and hashed one by one, a lambda's call each
