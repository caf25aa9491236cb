"""The operators on small tables with nulls, ties, repeats, empty and long texts, and clashing columns, against brute force."""

import hashlib
import importlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from affinis.llm import ann, decontaminate, html_text, packing, secrets, sharding, simhash, token_count, toxicity, warc
from affinis.llm.common import components
from affinis.llm.queries import oracle_sql, queries

LONG = "alpha beta gamma delta " * 3000
TEXTS = [(1, "one two three four five six"), (2, None), (3, ""), (4, LONG), (5, "one two three four five six"), (6, "Ünï çödé ß"), (7, "token = abcdef123456"), (8, "x"), (None, "one two three four five six"), (5, "one two three four five six")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "seq", 1, "b") for d, t in TEXTS], "doc_id long, text string, fp string, key long, length string")


def test_packing(spark, docs):
    out = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096).collect()
    for seq in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == seq), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    own = packing.encoder(public_tokenizers.path("word_bpe_49k.json"))
    end = np.array([1], "<u4").tobytes()
    expected = []
    for d, t in TEXTS:
        ids = own.encode(t or "") + end
        expected += [(d, k, k * 4096, len(ids[k * 16384 : (k + 1) * 16384]) // 4, zlib.crc32(ids[k * 16384 : (k + 1) * 16384])) for k in range(-(-len(ids) // 16384))]
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out))) == sorted(map(str, expected))
    assert packing.pack_documents(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def brute_components(fps):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def test_simhash_components(spark):
    rng = np.random.default_rng(3)
    base = " ".join(f"w{k}" for k in range(300)).split()
    texts = [(0, ""), (1, None), (2, "  \n")]
    for k in range(3, 60):
        words = list(base) if k % 3 else [f"u{k}v{j}" for j in range(50)]
        for j in rng.integers(0, len(words), k % 4):
            words[j] = f"new{k}"
        texts.append((k, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = sorted(simhash.near_duplicates(df).collect())
    fps = [int(r.fingerprint, 16) for r in rows]
    group = brute_components(fps)
    assert [r.component_id for r in rows] == [min(d for d, g in enumerate(group) if g == own) for own in group]
    assert fps[0] == fps[1] == fps[2] == 0 and rows[2].component_id == 0 and len(set(group)) < 59
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_links_across_the_sign_bit(spark):
    near = [0x7000_0000_0000_0000, -0x1000_0000_0000_0000, 0x7000_0000_0000_0003, -0x7000_0000_0000_0001]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in near], "fp long")).collect()
    assert {frozenset(r) for r in links} <= {frozenset((a, b)) for a in near for b in near if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert {x for r in links for x in r} == set(near[:3])


def test_near_copies_with_edits(spark):
    rng = np.random.default_rng(9)
    rows = []
    for g in range(12):
        words = [f"g{g}w{rng.integers(0, 10**6)}" for _ in range(200)]
        edited = [f"e{g}x{k}" if k % 50 == 25 else w for k, w in enumerate(words)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(edited))]
    found = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame([*rows, (100, None), (101, "")], "doc_id long, text string")).collect()}
    assert found.pop(101) == 100 and all(d == c + 1 and c % 2 == 0 for d, c in found.items()) and len(found) >= 9


def test_near_copies_are_all_found_and_verified(spark):
    rng = np.random.default_rng(11)
    rows = [(1000, None), (1001, " "), (1002, "a b c"), (1003, "A  b c"), (1004, "a b d"), (None, "a b c")]
    for g in range(40):
        words = [f"g{g}w{rng.integers(0, 10**6)}" for _ in range(200)]
        edits = 4 if g % 2 else 5  # 20 or 25 of 196 shingles: a similarity of 0.815 or 0.774
        copy = [f"e{g}x{k}" if k % 30 == 15 and k < 30 * edits else w for k, w in enumerate(words)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
    hub = [f"hub{k}" for k in range(200)]
    for v in range(6):  # each has 0.84 with the hub and 0.71 with every other
        rows.append((200 + v, " ".join(f"v{v}x{k}" if k % 60 == 5 + 9 * v else w for k, w in enumerate(hub[:180]))))
    rows.append((210, " ".join(hub[:180])))
    found = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = {2 * g + 1: 2 * g for g in range(1, 40, 2)} | {d: 200 for d in (201, 202, 203, 204, 205, 210)}
    assert found == expected | {1001: 1000, 1003: 1002, None: 1002}
    assert simhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_near(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 9 * n >= 4 * (len(sets[i]) + len(sets[j])):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


@pytest.mark.parametrize("room", [simhash.CLUSTER_SHINGLES, 900])
def test_near_copies_equal_brute_force(spark, room, monkeypatch):
    monkeypatch.setattr(simhash.similar_links, "__defaults__", (room,))
    rng = np.random.default_rng(7)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = []
    for g in range(25):
        base = [vocabulary[k] for k in rng.integers(0, 3000, rng.integers(30, 160))]
        for _ in range(rng.integers(1, 12)):
            own = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 22)):
                at = rng.integers(0, len(own))
                own[at : at + rng.integers(0, 2)] = [vocabulary[rng.integers(0, 3000)]] * rng.integers(0, 3)
            texts.append(" ".join(own))
    rows = simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    group = brute_near(texts)
    assert {r.doc_id: r.component_id for r in rows} == {k: g for k, g in enumerate(group) if g != k} and len(rows) > 60


def test_near_dedup_keeps_rows_apart(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, "a"), (2, text, "b"), (2, "a clean text under the same id", "c"), (None, text, "d"), (None, "clean without an id", "e"), (7, "twice", "f"), (7, "twice", "f"), (8, text + " more", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string")
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.hash for r in kept.collect()) == ["a", "c", "e", "f"]
    assert simhash.without_near_copies(docs.limit(0)).count() == 0


def test_long_buckets_in_blocks_lose_no_link(spark):
    rng = np.random.default_rng(4)
    center = int(rng.integers(0, 2**62))
    fps = {center ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 60, (150, 3))}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    small = components(simhash.fingerprint_links(df, block=16)).groupBy("component").count().collect()
    whole = components(simhash.fingerprint_links(df)).groupBy("component").count().collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, whole))
    expected = {}
    for g in brute_components(sorted(fps)):
        expected[g] = expected.get(g, 0) + 1
    assert sorted(r[1] for r in whole) == sorted(n for n in expected.values() if n > 1)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (7, 7), (8, 9)], "a long, b long")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)]


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 9)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0
    assert toxicity.without_toxic(docs, model).columns == docs.columns


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>Hello <b>you</b></p></article>", "x"), (2, None, None, "x"), (None, "u", "", "x")], "page_id long, url string, html string, text string")
    assert sorted(map(str, html_text.extract(pages).collect())) == sorted(["Row(page_id=1, url='u', text='Hello you', n_chars=9)", "Row(page_id=2, url=None, text='', n_chars=0)", "Row(page_id=None, url='u', text='', n_chars=0)"])


def test_html_tables(spark):
    long = "<article><p>" + "word " * 300_000 + "</p></article>"
    rows = [(1, "u", long, 5), (1, "u", long, 5), (2, "v", "<p>", 6), (2, "v", "<p>", 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    assert sorted((r.page_id, r.n_chars) for r in html_text.extract(pages).collect()) == [(1, 1_499_999)] * 2 + [(2, 0)] * 2
    assert html_text.extract(pages.limit(0)).count() == 0 and html_text.extract(pages).columns == ["page_id", "url", "text", "n_chars"]


def test_decontamination(spark):
    item = "Sue has 12.5kg of apples and gives 3,000 to Anna Maria Bell every day until 12.5kg remain in the box."
    new = "x Bob has 7 kg of apples and gives 90 to Carla Eve Smith every day until {} kg remain in the box. tail"
    docs = spark.createDataFrame([(1, "before. " + item + " after", 1), (2, None, 1), (3, "", 1), (4, new.format(7), 1), (5, new.format(8), 1), (6, "gives 90 to the poor every day of it", 1), (None, item, 1), (1, "again " + item, 1)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(0, item, "x"), (1, None, "x"), (2, "too short", "x")], "item_id long, text string, doc_id string")
    for rows in (decontaminate.BROADCAST_ROWS, 0):
        found = {(r.doc_id, r.item_id, r.reparameterised) for r in decontaminate.find_leaks(docs, bench, broadcast_rows=rows).collect()}
        assert found == {(1, 0, False), (4, 0, True), (None, 0, False)}
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_of_edited_copies(spark):
    item = "The committee of Anna Maria Bell, Bob Carl Dean and Anna Eve Fox met in Paris and Rome while Anna Maria Bell was away in Rome for the whole week."
    other = "Sue gives 40 of the apples to the boys and keeps the rest of them, then Tom Ray Poe sells 40 of the pears to them."
    asked = "x Eva gives 71 of the apples to the boys and keeps the rest of them, and then Max Lee Orr sells {} of the pears to them."
    docs = [(1, item.replace("Dean and", "Dean, Zed and")), (2, item.replace("met in", "met again in")), (3, asked.format(71)), (4, asked.format(72)), (5, item)]
    bench = spark.createDataFrame([(0, item), (1, other)], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.reparameterised) for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert found == {(1, 0, False), (2, 0, False), (3, 1, True), (5, 0, False)}


def test_decontamination_of_short_and_long_items(spark):
    long = " ".join("w" + chr(97 + j % 26) + chr(97 + j // 26) for j in range(200))
    part, less = " ".join(long.split()[70:130]), " ".join(long.split()[70:90])
    bench = [(0, "What is 7 times 8?"), (1, "Compute 12 + 15 * 3 - 7 + 44 / 2."), (2, long), (3, "Paris"), (4, "What is 7 times 8?")]
    docs = [(1, "so, what is 7 times 8? yes"), (2, "what is 7 times 9"), (3, "x compute 12 + 15 * 3 - 7 + 44 / 2"), (4, "compute 12 + 15 * 3 - 7 + 44 / 3"), (5, "a " + part + " b"), (6, less), (7, "in paris, now"), (None, "What is 7 times 8?"), (8, "parisian"), (9, None)]
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    for rows in (decontaminate.BROADCAST_ROWS, 0):
        found = {(r.doc_id, r.item_id, r.n_slots) for r in decontaminate.find_leaks(docs, bench, broadcast_rows=rows).collect()}
        assert found == {(1, 0, 2), (1, 4, 2), (None, 0, 2), (None, 4, 2), (3, 1, 6), (5, 2, 0), (7, 3, 0)}


def test_token_counts(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    expected = [(d, len((t or "").encode()), len(library.encode(t or ""))) for d, t in TEXTS]
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in rows] == expected and all(r.over_limit == (r.n_tokens > 4096) for r in rows)


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = [(k, [float(x) for x in rng.normal(size=8)], 0) for k in range(120)] + [(k, [1.0] * 8, 0) for k in range(120, 180)]
    odd = [(500, None, 0), (520, [0.0] * 8, 0), (540, [1.0, None] + [0.0] * 6, 0), (560, [float("nan")] * 8, 0), (580, [1.0], 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>, score int")
    rows = ann.search(df, k=5, every=20, centroids=4, share=1.0, block_rows=32, block_visits=3).collect()
    x = np.array([v for _, v, _ in vectors], "f4").astype("f8")
    expected = []
    for q in range(0, 180, 20):
        s = (x * x[q]).sum(axis=1)
        best = sorted((i for i in range(180) if i != q), key=lambda i: (-s[i], i))[:5]
        expected += [(q, r + 1, i, s[i]) for r, i in enumerate(best)]
    own = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows)
    assert [o[:3] for o in own] == [e[:3] for e in expected] and np.allclose([o[3] for o in own], [e[3] for e in expected])
    assert ann.search(df.limit(0)).count() == 0 and ann.search(df.where("vec_id in (0, 1)"), k=5).count() == 1
    again = ann.search(df.where("vec_id in (0, 1, 2)").union(df.where("vec_id in (0, 1)")), k=5).collect()
    assert sorted(r.vec_id for r in again) == [1, 1, 2]


def test_secrets(spark, docs):
    rows = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert rows[7].n_assign == 1 and rows[7].spans == "assign:0:20" and rows[7].redacted == "[assign]"
    assert rows[7].base_sha256 == hashlib.sha256(b"assign:0:20").hexdigest() and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    changed = secrets.redact(docs.withColumn("n_chars", F.length("text").cast("long")))
    assert changed.where("doc_id = 7").select("text", "n_chars").first() == ("[assign]", 8) and changed.count() == len(TEXTS)


def test_weak_parts_link_without_base_spans(spark):
    key, safe = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF3hI6kL9n", "aB3dE6gH9-K2mN5pQ8sT1_W4yZ7bC0eF3hI6kL9n"
    texts = [f"client_id=deploy01 {key} https://host/x", f"{safe} for user: bob", f"only {key} https://host/x", "login: anna https://host/x", f"account: {key}", f"login: anna {'x ' * 100} {key}", f"login: anna https://host/{key}"]
    rows = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0].spans == "account:0:18,secret:19:59,endpoint:60:74" and rows[0].redacted == "[account] [secret] [endpoint]"
    assert rows[1].spans == "secret:0:40,account:45:54"
    assert [rows[k].spans for k in (2, 3, 4, 5)] == [""] * 4 and rows[6].redacted.startswith("[account] ")
    assert all(r.n_assign + r.n_access + r.n_hex == 0 for r in rows.values())


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/ b\r\nX: y", "<p>é</p>", 1), (2, None, "<p>é</p>", 1), (3, "u", None, 1), (4, "u", "", 1), (5, "u", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n", 1), (None, "u", "z", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, sha256 int")
    records, payloads = warc.write_archive(df)
    rows = {r.page_id: r for r in warc.read_archive(records, payloads).collect()}
    import base64

    for page_id, _, html, _ in pages:
        data = (html or "").encode()
        assert rows[page_id].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode() and rows[page_id].payload_bytes == len(data)
    assert {k: (r.record_type, r.refers_to) for k, r in rows.items()} == {1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), None: ("response", None)}
    assert payloads.count() == 4
    for record, payload in warc.original_records(records, payloads).collect():
        head, _, body = bytes(record).partition(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1])
        assert len(body) == length + 4 and body.endswith(b"\r\n\r\n")
        assert b"WARC-Type: revisit" in head.split(b"WARC-Record-ID")[0] or body[:-4].endswith(bytes(payload))
    warc.write_warc_files(records, payloads, str(tmp_path / "w"))
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    n, at = 0, 0
    while at < len(whole):
        end = whole.index(b"\r\n\r\n", at)
        assert whole[at:end].startswith(b"WARC/1.1\r\n")
        at, n = end + 4 + int(whole[at:end].split(b"Content-Length: ")[1]) + 4, n + 1
    assert n == len(pages)
    assert warc.archive_pages(spark, df.union(df)).count() == 12 and warc.write_archive(df.union(df))[1].count() == 4
    assert {r.record_type for r in warc.archive_pages(spark, df, 100).collect()} == {"response"} and warc.archive_pages(spark, df.limit(0)).count() == 0


def fewest(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    def need(cap):
        n, room = 1, cap
        for s in sizes:
            if s > room:
                n, room = n + 1, cap
            room -= s
        return n
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if need(mid) <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("intervals", [8192, 8])
def test_sharding(spark, docs, monkeypatch, intervals):
    monkeypatch.setattr(sharding, "INTERVALS", intervals)
    monkeypatch.setattr(sharding, "SLICE_ROWS", 40)
    more = spark.range(100, 260).select(F.col("id").alias("doc_id"), F.expr("repeat('ab', int(id % 37))").alias("text"))
    rows = sharding.shard_documents(docs.select("doc_id", "text").union(more), 8).collect()
    texts = [(d, t or "") for d, t in TEXTS] + [(k, "ab" * (k % 37)) for k in range(100, 260)]
    groups = {}
    for _, t in texts:
        groups[hashlib.sha256(t.encode()).digest()] = groups.get(hashlib.sha256(t.encode()).digest(), 0) + len(t.encode()) + 1
    load = {}
    for r in rows:
        load.setdefault(r.shard, []).append(r)
    assert max(sum(r.size for r in own) for own in load.values()) == fewest([groups[k] for k in sorted(groups)], 8)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in load.values()) and set(load) <= set(range(8))
    shard = {}
    for r in rows:
        assert shard.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for _, t in texts)
    assert sharding.shard_documents(docs.limit(0)).count() == 0 and {r.law for r in rows} == {"bytes"}


def test_registered():
    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and set(oracle_sql()) <= set(names)


def test_pipeline(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    words = [" ".join("w" + chr(97 + k) + chr(97 + j % 26) + chr(97 + j // 26) for j in range(40)) for k in range(6)]
    rows = [(0, words[0]), (1, words[0]), (2, words[1] + " token = abcdef123456"), (3, "lead " + words[2] + " tail"), (4, None), (5, words[3])]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, words[2])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = out
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert kept == [{0, 1, 2, 3, 4, 5}, {0, 2, 3, 4, 5}, {0, 2, 4, 5}, {0, 2, 4, 5}]
    assert docs.where("doc_id = 2").first().text.endswith(" [assign]")
    assert {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()} == {0, 2, 4, 5}


def test_pipeline_stages_give_heap_back(spark):
    """A stage collects the executors' garbage before it begins: the heap of the stage before must not meet its Python workers."""
    pipeline = importlib.import_module("corpus_pipeline")
    beans = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    docs, before = spark.createDataFrame([(1, "x")], "doc_id long, text string"), beans()
    stage = pipeline.secret_redaction(spark, docs, "")
    assert beans() > before and stage.count() == 1  # calls at the same time may share a collection


def test_pipeline_stages_on_hard_rows(spark, tmp_path):
    """Toxic rows that are learnt from labels, clashing columns, shared and missing ids, repeated rows, long and empty texts."""
    pipeline = importlib.import_module("corpus_pipeline")
    rng = np.random.default_rng(21)
    common = [f"{a}{b}" for a in ("al", "be", "co", "di", "en") for b in ("mor", "tal", "vin", "res", "lon", "dar")]
    prose = lambda n: " ".join(common[k] + chr(97 + rng.integers(0, 26)) * rng.integers(0, 3) for k in rng.integers(0, len(common), n))
    rows, labels = [], []
    for k in range(240):
        bad = k % 4 == 0
        rows.append((k, prose(40) + (" you zorkhead and vileling zorkhead " + prose(5) if bad else ""), "x"))
        labels.append((k, 0, int(bad)))
    item = "x" + prose(1) + " the quick benchmark asks how many red apples Tom has after he eats seven of them " + prose(8)
    clean, long = prose(50), prose(30_000)
    rows += [(300, clean, "first"), (300, prose(60), "same id, other text"), (301, clean, "copy"), (None, prose(30) + " " + item, "leak"), (None, prose(70), "no id, clean"), (302, long, "long"), (303, long + " more", "long copy"), (304, "", "empty"), (305, None, "null"), (306, prose(45), "twice"), (306, None, "y")]
    rows += [rows[-2]]
    schema = "doc_id long, text string, gone_id string, hash long, row string"
    spark.createDataFrame([(d, t, g, 7, "r") for d, t, g in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        docs = pipeline.written(docs, "stage")
        assert docs.columns == ["doc_id", "text", "gone_id", "hash", "row"]
        seen.append(sorted((r.doc_id if r.doc_id is not None else -1, r.gone_id) for r in docs.select("doc_id", "gone_id").collect() if r.gone_id != "x"))
    kept_x = docs.where("gone_id = 'x'").count()
    assert kept_x <= 190 and docs.where("gone_id = 'x' and text like '%zorkhead%'").count() <= 6 and docs.where("gone_id = 'x' and text not like '%zorkhead%'").count() == 180
    names = [[g for _, g in s] for s in seen]
    assert len(names[0]) == 12
    assert sorted(names[1]) == sorted(["first", "same id, other text", "leak", "no id, clean", "long", "empty", "twice"])
    assert sorted(names[2]) == sorted(n for n in names[1] if n != "leak") and names[3] == names[2]
    packed = pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    empty = tmp_path / "none"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert pipeline.run(spark, str(empty)).count() == 0
