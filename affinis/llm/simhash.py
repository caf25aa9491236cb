"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a word of the perfect [23,12,7] Golay
code. A word's keys are the indices of all codewords at most 4 bits away: one, or six where the nearest is 3 bits away.
Two words at most 2 bits apart always have a key in common. Where fingerprints differ in at most 4 bits, pigeonhole leaves

* a segment without errors, and then one of the other two with at most 2: key (exact segment, Golay index); or
* an error in every segment, and then at most 2 in each: key (three Golay indices).

So no link is missed, and each key has 33 bits or more, which keeps chance buckets nearly empty. Every bucket is verified
bit by bit and gives a spanning forest of its links, never its pairs; a bucket of any size passes through memory in
blocks. Connected components of these forests are those of all links.

Edited copies (near_copies) are farther apart than 4 bits: those with a shingle similarity of 0.8 differ in about 9 of 100
bits. Their fingerprints are cut into five segments of 23 bits, decoded softly: how far a bit's count is from a tie tells how
sure it is, and the codewords nearest by that measure are the segment's indices. If the errors leave three segments right,
one of the ten triples of indices is a common key; a triple's likeliest readings, in the order of their distance, are all
keys. Every link is then verified on the texts' shingle sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from affinis.llm.common import components, forget, heavy_keys, holding, row_hash, salted_join, without_rows, written

#: Lowest bit and width of the segments; distance that links; rows of a bucket that are compared at once.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 4
BLOCK = 4096
#: Generator polynomial of the [23,12,7] Golay code (fixed value).
GENERATOR = 0b110001110101
#: Near copies: words of a shingle; similarity that links, as a fraction; words of what the fingerprint counts.
NEAR_WORDS, SIMILAR, COUNTED_WORDS = 5, (4, 5), 2
#: Soft decoding: segments of 23 bits; codewords of a segment; readings of a triple at most, and how much farther than its nearest they may be.
SOFT_SEGMENTS, NEAREST, READINGS, SLACK = 5, 4, 24, 0.5
#: Bits of 64 that may differ between candidates (a similarity of 0.8 leaves about 6, unrelated texts 32); shingles that a worker compares at once.
CLOSE_BITS, CLUSTER_SHINGLES = 18, 1_000_000


def fingerprints(docs: DataFrame, shingle_words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """(doc_id, fp): a bit of fp is 1 if it is set in over half the hashes of the text's shingles (distinct: each once); no shuffle.

    Words are runs of bytes other than ASCII white space, after lower-casing A to Z; shorter texts hash as one shingle, null
    and empty ones have fingerprint 0.
    """

    def fingerprint(text: str | None) -> int:
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        k = min(shingle_words, len(words))
        shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(k))))
        shingles = iter(set(shingles)) if distinct else shingles
        ones, n = np.zeros(64, "i8"), 0
        while block := list(map(xxh64_intdigest, itertools.islice(shingles, 65536), itertools.repeat(seed))):
            octets = np.array(block, "<u8").view("u1").reshape(-1, 8)
            ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype="i8")
            n += len(block)
        return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py()) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(of, "doc_id long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """The 23-bit words' remainders by the generator polynomial."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= ((words >> bit) & 1) * (GENERATOR << (bit - 11))
    return words


@cache
def _leaders() -> np.ndarray:
    """By syndrome: the error masks of the codewords at most 4 bits away, nearest first, -1 where there are fewer."""
    masks = [sum(1 << b for b in bits) for w in range(5) for bits in itertools.combinations(range(23), w)]
    found: list[list[int]] = [[] for _ in range(2048)]
    for mask, syndrome in zip(masks, _syndromes(np.array(masks, "i8"))):
        found[syndrome].append(mask)
    table = np.full((2048, 6), -1, "i8")
    for syndrome, own in enumerate(found):
        table[syndrome, : len(own)] = own
    return table


def golay_indices(words: np.ndarray) -> np.ndarray:
    """One row per 23-bit word: the 12-bit indices of the codewords at most 4 bits away, -1 where there are fewer than 6."""
    errors = _leaders()[_syndromes(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row of fps): fingerprints at most 4 bits apart have at least one key in common."""
    unsigned = fps.view("u8")
    cut = [((unsigned >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype("i8") for at, width in SEGMENTS]
    near = [golay_indices(segment) for segment in cut]
    keys, rows = [], []

    def add(values: np.ndarray, valid: np.ndarray) -> None:
        row, column = np.nonzero(valid)
        keys.append(values[row, column])
        rows.append(row)

    for i, j in itertools.permutations(range(3), 2):
        add((near[j] | (cut[i][:, None] << 12)) | ((3 * i + j) << 36), near[j] >= 0)
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    add((a | (b << 12) | (c << 24) | (15 << 36)).reshape(len(fps), -1), ((a >= 0) & (b >= 0) & (c >= 0)).reshape(len(fps), -1))
    return np.concatenate(keys), np.concatenate(rows)


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits differ; unsigned, as bitwise_count takes the absolute value of negative numbers."""
    return np.bitwise_count(np.bitwise_xor(a, b).view("u8"))


def forest(rows: np.ndarray, most: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links of rows (fingerprint, or fingerprint and id) at most ``most`` bits apart, each tree a breadth-first one of ids."""
    left, edges = rows.reshape(len(rows), -1), []
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            here = reached.pop()
            close = bits_apart(left[:, 0], here[0]) <= most
            if close.any():
                found = left[close]
                edges += [(here[-1], x[-1]) for x in found]
                reached += list(found)
                left = left[~close]
    return edges


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for at in range(0, len(fps), 2048):
            part = fps[at : at + 2048]
            keys, rows = bucket_keys(part)
            yield pa.record_batch([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


def _links(batches: Iterator[pa.RecordBatch], n_keys: int, block: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (n_keys keys in order, fp, perhaps id): the forests (a, b) of buckets; of longer buckets the rows, as (id, fp, key)."""

    def out(edges_a, edges_b, keys):
        return pa.record_batch([pa.array(c, pa.int64()) for c in (edges_a, edges_b, keys)], ["a", "b", "key"])

    def spilled(rows, key):
        return out(rows[:, -1], rows[:, 0], np.full(len(rows), key))

    def close(rows):
        edges = forest(rows, most)
        return out([int(a) for a, _ in edges], [int(b) for _, b in edges], [None] * len(edges))

    held_keys, held, spilling = None, None, False
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(n_keys)]
        rows = np.column_stack([batch.column(k).to_numpy() for k in range(n_keys, batch.num_columns)])
        if not len(rows):
            continue
        new = np.zeros(len(rows), bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        new[0] = held_keys != tuple(int(c[0]) for c in columns)
        starts = np.flatnonzero(new)
        ends = np.append(starts, len(rows))
        # what continues the bucket that the last batch left open
        head = rows[: ends[0]]
        if held_keys is not None:
            if spilling:
                if len(head):
                    yield spilled(head, held_keys[0])
            else:
                held = np.concatenate([held, head])
                if len(held) > block and n_keys == 1:
                    yield spilled(held, held_keys[0])
                    held, spilling = held[:0], True
            if len(starts):
                if not spilling and len(held) > 1:
                    yield close(held)
                spilling = False
        if not len(starts):
            continue
        a, b = [], []
        sizes = np.diff(ends)[:-1]  # the last bucket may go on in the next batch
        twos = starts[:-1][sizes == 2]
        twos = twos[bits_apart(rows[twos, 0], rows[twos + 1, 0]) <= most]
        if len(twos):
            yield out(rows[twos, -1], rows[twos + 1, -1], [None] * len(twos))
        for at, size in zip(starts[:-1][sizes > 2], sizes[sizes > 2]):
            if size > block and n_keys == 1:
                yield spilled(rows[at : at + size], int(columns[0][at]))
            else:
                for x, y in forest(rows[at : at + size], most):
                    a.append(x)
                    b.append(y)
        if a:
            yield out(np.array(a), np.array(b), [None] * len(a))
        held_keys, held = tuple(int(c[starts[-1]]) for c in columns), rows[starts[-1] :].copy()
    if held_keys is not None and not spilling and len(held) > 1:
        yield close(held)


def bucket_links(keyed: DataFrame, block: int = BLOCK, most: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) of keyed rows (key, fp) or (key, fp, id): forests of the links within buckets.

    Buckets of up to ``block`` rows are compared at once; longer ones in all pairs of blocks, each pair in a task of
    its own, so that none is left out and memory stays bounded.
    """
    columns = keyed.columns[1:]
    first = written(
        keyed.repartition("key").sortWithinPartitions("key", *columns).mapInArrow(lambda batches: _links(batches, 1, block, most), "a long, b long, key long"), "simhash-links"
    )
    edges = first.where("key is null").select("a", "b")
    long = first.where("key is not null").select("key", F.col("b").alias("fp"), *([F.col("a").alias("id")] * (len(columns) - 1)))
    if long.isEmpty():
        return edges.distinct()
    parts = long.groupBy("key").agg(F.ceil(F.count("*") * 2 / block).alias("parts"))
    dealt = long.join(parts, "key").withColumn("own", F.pmod(F.xxhash64(*columns), F.col("parts")))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), *columns
    )
    more = pairs.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", *columns).mapInArrow(
        lambda batches: _links(batches, 3, block, most), "a long, b long, key long"
    )
    return edges.union(more.select("a", "b")).distinct()


def fingerprint_links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) of fingerprints at most 4 bits apart whose components are those of all such links."""
    return bucket_links(distinct.select("fp").mapInArrow(_keyed, "key long, fp long"), block)


def near_duplicates(docs: DataFrame, shingle_words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents whose fingerprints are linked, directly or through others.

    component_id is the smallest doc_id of the component. Null and empty texts share fingerprint 0 and link like any other;
    exact copies and repeated rows share a fingerprint and so a component; rows with a null doc_id keep their fingerprint
    and take no part in the smallest; an empty table gives no rows; further columns are ignored; long texts count whole.
    """
    marked = written(fingerprints(docs, shingle_words, seed, id_col, text_col, distinct), "simhash")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    links = fingerprint_links(distinct)
    linked = components(links, "simhash-components").withColumnRenamed("node", "fp")
    grouped = linked.join(distinct, "fp")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("least"))
    moved = grouped.join(smallest, "component").select("fp", "least")
    labels = distinct.join(moved, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return salted_join(marked, labels, "fp", heavy_keys(marked, "fp"), ("doc_id",)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(words: list[bytes], shingle_words: int = NEAR_WORDS) -> np.ndarray:
    """The distinct hashes of the words' shingles, sorted; fewer words are one shingle, no words none."""
    if not words:
        return np.zeros(0, "u8")
    k = min(shingle_words, len(words))
    return np.unique(np.fromiter(map(xxh64_intdigest, map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(k))))), "u8"))


def bit_counts(words: list[bytes]) -> np.ndarray:
    """By bit of the soft segments: how many distinct runs of COUNTED_WORDS words have it set, less those that have not."""
    runs = set(zip(*(itertools.islice(words, i, None) for i in range(min(COUNTED_WORDS, len(words))))))
    digests = (xxh3_128_digest(b" ".join(run)) for run in runs)
    ones, n = np.zeros(128, "i8"), 0
    while block := b"".join(itertools.islice(digests, 65536)):
        octets = np.frombuffer(block, "u1").reshape(-1, 16)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype="i8")
        n += len(octets)
    return (2 * ones - n)[: 23 * SOFT_SEGMENTS]


@cache
def _codewords() -> np.ndarray:
    """The codewords by index, as a column of +1 and -1 each."""
    index = np.arange(4096, dtype="i8") << 11
    bits = (index ^ _syndromes(index))[:, None] >> np.arange(23) & 1
    return np.ascontiguousarray((2 * bits - 1).T.astype("f4"))


def soft_indices(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices, agreement) of the NEAREST codewords of every segment, nearest first, for rows of bit_counts."""
    segments = counts.reshape(-1, 23).astype("f4")
    segments /= np.maximum(np.sqrt((segments**2).sum(axis=1, keepdims=True)), 1e-9)
    agreement = segments @ _codewords()
    rows = np.arange(len(segments))
    indices, values = np.zeros((len(segments), NEAREST), "i2"), np.zeros((len(segments), NEAREST), "f4")
    for k in range(NEAREST):
        best = agreement.argmax(axis=1)
        indices[:, k], values[:, k] = best, agreement[rows, best]
        agreement[rows, best] = -np.inf
    return indices.reshape(-1, SOFT_SEGMENTS, NEAREST), values.reshape(-1, SOFT_SEGMENTS, NEAREST)


#: Triples of segments, and readings of a triple: which of each segment's codewords, the least likely left out.
TRIPLES = np.array(list(itertools.combinations(range(SOFT_SEGMENTS), 3)))
CHOICES = np.array([c for c in itertools.product(range(NEAREST), repeat=3) if sum(c) <= 5])


def soft_keys(indices: np.ndarray, agreement: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row): the likeliest readings of every triple of segments."""
    keys, total = np.broadcast_to(np.arange(len(TRIPLES))[None, :, None], (len(indices), len(TRIPLES), len(CHOICES))), 0.0
    for k in range(3):
        keys = keys << 12 | indices[:, TRIPLES[:, k]][:, :, CHOICES[:, k]]
        total = total + agreement[:, TRIPLES[:, k]][:, :, CHOICES[:, k]]
    last = np.partition(total, len(CHOICES) - READINGS, axis=2)[:, :, len(CHOICES) - READINGS, None]
    row, triple, choice = np.nonzero((total >= total.max(axis=2, keepdims=True) - SLACK) & (total >= last))
    return keys[row, triple, choice], row


def _split(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches, with the words of their texts."""
    for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
        yield batch, [(text.as_py() or "").encode().lower().split() for text in batch.column(column)]


def _signature(words: list[bytes]) -> int:
    return xxh64_intdigest(b" ".join(words))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, hash, text) as (doc_id, hash, sig, bits, decoded): a hash of all words, 64 fingerprint bits and the decoded segments (null without words)."""
    holding("simhash", _codewords.cache_clear)
    for batch, words in _split(batches, 2):
        counts = np.array([bit_counts(w) for w in words])
        indices, agreement = soft_indices(counts)
        bits = np.packbits(counts[:, :64] > 0, axis=1, bitorder="little").view("<i8")[:, 0]
        decoded = [i.tobytes() + a.tobytes() if w else None for w, i, a in zip(words, indices, agreement)]
        sigs = np.array([_signature(w) for w in words], "u8").view("i8")
        columns = [batch.column(0), batch.column(1), pa.array(sigs), pa.array(bits), pa.array(decoded, pa.binary())]
        yield pa.record_batch(columns, ["doc_id", "hash", "sig", "bits", "decoded"])


def _soft_keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, bits, decoded) as (key, fp, id)."""
    holding("simhash", _codewords.cache_clear)
    cut = 2 * SOFT_SEGMENTS * NEAREST
    for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
        octets = np.frombuffer(b"".join(batch.column(2).to_pylist()), "u1").reshape(batch.num_rows, -1)
        indices = octets[:, :cut].copy().view("i2").astype("i8").reshape(-1, SOFT_SEGMENTS, NEAREST)
        agreement = octets[:, cut:].copy().view("f4").reshape(-1, SOFT_SEGMENTS, NEAREST)
        keys, rows = soft_keys(indices, agreement)
        yield pa.record_batch([pa.array(c) for c in (keys, batch.column(1).to_numpy()[rows], batch.column(0).to_numpy()[rows])], ["key", "fp", "id"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text) as (sig, shingles)."""
    holding("simhash", _codewords.cache_clear)
    for _, words in _split(batches, 0):
        sets = [shingle_set(w).view("i8") for w in words]
        sigs = np.array([_signature(w) for w in words], "u8").view("i8")
        yield pa.record_batch([pa.array(sigs), pa.array(sets, pa.list_(pa.int64()))], ["sig", "shingles"])


def similar_forest(sizes: np.ndarray, shingles: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the sets (one after the other in shingles) with a Jaccard similarity of SIMILAR or more, by their places.

    One set's shared elements with all others are counted from the lists of sets by element, so no pair is looked at by itself.
    """
    part, whole = SIMILAR
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, element = np.unique(shingles, return_inverse=True)
    listed = owner[np.argsort(element, kind="stable")]
    ends = np.cumsum(np.bincount(element))
    starts = np.append(0, np.cumsum(sizes))
    left, edges = np.ones(len(sizes), bool), []
    for root in range(len(sizes)):
        if not left[root]:
            continue
        left[root] = False
        reached = [root]
        while reached and left.any():
            here = reached.pop()
            own = element[starts[here] : starts[here + 1]]
            lists = [listed[ends[e - 1] if e else 0 : ends[e]] for e in own]
            common = np.bincount(np.concatenate(lists), minlength=len(sizes)) if lists else np.zeros(len(sizes), "i8")
            found = np.flatnonzero(left & (common * (part + whole) >= part * (sizes + sizes[here])))
            left[found] = False
            edges += [(here, int(k)) for k in found]
            reached += found.tolist()
    return edges


def _verified(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """Rows (n_keys keys in order, sig, shingles): the forests (a, b) of every group's similar texts."""
    held_key, sigs, sets = None, [], []

    def close() -> Iterator[pa.RecordBatch]:
        if len(sigs) > 1:
            edges = similar_forest(np.array([len(x) for x in sets]), np.concatenate(sets))
            if edges:
                yield pa.record_batch([pa.array([sigs[e[side]] for e in edges], pa.int64()) for side in (0, 1)], ["a", "b"])
        sigs.clear()
        sets.clear()

    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in range(n_keys)))
        flat, offsets = batch.column(n_keys + 1).values.to_numpy(), batch.column(n_keys + 1).offsets.to_numpy()
        for key, sig, at, to in zip(keys, batch.column(n_keys).to_pylist(), offsets, offsets[1:]):
            if key != held_key:
                yield from close()
                held_key = key
            sigs.append(sig)
            sets.append(flat[at:to].copy())
    yield from close()


def similar_links(clusters: DataFrame, room: int = CLUSTER_SHINGLES) -> DataFrame:
    """Edges (a, b) of texts (cluster, sig, shingles) with a Jaccard similarity of SIMILAR or more, whose components are those of all such links.

    A cluster of up to ``room`` shingles is compared at once; a larger one in all pairs of parts, each pair in a task of its own.
    """
    sizes = clusters.groupBy("cluster").agg((F.ceil(F.sum(F.size("shingles")) / room)).cast("int").alias("parts")).where("parts > 1")
    sizes = written(sizes.withColumn("parts", 2 * F.col("parts")), "near-large")
    schema = "a long, b long"
    small = clusters.join(sizes, "cluster", "left_anti")
    links = small.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(lambda batches: _verified(batches, 1), schema)
    if sizes.isEmpty():
        return links
    dealt = clusters.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "cluster", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "sig", "shingles"
    )
    keys = ("cluster", "lo", "hi")
    return links.union(pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: _verified(batches, 3), schema))


def _near_copies(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(marked rows, near_copies)."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), row_hash(docs).alias("hash"), F.col(f"`{text_col}`").cast("string").alias("text"))
    marked = written(source.mapInArrow(_marked, "doc_id long, hash long, sig long, bits long, decoded binary"), "near-marks")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "hash")).alias("first")
    distinct = written(marked.groupBy("sig").agg(first, F.first("bits").alias("bits"), F.first("decoded").alias("decoded")), "near-distinct")
    keyed = distinct.where("decoded is not null").select("sig", "bits", "decoded").mapInArrow(_soft_keyed, "key long, fp long, id long")
    close = written(bucket_links(keyed, most=CLOSE_BITS), "near-close")
    clusters = written(components(close, "near-clusters").select(F.col("node").alias("sig"), F.col("component").alias("cluster")), "near-clusters")

    hashes = written(distinct.join(clusters, "sig").select(F.col("first.hash").alias("hash")), "near-wanted")
    texts = source.join(hashes, "hash", "left_semi").select("text")
    sets = texts.mapInArrow(_sets, "sig long, shingles array<long>").dropDuplicates(["sig"])
    grouped = written(sets.join(clusters, "sig").select("cluster", "sig", "shingles"), "near-sets")
    links = written(similar_links(grouped), "near-links")
    for table in (close, clusters, hashes, grouped):
        forget(table)

    linked = components(links, "near-components").select(F.col("node").alias("sig"), "component")
    groups = distinct.select("sig", "first").join(linked, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    kept = groups.groupBy("component").agg(F.min("first").alias("kept"))
    of_sig = groups.join(kept, "component").select("sig", "kept")
    copies = salted_join(marked.select("doc_id", "hash", "sig"), of_sig, "sig", heavy_keys(marked, "sig"), ("doc_id", "hash")).where("hash <> kept.hash")
    return marked, copies.select("doc_id", "hash", F.col("kept.doc_id").alias("component_id"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, component_id): the rows that are near copies of another, directly or through others; hash is row_hash.

    Of each group the row with the smallest doc_id is not reported (rows without one come last, then the smaller hash);
    component_id is its doc_id. Two texts link where their sets of five-word shingles have a Jaccard similarity of 0.8 or more;
    texts of the same words link without comparison, null and empty ones among them. Candidates are texts that share a soft
    Golay key with at most CLOSE_BITS of 64 bits between them; texts that these candidates connect are compared with each other on
    their whole sets, and only links verified so build groups. A row is one document, also where rows share a doc_id; an empty table gives
    no rows; further columns only enter the hash; long texts count whole.
    """
    return _near_copies(docs, id_col, text_col)[1]


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with all their columns, without the rows that near_copies reports; of rows alike in all columns one stays."""
    marked, copies = _near_copies(docs, id_col, text_col)
    repeated = marked.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    return without_rows(docs, written(copies.select("hash").distinct(), "near-gone"), written(repeated, "near-repeated"))
