"""The best records by shared keys: an inverted index in blocks that the other side's records stream past.

Keys are 64-bit hashes. Pairs are counted where the postings lie and never become rows; only a record's best ones do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.relational import top_per_group
from affinis.operators.words import give_back
from affinis.sources.shared import removed, stored

#: Records of a part, whose postings take two bytes each; postings that a task holds; tasks at least (the index is repeated for them).
PART_RECORDS, BLOCK_POSTINGS, LEAST_TASKS = 1 << 16, 48_000_000, 4
#: Postings that a row of the index holds at most, but for a single key's.
ROW_POSTINGS = 1_000_000
#: Keys over the cap up to which they are broadcast.
BROADCAST_KEYS = 1_000_000


class Part:
    """Postings of up to PART_RECORDS records: sorted keys, where each one's postings begin and end, and numbers of records."""

    def __init__(self, names: list[np.ndarray], keys: list[np.ndarray], sizes: list[np.ndarray], postings: list[np.ndarray]):
        self.names = np.concatenate(names)
        self.postings = np.concatenate([np.zeros(0, "u2"), *postings])
        own, sizes = np.concatenate([np.zeros(0, "i8"), *keys]), np.concatenate([np.zeros(0, "u4"), *sizes])
        order, ends = np.argsort(own), np.cumsum(sizes, dtype="u4")
        self.keys, self.starts, self.ends = own[order], (ends - sizes)[order], ends[order]

    def best(self, keys: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(names, shared keys) of at least the k records that share most of the keys, ties at the end included; with ``least``, of those
        that share so many."""
        at = np.searchsorted(self.keys, keys)
        at = at[self.keys[np.minimum(at, len(self.keys) - 1)] == keys] if len(self.keys) else at[:0]
        if not len(at):
            return self.names[:0], np.zeros(0, "i8")
        met = np.concatenate([self.postings[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist())])
        if len(met) < 4096:
            which, counts = np.unique(met, return_counts=True)
            kept = counts >= (least or least_of_best(counts, k))
            return self.names[which[kept]], counts[kept]
        counts = np.bincount(met)
        which = np.flatnonzero(counts >= (least or least_of_best(counts, k)))
        return self.names[which], counts[which]


def best_of(parts: list[Part], keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Part.best() of all parts: once k records are found, only those count that share as many keys as the k-th of them."""
    names, counts, least = [], [], 0
    for part in parts:
        found = part.best(keys, k, least)
        names.append(found[0])
        counts.append(found[1])
        if len(parts) > 1 and (every := sum(map(len, counts))) >= k:
            least = int(np.partition(np.concatenate(counts), every - k)[every - k])
    return (np.concatenate(names), np.concatenate(counts)) if parts else (np.zeros(0, object), np.zeros(0, "i8"))


def least_of_best(counts: np.ndarray, k: int) -> int:
    """The k-th largest of counts, 1 if fewer than k are positive."""
    of = np.bincount(counts)
    reached = np.flatnonzero(np.cumsum(of[:0:-1]) >= k)
    return len(of) - 1 - int(reached[0]) if len(reached) else 1


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, where each list begins) of a list column."""
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])


def _runs(columns: list[np.ndarray], n: int) -> list[tuple[int, int]]:
    """The ranges of rows that are equal in all columns."""
    changed = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        changed |= np.diff(c) != 0
    cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), n]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, n, keys, sizes, postings) of (part, key, at): the keys of a part in a batch as one row, numbers as bytes."""
    for batch in batches:
        of, own = batch.column("part").to_numpy(), batch.column("key").to_numpy()
        values, starts = _lists(batch.column("at"))
        sizes, values = np.diff(starts).astype("u4"), (values.astype("i4") + (PART_RECORDS >> 1)).astype("u2")
        for part in np.unique(of):
            here = of == part
            keys, counts, postings = own[here], sizes[here], values[np.repeat(here, sizes)]
            ends = np.cumsum(counts, dtype="i8")
            for a, b in _runs([ends // ROW_POSTINGS], len(keys)):
                first, n = int(ends[a] - counts[a]), int(ends[b - 1])
                numbers = (x.tobytes() for x in (keys[a:b], counts[a:b], postings[first:n]))
                yield pa.record_batch([pa.array([int(part)], pa.int32()), pa.array([n - first], pa.int64()), *(pa.array([x], pa.binary()) for x in numbers)], ["part", "n", "keys", "sizes", "postings"])


def labels(spark: SparkSession, n: int) -> list[int]:
    """n numbers that repartition(n, number) deals to n different partitions."""
    rows = spark.range(64 * n + 64, numPartitions=1).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("to")).groupBy("to").agg(F.min("id").alias("id")).collect()
    found = {r.to: r.id for r in rows}
    return [found.get(k, 64 * n + 64 + k) for k in range(n)]


def numbered(records: DataFrame, label: str) -> tuple[DataFrame, int]:
    """records stored with column number, from 0 without gaps, and how many there are."""
    made = stored(records.withColumn("number", F.monotonically_increasing_id()), label)
    per_task = {r.task: r["count"] for r in made.groupBy(F.shiftright("number", 33).alias("task")).count().collect()}
    before, total = [], 0
    for task in range(max(per_task, default=0) + 1):
        before.append(total)
        total += per_task.get(task, 0)
    first = F.get(F.lit(before), F.shiftright("number", 33).cast("int"))
    return made.withColumn("number", first + F.col("number").bitwiseAND((1 << 33) - 1)), total


def best_overlaps(queries: DataFrame, records: DataFrame, k: int, cap: int | None = None, block_postings: int = BLOCK_POSTINGS, least_tasks: int = LEAST_TASKS) -> DataFrame:
    """(s1_id, s23_id, overlap): of each query the k records that share most keys with it, ties to the smaller id.

    Both are (entity_id, keys), a row per id, with distinct 64-bit keys; keys that over ``cap`` records have do not count.
    The result is stored, and the tables that it was made from are removed.
    """
    spark = queries.sparkSession
    queries = stored(queries.select("entity_id", "keys"), "overlap-queries")
    records, total = numbered(records.select("entity_id", "keys"), "overlap-records")
    part = F.shiftright("number", 16)
    postings = records.select(part.cast("int").alias("part"), (F.col("number").bitwiseAND(PART_RECORDS - 1) - (PART_RECORDS >> 1)).cast("short").alias("at"), F.explode("keys").alias("key"))
    if cap is not None:
        over = stored(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > cap).select("key"), "overlap-over")
        n_over = over.count()
        if n_over:
            postings = postings.join(F.broadcast(over) if n_over <= BROADCAST_KEYS else over, "key", "left_anti")
    grouped = postings.groupBy("key", "part").agg(F.collect_list("at").alias("at"))
    asked = queries.select(F.explode("keys").alias("key")).distinct()
    index = grouped.join(asked, "key", "left_semi").select("part", "key", "at")
    index = stored(index.mapInArrow(packed, "part int, n long, keys binary, sizes binary, postings binary"), "overlap-index")
    names = stored(records.select("entity_id", "number"), "overlap-names")
    for done in (records, *([over] if cap is not None else [])):
        removed(done)
    n_postings = index.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = -(-total // PART_RECORDS)
    blocks = max(1, min(parts, -(-n_postings // block_postings)))
    chunks = -(-least_tasks // blocks)
    label = labels(spark, blocks * chunks)

    def group(block, chunk):
        return F.get(F.lit(label), (block.cast("int") * chunks + chunk).cast("int")).cast("long")

    none, every = {c: F.lit(None).cast(kind) for c, kind in (("name", "string"), ("packed", "struct<keys:binary,sizes:binary,postings:binary>"), ("keys", "array<bigint>"))}, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    block = lambda p: F.pmod(p, F.lit(blocks))
    named = names.select(part.alias("part"), F.col("number").alias("key"), F.col("entity_id").alias("name"), every.alias("chunk"))
    named = named.select(group(block(F.col("part")), F.col("chunk")).alias("group"), F.lit(0).alias("kind"), F.col("part").cast("int").alias("part"), "key", "name", none["packed"].alias("packed"), none["keys"].alias("keys"))
    rows = index.select("part", F.struct("keys", "sizes", "postings").alias("packed"), every.alias("chunk"))
    rows = rows.select(group(block(F.col("part")), F.col("chunk")).alias("group"), F.lit(1).alias("kind"), "part", F.lit(0).cast("long").alias("key"), none["name"].alias("name"), "packed", none["keys"].alias("keys"))
    calls = queries.select("entity_id", "keys", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    calls = calls.select(group(F.col("block"), F.pmod(F.xxhash64("entity_id"), F.lit(chunks))).alias("group"), F.lit(2).alias("kind"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("key"), F.col("entity_id").alias("name"), none["packed"].alias("packed"), "keys")
    met = named.union(rows).union(calls).repartition(blocks * chunks, "group").sortWithinPartitions("group", "kind", "part", "key")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of group, kind, part and key: names of records (kind 0), their postings (1), then the queries (2)."""
        give_back()
        here, held, built = None, {}, None
        for batch in batches:
            groups, kinds, parts = (batch.column(c).to_numpy() for c in ("group", "kind", "part"))
            for a, b in _runs([groups, kinds, parts], batch.num_rows):
                own = batch.slice(a, b - a)
                if here != groups[a]:
                    here, held, built = groups[a], {}, None
                if kinds[a] == 0:
                    held.setdefault(int(parts[a]), ([], [], [], []))[0].append(own.column("name").to_numpy(zero_copy_only=False))
                elif kinds[a] == 1:
                    _, keys, sizes, postings = held[int(parts[a])]
                    for row in own.column("packed"):
                        for to, kind, values in zip((keys, sizes, postings), ("i8", "u4", "u2"), row.values()):
                            to.append(np.frombuffer(values.as_py(), kind))
                else:
                    if built is None:
                        built = [Part(*held.pop(p)) for p in list(held)]
                    values, starts = _lists(own.column("keys"))
                    for at in range(0, b - a, 512):
                        to, ids, found, shared = min(at + 512, b - a), [], [], []
                        for q in range(at, to):
                            keys = values[starts[q] : starts[q + 1]]
                            theirs, counts = best_of(built, keys, k)
                            if len(theirs) > k:
                                best = np.lexsort((theirs, -counts))[:k]
                                theirs, counts = theirs[best], counts[best]
                            ids.append(np.full(len(theirs), q))
                            found.append(theirs)
                            shared.append(counts)
                        ids = own.column("name").take(pa.array(np.concatenate(ids).astype("i8")))
                        yield pa.record_batch([ids, pa.array(np.concatenate(found), pa.string()), pa.array(np.concatenate(shared).astype("i8"))], ["s1_id", "s23_id", "overlap"])
        held = built = own = None
        give_back()

    best = met.mapInArrow(counted, "s1_id string, s23_id string, overlap long")
    best = stored(best if blocks == 1 else top_per_group(best, "s1_id", k, F.desc("overlap"), "s23_id"), "overlap-best")
    for done in (queries, names, index):
        removed(done)
    return best


#: Elements of sets that a task holds; tasks at least (queries' sets are repeated for them).
BLOCK_ELEMENTS, LEAST_GROUPS = 8_000_000, 4


class Sets:
    """Sets of 64-bit elements of many records, and how many of them another record's set holds."""

    def __init__(self, sizes: list[np.ndarray], values: list[np.ndarray]):
        self.ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, "i8"), *sizes]))])
        every = np.concatenate([np.zeros(0, "i8"), *values])
        values.clear()  # memory: an inverse of unique() would take as much again as all elements, several times
        self.vocabulary, self.elements = np.unique(every), np.empty(len(every), "i4")
        for at in range(0, len(every), 1 << 20):
            self.elements[at : at + (1 << 20)] = np.searchsorted(self.vocabulary, every[at : at + (1 << 20)])
        self.mark = np.zeros(len(self.vocabulary), bool)

    def shared(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For each of the rows how many elements it shares with a query."""
        if not len(query) or not len(self.vocabulary):
            return np.zeros(len(rows), "i8")
        at = np.minimum(np.searchsorted(self.vocabulary, query), len(self.vocabulary) - 1)
        at = at[self.vocabulary[at] == query]
        self.mark[at] = True
        met = np.concatenate([self.elements[a:b] for a, b in zip(self.ends[rows].tolist(), self.ends[rows + 1].tolist())])
        hits = np.concatenate([[0], np.cumsum(self.mark[met])])
        self.mark[at] = False
        ends = np.cumsum(self.ends[rows + 1] - self.ends[rows])
        return np.diff(hits[np.concatenate([[0], ends])])


def shared_elements(pairs: DataFrame, queries: DataFrame, records: DataFrame, columns: list[str], least_groups: int = LEAST_GROUPS) -> DataFrame:
    """(s1_id, s23_id, and for each column c: c_shared, c_a, c_b): of pairs how many elements both sets share and how many they have.

    queries and records are (entity_id, columns of distinct 64-bit elements), a row per id; pairs of unknown ids are dropped. Records
    are dealt to groups, queries go to every group: sets are moved once a group and not once a pair.
    """
    spark = pairs.sparkSession
    total = records.agg(F.coalesce(F.sum(sum((F.size(c) for c in columns), F.lit(0))), F.lit(0))).first()[0]
    groups = max(least_groups, -(-total // BLOCK_ELEMENTS))
    label = F.lit(labels(spark, groups))
    group = lambda id_: F.get(label, F.pmod(F.xxhash64(id_), F.lit(groups)).cast("int")).cast("long")
    none = [F.lit(None).cast("array<bigint>").alias(c) for c in columns]
    held = records.select(group("entity_id").alias("group"), F.lit(0).alias("kind"), F.col("entity_id").alias("id"), F.lit(None).cast("string").alias("other"), *columns)
    asked = queries.select(F.explode(label.cast("array<bigint>")).alias("group"), F.lit(1).alias("kind"), F.col("entity_id").alias("id"), F.lit(None).cast("string").alias("other"), *columns)
    wanted = pairs.select(group("s23_id").alias("group"), F.lit(1).alias("kind"), F.col("s1_id").alias("id"), F.col("s23_id").alias("other"), *none)
    met = held.union(asked).union(wanted).repartition(groups, "group").sortWithinPartitions("group", "kind", "id", F.asc_nulls_first("other"))
    names = ["s1_id", "s23_id", *(f"{c}_{x}" for c in columns for x in ("shared", "a", "b"))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of group, kind and id: sets of records (kind 0), then each query's sets and after them its pairs (1)."""
        give_back()
        here, places, taken, built, query, asks = None, {}, None, None, None, None
        for batch in batches:
            all_groups, kinds = (batch.column(c).to_numpy() for c in ("group", "kind"))
            for a, b in _runs([all_groups, kinds], batch.num_rows):
                own = batch.slice(a, b - a)
                ids, lists = own.column("id").to_pylist(), [_lists(own.column(c)) for c in columns]
                if here != all_groups[a]:
                    here, places, taken, built, query = all_groups[a], {}, [([], []) for _ in columns], None, None
                if kinds[a] == 0:
                    places.update(zip(ids, range(len(places), len(places) + len(ids))))
                    for (sizes, values), (found, starts) in zip(taken, lists):
                        sizes.append(np.diff(starts))
                        values.append(found.copy())
                    continue
                if built is None:
                    built, taken = [Sets(*x) for x in taken], None
                others, out = own.column("other").to_pylist(), []
                at = 0
                while at < len(ids):
                    if others[at] is None:
                        query, asks = ids[at], [values[starts[at] : starts[at + 1]].copy() for values, starts in lists]
                        at += 1
                        continue
                    to = at
                    while to < len(ids) and ids[to] == ids[at] and others[to] is not None:
                        to += 1
                    if query == ids[at]:
                        theirs = [x for x in others[at:to] if x in places]
                        rows = np.array([places[x] for x in theirs], "i8")
                        if len(rows):
                            numbers = [n for s, q in zip(built, asks) for n in (s.shared(q, rows), np.full(len(rows), len(q)), s.ends[rows + 1] - s.ends[rows])]
                            out.append((ids[at], theirs, numbers))
                    at = to
                if out:
                    first = pa.array([x for x, theirs, _ in out for _ in theirs], pa.string())
                    second = pa.array([y for _, theirs, _ in out for y in theirs], pa.string())
                    yield pa.record_batch([first, second, *(pa.array(np.concatenate(c).astype("i4")) for c in zip(*(x for _, _, x in out)))], names)

    return met.mapInArrow(counted, "s1_id string, s23_id string, " + ", ".join(f"{c} int" for c in names[2:]))
