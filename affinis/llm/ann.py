"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised separately, so K centroids a half give K*K cells. A query walks the centroid pairs
from the best summed score down with a heap, a few centroids of either half at a step, and stops by a model instead of a fixed number of cells: a row's score is taken
as its cell's score plus a normal error of the quantisers' known spread, so the cell counts give the score that the k-th
neighbour will have and the share of neighbours that the cells not yet walked may still hold. On clustered vectors few cells
are walked, on shapeless ones many, at the same recall. All rows of walked cells are reranked by the exact inner product.

Rows of cells are dealt to blocks of bounded size (large cells to several), queries with the score at which their walk ended to
the blocks that they walk. A block's rows are read once and its queries stream past them; only a block with very many visits is
repeated, once per so many. Each block returns its best rows per query, and only these meet again.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.common import written

#: Rows for each of the K * K cells, which sets the centroids a half between these bounds; rows that train them at most (those with the smallest hash of their id); rounds of training.
CELL_ROWS, FEWEST, MOST, SAMPLE_ROWS, ROUNDS = 16, 8, 256, 20_000, 12
#: Centroids of a half that a step of the walk takes together.
STRIDE = 8
#: Share of the expected neighbours that the walked cells must hold; rows of a block; visits of a block in one task.
SHARE, BLOCK_ROWS, BLOCK_VISITS = 0.985, 4096, 16_384


def train_half(half: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k centroids of the rows by k-means from distinct evenly spread rows; fewer where there are fewer distinct rows."""
    distinct = np.unique(half, axis=0)
    centroids = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(rounds):
        own = nearest(half, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, half)
        n = np.bincount(own, minlength=len(centroids))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row."""
    return np.argmin((centroids**2).sum(axis=1) - 2 * rows @ centroids.T, axis=1)


class MultiIndex:
    """Two codebooks, their spreads and the rows of each cell."""

    def __init__(self, sample: np.ndarray, k: int):
        self.cut = sample.shape[1] // 2 or 1
        halves = sample[:, : self.cut], sample[:, self.cut :]
        self.books = [train_half(h, k) for h in halves]
        errors = [h - b[nearest(h, b)] for h, b in zip(halves, self.books)]
        self.spread = [float((e**2).mean()) if e.size else 0.0 for e in errors]
        self.counts = np.zeros(len(self.books[0]) * len(self.books[1]), "i8")

    def cells(self, rows: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        a, b = nearest(rows[:, : self.cut], self.books[0]), nearest(rows[:, self.cut :], self.books[1])
        return a * len(self.books[1]) + b

    def scores(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each query's inner products with the centroids of both halves."""
        return queries[:, : self.cut] @ self.books[0].T, queries[:, self.cut :] @ self.books[1].T

    def walk(self, query: np.ndarray, k: int, share: float) -> list[int]:
        """The non-empty cells to search for a query's k nearest rows, best first."""
        halves = query[: self.cut], query[self.cut :]
        one, two = (book @ half for book, half in zip(self.books, halves))
        sigma = math.sqrt(sum(s * float(h @ h) for s, h in zip(self.spread, halves))) or 1e-12
        scores, filled = (one[:, None] + two[None, :]).ravel(), self.counts > 0
        scores, counts = scores[filled], self.counts[filled]
        wanted = min(k, int(counts.sum()))
        lo, hi = float(scores.min()) - 9 * sigma, float(scores.max()) + 9 * sigma
        for _ in range(18):  # the score that the k-th nearest row is expected to have
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (counts * _tail((mid - scores) / sigma)).sum() > wanted else (lo, mid)
        expected, rows = np.zeros(len(self.counts)), self.counts
        expected[filled] = counts * _tail((lo - scores) / sigma)
        enough = share * expected.sum()
        first, second = np.argsort(-one), np.argsort(-two)
        heap, seen, found, have, held = [(-one[first[0]] - two[second[0]], 0, 0)], {(0, 0)}, 0.0, 0, []
        least = -math.inf
        while heap and (found < enough or have < wanted + 1 or -heap[0][0] >= least):
            _, i, j = heapq.heappop(heap)
            a, b = first[i : i + STRIDE], second[j : j + STRIDE]
            cells = (a[:, None] * len(two) + b[None, :]).ravel()
            held.append((cells, (one[a][:, None] + two[b][None, :]).ravel()))
            found, have = found + float(expected[cells].sum()), have + int(rows[cells].sum())
            if least == -math.inf and found >= enough and have >= wanted + 1:
                least = self._last(held, expected, enough, wanted)[0]  # what is still to come above it is taken too
            for x, y in ((i + STRIDE, j), (i, j + STRIDE)):
                if x < len(one) and y < len(two) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-one[first[x]] - two[second[y]], x, y))
        least, walked, values = self._last(held, expected, enough, wanted)
        return walked[(values >= least) & (rows[walked] > 0)].tolist()

    def _last(self, held: list[tuple[np.ndarray, np.ndarray]], expected: np.ndarray, enough: float, wanted: int) -> tuple[float, np.ndarray, np.ndarray]:
        """The score of the last cell that is needed, best first, and the cells and scores seen so far."""
        walked, values = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(-values)
        reached = (np.cumsum(expected[walked[order]]) >= enough) & (np.cumsum(self.counts[walked[order]]) >= wanted + 1)
        return float(values[order[np.argmax(reached)]]) if reached.any() else -math.inf, walked, values


def _tail(z: np.ndarray) -> np.ndarray:
    """The share of a normal distribution above z (a logistic form, within 0.0002)."""
    return 1 / (1 + np.exp(np.clip(0.07056 * z**3 + 1.5976 * z, -60, 60)))


def best_rows(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, exact scores) of the k best rows without the query's own; ids ascend; rough: scores up to rounding, -inf where not searched."""
    rough = np.where(ids == own, -np.inf, rough)
    if len(rough) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        chosen = np.flatnonzero((rough >= least - 1e-9 * max(1.0, abs(least))) & (rough > -np.inf)) if least > -np.inf else np.flatnonzero(rough > -np.inf)
    else:
        chosen = np.flatnonzero(rough > -np.inf)
    exact = (rows[chosen] * query).sum(axis=1)
    best = np.lexsort((ids[chosen], -exact))[:k]
    return ids[chosen][best], exact[best]


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(-1, width)


def centroids_for(rows: int) -> int:
    """Centroids a half for so many rows: as many cells as CELL_ROWS rows each would fill."""
    return min(MOST, max(FEWEST, math.ceil(math.sqrt(rows / CELL_ROWS))))


def search(embeddings: DataFrame, k: int = 20, every: int = 20, centroids: int | None = None, share: float = SHARE, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, block_visits: int = BLOCK_VISITS) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found of every query row, those whose id is divisible by ``every``.

    Nearness is the inner product in double precision; ties go to the smaller vec_id. Rows with a null id, or whose vector is
    null, empty, zero, of another length than most (no inner product is defined), or holds null or non-finite components take no
    part; of repeated rows with one id each is a candidate of other queries, and the one with the smallest vector is the query;
    fewer candidates than k are all returned; an empty table gives no rows; further columns are ignored.
    """
    spark = embeddings.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    whole = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    valid = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where("vec_id is not null and v is not null").where(whole)
    sizes = valid.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = sizes[0], sizes[1]
    valid = valid.where(F.size("v") == width)
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE_ROWS).select("v").toArrow()
    index = MultiIndex(_matrix(sample.column(0), width), centroids or centroids_for(total))

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([*batch.columns, pa.array(index.cells(_matrix(batch.column(1), width)).astype("i8"))], ["vec_id", "v", "cell"])

    indexed = written(valid.mapInArrow(celled, "vec_id long, v array<double>, cell long"), "ann-index")
    for cell, n in indexed.groupBy("cell").count().collect():  # K*K rows at most
        index.counts[cell] = n
    # cells in order fill blocks; a cell of more rows than a block has blocks of its own
    first_block, n_blocks, block, room = np.zeros(len(index.counts), "i8"), np.ones(len(index.counts), "i8"), 0, block_rows
    for cell in np.flatnonzero(index.counts):
        n = int(index.counts[cell])
        if n > room and room < block_rows:
            block, room = block + 1, block_rows
        first_block[cell], n_blocks[cell] = block, -(-n // block_rows)
        block, room = (block + int(n_blocks[cell]), block_rows) if n > block_rows else (block, room - n)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cells = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            mixed = ((ids.view("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype("i8")
            blocks = first_block[cells] + mixed % n_blocks[cells]
            yield pa.record_batch([pa.array(blocks), *batch.columns], ["block", "id", "v", "cell"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_pylist(), _matrix(batch.column(1), width)
            for own, query in zip(ids, vectors):
                cells = np.array(index.walk(query, k, share))
                one, two = index.scores(query[None])
                least = float((one[0, cells // two.shape[1]] + two[0, cells % two.shape[1]]).min())
                blocks = np.unique(np.concatenate([np.arange(b, b + n) for b, n in zip(first_block[cells], n_blocks[cells])]))
                rows = len(blocks)
                columns = [pa.array(blocks), pa.array([own] * rows, pa.int64()), pa.array([query] * rows, pa.list_(pa.float64())), pa.array([least] * rows)]
                yield pa.record_batch(columns, ["block", "id", "v", "least"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of block, part, kind and id: the rows of a block (kind 0), then the queries that visit it (kind 1)."""
        here, parts, rows = None, [], None
        for batch in batches:
            blocks, part, kinds, ids, cells, least = (batch.column(n).to_numpy() for n in ("block", "part", "kind", "id", "cell", "least"))
            vectors = _matrix(batch.column("v"), width)
            changed = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(part) != 0) | (np.diff(kinds) != 0)) + 1
            for at, to in zip([0, *changed.tolist()], [*changed.tolist(), batch.num_rows]):
                if at == to:
                    continue
                if here != (blocks[at], part[at]):
                    here, parts, rows = (blocks[at], part[at]), [], None
                if kinds[at] == 0:
                    parts.append((ids[at:to], cells[at:to], vectors[at:to]))
                    continue
                if rows is None:
                    rows = [np.concatenate(c) for c in zip(*parts)]
                for start in range(at, to, 256):
                    own = slice(start, min(start + 256, to))
                    one, two = index.scores(vectors[own])
                    reach = one[:, rows[1] // two.shape[1]] + two[:, rows[1] % two.shape[1]]
                    rough = np.where(reach >= least[own, None] - 1e-9, vectors[own] @ rows[2].T, -np.inf)
                    out = [(q, *best_rows(v, q, rows[0], rows[2], r, k)) for q, v, r in zip(ids[own], vectors[own], rough)]
                    columns = [np.concatenate([np.full(len(found), q) for q, found, _ in out]), np.concatenate([o[1] for o in out]), np.concatenate([o[2] for o in out])]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    queries = indexed.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.repartition(2 * spark.sparkContext.defaultParallelism)  # the walks are the work, however small the table
    visits = written(queries.mapInArrow(walked, "block long, id long, v array<double>, least double"), "ann-visits")
    parts = visits.groupBy("block").agg(F.ceil(F.count("*") / block_visits).alias("parts"))
    rows = indexed.mapInArrow(dealt, "block long, id long, v array<double>, cell long").join(parts, "block")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    calls = visits.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    both = rows.select("block", "part", F.lit(0).alias("kind"), "id", "v", "cell", F.lit(0.0).alias("least")).union(
        calls.select("block", "part", F.lit(1), "id", "v", F.lit(0).cast("long"), "least")
    )
    met = both.repartition("block", "part").sortWithinPartitions("block", "part", "kind", "id")
    found = met.mapInArrow(ranked, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
