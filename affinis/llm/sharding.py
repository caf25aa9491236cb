"""Minimax contiguous partition of ordered atomic groups, with DataFrame operations only.

Rows are ordered by the digest of their text, so equal texts are neighbours and form one atomic group. Digests are spread evenly,
so their first bits cut the order into slices of known size without a look at the data; a group larger than a slice follows the
rest of its slice, in parts of its own. Running sizes are summed within parts, over the parts of a stretch, and over stretches, so
no task sees more than its share.
The smallest capacity for which a greedy cut needs at most ``shards`` shards is found by binary search. The driver holds no
list of groups for that, only the least and greatest group end in each of some thousand intervals: with these it runs the
greedy check once pessimistically and once optimistically, and asks again, more finely, only where the two still differ.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.common import written

#: Rows of one ordered slice; stretches of slices; and intervals that one look at the group ends returns at most.
SLICE_ROWS, STRETCHES, INTERVALS = 100_000, 1024, 8192


def earlier(rows: DataFrame, order: Window) -> DataFrame:
    """rows with s and n summed over the rows before each."""
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({c: F.coalesce(F.sum(c).over(above), F.lit(0)) for c in ("s", "n")})


def ordered_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, digest, upto_size, upto_rows): rows by digest and id with running size and count."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    light = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "shard-rows",
    )
    slices = max(1, -(-light.count() // SLICE_ROWS))
    stretches = min(slices, STRETCHES)
    large = light.groupBy("digest").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("parts")).where("parts > 1")
    large = written(large, "shard-large")  # a row per SLICE_ROWS rows at most
    first_bits = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    dealt = light.join(large, "digest", "left").withColumns(
        {
            "slice": F.shiftright(first_bits * F.lit(slices), 32),
            "own": F.when(F.col("parts") > 1, F.col("digest")).otherwise(F.lit(b"")),
            "part": F.when(F.col("parts") > 1, F.pmod(F.xxhash64("doc_id"), F.col("parts"))).otherwise(0),
        }
    )
    piece, totals = ("slice", "own", "part"), (F.sum("size").alias("s"), F.count("*").alias("n"))
    within = Window.partitionBy(*piece).orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    pieces = dealt.groupBy(*piece).agg(*totals).withColumn("stretch", F.floor(F.col("slice") * stretches / F.lit(slices)))
    before = earlier(pieces, Window.partitionBy("stretch").orderBy(*piece))
    above = earlier(pieces.groupBy("stretch").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), Window.orderBy("stretch"))  # STRETCHES rows at most
    before = before.join(above.withColumnsRenamed({"s": "above_s", "n": "above_n"}), "stretch").select(*piece, (F.col("s") + F.col("above_s")).alias("s"), (F.col("n") + F.col("above_n")).alias("n"))
    running = dealt.withColumns({"own_s": F.sum("size").over(within), "own_n": F.count("*").over(within)}).join(before, [*piece])
    return written(
        running.select(
            "doc_id", "size", "text_crc32", "digest", (F.col("s") + F.col("own_s")).alias("upto_size"), (F.col("n") + F.col("own_n")).alias("upto_rows")
        ),
        "shard-order",
    )


class GroupEnds:
    """What the driver knows of the group ends: disjoint intervals (least, greatest, how many), in order."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total = ends, total
        self.known: list[tuple[int, int, int]] = []
        self.look([(0, total)])

    def look(self, windows: list[tuple[int, int]]) -> None:
        """Replaces what is known inside the windows by finer intervals."""
        per = max(1, INTERVALS // len(windows))
        place = F.lit(None).cast("long")
        for k, (lo, hi) in enumerate(windows):
            width = max(1, -(-(hi - lo + 1) // per))
            place = F.when(F.col("upto").between(lo, hi), k * per + F.floor((F.col("upto") - lo) / F.lit(width))).otherwise(place)
        found = self.ends.withColumn("at", place).where("at is not null").groupBy("at").agg(F.min("upto"), F.max("upto"), F.count("*")).collect()
        outside = [x for x in self.known if not any(lo <= x[0] and x[1] <= hi for lo, hi in windows)]
        self.known = sorted(outside + [(r[1], r[2], r[3]) for r in found])
        self.firsts = [x[0] for x in self.known]

    def cut(self, limit: int) -> tuple[int, int]:
        """Bounds of the last group end that is at most limit (0 where there is none)."""
        at = bisect_right(self.firsts, limit) - 1
        if at < 0:
            return 0, 0
        least, greatest, n = self.known[at]
        if limit >= greatest:
            return greatest, greatest
        return (least, least) if n <= 2 else (least, limit)

    def greedy(self, capacity: int, shards: int, optimistic: bool) -> list[int]:
        """Where the shards end when each takes all that fits."""
        ends = [0]
        for _ in range(shards):
            ends.append(self.cut(ends[-1] + capacity)[optimistic])
        return ends[1:]

    def least(self, shards: int, optimistic: bool) -> int:
        """The least capacity for which the greedy check reaches the end."""
        lo, hi = 0, self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.greedy(mid, shards, optimistic)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo


def minimax_cuts(ends: DataFrame, total: int, shards: int) -> list[int]:
    """The running sizes at which the shards end, for the smallest capacity that is enough; ends: column upto."""
    known = GroupEnds(ends, total)
    while True:
        low, high = known.least(shards, True), known.least(shards, False)
        pessimistic, optimistic = known.greedy(low, shards, False), known.greedy(high, shards, True)
        if low == high and pessimistic == optimistic:
            return pessimistic
        windows = []
        for first, last in zip([0, *pessimistic[:-1]], [0, *optimistic[:-1]]):
            inside = [x for x in known.known if x[2] > 2 and x[1] >= first + low and x[0] <= last + high]
            if inside:
                windows.append((inside[0][0], inside[-1][1]))
        merged: list[tuple[int, int]] = []
        for lo, hi in sorted(windows):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        known.look(merged)


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) under the law ``bytes``: the largest shard is as small as contiguous
    cuts between groups of equal texts allow.

    size is the text's UTF-8 bytes plus 1; null texts have size 1 and are one group with empty ones. Equal texts share a
    shard; repeated rows get a slot each; rows with a null doc_id come first within their group; an empty table gives no
    rows; further columns are ignored. With fewer groups than shards the last shards stay empty.
    """
    order = ordered_sizes(docs, id_col, text_col)
    ends = written(order.groupBy("digest").agg(F.max("upto_size").alias("upto"), F.max("upto_rows").alias("rows")), "shard-ends")
    total = ends.agg(F.max("upto")).first()[0] or 0
    cuts = minimax_cuts(ends, total, shards)[:-1] if total else []
    inner = sorted({c for c in cuts if 0 < c})
    rows_at = {r.upto: r.rows for r in ends.where(F.col("upto").isin(inner)).select("upto", "rows").collect()} if inner else {}
    shard, start = F.lit(0), F.lit(0).cast("long")
    for k, cut in enumerate(cuts):
        shard = F.when(F.col("upto_size") > cut, k + 1).otherwise(shard)
        start = F.when(F.col("upto_size") > cut, F.lit(rows_at.get(cut, 0)).cast("long")).otherwise(start)
    return order.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("upto_rows") - 1 - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
