"""Best-fit packing by exact-complement hashing.

Token lengths never exceed the capacity, so the whole packing problem is a histogram of at most ``capacity`` counts,
whatever the corpus size. The driver plans on that histogram alone: it keeps an index of the lengths still available
(a bit set and its mirror image, in which a pair with a given sum is one shift and one AND), fills each gap exactly with a
single, a pair or a triple of available lengths, and only when no exact complement exists takes the longest length that
fits. A pattern is consumed as often as the counts allow, so the plan has a few rows per length. Executors tokenize the
documents, number the pieces of each length, and look their place up in the plan.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.common import holding, tokenizer_file, written

#: Pieces that one numbering group holds on average, and words that a worker remembers.
GROUP_ROWS, CACHE_WORDS, CACHE_PARTS = 20_000, 300_000, 150_000
RANK_BITS = 40


class WordEncoder:
    """Ids of a tokenizers file with a white-space-free pre-tokenization, word by word, remembering words.

    The file's tokenizer drops white space and never joins what white space parts, so a text's ids are those of its
    words in turn. Only the file's own model turns parts of words into ids; words outside the plain case (lower-casing
    that depends on neighbours, special-token strings, non-NFC) are encoded by the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        self.as_char = [chr(b) if b in kept else chr(next(spare)) for b in range(256)]
        self.special = regex.compile("|".join(regex.escape(t.content) for t in self.whole.get_added_tokens_decoder().values())).search
        self.words, self.parts = _Memo(self.word, CACHE_WORDS), _Memo(self.part, CACHE_PARTS)

    def part(self, part: str) -> bytes:
        mapped = part if part.isascii() else "".join(self.as_char[b] for b in part.encode())
        return np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()

    def word(self, word: str) -> bytes:
        plain = word.isascii() or ("Σ" not in word and unicodedata.is_normalized("NFC", word))
        if not plain or ("<|" in word and self.special(word)) or any(c.isspace() or not c.isprintable() for c in word):
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.parts.__getitem__, self.split(word.lower())))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


class _Memo(dict):
    """A dict that computes what it lacks, and keeps it while it has room."""

    def __init__(self, compute, room: int):
        self.compute, self.room = compute, room

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.room and len(key) < 64:
            self[key] = value
        return value


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(tokenizer_file(path))
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """Documents as token pieces of at most ``capacity``: (doc_id, piece, start, length, ids_crc32[, ids])."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding("packing", _encoders.clear)
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    row = (doc_id, k, at // 4, len(own) // 4, zlib.crc32(own))
                    out.append((*row, np.frombuffer(own, "<u4").astype("i8")) if with_ids else row)
            columns = list(zip(*out)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(pieces, ddl)


def plan_sequences(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in order, how often) that use counts[length] pieces of every length and fill ``capacity``."""
    left = counts.astype("i8").copy()
    have = sum(1 << int(n) for n in np.flatnonzero(left))
    mirror = sum(1 << (capacity - int(n)) for n in np.flatnonzero(left))

    def take(n: int, by: int = 1) -> None:
        nonlocal have, mirror
        had, left[n] = left[n] > 0, left[n] - by
        if had != (left[n] > 0):
            have ^= 1 << n
            mirror ^= 1 << (capacity - n)

    def pair(total: int, most: int) -> tuple[int, int] | None:
        both = have & (mirror >> (capacity - total)) & ((2 << most) - 1)
        while both:
            a = both.bit_length() - 1
            if 2 * a < total:
                return None
            if 2 * a > total or left[a] > 1:
                return a, total - a
            both ^= 1 << a
        return None

    def triple(total: int) -> tuple[int, int, int] | None:
        rest = have & ((1 << total) - 1)
        while rest:
            a = rest.bit_length() - 1
            if 3 * a < total:
                return None
            take(a)
            found = pair(total - a, min(a, total - a))
            take(a, -1)
            if found:
                return a, *found
            rest ^= 1 << a
        return None

    plan = []
    while have:
        first = have.bit_length() - 1
        lengths, gap = [first], capacity - first
        take(first)
        while gap and (fits := have & ((2 << gap) - 1)):
            if left[gap] > 0:
                chosen = (gap,)
            else:
                chosen = pair(gap, gap) or triple(gap) or (fits.bit_length() - 1,)
            for n in chosen:
                take(n)
            lengths += chosen
            gap -= sum(chosen)
        used = {n: lengths.count(n) for n in lengths}
        more = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            take(n, k * more)
        plan.append((lengths, 1 + more))
    return plan


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """pieces (doc_id, piece, .., length) with sequence_id and offset: whole sequences of at most ``capacity``.

    No row is dropped; repeated documents are packed once each; an empty table gives an empty table. A null doc_id is kept
    and packed like any other. Other columns of ``pieces`` pass through.
    """
    pieces = written(pieces, "pieces")
    counts = np.zeros(capacity + 1, "i8")
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    starts, shift, places, after, base = [], [], [], np.zeros(capacity + 1, "i8"), 0
    for lengths, times in plan_sequences(counts, capacity):
        at = 0
        for n in lengths:
            starts.append((n << RANK_BITS) | int(after[n]))
            shift.append(base - int(after[n]))
            places.append(at)
            after[n] += times
            at += n
        base += times
    order = np.argsort(np.array(starts, "i8"))
    starts, shift, places = (np.array(x, "i8")[order] for x in (starts, shift, places))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            row = np.searchsorted(starts, (batch.column("length").to_numpy() << RANK_BITS) | rank, "right") - 1
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(shift[row] + rank), pa.array(places[row])], [*kept, "sequence_id", "offset"])

    groups = max(1, -(-int(counts.sum()) // GROUP_ROWS))
    tagged = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))
    sizes = tagged.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before")
    )
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece"))
    ranked = tagged.withColumn("within", within).join(before, ["length", "part"])
    ranked = ranked.select(*pieces.columns, (F.col("before") + F.col("within") - 1).alias("rank"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{ddl}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """Documents packed into as few sequences as the plan finds: one row per piece.

    Null and empty texts are one piece of the end id alone; very long texts are cut every ``capacity`` tokens; equal texts
    and repeated rows are packed each; an empty table gives no rows; further columns are ignored.
    """
    return pack(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), capacity)
