"""Words of whole texts in Arrow batches: what is asked of a word is found once for each word of a batch's vocabulary."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.text import CANONICAL
from affinis.schema import ACCENTED, FOLDED

#: Bytes of text that are worked on at once, but for a single text.
PIECE_BYTES = 4 << 20
#: Parities of a set at least; larger sets of n words have the power of two from 2 n up.
LEAST_PARITIES = 512
_INSIDE = np.zeros(256, bool)
_INSIDE[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_LOWER = np.arange(256, dtype="u1")
_LOWER[ord("A") : ord("Z") + 1] += 32
#: What an accented letter folds to, by its second byte: all are of two bytes, the first of which is _LEAD.
_LEAD, _FOLD = 0xC3, np.zeros(256, "u1")
for _a, _f in zip(ACCENTED, FOLDED):
    for _c in (_a, _a.upper()):
        _FOLD[_c.encode()[1]] = ord(_f)
#: The other letters whose lower case has one of a-z.
_RARE = "\u0130\u212a"


def text_of(text: Column) -> Column:
    """A text as Words takes it, '' for null: of what Words does not put into lower case itself nothing becomes one of a-z."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(_RARE[0]) | text.contains(_RARE[1]), F.lower(text)).otherwise(text)


def give_back() -> None:
    """Memory that is free within a Python worker goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


class Words:
    """The folded words of texts: the vocabulary, each word's number in it (codes) and its text (rows)."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        """Of texts that end where the next begins: n + 1 offsets into data."""
        data, offsets = _LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
        lead = np.flatnonzero(data == _LEAD)
        if len(lead):
            lead = lead[_FOLD[data[lead + 1]] > 0]
            data[lead + 1] = _FOLD[data[lead + 1]]
            data, offsets = np.delete(data, lead), offsets - np.searchsorted(lead, offsets)
        inside = _INSIDE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begun = offsets[:-1][offsets[:-1] < len(data)]
        first[begun] = inside[begun]
        begins, kept = np.flatnonzero(first), data[inside]
        ends = np.append(np.flatnonzero(first[inside]), len(kept)).astype("i4")
        words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(ends), pa.py_buffer(kept)).dictionary_encode()
        self.n, self.vocabulary, self.codes = len(offsets) - 1, words.dictionary, words.indices.to_numpy()
        self.starts = np.searchsorted(begins, offsets)
        self.rows = np.repeat(np.arange(self.n), np.diff(self.starts))


def pieces(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) of runs of texts without nulls, of PIECE_BYTES at most or a single one."""
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, "i8")[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, "i8")
    data = np.frombuffer(data, "u1") if data is not None and data.size else np.zeros(0, "u1")
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        yield at, to, Words(offsets[at : to + 1], data)
        at = to


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in any batch."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False).view("i8") if len(words) else np.zeros(0, "i8")


def sets(hashes: np.ndarray, codes: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """For each of n rows the distinct hashes of its codes, in order."""
    order = np.argsort(hashes)
    rank = np.empty(len(order), "i8")
    rank[order] = np.arange(len(order))
    met = rows * len(order) + rank[codes]
    met.sort()
    met = met[np.append(True, met[1:] != met[:-1])] if len(met) else met
    of, at = np.divmod(met, max(len(order), 1))
    return _lists(pa.array(hashes[order][at]), of, n)


def _lists(values: pa.Array, rows: np.ndarray, n: int) -> pa.Array:
    """Values of ascending rows as a list for each of n rows."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(rows, minlength=n))).astype("i4")), values)


def word_sets(texts: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, words): the distinct folded words of each text as sorted 64-bit hashes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for at, to, w in pieces(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(at, to - at), sets(hashed(w.vocabulary), w.codes, w.rows, w.n)], [id_, "words"])

    of = texts.select(id_, text_of(F.col(text)).alias("text"))
    return of.mapInArrow(made, f"{id_} {of.schema[0].dataType.simpleString()}, words array<long>")


def parities(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """For each of the sets, of which values are all elements in turn: how many have each value modulo its number of parities, modulo two."""
    bits = np.maximum(LEAST_PARITIES, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype("i8"))
    ends = np.append(0, np.cumsum(bits))
    odd = np.bincount(np.repeat(ends[:-1], sizes) + (values & (np.repeat(bits, sizes) - 1)), minlength=int(ends[-1])) & 1
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer((ends >> 3).astype("i8")), pa.py_buffer(np.packbits(odd.astype("u1")))]).cast(pa.binary())


def set_sketches(texts: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, n, mark, parities) of word_sets(), where sets are not empty: their sizes, a 64-bit hash of the set, and parities()."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for at, to, w in pieces(batch.column(1)):
                own = sets(hashed(w.vocabulary), w.codes, w.rows, w.n)
                sizes, values = own.value_lengths().to_numpy().astype("i8"), own.values.to_numpy()
                held = np.flatnonzero(sizes)  # rows without words have no values
                if not len(held):
                    continue
                sizes, mixed = sizes[held], values.view("u8") * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                mark = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), np.append(0, np.cumsum(sizes)[:-1])).view("i8")
                yield pa.record_batch([batch.column(0).slice(at, to - at).take(pa.array(held)), pa.array(sizes), pa.array(mark), parities(values, sizes)], [id_, "n", "mark", "parities"])

    of = texts.select(id_, text_of(F.col(text)).alias("text"))
    return of.mapInArrow(made, f"{id_} {of.schema[0].dataType.simpleString()}, n long, mark long, parities binary")


def _first(codes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k codes of each of ascending rows, and their rows."""
    here = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return codes[here], rows[here]


def canonical(w: Words) -> tuple[pa.Array, np.ndarray]:
    """The vocabulary of texts with what legal suffixes become, and the number in it that each word becomes (-1: it is left out)."""
    suffixes, targets = list(CANONICAL), sorted({to for to in CANONICAL.values() if to})
    words = pa.concat_arrays([w.vocabulary, pa.array(targets, pa.string())])
    becomes = np.arange(len(words))
    for s, where in zip(suffixes, pc.index_in(pa.array(suffixes, pa.string()), value_set=w.vocabulary).to_pylist()):
        if where is not None:
            becomes[where] = len(w.vocabulary) + targets.index(CANONICAL[s]) if CANONICAL[s] else -1
    return words, becomes


def record_words(texts: DataFrame, text: str, name_words: int = 6) -> DataFrame:
    """(entity_id, norm_name, places, addr) of (entity_id, text): the first words of a text are its name, all others its address, both
    normalised as by normalize_words(); places are the address's first two words that name a place and its first two numbers, addr the
    64-bit hashes of all that name a place: those of four letters or more that are no numbers."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for at, to, w in pieces(batch.column(1)):
                words, becomes = canonical(w)
                codes, rows, named = becomes[w.codes], w.rows, np.arange(len(w.codes)) - w.starts[w.rows] < name_words
                codes, rows, named = (x[codes >= 0] for x in (codes, rows, named))
                new = np.ones(len(codes), bool)  # no stutters
                new[1:] = (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1]) | (named[1:] != named[:-1])
                codes, rows, named = codes[new], rows[new], named[new]
                name = pc.binary_join(_lists(words.take(pa.array(codes[named])), rows[named], w.n), " ")
                codes, rows = codes[~named], rows[~named]
                number = pc.match_substring_regex(words, "^[0-9]+$").to_numpy(zero_copy_only=False)
                place = ~number & (pc.binary_length(words).to_numpy() >= 4)
                is_place, is_number = place[codes], number[codes]
                two, those = _first(codes[is_place], rows[is_place], 2), _first(codes[is_number], rows[is_number], 2)
                order = np.argsort(np.concatenate([two[1], those[1]]), kind="stable")
                of = np.concatenate([two[1], those[1]])[order]
                places = _lists(words.take(pa.array(np.concatenate([two[0], those[0]])[order])), of, w.n)
                addr = sets(hashed(words), codes[is_place], rows[is_place], w.n)
                yield pa.record_batch([batch.column(0).slice(at, to - at), name, places, addr], ["entity_id", "norm_name", "places", "addr"])

    of = texts.select("entity_id", text_of(F.col(text)).alias("text"))
    return of.mapInArrow(made, "entity_id string, norm_name string, places array<string>, addr array<long>")
