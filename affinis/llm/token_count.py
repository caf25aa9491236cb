"""Token counts of a BPE piece model by heap-and-linked-list merging, without making ids.

The count of a word is its initial symbols minus the merges done: the lowest-ranked adjacent pair is popped from a heap,
its right symbol is unlinked, and the two pairs this makes are pushed. Symbols the vocabulary lacks count as their UTF-8
bytes and never merge. Pieces of the model never continue past a word, so a text's count is the sum over its words,
which a worker remembers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import holding, tokenizer_file

#: Words that a worker remembers.
CACHE_WORDS = 600_000
SPACE = "▁"


class PieceCounter:
    """Counts tokens as a sentencepiece BPE model with byte fallback, dummy prefix and identity normalisation does."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and trainer.byte_fallback):
            raise ValueError("only models with identity normalisation, a dummy prefix and byte fallback are counted")
        pieces = [p for p in model.pieces if p.type == 1]
        self.rank = {p.piece: i for i, p in enumerate(sorted(pieces, key=lambda p: -p.score))}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank) or "\n" in "".join(self.rank):
            raise ValueError("pieces of this model continue past words")
        self.segments = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.words = _Words(self)

    def merged(self, segment: str) -> int:
        """Tokens of one segment: symbols minus merges."""
        rank = self.rank
        symbols = list(segment)
        count = sum(1 if c in rank else len(c.encode()) for c in symbols)
        n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, pair) for i in range(n - 1) if (r := rank.get(pair := symbols[i] + symbols[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = following[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue  # one of the two has merged since
            count -= 1
            symbols[i], symbols[j] = pair, ""
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (r := rank.get(longer := pair + symbols[k])) is not None:
                    heappush(heap, (r, i, longer))
            if (h := before[i]) >= 0 and (r := rank.get(longer := symbols[h] + pair)) is not None:
                heappush(heap, (r, h, longer))
        return count

    def count(self, text: str) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        total, words = 0, self.words
        for k, line in enumerate((" " + text).split("\n")):
            total += k > 0  # the line feed is a byte
            first, *rest = line.split(" ")
            if "" in rest:
                total += sum(map(self.merged, self.segments(line.replace(" ", SPACE))))
            else:
                total += sum(map(words.__getitem__, rest)) + (self.merged(first) if first else 0)
        return total


class _Words(dict):
    """Counts of words that follow one space."""

    def __init__(self, counter: PieceCounter):
        self.counter = counter

    def __missing__(self, word: str) -> int:
        n = self.counter.merged(SPACE + word)
        if len(self) < CACHE_WORDS and len(word) < 64:
            self[word] = n
        return n


_counters: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """This process's counter for a model file."""
    if path not in _counters:
        _counters[path] = PieceCounter(tokenizer_file(path))
    return _counters[path]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; no shuffle.

    Null and empty texts have 0 bytes and tokens; repeated rows are counted each; an empty table gives no rows; a null
    doc_id stays null; further columns are ignored. Very long words are merged in n log n steps.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding("token_count", _counters.clear)
        count = counter(model).count
        for batch in batches:
            tokens, sizes = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                tokens.append(count(text))
                sizes.append(len(text) if text.isascii() else len(text.encode()))
            n = pa.array(tokens, pa.int64())
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), n, pa.array([t > limit for t in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(counts, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
