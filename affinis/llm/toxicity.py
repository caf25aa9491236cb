"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text: each holds the segments (word beginnings and
words) that are far more frequent in its class, followed by material that both share. The shared part lies nearest to the
text, so a window compresses to the same length with both unless it uses one class's own segments. A window's distance is
the difference of its two compressed lengths. A document's score comes from its greatest distance and from how much
distance its windows gather, calibrated on documents that the dictionaries were not trained on.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from affinis.llm.common import holding

#: Labelled rows that train the model at most: those with the smallest hash of their id, by label; and bytes of their texts, in the same order.
TOXIC_ROWS, ORDINARY_ROWS, TRAIN_BYTES = 1500, 3000, 64_000_000
#: Bytes of a window: below what zstandard entropy-codes literals from, so that lengths differ by matches alone.
WINDOW = 56
#: A class segment is in this share of its class's texts (and in this many), and this many times likelier there.
SHARE, LEAST, RATIO, SEGMENT_BYTES, SHARED_SEGMENTS = 0.015, 3, 20, 4096, 1500
#: Stretches of class segments in this share of ordinary texts belong to the shared part.
NEUTRAL = 0.003
PARAMETERS = dict(window_log=17, chain_log=14, hash_log=14, search_log=5, min_match=5, target_length=64, strategy=5, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
#: Starts every window and ends every dictionary: keeps blocks compressible, so that each byte gained in the window shows.
PRIMER = bytes(range(1, 9)) + bytes(range(14, 32)) + bytes(range(33, 64)) + bytes(range(91, 97))
WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
CUT = re.compile(rb"(?s).{1,%d}(?=\s|\Z)|.{1,%d}" % (WINDOW, WINDOW))


def word_segments(word: bytes) -> list[bytes]:
    """Beginnings of 4 to 12 bytes of a word, and a word of 4 to 14 whole."""
    found = [b" " + word[:k] for k in range(4, min(len(word), 12) + 1)]
    return found + [b" " + word + b" "] * (3 < len(word) < 15)


class Segments:
    """The segments of texts, by number: each word's are found once, however often and for whatever they are counted."""

    def __init__(self, texts: Iterable[bytes]):
        words: dict[bytes, int] = {}
        self.by_text = {t: np.fromiter((words.setdefault(w, len(words)) for w in set(WORD.findall(t))), "i4") for t in texts}
        self.words = list(words)
        hashes = np.fromiter((xxh64_intdigest(s) for w in self.words for s in word_segments(w)), "u8")
        self.starts = np.append(0, np.cumsum(np.fromiter((len(word_segments(w)) for w in self.words), "i8", len(self.words))))
        distinct, self.of_words = np.unique(hashes, return_inverse=True)
        self.n = len(distinct)

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """In how many of the texts each segment is."""
        found = np.zeros(self.n, "i8")
        for text in texts:
            own = self.by_text[text]
            if len(own):
                found[np.unique(np.concatenate([self.of_words[self.starts[w] : self.starts[w + 1]] for w in own]))] += 1
        return found

    def names(self, numbers: np.ndarray) -> dict[int, bytes]:
        """What the numbered segments are."""
        at = np.flatnonzero(np.isin(self.of_words, numbers))
        return {int(self.of_words[k]): word_segments(self.words[w])[k - self.starts[w]] for k, w in zip(at, np.searchsorted(self.starts, at, "right") - 1)}


def class_segments(own: list[bytes], other: list[bytes], known: Segments) -> bytes:
    """Segments typical of own against other, the most telling last."""
    n, against = known.counts(own), known.counts(other)
    frequent = n >= max(LEAST, SHARE * len(own))
    telling = np.flatnonzero(frequent & (n / max(1, len(own)) > RATIO * (against + 0.25) / max(1, len(other))))
    out = b""
    for _, segment in sorted(((int(n[k]) * len(name), name) for k, name in known.names(telling).items()), reverse=True):
        if segment not in out and len(out) + len(segment) <= SEGMENT_BYTES:
            out = segment + out
    return out


def shared_part(ordinary: list[bytes], own: bytes) -> bytes:
    """What both dictionaries end with: stretches of class segments that ordinary text uses too, and its commonest words."""
    stretches = {own[i : i + k] for k in range(5, 11) for i in range(len(own) - k + 1)}
    used: Counter[bytes] = Counter()
    if stretches:
        finder = ahocorasick.Automaton()
        for s in stretches:
            finder.add_word(s.decode("latin-1"), s)
        finder.make_automaton()
        for text in ordinary:
            used.update({s for _, s in finder.iter(text.decode("latin-1"))})
    neutral = [s for s, k in used.items() if k >= max(1, NEUTRAL * len(ordinary))]
    neutral = sorted(s for s in neutral if not any(s != t and s in t for t in neutral))
    words = Counter(b" " + w for text in ordinary for w in set(WORD.findall(text)) if len(w) > 3)
    common = sorted(words.items(), key=lambda x: (x[1] * len(x[0]), x[0]))[-SHARED_SEGMENTS:]
    return b"\n".join(neutral) + b"\n" + b"".join(w for w, _ in common)


@dataclass
class Model:
    """Two dictionaries and the calibration of distances."""

    toxic: bytes
    ordinary: bytes
    weights: list[float] = field(default_factory=list)
    prior: float = 0.0

    def __getstate__(self):
        return self.toxic, self.ordinary, self.weights, self.prior

    def __setstate__(self, state):
        self.toxic, self.ordinary, self.weights, self.prior = state

    def compressors(self):
        """The compressing functions of both dictionaries."""
        if "made" not in self.__dict__:
            parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
            self.made = []
            for content in (self.ordinary, self.toxic):
                dictionary = zstandard.ZstdCompressionDict(content + PRIMER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(compression_params=parameters)
                self.made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress)
        return self.made

    def features(self, text: str) -> list[float]:
        """1, the greatest distance of a window, and the distance that windows gather, damped."""
        ordinary, toxic = self.compressors()
        greatest = gathered = 0
        for window in CUT.findall(text.lower().encode()):
            primed = PRIMER + window
            distance = len(ordinary(primed)) - len(toxic(primed))
            if distance > 0:
                greatest = max(greatest, distance)
                gathered += distance - 1
        return [1.0, float(min(greatest, 10)), math.log1p(gathered)]

    def score(self, text: str) -> float:
        """How likely a text is toxic; the prior where nothing was learnt."""
        if not self.weights:
            return self.prior
        z = sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def dictionaries(rows: list[tuple[str, int]], known: Segments | None = None) -> Model:
    """A model without calibration."""
    toxic, ordinary = ([t.lower().encode() for t, y in rows if y == k] for k in (1, 0))
    known = known or Segments(toxic + ordinary)
    own, other = class_segments(toxic, ordinary, known), class_segments(ordinary, toxic, known)
    shared = shared_part(ordinary, own)
    return Model(own + shared, other + shared)


def calibrated(features: Iterable[list[float]], labels: Iterable[int]) -> list[float]:
    """Logistic weights by Newton steps with a small ridge."""
    x, y = np.array(list(features)), np.array(list(labels), "f8")
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
    return w.tolist()


def train(rows: list[tuple[str, int]], prior: float | None = None) -> Model:
    """A model from (text, label) rows: calibrated across two folds, with dictionaries of all rows.

    prior is the share of toxic texts where the sample does not keep it.
    """
    rows = sorted(set(rows))
    share = sum(y for _, y in rows) / len(rows) if rows else 0.0
    prior = share if prior is None else prior
    folds = [[], []]
    for label in (0, 1):
        for k, row in enumerate(r for r in rows if r[1] == label):
            folds[k % 2].append(row)
    if any({y for _, y in fold} != {0, 1} for fold in folds):
        return Model(b"", b"", [], prior)
    known = Segments(t.lower().encode() for t, _ in rows)
    features, labels = [], []
    for own, other in (folds, folds[::-1]):
        model = dictionaries(own, known)
        features += [model.features(t) for t, _ in other]
        labels += [y for _, y in other]
    model = dictionaries(rows, known)
    model.weights, model.prior = calibrated(features, labels), prior
    if 0 < prior < 1:
        model.weights[0] += math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return model


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS, train_bytes: int = TRAIN_BYTES) -> Model:
    """The model of the labelled rows that are not held out, from a bounded sample of each label.

    Ids with contradicting labels teach nothing; of several texts under one id the smallest is taken.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").select("doc_id", "y")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = known.where("y = 1").orderBy(*order).limit(toxic_rows).union(known.where("y = 0").orderBy(*order).limit(ordinary_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # toxic_rows + ordinary_rows at most
    taken = F.sum(F.octet_length("text")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = [(r.text, r.y) for r in found.withColumn("taken", taken).where(F.col("taken") <= train_bytes).select("text", "y").collect()]
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    return train(rows, counts.get(1, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; no shuffle.

    Null and empty texts get the score of a text without distance; where no row of one label could be learnt from, every
    score is the share of toxic rows, 0 without any. Equal texts get equal scores; repeated rows are scored each; a null doc_id is
    not held out; an empty table gives no rows; further columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text.as_py() or "") for text in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold; no shuffle."""
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding("toxicity", lambda: None)
        for batch in batches:
            mask = [model.score(text.as_py() or "") < threshold for text in batch.column(at)]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
