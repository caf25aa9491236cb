"""Similarities of strings and token sets as Column builders; edit similarities over Arrow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType



def _n(a: Column) -> Column:
    return F.size(a).cast("double")


def jaccard(a: Column, b: Column) -> Column:
    """Shared by all words; both empty 1."""
    union = _n(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(_n(F.array_intersect(a, b)) / F.nullif(union, F.lit(0.0)))


def overlap(a: Column, b: Column) -> Column:
    """How many words both have."""
    return _n(F.array_intersect(a, b))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Shared words by those of the smaller set; either empty 0."""
    least = F.least(_n(F.array_distinct(a)), _n(F.array_distinct(b)))
    return F.when(least == 0, F.lit(0.0)).otherwise(overlap(a, b) / F.nullif(least, F.lit(0.0)))


def containment(a: Column, b: Column) -> Column:
    """Shared words by those of a; a empty: 1 if b is too, else 0."""
    own = _n(F.array_distinct(a))
    return F.when(own == 0, F.when(F.size(b) == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(overlap(a, b) / F.nullif(own, F.lit(0.0)))


def length_ratio(a: Column, b: Column) -> Column:
    """Shorter by longer in characters; both empty 1, one 0."""
    longer = F.greatest(F.length(a), F.length(b)).cast("double")
    return F.when(longer == 0, F.lit(1.0)).otherwise(F.least(F.length(a), F.length(b)) / F.nullif(longer, F.lit(0.0)))


def prefix_match(a: Column, b: Column, n: int) -> Column:
    """1 if both have n characters and the first n agree."""
    same = (F.length(a) >= n) & (F.length(b) >= n) & (F.substring(a, 1, n) == F.substring(b, 1, n))
    return F.when(same, F.lit(1.0)).otherwise(F.lit(0.0))


def exact_match(a: Column, b: Column) -> Column:
    """1 if equal and not empty."""
    return F.when((a == b) & (a != ""), F.lit(1.0)).otherwise(F.lit(0.0))


def numeric_match(a: Column, b: Column) -> Column:
    """Shared digit words by those of the larger set; either empty 0."""
    x, y = (F.array_distinct(F.filter(c, lambda w: w.rlike(r"^\p{Nd}+$"))) for c in (a, b))
    most = F.greatest(_n(x), _n(y))
    empty = (F.size(x) == 0) | (F.size(y) == 0)
    return F.when(empty, F.lit(0.0)).otherwise(_n(F.array_intersect(x, y)) / F.nullif(most, F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays in double precision; missing or zero vectors 0."""
    a, b = a.cast("array<double>"), b.cast("array<double>")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with(a, b, lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(a, lambda x: x * x))) * F.sqrt(total(F.transform(b, lambda x: x * x)))
    return F.coalesce(F.when(norm == 0, F.lit(0.0)).otherwise(dot / F.nullif(norm, F.lit(0.0))), F.lit(0.0))


def indel_similarity(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|), the LCS bit-parallel; both empty 1."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    if a == b:
        return 1.0
    where: dict[str, int] = {}
    for k, char in enumerate(a):
        where[char] = where.get(char, 0) | 1 << k
    full = (1 << len(a)) - 1
    state = full
    for char in b:
        hit = state & where.get(char, 0)
        state = ((state + hit) | (state - hit)) & full
    return 2 * (len(a) - state.bit_count()) / total


def jaro_winkler_similarity(a: str, b: str) -> float:
    """Jaro similarity, raised for a common prefix of up to 4 where it is over 0.7; either empty 0."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    # the window moves on with every character, so those of one kind in b are taken in order: a queue each
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    taken, matched = [], []
    for i, char in enumerate(a):
        queue = places.get(char)
        while queue and queue[-1] < i - reach:
            queue.pop()
        if queue and queue[-1] <= i + reach:
            taken.append(queue.pop())
            matched.append(char)
    if not matched:
        return 0.0
    m = len(matched)
    moved = sum(x != b[j] for x, j in zip(matched, sorted(taken))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro > 0.7:
        prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
        jaro += 0.1 * prefix * (1 - jaro)
    return jaro


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """indel_similarity over Arrow batches."""
    return pd.Series([indel_similarity(x, y) for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """jaro_winkler_similarity over Arrow batches."""
    return pd.Series([jaro_winkler_similarity(x, y) for x, y in zip(a, b)])


def token_sort_ratio(a: Column, b: Column) -> Column:
    """The indel ratio of both texts' words (columns of words) in sorted order; either empty 0."""
    x, y = F.array_join(F.array_sort(a), " "), F.array_join(F.array_sort(b), " ")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(indel_ratio(x, y))
