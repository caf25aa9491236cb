import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinis.functions.phonetic import metaphone, soundex_key
from affinis.functions.similarity import containment, cosine, indel_similarity, jaccard, jaro_winkler_similarity, length_ratio, overlap_ratio
from affinis.functions.text import CANONICAL, dominant_indic_script, normalize_ascii, normalize_text, normalize_unicode, normalize_words

NORMAL = {
    "café": "cafe", "société générale": "socie te ge ne rale", "#12345 foo": "12345 foo", "Foo Pvt. Ltd.": "foo private limited", "inc.com": "com", "co.uk": "companyuk",
    "foo ltd limited": "foo limited", "": "", "   ": "", "See https://x.y/z now www.a.b": "see now", "[A](B) *c*_d_": "a b c d", "the the the": "the", "corp.pvt": "corporationprivate",
}


@pytest.mark.parametrize("text,expected", NORMAL.items())
def test_normalize_text(text, expected):
    assert normalize_text(text) == expected
    assert normalize_text(None) == ""


def test_transliteration_is_pluggable():
    assert dominant_indic_script("हिन्दी a") == "devanagari" and dominant_indic_script("abc") is None
    assert normalize_text("हिन्दी", lambda text, script: f"{script} x") == "devanagari x"


def test_catalyst_and_arrow_normalisation_agree_on_ascii(spark):
    rnd = random.Random(3)
    parts = ["ltd", "Inc.", "co", "sa,", "foo", "BAR", "#", "12", "_", "-", "http://a.b", " ", "  ", "corp.", "earl", "\t"]
    texts = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 9))) for _ in range(300)] + [t for t in NORMAL if t.isascii()]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_ascii(F.col("t")).alias("a"), normalize_unicode("t").alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]


def test_words_normalise_as_their_text(spark):
    rnd = random.Random(5)
    parts = [*CANONICAL, "companyco", "co2", "foo", "foo", "12", "x", "www", "https", "inc1"]
    texts = [[rnd.choice(parts) for _ in range(rnd.randint(0, 12))] for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "w array<string>").select("w", normalize_words(F.col("w")).alias("a"), normalize_ascii(F.array_join("w", " ")).alias("b")).collect()
    assert [(r.w, r.a) for r in rows] == [(r.w, r.b) for r in rows]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=12), st.text("abcé", max_size=12))
def test_indel_similarity(a, b):
    assert indel_similarity(a, b) == (2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0)
    assert 0 <= jaro_winkler_similarity(a, b) <= 1 and jaro_winkler_similarity(a, a) == (1.0 if a else 0.0)


def test_published_similarities():
    assert round(jaro_winkler_similarity("martha", "marhta"), 4) == 0.9611
    assert round(jaro_winkler_similarity("dixon", "dicksonx"), 4) == 0.8133
    assert [metaphone(w) for w in ("knight", "thumb", "phone", "school", "xavier", "wright")] == ["NT", "0M", "FN", "SKL", "SFR", "RT"]


def test_set_similarities_with_empty_sides(spark):
    df = spark.createDataFrame([([], []), ([], ["x"]), (["x"], []), (["x", "y"], ["y", "z"])], "a array<string>, b array<string>")
    a, b = F.col("a"), F.col("b")
    rows = df.select(jaccard(a, b), containment(a, b), overlap_ratio(a, b)).collect()
    assert [tuple(r) for r in rows] == [(1.0, 1.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (1 / 3, 0.5, 0.5)]


def test_lengths_soundex_cosine(spark):
    df = spark.createDataFrame([("", "", "Ashcraft"), ("ab", "", "é"), ("ab", "abcd", "x")], "a string, b string, w string")
    rows = df.select(length_ratio(F.col("a"), F.col("b")), soundex_key(F.col("w"))).collect()
    assert [tuple(r) for r in rows] == [(1.0, "A261"), (0.0, ""), (0.5, "")]
    vectors = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in vectors.select(cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0]
