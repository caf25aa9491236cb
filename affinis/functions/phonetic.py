"""Phonetic codes: American Soundex on the JVM, Metaphone over Arrow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

VOWELS = set("AEIOU")


def soundex_key(word: Column) -> Column:
    """The Soundex code of a word of two or more ASCII letters, else ''."""
    return F.when(word.rlike("^[A-Za-z]{2,}$"), F.soundex(word)).otherwise(F.lit(""))


def metaphone(word: str) -> str:
    """The Metaphone code of a word, after the rules that Lawrence Philips published in 1990; '' unless all is letters A to Z."""
    w = word.upper()
    if not w or not w.isascii() or not w.isalpha():
        return ""
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[0] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out, n = [], len(w)
    at = lambda k: w[k] if 0 <= k < n else ""
    k = 0
    while k < n:
        c, before, after = w[k], at(k - 1), at(k + 1)
        step = 1
        if c == before and c != "C":
            pass
        elif c in VOWELS:
            if k == 0:
                out.append(c)
        elif c == "B":
            if not (before == "M" and k == n - 1):
                out.append("B")
        elif c == "C":
            if after == "I" and at(k + 2) == "A":
                out.append("X")
            elif after == "H":
                out.append("K" if before == "S" else "X")
                step = 2
            elif after and after in "IEY":
                if before != "S":
                    out.append("S")
            else:
                out.append("K")
        elif c == "D":
            if after == "G" and at(k + 2) and at(k + 2) in "EIY":
                out.append("J")
                step = 2
            else:
                out.append("T")
        elif c == "G":
            if after == "H" and not (k + 2 >= n or at(k + 2) in VOWELS):
                step = 2
            elif after == "H" and k + 2 >= n:
                step = 2
            elif after == "H":
                out.append("K")
                step = 2
            elif after == "N" and (k + 2 >= n or w[k + 2 :] == "ED"):
                pass
            elif after and after in "IEY" and before != "G":
                out.append("J")
            else:
                out.append("K")
        elif c == "H":
            if (after and after in VOWELS) and before not in ("C", "S", "P", "T", "G"):
                out.append("H")
        elif c == "K":
            if before != "C":
                out.append("K")
        elif c == "P":
            if after == "H":
                out.append("F")
                step = 2
            else:
                out.append("P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            if after == "H":
                out.append("X")
                step = 2
            elif after == "I" and at(k + 2) and at(k + 2) in "OA":
                out.append("X")
            else:
                out.append("S")
        elif c == "T":
            if after == "I" and at(k + 2) and at(k + 2) in "OA":
                out.append("X")
            elif after == "H":
                out.append("0")
                step = 2
            elif not (after == "C" and at(k + 2) == "H"):
                out.append("T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            if after and after in VOWELS:
                out.append(c)
        elif c == "X":
            out.append("KS")
        elif c == "Z":
            out.append("S")
        else:
            out.append(c)
        k += step
    return "".join(out)


@F.pandas_udf(ArrayType(StringType()))
def metaphone_keys(words: pd.Series) -> pd.Series:
    """The Metaphone codes of the words of two or more letters, without empty ones."""
    return words.map(lambda ws: [c for w in ws if len(w) >= 2 and (c := metaphone(w))])


@F.pandas_udf(StringType())
def metaphone_code(word: pd.Series) -> pd.Series:
    """The Metaphone code of each word."""
    return word.map(lambda w: metaphone(w or ""))
