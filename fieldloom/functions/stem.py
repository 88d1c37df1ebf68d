"""Porter's stemming algorithm (M. F. Porter, "An algorithm for suffix stripping", Program 14, 1980), as rules."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F, types as T

# The suffix rules of steps 2, 3 and 4 of the paper.
STEP2 = "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble"
STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _shape(w: str) -> str:
    """c and v for consonants and vowels; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(w):
        out += "v" if ch in "aeiou" or (ch == "y" and i and out[-1] == "c") else "c"
    return out


def _measure(w: str) -> int:
    return len(re.findall("v+c+", _shape(w)))


def _double(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _shape(w)[-1] == "c"


def _cvc(w: str) -> bool:
    return len(w) > 2 and _shape(w)[-3:] == "cvc" and w[-1] not in "wxy"


def _longest(w: str, table: list[tuple[str, str]], least: int) -> str:
    for suffix, new in sorted(table, key=lambda t: -len(t[0])):
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            if _measure(stem) > least and (suffix != "ion" or stem[-1:] in ("s", "t")):
                return stem + new
            return w
    return w


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """Stem of a lower-case English word; words of up to two letters stay."""
    w = word
    if len(w) <= 2:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        cut = next((w[: -len(e)] for e in ("ed", "ing") if w.endswith(e) and "v" in _shape(w[: -len(e)])), None)
        if cut is not None:
            w = cut + "e" if cut.endswith(("at", "bl", "iz")) else cut[:-1] if _double(cut) and cut[-1] not in "lsz" else cut + "e" if _measure(cut) == 1 and _cvc(cut) else cut
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    for table, least in ((STEP2, 0), (STEP3, 0)):
        w = _longest(w, [tuple(r.split(":")) for r in table.split()], least)
    w = _longest(w, [(r, "") for r in STEP4.split()], 1)
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


@F.pandas_udf(T.ArrayType(T.StringType()))
def stemmed(words: pd.Series) -> pd.Series:
    """Stems of an array of words; null stays null."""
    return words.map(lambda ws: None if ws is None else [stem(w) for w in ws])
