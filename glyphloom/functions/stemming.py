"""English suffix stripping by the published Porter rules, for tokenizers that want stems."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOWELS = "aeiou"

# The suffix tables of steps 2, 3 and 4 of the algorithm.
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _consonant(word: str, k: int) -> bool:
    if word[k] in _VOWELS:
        return False
    return word[k] != "y" or k == 0 or not _consonant(word, k - 1)


def _measure(stem: str) -> int:
    """How often a vowel run is followed by a consonant run."""
    shape = [_consonant(stem, k) for k in range(len(stem))]
    return sum(not a and b for a, b in zip(shape, shape[1:], strict=False))


def _has_vowel(stem: str) -> bool:
    return any(not _consonant(stem, k) for k in range(len(stem)))


def _short(word: str) -> bool:
    """Ends consonant, vowel, consonant other than w, x, y."""
    k = len(word)
    return k >= 3 and _consonant(word, k - 3) and not _consonant(word, k - 2) and _consonant(word, k - 1) and word[-1] not in "wxy"


def _replaced(word: str, table: tuple, least: int) -> str:
    for suffix, new in sorted(table, key=lambda x: -len(x[0])):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > least else word
    return word


def stem(word: str) -> str:
    if len(word) <= 2 or not word.isascii() or not word.isalpha():
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            if word.endswith(suffix) and _has_vowel(word[: -len(suffix)]):
                word = word[: -len(suffix)]
                if word.endswith(("at", "bl", "iz")) or _measure(word) == 1 and _short(word):
                    word += "e"
                elif len(word) > 1 and word[-1] == word[-2] and _consonant(word, len(word) - 1) and word[-1] not in "lsz":
                    word = word[:-1]
                break
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _replaced(_replaced(word, _STEP2, 0), _STEP3, 0)
    for suffix in sorted(_STEP4, key=lambda x: -len(x)):
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            if _measure(rest) > 1 and (suffix != "ion" or rest.endswith(("s", "t"))):
                word = rest
            break
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _short(word[:-1]):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(T.ArrayType(T.StringType()))
def stems(words: pd.Series) -> pd.Series:
    known: dict[str, str] = {}
    return pd.Series([None if w is None else [known.setdefault(x, stem(x)) if x not in known else known[x] for x in w] for w in words])
