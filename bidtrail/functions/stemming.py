"""English stems after the published algorithm of M. F. Porter (1980), with its author's later changes (bli, logi)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Endings and what takes their place, where the part before has at least one vowel-consonant sequence.
STEP_2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize ation:ate "
    "ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
)
STEP_3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
# Endings that go where the part before has at least two such sequences; ion only after s or t.
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _longest_first(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(pairs, key=lambda p: -len(p[0]))


_TWO, _THREE = (_longest_first([tuple(p.split(":")) for p in step.split()]) for step in (STEP_2, STEP_3))
_FOUR = _longest_first([(ending, "") for ending in STEP_4.split()])


def _shape(part: str) -> str:
    """c or v per letter; y is a vowel after a consonant."""
    out = ""
    for letter in part:
        out += "v" if letter in "aeiou" or letter == "y" and out.endswith("c") else "c"
    return out


def _measure(part: str) -> int:
    return len(re.findall("v+c+", _shape(part)))


def _doubled(part: str) -> bool:
    return len(part) > 1 and part[-1] == part[-2] and _shape(part)[-1] == "c"


def _short(part: str) -> bool:
    """Ends in consonant, vowel, consonant, the last one not w, x or y."""
    return _shape(part).endswith("cvc") and part[-1] not in "wxy"


def _replaced(word: str, pairs: list[tuple[str, str]], least: int) -> str:
    """The word with its longest listed ending replaced, if what stands before measures enough."""
    for ending, new in pairs:
        if word.endswith(ending):
            part = word[: -len(ending)]
            fits = _measure(part) >= least and (ending != "ion" or part[-1:] in ("s", "t"))
            return part + new if fits else word
    return word


def stem(word: str) -> str:
    """Stem of a lower-case word; words of one or two letters stay."""
    if len(word) <= 2:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        part = next((word[: -len(e)] for e in ("ed", "ing") if word.endswith(e)), None)
        if part is not None and "v" in _shape(part):
            if part.endswith(("at", "bl", "iz")):
                word = part + "e"
            elif _doubled(part) and part[-1] not in "lsz":
                word = part[:-1]
            else:
                word = part + "e" if _measure(part) == 1 and _short(part) else part
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    word = _replaced(_replaced(_replaced(word, _TWO, 1), _THREE, 1), _FOUR, 2)
    if word.endswith("e"):
        part = word[:-1]
        if _measure(part) > 1 or _measure(part) == 1 and not _short(part):
            word = part
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@pandas_udf(StringType())
def stem_of(terms: pd.Series) -> pd.Series:
    """Stem of each term; meant for distinct terms."""
    return terms.map(stem, na_action="ignore")
