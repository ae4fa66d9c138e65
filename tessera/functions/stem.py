"""English suffix stripping in five steps (the algorithm published by M. F. Porter, Program 14, 1980)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The published suffix rules, in the order they are tried.
STEP_2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
          ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
          ("iviti", "ive"), ("biliti", "ble"))
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
          "ous", "ive", "ize")
SHORT = 3  # words of so many letters stay as they are


def _sounds(word: str) -> str:
    """v for a vowel, c for a consonant; y is a vowel after a consonant."""
    out = ""
    for i, x in enumerate(word):
        out += "v" if x in "aeiou" or x == "y" and i and out[i - 1] == "c" else "c"
    return out


def _measure(stem: str) -> int:
    """How many times a consonant follows a vowel."""
    return _sounds(stem).count("vc")


def _hop(stem: str) -> bool:
    """Ends in consonant, vowel, consonant, the last not w, x or y."""
    return _sounds(stem).endswith("cvc") and stem[-1] not in "wxy"


def _double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _sounds(stem)[-1] == "c"


def _replace(word: str, rules, least: int) -> str:
    """The longest suffix that fits is replaced if what is before it measures more than ``least``."""
    for old, new in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(old):
            stem = word[:len(word) - len(old)]
            fits = _measure(stem) > least and (old != "ion" or stem.endswith(("s", "t")))
            return stem + new if fits else word
    return word


def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if len(word) <= 2:
        return word
    word = _replace_plural(word)
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = next((word[:-len(s)] for s in ("ing", "ed") if word.endswith(s)), None)
        if cut is not None and "v" in _sounds(cut):
            word = cut
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _hop(word):
                word += "e"
    if word.endswith("y") and "v" in _sounds(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, STEP_2, 0)
    word = _replace(word, STEP_3, 0)
    word = _replace(word, [(s, "") for s in STEP_4], 1)
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _hop(word[:-1]):
            word = word[:-1]
    if _double(word) and word[-1] == "l" and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def _replace_plural(word: str) -> str:
    for old, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(old):
            return word[:len(word) - len(old)] + new
    return word


def stems(words: Column, nested: bool = False) -> Column:
    """The stems of an array of words (short words as they are), or of an array of such arrays; each distinct word of
    a batch is worked out once."""
    def worked(values: pa.Array) -> pa.Array:
        if pa.types.is_list(values.type):
            ends = [0]
            for n in values.value_lengths().fill_null(0).to_pylist():
                ends.append(ends[-1] + n)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), worked(values.flatten()),
                                            mask=values.is_null() if values.null_count else None)
        coded = values.dictionary_encode()
        each = [w if len(w) <= SHORT else stem(w) for w in coded.dictionary.to_pylist()]
        return pa.array(each, pa.string()).take(coded.indices)

    @F.arrow_udf("array<array<string>>" if nested else "array<string>")
    def run(lists: pa.Array) -> pa.Array:
        return worked(lists)

    return run(words)
