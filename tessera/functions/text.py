"""String functions with the reference's exact text semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "split_space", "split_ws", "strip_ws", "char_span", "repair_answer",
    "sentence_lines", "rouge_words", "alnum_words", "normalize_answer",
    "ANSWER_BRACKETS", "SENTENCE_END",
]

# Fixed values that must equal the reference's behaviour.
# Bracket pairs repaired in extracted answers (opening, closing):
ANSWER_BRACKETS = (("《", "》"), ("「", "」"))
# Sentence-final punctuation used to cut sentences (ASCII and full width):
SENTENCE_END = ".!?。！？"

_WS = r"(?U)\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_space(col) -> Column:
    """Split on ONE space, keeping empty tokens (``str.split(' ')``)."""
    return F.split(_c(col), " ", -1)


def split_ws(col) -> Column:
    """Split on any Unicode whitespace run, no empty tokens (``str.split()``)."""
    return F.filter(F.split(_c(col), _WS, -1), lambda t: t != "")


def strip_ws(col) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends (``trim`` only
    removes ASCII spaces)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def char_span(text, start, end) -> Column:
    """``text[start:end]`` by code points (0-based, end exclusive)."""
    text, start, end = _c(text), _c(start), _c(end)
    return F.when(end > start, text.substr(start + F.lit(1), end - start)).otherwise(F.lit(""))


def repair_answer(col) -> Column:
    """First matching rule wins: a comma anywhere -> delete all commas; else an
    unmatched opening or closing bracket gets its mate added."""
    c = _c(col)
    out = F.when(c.contains(","), F.regexp_replace(c, ",", ""))
    for o, cl in ANSWER_BRACKETS:
        out = out.when(c.contains(o) & ~c.contains(cl), F.concat(c, F.lit(cl)))
        out = out.when(c.contains(cl) & ~c.contains(o), F.concat(F.lit(o), c))
    return out.otherwise(c)


def sentence_lines(col) -> Column:
    """Cut after sentence-final punctuation, strip each piece, drop empties;
    returns array<string> (join with newline for the scorer)."""
    pieces = F.split(_c(col), r"(?<=[.!?。！？])", -1)
    return F.filter(F.transform(pieces, lambda p: strip_ws(p)), lambda p: p != "")


def rouge_words(col) -> Column:
    """Tokens as the set-ROUGE scorer sees them: cut the text at '.', keep
    non-empty pieces, squeeze each piece's whitespace and split it on one
    space (an all-blank piece yields one empty token)."""
    pieces = F.filter(F.split(_c(col), r"\.", -1), lambda p: F.length(p) > 0)
    return F.flatten(F.transform(
        pieces,
        lambda p: F.when(F.size(split_ws(p)) == 0, F.array(F.lit(""))).otherwise(split_ws(p))))


def alnum_words(col) -> Column:
    """Lower-case, non ``[a-z0-9]`` -> space, split (multiset-ROUGE tokenizer)."""
    return split_ws(F.regexp_replace(F.lower(_c(col)), r"[^a-z0-9]+", " "))


def normalize_answer(col) -> Column:
    """SQuAD answer normalisation: lower, drop ASCII punctuation, drop the
    articles a/an/the, squeeze whitespace."""
    c = F.lower(_c(col))
    c = F.regexp_replace(c, r"[!-/:-@\[-`{-~]", "")
    c = F.regexp_replace(c, r"(?U)\b(a|an|the)\b", " ")
    return F.array_join(split_ws(c), " ")
