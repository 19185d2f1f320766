"""Counts and grade levels of a text.

Words are runs of anything but space, newline, tab and return; sentences are runs of
``. ! ?``; syllables are runs of the vowels ``aeiouy`` in either case; characters are
those that are not white space. The grades count each of words, sentences and syllables
as at least 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_CHARACTERS = " \n\t\r"
WHITE = f"[{WHITE_CHARACTERS}]+"
SENTENCE_END = r"[.!?]+"
NOT_VOWELS = r"[^aeiouyAEIOUY]+"


def _pieces(col: Column, separator: str) -> Column:
    """Non-empty pieces: runs of anything the separator leaves. Splitting counts runs
    at about half the cost of extracting every match."""
    return F.array_remove(F.split(col, separator), "")


def tokens(col: Column) -> Column:
    return _pieces(col, WHITE)


def distinct_tokens(col: Column) -> Column:
    return F.array_distinct(tokens(F.lower(col)))


def token_count(col: Column) -> Column:
    return F.array_size(tokens(col)).cast("bigint")


def sentence_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(SENTENCE_END)).cast("bigint")


def syllable_count(col: Column) -> Column:
    return F.array_size(_pieces(col, NOT_VOWELS)).cast("bigint")


def _at_least_1(n: Column) -> Column:
    return F.when(n < 1, 1).otherwise(n)


def fk_grade(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch-Kincaid grade level (Kincaid et al. 1975)."""
    w, s, y = _at_least_1(words), _at_least_1(sentences), _at_least_1(syllables)
    return 0.39 * w / s + 11.8 * y / w - 15.59


def ari_grade(characters: Column, words: Column, sentences: Column) -> Column:
    """Automated Readability Index (Senter and Smith 1967)."""
    w, s = _at_least_1(words), _at_least_1(sentences)
    return 4.71 * characters / w + 0.5 * w / s - 21.43
