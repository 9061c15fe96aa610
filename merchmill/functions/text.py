"""Text clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from merchmill import values

# a word starts at a letter that does not follow another letter
_TITLE_BREAK = r"(?<=\P{L})(?=\p{L})"
# a word starts after white space or after one of the listed marks
_INITCAP_BREAK = "(?U)(?<=[\\s" + re.escape(values.INITCAP_BREAKS) + "])"


def _capitalise(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substr(word, F.lit(2)))


def _capitalise_words(text: Column, word_break: str) -> Column:
    return F.array_join(F.transform(F.split(F.lower(text), word_break), _capitalise), "")


def title_words(text: Column) -> Column:
    """Title case where every letter after a non-letter is a capital: ``d'oeste 2nd`` -> ``D'Oeste 2Nd``."""
    return _capitalise_words(text, _TITLE_BREAK)


def initcap_words(text: Column) -> Column:
    """SQL INITCAP with the warehouse's set of word breaks (blanks and most punctuation)."""
    return _capitalise_words(text, _INITCAP_BREAK)


def trim_blank(text: Column) -> Column:
    """Strip every kind of white space from both ends, not only the space character."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
