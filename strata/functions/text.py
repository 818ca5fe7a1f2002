"""Words of a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(separator: str) -> str:
    """A pattern for the separator itself; one escaped character is split without the regex engine."""
    if len(separator) == 1:
        return separator if separator.isalnum() or separator.isspace() else f"\\{separator}"
    return rf"\Q{separator}\E"


def split_words(text: Column, separator: str = " ") -> Column:
    """Pieces between separators; empty pieces and line breaks inside pieces stay."""
    return F.split(text, _literal(separator))


def normal_word(word: Column) -> Column:
    return F.lower(F.trim(word))


def has_letter(word: Column) -> Column:
    """True for words with an ASCII lower-case letter; null for null."""
    return word.rlike("[a-z]")


def split_records(text: Column, separator: str = ".") -> Column:
    """The records a text reader with this line separator would make of the text."""
    return F.split(text, _literal(separator))
