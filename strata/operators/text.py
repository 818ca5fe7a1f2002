"""Word frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import has_letter, normal_word, split_words


def words_of(lines: DataFrame, text: str = "value", separator: str = " ", with_columns: Sequence[str] = ()) -> DataFrame:
    """One row per piece of every line, as it stands in the text, beside the line's columns of choice."""
    return lines.select(*with_columns, F.explode(split_words(F.col(text), separator)).alias("word"))


def clean_words(words: DataFrame) -> DataFrame:
    """Lower-cased, trimmed words that hold at least one letter; other columns stay."""
    cleaned = words.withColumn("word", normal_word(F.col("word")))
    return cleaned.where(F.col("word").isNotNull() & has_letter(F.col("word")))


def count_words(words: DataFrame) -> DataFrame:
    return words.groupBy("word").count()


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Frequency of every clean word; counted per task before the one shuffle on the word."""
    return count_words(clean_words(words_of(lines, text)))
