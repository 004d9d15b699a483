"""Word frequency over text lines or whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expressions import is_alpha_word


def words(df: DataFrame, text_col: str = "value", word: str = "word") -> DataFrame:
    """C1 + B13: tokens of every line, split on the single space.

    Text columns that hold whole documents are split on newlines as well
    (splitting on ``[ \\n]`` gives the same non-empty tokens as splitting
    into lines first and lines into words, in one generator).  A token is
    kept when it is entirely ASCII letters; empty tokens, digits,
    punctuation and non-ASCII letters fail the match.
    """
    tok = F.explode(F.split(F.col(text_col), "[ \n]")).alias(word)
    return df.select(tok).where(is_alpha_word(F.col(word)))


def word_count(df: DataFrame, text_col: str = "value", word: str = "word",
               name: str = "n") -> DataFrame:
    """Occurrences per word (case-sensitive).

    The explode and the regex filter run inside the scan's codegen stage;
    the partial aggregate combines repeated words before the exchange.
    """
    return words(df, text_col, word).groupBy(word).agg(F.count(F.lit(1)).alias(name))


def top_words(df: DataFrame, k: int = 100, text_col: str = "value", word: str = "word",
              name: str = "n") -> DataFrame:
    """the ``k`` most frequent words, ties broken by word."""
    return (word_count(df, text_col, word, name)
            .orderBy(F.desc(name), F.asc(word)).limit(k))
