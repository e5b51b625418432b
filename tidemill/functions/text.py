"""Tokenisers and text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_width, shuffles_for

#: Texts whose different tokens a task holds at a time.
TASK_TEXTS = 5_000
WORD_PATTERN = r"[A-Za-z']+"
LATIN_UPPER = "A-ZÀ-ÖØ-Þ"
LATIN_LOWER = "a-zß-öø-ÿ"
LATIN_VOWELS = "aeiouyàâäèéêëîïôöùûüáíóú"
CYRILLIC_UPPER = "А-ЯЁ"
CYRILLIC_LOWER = "а-яё"
CYRILLIC_VOWELS = "аеёиоуыэюя"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_tokens(text: Column | str) -> Column:
    """Tokens between runs of whitespace; no empty tokens."""
    return F.filter(F.split(_col(text), r"\s+"), lambda w: w != "")


def space_tokens(text: Column | str, drop_trailing: bool = False) -> Column:
    """Tokens of a split at every single space; neighbouring spaces give empty tokens, which count.

    ``drop_trailing`` leaves out empty tokens at the end of the text (and an empty text altogether).
    """
    c = F.regexp_replace(_col(text), " +$", "") if drop_trailing else _col(text)
    parts = F.split(c, " ", -1)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(parts) if drop_trailing else parts


def letter_tokens(text: Column | str, pattern: str = WORD_PATTERN) -> Column:
    """Lower-cased matches of ``pattern`` (letters and apostrophes)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(f"({pattern})"), F.lit(1))


def bigrams(tokens: Column) -> Column:
    """Neighbouring token pairs joined by a space; fewer than two tokens give none.

    Two shifted copies are zipped: a lambda that looked into the array by index would evaluate the whole
    tokeniser again for every element.
    """
    rest = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
    pairs = F.zip_with(tokens, rest, lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.filter(pairs, lambda p: p.isNotNull())


def characters(text: Column | str) -> Column:
    """Every character of the lower-cased text."""
    return F.filter(F.split(F.lower(_col(text)), ""), lambda c: c != "")


def word_count(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """Count of each token over all rows; tasks combine their counts before the shuffle."""
    return df.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("cnt"))


def many_word_count(texts: DataFrame, tokens: Column, rest: Column, name: str = "word") -> DataFrame:
    """``word_count`` where most tokens are different ones: of ``rest``, made of the column ``tokens``. Texts are dealt to tasks by number,
    and so are the counts, which are written once, so that a task's memory does not follow the input."""
    spark, held = texts.sparkSession, texts.count()
    with shuffles_for(spark, held, TASK_TEXTS):
        dealt = texts.repartition(shuffle_width(spark), F.xxhash64(*texts.columns))
        return cut_lineage(word_count(dealt.select(tokens.alias("tokens")), rest, name))


def proper_nouns(
    tokens: Column,
    upper: str = CYRILLIC_UPPER,
    lower: str = CYRILLIC_LOWER,
    vowels: str = CYRILLIC_VOWELS + "й",
    skip_sentence_first: bool = True,
) -> Column:
    """Capitalised words of one alphabet among the whitespace tokens of a text, trailing vowels stripped.

    Punctuation around a word is ignored. The first word of the text and a word after a token that ends
    in ``.``, ``!`` or ``?`` are sentence-first and skipped. A word of vowels only strips to '' and is dropped.
    """
    edge = f"^[^{upper}{lower}]+|[^{upper}{lower}]+$"

    def keep(w: Column, before: Column) -> Column:
        bare = F.regexp_replace(w, edge, "")
        fit = bare.rlike(f"^[{upper}][{lower}]*$")
        if skip_sentence_first:
            fit = fit & ~before.rlike(r"[.!?]$")
        return F.when(fit, F.regexp_replace(bare, f"[{vowels}]+$", "")).otherwise(F.lit(""))

    # Each token beside the one before it; the text begins like a sentence.
    shifted = F.concat(F.array(F.lit(".")), tokens)
    words = F.zip_with(tokens, F.slice(shifted, 1, F.greatest(F.size(tokens), F.lit(0))), keep)
    return F.filter(words, lambda w: w != "")


def without(df: DataFrame, column: str, stop_words: Sequence[str]) -> DataFrame:
    """Rows whose word is not in a fixed stop list."""
    return df.where(~F.col(column).isin(list(stop_words)))
