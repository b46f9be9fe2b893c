"""Readability of a text corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.functions import text as tx
from registrar.operators.joins import left_join
from registrar.sources.textdir import read_text_dir, read_text_lines

# Lowest score of each band, reading age, note.
BANDS = [
    (90, "10-11", "Very easy to read. Easily understood by an average 11-year-old student."),
    (80, "11-12", "Easy to read. Conversational English for consumers."),
    (70, "12-13", "Fairly easy to read."),
    (60, "13-15", "Plain English. Easily understood by 13- to 15-year-old students."),
    (50, "15-18", "Fairly difficult to read."),
    (30, "Undergraduate", "Difficult to read."),
    (10, "Graduate", "Very difficult to read. Best understood by university graduates."),
    (0, "Professional", "Extremely difficult to read. Best understood by university graduates."),
]
TOP_SCORE = 100


def _band(score: Column, position: int) -> Column:
    """Value of the band a whole score falls in; no band outside 0 to 100."""
    column, upper = F.when(score > TOP_SCORE, F.lit(None)), TOP_SCORE
    for low, *values in BANDS:
        column = column.when(score.between(low, upper), F.lit(values[position]))
        upper = low - 1
    return column


def text_counts(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Types, tokens, words, sentences and syllables of every document.

    Whole texts, one row each, no shuffle; the token array is built once and
    lives only inside the row.
    """
    split = documents.select("doc_id", *keep, "text", tx.tokens(F.col("text")).alias("tokens"))
    split = split.withColumn("word_list", F.filter("tokens", tx.is_word))
    return split.select(
        "doc_id",
        *keep,
        F.size(F.array_distinct("tokens")).alias("types"),
        F.size("tokens").alias("tokens"),
        F.size("word_list").alias("words"),
        tx.sentences(F.col("text")).alias("sentences"),
        tx.syllables(F.col("text"), F.col("word_list")).alias("syllables"),
    )


def line_counts(lines: DataFrame, files: DataFrame) -> DataFrame:
    """The counts of ``text_counts`` for files given by lines, each file in many tasks.

    No word, token or vowel run goes over a line end, and a sentence may end
    there, so counts of lines add up; types are counted as distinct (file,
    token) pairs. Both are combined map-side: a file that holds most lines
    moves as one row per task, and as its distinct tokens.
    """
    split = lines.select("file", "text", tx.tokens(F.col("text")).alias("tokens"))
    words = F.filter("tokens", tx.is_word)
    sums = split.groupBy("file").agg(
        F.sum(F.size("tokens")).alias("tokens"),
        F.sum(F.size(words)).alias("words"),
        F.sum(tx.sentence_ends(F.col("text"))).alias("sentences"),
        F.sum(tx.syllables(F.col("text"), words)).alias("syllables"),
    )
    pairs = split.select("file", F.explode("tokens").alias("token")).distinct()
    types = pairs.groupBy("file").agg(F.count("*").alias("types"))
    counts = left_join(left_join(files, sums, ["file"]), types, ["file"])
    whole = lambda c, least: F.greatest(F.coalesce(c, F.lit(0)), F.lit(least)).cast("int").alias(c)
    return counts.select(
        "doc_id", whole("types", 0), whole("tokens", 0), whole("words", 0), whole("sentences", 1), whole("syllables", 0)
    )


def readability(documents: DataFrame, return_full: bool = False) -> DataFrame:
    """Flesch reading ease and reading age of every document."""
    return _scored(text_counts(documents), return_full)


def _scored(df: DataFrame, return_full: bool) -> DataFrame:
    words, sentences, syllables = F.col("words"), F.col("sentences"), F.col("syllables")
    df = df.select(
        F.col("doc_id").alias("text"),
        "types", "tokens", "words", "sentences",
        F.bround(F.try_divide(words.cast("double"), sentences.cast("double")), 1).alias("mean_words_ps"),
        F.bround(F.try_divide(syllables.cast("double"), words.cast("double")), 1).alias("mean_syllables_pw"),
        F.bround(tx.flesch(words, sentences, syllables), 0).alias("flesch"),
    )
    df = df.select(
        "*", _band(F.col("flesch"), 0).alias("age"), _band(F.col("flesch"), 1).alias("notes")
    )
    return df if return_full else df.select("text", "flesch", "age", "notes")


def readability_dir(
    spark: SparkSession,
    path: str,
    return_full: bool = False,
    glob: str = "*",
    encoding: str = "ISO-8859-1",
    by_line: bool = False,
) -> DataFrame:
    """Readability of every file of a directory, by file name.

    ``by_line`` reads files by lines, which splits large ones over tasks and
    costs a shuffle; without it a file is one row, of at most 2 GB.
    """
    if by_line:
        return _scored(line_counts(*read_text_lines(spark, path, glob, encoding)), return_full)
    return readability(read_text_dir(spark, path, glob, encoding), return_full)


def corpus_means(documents: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts and means over groups of documents, from exact sums.

    Partial sums are made before the shuffle, so a source holding a third of
    the corpus moves as one row per task.
    """
    total = lambda c: F.sum(c).alias(c)
    sums = text_counts(documents, by).groupBy(*by).agg(
        F.count("*").alias("documents"), total("tokens"), total("words"), total("sentences"),
        total("syllables"),
    )
    ratio = lambda a, b: F.bround(
        F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), 1
    )
    return sums.select(
        *by, "documents", "tokens", "words", "sentences", "syllables",
        ratio("words", "sentences").alias("mean_words_ps"),
        ratio("syllables", "words").alias("mean_syllables_pw"),
    )
