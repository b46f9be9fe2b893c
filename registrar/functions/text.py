"""Text statistics as column expressions.

A word is a run of letters and digits, with inner apostrophes and hyphens. A
token is a word or one punctuation mark or symbol. A sentence ends in full
stops, exclamation or question marks before white space or the end. A syllable
is a run of vowels, at least one for each word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"
TOKEN = WORD + r"|[\p{P}\p{S}]"
SENTENCE_END = r"[.!?]+(?:[ \t\n\r\f]|\z)"
VOWELS = r"[AEIOUYaeiouy]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def is_word(token: Column) -> Column:
    return token.rlike(r"^[\p{L}\p{N}]")


def sentence_ends(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SENTENCE_END))


def sentences(text: Column) -> Column:
    return F.greatest(sentence_ends(text), F.lit(1))


def syllables(text: Column, words: Column) -> Column:
    """Vowel runs of the text, and one for each word that has none."""
    silent = F.size(F.filter(words, lambda w: ~w.rlike(VOWELS)))
    return F.regexp_count(text, F.lit(VOWELS)) + silent


def flesch(words: Column, sentence_count: Column, syllable_count: Column) -> Column:
    """Flesch reading ease; null for a text without words."""
    per_sentence = F.try_divide(words.cast("double"), sentence_count.cast("double"))
    per_word = F.try_divide(syllable_count.cast("double"), words.cast("double"))
    return 206.835 - 1.015 * per_sentence - 84.6 * per_word
