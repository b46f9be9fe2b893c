"""Quality rules, line first: bad lines are removed, then documents that lose too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import let

BLANKS = " \t\n\x0b\f\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
_TERMINAL = r"[.!?:;\"')\]…”»]$"

#: A line with one of these is boilerplate.
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "use of cookies", "enable javascript", "click here", "sign up for", "subscribe to our",
)
#: A line with so many of | and > is navigation.
SEPARATORS = 3
#: A line without an end mark needs so many words.
LEAST_WORDS = 3
#: A line may have one symbol to so many words.
WORDS_PER_SYMBOL = 4
#: A document may lose so many hundredths of its word characters with its bad lines.
MOST_LOST = 30


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, the base rule, the line rules' outcome and ``kept``.

    Words are runs of anything but ASCII white space. Added: n_words,
    word_chars, n_symbols, n_dup_lines (lines with a word that equal an earlier
    one), n_repeat_words (words inside five-word windows that stand twice or
    more in the text), base_failed (under 10 words, or over a fifth of them
    repeated), n_lines and n_bad_lines (lines with a word; of them, those
    that fail a line rule), kept_chars (word characters in the good lines),
    ``kept``, and ``clean_text`` (the good lines). Columns of these names are
    replaced.

    Null and empty texts have no words, so they fail the base rule. Rows that
    repeat are measured one by one.
    """
    names = [c for c in docs.columns if c not in _ADDED]
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda l: F.btrim(l, F.lit(BLANKS)) != "")
    checked = docs.select(
        *names,
        _words(text).alias("__words"),
        let(lines, lambda ls: F.struct(
            F.transform(ls, _line).alias("line"),
            (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup"),
        )).alias("__lines"),
    )
    line = F.col("__lines.line")
    counted = checked.select(
        *names,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.aggregate(line.symbols, F.lit(0), lambda a, x: a + x).cast("long").alias("n_symbols"),
        F.col("__lines.dup").cast("long").alias("n_dup_lines"),
        _repeated(F.col("__words")).cast("long").alias("n_repeat_words"),
        F.size(line).cast("long").alias("n_lines"),
        F.size(F.filter(line, lambda x: x.bad)).cast("long").alias("n_bad_lines"),
        F.aggregate(
            line, F.lit(0), lambda a, x: a + F.when(x.bad, 0).otherwise(x.chars)
        ).cast("long").alias("kept_chars"),
        F.array_join(F.transform(F.filter(line, lambda x: ~x.bad), lambda x: x.text), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    lost = 100 * (F.col("word_chars") - F.col("kept_chars")) > MOST_LOST * F.col("word_chars")
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~lost)


_ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines",
    "kept_chars", "clean_text", "base_failed", "kept",
)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANK_RUN, -1))


def _line(line: Column) -> Column:
    """Word characters, symbols and the verdict of one line."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    parts = F.struct(
        F.size(F.split(trimmed, _BLANK_RUN, -1)).alias("words"),
        F.length(F.regexp_replace(trimmed, _BLANK_RUN, "")).alias("chars"),
        (F.length(line) - F.length(F.regexp_replace(line, _SYMBOLS, ""))).alias("symbols"),
        (2 * F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))
         - F.length(F.replace(line, F.lit(">"), F.lit("")))).alias("separators"),
        F.lower(line).alias("lower"),
        trimmed.rlike(_TERMINAL).alias("ended"),
    )

    def verdict(p: Column) -> Column:
        boilerplate = F.lit(False)
        for phrase in BOILERPLATE:
            boilerplate = boilerplate | p.lower.contains(phrase)
        bad = (
            (~p.ended & (p.words < LEAST_WORDS))
            | (WORDS_PER_SYMBOL * p.symbols > p.words)
            | (p.separators >= SEPARATORS)
            | boilerplate
        )
        return F.struct(
            line.alias("text"), p.chars.alias("chars"), p.symbols.alias("symbols"), bad.alias("bad")
        )

    return let(parts, verdict)


def _repeated(words: Column) -> Column:
    """Words covered by five-word windows that stand at least twice.

    Windows are compared by a 64-bit hash. Only texts that have some repeated
    window, which a hash set tells, are sorted to find where.
    """
    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)])
        )

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(placed, lambda s: F.filter(
            s,
            lambda x, i: x.h.eqNullSafe(F.get(s, i - 1).h) | x.h.eqNullSafe(F.get(s, i + 1).h),
        ))
        at = F.array_sort(F.transform(twice, lambda x: x.i))
        start = F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last"))
        return F.aggregate(
            at,
            start,
            lambda a, p: F.struct((a.n + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a.n,
        )

    counted = let(
        words,
        lambda w: let(hashes(w), lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), covered(h)
        ).otherwise(F.lit(0))),
    )
    return F.when(F.size(words) < 5, F.lit(0)).otherwise(counted)


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return measure(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_lines", "n_bad_lines", "kept_chars", "kept",
    )


_PHRASES = " OR ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
SQL = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), gram AS (
    SELECT doc_id, pos, array_to_string(list_slice(words, pos, pos + 4), ' ') AS w
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS pos FROM doc WHERE len(words) >= 5)
), twice AS (
    SELECT doc_id, pos FROM gram QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest(generate_series(pos, pos + 4)) AS p FROM twice) GROUP BY doc_id
), line AS (
    SELECT doc_id, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS chars,
           (NOT regexp_matches(regexp_replace(l, '[\x20\x09-\x0D]+$', ''), '[.!?:;"'')\]…”»]$')
                AND len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) < {LEAST_WORDS})
           OR {WORDS_PER_SYMBOL} * length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) > len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
           OR length(regexp_replace(l, '[^|>]', '', 'g')) >= {SEPARATORS}
           OR {_PHRASES} AS bad
    FROM (SELECT doc_id, unnest(lines) AS l FROM doc)
), summed AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_bad_lines,
           coalesce(sum(chars) FILTER (NOT bad), 0) AS kept_chars
    FROM line GROUP BY doc_id
), counted AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(array_to_string(words, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(repeated.n, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines,
           CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
    FROM doc LEFT JOIN repeated USING (doc_id) LEFT JOIN summed USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND NOT 100 * (word_chars - kept_chars) > {MOST_LOST} * word_chars AS kept
FROM counted
"""
