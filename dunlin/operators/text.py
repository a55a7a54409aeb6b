"""Cleaning of filings and web text, readability and dictionary measures.

Everything works on one document per row with built-in functions.  Lazy
patterns only run on documents that hold their opening tag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.functions.strings import words
from dunlin.session import broadcast_if_bounded

# Patterns and replacement texts of the filing cleaner.
ABBREVIATION = r"[A-Z]\.([A-Z]\.)+"
EMBEDDED_TYPES = (
    "GRAPHIC", "EXCEL", "PDF", "ZIP", "COVER", "CORRESP",
    r"EX-10[01]\.INS", r"EX-99\.SDR [KL]\.INS", r"EX-10[01]\.SCH", r"EX-99\.SDR [KL]\.SCH",
    r"EX-10[01]\.CAL", r"EX-99\.SDR [KL]\.CAL", r"EX-10[01]\.DEF", r"EX-99\.SDR [KL]\.LAB",
    r"EX-10[01]\.LAB", r"EX-10[01]\.PRE", r"EX-99\.SDR [KL]\.PRE")
HEAD = r"<HEAD>.*?</HEAD>"
META = r"(?s)<TYPE>.*?<SEQUENCE>.*?<FILENAME>.*?<DESCRIPTION>"
TABLE = r"(?is)<Table.*?</Table>"
TABLE_END = "</table>"
TAG = r"(?s)<[^>]*>"
ENTITIES = (
    (r"(&#32;|&nbsp;|&#x(A|a)0;)", " "),
    (r"(&#146;|&#x2019;)", "'"),
    (r"&#120;", "x"),
    (r"(&#168;|&#167;|&reg;|&#153;|&copy;)", " "),
    (r"(&#147;|&#148;|&#x201C;|&#x201D;)", '"'),
    (r"&amp;", "&"),
    (r"(&#150;|&#151;|&#x2013;)", "-"),
    (r"&#8260;", "/"))
BOILERPLATE = (r"IDEA: XBRL DOCUMENT", r"/\* Do Not Remove This Comment \*/", r"v2\.4\.0\.8")
URL = r"\b(https?|ftp|file)://[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*[-a-zA-Z0-9+&@#/%=~_|]"
FILE_NAME = r"[_a-zA-Z0-9\-.]+\.(txt|sgml|xml|xsd|htm|html)"
NOT_LETTER_OR_PERIOD = r"[^a-zA-Z.]"
NOT_LETTER = r"[^a-zA-Z]"
# A word with more than two vowel groups, taken whole.
LONG_WORD = "(?:[b-df-hj-np-tv-xz]*+[aeiouy]++){2}[b-df-hj-np-tv-xz]++[aeiouy][a-z]*+"


def _only_if(text: Column, mark: str, cleaned: Column) -> Column:
    return F.when(F.contains(text, F.lit(mark)), cleaned).otherwise(text)


def drop_abbreviations(text: Column) -> Column:
    return F.regexp_replace(text, ABBREVIATION, " ")


def drop_embedded_documents(text: Column) -> Column:
    pattern = rf"(?s)<TYPE>({'|'.join(EMBEDDED_TYPES)}).*?</TEXT>"
    return _only_if(text, "<TYPE>", F.regexp_replace(text, pattern, " "))


def drop_metadata(text: Column) -> Column:
    headless = _only_if(text, "<HEAD>", F.regexp_replace(text, HEAD, " "))
    return _only_if(headless, "<DESCRIPTION>", F.regexp_replace(headless, META, " "))


def drop_tables_and_tags(text: Column) -> Column:
    # Only what comes before the last closing tag can hold a whole table; there
    # every lazy match ends, so unclosed tags are not tried again and again.
    upto = F.length(text) - F.instr(F.reverse(F.lower(text)), TABLE_END[::-1]) + 1
    held = F.contains(F.lower(text), F.lit("<table")) & F.contains(F.lower(text), F.lit(TABLE_END))
    flat = F.when(held, F.concat(F.regexp_replace(F.substring(text, F.lit(1), upto), TABLE, " "), F.substring(text, upto + 1, F.length(text)))).otherwise(text)
    return F.regexp_replace(flat, TAG, " ")


def replace_entities(text: Column) -> Column:
    for pattern, replacement in ENTITIES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def drop_boilerplate(text: Column) -> Column:
    for pattern in BOILERPLATE:
        text = F.regexp_replace(text, pattern, " ")
    return text


def keep_letters_and_periods(text: Column) -> Column:
    """Remove URLs and file names, then blank out all but letters and periods."""
    # A match can only begin where a run of name letters begins: the greedy run
    # takes the last extension in it either way.
    text = F.regexp_replace(F.regexp_replace(text, URL, ""), r"(?<![_a-zA-Z0-9\-.])" + FILE_NAME, " ")
    return F.regexp_replace(text, NOT_LETTER_OR_PERIOD, " ")


def letters_only(text: Column) -> Column:
    return collapse_whitespace(F.regexp_replace(text, NOT_LETTER, " "))


#: The cleaner's steps in order; boilerplate goes after the white space.
FILING_STEPS = (drop_abbreviations, drop_embedded_documents, drop_metadata, drop_tables_and_tags,
                replace_entities, collapse_whitespace, drop_boilerplate, keep_letters_and_periods)


def clean_filing(df: DataFrame, column: str, out: str) -> DataFrame:
    """Run all cleaning steps; each one becomes its own projection."""
    df = df.withColumn(out, F.col(column))
    for step in FILING_STEPS:
        df = df.withColumn(out, step(F.col(out)))
    return df


# ------------------------------------------------------- document statistics


def fog_index(df: DataFrame, key: str, column: str, digits: int = 4) -> DataFrame:
    """``0.4 * (words / sentences + 100 * long words / words)`` per document.

    A sentence ends with a period and a long word has over two vowel groups.
    Documents without a period or a word are left out.  Nothing is shuffled.
    """
    lowered = F.lower(column)
    sized = df.select(
        key, F.regexp_count(column, F.lit(r"\.")).alias("periods"),
        F.regexp_count(lowered, F.lit("[a-z]+")).alias("n"),
        F.regexp_count(lowered, F.lit(LONG_WORD)).alias("long")).where("periods > 0 AND n > 0")
    fog = 0.4 * (F.col("n") / F.col("periods") + 100.0 * F.col("long") / F.col("n"))
    return sized.select(key, F.round(fog, digits).alias("fog"))


def word_counts(df: DataFrame, keys: Sequence[str], column: str, pattern: str = "[a-z]+") -> DataFrame:
    """``(keys, word, n)``; repeated words shrink before the shuffle."""
    return (df.select(*keys, F.explode(words(F.col(column), pattern)).alias("word"))
            .groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n")))


def match_dictionary(df: DataFrame, keys: Sequence[str], column: str, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Words of the texts found in the dictionary: ``(keys, word, n, attributes)``, one row per key and word.

    If the dictionary's words are few bytes they go to every executor and other
    words are dropped where they arise; the counts are the same either way.
    """
    entries = dictionary.withColumn("word", F.lower(word)) if word == "word" else (
        dictionary.withColumn("word", F.lower(word)).drop(word))
    known = broadcast_if_bounded(entries.select("word").distinct())
    found = df.select(*keys, F.explode(words(F.col(column))).alias("word")).join(known, "word", "left_semi")
    return found.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n")).join(entries, "word")


def dictionary_measures(matched: DataFrame, keys: Sequence[str], digits: int = 6) -> DataFrame:
    """Matched words, negative words and their ratio per document."""
    total = F.sum("n")
    negative = F.sum(F.when(F.col("negative") > 0, F.col("n")).otherwise(0))
    return matched.groupBy(*keys).agg(total.alias("words"), negative.alias("negative"),
                                      F.round(negative / total, digits).alias("sentiment"))


def modal_counts(matched: DataFrame) -> DataFrame:
    """Words per modal strength."""
    return matched.where("modal > 0").groupBy("modal").agg(F.sum("n").alias("n"))


def without_stop_words(counts: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """Alphabetic words, lower-cased, that are not stop words."""
    kept = counts.where(F.rlike(word, F.lit("^[A-Za-z]+$"))).withColumn(word, F.lower(word))
    stops = stop_words.select(F.lower(word).alias(word)).distinct()
    return kept.join(broadcast_if_bounded(stops), word, "left_anti")


def document_from_sentences(df: DataFrame, column: str, out: str, separator: str = ",") -> DataFrame:
    """Join the sentences of an array column to one text."""
    return df.withColumn(out, F.concat_ws(separator, column)).drop(column)
