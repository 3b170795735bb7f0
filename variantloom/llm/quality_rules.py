"""Line-first quality rules, in built-in functions only.

Each line is judged first: punctuation, navigation and boilerplate rules mark lines that fail. Lines
that fail are removed, and a document that loses too much of its text, or fails the base rules on
its whole text, is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.text import lower_ascii, word_array

# Phrases of page furniture, in lower case. A line of few words that holds one fails.
BOILERPLATE = [
    "accept all cookies", "accept cookies", "add to cart", "all rights reserved", "back to top",
    "click here", "cookie policy", "cookie settings", "enable javascript", "follow us on",
    "forgot your password", "leave a comment", "log in to", "privacy policy", "read more",
    "share this", "sign up for", "skip to content", "skip to main content", "subscribe to our",
    "terms of service", "terms of use", "this site uses cookies", "we use cookies",
]
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules; percentages are of words, except `lost`, of the word characters."""

    boilerplate_words: int = 15  # a longer line is a paragraph, whatever it mentions
    symbol_percent: int = 50  # symbols per hundred words
    separators: int = 3  # bars, bullets and chevrons that make a line a menu
    separator_percent: int = 25
    shouted_percent: int = 50  # exclamation marks per hundred words
    repeat_words: int = 10  # from here on a line of hardly any different words fails
    distinct_percent: int = 20
    lost: int = 50
    base_words: int = 50
    base_repeat_percent: int = 50


def measured(line: Column) -> Column:
    """A line with its words, split once for all rules."""
    return F.struct(line.alias("line"), word_array(line).alias("words"))


def failed_rule(x: Column, limits: Limits) -> Column:
    """Whether a measured line fails a rule. Lines without a word never do."""
    line, count = x["line"], F.size(x["words"])
    furniture = (count <= limits.boilerplate_words) & lower_ascii(line).rlike("|".join(BOILERPLATE))
    # Most lines hold none of the characters that the next three rules count.
    marked = line.rlike("[#*$%&|<>•»›!]")
    symbols = F.regexp_count(line, F.lit(SYMBOLS)) * 100 > count * limits.symbol_percent
    marks = F.regexp_count(line, F.lit("[|•»›]"))
    menu = (marks >= limits.separators) & (marks * 100 > count * limits.separator_percent)
    calls = F.regexp_count(line, F.lit("!"))
    shouted = (calls >= 3) & (calls * 100 > count * limits.shouted_percent)
    different = F.size(F.array_distinct(x["words"]))
    dull = (count >= limits.repeat_words) & (different * 100 < count * limits.distinct_percent)
    return furniture | (marked & (symbols | menu | shouted)) | dull


def windows(words: Column) -> Column:
    """Windows of three words with their places, sorted by the words; NULL for fewer than two windows."""
    n = F.size(words) - 2
    zipped = F.arrays_zip(
        F.slice(words, F.lit(1), n).alias("a"),
        F.slice(words, F.lit(2), n).alias("b"),
        F.slice(words, F.lit(3), n).alias("c"),
        F.sequence(F.lit(0), n - 1).alias("at"),
    )
    return F.when(n > 1, F.sort_array(zipped))


def repeat_words(ordered: Column) -> Column:
    """Words inside windows that occur at least twice, from the sorted windows (a stored column).

    Equal windows are neighbours; the sorted places of those that repeat each add three words, less
    what the one before covers already.
    """
    n = F.size(ordered)

    def equal(x: Column, y: Column) -> Column:
        return (x["c"] == y["c"]) & (x["a"] == y["a"]) & (x["b"] == y["b"])

    equal_places = F.zip_with(
        F.slice(ordered, F.lit(1), n - 1),
        F.slice(ordered, F.lit(2), n - 1),
        lambda x, y: F.when(equal(x, y), F.array(x["at"], y["at"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(equal_places, lambda p: p.isNotNull()))))
    state = F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-3).alias("last")),
        lambda s, at: F.struct((s["sum"] + F.least(F.lit(3), at - s["last"])).alias("sum"), at.alias("last")),
    )
    return F.coalesce(state["sum"], F.lit(0).cast("bigint"))


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the counts of every whole text, kept, and the text without its failed lines.

    One row per input row, computed inside the row: nothing is shuffled. A NULL text counts as empty;
    empty and short texts fail the base rules. Only doc_id and text are read, so other columns can
    have any name. `clean_text` is NULL where the document is rejected.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n"), measured), lambda x: F.size(x["words"]) > 0)
    rows = docs.select("doc_id", text.alias("text"), lines.alias("lines"))
    # Words never span lines, so the text's words are those of its lines.
    rows = rows.select("*", F.flatten("lines.words").alias("words"))
    good = F.filter(F.col("lines"), lambda x: ~failed_rule(x, limits))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines.line"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        windows(F.col("words")).alias("_ordered"),
        good.alias("_good"),
    )
    rows = rows.select(
        "*",
        repeat_words(F.col("_ordered")).alias("n_repeat_words"),
        F.char_length(F.array_join(F.flatten("_good.words"), "")).cast("bigint").alias("kept_chars"),
    )
    base_failed = (F.col("n_words") < limits.base_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.base_repeat_percent
    )
    lost = (F.col("word_chars") - F.col("kept_chars")) * 100 > F.col("word_chars") * limits.lost
    rows = rows.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & ~lost)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", F.size("_good").cast("bigint").alias("n_kept_lines"), "kept_chars",
        F.when(F.col("kept"), F.array_join("_good.line", "\n")).alias("clean_text"),
    )
