"""Line-first cleaning: rules per line, then rejection of documents that lose too much of their text.

Built-in functions only; one pass over the documents, no shuffle. Null texts count as empty; empty and blank texts have no
words and fail; a text of any length is the arrays of one row; repeated rows give repeated results; other columns stay as
they are, except that those named like a result are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hearthline.llm.common import BLANK, BLANKS, text_or_empty

SYMBOLS = "[#*$%&|<>]"
#: A line of so many characters must hold the end of a sentence.
SENTENCE_CHARS = 50
TERMINAL = "[.!?…。！？]"
#: Characters of a line for each symbol or each character of a "!!", below which it is dropped. Menus with bars fall under this.
CHARS_A_SYMBOL = 20
#: A line of at most so many characters that begins with a menu word and holds no end of a sentence is navigation.
MENU_CHARS = 30
MENU = r"(?i)^[\x20\x09-\x0D]*(home|menu|next|previous|back|login|log in|share|search|skip to content)\b"
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "click here",
    "enable javascript", "lorem ipsum", "subscribe to our newsletter",
)
#: The largest part of its characters that a document may lose.
LOST_SHARE = 0.5
MIN_WORDS = 50
REPEAT_PERCENT = 50

_WORDS = rf"CASE WHEN _t = '' THEN cast(array() AS array<string>) ELSE split(_t, r'{BLANKS}') END"
_HASH = "xxhash64(_words[i], _words[i + 1], _words[i + 2])"
#: One number for each 3-word window: the upper bits of its hash, then its position; sorting such numbers is cheap.
_PACKED = (
    "sort_array(CASE WHEN size(_words) < 3 THEN cast(array() AS array<bigint>) ELSE"
    f" transform(sequence(0, size(_words) - 3), i -> shiftleft(shiftright({_HASH}, 30), 30) | i) END)"
)
#: Windows that share those upper bits with another, now by the whole hash.
_WINDOWS = (
    "sort_array(transform(filter(_packed, (x, k) -> coalesce(shiftright(get(_packed, k - 1), 30) = shiftright(x, 30), false)"
    " OR coalesce(shiftright(get(_packed, k + 1), 30) = shiftright(x, 30), false)), x -> cast(x & 1073741823 AS int)))"
)
_HASHED = f"sort_array(transform(_windows, i -> struct({_HASH} AS h, i AS i)))"
#: Positions of 3-word windows that occur more than once, in order.
_REPEATED = (
    "sort_array(transform(filter(_hashed, (x, k) -> coalesce(get(_hashed, k - 1).h = x.h, false)"
    " OR coalesce(get(_hashed, k + 1).h = x.h, false)), x -> x.i))"
)
#: Words under such windows. Each step is bound to a name by a list of one: written as columns, the optimizer may copy a step into
#: the lambdas of the next, which would then run it once for each word.
_COVERED = "aggregate(transform(_repeated, (p, k) -> least(3, coalesce(get(_repeated, k + 1) - p, 3))), 0L, (a, x) -> a + x)"
for _name, _step in (("_repeated", _REPEATED), ("_hashed", _HASHED), ("_windows", _WINDOWS), ("_packed", _PACKED), ("_words", _WORDS)):
    _COVERED = f"transform(array({_step}), {_name} -> {_COVERED})[0]"


def bad_line(line: Column) -> Column:
    """Whether a line breaks a rule of punctuation, noise, navigation or boilerplate."""
    chars, open_end = F.length(line), ~line.rlike(TERMINAL)
    return (
        (open_end & (chars >= SENTENCE_CHARS))
        | (F.regexp_count(line, F.lit(SYMBOLS)) * CHARS_A_SYMBOL > chars)
        | ((chars - F.length(F.replace(line, F.lit("!!"), F.lit("")))) * CHARS_A_SYMBOL > chars)
        | (open_end & (chars <= MENU_CHARS) & line.rlike(MENU))
        | F.exists(F.array(F.lower(line)), _boilerplate)  # lower() once
    )


def _boilerplate(lower: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(lower, F.lit(phrase)) for phrase in BOILERPLATE))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Every row with its counts, ``base_failed``, ``kept`` and ``cleaned``: the text of the lines that passed.

    Blank lines neither pass nor fail; they stay in ``cleaned``. A document is kept if its base rules hold and ``lost_chars``,
    the characters of its failed lines and their ends, are at most LOST_SHARE of its characters.
    """
    staged = (
        docs.withColumn("_text", text_or_empty())
        .withColumn("_t", F.btrim("_text", F.lit(BLANK)))
        .withColumn("_words", F.expr(_WORDS))
        .withColumn("_lines", F.split("_text", "\n"))
        .withColumn("_full", F.filter("_lines", lambda x: F.btrim(x, F.lit(BLANK)) != ""))
        .withColumn("_passed", F.filter("_lines", lambda x: (F.btrim(x, F.lit(BLANK)) == "") | ~bad_line(x)))
        .withColumn("cleaned", F.array_join("_passed", "\n"))
    )
    chars = F.length("_text").cast("long")
    counted = staged.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long"),
        "n_repeat_words": F.expr(_COVERED),
        "n_failed_lines": (F.size("_lines") - F.size("_passed")).cast("long"),
        "lost_chars": chars - F.length("cleaned"),
        "n_chars_in": chars,
    }).drop("_text", "_t", "_words", "_lines", "_full", "_passed")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_chars") <= LOST_SHARE * F.col("n_chars_in"))
    ).drop("n_chars_in")
