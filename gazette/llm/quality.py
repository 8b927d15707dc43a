"""Quality rules: clean lines first, then reject documents that lose too much.

Every line with a word is judged by itself; it fails as

* boilerplate, if it holds a stock phrase of web pages,
* navigation, if separators (``|``, ``»``, ``•`` ...) stand between its words
  at a rate of one to four words or more,
* bad punctuation, if 30 % of its words or more end in a cluster of symbols
  (``###``, ``!!``), or if it has fewer than four words and no sentence end.

Failed lines go; a document is rejected if they hold more than 40 % of its
words, or if it fails the base rules (fewer than ten words, or more than 20 %
of the words in 5-word windows that occur twice or more).

Everything is computed a row at a time in the JVM: no shuffle, so neither hot
sources nor groups of copies matter, and a very long text costs in proportion
to its length (windows are compared by 64-bit hashes and sorted in the row).

Defined cases: a null or empty text has no words, all counts are 0 and it
fails the base rules. Extra columns stay, columns named like a result are
replaced, repeated rows are judged alike, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANK_CLASS, BLANKS, WORD_REGEX, free_name

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_LOST_PCT = 40
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
# Stock phrases of web pages, compared without case.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript",
    "lorem ipsum", "privacy policy", "read more", "sign in to", "skip to content", "subscribe to our",
    "terms of service", "terms of use",
)
BOILERPLATE_REGEX = "(?i)(" + "|".join(BOILERPLATE) + ")"
SEPARATOR_REGEX = r"(^|[\x20\x09-\x0D])[|»›•·]+([\x20\x09-\x0D]|$)"
CLUSTER_REGEX = r"[#*$%&|<>!]{2,}([\x20\x09-\x0D]|$)"
SENTENCE_END_REGEX = r"""[.!?:;…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")


def line_fails(line: Column, n_words: Column) -> Column:
    clusters = F.regexp_count(line, F.lit(CLUSTER_REGEX))
    separators = F.regexp_count(line, F.lit(SEPARATOR_REGEX))
    return (line.rlike(BOILERPLATE_REGEX)
            | ((separators > 0) & (separators * 4 >= n_words))
            | (clusters * 10 >= n_words * 3)
            | ((n_words < 4) & ~line.rlike(SENTENCE_END_REGEX)))


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts, base_failed, kept and clean_text (the text
    without its failed lines)."""
    others = [c for c in docs.columns if c.lower() not in RESULT]
    t, lines, hashes, wins, order, spots, n = free_name(docs, "t", "lines", "hashes", "wins", "order", "spots", "n")
    d = docs.select(*[docs[f"`{c}`"] for c in others], F.coalesce(docs[text], F.lit("")).alias(t))
    words = F.filter(F.split(F.col(t), BLANK_CLASS + "+"), lambda w: w != "")
    split = F.split(F.col(t), "\n")
    # a line and its number of words; lines without words don't count
    line = F.filter(F.transform(split, lambda x: F.struct(x.alias("x"), F.regexp_count(x, F.lit(WORD_REGEX)).alias("n"))), lambda s: s["n"] > 0)
    d = d.withColumns({hashes: F.transform(words, lambda w: F.xxhash64(w)), lines: line})
    d = d.withColumn(n, F.size(hashes))
    d = d.withColumn(wins, F.when(F.col(n) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col(n) - WINDOW),
        lambda i: F.xxhash64(*[d[hashes][i + k] for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    some = F.size(F.array_distinct(wins)) < F.size(wins)
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    d = d.withColumn(order, F.when(some, F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    twice = F.filter(order, lambda x, i: ((i > 0) & (F.get(d[order], i - 1)["h"] == x["h"])) | F.coalesce(F.get(d[order], i + 1)["h"] == x["h"], F.lit(False)))
    d = d.withColumn(spots, F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        spots, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), p - a["last"])).alias("sum")), lambda a: a["sum"])
    worded = F.transform(lines, lambda s: s["x"])
    lost = F.aggregate(lines, F.lit(0), lambda a, s: a + F.when(line_fails(s["x"], s["n"]), s["n"]).otherwise(0))
    good = F.filter(split, lambda x: ~F.coalesce(line_fails(x, F.nullif(F.regexp_count(x, F.lit(WORD_REGEX)), F.lit(0))), F.lit(False)))
    failed, n_lost = free_name(d, "failed", "n_lost")
    d = d.withColumns({
        "n_words": F.col(n).cast("long"),
        "word_chars": F.char_length(F.regexp_replace(F.col(t), BLANK_CLASS + "+", "")).cast("long"),
        "n_symbols": F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(worded))).cast("long"),
        "n_repeat_words": covered.cast("long"),
        n_lost: lost, "clean_text": F.array_join(good, "\n"),
    })
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col(n_lost) * 100 <= F.col("n_words") * MAX_LOST_PCT))
    return d.select(*[d[f"`{c}`"] for c in others], *RESULT)
