"""Line dedup: lines that many documents share stay in one document only.

A line's key is the line without blanks at both ends, A-Z lower-cased; keys
are compared by a 128-bit hash. A key of at least ``min_chars`` code points
that is found in at least ``min_docs`` documents loses all its lines except in
the largest doc_id holding it.

Only (document, position, hash) rows are shuffled by hash; documents are
counted in two steps (distinct documents a hash, then hashes), so a line that a
third of all documents share is one row a task before it meets in one place.
The text moves once, when the positions to drop meet their document.

Defined cases: a null text counts as an empty one, an empty text is one empty
line. Rows of one doc_id are one document; rows without doc_id together are one
document below all others, so they lose to any with an id. Rows alike in doc_id
and text are cleaned alike. Extra columns stay; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import BLANKS, ascii_lower, free_name, staged, text_or_empty

MIN_DOCS = 3
MIN_CHARS = 20


def line_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, th, pos, h1, h2) a line: th tells apart rows of one doc_id."""
    t = text_or_empty(docs, text)
    lines = docs.select(docs["doc_id"].alias("doc"), F.xxhash64(t).alias("th"), F.posexplode(F.split(t, "\n")).alias("pos", "line"))
    keyed = lines.select("doc", "th", "pos", ascii_lower(trimmed(F.col("line"))).alias("key"))
    return (keyed.where(F.char_length("key") >= MIN_CHARS)
            .select("doc", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))


def trimmed(line):
    """Without blanks at both ends; most lines have none and are left alone."""
    at_end = F.lit(BLANKS).contains(F.left(line, F.lit(1))) | F.lit(BLANKS).contains(F.right(line, F.lit(1)))
    return F.when(at_end, F.btrim(line, F.lit(BLANKS))).otherwise(line)


def shared_keys(keys: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents, and who keeps them."""
    return (keys.select("h1", "h2", "doc").distinct()
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper"))
            .where(F.col("n") >= min_docs).select("h1", "h2", "keeper"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text") -> DataFrame:
    """``docs`` with the cleaned text, n_lines and n_dropped (replacing columns
    so named)."""
    keys = line_keys(docs, text)
    shared = staged(shared_keys(keys, min_docs), "line-shared")  # so that the join can split a hot key's rows
    lost = (keys.join(shared, ["h1", "h2"])
            .where(~F.col("doc").eqNullSafe(F.col("keeper")))
            .groupBy("doc", "th").agg(F.collect_set("pos").alias("lost")))
    others = [c for c in docs.columns if c.lower() not in (text.lower(), "n_lines", "n_dropped")]
    th, lines, drop, keep = free_name(docs, "th", "lines", "drop", "keep")
    t = text_or_empty(docs, text)
    given = docs.select(*[docs[f"`{c}`"] for c in others], docs[text], F.xxhash64(t).alias(th))
    joined = given.join(lost, given["doc_id"].eqNullSafe(lost["doc"]) & (given[th] == lost["th"]), "left").select(
        *[given[f"`{c}`"] for c in others],
        F.split(F.coalesce(given[text], F.lit("")), "\n").alias(lines),
        F.coalesce(lost["lost"], F.array().cast("array<int>")).alias(drop))
    placed = joined.withColumn(keep, F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))))
    return placed.select(
        *[placed[f"`{c}`"] for c in others],
        F.array_join(F.transform(keep, lambda p: placed[lines][p]), "\n").alias(text),
        F.size(lines).cast("long").alias("n_lines"), F.size(drop).cast("long").alias("n_dropped"))
