"""Keyword dictionary: loading, exclusion, categorisation, provisional labels.

The dictionary is configuration: it is loaded and normalised once on the
driver. Matching runs in one of two physical forms with the same result, chosen
by the caller:

* ``expr`` (the default) — one boolean expression per sub-category, an OR of
  ``contains`` with short-circuit per sub. No join, no shuffle; the cost grows
  with words times text length.
* ``pieces`` — for dictionaries of many thousand words: each word is known by
  the rarest of its three-character pieces. Of the distinct pieces of a text
  those that some word is known by are kept (a hash set lookup each), and only
  the words of these are tested with ``contains``. Everything stays in the row:
  no text moves. ``join`` is an older name of it.

Matching is by substring on NFC + lower-cased text, title + ' ' + description,
so a keyword may also match across the joint.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import constants as K
from ..functions.text import match_text, norm_lower, py_norm_lower

PIECE = 3   # characters of a word that a text's pieces are joined on

CATEGORIES_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


@dataclass
class Taxonomy:
    """Normalised dictionary: categories -> subs -> words, excludes, type hints."""
    categories: list = field(default_factory=list)   # [(category, [(sub, [word, ...]), ...]), ...]
    exclude: list = field(default_factory=list)
    hints: dict | None = None                        # {'subsidy': [...], 'commissioned': [...]}

    @classmethod
    def from_dict(cls, data) -> "Taxonomy":
        """Every list of words below a category is a sub-category; anything of
        another shape is left out."""
        if not isinstance(data, dict):
            raise ValueError("a dictionary is an object of categories")

        def words(value):
            return [py_norm_lower(w) for w in value] if isinstance(value, list) else None

        reserved = (K.DICT_EXCLUDE_KEY, K.DICT_HINTS_KEY)
        nested = {c: v for c, v in data.items() if c not in reserved and isinstance(v, dict)}
        categories = [(c, [(sub, w) for sub, v in subs.items() if (w := words(v)) is not None]) for c, subs in nested.items()]
        hints = data.get(K.DICT_HINTS_KEY)
        return cls(categories, words(data.get(K.DICT_EXCLUDE_KEY)) or [],
                   {k: words(v) for k, v in hints.items()} if isinstance(hints, dict) else None)

    @classmethod
    def from_json(cls, path, spark: SparkSession | None = None) -> "Taxonomy":
        """From a JSON file on any file system that Spark reads."""
        spark = spark or SparkSession.active()
        from .store import read_text
        text = read_text(spark, str(path))
        if text is None:
            raise FileNotFoundError(str(path))
        return cls.from_dict(json.loads(text))

    @property
    def category_names(self) -> list:
        return [c for c, _ in self.categories]


def _any_contains(text: Column, words) -> Column:
    if not words:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def _empty_categories() -> Column:
    return F.from_json(F.lit("{}"), CATEGORIES_TYPE)


def categories_expr(norm_text: Column, tax: Taxonomy) -> Column:
    """``MAP<category, ARRAY<sub>>`` of matched subs (sorted), categories in
    dictionary order, categories without a hit left out."""
    entries = []
    for cat, subs in tax.categories:
        if not subs:
            continue
        hit = F.array(*[F.when(_any_contains(norm_text, ws), F.lit(sub)) for sub, ws in subs])
        entries.append(F.struct(F.lit(cat).alias("key"), F.array_sort(F.array_compact(hit)).alias("value")))
    if not entries:
        return _empty_categories()
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0))


def exclude_expr(norm_title: Column, tax: Taxonomy) -> Column:
    """True when the (normalised) title contains an exclude word; '' -> False."""
    return (F.coalesce(norm_title, F.lit("")) != "") & _any_contains(F.coalesce(norm_title, F.lit("")), tax.exclude)


def pre_label_expr(norm_text: Column, tax: Taxonomy) -> Column:
    """Provisional type from hint words: both or neither signal -> unknown."""
    if tax.hints is None:
        return F.lit(K.UNKNOWN)
    sub = _any_contains(norm_text, tax.hints.get("subsidy") or [])
    com = _any_contains(norm_text, tax.hints.get("commissioned") or [])
    return (F.when(sub & com, F.lit(K.UNKNOWN)).when(sub, F.lit("subsidy"))
            .when(com, F.lit("commissioned")).otherwise(F.lit(K.UNKNOWN)))


def hits_array(categories: Column) -> Column:
    """Subs of all categories, dictionary order, not re-sorted."""
    return F.flatten(F.map_values(categories))


def flatten_hits(categories: Column) -> Column:
    """All matched subs, sorted."""
    return F.array_sort(hits_array(categories))


def hits_json(categories: Column) -> Column:
    """Stored keyword_hits: a JSON list, NULL when there is no hit."""
    h = hits_array(categories)
    return F.when(F.size(h) > 0, F.to_json(h))


def category_flag(categories: Column, category: str) -> Column:
    return F.coalesce(F.map_contains_key(categories, F.lit(category)), F.lit(False))


def category_tags(flags: list, labels: list, sep: str = " ") -> Column:
    """Labels of the set flags, in the given order, joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(f, F.lit(l)) for f, l in zip(flags, labels)])), sep)


# --------------------------------------------------------------------------
# form 2: words looked up by their rarest piece


def pieces_of(word: str) -> list:
    return [word[i:i + PIECE] for i in range(len(word) - PIECE + 1)]


def rarest_pieces(tax: Taxonomy, frequency: dict | None = None) -> dict:
    """piece -> [(word, c, s), ...]: every word of at least ``PIECE`` characters
    under the rarest of its pieces, with the places of its category and
    sub-category. How often a piece is met is told by ``frequency`` (texts that
    hold it) and, where that says nothing, by the number of words that hold it,
    so that words which all begin alike are told apart."""
    rows = sorted({(w, i, j) for i, (_, subs) in enumerate(tax.categories) for j, (_, ws) in enumerate(subs) for w in ws if len(w) >= PIECE})
    held = Counter(p for w in {w for w, _, _ in rows} for p in set(pieces_of(w)))
    out: dict = {}
    for w, i, j in rows:
        best = min(pieces_of(w), key=lambda p: ((frequency or {}).get(p, 0), held[p], p))
        out.setdefault(best, []).append((w, i, j))
    return out


def _pieces(text: Column) -> Column:
    """The distinct runs of ``PIECE`` characters of a text: those that follow
    each other, from each of the first ``PIECE`` characters on."""
    runs = [F.regexp_extract_all(F.substring(text, k + 1, (1 << 31) - 1), F.lit(f"(?s).{{{PIECE}}}"), F.lit(0)) for k in range(PIECE)]
    return F.concat(*runs)


def piece_frequencies(df: DataFrame, tax: Taxonomy, text: str) -> dict:
    """Texts that hold each piece of the dictionary's words (bounded by it)."""
    known = sorted({p for _, subs in tax.categories for _, ws in subs for w in ws for p in pieces_of(w)})
    if not known:
        return {}
    used = F.array_distinct(F.filter(_pieces(F.col(text)), lambda p: p.isin(known)))
    return {r["p"]: r["n"] for r in df.select(F.explode(used).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}


def _hits_by_piece(text: Column, tax: Taxonomy, frequency: dict | None) -> Column:
    """The (c, s) places of the sub-categories found in a text."""
    by_piece = rarest_pieces(tax, frequency)
    none = F.array().cast("array<struct<c:int,s:int>>")
    if not by_piece:
        return none
    n = len(by_piece)
    # words in slots by a hash of their piece: a slot is found without a search
    slots: list = [[] for _ in range(n)]
    for p, words in by_piece.items():
        slots[zlib.crc32(p.encode()) % n] += [{"w": w, "c": i, "s": j} for w, i, j in words]
    table = F.from_json(F.lit(json.dumps(slots)), "array<array<struct<w:string,c:int,s:int>>>")

    def found(piece: Column) -> Column:
        words = F.get(table, F.pmod(F.crc32(piece.cast("binary")), F.lit(n)).cast("int"))
        return F.transform(F.filter(words, lambda x: text.contains(x["w"])), lambda x: F.struct(x["c"].alias("c"), x["s"].alias("s")))

    used = F.array_distinct(F.filter(_pieces(text), lambda p: p.isin(sorted(by_piece))))
    return F.coalesce(F.array_distinct(F.flatten(F.transform(used, found))), none)


def _subs_hit(hits: Column, category: int, names: Column) -> Column:
    own = F.filter(hits, lambda h: h["c"] == category)
    return F.transform(own, lambda h: F.get(names, h["s"]))


def _categories_from_hits(hits: Column, norm_text: Column, tax: Taxonomy) -> Column:
    """As :func:`categories_expr`; words too short for a piece are tested here."""
    entries = []
    for i, (cat, subs) in enumerate(tax.categories):
        if not subs:
            continue
        found = _subs_hit(hits, i, F.array(*[F.lit(sub) for sub, _ in subs]))
        few = F.array_compact(F.array(*[F.when(_any_contains(norm_text, [w for w in ws if len(w) < PIECE]), F.lit(sub)) for sub, ws in subs]))
        entries.append(F.struct(F.lit(cat).alias("key"), F.array_sort(F.array_distinct(F.concat(found, few))).alias("value")))
    if not entries:
        return _empty_categories()
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0))


def categorise(df: DataFrame, tax: Taxonomy, title: str = "title", description: str = "description",
               out: str = "categories", method: str = "expr", norm_col: str | None = None, key: str | None = None, frequency: dict | None = None) -> DataFrame:
    """Add ``out``: the category map of each row (C1 + D1).

    ``norm_col`` names an existing normalised match-text column; otherwise it
    is computed here (NFC + lower of title + ' ' + description).
    ``frequency`` says how often pieces are met (:func:`piece_frequencies`);
    ``key`` is no longer needed."""
    tmp = norm_col or "_match_norm"
    if norm_col is None:
        df = df.withColumn(tmp, norm_lower(match_text(title, description)))
    if method == "expr":
        res = df.withColumn(out, categories_expr(F.col(tmp), tax))
    elif method in ("pieces", "join"):
        hits, = [c for c in ("_hits", "__hits") if c not in df.columns][:1]
        df = df.withColumn(hits, _hits_by_piece(F.col(tmp), tax, frequency))
        res = df.withColumn(out, _categories_from_hits(F.col(hits), F.col(tmp), tax)).drop(hits)
    else:
        raise ValueError(method)
    return res.drop(tmp) if norm_col is None else res


def prepare(df: DataFrame, tax: Taxonomy, title: str = "title", description: str = "description") -> DataFrame:
    """Exclusion, categories and provisional label, with a ``stage`` column
    giving each record's first-match outcome: excluded | no_category | kept.

    The description of an excluded row is not normalised or matched; the row
    stays, without categories, for the run counters."""
    d = (df.withColumn("_norm_title", norm_lower(F.col(title)))
           .withColumn("excluded", exclude_expr(F.col("_norm_title"), tax))
           .withColumn("_match_norm", F.when(~F.col("excluded"), norm_lower(match_text(title, description)))))
    d = categorise(d, tax, title, description, norm_col="_match_norm")
    d = d.withColumn("pre_label", pre_label_expr(F.col("_match_norm"), tax))
    stage = (F.when(F.col("excluded"), F.lit("excluded"))
             .when(F.size("categories") == 0, F.lit("no_category"))
             .otherwise(F.lit("kept")))
    return d.withColumn("stage", stage).drop("_norm_title", "_match_norm")
