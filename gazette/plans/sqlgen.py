"""Helpers that write the DuckDB oracle SQL for the query catalog.

The oracle is an independent formulation of each query in plain SQL over the
same parquet tables; only constants (dictionary words, labels) are shared.
"""

from __future__ import annotations

from .. import constants as K
from ..operators.taxonomy import Taxonomy

# Python str.strip() whitespace, in RE2 syntax
SQL_SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]"


def lit(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def ustrip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def any_contains(text: str, words) -> str:
    if not words:
        return "FALSE"
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def categories_str(text: str, tax: Taxonomy) -> str:
    """'cat:sub,sub;cat:sub' in dictionary order, subs sorted; '' when none."""
    parts = []
    for cat, subs in tax.categories:
        arr = "[" + ", ".join(f"CASE WHEN {any_contains(text, ws)} THEN {lit(s)} END" for s, ws in subs) + "]"
        lst = f"list_sort(list_filter({arr}, lambda x: x IS NOT NULL))"
        parts.append(f"CASE WHEN len({lst}) > 0 THEN {lit(cat + ':')} || array_to_string({lst}, ',') END")
    return "concat_ws(';', " + ", ".join(parts) + ")" if parts else "''"


def category_hit(text: str, tax: Taxonomy, category: str) -> str:
    for cat, subs in tax.categories:
        if cat == category:
            return any_contains(text, [w for _, ws in subs for w in ws])
    return "FALSE"


def hits_list(text: str, tax: Taxonomy) -> str:
    """Flattened subs: dictionary category order, subs sorted inside a category."""
    lists = []
    for cat, subs in tax.categories:
        arr = "[" + ", ".join(f"CASE WHEN {any_contains(text, ws)} THEN {lit(s)} END" for s, ws in subs) + "]"
        lists.append(f"list_sort(list_filter({arr}, lambda x: x IS NOT NULL))")
    if not lists:
        return "[]::VARCHAR[]"
    return "flatten([" + ", ".join(lists) + "])"


def pre_label(text: str, tax: Taxonomy) -> str:
    if tax.hints is None:
        return lit(K.UNKNOWN)
    s = any_contains(text, tax.hints.get("subsidy") or [])
    c = any_contains(text, tax.hints.get("commissioned") or [])
    return (f"CASE WHEN {s} AND {c} THEN 'unknown' WHEN {s} THEN 'subsidy' "
            f"WHEN {c} THEN 'commissioned' ELSE 'unknown' END")


N_CTE = f"""n AS (
  SELECT doc_id AS ord, source, CAST(doc_id AS VARCHAR) AS external_id,
         {ustrip("split_part(text, chr(10), 1)")} AS title,
         'https://d.example/' || CAST(CASE WHEN doc_id % 3 = 0 THEN doc_id ELSE doc_id % 100 END AS VARCHAR) AS url,
         text AS description,
         DATE '1997-01-01' + CAST(doc_id % 500 AS INTEGER) AS posted_date,
         CASE WHEN doc_id % 11 <> 0
              THEN DATE '1997-01-01' + CAST(doc_id % 500 AS INTEGER) + CAST(30 + doc_id % 60 AS INTEGER) END AS deadline,
         'unknown' AS tender_type
  FROM documents)"""


def prepared_cte(tax: Taxonomy, src: str = "n") -> str:
    """Normalised texts, exclusion, categories, label and stage of each record."""
    norm = "lower(nfc_normalize(coalesce(title, '') || ' ' || coalesce(description, '')))"
    ntitle = "lower(nfc_normalize(title))"
    return f"""p0 AS (
  SELECT *, {norm} AS mt, {ntitle} AS nt FROM {src}),
p AS (
  SELECT * EXCLUDE (mt, nt),
         (coalesce(nt, '') <> '' AND {any_contains("coalesce(nt, '')", tax.exclude)}) AS excluded,
         {categories_str("mt", tax)} AS categories_str,
         {hits_list("mt", tax)} AS hits,
         {pre_label("mt", tax)} AS pre_label
  FROM p0),
ps AS (
  SELECT *, CASE WHEN excluded THEN 'excluded' WHEN len(hits) = 0 THEN 'no_category' ELSE 'kept' END AS stage
  FROM p)"""


def sanitise(expr: str, n: int) -> str:
    """The scorer-input sanitiser in DuckDB SQL."""
    x = f"nfc_normalize(coalesce({expr}, ''))"
    x = f"regexp_replace({x}, '{K.CONTROL_CHARS_CLASS}', ' ', 'g')"
    x = f"regexp_replace({x}, '  +', ' ', 'g')"
    x = ustrip(x)
    pat = "(?i)(" + "|".join(K.INJECTION_PHRASES) + ")"
    return f"substring(CASE WHEN regexp_matches({x}, {lit(pat)}) THEN {lit(K.INJECTION_PLACEHOLDER)} ELSE {x} END, 1, {n})"


def html_escape(expr: str) -> str:
    return (f"replace(replace(replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&#34;'), '''', '&#39;')")


NATIVE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'),
                   ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
                   ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def node_text_stripped(expr: str) -> str:
    x = f"regexp_replace({expr}, '<[^>]*>', chr(1), 'g')"
    for ent, ch in NATIVE_ENTITIES:
        x = f"replace({x}, {lit(ent)}, {lit(ch)})"
    x = f"regexp_replace({x}, '{SQL_SPACE}*\\x01{SQL_SPACE}*', '', 'g')"
    return ustrip(x)


ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
