"""Text functions: Unicode normalisation, stripping, sanitising, escaping.

Normalisation runs in the JVM through ICU (shipped with Spark 4 for collations)
via the ``reflect`` SQL function; an Arrow-batched pandas UDF is kept as the
fallback engine. Both give Python's ``unicodedata`` result: NFC does *not* fold
width, so full-width letters only lower-case, they are not mapped to ASCII.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .. import constants as K

_ICU = "com.ibm.icu.text.Normalizer"
# form -> (ICU static method, compat flag)
_ICU_CALLS = {"NFC": ("compose", False), "NFKC": ("compose", True),
              "NFD": ("decompose", False), "NFKD": ("decompose", True)}

# Characters Python's str.strip() removes (str.isspace): ASCII controls
# \t\n\v\f\r, the separators \x1c-\x1f, NEL and every Unicode Z* separator.
PY_SPACE_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\p{Z}]"
_STRIP_RE = rf"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$"


_ENGINE = {"normalize": "icu"}


def set_normalize_engine(engine: str) -> None:
    """Choose 'icu' (JVM, default) or 'python' (Arrow pandas UDF)."""
    if engine not in ("icu", "python"):
        raise ValueError(engine)
    _ENGINE["normalize"] = engine


@lru_cache(maxsize=None)
def _normalize_udf(form: str):
    @F.pandas_udf(T.StringType())
    def _norm(s: pd.Series) -> pd.Series:
        # ASCII text is already in every normal form: skip the call for it.
        def one(x):
            if x is None or x.isascii():
                return x
            return unicodedata.normalize(form, x)
        return s.map(one)
    return _norm


def normalize(col: Column | str, form: str = "NFC") -> Column:
    """Unicode normal form of a string column (NULL stays NULL)."""
    form = form.upper()
    c = F.col(col) if isinstance(col, str) else col
    if _ENGINE["normalize"] == "python":
        return _normalize_udf(form)(c)
    method, compat = _ICU_CALLS[form]
    call = F.call_function("reflect", F.lit(_ICU), F.lit(method), c, F.lit(compat))
    # ICU runs its own quick check and returns early for text already in the
    # form; a JVM-side pre-check with a regular expression measured slower.
    return F.when(c.isNotNull(), call)


def norm_lower(col: Column | str) -> Column:
    """NFC then lower case: the comparison form of text and keywords."""
    return F.lower(normalize(col, "NFC"))


def py_norm_lower(s: str) -> str:
    """Driver-side twin of :func:`norm_lower` for dictionary words."""
    return unicodedata.normalize("NFC", s).lower()


def unicode_strip(col: Column | str) -> Column:
    """Strip leading/trailing whitespace as Python's ``str.strip()`` does.

    ``trim`` only removes ASCII spaces and would keep e.g. U+3000.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, _STRIP_RE, "")


def blank_to_null(col: Column | str) -> Column:
    c = unicode_strip(col)
    return F.when(F.length(c) > 0, c)


def match_text(title: Column | str, description: Column | str) -> Column:
    """Title, one space, description; NULL parts become ''."""
    t = F.col(title) if isinstance(title, str) else title
    d = F.col(description) if isinstance(description, str) else description
    return F.concat(F.coalesce(t, F.lit("")), F.lit(" "), F.coalesce(d, F.lit("")))


def injection_regex(phrases=K.INJECTION_PHRASES) -> str:
    return "(?iu)(" + "|".join(phrases) + ")"


def sanitise(col: Column | str, max_chars: int, phrases=K.INJECTION_PHRASES,
             placeholder: str = K.INJECTION_PLACEHOLDER) -> Column:
    """Scorer-input sanitiser, in order: NFC, control chars to space, runs of
    spaces to one, strip, whole-text placeholder on an injection phrase, cut
    to ``max_chars`` code points. NULL is treated as ''."""
    c = F.col(col) if isinstance(col, str) else col
    t = normalize(F.coalesce(c, F.lit("")), "NFC")
    t = F.regexp_replace(t, K.CONTROL_CHARS_CLASS, " ")
    t = F.regexp_replace(t, "  +", " ")
    t = unicode_strip(t)
    t = F.when(t.rlike(injection_regex(phrases)), F.lit(placeholder)).otherwise(t)
    return F.substring(t, 1, max_chars)


def html_escape(col: Column | str) -> Column:
    """Escape & < > " ' the way HTML template autoescaping does."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    c = F.replace(c, F.lit('"'), F.lit("&#34;"))
    return F.replace(c, F.lit("'"), F.lit("&#39;"))


def decode_entities(c: Column) -> Column:
    """Numeric and named (HTML 4) character references decoded, on the JVM.
    Texts without an ampersand skip the call."""
    decoded = F.call_function("reflect", F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4"), c)
    apos = F.replace(decoded, F.lit("&apos;"), F.lit("'"))
    return F.when(c.contains("&"), apos).otherwise(c)


def prompt_from_safe(safe_title: Column | str, safe_description: Column | str,
                     template: str = "Title: {title}\nSummary: {description}",
                     empty_description: str = K.EMPTY_DESCRIPTION_PLACEHOLDER) -> Column:
    """Prompt from already sanitised parts (pass column names of a staged
    projection so each sanitised text is computed once)."""
    t = F.col(safe_title) if isinstance(safe_title, str) else safe_title
    d = F.col(safe_description) if isinstance(safe_description, str) else safe_description
    d = F.when(F.length(d) > 0, d).otherwise(F.lit(empty_description))
    head, rest = template.split("{title}", 1)
    mid, tail = rest.split("{description}", 1)
    return F.concat(F.lit(head), t, F.lit(mid), d, F.lit(tail))


def prompt_text(title: Column | str, description: Column | str,
                template: str = "Title: {title}\nSummary: {description}",
                title_chars: int = K.SCORER_TITLE_CHARS,
                description_chars: int = K.SCORER_DESCRIPTION_CHARS,
                empty_description: str = K.EMPTY_DESCRIPTION_PLACEHOLDER) -> Column:
    """Scorer prompt: sanitised parts substituted into a template literally.

    The template is split around the two fields and joined with ``concat``,
    so braces or ``$`` inside the data are inert. In a hot path, stage the
    sanitised columns and use :func:`prompt_from_safe`."""
    return prompt_from_safe(sanitise(title, title_chars), sanitise(description, description_chars),
                            template, empty_description)
