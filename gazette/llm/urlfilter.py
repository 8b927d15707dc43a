"""URL filter: host and path rules and glob rules, all matched in one pass.

Every rule becomes a glob over the canonical form ``.host/path`` of a url, and
all globs are packed into multiword Shift-And masks: one bit a glob position,
64 to a word. A column of urls is read one character at a time; per character
two table look-ups and a shift advance every glob over every url.

Globs: ``?`` is one character other than ``/``, ``*`` any run without ``/``,
``**`` any run at all, ``\\`` takes the next character as it is.

Null urls, and urls without ``://``, have an empty host and path: no rule fits
them and the globs see an empty string. Repeated rows are judged alike, extra
columns stay, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, UPPER, free_name

ONE, RUN, ANY = object(), object(), object()


@dataclass(frozen=True)
class Rule:
    """``name`` is ``host`` + path, as in ``example.org/es/``."""
    name: str
    verdict: str

    @property
    def glob(self) -> str:
        host, slash, path = self.name.partition("/")
        return f"*.{quote(host)}{slash}{quote(path)}**"


# Rules of the production filter, and its globs for urls that no rule fits:
# hosts of spam, pharmacy, betting and adult sites.
RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)
BLOCK_GLOBS = ("*spam**", "*pills**", "*pharma**", "*bets**", "*casino**", "*poker**", "*adult**", "*porn**", "*xxx**")


def quote(s: str) -> str:
    return "".join("\\" + c if c in "\\*?" else c for c in s)


def parse_glob(glob: str) -> tuple[list, dict]:
    """Its single-character steps, and the run (RUN or ANY) after each step
    (0: before the first)."""
    steps, runs, i = [], {}, 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            wide = glob[i:i + 2] == "**"
            i += 1 + wide
            if wide or len(steps) not in runs:
                runs[len(steps)] = ANY if wide else RUN
            continue
        if c == "\\" and i + 1 < len(glob):
            i += 1
            c = glob[i]
        elif c == "?":
            c = ONE
        steps.append(c)
        i += 1
    return steps, runs


class GlobAutomaton:
    """All globs as one nondeterministic automaton in bit masks."""

    def __init__(self, globs: list[str]):
        parsed = [parse_glob(g) for g in globs]
        letters = sorted({c for steps, _ in parsed for c in steps if isinstance(c, str)} | {"/"})
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        n_class = len(letters) + 1  # the last class: any other character
        size = sum(len(steps) + 1 for steps, _ in parsed)
        self.words = max(1, -(-size // 64))
        self.start = np.zeros(self.words, np.uint64)
        self.step = np.zeros((n_class, self.words), np.uint64)  # states entered by a character
        self.stay = np.zeros((n_class, self.words), np.uint64)  # states kept by it
        self.final = []
        slash, at = letters.index("/"), 0
        for steps, runs in parsed:
            self._set(self.start, at)
            for i in range(len(steps) + 1):
                for k in range(n_class):
                    if i and (k != slash if steps[i - 1] is ONE else k < len(letters) and letters[k] == steps[i - 1]):
                        self._set(self.step[k], at + i)
                    if i in runs and (k != slash or runs[i] is ANY):
                        self._set(self.stay[k], at + i)
            self.final.append(at + len(steps))
            at += len(steps) + 1

    @staticmethod
    def _set(mask, bit):
        mask[bit // 64] |= np.uint64(1 << (bit % 64))

    def match(self, texts: list[str]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        n = len(texts)
        lens = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-lens, kind="stable")  # the texts still being read are the first ones
        codes = np.frombuffer("".join([texts[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        kind = np.where(self.letters[place] == codes, place, len(self.letters)).astype(np.int32)
        lens = lens[order]
        begin = np.cumsum(lens) - lens
        state = np.tile(self.start, (n, 1))
        top, one = np.uint64(63), np.uint64(1)
        live = n
        for j in range(int(lens[0]) if n else 0):
            while live and lens[live - 1] <= j:
                live -= 1
            k, now = kind[begin[:live] + j], state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[k]) | (now & self.stay[k])
        out = np.zeros((n, len(self.final)), bool)
        for g, bit in enumerate(self.final):
            out[order, g] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one
        return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_filter(pages: DataFrame, url: str = "url", rules: tuple = RULES, block_globs: tuple = BLOCK_GLOBS) -> DataFrame:
    """``pages`` with host, path, rule and verdict (replacing columns so named).

    The longest fitting rule decides (of equally long ones a blocking one,
    then the first by name). Without a rule any of the globs blocks, else the
    url is allowed."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    globs = [r.glob for r in ranked] + list(block_globs)
    names, verdicts, n_rules = [r.name for r in ranked], [r.verdict for r in ranked], len(ranked)

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = GlobAutomaton(globs)
        for canonical in batches:
            hit = automaton.match(canonical.tolist())
            by_rule = hit[:, :n_rules]
            first = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1) if n_rules else 0, -1)
            blocked = hit[:, n_rules:].any(axis=1)
            yield pd.DataFrame({
                "rule": pd.Series([names[i] if i >= 0 else None for i in first], dtype=object),
                "verdict": [verdicts[i] if i >= 0 else "block" if b else "allow" for i, b in zip(first, blocked)],
            })

    given = pages[url]
    host, path = host_of(given), path_of(given)
    judged = judge(F.concat(F.lit("."), host, path))
    kept = [pages[f"`{c}`"] for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    own = free_name(pages, "judged")[0]
    out = pages.select(*kept, host.alias("host"), path.alias("path"), judged.alias(own))
    return out.withColumns({"rule": out[f"{own}.rule"], "verdict": out[f"{own}.verdict"]}).drop(own)
