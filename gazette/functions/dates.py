"""Date functions: era dates, dates in listing rows, lenient API dates, feed
dates, and the labels the reports print."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .. import constants as K
from .text import normalize


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def ts_lit(ts: _dt.datetime) -> Column:
    """Timestamp literal read in the session time zone (a naive Python datetime
    given to ``lit`` would be converted with the Python process's zone)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def try_int(col: Column) -> Column:
    """String digits to INT, NULL when not a number or out of range."""
    return col.try_cast("long")


def ymd_date(y: Column, m: Column, d: Column) -> Column:
    """Calendar date from parts; NULL for an impossible date (no exception)."""
    ok = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    txt = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m.cast("string"), d.cast("string"))
    return F.when(ok, txt.try_cast("date"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it
    (merged projections would repeat its expression)."""
    return F.get(F.transform(F.array(value), body), 0)


def era_date(text: Column | str, eras=K.ERA_OFFSETS) -> Column:
    """First '<era><y>年<m>月<d>日' in the text (after NFKC, so full-width
    digits count) as a date; NULL if none or impossible. '元年' is not matched."""
    names = "|".join(name for name, _ in eras)
    found = F.regexp_substr(normalize(_c(text), "NFKC"), F.lit(rf"({names})(\d+)年(\d+)月(\d+)日"))

    def date(s: Column) -> Column:
        numbers = F.split(F.regexp_replace(s, r"\D+", " "), " ")  # before the first one stands the era
        offset = F.lit(None).cast("long")
        for name, off in reversed(eras):
            offset = F.when(s.startswith(name), F.lit(off)).otherwise(offset)
        return let(numbers, lambda n: ymd_date(offset + try_int(n[1]), try_int(n[2]), try_int(n[3])))

    return let(found, date)


def row_dates(text: Column | str, pattern: str = K.ROW_DATE_PATTERN) -> Column:
    """Array of the date-like strings in a row's text (Unicode digits count)."""
    return F.regexp_extract_all(_c(text), F.lit("(?U)" + pattern), 0)


FULL_WIDTH, DIGITS = "０１２３４５６７８９", "0123456789"
# English month names, in order.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def row_date_value(s: Column) -> Column:
    """A matched row-date string to a date. 'y/m/d' and 'y-m-d' parse, with
    full-width digits too; the '年/月' form is matched but gives NULL (the
    lenient parser rejects it)."""
    plain = F.translate(s, "/" + FULL_WIDTH, "-" + DIGITS)
    return let(plain, lambda x: F.when(x.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & ~x.startswith("0000"), x.try_cast("date")))


# Each full date has one of these shapes; its groups are the year, the month
# (a number or a name) and the day, in any order. A weekday or other word may
# stand before those that begin with a month's name or a day.
_WORD_BEFORE, _NAME, _DAY, _SEP = r"(?:[A-Za-z]{3,9}\.?,?\s+)?", r"([A-Za-z]{3,9})", r"(\d{1,2})(?:st|nd|rd|th)?", r"[\s/.-]+"
SHAPES = (
    r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})",
    r"(\d{4})(\d{2})(\d{2})(?:\d{4}|\d{6})?",
    rf"(\d{{4}}){_SEP}{_NAME}\.?{_SEP}{_DAY}",
    rf"{_WORD_BEFORE}{_NAME}\.?\s+{_DAY},?\s+(\d{{4}})",
    rf"{_WORD_BEFORE}{_DAY}(?:\s+of)?{_SEP}{_NAME}\.?,?{_SEP}(\d{{4}})",
    r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})",
)
ANY_SHAPE = r"^(?:" + "|".join(SHAPES) + r")(?:[T ,].*)?$"
# What a string of any shape becomes: year, month or its name, day, and the two
# numbers before the year of the last shape. Groups of other shapes are empty.
PARTS = "\u0001$1$4$7$12$15$18 $2$5$8$10$14 $3$6$9$11$13 $16 $17"


def month_number(name: Column) -> Column:
    """The number of a month given as a number or by its English name or the
    first three letters or more; else NULL."""
    known, full = F.lit("".join(m[:3] for m in MONTHS)), F.array(*[F.lit(m) for m in MONTHS])

    def named(low: Column) -> Column:
        nth = (F.instr(known, F.left(low, F.lit(3))) + 2) / 3
        whole = (F.length(low) >= 3) & (nth >= 1) & (nth == F.floor(nth))
        return F.when(whole & F.startswith(F.get(full, (nth - 1).cast("int")), low), nth.cast("int"))

    return F.coalesce(name.try_cast("int"), let(F.lower(name), named))


def lenient_date(value: Column | str) -> Column:
    """Date from a loosely formatted API value; NULL when empty or unreadable.

    The string is matched once, against all ``SHAPES``; which of them it has
    tells where its year, month and day are. The calendar day written there is
    kept: a time of day and any zone suffix are dropped, never applied
    ('…T15:00:00.000Z' stays on its day). In 'a/b/yyyy' a is the month if it can
    be one. Not accepted: a lone day number, two-digit years, dates without a
    year or (other than in the reference, which takes today's) without a day,
    and other languages' months."""
    s = F.translate(F.trim(_c(value).cast("string")), FULL_WIDTH, DIGITS)

    def date(p: Column) -> Column:
        y, m, d, a, b = (p[i] for i in range(5))
        swap = try_int(a) > 12
        month = F.when(m != "", month_number(m)).otherwise(F.when(swap, b).otherwise(a))
        day = F.when(d != "", d).otherwise(F.when(swap, a).otherwise(b))
        return F.when(F.startswith(y, F.lit("\u0001")) & (y != "\u00010000"), F.concat(F.substring(y, 2, 4), F.lit("-"), month, F.lit("-"), day).try_cast("date"))

    return let(F.split(F.regexp_replace(s, ANY_SHAPE, PARTS), " "), date)


def feed_timestamp(value: Column | str) -> Column:
    """Feed timestamp (RFC 822 or ISO 8601) as an instant; NULL if unreadable.

    The weekday prefix of RFC 822 is dropped first: it cannot be parsed."""
    s = F.trim(_c(value))
    rfc = F.regexp_replace(s, r"^[A-Za-z]{3},\s*", "")
    rfc = F.regexp_replace(rfc, r"\s+", " ")
    return F.coalesce(
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm z")),
        F.try_to_timestamp(s),
    )


def feed_date(published: Column | str, updated: Column | str) -> Column:
    """Published, else updated, as a UTC calendar date (session zone is UTC)."""
    return F.coalesce(F.to_date(feed_timestamp(published)), F.to_date(feed_timestamp(updated)))


def month_label(d: Column | str) -> Column:
    return F.coalesce(F.date_format(_c(d), K.MONTH_LABEL_FORMAT), F.lit(K.MONTH_UNKNOWN_LABEL))


def date_or_dash(d: Column | str) -> Column:
    return F.coalesce(F.date_format(_c(d), "yyyy-MM-dd"), F.lit(K.DATE_DASH))


def run_stamp(ts: Column | str) -> Column:
    return F.date_format(_c(ts), K.RUN_STAMP_FORMAT)


def deadline_badge(deadline: Column | str, as_of: _dt.date) -> Column:
    """Badge text from the days left until the deadline; NULL without one."""
    dl = _c(deadline)
    days = F.datediff(dl, F.lit(as_of))
    return (F.when(dl.isNull(), F.lit(None).cast("string"))
            .when(days < 0, F.lit(K.BADGE_EXPIRED))
            .when(days == 0, F.lit(K.BADGE_TODAY))
            .when(days <= K.BADGE_SOON_DAYS,
                  F.concat(F.lit(K.BADGE_DAYS_PREFIX), days.cast("string"), F.lit(K.BADGE_DAYS_SUFFIX)))
            .otherwise(F.concat(F.date_format(dl, K.BADGE_DATE_FORMAT), F.lit(K.BADGE_DATE_SUFFIX))))


def score_band(score: Column | str) -> Column:
    s = _c(score)
    return (F.when(s.isNull(), F.lit("none"))
            .when(s >= K.SCORE_BAND_HIGH, F.lit("high"))
            .when(s >= K.SCORE_BAND_MID, F.lit("mid"))
            .otherwise(F.lit("low")))
