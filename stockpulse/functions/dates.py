"""Dates: literals, text dates by their shape (N4) and the US week number."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: month names, as the source engine reads them (full or three letters).
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
#: Two-digit years up to this one belong to this century.
LAST_SHORT_YEAR = 49

# a time of day behind the date: clock, fraction, AM/PM, offset
_TIME = (r"[T ]\s*(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:[.:]\d{1,7})?)?\s*(?:[AaPp][Mm])?"
         r"\s*(?:Z|[+-]\d{2}:\d{2})?$")
_YEAR, _NAME = r"(\d{4}|\d{2})", r"([A-Za-z]{3,9})"
#: Shapes of a date, and its year, month and day by capture group.  No text has two.
_SHAPES = (
    (r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})$", "134"),              # 2026-01-15, 2026/1/5
    (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2{_YEAR}$", "413"),          # 1/15/2026, 01-15-26
    (rf"^{_YEAR}(\d{{2}})(\d{{2}})$", "123"),                       # 20260115
)
_NAMED = (
    (rf"^(\d{{1,2}})[ -]*{_NAME}\.?[ ,-]*{_YEAR}$", "321"),         # 15 Jan 2026, 15-Jan-2026
    (rf"^{_NAME}\.?[ -]*(\d{{1,2}})[ ,-]+{_YEAR}$", "312"),         # January 15, 2026
    (rf"^(\d{{4}})[ -]*{_NAME}\.?[ -]*(\d{{1,2}})$", "123"),       # 2026 Jan 15
)
_MARK = "\x01"


def ts_lit(value: dt.datetime) -> Column:
    """Timestamp literal without time zone (source timestamps are NTZ)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def date_lit(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def try_date(c: Column, formats: tuple[str, ...] = ()) -> Column:
    """The date that a text states in one of the known shapes, with or without a
    time of day behind it, else NULL (TRY_CAST(text AS date)).

    The shape picks the one reading, so ``1/2/2026`` is 2 January; a day that the
    calendar does not have is NULL.  ``formats`` are further date patterns."""
    def parts_of(t: Column) -> Column:
        """[year, month, day] of a text in one of the shapes; of others the text as it is."""
        def marked(shapes: tuple[tuple[str, str], ...]) -> Column:
            out = t
            for pattern, (y, m, d) in shapes:
                out = F.regexp_replace(out, pattern, f"${y}{_MARK}${m}{_MARK}${d}")
            return out
        return F.split(F.when(t.rlike("[A-Za-z]"), marked(_NAMED)).otherwise(marked(_SHAPES)), _MARK)

    def day_of(parts: Column) -> Column:
        year, month, day = (F.get(parts, F.lit(i)) for i in range(3))
        century = F.when(F.length(year) == 4, "").when(year <= str(LAST_SHORT_YEAR), "20").otherwise("19")
        # a name is found among the full or the three-letter ones; digits are found in neither
        number = F.greatest(*[F.array_position(F.lit(list(names)), F.lower(month))
                              for names in (MONTHS, [m[:3] for m in MONTHS])])
        month = F.when(number > 0, number.cast("string")).otherwise(month)
        iso = F.concat(century, year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))
        return F.try_to_date(F.when(iso >= "0001", iso), "yyyy-MM-dd")

    # a one-element array hands a value on by name, so that finding it is stated once
    text = F.array(F.regexp_replace(F.trim(c), _TIME, ""))
    read = F.get(F.transform(F.transform(text, parts_of), day_of), F.lit(0))
    return F.coalesce(read, *[F.try_to_date(F.trim(c), f) for f in formats]) if formats else read


def us_week(d: Column) -> Column:
    """DATEPART(WEEK, d): week 1 contains Jan 1, weeks start on Sunday."""
    jan1 = F.trunc(d, "year")
    return F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7).cast("int") + 1
