"""Column expressions for dates, texts, numbers, JSON and arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---- dates -------------------------------------------------------------------------------


def build_timestamp(year: Column, month: Column, day: Column, time: Column) -> Column:
    """Timestamp from its parts (time as ``HH:mm`` or ``HH:mm:ss`` text); null when unreadable."""
    text = F.concat_ws(" ", F.concat_ws("-", year, month, day), time)
    return text.try_cast("timestamp_ntz")


def month_of(ts: Column) -> Column:
    """First day of the month, the key of a calendar period."""
    return F.trunc(ts, "MM")


def day_of(ts: Column) -> Column:
    return F.dayofmonth(ts)


def nearest_due_date(day: Column, due_day: int = 4) -> Column:
    """The latest monthly due date on or before ``day``."""
    first = F.trunc(day, "MM")
    base = F.when(F.dayofmonth(day) >= due_day, first).otherwise(F.add_months(first, -1))
    return F.date_add(base, due_day - 1)


def days_since_due(day: Column, due_day: int = 4) -> Column:
    return F.date_diff(F.to_date(day), nearest_due_date(day, due_day))


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def text_to_local_time(
    text: Column, formats: Sequence[str], zone: str | None = None, source_zone: str = "UTC"
) -> Column:
    """First reading of ``text`` that fits one of ``formats``, as local time of ``zone``."""
    read = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])
    if zone is None:
        return read
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), read)


def on_days(ts: Column, first: Column, last: Column | None = None) -> Column:
    """``ts`` falls on the days ``first`` to ``last`` (default: ``first`` alone).

    A range on the bare column, which reaches the file scan where a test of ``to_date(ts)``
    would not.
    """
    end = F.date_add(F.to_date(first if last is None else last), 1)
    return (ts >= F.to_date(first)) & (ts < end)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def minutes_until(later: Column, earlier: Column, field_only: bool = False) -> Column:
    """Whole minutes from ``earlier`` to ``later``.

    ``field_only`` returns the minute field of the interval instead (65 minutes give 5).
    """
    interval = later - earlier
    if field_only:
        return F.extract(F.lit("MINUTE"), interval).cast("int")
    return F.timestamp_diff("MINUTE", earlier, later)


# ---- texts and numbers -------------------------------------------------------------------


def strip_prefixes(name: Column, prefixes: Sequence[str]) -> Column:
    """Name without any of the given texts (regular expressions)."""
    return F.regexp_replace(name, "|".join(prefixes), "")


def parse_number(text: Column) -> Column:
    """Number from text with thousands commas; ``-`` and unreadable text give null."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def fuzzy_ratio(a: Column, b: Column) -> Column:
    """Text similarity from 0 to 100: share of characters kept by the edit distance."""
    longest = F.greatest(F.length(a), F.length(b))
    ratio = F.try_divide(longest - F.levenshtein(a, b), longest) * 100
    return F.when(longest == 0, 100.0).otherwise(ratio)


def name_from_index(index: Column, names: Mapping[int, str]) -> Column:
    """Name of a class index; null for an index without a name."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), index)


# ---- JSON --------------------------------------------------------------------------------


def json_to_doubles(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def required_field(text: Column, schema: str, path: str) -> Column:
    """The field at ``path`` of a JSON document, null when the document lacks it."""
    return F.from_json(text, schema).getField(path)


# ---- arrays ------------------------------------------------------------------------------


def pad_right(values: Column, size: int) -> Column:
    """Array filled with zeros at its end up to ``size`` items."""
    missing = F.greatest(F.lit(0), F.lit(size) - F.size(values))
    return F.concat(values, F.array_repeat(F.lit(0.0), missing))


def add_arrays(a: Column, b: Column) -> Column:
    """Item-wise sum; a missing item counts as 0."""
    zero = F.lit(0.0)
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, zero) + F.coalesce(y, zero))
