"""Row filters and text helpers shared by the reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulmark.constants import PICKUP_DAYS


def not_deleted(flag: Column | str = "is_deleted") -> Column:
    """NULL and false both mean the row is live."""
    col = F.col(flag) if isinstance(flag, str) else flag
    return ~F.coalesce(col, F.lit(False))


def ci(value: Column) -> Column:
    """Comparison form of a code: case and trailing blanks do not matter."""
    return F.upper(F.rtrim(value))


def code_list(values: str | Iterable | None) -> list[str] | None:
    """A comma list (or any iterable) as trimmed codes; NULL or ALL is no filter."""
    if values is None:
        return None
    parts = values.split(",") if isinstance(values, str) else values
    codes = [str(p).strip() for p in parts if str(p).strip()]
    return None if [c.upper() for c in codes] == ["ALL"] else codes


def id_list(values: str | int | Iterable | None) -> list[int] | None:
    codes = code_list([values] if isinstance(values, int) else values)
    return None if codes is None else [int(c) for c in codes]


def optional_in(value: Column, wanted: list | None) -> Column:
    """Membership, or everything (NULL too) when no list was given."""
    if wanted is None:
        return F.lit(True)
    if wanted and isinstance(wanted[0], str):
        return ci(value).isin([w.upper().rstrip() for w in wanted])
    return value.isin(wanted)


def _as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def in_dates(value: Column | str, start, end) -> Column:
    """Inclusive window on the date part, written so the scan can use it."""
    col = F.col(value) if isinstance(value, str) else value
    return (col >= _as_date(start)) & (col < F.date_add(_as_date(end), 1))


def switch_filter(value: Column, wanted: str | None) -> Column:
    """Equality when a value is given; otherwise every row whose column is set."""
    return value.isNotNull() if wanted is None else ci(value) == wanted.upper().rstrip()


def contains_text(value: Column, part: str | None) -> Column:
    """Case-insensitive contains search; an empty search keeps every row."""
    if not part:
        return F.lit(True)
    return F.contains(F.upper(value), F.lit(part.upper()))


def date_of(text: Column) -> Column:
    """The date that a text states as ISO, ``M/d/yyyy`` or ``yyyyMMdd``; NULL for any other text."""
    trimmed = F.trim(text)
    return F.coalesce(F.try_to_date(trimmed), F.try_to_date(trimmed, "M/d/yyyy"), F.try_to_date(trimmed, "yyyyMMdd"))


def is_date(text: Column) -> Column:
    return date_of(text).isNotNull()


def protection_matches(temperature: Column, protection: Column, dry: int = 3) -> Column:
    """Dry freight needs a dry or unstated protection; other freight takes any."""
    return F.when(
        temperature == dry, F.coalesce(protection == "Dry", F.lit(True))
    ).otherwise(F.lit(True))


def positive_key(value: Column) -> Column:
    return (F.trim(value.cast("string")) != "") & (value > 0)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, so 00:00:59 to 00:31:00 counts 31.

    Counted from days, hours and minutes, so no time zone enters.
    """
    def of_day(c: Column) -> Column:
        return F.hour(c) * 60 + F.minute(c)

    return (F.datediff(end, start) * 1440 + of_day(end) - of_day(start)).cast("bigint")


def moment(value) -> Column:
    """A fixed point in time, free of any time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def dollars(rate: Column) -> Column:
    return F.concat(F.lit("$"), rate.cast("decimal(18,3)").cast("string"))


def short_date(value: Column) -> Column:
    return F.date_format(value, "MM/dd/yy")


def pickup_day_name(day: Column) -> Column:
    """0 = Monday; anything else than 0-6 has no name."""
    names = F
    for number, name in enumerate(PICKUP_DAYS):
        names = names.when(day == number, name)
    return names


def pickup_day_number(day: Column) -> Column:
    """1 = Monday, from 0 = Monday."""
    return F.when(day.between(0, len(PICKUP_DAYS) - 1), day + 1)
