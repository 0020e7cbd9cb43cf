"""Fields of a bibliographic record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once a row, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def journal_name(container_title: Column) -> Column:
    """First entry of a title list, or the plain title; empty when there is neither.

    A list arrives as raw JSON text; a plain title that only looks like one fails to parse and is
    kept as it is.
    """

    def first_entry(entries: Column) -> Column:
        return F.when(entries.isNotNull(), F.coalesce(F.get(entries, F.lit(0)), F.lit("")))

    listed = once(F.from_json(container_title, "array<string>"), first_entry)
    return F.coalesce(F.when(container_title.startswith("["), listed), container_title, F.lit(""))


def publication_date(published: Column, compat: bool = False) -> Column:
    """``date-time`` if given, else ``Y-MM-DD``, ``Y-MM`` or ``Y`` from ``date-parts``, else empty.

    ``published`` is raw JSON text.  Numbers may be written as text; what is no date object, or a
    part that is no number and those after it, is left out.  ``compat`` prints ``None`` for a null
    year.
    """

    def two_digits(part: Column) -> Column:
        return once(part.try_cast("int"), lambda number: F.when(number.isNotNull(), F.format_string("%02d", number)))

    def joined(parts: Column) -> Column:
        year = F.coalesce(F.get(parts, F.lit(0)), F.lit("None" if compat else ""))
        month, day = (two_digits(F.get(parts, F.lit(place))) for place in (1, 2))
        after = once(month, lambda m: F.when(m.isNotNull(), F.concat_ws("-", m, day)))
        dated = once(year, lambda y: F.when(y != "", F.concat_ws("-", y, after)))
        return F.when(F.coalesce(F.size(parts), F.lit(0)) > 0, dated)

    def date(fields: Column) -> Column:
        moment = fields["date-time"]
        first = once(F.from_json(fields["date-parts"], "array<string>"), lambda lists: F.get(lists, F.lit(0)))
        return F.when(moment != "", moment).otherwise(once(F.from_json(first, "array<string>"), joined))

    return F.coalesce(once(F.from_json(published, "`date-time` string, `date-parts` string"), date), F.lit(""))


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
