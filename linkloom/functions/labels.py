"""Nested objects of the dump and their flat text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "; "


def titled(title: Column, external_id: Column) -> Column:
    return F.struct(title.alias("title"), external_id.alias("external_id"))


def titled_or_null(title: Column, external_id: Column) -> Column:
    """Object with title and external id; null (an empty object in the dump) when both are."""
    return F.when(title.isNotNull() | external_id.isNotNull(), titled(title, external_id))


def organisation(title: Column, external_id: Column, ror_name: Column, ror_id: Column) -> Column:
    return F.struct(
        title.alias("title"),
        external_id.alias("external_id"),
        ror_name.alias("ror_name"),
        ror_id.alias("ror_id"),
    )


def _text(value: Column, compat: bool) -> Column:
    return F.coalesce(value, F.lit("None" if compat else ""))


def object_label(ref: Column, compat: bool = False) -> Column:
    """``title external_id``, or the title alone when there is no id.

    ``compat`` prints ``None`` for a null title that has an id.
    """
    title, external_id = ref["title"], ref["external_id"]
    both = F.concat_ws(" ", _text(title, True), external_id) if compat else F.concat_ws(" ", title, external_id)
    return F.when(external_id != "", both).otherwise(F.coalesce(title, F.lit("")))


def organisation_label(ref: Column, compat: bool = False) -> Column:
    title, external_id = ref["title"], ref["external_id"]
    suffix = F.when(external_id != "", F.concat(F.lit(" "), external_id)).otherwise(F.lit(""))
    label = F.concat(_text(title, compat), suffix)
    return label if compat else F.ltrim(label)


def ror_label(ref: Column, compat: bool = False) -> Column:
    """``ror_name ror_id``; ``compat`` prints ``None`` for each null."""
    return F.trim(F.concat_ws(" ", _text(ref["ror_name"], compat), _text(ref["ror_id"], compat)))


def joined(values: Column) -> Column:
    return F.array_join(values, SEPARATOR)
