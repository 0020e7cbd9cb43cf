"""Clean-up of organisation titles, one expression per step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define what is removed.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
STRICT_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CONTACT_LABELS = "E‐mail:|Electronic address:|E-mail: |Electronic address|E-mail"
EDGE_CHARACTERS = r"[.,*;:\s]+"

# Accepts a title made only of @handles, in linear time.
HANDLES_ONLY = r"^@\S+(?:\s+(?:[/.-]\s*)?@\S+)*\z"

LEADING = "^" + EDGE_CHARACTERS
# The look-behind lets a match start only at the beginning of a run, so a long run of blanks
# inside a text is scanned once and not once per blank.
TRAILING = r"(?<![.,*;:\s])" + EDGE_CHARACTERS + r"\z"


def is_handles_only(title: Column) -> Column:
    return title.rlike(HANDLES_ONLY)


def remove_emails(title: Column) -> Column:
    return F.when(title.contains("@"), F.regexp_replace(title, EMAIL, "")).otherwise(title)


def remove_contact_labels(title: Column) -> Column:
    return F.regexp_replace(title, CONTACT_LABELS, "")


def trim_ends(title: Column, compat: bool = False) -> Column:
    """Trim spaces, then newlines.

    ``compat`` trims the two characters backslash and n instead of newlines.
    """
    return F.btrim(F.trim(title), F.lit("\\n" if compat else "\n"))


def single_spaced(title: Column) -> Column:
    return F.regexp_replace(title, r"\s+", " ")


def _strip_leading(title: Column) -> Column:
    return F.regexp_replace(title, LEADING, "")


def _strip_trailing(title: Column) -> Column:
    return F.regexp_replace(title, TRAILING, "")


def strip_one_end(title: Column, compat: bool = False) -> Column:
    """Trim, remove the leading run of special characters or, without one, the trailing run."""
    trimmed = trim_ends(title, compat)
    stripped = F.when(trimmed.rlike(LEADING), _strip_leading(trimmed)).otherwise(_strip_trailing(trimmed))
    return single_spaced(stripped)


def clean_remaining_email_titles(title: Column, compat: bool = False) -> Column:
    """Titles that still hold an e-mail address are stripped at one end."""
    return F.when(title.rlike(STRICT_EMAIL), strip_one_end(title, compat)).otherwise(title)


def clean_trailing(title: Column, compat: bool = False) -> Column:
    cleaned = single_spaced(_strip_trailing(trim_ends(title, compat)))
    return F.when(title.rlike(TRAILING), cleaned).otherwise(title)


def clean_leading(title: Column) -> Column:
    return F.when(title.rlike(LEADING), single_spaced(_strip_leading(title))).otherwise(title)


def clean_either_end(title: Column, compat: bool = False) -> Column:
    has_edge = title.rlike(LEADING) | title.rlike(TRAILING)
    return F.when(has_edge, strip_one_end(title, compat)).otherwise(title)


def unwrap_parentheses(title: Column) -> Column:
    return F.regexp_replace(title, r"(?s)^\((.*)\)\z", "$1")


def fix_separator(value: Column) -> Column:
    """No blank before the semicolon of a joined list."""
    return F.replace(value, F.lit(" ;"), F.lit(";"))


def name_key(title: Column) -> Column:
    """Organisation name reduced to lower-case words, for exact matching; null when none remain."""
    words = F.trim(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", " "))
    return F.when(words != "", words)
