"""Identifier normalisation: DOIs, organisation ids, accession numbers, generated ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import rules

DOI_URL = "https://doi.org/"
ROR_URL = "https://ror.org/"
GRID_URL = "https://www.grid.ac/"
ISNI_HOST = "http://isni.org"
ISNI_URL = "http://isni.org/isni/"

UUID_PATTERN = r"^(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"


# Every character that counts as a blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove blanks of any kind, Unicode ones included, from both ends."""
    return F.btrim(value, F.lit(BLANKS))


def add_prefix_by_start(value: Column, prefixes: Sequence[tuple[str, str]]) -> Column:
    """Put a prefix before values with a given start; the first start that fits decides."""
    result = value
    for start, prefix in reversed(prefixes):
        result = F.when(value.startswith(start), F.concat(F.lit(prefix), value)).otherwise(result)
    return result


def normalize_doi(value: Column) -> Column:
    """Bring the common spellings of a DOI into URL form; anything else is only stripped.

    Null and the empty string give null.
    """
    spellings = [
        (DOI_URL, ""),
        ("doi.org/", "https://"),
        ("10.", DOI_URL),
        ("//", "https:"),
    ]
    return F.when(value != "", add_prefix_by_start(strip(value), spellings))


def doi_to_url(value: Column) -> Column:
    """URL form of a bare DOI; other text unchanged."""
    return add_prefix_by_start(value, [("10.", DOI_URL)])


def doi_key(value: Column) -> Column:
    """Case-folded DOI without the resolver prefix, for comparing spellings."""
    return F.regexp_replace(F.lower(value), r"^https://doi\.org/", "")


def normalize_external_id(value: Column, compat: bool = False) -> Column:
    """URL form of an organisation id (ROR, GRID, ISNI, funder DOI); other ids are only stripped.

    The first rule that fits decides; an id starting ``0000`` is an ISNI, even where it has the
    form of a ROR id.  ``compat`` inserts the ISNI path even where it is already present.
    """

    def by_first_rule(text: Column) -> Column:
        old_isni = text.startswith(ISNI_HOST)
        if not compat:
            old_isni = old_isni & ~text.startswith(ISNI_URL)
        return (
            F.when(text.startswith(ROR_URL) | text.startswith(DOI_URL), text)
            .when(text.startswith("grid."), F.concat(F.lit(GRID_URL), text))
            .when(text.startswith("0000"), F.concat(F.lit(ISNI_URL), F.replace(text, F.lit(" "), F.lit(""))))
            .when(text.startswith("10."), F.concat(F.lit(DOI_URL), text))
            .when(text.rlike(r"^0[a-zA-Z0-9]{6}[0-9]{2}\z"), F.concat(F.lit(ROR_URL), text))
            .when(old_isni, F.concat(F.lit(ISNI_HOST + "/isni"), F.substring(text, len(ISNI_HOST) + 1, 2**31 - 1)))
            .otherwise(text)
        )

    # the stripped text is named once: written out in every rule it would outgrow a compiled method
    return F.get(F.transform(F.array(strip(value)), by_first_rule), F.lit(0))


def last_segment(value: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(value, "/", -1)


def external_id_search_key(value: Column) -> Column:
    """What a registry lists for a normalised id: the last part of an id URL, else the text."""
    return F.regexp_replace(value, r"(?s)^(?=https://www\.grid\.ac|http://isni\.org/isni|https://doi\.org).*/", "")


def with_pmc_prefix(value: Column) -> Column:
    return F.when(value.startswith("PMC"), value).otherwise(F.concat(F.lit("PMC"), value))


def is_uuid(value: Column) -> Column:
    return value.rlike(UUID_PATTERN)


def derived_id(*key: Column) -> Column:
    """UUID-shaped id made from the natural key, so a retried task makes the same one."""
    parts = [F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit("-")) for part in key]
    digest = F.md5(F.concat_ws("\u001f", *parts))
    return F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def accession_patterns(compat: bool = False) -> dict[str, str]:
    """Pattern per repository; ``compat`` brings back the doubled backslashes of some of them."""
    if not compat:
        return dict(rules.ACCESSION_PATTERNS)
    doubled = set(rules.DOUBLED_BACKSLASH_REPOSITORIES)
    return {
        repository: pattern.replace("\\", "\\\\") if repository in doubled else pattern
        for repository, pattern in rules.ACCESSION_PATTERNS.items()
    }


def accession_matches(repository: Column, accession: Column, patterns: Mapping[str, str]) -> Column:
    """Does the accession number fit its repository's pattern (null: no pattern or no number).

    Literal patterns in a ``when`` chain stay compiled; a pattern column would recompile whenever
    the repository changes.  ``^(?:…)`` anchors every alternative at the start.
    """
    result = F.lit(None).cast("boolean")
    for repository_id, pattern in patterns.items():
        result = F.when(repository == repository_id, accession.rlike(f"^(?:{pattern})")).otherwise(result)
    return result
