"""Explicit schemas of the corpus tables and of every input file."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STRING, TIMESTAMP, BOOLEAN = T.StringType(), T.TimestampType(), T.BooleanType()

ASSERTIONS = _struct(
    id=STRING,
    type=STRING,
    created=TIMESTAMP,
    updated=TIMESTAMP,
    activity_id=STRING,
    repository_id=STRING,
    publisher_id=STRING,
    journal_id=STRING,
    source_type=STRING,
    title=STRING,
    obj_id=STRING,
    subj_id=STRING,
    published_date=STRING,
    accession_number=STRING,
    doi=STRING,
    relation_type_id=STRING,
    source_id=STRING,
    not_found=BOOLEAN,
    retried=BOOLEAN,
)

NAMED = _struct(id=STRING, title=STRING, external_id=STRING)
SOURCES = _struct(id=STRING, abbreviation=STRING, title=STRING)
SUBJECTS = _struct(id=STRING, title=STRING, type=STRING, created=TIMESTAMP, updated=TIMESTAMP)
ORGANISATIONS = _struct(
    id=STRING,
    title=STRING,
    external_id=STRING,
    ror_id=STRING,
    ror_name=STRING,
    type=STRING,
    created=TIMESTAMP,
)
ASSERTIONS_SUBJECTS = _struct(
    id=STRING,
    type=STRING,
    created=TIMESTAMP,
    updated=TIMESTAMP,
    assertion_id=STRING,
    subject_id=STRING,
    inferred=BOOLEAN,
)
ASSERTIONS_AFFILIATIONS = _struct(id=STRING, assertion_id=STRING, affiliation_id=STRING, type=STRING)
ASSERTIONS_FUNDERS = _struct(assertion_id=STRING, funder_id=STRING)

CORPUS = {
    "assertions": ASSERTIONS,
    "repositories": NAMED,
    "publishers": NAMED,
    "journals": NAMED,
    "sources": SOURCES,
    "subjects": SUBJECTS,
    "affiliations": ORGANISATIONS,
    "funders": ORGANISATIONS,
    "assertions_subjects": ASSERTIONS_SUBJECTS,
    "assertions_affiliations": ASSERTIONS_AFFILIATIONS,
    "assertions_funders": ASSERTIONS_FUNDERS,
}

# Bibliographic record as found in the JSON lines.  `container-title` is a list in some records
# and a plain string in others, and dates come in odd shapes; read as strings, Spark hands back
# the raw JSON text and no field can spoil its record.
PAPER_RECORD = T.StructType(
    [
        T.StructField("DOI", STRING),
        T.StructField("container-title", STRING),
        T.StructField("publisher", STRING),
        T.StructField("published", STRING),
    ]
)
PAPERS = _struct(doi=STRING, journal=STRING, publisher=STRING, published_date=STRING)

LOOKUP_CACHE = _struct(pmcid=STRING, doi_url=STRING)

REGISTRY = _struct(
    ror_id=STRING,
    name=STRING,
    aliases=T.ArrayType(STRING),
    external_ids=T.ArrayType(STRING),
)

TITLED = _struct(title=STRING, external_id=STRING)
ORGANISATION_REF = _struct(title=STRING, external_id=STRING, ror_name=STRING, ror_id=STRING)

# One record of the JSON dump.
DETAILS = _struct(
    id=STRING,
    created=TIMESTAMP,
    updated=TIMESTAMP,
    repository=TITLED,
    publisher=TITLED,
    journal=TITLED,
    title=STRING,
    dataset=STRING,
    publication=STRING,
    publishedDate=STRING,
    source=STRING,
    affiliations=T.ArrayType(ORGANISATION_REF),
    funders=T.ArrayType(ORGANISATION_REF),
    subjects=T.ArrayType(STRING),
)
