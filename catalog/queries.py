"""Every registered query with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.derive import Tables, oracle
from linkloom import rules
from linkloom.corpus import Corpus
from linkloom.functions import titles
from linkloom.functions.identifiers import doi_key, external_id_search_key, normalize_external_id
from linkloom.operators.dedup import dedup_latest
from linkloom.operators import filters, integrity, updates
from linkloom.operators.joins import lookup_join
from linkloom.operators.nesting import expand_bridge, nest
from linkloom.operators.numbering import number_rows
from linkloom.plans import (
    accession,
    clean_orgs,
    compare,
    curate,
    details,
    export,
    ingest,
    live_summaries,
    paper_store,
    papers,
    reconcile,
    review,
    summaries,
    tag_subjects,
)
from linkloom.session import ensure_checkpoint_dir, stored
from linkloom.sinks import files
from linkloom.sinks.keyed_store import KeyedStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# the same queries as functions of the tables, for the benchmark
BUILDS: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# literal rules for the derived corpus
TRIALS = ["repo-1", "repo-2"]
EXCLUDED = ["repo-3", "repo-4"]
PATTERNS = {"repo-0": r"^GSE\d+$", "repo-3": r"^GSE[0-9]$", "repo-5": r"^(GSE1\d)|(AD [0-9]+)$"}
SUBJECT_RULES = {
    "repo-1": ["economy", "health biotechnology"],
    "repo-4": ["basic medicine", "large", "no such subject"],
    "repo-7": ["promo"],
}
NOW = "2025-09-01 00:00:00"


def register(name: str, sql: str | None):
    """Register a function of the tables under a name, with its SQL."""

    def wrap(build: Callable[[Tables], DataFrame]):
        BUILDS[name] = build
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return wrap


def corpus_of(t: Tables, named_ends: bool = False) -> Corpus:
    assertions = updates.add_dataset_publication(t.assertions) if named_ends else t.assertions
    return Corpus(
        assertions,
        t.repositories,
        t.publishers,
        t.journals,
        t.sources,
        t.subjects,
        t.affiliations,
        t.funders,
        t.assertions_subjects,
        t.assertions_affiliations,
        t.assertions_funders,
    )


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def flat(ref: Column, *names: str) -> Column:
    """Text form of a nested value: fields joined by a bar, nulls as a tilde."""
    return F.concat_ws("|", *[F.coalesce(ref[n], F.lit("~")) for n in names])


def flat_list(column: str, *names: str) -> Column:
    return F.array_join(F.array_sort(F.transform(column, lambda r: flat(r, *names))), "; ")


# --- SQL fragments used by several oracles ----------------------------------------------------

CITES = f"(relation_type_id is null or relation_type_id in ({sql_list(rules.CITATION_RELATIONS)}))"
NOT_TRIAL = f"(repository_id is null or repository_id not in ({sql_list(TRIALS)}))"

DEDUPED = f"""deduped as (
    select * exclude (rn) from (
        select *, row_number() over (partition by {", ".join(rules.DEDUP_KEYS)}
                                     order by updated desc nulls first, id) as rn
        from assertions) where rn = 1)"""

STAGES = f"""{DEDUPED},
    cited as (select * from deduped where {CITES}),
    untried as (select * from cited where {NOT_TRIAL}),
    final as (select * from untried where subj_id <> obj_id)"""

NAMED_ENDS = f"""named_ends as (
    select *, case when source_type is null or source_type = '{rules.SUBJECT_IS_DATASET_SOURCE}' then subj_id
                   when source_type = '{rules.OBJECT_IS_DATASET_SOURCE}' then obj_id end as dataset,
              case when source_type is null or source_type = '{rules.SUBJECT_IS_DATASET_SOURCE}' then obj_id
                   when source_type = '{rules.OBJECT_IS_DATASET_SOURCE}' then subj_id end as publication
    from assertions)"""


def norm_doi_sql(c: str) -> str:
    s = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    return f"""case when {c} is null or {c} = '' then null
        when starts_with({s}, 'https://doi.org/') then {s}
        when starts_with({s}, 'doi.org/') then 'https://' || {s}
        when starts_with({s}, '10.') then 'https://doi.org/' || {s}
        when starts_with({s}, '//') then 'https:' || {s} else {s} end"""


def norm_ext_sql(c: str) -> str:
    s = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    return f"""case when starts_with({s}, 'https://ror.org/') or starts_with({s}, 'https://doi.org/') then {s}
        when starts_with({s}, 'grid.') then 'https://www.grid.ac/' || {s}
        when starts_with({s}, '0000') then 'http://isni.org/isni/' || replace({s}, ' ', '')
        when starts_with({s}, '10.') then 'https://doi.org/' || {s}
        when regexp_matches({s}, '^0[a-zA-Z0-9]{{6}}[0-9]{{2}}$') then 'https://ror.org/' || {s}
        when starts_with({s}, 'http://isni.org') and not starts_with({s}, 'http://isni.org/isni/')
            then replace({s}, 'http://isni.org', 'http://isni.org/isni') else {s} end"""


def uuid_sql(*parts: str) -> str:
    text = ", ".join(f"coalesce('=' || {p}, '-')" for p in parts)
    return (
        f"regexp_replace(md5(concat_ws(chr(31), {text})), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
        r"'\1-\2-\3-\4-\5')"
    )


# --- details (D1, D2, J3-J6, A2, A3, U10, U11) --------------------------------------------------

ORG_FIELDS = ("title", "external_id", "ror_name", "ror_id")


def _org_text(alias: str, fields=ORG_FIELDS) -> str:
    return " || '|' || ".join(f"coalesce({alias}.{f}, '~')" for f in fields)


def _nested_sql(bridge: str, dim: str, fk: str, name: str, text: str, keep: str = "true") -> str:
    return f"""(select b.assertion_id, string_agg({text}, '; ' order by {text}) as {name}
        from {bridge} b join {dim} d on d.id = b.{fk} where {keep} group by b.assertion_id)"""


NAMED_KEEP = "(d.title is not null or d.external_id is not null)"
DETAILS_JOINS = """
    left join repositories r on r.id = a.repository_id
    left join publishers p on p.id = a.publisher_id
    left join journals j on j.id = a.journal_id
    left join sources s on s.id = a.source_id"""


def _ref(alias: str) -> str:
    return f"""case when {alias}.title is not null or {alias}.external_id is not null
        then coalesce({alias}.title, '~') || '|' || coalesce({alias}.external_id, '~') end"""


DETAILS_SQL = f"""with {NAMED_ENDS}
    select a.id, a.created, a.updated, {_ref("r")} as repository, {_ref("p")} as publisher,
           {_ref("j")} as journal, a.title, a.dataset, a.publication,
           a.published_date as published_date, s.abbreviation as source,
           coalesce(af.affiliations, '') as affiliations, coalesce(fu.funders, '') as funders,
           coalesce(su.subjects, '') as subjects
    from named_ends a {DETAILS_JOINS}
    left join {_nested_sql("assertions_affiliations", "affiliations", "affiliation_id", "affiliations",
                           _org_text("d"), NAMED_KEEP)} af on af.assertion_id = a.id
    left join {_nested_sql("assertions_funders", "funders", "funder_id", "funders",
                           _org_text("d"), NAMED_KEEP)} fu on fu.assertion_id = a.id
    left join {_nested_sql("assertions_subjects", "subjects", "subject_id", "subjects",
                           "d.title", "d.title is not null")} su on su.assertion_id = a.id"""


@register("details_formatted", DETAILS_SQL)
def _details_formatted(t):
    d = details.assertion_details_formatted(corpus_of(t, named_ends=True))
    refs = {c: F.when(F.col(c).isNotNull(), flat(F.col(c), "title", "external_id")) for c in ("repository", "publisher", "journal")}
    d = d.withColumns({**refs, "affiliations": flat_list("affiliations", *ORG_FIELDS), "funders": flat_list("funders", *ORG_FIELDS)})
    return d.withColumn("subjects", F.array_join(F.array_sort("subjects"), "; ")).withColumnRenamed("publishedDate", "published_date")


def _view_sql(funders_bridge: str, funders_fk: str) -> str:
    two = ("title", "external_id")
    ref = {x: f"case when {x}.id is not null then coalesce({x}.title, '~') || '|' || coalesce({x}.external_id, '~') end" for x in "rpj"}
    return f"""
    select a.id, a.created, a.updated, {ref["r"]} as repository, {ref["p"]} as publisher, {ref["j"]} as journal,
           a.title, a.obj_id as objid, a.subj_id as subjid, a.published_date as publisheddate,
           a.accession_number as accessionnumber, a.doi, a.relation_type_id as relationtypeid,
           coalesce(s.abbreviation, '') as source, coalesce(su.subjects, '') as subjects,
           coalesce(af.affiliations, '') as affiliations, coalesce(fu.funders, '') as funders
    from assertions a {DETAILS_JOINS}
    left join {_nested_sql("assertions_affiliations", "affiliations", "affiliation_id", "affiliations",
                           _org_text("d", two))} af on af.assertion_id = a.id
    left join {_nested_sql(funders_bridge, "funders", funders_fk, "funders", _org_text("d", two))} fu
        on fu.assertion_id = a.id
    left join {_nested_sql("assertions_subjects", "subjects", "subject_id", "subjects", "d.title")} su
        on su.assertion_id = a.id"""


def _view(t, via):
    d = details.assertion_details(corpus_of(t), funders_via=via)
    two = ("title", "external_id")
    refs = {c: F.when(F.col(c).isNotNull(), flat(F.col(c), *two)) for c in ("repository", "publisher", "journal")}
    d = d.withColumns({**refs, "affiliations": flat_list("affiliations", *two), "funders": flat_list("funders", *two)})
    return d.withColumn("subjects", F.array_join(F.array_sort("subjects"), "; "))


@register("details_view", _view_sql("assertions_funders", "funder_id"))
def _details_view(t):
    return _view(t, "funders")


@register("details_view_funders_via_affiliations", _view_sql("assertions_affiliations", "affiliation_id"))
def _details_view_literal(t):
    return _view(t, "affiliations")


@register(
    "nested_subjects",
    f"""select assertion_id, subjects from {_nested_sql("assertions_subjects", "subjects", "subject_id", "subjects",
                                                        "d.title", "d.title is not null")}""",
)
def _nested_subjects(t):
    title = F.col("title")
    expanded = expand_bridge(t.assertions_subjects, t.subjects, "subject_id")
    nested = nest(expanded, title, "subjects", title.isNotNull())
    return nested.withColumn("subjects", F.array_join("subjects", "; "))


# --- row filters (F1-F7), deduplication (W1) and counts (A1) --------------------------------------


@register("dedup_latest", f"with {DEDUPED} select * from deduped")
def _dedup(t):
    return dedup_latest(t.assertions)


@register("keep_citations", f"select id, relation_type_id from assertions where {CITES}")
def _citations(t):
    return filters.keep_citations(t.assertions).select("id", "relation_type_id")


@register("drop_repositories", f"select id, repository_id from assertions where {NOT_TRIAL}")
def _drop_repositories(t):
    return filters.drop_repositories(t.assertions, TRIALS).select("id", "repository_id")


@register("drop_self_citations", "select id, subj_id, obj_id from assertions where subj_id <> obj_id")
def _self(t):
    return filters.drop_self_citations(t.assertions).select("id", "subj_id", "obj_id")


@register(
    "drop_source_relation",
    f"""select id from assertions where not coalesce(source_type = '{rules.OBJECT_IS_DATASET_SOURCE}'
        and relation_type_id = 'is-referenced-by', false)""",
)
def _source_relation(t):
    return filters.drop_source_relation(t.assertions).select("id")


@register(
    "drop_excluded_without_doi",
    f"""select id from assertions
        where not coalesce(repository_id in ({sql_list(EXCLUDED)}) and doi is null, false)""",
)
def _excluded(t):
    return filters.drop_excluded_without_doi(t.assertions, EXCLUDED).select("id")


@register("drop_ids", "select id from assertions where id not in (select assertion_id from removal_ids)")
def _drop_ids(t):
    return filters.drop_ids(t.assertions, t.removal_ids).select("id")


@register(
    "select_recent_unresolved",
    """select id, external_id from affiliations where created >= timestamp '2025-07-01 00:00:00'
       and ror_id is null and ror_name is null""",
)
def _recent(t):
    return filters.select_unresolved(t.affiliations, rules.CURRENT_INGEST_SINCE).select("id", "external_id")


@register(
    "select_recent_unresolved_with_id",
    """select id, external_id from affiliations where created >= timestamp '2025-07-01 00:00:00'
       and external_id is not null and ror_id is null""",
)
def _recent_with_id(t):
    return filters.select_unresolved_with_id(t.affiliations, rules.CURRENT_INGEST_SINCE).select("id", "external_id")


@register(
    "stage_counts",
    f"""with {DEDUPED} select (select count(*) from assertions) as rows_before,
        (select count(*) from assertions) - (select count(*) from deduped) as removed,
        (select count(*) from deduped) as remaining""",
)
def _stage_counts(t):
    return curate.stage_counts(t.assertions, dedup_latest(t.assertions))


# --- referential clean-up (J1, J2, F9, F10) --------------------------------------------------------


@register(
    "cascade_bridges",
    f"""with kept as (select id from assertions where {CITES})
    select 'affiliations' as bridge, assertion_id, affiliation_id as target from assertions_affiliations
        where assertion_id in (select id from kept)
    union all select 'funders', assertion_id, funder_id from assertions_funders
        where assertion_id in (select id from kept)
    union all select 'subjects', assertion_id, subject_id from assertions_subjects
        where assertion_id in (select id from kept)""",
)
def _cascade(t):
    corpus = corpus_of(t)
    return _bridge_rows(integrity.cascade(corpus, filters.keep_citations(corpus.assertions)))


def _bridge_rows(c: Corpus) -> DataFrame:
    parts = [
        ("affiliations", c.assertions_affiliations, "affiliation_id"),
        ("funders", c.assertions_funders, "funder_id"),
        ("subjects", c.assertions_subjects, "subject_id"),
    ]
    rows = [df.select(F.lit(n).alias("bridge"), "assertion_id", F.col(fk).alias("target")) for n, df, fk in parts]
    return reduce(DataFrame.unionByName, rows)


def _dimension_rows(c: Corpus) -> DataFrame:
    parts = [("affiliations", c.affiliations), ("funders", c.funders), ("subjects", c.subjects)]
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("dimension"), "id") for n, df in parts])


@register(
    "drop_orphans",
    """select 'affiliations' as dimension, id from affiliations
        where id in (select affiliation_id from assertions_affiliations)
    union all select 'funders', id from funders where id in (select funder_id from assertions_funders)
    union all select 'subjects', id from subjects where id in (select subject_id from assertions_subjects)""",
)
def _orphans(t):
    return _dimension_rows(integrity.drop_all_orphans(corpus_of(t)))


@register(
    "remove_listed",
    """with kept as (select id from assertions where id not in (select assertion_id from removal_ids))
    select 'assertions' as kind, id as assertion_id, title as target from assertions where id in (select id from kept)
    union all select 'affiliations', assertion_id, affiliation_id from assertions_affiliations
        where assertion_id in (select id from kept)
    union all select 'funders', assertion_id, funder_id from assertions_funders where assertion_id in (select id from kept)
    union all select 'subjects', assertion_id, subject_id from assertions_subjects where assertion_id in (select id from kept)""",
)
def _remove_listed(t):
    done = accession.remove_listed(corpus_of(t), t.removal_ids)
    tables = {
        "assertions": done.assertions.select("id", "title"),
        "affiliations": done.assertions_affiliations.select("assertion_id", "affiliation_id"),
        "funders": done.assertions_funders.select("assertion_id", "funder_id"),
        "subjects": done.assertions_subjects.select("assertion_id", "subject_id"),
    }
    sides = [df.toDF("assertion_id", "target").withColumn("kind", F.lit(kind)) for kind, df in tables.items()]
    return reduce(DataFrame.unionByName, sides)


HANDLES = r"regexp_matches(title, '^@\S+(?:\s+(?:[/.-]\s*)?@\S+)*\z')"


@register(
    "drop_handle_orgs",
    f"""select 'affiliation' as kind, id from affiliations where not coalesce({HANDLES}, false)
    union all select 'bridge', id from assertions_affiliations
        where affiliation_id not in (select id from affiliations where {HANDLES})""",
)
def _handles(t):
    orgs, bridge = clean_orgs.drop_handle_orgs(t.affiliations, t.assertions_affiliations)
    return orgs.select(F.lit("affiliation").alias("kind"), "id").unionByName(
        bridge.select(F.lit("bridge").alias("kind"), "id")
    )


DOOMED = ["aff-000001", "aff-000003", "aff-000005"]


@register(
    "drop_org_ids",
    f"""select 'affiliation' as kind, id from affiliations where id not in ({sql_list(DOOMED)})
    union all select 'bridge', id from assertions_affiliations where affiliation_id not in ({sql_list(DOOMED)})""",
)
def _org_ids(t):
    orgs, bridge = clean_orgs.drop_org_ids(t.affiliations, t.assertions_affiliations, DOOMED)
    return orgs.select(F.lit("affiliation").alias("kind"), "id").unionByName(
        bridge.select(F.lit("bridge").alias("kind"), "id")
    )


# --- curation pipeline (D4, A12) -------------------------------------------------------------------


@register("curate_assertions", f"with {STAGES} select * from final")
def _curate_assertions(t):
    return curate.curate(corpus_of(t), trial_repositories=TRIALS).corpus.assertions


@register(
    "curate_bridges",
    f"""with {STAGES}
    select 'affiliations' as bridge, assertion_id, affiliation_id as target from assertions_affiliations
        where assertion_id in (select id from final)
    union all select 'funders', assertion_id, funder_id from assertions_funders
        where assertion_id in (select id from final)
    union all select 'subjects', assertion_id, subject_id from assertions_subjects
        where assertion_id in (select id from final)""",
)
def _curate_bridges(t):
    return _bridge_rows(curate.curate(corpus_of(t), trial_repositories=TRIALS).corpus)


_LIVE = {
    dim: f"(select {fk} from {bridge} where assertion_id in (select id from untried))"
    for bridge, fk, dim in [
        ("assertions_affiliations", "affiliation_id", "affiliations"),
        ("assertions_funders", "funder_id", "funders"),
        ("assertions_subjects", "subject_id", "subjects"),
    ]
}


@register(
    "curate_dimensions",
    f"""with {STAGES} """
    + " union all ".join(f"select '{d}' as dimension, id from {d} where id in {live}" for d, live in _LIVE.items()),
)
def _curate_dimensions(t):
    return _dimension_rows(curate.curate(corpus_of(t), trial_repositories=TRIALS).corpus)


def _audit_row(no: int, step: str, table: str, before: str, after: str) -> str:
    return (
        f"select {no} as step_no, '{step}' as step, '{table}' as \"table\", "
        f"(select count(*) from {before}) - (select count(*) from {after}) as removed, "
        f"(select count(*) from {after}) as remaining"
    )


@register(
    "curate_audit",
    f"with {STAGES}, "
    + ", ".join(f"live_{d} as (select id from {d} where id in {live})" for d, live in _LIVE.items())
    + " "
    + " union all ".join(
        [
            _audit_row(1, "duplicates", "assertions", "assertions", "deduped"),
            _audit_row(2, "non citations", "assertions", "deduped", "cited"),
            _audit_row(3, "clinical trials", "assertions", "cited", "untried"),
            *[_audit_row(4, "orphans", d, d, f"live_{d}") for d in _LIVE],
            _audit_row(5, "self citations", "assertions", "untried", "final"),
        ]
    ),
)
def _curate_audit(t):
    return curate.curate(corpus_of(t), trial_repositories=TRIALS).audit


@register(
    "curate_all_steps",
    f"""with {DEDUPED},
    listed as (select * from deduped where id not in (select assertion_id from removal_ids)),
    kept as (select * from listed where {CITES} and {NOT_TRIAL}
        and not coalesce(source_type = '{rules.OBJECT_IS_DATASET_SOURCE}' and relation_type_id = 'is-referenced-by', false)
        and not coalesce(repository_id in ({sql_list(EXCLUDED)}) and doi is null, false)
        and subj_id <> obj_id)
    select * from kept""",
)
def _curate_all(t):
    done = curate.curate(
        corpus_of(t),
        removal_ids=t.removal_ids,
        trial_repositories=TRIALS,
        source_relation=(rules.OBJECT_IS_DATASET_SOURCE, "is-referenced-by"),
        excluded_repositories=EXCLUDED,
    )
    return done.corpus.assertions


# --- table updates (M1-M9, J7) ----------------------------------------------------------------------


@register("dataset_publication", f"with {NAMED_ENDS} select id, source_type, dataset, publication from named_ends")
def _ends(t):
    return updates.add_dataset_publication(t.assertions).select("id", "source_type", "dataset", "publication")


@register(
    "merge_repository",
    """select id, case when repository_id = 'repo-3' then 'repo-5' else repository_id end as repository_id,
              'assertion' as kind from assertions
       union all select id, title, 'repository' from repositories where id <> 'repo-3'""",
)
def _merge(t):
    assertions, repositories = updates.merge_repositories(t.assertions, t.repositories, {"repo-3": "repo-5"})
    return assertions.select("id", "repository_id", F.lit("assertion").alias("kind")).union(
        repositories.select("id", "title", F.lit("repository"))
    )


@register(
    "clear_invalid_ids",
    "select id, case when trim(external_id) in ('N/A', 'null') then null else external_id end as external_id from affiliations",
)
def _invalid(t):
    return updates.clear_invalid_ids(t.affiliations, rules.INVALID_EXTERNAL_IDS["affiliations"]).select("id", "external_id")


@register("lowercase_subjects", "select id, lower(title) as title from subjects")
def _lower(t):
    return updates.lowercase_titles(t.subjects).select("id", "title")


@register(
    "normalize_dois",
    f"""with {NAMED_ENDS} select id, {norm_doi_sql("subj_id")} as subj_id, {norm_doi_sql("obj_id")} as obj_id,
        {norm_doi_sql("doi")} as doi, {norm_doi_sql("dataset")} as dataset,
        {norm_doi_sql("publication")} as publication from named_ends""",
)
def _dois(t):
    normalized = updates.normalize_assertion_dois(updates.add_dataset_publication(t.assertions))
    return normalized.select("id", "subj_id", "obj_id", "doi", "dataset", "publication")


@register(
    "update_from",
    """select a.id, case when u.id is not null then u.title else a.title end as title
       from assertions a left join title_updates u on u.id = a.id""",
)
def _update_from(t):
    return updates.update_from(t.assertions, t.title_updates, "id", ["title"]).select("id", "title")


@register("normalize_external_ids", f"select id, {norm_ext_sql('external_id')} as external_id from affiliations")
def _external_ids(t):
    return t.affiliations.select("id", normalize_external_id(F.col("external_id")).alias("external_id"))


@register(
    "normalize_external_ids_compat",
    f"""select id, case when starts_with(trim(external_id), 'http://isni.org')
            then replace(trim(external_id), 'http://isni.org', 'http://isni.org/isni')
            else {norm_ext_sql('external_id')} end as external_id from affiliations""",
)
def _external_ids_compat(t):
    return t.affiliations.select("id", normalize_external_id(F.col("external_id"), compat=True).alias("external_id"))


@register(
    "fix_separators",
    """select f.id, replace(f.title || '; ' || f.title, ' ;', ';') as affiliations,
              replace('A ;' || f.title, ' ;', ';') as funders from funders f""",
)
def _separators(t):
    title = F.col("title")
    flat_text = t.funders.select(
        "id",
        F.concat(title, F.lit("; "), title).alias("affiliations"),
        F.concat(F.lit("A ;"), title).alias("funders"),
    )
    return updates.fix_separators(flat_text)


EDGE = r"[.,*;:\s]+"
EMAIL_SQL = titles.EMAIL


NEWLINE, LITERAL = "chr(10)", r"'\n'"


def _clean_trailing_sql(c: str, trimmed: str = NEWLINE) -> str:
    return rf"""case when regexp_matches({c}, '{EDGE}\z')
        then regexp_replace(regexp_replace(trim(trim({c}, ' '), {trimmed}), '{EDGE}\z', ''), '\s+', ' ', 'g')
        else {c} end"""


def _either_end_sql(c: str, guard: str, newline: str = NEWLINE) -> str:
    trimmed = f"trim(trim({c}, ' '), {newline})"
    return rf"""case when {guard}
        then regexp_replace(case when regexp_matches({trimmed}, '^{EDGE}') then regexp_replace({trimmed}, '^{EDGE}', '')
                                 else regexp_replace({trimmed}, '{EDGE}\z', '') end, '\s+', ' ', 'g')
        else {c} end"""


HAS_EDGE = rf"regexp_matches(title, '^{EDGE}') or regexp_matches(title, '{EDGE}\z')"


def _clean_affiliations_sql(newline: str) -> str:
    has_email = f"regexp_matches(title, '{titles.STRICT_EMAIL}')"
    return rf"""with s3 as (select id, regexp_replace(title, '{EMAIL_SQL}', '', 'g') as title from affiliations),
    s4 as (select id, regexp_replace(title, '{titles.CONTACT_LABELS}', '', 'g') as title from s3),
    s5 as (select id, {_either_end_sql("title", has_email, newline)} as title from s4),
    s6 as (select id, {_clean_trailing_sql("title", newline)} as title from s5),
    s7 as (select id, regexp_replace(title, '(?s)^\((.*)\)\z', '\1') as title from s6)
    select id, case when regexp_matches(title, '^{EDGE}')
        then regexp_replace(regexp_replace(title, '^{EDGE}', ''), '\s+', ' ', 'g') else title end as title from s7"""


def _clean_funders_sql(newline: str) -> str:
    return f"""with s9 as (select id, {_either_end_sql("title", HAS_EDGE, newline)} as title from funders)
    select id, {_clean_trailing_sql("title", newline)} as title from s9"""


@register("clean_affiliations", _clean_affiliations_sql(NEWLINE))
def _clean_affiliations(t):
    return clean_orgs.clean_affiliations(t.affiliations).select("id", "title")


@register("clean_affiliations_compat", _clean_affiliations_sql(LITERAL))
def _clean_affiliations_compat(t):
    return clean_orgs.clean_affiliations(t.affiliations, compat=True).select("id", "title")


@register("clean_funders", _clean_funders_sql(NEWLINE))
def _clean_funders(t):
    return clean_orgs.clean_funders(t.funders).select("id", "title")


@register("clean_funders_compat", _clean_funders_sql(LITERAL))
def _clean_funders_compat(t):
    return clean_orgs.clean_funders(t.funders, compat=True).select("id", "title")


@register(
    "scrub_emails_documents",
    rf"""select doc_id, md5(regexp_replace(text, '{EMAIL_SQL}', '', 'g')) as text_md5,
        text <> regexp_replace(text, '{EMAIL_SQL}', '', 'g') as changed from documents""",
)
def _scrub(t):
    clean = titles.remove_emails(F.col("text"))
    return t.documents.select("doc_id", F.md5(clean).alias("text_md5"), (clean != F.col("text")).alias("changed"))


@register(
    "clean_document_edges",
    rf"""select doc_id, md5({_either_end_sql("text", f"regexp_matches(text, '^{EDGE}') or regexp_matches(text, '{EDGE}" + chr(92) + "z')")}) as text_md5
    from documents""",
)
def _edges(t):
    return t.documents.select("doc_id", F.md5(titles.clean_either_end(F.col("text"))).alias("text_md5"))


# --- accession numbers (U1, D5) ------------------------------------------------------------------------


def _pattern_case(patterns=PATTERNS) -> str:
    whens = " ".join(
        f"when a.repository_id = '{r}' then regexp_matches(a.accession_number, '^(?:{p})')" for r, p in patterns.items()
    )
    return f"case {whens} end"


@register(
    "validate_accessions",
    f"""select a.repository_id, a.id, a.subj_id, a.obj_id, a.type, a.created, a.updated, a.source_type, a.title,
        a.accession_number, a.published_date, a.doi, a.not_found, a.retried, r.title as repository_title,
        p.title as publisher_title, s.title as source_title, {_pattern_case()} as accession_number_pattern_match
    from assertions a left join repositories r on r.id = a.repository_id
    left join publishers p on p.id = a.publisher_id left join sources s on s.id = a.source_id
    where a.source_id = 'src-1' and a.repository_id in ({sql_list(PATTERNS)})""",
)
def _validate(t):
    return accession.validate_accessions(corpus_of(t), PATTERNS, "src-1")


DOUBLED = {repository: pattern.replace("\\", "\\\\") for repository, pattern in PATTERNS.items()}


@register(
    "accession_flags_doubled_backslashes",
    f"""select id, {_pattern_case(DOUBLED)} as matches from assertions a""",
)
def _doubled(t):
    return t.assertions.select(
        "id", accession.accession_matches(F.col("repository_id"), F.col("accession_number"), DOUBLED).alias("matches")
    )


# --- export (K1, K2, W2, U12-U14) -------------------------------------------------------------------------

CHUNK = 4000


@register(
    "export_chunks",
    f"""select id, rn as row_number, cast((rn - 1) // {CHUNK} + 1 as integer) as chunk
        from (select id, row_number() over (order by id) as rn from assertions)""",
)
def _chunks(t):
    return number_rows(t.assertions, "id", CHUNK).rows


def _label(alias: str) -> str:
    return f"""case when {alias}.external_id <> '' then coalesce({alias}.title || ' ', '') || {alias}.external_id
        else coalesce({alias}.title, '') end"""


_ORG_LABEL = "ltrim(coalesce(d.title, '') || case when d.external_id <> '' then ' ' || d.external_id else '' end)"
_ROR_LABEL = "trim(coalesce(d.ror_name, '') || ' ' || coalesce(d.ror_id, ''))"
_STRUCT_ORDER = "order by d.title nulls first, d.external_id nulls first, d.ror_name nulls first, d.ror_id nulls first"


_ORG_LABEL_COMPAT = "coalesce(d.title, 'None') || case when d.external_id <> '' then ' ' || d.external_id else '' end"
_ROR_LABEL_COMPAT = "coalesce(d.ror_name, 'None') || ' ' || coalesce(d.ror_id, 'None')"


def _csv_nested(bridge: str, dim: str, fk: str, org: str = _ORG_LABEL, ror: str = _ROR_LABEL) -> str:
    return f"""(select b.assertion_id, string_agg({org}, '; ' {_STRUCT_ORDER}) as labels,
        string_agg({ror}, '; ' {_STRUCT_ORDER}) as rors
        from {bridge} b join {dim} d on d.id = b.{fk} where {NAMED_KEEP} group by b.assertion_id)"""


@register(
    "export_csv_rows",
    f"""with {NAMED_ENDS}
    select a.id, a.created, a.updated, {_label("r")} as repository, {_label("p")} as publisher,
        {_label("j")} as journal, a.title, a.dataset, a.publication, a.published_date as "publishedDate",
        s.abbreviation as source, coalesce(su.subjects, '') as subjects,
        coalesce(af.labels, '') as affiliations, coalesce(af.rors, '') as "affiliationsROR",
        coalesce(fu.labels, '') as funders, coalesce(fu.rors, '') as "fundersROR"
    from named_ends a {DETAILS_JOINS}
    left join {_csv_nested("assertions_affiliations", "affiliations", "affiliation_id")} af on af.assertion_id = a.id
    left join {_csv_nested("assertions_funders", "funders", "funder_id")} fu on fu.assertion_id = a.id
    left join {_nested_sql("assertions_subjects", "subjects", "subject_id", "subjects",
                           "d.title", "d.title is not null")} su on su.assertion_id = a.id""",
)
def _csv_rows(t):
    return export.csv_rows(details.assertion_details_formatted(corpus_of(t, named_ends=True)))



@register(
    "export_csv_labels_compat",
    f"""select a.id, coalesce(af.labels, '') as affiliations, coalesce(af.rors, '') as "affiliationsROR"
    from assertions a left join {_csv_nested("assertions_affiliations", "affiliations", "affiliation_id",
                                             _ORG_LABEL_COMPAT, _ROR_LABEL_COMPAT)} af on af.assertion_id = a.id""",
)
def _csv_labels_compat(t):
    formatted = details.assertion_details_formatted(corpus_of(t, named_ends=True))
    return export.csv_rows(formatted, compat=True).select("id", "affiliations", "affiliationsROR")


def _json_text(value: str) -> str:
    return f"coalesce(cast(to_json({value}) as varchar), 'null')"


def _json_object(alias: str, fields) -> str:
    return "'{' || " + " || ',' || ".join(f"""'"{f}":' || {_json_text(f"{alias}.{f}")}""" for f in fields) + " || '}'"


def _json_ref(alias: str) -> str:
    return f"""case when {alias}.title is not null or {alias}.external_id is not null
        then {_json_object(alias, ("title", "external_id"))} else '{{}}' end"""


def _json_time(column: str) -> str:
    return f"""coalesce('"' || strftime({column}, '%Y-%m-%dT%H:%M:%S') || '.000"', 'null')"""


def _json_nested(bridge: str, dim: str, fk: str) -> str:
    return f"""(select b.assertion_id, string_agg({_json_object("d", ORG_FIELDS)}, ',' {_STRUCT_ORDER}) as items
        from {bridge} b join {dim} d on d.id = b.{fk} where {NAMED_KEEP} group by b.assertion_id)"""


@register(
    "export_json_lines",
    f"""with {NAMED_ENDS}, numbers as (
        select id, row_number() over (order by id) as rn, count(*) over () as total from assertions)
    select cast((n.rn - 1) // {CHUNK} + 1 as integer) as chunk, n.rn as row_number,
        case when (n.rn - 1) % {CHUNK} = 0 then '[' else '' end
        || '{{"id":' || {_json_text("a.id")} || ',"created":' || {_json_time("a.created")}
        || ',"updated":' || {_json_time("a.updated")} || ',"repository":' || {_json_ref("r")}
        || ',"publisher":' || {_json_ref("p")} || ',"journal":' || {_json_ref("j")}
        || ',"title":' || {_json_text("a.title")} || ',"dataset":' || {_json_text("a.dataset")}
        || ',"publication":' || {_json_text("a.publication")}
        || ',"publishedDate":' || {_json_text("a.published_date")} || ',"source":' || {_json_text("s.abbreviation")}
        || ',"affiliations":[' || coalesce(af.items, '') || '],"funders":[' || coalesce(fu.items, '')
        || '],"subjects":[' || coalesce(su.items, '') || ']}}'
        || case when n.rn % {CHUNK} = 0 or n.rn = n.total then ']' else ',' end as value
    from named_ends a join numbers n on n.id = a.id {DETAILS_JOINS}
    left join {_json_nested("assertions_affiliations", "affiliations", "affiliation_id")} af on af.assertion_id = a.id
    left join {_json_nested("assertions_funders", "funders", "funder_id")} fu on fu.assertion_id = a.id
    left join (select b.assertion_id, string_agg({_json_text("d.title")}, ',' order by d.title) as items
        from assertions_subjects b join subjects d on d.id = b.subject_id where d.title is not null
        group by b.assertion_id) su on su.assertion_id = a.id""",
)
def _json_lines(t):
    corpus = corpus_of(t, named_ends=True)
    numbered = number_rows(corpus.assertions, "id", CHUNK)
    chunked = export.with_chunks(details.assertion_details_formatted(corpus), numbered)
    return files.json_lines(chunked, numbered, CHUNK)


# --- subjects (D8) ------------------------------------------------------------------------------------------

SINCE = "1998-01-01"
RULE_VALUES = ", ".join(f"('{r}', '{s}')" for r, ss in SUBJECT_RULES.items() for s in ss)
REQUIRED_VALUES = ", ".join(f"('{s}')" for s in rules.REQUIRED_SUBJECTS)
SUBJECTS_AFTER = f"""lowered as (select id, lower(title) as title from subjects),
    tagged_subjects as (select id, title from lowered
        union all select {uuid_sql("'subject'", "v.title")}, v.title from (values {REQUIRED_VALUES}) v(title)
        where v.title not in (select title from lowered))"""


@register("add_subjects", f"with {SUBJECTS_AFTER} select id, title from tagged_subjects")
def _add_subjects(t):
    lowered = updates.lowercase_titles(t.subjects)
    return tag_subjects.add_subjects(lowered, rules.REQUIRED_SUBJECTS, F.lit(NOW).cast("timestamp")).select("id", "title")


@register(
    "tag_subjects",
    f"""with {SUBJECTS_AFTER}, wanted as (
        select a.id as assertion_id, s.id as subject_id
        from assertions a join (values {RULE_VALUES}) r(repository_id, title) on r.repository_id = a.repository_id
        join tagged_subjects s on s.title = r.title where a.created >= timestamp '{SINCE} 00:00:00')
    select id, type, created, updated, assertion_id, subject_id, inferred from assertions_subjects
    union all select {uuid_sql("'assertionSubject'", "w.assertion_id", "w.subject_id")}, 'assertionSubject',
        timestamp '{NOW}', timestamp '{NOW}', w.assertion_id, w.subject_id, false
    from wanted w where not exists (select 1 from assertions_subjects e
        where e.assertion_id = w.assertion_id and e.subject_id = w.subject_id)""",
)
def _tag(t):
    tagged = tag_subjects.tag_subjects(
        corpus_of(t), SUBJECT_RULES, since=SINCE, now=F.lit(NOW).cast("timestamp")
    )
    return tagged.assertions_subjects


# --- review (F12, A10, U21, J12-J14, D12) ------------------------------------------------------------------

REVIEW_COLUMNS = {"dataset": "Dataset"}
for _i in review.MATCHES:
    REVIEW_COLUMNS |= {f"m{_i}_name": f"Match {_i} Name", f"m{_i}_id": f"Match {_i} ID", f"m{_i}_chosen": f"Match {_i} Chosen"}


def _review(t) -> DataFrame:
    return t.review.withColumnsRenamed(REVIEW_COLUMNS)


FLAGS = "(" + " + ".join(f"case when upper(trim(m{i}_chosen)) = 'TRUE' then 1 else 0 end" for i in review.MATCHES) + ")"
ALL_FALSE = "(" + " and ".join(f"coalesce(upper(trim(m{i}_chosen)) = 'FALSE', false)" for i in review.MATCHES) + ")"
CLASSIFIED = f"""classified as (select *, {FLAGS} as num_true, {ALL_FALSE} as all_false,
    case when {FLAGS} = 1 then '{review.BUCKETS["one"]}' when {FLAGS} > 1 then '{review.BUCKETS["many"]}'
         when {ALL_FALSE} then '{review.BUCKETS["none"]}' end as bucket from review)"""


@register("classify_matches", f"with {CLASSIFIED} select dataset, m1_id, num_true, all_false, bucket from classified")
def _classify(t):
    done = review.classify_matches(_review(t))
    return done.select(
        F.col("Dataset").alias("dataset"), F.col("Match 1 ID").alias("m1_id"), "num_true", "all_false", "bucket"
    )


@register(
    "bucket_summary",
    f"""with {CLASSIFIED} select count(*) as total, """
    + ", ".join(f"count(case when bucket = '{b}' then 1 end) as {b}" for b in review.BUCKETS.values())
    + ", count(case when bucket is null then 1 end) as no_bucket from classified",
)
def _buckets(t):
    return review.bucket_summary(review.classify_matches(_review(t)))


def _pick(what: str) -> str:
    return "case " + " ".join(f"when upper(trim(m{i}_chosen)) = 'TRUE' then trim(m{i}_{what})" for i in review.MATCHES) + " end"


CHOSEN = f"""chosen as (select distinct * from (select trim(dataset) as dataset_key, {_pick("id")} as ror_id,
    {_pick("name")} as title from review) where dataset_key is not null and ror_id is not null and title is not null)"""
ORG_BY_TITLE = f"""known as (select title, max(id) as affiliation_id from affiliations
        where title in (select title from chosen) group by title),
    new_orgs as (select {uuid_sql("'affiliation'", "title")} as id, title, min(ror_id) as ror_id
        from chosen where title not in (select title from known) group by title),
    by_title as (select title, affiliation_id from known union all select title, id from new_orgs)"""
BY_KEY = """unlinked as (select * from named_ends where id not in (select assertion_id from assertions_affiliations)),
    by_key as (select distinct c.dataset_key, a.id as assertion_id from chosen c join unlinked a
        on (starts_with(c.dataset_key, 'a-') and a.id = c.dataset_key)
        or (not starts_with(c.dataset_key, 'a-') and a.dataset = c.dataset_key))"""


@register("chosen_matches", f"with {CHOSEN} select dataset_key, ror_id, title from chosen")
def _chosen(t):
    return review.chosen_matches(_review(t))


@register("resolve_org_by_title", f"with {CHOSEN}, {ORG_BY_TITLE} select title, affiliation_id from by_title")
def _org_by_title(t):
    return review.resolve_org_by_title(review.chosen_matches(_review(t)), t.affiliations)[0]


def _link(t, compat: bool = False) -> review.Linked:
    return review.link_chosen_affiliations(
        _review(t),
        t.affiliations,
        updates.add_dataset_publication(t.assertions),
        t.assertions_affiliations,
        is_id=lambda key: key.startswith("a-"),
        compat=compat,
    )


@register(
    "link_chosen_affiliations",
    f"""with {CHOSEN}, {ORG_BY_TITLE}, {NAMED_ENDS}, {BY_KEY}
    select {uuid_sql("'assertionAffiliation'", "c.dataset_key", "c.ror_id", "c.title", "k.assertion_id", "o.affiliation_id")} as id,
        k.assertion_id, o.affiliation_id, 'assertionAffiliation' as type
    from chosen c join by_title o on o.title = c.title join by_key k on k.dataset_key = c.dataset_key""",
)
def _links(t):
    return _link(t).new_links


@register(
    "link_chosen_affiliations_compat",
    f"""with {CHOSEN}, {ORG_BY_TITLE}, {NAMED_ENDS}, {BY_KEY},
    one_each as (select dataset_key, max(assertion_id) as assertion_id from by_key group by dataset_key)
    select k.assertion_id, o.affiliation_id, 'assertionAffiliation' as type
    from chosen c join by_title o on o.title = c.title join one_each k on k.dataset_key = c.dataset_key""",
)
def _links_compat(t):
    return _link(t, compat=True).new_links.select("assertion_id", "affiliation_id", "type")


@register(
    "new_affiliations",
    f"with {CHOSEN}, {ORG_BY_TITLE} select id, title, ror_id, 'affiliation' as type from new_orgs",
)
def _new_affiliations(t):
    return _link(t).new_affiliations


# --- text-mined ingest (S7, J8-J11, A9, D9, U3, U18) ----------------------------------------------------------

FEED = """feed as (select repo_code, trim(accession) as accession, trim(pmcid) as pmcid from textmined
        where accession <> '' and pmcid <> ''),
    lookup as (select pmcid, max(doi) as doi, max(doi_url) as doi_url from
        (select pmcid, doi, null as doi_url from crosswalk union all select pmcid, null, doi_url from lookup_cache)
        group by pmcid),
    looked_up as (select f.*, coalesce(case when starts_with(l.doi, '10.') then 'https://doi.org/' || l.doi else l.doi end,
        nullif(l.doi_url, '')) as publication from feed f left join lookup l on l.pmcid = f.pmcid)"""


@register(
    "resolve_publications",
    f"with {FEED} select repo_code, accession, pmcid, publication from looked_up where publication is not null",
)
def _resolve(t):
    return ingest.resolve_publications(t.textmined, t.crosswalk, t.lookup_cache).select(
        "repo_code", "accession", "pmcid", "publication"
    )


@register(
    "missing_keys",
    f"""with {FEED} select distinct pmcid, pmcid as query_key from feed
        where pmcid not in (select pmcid from lookup)""",
)
def _missing(t):
    return ingest.missing_keys(t.textmined, t.crosswalk, t.lookup_cache)


@register(
    "merge_lookup_cache",
    """select pmcid, doi_url from fetched_cache
       union all select pmcid, doi_url from lookup_cache where pmcid not in (select pmcid from fetched_cache)""",
)
def _merge_cache(t):
    return ingest.merge_lookup_cache(t.lookup_cache, t.fetched_cache)


def _scratch(t) -> str:
    """A new folder beside the checkpoints, which all executors reach."""
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4().hex}"


@register("merge_cache_store", None)
def _merge_cache_store(t):
    store = KeyedStore.create(t.lookup_cache, _scratch(t), "pmcid", 16)
    return paper_store.merge_into_cache(store, t.fetched_cache).read()


ORACLES["merge_cache_store"] = ORACLES["merge_lookup_cache"]


NAMES_CASE = "case repo_code " + " ".join(
    f"when '{c}' then '{n}'" for c, n in rules.REPOSITORY_NAMES.items()
) + " else repo_code end"


@register(
    "standardize_repository",
    f"select repo_code, {NAMES_CASE} as repository, count(*) as n from textmined group by all",
)
def _standardize(t):
    return ingest.standardize_repository(t.textmined).groupBy("repo_code", "repository").agg(F.count(F.lit(1)).alias("n"))


@register(
    "match_rate",
    f"""with {FEED} select repo_code, count(*) as total, count(publication) as matched,
        round(count(publication) * 100.0 / count(*), 1) as percent from looked_up group by repo_code""",
)
def _rate(t):
    return ingest.match_rate(ingest.lookup_publications(t.textmined, t.crosswalk, t.lookup_cache))


@register(
    "ingest_textmined",
    f"""with {FEED}, named as (select *, {NAMES_CASE} as repository from looked_up where publication is not null)
    select repo_code, case when repository = 'doi' then p.publisher else repository end as repository,
        accession as dataset, publication
    from named n left join (select doi, max(publisher) as publisher from doi_publishers group by doi) p
        on n.repository = 'doi' and p.doi = n.accession""",
)
def _ingest(t):
    return ingest.ingest_textmined(t.textmined, t.crosswalk, t.lookup_cache, t.doi_publishers).citations


# --- papers (S8, U15-U17, K8, J19, A5, D10, D11) -----------------------------------------------------------------

_J = "json_extract(value, '$.\"container-title\"')"
_D = "json_extract(value, '$.published.\"date-parts\"[0]')"


def _part(i: int) -> str:
    return f"cast(json_extract_string({_D}, '$[{i}]') as integer)"


PARSED = f"""valid as (select value from paper_lines where json_valid(value)),
    parsed as (select json_extract_string(value, '$.DOI') as doi,
        case when json_type({_J}) = 'ARRAY' then coalesce(json_extract_string({_J}, '$[0]'), '')
             else coalesce(json_extract_string(value, '$."container-title"'), '') end as journal,
        coalesce(json_extract_string(value, '$.publisher'), '') as publisher,
        case when json_extract_string(value, '$.published."date-time"') <> ''
                then json_extract_string(value, '$.published."date-time"')
             when json_array_length({_D}) >= 3
                then {_part(0)} || '-' || lpad(cast({_part(1)} as string), 2, '0') || '-'
                     || lpad(cast({_part(2)} as string), 2, '0')
             when json_array_length({_D}) = 2 then {_part(0)} || '-' || lpad(cast({_part(1)} as string), 2, '0')
             when json_array_length({_D}) = 1 then cast({_part(0)} as string)
             else '' end as published_date
        from valid),
    papers as (select doi, journal, publisher, published_date from (
        select *, row_number() over (partition by doi order by published_date desc, journal desc, publisher desc) as rn
        from parsed where doi <> '') where rn = 1)"""


@register("load_papers", f"with {PARSED} select doi, journal, publisher, published_date from papers")
def _load_papers(t):
    return papers.load_papers(t.paper_lines)


@register("bad_paper_lines", "select value from paper_lines where not json_valid(value)")
def _bad_lines(t):
    return papers.parse_papers(t.paper_lines)[1]


@register(
    "enrich_papers",
    f"""with {PARSED} select a.id, a.obj_id, p.journal as paper_journal, p.publisher as paper_publisher,
        p.published_date as paper_published_date from assertions a left join papers p on p.doi = a.obj_id""",
)
def _enrich(t):
    done = papers.enrich_papers(t.assertions.select("id", "obj_id"), papers.load_papers(t.paper_lines), on="obj_id")
    return done.select("id", "obj_id", "paper_journal", "paper_publisher", "paper_published_date")


@register(
    "paper_stats",
    f"""with {PARSED} select publisher, count(*) as papers, (select count(*) from papers) as total_papers
        from papers where publisher <> '' group by publisher order by papers desc, publisher limit 10""",
)
def _stats(t):
    return papers.paper_stats(papers.load_papers(t.paper_lines))


@register(
    "search_papers",
    f"""with {PARSED} select doi, journal, publisher, published_date from papers
        where publisher = 'Publisher 3' and journal = 'Journal 4' and starts_with(published_date, '2000')""",
)
def _search(t):
    return papers.search_papers(papers.load_papers(t.paper_lines), journal="Journal 4", publisher="Publisher 3", year=2000)


@register(
    "upsert_papers",
    f"""with {PARSED}, newer as (select distinct '10.1029/p' || cast(c_custkey * 2 as string) as doi,
            'New Journal' as journal, c_mktsegment as publisher, '2024' as published_date from customer)
    select doi, journal, publisher, published_date from newer
    union all select doi, journal, publisher, published_date from papers where doi not in (select doi from newer)""",
)
def _upsert(t):
    return papers.upsert_papers(papers.load_papers(t.paper_lines), _newer(t))


def _newer(t):
    return t.customer.select(
        F.concat(F.lit("10.1029/p"), (F.col("c_custkey") * 2).cast("string")).alias("doi"),
        F.lit("New Journal").alias("journal"),
        F.col("c_mktsegment").alias("publisher"),
        F.lit("2024").alias("published_date"),
    )


@register("upsert_paper_store", None)
def _upsert_store(t):
    store = paper_store.create_paper_store(papers.load_papers(t.paper_lines), _scratch(t), 16)
    return paper_store.upsert_into_store(store, _newer(t)).read()


ORACLES["upsert_paper_store"] = ORACLES["upsert_papers"]


# --- comparison (S10, C1, C2, J20, J21, U23, X3, X4) ---------------------------------------------------------------


def _report(t) -> DataFrame:
    """One line per article with its sorted list of cited datasets."""
    return t.report_pairs.groupBy("article_doi").agg(F.sort_array(F.collect_list("dataset_doi")).alias("cited"))


def _key(c: str) -> str:
    return f"regexp_replace(lower({c}), '^https://doi\\.org/', '')"


LINKS = f"""links as (select distinct subj_id, obj_id from event_links
    where relation_type_id in ({sql_list(rules.CITATION_RELATIONS)}))"""

COMPARE = f"""{LINKS},
    report as (select article_doi, {_key("article_doi")} as article_key, list(dataset_doi order by dataset_doi) as cited
        from report_pairs group by article_doi),
    ends as (select {_key("subj_id")} as article_key, obj_id as other, 0 as side from links
        union all select {_key("obj_id")}, subj_id, 1 from links),
    firsts as (select article_key, other, min(side) as side from ends group by article_key, other),
    lists as (select article_key, list(other order by side, other) as events from firsts group by article_key),
    both_lists as (select r.article_doi, r.cited, coalesce(l.events, []) as events
        from report r left join lists l on l.article_key = r.article_key)"""


@register(
    "compare_citations",
    f"""with {COMPARE}, keyed as (select *, list_transform(cited, lambda d: {_key("d")}) as ck,
            list_transform(events, lambda d: {_key("d")}) as ek from both_lists)
    select article_doi, array_to_string(cited, ',') as reported, cast(len(cited) as integer) as reported_count,
        array_to_string(events, ',') as events, cast(len(events) as integer) as events_count,
        len(cited) = len(events)
            and len(list_filter(ck, lambda s: len(list_filter(ek, lambda e: contains(e, s))) = 0)) = 0
            and len(list_filter(ek, lambda s: len(list_filter(ck, lambda e: contains(e, s))) = 0)) = 0 as same,
        cast(len(cited) - len(events) as integer) as count_difference,
        array_to_string(list_filter(ck, lambda s: not list_contains(ek, s)), ',') as only_reported,
        array_to_string(list_filter(ek, lambda s: not list_contains(ck, s)), ',') as only_events
    from keyed""",
)
def _compare(t):
    return compare.compare_citations(_report(t), t.event_links)


@register(
    "citation_differences",
    f"""with {COMPARE}, pairs as (select article_key, {_key("unnest(cited)")} as cited_key, true as reported from report
        union all select e.article_key, {_key("e.other")}, false from ends e
            where e.article_key in (select article_key from report))
    select article_key, cited_key, bool_or(reported) as reported, bool_or(not reported) as recorded
    from pairs group by article_key, cited_key""",
)
def _differences(t):
    return compare.citation_differences(_report(t), t.event_links)


@register(
    "citation_events_for",
    f"""with {LINKS}, articles as (select distinct {_key("article_doi")} as article_key from report_pairs)
    select {_key("subj_id")} as article_key, obj_id as other, true as as_subject from links
        where {_key("subj_id")} in (select article_key from articles)
    union all select {_key("obj_id")}, subj_id, false from links
        where {_key("obj_id")} in (select article_key from articles)""",
)
def _events_for(t):
    return compare.citation_events_for(t.report_pairs.select(doi_key(F.col("article_doi")).alias("article_key")), t.event_links)


@register(
    "in_events",
    f"""with {LINKS} select article_doi, dataset_doi from report_pairs r where exists (
        select 1 from links l where {_key("l.subj_id")} = {_key("r.article_doi")}
            and {_key("l.obj_id")} = {_key("r.dataset_doi")})""",
)
def _in_events(t):
    return compare.in_events(t.report_pairs, t.event_links)


@register(
    "missing_citations",
    f"""with {LINKS}, pairs as (select distinct {_key("subj_id")} as a, {_key("obj_id")} as d from links),
    checked as (select r.article_doi, r.dataset_doi, p.a is null as missing from report_pairs r
        left join pairs p on p.a = {_key("r.article_doi")} and p.d = {_key("r.dataset_doi")})
    select article_doi, string_agg(dataset_doi, ', ' order by dataset_doi) as reported,
        cast(count(*) as integer) as reported_count,
        coalesce(string_agg(case when missing then dataset_doi end, ', ' order by dataset_doi), '') as missing,
        cast(count(case when missing then 1 end) as integer) as missing_count,
        cast(count(case when not missing then 1 end) as integer) as found_count
    from checked group by article_doi""",
)
def _missing_citations(t):
    return compare.missing_citations(_report(t), t.event_links)


# --- reconciliation (E1-E8, X1, U20) ----------------------------------------------------------------------------------


def _name_key_sql(c: str) -> str:
    return rf"nullif(trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '')"


REGISTRY = f"""reg_names as (select ror_id, name, name as label from registry
        union select ror_id, name, unnest(aliases) from registry),
    reg_by_name as (select {_name_key_sql("label")} as k, min(ror_id) as ror_id, min(name) as name from reg_names
        group by 1 having count(distinct ror_id) = 1 and k is not null),
    reg_ext as (select e as k, min(ror_id) as ror_id from
        (select ror_id, unnest(external_ids) as e from registry) where e <> '' group by e),
    reg_by_ext as (select x.k, x.ror_id, r.name from reg_ext x join registry r on r.ror_id = x.ror_id),
    reg_by_id as (select ror_id as k, ror_id, name from registry)"""

SEARCH_KEY = """case when starts_with({c}, 'https://www.grid.ac') or starts_with({c}, 'http://isni.org/isni')
    or starts_with({c}, 'https://doi.org') then regexp_extract({c}, '([^/]*)$', 1) else {c} end"""

ORG_KEYS = f"""cleared as (select id, title, created, ror_id, ror_name,
        case when trim(external_id) in ('N/A', 'null') then null else external_id end as external_id from affiliations),
    keyed as (select *, case when external_id <> '' then {norm_ext_sql("external_id")} else external_id end as norm,
        {_name_key_sql("title")} as name_key from cleared),
    searched as (select *, {SEARCH_KEY.format(c="norm")} as ext_key from keyed)"""


@register(
    "reconcile_by_id",
    f"""with {REGISTRY}, {ORG_KEYS} select o.id, r.ror_id, r.name from searched o
        join reg_by_id r on r.k = o.norm where starts_with(o.norm, 'https://ror.org/')""",
)
def _by_id(t):
    return _matched(t, "_id_key", reconcile.by_id(t.registry), "_by_id").filter(F.col("_normalized").startswith("https://ror.org/")).select("id", "ror_id", "name")


def _matched(t, key: str, lookup: DataFrame, entry: str) -> DataFrame:
    orgs = updates.clear_invalid_ids(t.affiliations, rules.INVALID_EXTERNAL_IDS["affiliations"])
    keyed = reconcile.with_search_keys(orgs).drop("ror_id", "ror_name")
    found = lookup_join(keyed, lookup, key).filter(F.col(entry).isNotNull())
    return found.withColumns({"ror_id": F.col(f"{entry}.ror_id"), "name": F.col(f"{entry}.name")})


@register(
    "reconcile_by_external_id",
    f"""with {REGISTRY}, {ORG_KEYS} select o.id, r.ror_id, r.name from searched o
        join reg_by_ext r on r.k = o.ext_key where not starts_with(o.norm, 'https://ror.org/') and o.norm <> ''""",
)
def _by_external(t):
    return _matched(t, "_id_key", reconcile.by_external_id(t.registry), "_by_id").select("id", "ror_id", "name")


@register(
    "reconcile_by_title",
    f"""with {REGISTRY}, {ORG_KEYS} select o.id, r.ror_id, r.name from searched o join reg_by_name r on r.k = o.name_key""",
)
def _by_title(t):
    return _matched(t, "_name_key", reconcile.by_name(t.registry), "_by_name").select("id", "ror_id", "name")


def _reconcile_sql(since: str) -> str:
    return f"""with {REGISTRY}, {ORG_KEYS},
    found as (select o.*, {since} as recent, i.ror_id as id_ror, i.name as id_name, e.ror_id as ext_ror, e.name as ext_name,
            n.ror_id as title_ror, n.name as title_name
        from searched o left join reg_by_id i on i.k = o.norm and starts_with(o.norm, 'https://ror.org/')
        left join reg_by_ext e on e.k = o.ext_key and not starts_with(o.norm, 'https://ror.org/') and o.norm <> ''
        left join reg_by_name n on n.k = o.name_key),
    first_pass as (select *, recent and ror_id is null and ror_name is null as first,
        case when recent and ror_id is null and ror_name is null
             then case when coalesce(external_id, '') <> '' then coalesce(id_ror, ext_ror) else title_ror end
             else ror_id end as ror1,
        case when recent and ror_id is null and ror_name is null
             then case when coalesce(external_id, '') <> '' then coalesce(id_name, ext_name) else title_name end
             else ror_name end as name1 from found)
    select id, case when first then norm else external_id end as external_id,
        case when recent and external_id is not null and ror1 is null then title_ror else ror1 end as ror_id,
        case when recent and external_id is not null and ror1 is null then title_name else name1 end as ror_name
    from first_pass"""


@register(
    "reconcile_funders",
    _reconcile_sql("true")
    .replace("from affiliations", "from funders")
    .replace("('N/A', 'null')", f"({sql_list(rules.INVALID_EXTERNAL_IDS['funders'])})"),
)
def _reconcile_funders(t):
    done = reconcile.reconcile_corpus(corpus_of(t), t.registry)
    return done.funders.select("id", "external_id", "ror_id", "ror_name")


@register("reconcile_orgs", _reconcile_sql("true"))
def _reconcile(t):
    done = reconcile.reconcile_orgs(t.affiliations, t.registry, rules.INVALID_EXTERNAL_IDS["affiliations"])
    return done.select("id", "external_id", "ror_id", "ror_name")


@register("reconcile_orgs_since", _reconcile_sql("(created >= timestamp '2025-07-01 00:00:00')"))
def _reconcile_since(t):
    done = reconcile.reconcile_orgs(
        t.affiliations, t.registry, rules.INVALID_EXTERNAL_IDS["affiliations"], since=rules.CURRENT_INGEST_SINCE
    )
    return done.select("id", "external_id", "ror_id", "ror_name")


@register(
    "external_id_search_keys",
    f"""with {ORG_KEYS} select id, ext_key from searched""",
)
def _search_keys(t):
    orgs = updates.clear_invalid_ids(t.affiliations, rules.INVALID_EXTERNAL_IDS["affiliations"])
    normalized = F.when(F.col("external_id") != "", normalize_external_id(F.col("external_id"))).otherwise(F.col("external_id"))
    return orgs.select("id", external_id_search_key(normalized).alias("ext_key"))


UNRESOLVED = """unresolved as (select id, title from affiliations where external_id is null
    union select id, title from funders where external_id is null)"""


@register("unresolved_orgs", f"with {UNRESOLVED} select id, title from unresolved")
def _unresolved(t):
    return reconcile.unresolved_orgs(t.affiliations, t.funders)


_TOKENS = "list_sort(list_distinct(string_split({c}, ' ')))"
CANDIDATES = f"""{UNRESOLVED}, {REGISTRY},
    org_sets as (select distinct {_TOKENS.format(c=_name_key_sql("title"))} as toks from unresolved
        where {_name_key_sql("title")} is not null),
    reg_sets as (select distinct ror_id, name, {_TOKENS.format(c=_name_key_sql("label"))} as toks from reg_names
        where {_name_key_sql("label")} is not null),
    org_tokens as (select array_to_string(toks, ' ') as set_key, len(toks) as n, unnest(toks) as tok from org_sets),
    reg_tokens as (select ror_id, name, array_to_string(toks, ' ') as reg_key, len(toks) as n, unnest(toks) as tok from reg_sets),
    shared_tokens as (select o.set_key, r.ror_id, r.name, r.reg_key, o.n as n_o, r.n as n_r, count(*) as shared
        from org_tokens o join reg_tokens r on r.tok = o.tok group by all),
    scored as (select set_key, ror_id, name, max(shared / (n_o + n_r - shared)) as score from shared_tokens group by all
        having score >= 0.0),
    ranked as (select *, row_number() over (partition by set_key order by score desc, name, ror_id) as rank from scored)"""


@register(
    "candidate_matches",
    f"with {CANDIDATES} select set_key, ror_id, name, score, cast(rank as integer) as rank from ranked where rank <= 3",
)
def _candidates(t):
    return reconcile.candidate_matches(reconcile.unresolved_orgs(t.affiliations, t.funders), t.registry)


def _wide(i: int) -> str:
    chosen = (
        "max(case when rank = 1 then score end) = 1 and not coalesce(max(case when rank = 2 then score end) = 1, false)"
        if i == 1
        else f"max(case when rank = {i} then score end) < 0"
    )
    return f"""max(case when rank = {i} then name end) as "m{i}_name", max(case when rank = {i} then ror_id end) as m{i}_id,
        max(case when rank = {i} then score end) as m{i}_score, {chosen} as m{i}_chosen"""


@register(
    "candidate_report",
    f"""with {CANDIDATES}, wide as (select set_key, {_wide(1)}, {_wide(2)}, {_wide(3)} from ranked where rank <= 3 group by set_key)
    select u.id, u.title as original_name, w.* exclude (set_key)
    from unresolved u left join wide w on w.set_key = array_to_string({_TOKENS.format(c=_name_key_sql("u.title"))}, ' ')""",
)
def _candidate_report(t):
    report = reconcile.candidate_report(reconcile.unresolved_orgs(t.affiliations, t.funders), t.registry)
    renamed = {"Original Name": "original_name"}
    for i in (1, 2, 3):
        renamed |= {f"Match {i} {c}": f"m{i}_{c.lower()}" for c in reconcile.MATCH_COLUMNS}
    return report.withColumnsRenamed(renamed)


# --- summaries (A14) ---------------------------------------------------------------------------------------------------


@register(
    "assertions_last_10_years",
    """select cast(substr(published_date, 1, 4) as integer) as year, count(*) as assertions from assertions
       where cast(substr(published_date, 1, 4) as integer) between 1990 and 1999 group by 1""",
)
def _last_years(t):
    return summaries.assertions_last_10_years(t.assertions, 1999)


@register(
    "growth_per_day",
    """select day, added, cast(sum(added) over (order by day) as bigint) as total from
       (select cast(created as date) as day, count(*) as added from assertions group by 1)""",
)
def _growth(t):
    return summaries.growth_per_day(t.assertions)


@register(
    "facet_unique_counts",
    " union all ".join(
        f"select '{name}' as facet, count(distinct {column}) as unique_values from {table}"
        for name, column, table in [
            ("repository", "repository_id", "assertions"),
            ("publisher", "publisher_id", "assertions"),
            ("journal", "journal_id", "assertions"),
            ("source", "source_id", "assertions"),
            ("affiliations", "affiliation_id", "assertions_affiliations"),
            ("funders", "funder_id", "assertions_funders"),
            ("subjects", "subject_id", "assertions_subjects"),
        ]
    ),
)
def _facets(t):
    return summaries.facet_unique_counts(corpus_of(t))


def _summary_store(t):
    """Counted without the links of some sources, then given those and others twice, then rid of the surplus."""
    corpus = corpus_of(t)
    whole = {name: corpus.tables()[name] for name in live_summaries.COUNTED}
    late = F.coalesce(F.pmod(F.xxhash64("source_id"), F.lit(3)) == 0, F.lit(True))
    links = whole["assertions"]
    late_links = links.filter(late).select(F.col("id").alias("assertion_id")).distinct().withColumn("late", F.lit(True))
    first, added = {"assertions": links.filter(~late)}, {"assertions": links.filter(late)}
    for name, (column, _) in live_summaries.BRIDGES.items():
        # parted once for both
        parted = stored(whole[name].join(late_links, "assertion_id", "left").select(column, "late"))
        first[name], added[name] = parted.filter("late is null").select(column), parted.filter("late").select(column)
    wrong = {"assertions": links.filter(F.pmod(F.xxhash64("source_id"), F.lit(3)) == 1)}
    store = live_summaries.create_summary_store(first, _scratch(t), 64)
    store = live_summaries.refresh_summaries(store, {**added, **{"assertions": added["assertions"].unionByName(wrong["assertions"])}})
    return live_summaries.refresh_summaries(store, {}, wrong)


@register("assertions_last_10_years_refreshed", None)
def _last_years_refreshed(t):
    return live_summaries.assertions_last_10_years(_summary_store(t), 1999)


@register("growth_per_day_refreshed", None)
def _growth_refreshed(t):
    return live_summaries.growth_per_day(_summary_store(t))


@register("facet_unique_counts_refreshed", None)
def _facets_refreshed(t):
    return live_summaries.facet_unique_counts(_summary_store(t))


for _name in ("assertions_last_10_years", "growth_per_day", "facet_unique_counts"):
    ORACLES[f"{_name}_refreshed"] = ORACLES[_name]


from catalog import input_queries, rule_queries  # noqa: E402, F401  (they register more)
