"""Queries that run the fixed rules, as they are by default, over repositories they name."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.queries import DEDUPED, NOW, _pattern_case, register, sql_list, uuid_sql
from linkloom import rules
from linkloom.corpus import Corpus
from linkloom.operators import filters, updates
from linkloom.plans import accession, curate, tag_subjects


def ruled_corpus(t) -> Corpus:
    return Corpus(
        t.ruled_assertions,
        t.ruled_repositories,
        t.publishers,
        t.journals,
        t.sources,
        t.ruled_subjects,
        t.affiliations,
        t.funders,
        t.assertions_subjects,
        t.assertions_affiliations,
        t.assertions_funders,
    )


@register(
    "validate_accessions_by_default",
    f"""select a.repository_id, a.id, a.accession_number, r.title as repository_title, p.title as publisher_title,
        s.title as source_title, {_pattern_case(rules.ACCESSION_PATTERNS)} as accession_number_pattern_match
    from ruled_assertions a left join ruled_repositories r on r.id = a.repository_id
    left join publishers p on p.id = a.publisher_id left join sources s on s.id = a.source_id
    where a.source_id = '{rules.TEXT_MINED_SOURCE_ID}' and a.repository_id in ({sql_list(rules.ACCESSION_PATTERNS)})""",
)
def _validate(t):
    report = accession.validate_accessions(ruled_corpus(t))
    return report.select(
        "repository_id", "id", "accession_number", "repository_title", "publisher_title", "source_title", "accession_number_pattern_match"
    )


@register(
    "accession_counts_by_default",
    f"""select repository_id, accession_number, {_pattern_case(rules.ACCESSION_PATTERNS)} as matches, count(*) as n
    from ruled_assertions a group by all""",
)
def _counts(t):
    matches = accession.accession_matches(F.col("repository_id"), F.col("accession_number"), accession.accession_patterns())
    return t.ruled_assertions.groupBy("repository_id", "accession_number", matches.alias("matches")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "drop_trials_by_default",
    f"select id, repository_id from ruled_assertions where repository_id not in ({sql_list(rules.CLINICAL_TRIAL_REPOSITORIES)})",
)
def _trials(t):
    return filters.drop_repositories(t.ruled_assertions).select("id", "repository_id")


@register(
    "drop_excluded_by_default",
    f"""select id, repository_id, doi from ruled_assertions
    where not (repository_id in ({sql_list(rules.EXCLUDED_REPOSITORIES)}) and doi is null)""",
)
def _excluded(t):
    return filters.drop_excluded_without_doi(t.ruled_assertions).select("id", "repository_id", "doi")


_OLD, _NEW = next(iter(rules.MERGED_REPOSITORIES.items()))


@register(
    "merge_repositories_by_default",
    f"""select id, case when repository_id = '{_OLD}' then '{_NEW}' else repository_id end as repository_id from ruled_assertions
    union all select 'repository', id from ruled_repositories where id <> '{_OLD}'""",
)
def _merged(t):
    assertions, repositories = updates.merge_repositories(t.ruled_assertions, t.ruled_repositories)
    return assertions.select("id", "repository_id").union(repositories.select(F.lit("repository"), "id"))


_RULES = ", ".join(f"('{r}', '{s}')" for r, ss in rules.REPOSITORY_SUBJECTS.items() for s in ss)
_REQUIRED = ", ".join(f"('{s}')" for s in rules.REQUIRED_SUBJECTS)


@register(
    "tag_subjects_by_default",
    f"""with lowered as (select id, lower(title) as title from ruled_subjects),
    all_subjects as (select id, title from lowered
        union all select {uuid_sql("'subject'", "v.title")}, v.title from (values {_REQUIRED}) v(title)
        where v.title not in (select title from lowered)),
    wanted as (select a.id as assertion_id, s.id as subject_id
        from ruled_assertions a join (values {_RULES}) r(repository_id, title) on r.repository_id = a.repository_id
        join all_subjects s on s.title = r.title where a.created >= timestamp '{rules.CURRENT_INGEST_SINCE} 00:00:00')
    select id, type, created, updated, assertion_id, subject_id, inferred from assertions_subjects
    union all select {uuid_sql("'assertionSubject'", "w.assertion_id", "w.subject_id")}, 'assertionSubject',
        timestamp '{NOW}', timestamp '{NOW}', w.assertion_id, w.subject_id, false
    from wanted w where not exists (select 1 from assertions_subjects e
        where e.assertion_id = w.assertion_id and e.subject_id = w.subject_id)""",
)
def _tagged(t):
    return tag_subjects.tag_subjects(ruled_corpus(t), now=F.lit(NOW).cast("timestamp")).assertions_subjects


@register(
    "curate_by_default",
    f"""with {DEDUPED.replace("from assertions)", "from ruled_assertions)")}
    select * from deduped where (relation_type_id is null or relation_type_id in ({sql_list(rules.CITATION_RELATIONS)}))
        and repository_id not in ({sql_list(rules.CLINICAL_TRIAL_REPOSITORIES)})
        and not (repository_id in ({sql_list(rules.EXCLUDED_REPOSITORIES)}) and doi is null)
        and subj_id <> obj_id""",
)
def _curated(t):
    return curate.curate(ruled_corpus(t), excluded_repositories=rules.EXCLUDED_REPOSITORIES).corpus.assertions
