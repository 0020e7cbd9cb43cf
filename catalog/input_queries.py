"""Queries for the half of each reader that turns raw rows into tables, and for lookups with repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.queries import (
    CANDIDATES,
    CHUNK,
    DETAILS_JOINS,
    NAMED_ENDS,
    ORACLES,
    ORG_KEYS,
    REGISTRY,
    _matched,
    corpus_of,
    register,
    sql_list,
)
from linkloom import rules
from linkloom.functions.identifiers import is_uuid, with_pmc_prefix
from linkloom.operators import updates
from linkloom.operators.numbering import number_rows
from linkloom.plans import details, export, ingest, papers, reconcile
from linkloom.sinks import files as sinks
from linkloom.sources import files as sources

BLANK = r"^\s+|\s+$"


def _strip(column: str) -> str:
    return f"regexp_replace({column}, '{BLANK}', '', 'g')"


@register(
    "removal_rows",
    f"""select {_strip("assertion_id")} as assertion_id, regexp_extract(file, '^(.+?)-remove', 1) as repository_id
    from removal_lines""",
)
def _removal_rows(t):
    return sources.removal_rows(t.removal_lines)


@register(
    "feed_rows",
    f"""select split_part(file, '.', 1) as repo_code, {_strip("accession")} as accession, {_strip("pmcid")} as pmcid
    from raw_feed where file <> 'PMID_PMCID_DOI.csv' and split_part(file, '.', 1) not in ({sql_list(rules.EXCLUDED_FEEDS)})
        and accession <> '' and pmcid <> ''""",
)
def _feed_rows(t):
    return sources.feed_rows(t.raw_feed)


@register(
    "crosswalk_rows",
    f"""select * from (select {_strip("pmcid")} as pmcid, {_strip("doi")} as doi from raw_crosswalk)
    where pmcid <> '' and doi <> ''""",
)
def _crosswalk_rows(t):
    return ingest.usable_crosswalk(t.raw_crosswalk)


@register(
    "name_rows",
    """select 'n' || cast(n_nationkey as string) as repo_code, n_name as name from nation
    union all select 'm' || cast(n_nationkey as string), 'Name, of ' || cast(n_nationkey as string) from nation""",
)
def _name_rows(t):
    return sources.name_rows(t.name_texts)


@register(
    "review_rows",
    """select '10.1/' || cast(s_suppkey as string) as dataset, 'Org, ' || cast(s_suppkey as string) as m1_name,
        'B' || cast(s_suppkey as string) as m2_name, case when s_suppkey % 2 = 0 then 'FALSE' end as m2_chosen,
        'say "x" ' as m3_name, 'r3' as m3_id from supplier""",
)
def _review_rows(t):
    names = {"Dataset": "dataset", "Match 1 Name": "m1_name", "Match 2 Name": "m2_name", "Match 2 Chosen": "m2_chosen"}
    names |= {"Match 3 Name": "m3_name", "Match 3 ID": "m3_id"}
    rows = sources.review_rows(t.review_lines)
    return rows.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


@register(
    "citation_lists",
    """select '10.1029/a' || cast(o_orderkey as string) as article_doi,
        case o_orderkey % 4 when 2 then '10.5061/d' || cast(o_custkey % 30 as string)
             when 3 then '10.5061/d' || cast(o_custkey % 30 as string) || '|10.5061/e' || cast(o_custkey as string)
             else '' end as cited, cast(greatest(o_orderkey % 4 - 1, 0) as integer) as n
    from orders""",
)
def _citation_lists(t):
    cited = sources.citation_list(F.coalesce("cited", F.lit("")))
    return t.report_texts.select("article_doi", F.array_join(cited, "|").alias("cited"), F.size(cited).alias("n"))


@register(
    "dump_records",
    f"""with {NAMED_ENDS} select a.id, a.created, a.title, a.dataset, a.publication, a.published_date,
        r.title as repository, s.abbreviation as source from named_ends a {DETAILS_JOINS}""",
)
def _dump_records(t):
    corpus = corpus_of(t, named_ends=True)
    numbered = number_rows(corpus.assertions, "id", CHUNK)
    chunked = export.with_chunks(details.assertion_details_formatted(corpus), numbered)
    back = sources.dump_records(sinks.json_lines(chunked, numbered, CHUNK).select("value"))
    return back.select(
        "id", "created", "title", "dataset", "publication", F.col("publishedDate").alias("published_date"),
        F.col("repository.title").alias("repository"), "source",
    )


@register("ensure_columns", "select id, cast(null as string) as ror_id, ror_name from affiliations")
def _ensure_columns(t):
    return updates.ensure_columns(t.affiliations.drop("ror_id"), ("ror_id", "ror_name")).select("id", "ror_id", "ror_name")


@register(
    "key_forms",
    """select n, case when starts_with(pmcid, 'PMC') then pmcid else 'PMC' || pmcid end as pmcid,
        regexp_full_match(lower(key), '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}') as is_uuid from raw_keys""",
)
def _key_forms(t):
    return t.raw_keys.select("n", with_pmc_prefix(F.col("pmcid")).alias("pmcid"), is_uuid(F.col("key")).alias("is_uuid"))


@register(
    "bad_lines_by_file",
    """select 'file-' || cast(length(value) % 3 as string) as file, count(*) as bad_lines from paper_lines
    where not json_valid(value) group by all""",
)
def _bad_lines(t):
    file = F.concat(F.lit("file-"), (F.length("value") % 3).cast("string"))
    return papers.count_bad_lines(papers.parse_papers(t.paper_lines.withColumn("file", file))[1])


# --- lookups that repeat a key -------------------------------------------------------------------------


@register(
    "update_from_repeats",
    """with twice as (select id, title from title_updates union all select id, 'A first title' from title_updates),
    one as (select id, max(title) as title from twice group by id)
    select a.id, case when u.id is not null then u.title else a.title end as title
    from assertions a left join one u on u.id = a.id""",
)
def _update_repeats(t):
    twice = t.title_updates.unionByName(t.title_updates.withColumn("title", F.lit("A first title")))
    return updates.update_from(t.assertions, twice, "id", ["title"]).select("id", "title")


@register(
    "reconcile_by_id_repeats",
    f"""with {REGISTRY}, {ORG_KEYS} select o.id, r.ror_id, least(r.name, 'Middle') as name from searched o
        join reg_by_id r on r.k = o.norm where starts_with(o.norm, 'https://ror.org/')""",
)
def _by_id_repeats(t):
    twice = t.registry.unionByName(t.registry.withColumn("name", F.lit("Middle")))
    found = _matched(t, "_id_key", reconcile.by_id(twice), "_by_id")
    return found.filter(F.col("_normalized").startswith("https://ror.org/")).select("id", "ror_id", "name")


@register("enrich_papers_repeats", None)
def _enrich_repeats(t):
    unreduced, _ = papers.parse_papers(t.paper_lines)
    done = papers.enrich_papers(t.assertions.select("id", "obj_id"), unreduced, on="obj_id")
    return done.select("id", "obj_id", "paper_journal", "paper_publisher", "paper_published_date")


ORACLES["enrich_papers_repeats"] = ORACLES["enrich_papers"]

LOW_SCORE = 0.4


@register(
    "candidate_matches_low_score",
    f"with {CANDIDATES.replace('score >= 0.0', f'score >= {LOW_SCORE}')} select set_key, ror_id, name, score, cast(rank as integer) as rank from ranked where rank <= 3",
)
def _low_candidates(t):
    return reconcile.candidate_matches(reconcile.unresolved_orgs(t.affiliations, t.funders), t.registry, LOW_SCORE)
