"""Corpus tables derived from the given test tables, in SQL both Spark and DuckDB read alike.

Each entry is one SELECT over the given tables (or over tables derived before it).  Spark runs
it with the Parquet files, DuckDB takes the same text as a common table expression.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from linkloom import rules

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DIRECT = rules.SUBJECT_IS_DATASET_SOURCE
SWAPPED = rules.OBJECT_IS_DATASET_SOURCE


def _named(name: str, prefix: str, modulus: int) -> str:
    n = f"(c_custkey % {modulus})"
    return f"""
        select distinct '{prefix}-' || cast({n} as string) as id,
               '{name} ' || cast({n} as string) as title,
               case when {n} % 3 = 0 then null else 'ext-' || cast({n} as string) end as external_id
        from customer"""


DERIVED = {
    "assertions": f"""
        select 'a-' || lpad(cast(o_orderkey as string), 9, '0') as id,
               'assertion' as type,
               o_orderdate as created,
               case when o_orderkey % 50 = 0 then null else o_orderdate end as updated,
               'act-' || cast(o_orderkey % 100 as string) as activity_id,
               case when o_custkey % 17 = 0 then null
                    else 'repo-' || cast(o_custkey % 12 as string) end as repository_id,
               'pub-' || cast(o_custkey % 7 as string) as publisher_id,
               case when o_custkey % 5 = 0 then null
                    else 'jrn-' || cast(o_custkey % 9 as string) end as journal_id,
               case o_orderkey % 4 when 0 then '{SWAPPED}' when 3 then null
                    when 2 then '{DIRECT}'
                    else case when o_orderkey % 7 = 0 then 'other' else '{DIRECT}' end end as source_type,
               case when o_orderkey % 8 = 0 then null
                    else 'Link "' || cast(o_orderkey as string) || '", part' end as title,
               case when o_custkey % 23 = 0 then '10.5061/d' || cast(o_custkey % 30 as string)
                    when o_custkey % 29 = 0 then null
                    else '10.1029/p' || cast(o_custkey as string) end as obj_id,
               case o_custkey % 6
                    when 0 then 'https://doi.org/10.5061/d' || cast(o_custkey % 30 as string)
                    when 1 then 'doi.org/10.5061/d' || cast(o_custkey % 30 as string)
                    when 2 then '10.5061/d' || cast(o_custkey % 30 as string)
                    when 3 then '//doi.org/10.5061/d' || cast(o_custkey % 30 as string)
                    when 4 then '  10.5061/d' || cast(o_custkey % 30 as string) || ' '
                    else 'GSE' || cast(o_custkey % 30 as string) end as subj_id,
               cast(cast(o_orderdate as date) as string) as published_date,
               case when o_custkey % 3 = 0 then null
                    when o_orderkey % 10 = 0 then 'BAD ' || cast(o_orderkey as string)
                    else 'GSE' || cast(o_orderkey % 100 as string) end as accession_number,
               case when o_custkey % 4 = 0 then null
                    else '10.5061/d' || cast(o_custkey % 30 as string) end as doi,
               case o_orderkey % 9 when 0 then 'cites' when 1 then 'is-cited-by' when 2 then 'references'
                    when 3 then 'is-referenced-by' when 4 then 'is-supplemented-by'
                    when 5 then 'is-supplement-to' when 6 then 'is-part-of'
                    when 7 then 'is-identical-to' else null end as relation_type_id,
               'src-' || cast(o_custkey % 2 as string) as source_id,
               o_orderkey % 13 = 0 as not_found,
               o_orderkey % 2 = 0 as retried
        from orders""",
    "repositories": _named("Repository", "repo", 12),
    "publishers": _named("Publisher", "pub", 7),
    "journals": _named("Journal", "jrn", 9),
    "sources": """
        select distinct 'src-' || cast(c_custkey % 2 as string) as id,
               's' || cast(c_custkey % 2 as string) as abbreviation,
               'Source ' || cast(c_custkey % 2 as string) as title
        from customer""",
    "affiliations": """
        select 'aff-' || lpad(cast(s_suppkey as string), 6, '0') as id,
               case s_suppkey % 10
                    when 0 then '@org' || cast(s_suppkey as string) || ' / @lab'
                    when 1 then 'Inst ' || cast(s_suppkey as string) || ', a.b@x.org'
                    when 2 then 'Electronic address: Dept ' || cast(s_suppkey as string)
                    when 3 then '(Lab ' || cast(s_suppkey as string) || ')'
                    when 4 then '..; Centre  ' || cast(s_suppkey as string)
                    when 5 then 'Institut de Recherche ' || cast(s_suppkey as string) || ' ., '
                    when 6 then ' National Foundation'
                    when 7 then 'University ' || cast(s_suppkey % 20 as string)
                    when 8 then null
                    else 'Plain ' || cast(s_suppkey as string) end as title,
               case s_suppkey % 9
                    when 0 then 'https://ror.org/01abcde23'
                    when 1 then 'grid.' || cast(s_suppkey as string) || '.1'
                    when 2 then '0000 0001 2345 6789'
                    when 3 then '10.13039/100000001'
                    when 4 then ' N/A '
                    when 5 then '01abcde23'
                    when 6 then 'http://isni.org/0000000123456789'
                    when 7 then '' else null end as external_id,
               case when s_suppkey % 11 = 5 then 'https://ror.org/09preset1' else null end as ror_id,
               case when s_suppkey % 11 = 5 then 'Preset ' || cast(s_suppkey as string) else null end as ror_name,
               'affiliation' as type,
               case when s_suppkey % 4 = 3 then cast('2024-01-01 00:00:00' as timestamp)
                    else cast('2025-08-01 00:00:00' as timestamp) end as created
        from supplier""",
    "funders": """
        select 'fun-' || cast(c_custkey as string) as id,
               ' ' || c_mktsegment || ' Fund ' || cast(c_custkey as string) || ';' as title,
               case when c_custkey % 2 = 0 then null
                    else '10.13039/' || cast(c_custkey as string) end as external_id,
               cast(null as string) as ror_id,
               cast(null as string) as ror_name,
               'funder' as type,
               cast('2025-08-01 00:00:00' as timestamp) as created
        from customer""",
    "subjects": """
        select distinct 'sub-' || lower(p_type) as id, p_type as title, 'subject' as type,
               cast('2024-01-01 00:00:00' as timestamp) as created,
               cast('2024-01-01 00:00:00' as timestamp) as updated
        from part""",
    "assertions_subjects": """
        select distinct 'as-' || cast(l_orderkey as string) || '-' || lower(p_type) as id,
               'assertionSubject' as type,
               cast('2024-01-01 00:00:00' as timestamp) as created,
               cast('2024-01-01 00:00:00' as timestamp) as updated,
               'a-' || lpad(cast(l_orderkey as string), 9, '0') as assertion_id,
               'sub-' || lower(p_type) as subject_id,
               false as inferred
        from lineitem join part on l_partkey = p_partkey
        where p_type <> 'PROMO'""",
    "assertions_affiliations": """
        select distinct 'aa-' || cast(l_orderkey as string) || '-' || cast(l_suppkey as string) as id,
               'a-' || lpad(cast(l_orderkey as string), 9, '0') as assertion_id,
               'aff-' || lpad(cast(l_suppkey as string), 6, '0') as affiliation_id,
               'assertionAffiliation' as type
        from lineitem join supplier on l_suppkey = s_suppkey where s_acctbal > 1000""",
    "assertions_funders": """
        select 'a-' || lpad(cast(o_orderkey as string), 9, '0') as assertion_id,
               'fun-' || cast(o_custkey as string) as funder_id
        from orders join customer on o_custkey = c_custkey
        where o_orderpriority in ('1-URGENT', '2-HIGH') and c_acctbal > 1000""",
    "removal_ids": """
        select 'a-' || lpad(cast(o_orderkey as string), 9, '0') as assertion_id
        from orders where o_orderstatus = 'P' and o_orderpriority = '1-URGENT'""",
    "title_updates": """
        select 'a-' || lpad(cast(o_orderkey as string), 9, '0') as id,
               case when o_orderkey % 20 = 0 then null
                    else 'Renamed ' || cast(o_orderkey as string) end as title
        from orders where o_orderpriority = '2-HIGH'""",
    "textmined": """
        select case l_suppkey % 4 when 0 then 'geo' when 1 then 'pdb' when 2 then 'doi'
                    else 'unknownrepo' end as repo_code,
               case when l_suppkey % 4 = 2 then '10.5061/d' || cast(l_partkey % 30 as string)
                    else ' GSE' || cast(l_partkey as string) end as accession,
               case when l_linenumber = 7 then '' else 'PMC' || cast(l_orderkey as string) end as pmcid
        from lineitem""",
    "crosswalk": """
        select 'PMC' || cast(o_orderkey as string) as pmcid,
               case when o_custkey % 7 = 0 then 'doi:10.1029/p' || cast(o_custkey as string)
                    else '10.1029/p' || cast(o_custkey as string) end as doi
        from orders where o_orderpriority <> '5-LOW'""",
    "lookup_cache": """
        select 'PMC' || cast(o_orderkey as string) as pmcid,
               'https://doi.org/10.9999/' || cast(o_orderkey as string) as doi_url
        from orders where o_orderstatus = 'P'""",
    "fetched_cache": """
        select 'PMC' || cast(o_orderkey as string) as pmcid,
               'https://doi.org/10.7777/' || cast(o_orderkey as string) as doi_url
        from orders where o_orderpriority = '3-MEDIUM'""",
    "doi_publishers": """
        select distinct '10.5061/d' || cast(p_size as string) as doi,
               'Publisher of ' || cast(p_size as string) as publisher
        from part""",
    "event_links": """
        select distinct 'https://doi.org/10.1029/A' || cast(l_orderkey as string) as subj_id,
               'https://doi.org/10.5061/d' || cast(l_partkey % 30 as string) as obj_id,
               case when l_returnflag = 'R' then 'is-part-of' else 'references' end as relation_type_id
        from lineitem where l_linestatus = 'O'
        union all
        select distinct 'https://doi.org/10.5061/d' || cast(l_partkey % 30 as string) as subj_id,
               'https://doi.org/10.1029/a' || cast(l_orderkey as string) as obj_id,
               'is-referenced-by' as relation_type_id
        from lineitem where l_linestatus = 'F'""",
    "report_pairs": """
        select distinct '10.1029/a' || cast(l_orderkey as string) as article_doi,
               '10.5061/D' || cast(l_partkey % 30 as string) as dataset_doi
        from lineitem""",
    "review": """
        select case when s_suppkey % 3 = 0 then 'a-' || lpad(cast(s_suppkey * 7 as string), 9, '0')
                    else ' 10.5061/d' || cast(s_suppkey % 30 as string) end as dataset,
               case when s_suppkey % 2 = 0 then 'Plain ' || cast(s_suppkey + 9 as string)
                    else 'New Org ' || cast(s_suppkey % 40 as string) end as m1_name,
               'https://ror.org/1' || cast(s_suppkey as string) as m1_id,
               case s_suppkey % 4 when 0 then 'TRUE' when 3 then null else 'FALSE' end as m1_chosen,
               'Second Org ' || cast(s_suppkey % 50 as string) as m2_name,
               'https://ror.org/2' || cast(s_suppkey as string) as m2_id,
               case when s_suppkey % 6 = 0 or s_suppkey % 7 = 1 then 'True ' else 'FALSE' end as m2_chosen,
               'Third Org' as m3_name,
               'https://ror.org/3' || cast(s_suppkey as string) as m3_id,
               'FALSE' as m3_chosen
        from supplier""",
    "registry": """
        select case when s_suppkey = 0 then 'https://ror.org/01abcde23'
                    else 'https://ror.org/0' || lpad(cast(s_suppkey as string), 8, '0') end as ror_id,
               case s_suppkey % 10
                    when 9 then 'Plain ' || cast(s_suppkey as string)
                    when 7 then 'UNIVERSITY, ' || cast(s_suppkey % 20 as string)
                    when 3 then 'Lab ' || cast(s_suppkey as string)
                    else 'Research Institute ' || cast(s_suppkey as string) end as name,
               split('Inst ' || cast(s_suppkey as string) || ';Building Fund '
                     || cast(s_suppkey as string) || ';Trust Fund of Household '
                     || cast(s_suppkey as string) || ';Household Fund '
                     || cast(s_suppkey as string) || ' Trust;Recherche Institut', ';') as aliases,
               split('grid.' || cast(s_suppkey as string) || '.1;'
                     || case when s_suppkey % 50 = 3 then '100000001'
                             when s_suppkey % 60 = 5 then '0000000123456789' else '' end, ';') as external_ids
        from supplier""",
    "paper_lines": """
        select case when o_orderkey % 101 = 0 then '{"DOI": "10.1029/broken'
               else '{"type":"journal-article"'
                    || case when o_orderkey % 20 = 0 then ''
                            else ',"DOI":"10.1029/p' || cast(o_custkey as string) || '"' end
                    || case o_orderkey % 4
                            when 0 then ',"container-title":["Journal ' || cast(o_custkey % 9 as string) || '","Alt"]'
                            when 1 then ',"container-title":"Journal ' || cast(o_custkey % 9 as string) || '"'
                            when 2 then ',"container-title":[]' else '' end
                    || case when o_orderkey % 6 = 0 then ''
                            else ',"publisher":"Publisher ' || cast(o_custkey % 13 as string) || '"' end
                    || case o_orderkey % 5
                            when 0 then ',"published":{"date-time":"' || cast(cast(o_orderdate as date) as string)
                                        || 'T00:00:00Z","date-parts":[[1990]]}'
                            when 1 then ',"published":{"date-parts":[[' || cast(year(o_orderdate) as string) || ','
                                        || cast(month(o_orderdate) as string) || ','
                                        || cast(day(o_orderdate) as string) || ']]}'
                            when 2 then ',"published":{"date-parts":[[' || cast(year(o_orderdate) as string) || ','
                                        || cast(month(o_orderdate) as string) || ']]}'
                            when 3 then ',"published":{"date-parts":[[' || cast(year(o_orderdate) as string) || ']]}'
                            else case o_orderkey % 35 when 4 then ',"published":[]'
                                     when 9 then ',"published":{"date-parts":[["' || cast(year(o_orderdate) as string) || '"]]}'
                                     when 14 then ',"published":"soon"'
                                     when 19 then ',"published":{"date-parts":[["' || cast(year(o_orderdate) as string) || '","7"]]}'
                                     else '' end end
                    || '}' end as value
        from orders""",
}

# Accession numbers that fit and that do not, for each pattern in the order of the rules.
SAMPLES = [
    ["AB123.1", "123AB"],
    ["1abc", "abcd"],
    ["rs123", "rs"],
    ["GSE123", "GXX1"],
    ["NM_000123.4", "NZ_ABCD123", "QQ_1"],
    ["A0B123", "P12345", "B"],
    ["PRJNA123", "PRJXA1"],
    ["ENSG00000000001", "EN SG"],
    ["PF00001", "PF1"],
    ["E-MTAB-123", "X-MTAB-1"],
    ["123", "12a"],
    ["GCA_000001405.28", "GCA_1"],
    ["EMD-1234", "EMD-1"],
    ["ABC123", "abc"],
    ["IPR000001", "IPR1"],
    ["phs000001.v1.p1", "phs1"],
    ["S-EPMC-12_A", "S-EP"],
    ["1.1.1.1", "7.1.1.1"],
    ["CPX-12", "CPX12"],
    ["R-HSA-123.4", "REACT_12", "R-HS-1"],
    ["GO:0000001", "GO:1"],
    ["1234567", "123"],
    ["EBI-123", "EBI123"],
    ["UPI0000000001", "UPI1"],
    ["URS0000000001_9606", "URS1"],
    ["ENSG00000000001", "ENSG1"],
    ["BIOMD0000000001", "BMID000000000001", "BIOMD1"],
    ["77", "7b"],
    ["CHEMBL25", "CHEMBLX"],
    ["EGAD00000000001", "EGAD1"],
    ["MTBLS1", "MTBL1"],
    ["EMPIAR-10001", "EMPIAR-1"],
    ["RF00001", "RF1"],
    ["A12", "ABC1"],
    ["HGNC:5", "HGNC:123456"],
]
_SAMPLE_ROWS = [(repository, sample) for repository, samples in zip(rules.ACCESSION_PATTERNS, SAMPLES) for sample in samples]
_SAMPLE_ROWS += [
    (repository, None)
    for repository in dict.fromkeys([*rules.CLINICAL_TRIAL_REPOSITORIES, *rules.EXCLUDED_REPOSITORIES, *rules.MERGED_REPOSITORIES])
]
_SAMPLE_VALUES = ", ".join(
    f"({n}, '{repository}', " + ("cast(null as string))" if sample is None else f"'{sample}')")
    for n, (repository, sample) in enumerate(_SAMPLE_ROWS)
)

DERIVED |= {
    # the corpus under the real rules: repositories, accession numbers, subjects
    "rule_samples": f"select * from (values {_SAMPLE_VALUES}) as v(n, repository_id, accession_number)",
    "ruled_assertions": f"""
        select a.id, a.type,
               case when s.n % 2 = 0 then cast('2025-08-01 00:00:00' as timestamp) else a.created end as created,
               a.updated, a.activity_id, s.repository_id, a.publisher_id, a.journal_id, a.source_type, a.title,
               a.obj_id, a.subj_id, a.published_date, s.accession_number, a.doi, a.relation_type_id,
               case when cast(substr(a.id, 3) as bigint) % 7 = 0 then a.source_id
                    else '{rules.TEXT_MINED_SOURCE_ID}' end as source_id,
               a.not_found, a.retried
        from assertions a join rule_samples s on cast(substr(a.id, 3) as bigint) % {len(_SAMPLE_ROWS)} = s.n""",
    "ruled_repositories": """
        select distinct repository_id as id, 'Repository ' || substr(repository_id, 1, 8) as title,
               cast(null as string) as external_id
        from rule_samples""",
    "ruled_subjects": """
        select id, title, type, created, updated from subjects
        union all select 'sub-rule-' || cast(n_nationkey as string) as id,
               case n_nationkey when 0 then 'Biological Sciences' when 1 then 'Chemical Sciences' else 'Basic Medicine' end as title,
               'subject' as type, cast('2024-01-01 00:00:00' as timestamp) as created,
               cast('2024-01-01 00:00:00' as timestamp) as updated
        from nation where n_nationkey < 3""",
    # raw rows of input files
    "removal_lines": """
        select ' a-' || lpad(cast(o_orderkey as string), 9, '0') || chr(13) as assertion_id,
               case o_custkey % 3 when 0 then '345977e0-remove.csv' when 1 then 'c2f3 8c5b-remove-ids-remove.csv'
                    else 'notes.csv' end as file
        from orders where o_orderstatus = 'P'""",
    "raw_feed": """
        select case l_suppkey % 5 when 0 then 'geo.csv' when 1 then 'nct.csv' when 2 then 'PMID_PMCID_DOI.csv'
                    when 3 then 'pdb.v2.csv' else 'rrid.csv' end as file,
               case when l_linenumber = 3 then '' else ' GSE' || cast(l_partkey as string) || chr(10) end as accession,
               case when l_linenumber = 5 then null else chr(9) || 'PMC' || cast(l_orderkey as string) end as pmcid
        from lineitem""",
    "raw_crosswalk": """
        select cast(o_custkey as string) as pmid,
               case when o_orderkey % 11 = 0 then ' ' else ' PMC' || cast(o_orderkey as string) || ' ' end as pmcid,
               case when o_orderkey % 13 = 0 then null else '10.1029/p' || cast(o_custkey as string) || chr(13) end as doi
        from orders""",
    "name_texts": """
        select '{"n' || cast(n_nationkey as string) || '": "' || n_name || '", "m' || cast(n_nationkey as string)
               || '" : "Name, of ' || cast(n_nationkey as string) || '"}' as value
        from nation""",
    "report_texts": """
        select '10.1029/a' || cast(o_orderkey as string) as article_doi,
               case o_orderkey % 4 when 0 then '[]' when 1 then null
                    when 2 then '["10.5061/d' || cast(o_custkey % 30 as string) || '"]'
                    else '["10.5061/d' || cast(o_custkey % 30 as string) || '", "10.5061/e' || cast(o_custkey as string) || '" , ]'
               end as cited
        from orders""",
    "raw_keys": """
        select c_custkey as n, case c_custkey % 3 when 0 then 'PMC' else '' end || cast(c_custkey as string) as pmcid,
               case c_custkey % 4 when 0 then md5(cast(c_custkey as string))
                    when 1 then 'C56FBE18-f93b-478b-9674-' || lpad(cast(c_custkey as string), 12, '0')
                    when 2 then 'c56fbe18-f93b-478b-9674-00056bdeb887' || chr(10)
                    else 'c56fbe18-f93b-478b-9674-' || lpad(cast(c_custkey as string), 12, 'a') end as key
        from customer""",
    "review_lines": """
        select '"10.1/' || cast(s_suppkey as string) || '", "Org, ' || cast(s_suppkey as string) || '",  r1 ,TRUE,B' || cast(s_suppkey as string)
               || ',r2,' || case when s_suppkey % 2 = 0 then 'FALSE' else '' end || ',"say ""x"" ",r3,FALSE' as value
        from supplier""",
}

_WORD = re.compile(r"[a-z_0-9]+")


def needed(sql: str) -> list[str]:
    """Derived tables a statement reads, those they read first."""
    found: list[str] = []
    for word in dict.fromkeys(_WORD.findall(sql.lower())):
        if word in DERIVED:
            for name in [*needed(DERIVED[word].replace(word, "")), word]:
                if name not in found:
                    found.append(name)
    return found


def oracle(sql: str) -> str:
    """A statement over derived tables as one DuckDB statement over the given ones."""
    names = needed(sql)
    tables = ",\n".join(f"{name} as ({DERIVED[name]}\n)" for name in names)
    body = sql.strip()
    if not tables:
        return body
    if body.lower().startswith("with "):
        return f"with {tables},\n{body[5:]}"
    return f"with {tables}\n{body}"


class Tables:
    """Given and derived tables of one scale factor as attributes, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in DERIVED:
            table = self._kept(name, self._derive(DERIVED[name]))
        else:
            raise AttributeError(name)
        setattr(self, name, table)
        return table

    def _kept(self, name: str, table: DataFrame) -> DataFrame:
        return table

    def _derive(self, sql: str) -> DataFrame:
        """The table of one statement, not yet computed."""
        names = (*GIVEN, *DERIVED)
        used = {name: getattr(self, name) for name in names if re.search(rf"\b(from|join) {name}\b", sql)}
        text = sql.replace("{", "{{").replace("}", "}}")
        for given in used:
            text = re.sub(rf"\b(from|join) {given}\b", rf"\1 {{{given}}}", text)
        return self.spark.sql(text, **used)


class StoredTables(Tables):
    """Derived tables written to ``folder`` when first asked for, and read from there."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str):
        super().__init__(spark, sf_dir)
        self.folder = folder

    def _kept(self, name: str, table: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        table.write.parquet(path)
        return self.spark.read.parquet(path)
