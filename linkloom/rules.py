"""Fixed values the curation rules depend on.

Everything below is plain data: identifiers, word lists and patterns that must have exactly these
values for results to come out right.  No logic lives here; operators take these as default
arguments, so another corpus can pass its own.
"""

from __future__ import annotations

# --- fixed values: relation types that count as a citation -----------------------------------
CITATION_RELATIONS = [
    "cites",
    "is-cited-by",
    "references",
    "is-referenced-by",
    "is-supplemented-by",
    "is-supplement-to",
]

# --- fixed values: source types and which end of the link is the dataset ---------------------
# subject = dataset, object = publication (a null source type counts as this too)
SUBJECT_IS_DATASET_SOURCE = "datacite-crossref"
# subject = publication, object = dataset
OBJECT_IS_DATASET_SOURCE = "crossref"

# --- fixed values: columns that make two assertions the same one ------------------------------
DEDUP_KEYS = [
    "obj_id",
    "subj_id",
    "repository_id",
    "publisher_id",
    "journal_id",
    "accession_number",
    "source_id",
]

# --- fixed values: repositories holding clinical-trial registrations -------------------------
CLINICAL_TRIAL_REPOSITORIES = [
    "fef75a3c-6e48-4170-be9d-415601efb689",
    "2638e611-ff6f-49db-9b3e-702ecd16176b",
]

# --- fixed values: repositories excluded unless the assertion has a DOI -----------------------
EXCLUDED_REPOSITORIES = [
    "583ce2c8-95fc-4033-bdf0-3884edf2d4d9",
    "fef75a3c-6e48-4170-be9d-415601efb689",
    "7109c7ca-dd40-4dfc-a883-c3bd2ad93ea5",
    "2638e611-ff6f-49db-9b3e-702ecd16176b",
    "a4855df9-755e-41d6-bddf-4589461e303c",
    "e387c003-d7e5-455d-b7b0-544e9251b1d0",
    "c2f38c5b-7a8b-4e95-a2db-5d5578570627",
    "b46c885e-c755-4b03-b443-d174aacc68f0",
    "ed99c2e4-de5a-41a1-8925-55f3daa88606",
    "0ccefa3f-5c25-4191-945e-715ce1816f57",
    "e8991e13-ba77-45cb-8254-675f35fb349e",
    "54753603-c263-4cc0-bd65-57c39b5a20f6",
]

# --- fixed values: duplicate repository -> the repository it is merged into ------------------
MERGED_REPOSITORIES = {
    "80a1d446-267a-4468-a474-b69a6242a2b7": "b2a4aa2b-db3f-456a-8e2b-7d935343385e",
}

# --- fixed values: external ids that stand for "no id", per organisation table ---------------
INVALID_EXTERNAL_IDS = {
    "affiliations": ["N/A", "null"],
    "funders": [
        "DOE BER/TES/ARM",
        "LANL - LDRD",
        "2016YFC0203302, 2016YFC0200404, 2016YFC0203300",
        "https://data.bris.ac.uk/datasets",
        "Grant agreement No 654109",
        "224308 (ARF)",
        "WFLUS008/12 (ARF) and WFLUS006/14 (ARF)",
        "W81XWH-10-1-0910 (MSB) and W81XWH-13-1-0297 (MSB)",
        "CO19772 (MSB and JCB)",
        "(BioSC)",
    ],
}

# --- fixed values: the source whose accession numbers are checked ----------------------------
TEXT_MINED_SOURCE_ID = "c66aafc0-cfd6-4bce-9235-661a4a7c6126"

# --- fixed values: accession-number pattern per repository ------------------------------------
ACCESSION_PATTERNS = {
    "00363b65-f3ef-4fa9-8255-23ab269f4930": r"^[A-Z]+[0-9]+(\.\d+)?$",
    "87646104-e5ef-494b-b2f3-a46c9572e003": r"^[0-9][A-Za-z0-9]{3}$",
    "6087b2e9-ecbf-4898-8047-5f484f1bce2f": r"^rs\d+$",
    "b2a4aa2b-db3f-456a-8e2b-7d935343385e": r"^G(PL|SM|SE|DS)\d+$",
    "1edec4bf-cfee-4296-8893-d1b0ca528f92": r"^(((WP|AC|AP|NC|NG|NM|NP|NR|NT|NW|XM|XP|XR|YP|ZP)_\d+)|(NZ\_[A-Z]{2,4}\d+))(\.\d+)?$",
    "58d689da-7c8c-4ac1-90c9-69253d28f81f": r"^([A-N,R-Z][0-9]([A-Z][A-Z, 0-9][A-Z, 0-9][0-9]){1,2})|([O,P,Q][0-9][A-Z, 0-9][A-Z, 0-9][A-Z, 0-9][0-9])(\.\d+)?$",
    "5f36c68f-bb46-4a21-9b95-6bb87de12aa0": r"^PRJ[DEN][A-Z]\d+$",
    "8d9c72f8-7b96-4b5c-86b0-b3f0dd7d0b0d": r"^((ENS[FPTG]\d{11}(\.\d+)?)|(FB\w{2}\d{7})|(Y[A-Z]{2}\d{3}[a-zA-Z](\-[A-Z])?)|([A-Z_a-z0-9]+(\.)?(t)?(\d+)?([a-z])?))$",
    "19ad31a7-e6d0-4547-ad14-1201d3c96dca": r"^PF\d{5}$",
    "524e4405-f959-4e3c-ab4e-eecaa8ed23d5": r"^[AEP]-\w{4}-\d+$",
    "1f463165-6957-491b-a1e1-e484540200f0": r"^\d+$",
    "79760077-45df-4626-9675-60ee459aa283": r"^GCA_[0-9]{9}(\.[0-9]+)?$",
    "b5966ef4-8bd3-4de8-aafb-396df8e75b0b": r"^EMD-\d{4,5}$",
    "8748538d-965e-4440-85cc-d9d1722e7ca9": r"^[A-Z]+[0-9]+$",
    "66807551-597e-4088-9743-32690481f6ff": r"^IPR\d{6}$",
    "b4440b59-ca28-4a67-a65f-2dc02fb0aa23": r"^phs[0-9]{6}(.v\d+.p\d+)?$",
    "f43825eb-5b72-4f1a-b716-dc7eec6d4206": r"^S-[A-Z]{4}[\-\_A-Z\d]+$",
    "c908c286-c01b-44c7-bac9-3bd53148d898": r"^[1-6]\.[0-9]+\.[0-9]+\.[0-9]+$",
    "345977e0-6fb8-476e-9742-0b8987e2fce8": r"^CPX-[0-9]+$",
    "0a60b1a9-041a-444e-bd6a-94caaab7591b": r"(^R-[A-Z]{3}-\d+(-\d+)?(\.\d+)?$)|(^REACT_\d+(\.\d+)?$)",
    "e387c003-d7e5-455d-b7b0-544e9251b1d0": r"^GO:\d{7}$",
    "a4855df9-755e-41d6-bddf-4589461e303c": r"^\d{7}$",
    "c82c6040-e644-4d94-a54f-97f0236c7147": r"^EBI\-[0-9]+$",
    "c56fbe18-f93b-478b-9674-00056bdeb887": r"^UPI[A-F0-9]{10}$",
    "d201d41a-2b84-4ebc-91a4-afab8c481944": r"^URS[0-9A-F]{10}(\_\d+)?$",
    "54753603-c263-4cc0-bd65-57c39b5a20f6": r"^ENSG\d{11}$",
    "e5960008-7a81-46b1-b526-d7dbea7e2c93": r"^((BIOMD|MODEL)\d{10})|(BMID\d{12})$",
    "d3ee57d1-bce4-437d-b054-e686d9abc727": r"^\d+$",
    "876f8718-c8b2-4d05-95ff-ab00ba6fa56b": r"^CHEMBL\d+$",
    "23b16007-328b-46a1-84ee-19cd32995091": r"^EGAD\d{11}$",
    "75800c1d-b982-4542-b996-033781f70fa1": r"^MTBLS\d+$",
    "ffe70f6b-6db0-402e-86b7-cc07bacbbdc8": r"^EMPIAR-\d{5,}",
    "0ccefa3f-5c25-4191-945e-715ce1816f57": r"^RF\d{5}$",
    "69bb4f86-1d75-487e-971a-f446a2ef0792": r"^\w{1,2}\d+$",
    "490f73dd-7532-453b-bd37-a96a566d60ba": r"^((HGNC|hgnc):)?\d{1,5}$",
}

# Repositories whose historic pattern had every backslash doubled (compat mode only).
DOUBLED_BACKSLASH_REPOSITORIES = [
    "e387c003-d7e5-455d-b7b0-544e9251b1d0",
    "a4855df9-755e-41d6-bddf-4589461e303c",
    "c82c6040-e644-4d94-a54f-97f0236c7147",
    "d201d41a-2b84-4ebc-91a4-afab8c481944",
    "54753603-c263-4cc0-bd65-57c39b5a20f6",
    "e5960008-7a81-46b1-b526-d7dbea7e2c93",
    "d3ee57d1-bce4-437d-b054-e686d9abc727",
    "876f8718-c8b2-4d05-95ff-ab00ba6fa56b",
    "23b16007-328b-46a1-84ee-19cd32995091",
    "75800c1d-b982-4542-b996-033781f70fa1",
    "ffe70f6b-6db0-402e-86b7-cc07bacbbdc8",
    "0ccefa3f-5c25-4191-945e-715ce1816f57",
    "69bb4f86-1d75-487e-971a-f446a2ef0792",
    "490f73dd-7532-453b-bd37-a96a566d60ba",
]

# --- fixed values: subjects that must exist before tagging -----------------------------------
REQUIRED_SUBJECTS = [
    "health biotechnology",
    "animal and dairy science",
    "basic medicine",
]

# --- fixed values: subjects every new assertion of a repository gets -------------------------
REPOSITORY_SUBJECTS = {
    "00363b65-f3ef-4fa9-8255-23ab269f4930": ["biological sciences", "basic medicine"],
    "6087b2e9-ecbf-4898-8047-5f484f1bce2f": ["biological sciences", "basic medicine"],
    "b2a4aa2b-db3f-456a-8e2b-7d935343385e": ["biological sciences", "basic medicine"],
    "1edec4bf-cfee-4296-8893-d1b0ca528f92": ["biological sciences", "basic medicine"],
    "58d689da-7c8c-4ac1-90c9-69253d28f81f": ["biological sciences", "basic medicine"],
    "5f36c68f-bb46-4a21-9b95-6bb87de12aa0": ["biological sciences", "basic medicine"],
    "8d9c72f8-7b96-4b5c-86b0-b3f0dd7d0b0d": ["biological sciences", "basic medicine", "animal and dairy science"],
    "31ffd918-669b-4d61-9470-784226277b5b": ["biological sciences", "basic medicine"],
    "19ad31a7-e6d0-4547-ad14-1201d3c96dca": ["biological sciences", "basic medicine"],
    "524e4405-f959-4e3c-ab4e-eecaa8ed23d5": ["biological sciences", "basic medicine"],
    "1f463165-6957-491b-a1e1-e484540200f0": ["basic medicine", "chemical sciences", "biological sciences"],
    "79760077-45df-4626-9675-60ee459aa283": ["biological sciences", "basic medicine"],
    "b5966ef4-8bd3-4de8-aafb-396df8e75b0b": ["biological sciences", "basic medicine"],
    "8748538d-965e-4440-85cc-d9d1722e7ca9": ["biological sciences", "basic medicine"],
    "66807551-597e-4088-9743-32690481f6ff": ["biological sciences", "basic medicine"],
    "b4440b59-ca28-4a67-a65f-2dc02fb0aa23": ["biological sciences", "basic medicine"],
    "f43825eb-5b72-4f1a-b716-dc7eec6d4206": ["biological sciences", "basic medicine"],
    "c908c286-c01b-44c7-bac9-3bd53148d898": ["biological sciences", "basic medicine"],
    "345977e0-6fb8-476e-9742-0b8987e2fce8": ["basic medicine", "chemical sciences", "biological sciences"],
    "0a60b1a9-041a-444e-bd6a-94caaab7591b": ["biological sciences", "basic medicine", "health biotechnology"],
    "876f8718-c8b2-4d05-95ff-ab00ba6fa56b": ["biological sciences", "basic medicine", "health biotechnology", "chemical sciences"],
    "23b16007-328b-46a1-84ee-19cd32995091": ["biological sciences", "basic medicine"],
    "7109c7ca-dd40-4dfc-a883-c3bd2ad93ea5": ["biological sciences", "basic medicine"],
    "75800c1d-b982-4542-b996-033781f70fa1": ["biological sciences", "basic medicine"],
    "4371937f-226a-4381-b07a-1ccc0085f0fd": ["biological sciences", "basic medicine"],
    "ffe70f6b-6db0-402e-86b7-cc07bacbbdc8": ["biological sciences", "basic medicine"],
    "0ccefa3f-5c25-4191-945e-715ce1816f57": ["biological sciences", "basic medicine"],
    "69bb4f86-1d75-487e-971a-f446a2ef0792": ["biological sciences", "basic medicine"],
    "490f73dd-7532-453b-bd37-a96a566d60ba": ["biological sciences", "basic medicine"],
    "e387c003-d7e5-455d-b7b0-544e9251b1d0": ["biological sciences", "basic medicine"],
    "a4855df9-755e-41d6-bddf-4589461e303c": ["basic medicine", "chemical sciences", "biological sciences"],
    "c82c6040-e644-4d94-a54f-97f0236c7147": ["biological sciences", "basic medicine"],
    "c56fbe18-f93b-478b-9674-00056bdeb887": ["biological sciences", "basic medicine"],
    "d201d41a-2b84-4ebc-91a4-afab8c481944": ["biological sciences", "basic medicine"],
    "54753603-c263-4cc0-bd65-57c39b5a20f6": ["biological sciences", "basic medicine"],
    "e5960008-7a81-46b1-b526-d7dbea7e2c93": ["biological sciences", "basic medicine"],
    "87646104-e5ef-494b-b2f3-a46c9572e003": ["biological sciences", "basic medicine", "physical sciences", "chemical sciences"],
    "d3ee57d1-bce4-437d-b054-e686d9abc727": ["basic medicine", "chemical sciences", "biological sciences"],
    "9c0f9579-4f8d-4563-a35f-72cb536050e8": ["biological sciences"],
    "93e2edcd-ce4b-4370-8d2f-1771a578dace": ["biological sciences", "basic medicine"],
    "f99f9396-1377-4423-8165-6731ba593ddf": ["biological sciences", "basic medicine"],
}

# --- fixed values: text-mined files that are not ingested ------------------------------------
EXCLUDED_FEEDS = [
    "cellosaurus",
    "chebi",
    "ebisc",
    "eudract",
    "hipsci",
    "nct",
    "omim",
    "rrid",
]

# --- fixed values: repository code -> display name -------------------------------------------
REPOSITORY_NAMES = {
    "alphafold": "AlphaFold Protein Structure Database",
    "arrayexpress": "ArrayExpress",
    "bia": "BioImage Archive",
    "biomodels": "BioModels",
    "bioproject": "BioProject",
    "biosample": "BioSample",
    "biostudies": "BioStudies",
    "brenda": "BRENDA Enzyme Database",
    "cath": "CATH",
    "chembl": "ChEMBL",
    "complexportal": "Complex Portal (CP)",
    "dbgap": "NCBI dbGaP (DataBase of Genotypes And Phenotypesgenotypes and phenotypes)",
    "efo": "Experimental Factor Ontology",
    "ega": "The European Genome-phenome Archive(EGA)",
    "emdb": "The Electron Microscopy Data Bank (EMDB)",
    "empiar": "Electron Microscopy Public Image Archive (EMPIAR)",
    "ensembl": "Ensembl",
    "gca": "Genome assembly database",
    "gen": "European Nucleotide Archive",
    "geo": "Gene Expression Omnibus",
    "gisaid": "GISAID",
    "go": "Gene Ontology",
    "hgnc": "HUGO Gene Nomenclature Committee",
    "hpa": "The Human Protein Atlas",
    "igsr": "The International Genome Sample Resource",
    "intact": "IntAct",
    "interpro": "InterPro",
    "metabolights": "MetaboLights",
    "metagenomics": "MGnify",
    "mint": "Molecular INTeraction Database",
    "orphadata": "Orphadata",
    "pdb": "The Protein Data Bank",
    "pfam": "Pfam Protein Families",
    "pxd": "PRIDE Proteomics Identification Database",
    "reactome": "Reactome",
    "refseq": "NCBI Reference Sequence Database",
    "refsnp": "dbSNP Reference SNP",
    "rfam": "Rfam",
    "rhea": "Rhea",
    "rnacentral": "RNAcentral",
    "treefam": "TreeFam",
    "uniparc": "UniParc",
    "uniprot": "UniProt",
}

# --- fixed values: rows newer than this belong to the current ingest -------------------------
CURRENT_INGEST_SINCE = "2025-07-01"
