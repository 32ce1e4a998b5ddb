"""Explicit schemas of all tables; nothing is ever inferred."""




REFERENCE = "struct<ref_id:string,pmid:bigint,doi:string,title:string,journal:string,year:int,raw:string>"
CITATION = "struct<ref_ids:array<string>,sentence:string,section:string,paragraph_idx:int,in_table:boolean,in_fig:boolean>"
ARTICLE = f"pmcid string, pmid bigint, doi string, title string, journal string, year int, license string, n_refs int, n_citations int, references array<{REFERENCE}>, citations array<{CITATION}>, subset string, source_xml string"

PUBMED_SOURCE = (
    "pmid string, article_ids array<struct<id_type:string,value:string>>, title string, abstract array<struct<label:string,text:string>>, "
    "journal struct<title:string,iso_abbrev:string,pub_year:string>, article_date struct<year:string>, publication_types array<string>, "
    "mesh_headings array<struct<descriptor_name:string>>, references array<struct<pmid:string,doi:string>>"
)
PUBMED_LOOKUP = (
    "pmid bigint, doi string, title string, abstract string, journal_title string, journal_iso string, pub_year int, "
    "pub_types array<string>, mesh_descriptors array<string>, reference_pmids array<bigint>, reference_dois array<string>"
)
#: The columns kept of the citation metrics and their types.
ICITE = {
    "pmid": "bigint", "doi": "string", "year": "int", "journal": "string", "citation_count": "int", "relative_citation_ratio": "float",
    "nih_percentile": "float", "is_research_article": "boolean", "is_clinical": "boolean", "expected_citations_per_year": "float",
    "citations_per_year": "float", "field_citation_rate": "float", "human": "float", "animal": "float", "molecular_cellular": "float", "apt": "float",
}
ICITE_LOOKUP = ", ".join(f"{k} {v}" for k, v in ICITE.items())

CITING = "struct<pmcid:string,pmid:bigint,doi:string,title:string,journal:string,year:int,license:string,subset:string,mesh:array<string>,pub_types:array<string>>"
CONTEXT = "struct<section:string,section_bucket:string,paragraph_idx:int,in_table:boolean,in_fig:boolean,evidence_sentence:string,n_co_cited_refs:int,co_cited_ref_ids:array<string>>"
IMPACT = "struct<citation_count:int,relative_citation_ratio:float,nih_percentile:float,is_clinical:boolean,is_research_article:boolean>"
CITED = f"struct<ref_id:string,pmid:bigint,doi:string,title:string,abstract:string,journal:string,year:int,mesh:array<string>,pub_types:array<string>,icite:{IMPACT}>"
ENRICHED = f"citing {CITING}, context {CONTEXT}, cited {CITED}"

STATISTIC = "struct<metric:string,value:string,ci_or_range:string,p_value:string,n_subjects:int>"
EXTRACTED = (
    "struct<relevance_check:string,mismatch_reason:string,attributed_claim:string,citation_purpose:string,evidence_type:string,support_strength:string,"
    f"cited_study_design:string,question:string,answer:string,answer_grounded_in:array<string>,evidence_quote_from_cited:string,statistic_extraction:{STATISTIC}>"
)
RESULT = (
    f"input struct<citing:{CITING},context:{CONTEXT},cited:{CITED}>, ok boolean, raw_text string, usage_in int, usage_out int, latency_s double, attempts int, "
    f"generator struct<model:string,prompt_version:string,ts:double>, error_kind string, error string, extracted {EXTRACTED}"
)
CHAT = "array<struct<role:string,content:string>>"
SPLIT_COLUMNS = ["record_key", "citing_pmcid", "cited_pmid", "split", "relevance_check", "cited_study_design", "support_strength"]
