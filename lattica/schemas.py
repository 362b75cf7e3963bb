"""Schemas of the nested entities, and the columns of the flat tables with their types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_YEARS = "counts_by_year array<struct<year:int,works_count:bigint,oa_works_count:bigint,cited_by_count:bigint>>"
_COUNTS = "works_count bigint, cited_by_count bigint"
_SOURCE = "source:struct<id:string,display_name:string,type:string>"
_LOCATION = f"struct<{_SOURCE},version:string,license:string,landing_page_url:string,pdf_url:string,is_oa:string,is_accepted:string,is_published:string>"
_INSTITUTION = "struct<id:string,display_name:string,country_code:string,lineage:array<string>>"
_AUTHORSHIP = f"struct<author:struct<id:string,display_name:string>,author_position:string,raw_author_name:string,is_corresponding:boolean,raw_affiliation_string:string,raw_affiliation_strings:array<string>,institutions:array<{_INSTITUTION}>>"
_NAMED = "struct<id:string,display_name:string>"
_VENUE = "struct<id:string,url:string,is_oa:string,version:string,license:string>"

#: Input: one JSON object per line. own_id in ids is the entity's own URL; a snapshot may name it otherwise.
NESTED = {
    "works": f"id string, doi string, title string, publication_year int, publication_date string, type string, type_crossref string, cited_by_count bigint, language string, is_retracted string, is_paratext string, created_date string, locations_count int, indexed_in array<string>, topics array<struct<id:string,score:double>>, keywords array<struct<display_name:string,score:double>>, grants array<struct<funder:string,funder_display_name:string,award_id:string>>, authorships array<{_AUTHORSHIP}>, primary_location {_LOCATION}, locations array<{_LOCATION}>, best_oa_location {_LOCATION}, open_access struct<is_oa:string,oa_status:string,oa_url:string,any_repository_has_fulltext:string>, biblio struct<volume:string,issue:string,first_page:string,last_page:string>, concepts array<struct<id:string,display_name:string,level:int,score:double>>, ids struct<own_id:string,mag:string,pmid:string,pmcid:string>, mesh array<struct<descriptor_ui:string,descriptor_name:string,qualifier_ui:string,qualifier_name:string,is_major_topic:string>>, referenced_works array<string>, related_works array<string>, abstract_inverted_index string, host_venue {_VENUE}, alternate_host_venues array<{_VENUE}>",
    "authors": f"id string, orcid string, display_name string, display_name_alternatives array<string>, {_COUNTS}, last_known_institution struct<id:string>, ids struct<own_id:string,orcid:string,scopus:string,twitter:string,wikipedia:string,mag:string>, {_YEARS}, x_concepts array<struct<id:string,display_name:string,level:int,score:double>>, most_cited_work string, updated_date string",
    "institutions": f"id string, display_name string, ror string, country_code string, type string, homepage_url string, display_name_acronyms array<string>, display_name_acroynyms array<string>, display_name_alternatives array<string>, {_COUNTS}, ids struct<own_id:string,ror:string,grid:string,wikipedia:string,wikidata:string,mag:string>, geo struct<city:string,geonames_city_id:string,region:string,country_code:string,country:string,latitude:double,longitude:double>, associated_institutions array<struct<id:string,relationship:string>>, associated_insitutions array<struct<id:string,relationship:string>>, {_YEARS}, updated_date string",
    "concepts": f"id string, display_name string, wikidata string, description string, level int, {_COUNTS}, ids struct<own_id:string,wikidata:string,wikipedia:string,umls_aui:array<string>,umls_cui:array<string>,mag:string>, ancestors array<struct<id:string>>, related_concepts array<struct<id:string,score:double>>, {_YEARS}, updated_date string",
    "topics": f"id string, display_name string, description string, {_COUNTS}, subfield {_NAMED}, field {_NAMED}, domain {_NAMED}, keywords array<string>, siblings array<{_NAMED}>, updated_date string",
    "sources": f"id string, display_name string, issn_l string, issn array<string>, publisher string, {_COUNTS}, is_oa string, is_in_doaj string, homepage_url string, works_api_url string, ids struct<own_id:string,issn_l:string,issn:array<string>,mag:string,wikidata:string,fatcat:string>, {_YEARS}, updated_date string",
    "venues": f"id string, display_name string, issn_l string, issn array<string>, type string, publisher string, {_COUNTS}, is_oa string, is_in_doaj string, homepage_url string, ids struct<own_id:string,issn_l:string,issn:array<string>,mag:string>, {_YEARS}, updated_date string",
    "publishers": f"id string, display_name string, alternate_titles array<string>, country_codes array<string>, hierarchy_level int, parent_publisher string, {_COUNTS}, sources_api_url string, ids struct<own_id:string,ror:string,wikidata:string>, {_YEARS}, updated_date string",
    "funders": f"id string, display_name string, alternate_titles array<string>, country_code string, description string, homepage_url string, grants_count bigint, {_COUNTS}, ids struct<wikidata:string,ror:string,crossref:string,doi:string>, {_YEARS}, roles array<struct<role:string,id:string,works_count:bigint>>, summary_stats struct<works_count:bigint,cited_by_count:bigint,oa_percent:double,h_index:bigint,`2yr_mean_citedness`:double,`2yr_works_count`:bigint,`2yr_i10_index`:bigint,`2yr_h_index`:bigint>, updated_date string",
}

MANIFEST = "entries array<struct<url:string,meta:struct<record_count:bigint>>>, meta struct<record_count:bigint>"
LOG = "timestamp timestamp, path string, table string, records bigint"

#: Types in Parquet of flat columns that are not as they were read; ids are bigint wherever they occur.
STORED = {
    "publication_year": "smallint", "year": "smallint", "level": "tinyint", "institution_lineage_level": "smallint", "num_authors": "int", "num_locations": "int",
    "num_references": "int", "score": "float", "publication_date": "timestamp", "created_date": "timestamp", "updated_date": "timestamp",
}


def nested_schema(entity: str, own_id: str = "own_id") -> T.StructType:
    """Schema to parse an entity's records with; own_id: the name that the snapshot gives this field of ids."""
    return T.StructType.fromDDL(NESTED[entity].replace("struct<own_id:", f"struct<{own_id}:"))


def with_own_id(df: DataFrame, entity: str) -> DataFrame:
    """df with the fields of ids named as in NESTED."""
    return df.withColumn("ids", F.col("ids").cast(nested_schema(entity)["ids"].dataType)) if "ids" in df.columns else df
