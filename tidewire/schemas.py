"""Schemas of the corpus tables. One ``articles`` table, partitioned by year and month."""

from __future__ import annotations

from pyspark.sql.types import StructType

LOCATION = "struct<location_level:string,admin0:string,admin1:string,admin2:string>"
RESULT = "struct<result:string,model_outputs:map<string,double>>"
EVENT = "struct<event_type:string,model_outputs:map<string,double>>"
TOP_TWO = "struct<env_max:string,env_sec:string,model_outputs:map<string,double>>"
MENTION = "struct<name:string,countryCode:string,lat:double,lon:double,featureCode:string,confidence:double,stateGeoNameId:string,countryGeoNameId:string>"
PLACE = "struct<id:string,name:string,featureCode:string,countryCode:string>"
FOCUS = f"struct<countries:array<{PLACE}>,states:array<{PLACE}>,cities:array<{PLACE}>>"
ADMIN_MENTION = "struct<location:string,location_level:string,original_category:string,lon:double,lat:double,confidence:double,admin_hierarchy:array<struct<name:string,level:string,country_code:string>>>"
EVIDENCE = "struct<evidence_term:string,kind:string,matched_level:string,matched_value:string,score:double,iso_source:string,iso_set:array<string>>"
REVISIT = f"array<struct<location:string,reason:string,note:string,original:{LOCATION},reconciled:{LOCATION}>>"
META = "struct<status:string,n_gemini:int,n_reconciled_before_dedup:int,n_reconciled:int,n_dedup_dropped:int,n_revisit:int,n_added_cliff_only:int,cliff_isos:array<string>,doc_context_isos:array<string>,timestamp_utc:string>"

ARTICLES = (
    "_id string, url string, source_domain string, title string, maintext string, language string, language_translated string,"
    " title_translated string, maintext_translated string, date_publish timestamp, date_publish_raw string, date_download timestamp,"
    f" download_via string, include boolean, civic_new {EVENT}, civic1 {EVENT}, RAI {EVENT}, civic struct<event_type:string>,"
    f" civic_related {RESULT}, RAI_new {RESULT}, environmental_binary {RESULT}, env_classifier {TOP_TWO},"
    f" US_funding_relevance {RESULT}, US_funding_event {RESULT}, US_funding_sentiment {RESULT}, US_narrative_class {RESULT}, US_narrative_sentiment {RESULT},"
    " cliff_locations map<string,array<string>>, en_cliff_locations map<string,array<string>>,"
    " coord_cliff_locations map<string,array<struct<name:string,lat:double,lon:double>>>,"
    f" cliff_admin_locations array<{ADMIN_MENTION}>, new_mordecai_locations map<string,array<string>>,"
    f" gemini_locations map<string,{LOCATION}>, gemini_locations_normalized map<string,{LOCATION}>,"
    f" reconciled_locations map<string,{LOCATION}>, reconciled_locations_meta {META}, reconciled_locations_debug map<string,string>,"
    f" reconciled_locations_revisit {REVISIT}, reconciled_locations_evidence map<string,{EVIDENCE}>, reconciled_locations_match_terms array<string>,"
    " year int, month int"
)
SOURCES = "source_domain string, include boolean, primary_location array<string>, major_international boolean, major_regional boolean, blacklist_url_patterns array<string>"
MODELS = "model_name string, event_type_nums map<string,int>, event_type_cutoffs map<string,double>"
KB = "Admin0 string, Admin1 string, Admin2 string, Admin0_ISO3 string"
TWEETS = "_id string, date date, language string, text string"
#: Column order of the gazetteer's text file.
GEONAMES = (
    "geonameid string, name string, asciiname string, alternatenames string, latitude string, longitude string, feature_class string,"
    " feature_code string, country_code string, cc2 string, admin1_code string, admin2_code string, admin3_code string, admin4_code string,"
    " population string, elevation string, dem string, timezone string, modification string"
)


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
