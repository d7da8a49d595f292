"""Declared schemas of the input formats."""

ATTRIBUTE = "struct<name:string,value:string,term_source_id:string>"
ENTITY = f"id string, attributes array<{ATTRIBUTE}>"

RELATIONSHIP = "struct<type:string,source:string,target:string>"
CHARACTERISTIC = "struct<text:string,ontologyTerms:array<string>,unit:string>"
SAMPLE = (
    f"accession string, characteristics map<string,array<{CHARACTERISTIC}>>, "
    f"relationships array<{RELATIONSHIP}>"
)
SAMPLE_PAGE = f"_embedded struct<samples:array<struct<{SAMPLE.replace(' string,', ':string,', 1).replace(' map<', ':map<').replace(' array<', ':array<')}>>>"

GROUP = (
    "accession string, name string, releaseDate string, updateDate string, "
    "characteristics map<string,array<struct<text:string>>>, "
    "contact array<struct<Name:string,`E-mail`:string>>, organization array<struct<Name:string>>, "
    f"relationships array<{RELATIONSHIP}>"
)

RULESET = (
    "rule_groups array<struct<name:string,"
    "condition:struct<attribute_value_match:struct<Material:array<string>>>,"
    "rules:array<struct<name:string,mandatory:string>>>>"
)

WORKLIST = "sample string, field string"
SAMPLE_LOG = "id string, type string, overall string, detail string"
EXPERIMENT_LOG = "id string, dataset string, unused string, overall string, detail string"
FIELD_LIST = "column string, sheet string, file string, element string"

LEDGER = "seed_id string, completed_at timestamp"
