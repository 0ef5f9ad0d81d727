"""Source tables, artifact codes, attribute names and report labels."""

from __future__ import annotations

# The file name of each source table in the relational dump.
TABLE_FILES = {
    "nodes": "osf_abstractnode",
    "logs": "osf_nodelog",
    "artifacts": "osf_outcomeartifact",
    "guids": "osf_guid",
    "metadata_records": "osf_guidmetadatarecord",
    "affiliations": "osf_abstractnode_affiliated_institutions",
    "institutions": "osf_institution",
    "templates": "osf_registrationschema",
    "providers": "osf_abstractprovider",
    "node_subjects": "osf_abstractnode_subjects",
    "subjects": "osf_subject",
    "users": "osf_osfuser",
}

# Columns each table must have. Types are families, so that a dump with 32-bit keys or
# with zoned timestamps is accepted as well.
TABLE_COLUMNS = {
    "nodes": {
        "id": "integer", "type": "string", "created": "timestamp", "deleted": "timestamp",
        "registered_date": "timestamp", "is_public": "boolean", "moderation_state": "string",
        "spam_status": "integer", "provider_id": "integer", "creator_id": "integer",
        "registered_meta": "string",
    },
    "logs": {"node_id": "integer", "action": "string", "created": "timestamp", "params": "string"},
    "artifacts": {
        "_id": "string", "artifact_type": "integer", "created": "timestamp",
        "deleted": "timestamp", "finalized": "boolean",
    },
    "guids": {"id": "integer", "content_type_id": "integer", "object_id": "integer"},
    "metadata_records": {
        "guid_id": "integer", "resource_type_general": "string", "funding_info": "string",
    },
    "affiliations": {"abstractnode_id": "integer", "institution_id": "integer"},
    "institutions": {"id": "integer", "name": "string"},
    "templates": {"_id": "string", "name": "string"},
    "providers": {"id": "integer", "name": "string"},
    "node_subjects": {"abstractnode_id": "integer", "subject_id": "integer"},
    "subjects": {"id": "integer", "text": "string", "parent_id": "integer"},
    "users": {"id": "integer"},
}

# Codes and patterns found in the dump.
NODE_TYPE_PREFIX = "osf."
RESOURCE_ADDED = "resource_identifier_added"
GUID_OF_NODE = 30
OUTPUT_TYPES = (1, 11, 21, 41)
OUTCOME_TYPE = 31
KEY_PATTERN = "[0-9][0-9A-Za-z]{5,}"
FUNDING_SCHEMA = "array<struct<funder_name:string,funder_identifier:string>>"

# What makes a registration valid (all must hold).
VALID_REGISTRATION = (
    "is_public",
    "deleted IS NULL",
    "registered_date IS NOT NULL",
    "moderation_state = 'accepted'",
    "(spam_status <> 2 OR spam_status IS NULL)",
)

# Attributes a summary can be split by.
SUPPORTED_ATTRIBUTES = (
    "institution",
    "funder",
    "funded",
    "template",
    "provider",
    "subject",
    "subject_parent",
    "affiliated",
)
OVERALL = "overall"

# Labels written when a registration has no value.
UNAFFILIATED = "Unaffiliated"
AFFILIATED = "OSFI-Affiliate"
UNFUNDED = "Unfunded"
FUNDED = "Funded"
UNSPECIFIED = "Unspecified"

# Report labels by measure.
REPORTING_LABELS = {
    "n_osr": "Open Registrations",
    "have_outputs": "Open Registrations with Linked Outputs",
    "have_outcomes": "Open Registrations with Linked Outcomes",
    "are_los": "Lifecycle Open Science (LOS) Registrations",
    "prop_los": "Share of Open Registrations that are LOS",
}

# Section titles of the annual report by moment.
SECTION_LABELS = {"value": "TOTALS", "delta": "NET CHANGE", "growth": "% GROWTH"}
