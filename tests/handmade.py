"""Small dumps written row by row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from regspan.sources.dump import Dump

_TABLES = {
    "nodes": "id long, type string, created timestamp_ntz, deleted timestamp_ntz, "
    "registered_date timestamp_ntz, is_public boolean, moderation_state string, "
    "spam_status int, provider_id long, creator_id long, registered_meta string",
    "logs": "node_id long, action string, created timestamp_ntz, params string",
    "artifacts": "_id string, artifact_type int, created timestamp_ntz, "
    "deleted timestamp_ntz, finalized boolean",
    "guids": "id long, content_type_id int, object_id long",
    "metadata_records": "guid_id long, resource_type_general string, funding_info string",
    "affiliations": "abstractnode_id long, institution_id int",
    "institutions": "id int, name string",
    "templates": "_id string, name string",
    "providers": "id int, name string",
    "node_subjects": "abstractnode_id long, subject_id long",
    "subjects": "id int, text string, parent_id int",
    "users": "id long",
}


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


def node(node_id: int, created: str = "2020-01-01", **changes) -> tuple:
    row = {
        "id": node_id,
        "type": "osf.registration",
        "created": day(created),
        "deleted": None,
        "registered_date": day(created),
        "is_public": True,
        "moderation_state": "accepted",
        "spam_status": None,
        "provider_id": None,
        "creator_id": 1,
        "registered_meta": None,
    }
    return tuple({**row, **changes}.values())


def added(node_id: int, artifact: str | None, created: str, action=None) -> tuple:
    params = None if artifact is None else f'{{"artifact_id": "{artifact}"}}'
    return (node_id, action or "resource_identifier_added", day(created), params)


def artifact(key: str, kind: int | None, created: str, deleted: str | None = None, final=True):
    return (key, kind, day(created), day(deleted) if deleted else None, final)


def make_dump(spark: SparkSession, **tables: list[tuple]) -> Dump:
    return Dump(lambda name: spark.createDataFrame(tables.get(name, []), _TABLES[name]))
