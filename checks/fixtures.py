"""The source tables of the library as views over the given tables.

The SQL runs unchanged in Spark and DuckDB.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from regspan.sources.dump import Dump, check_columns

GIVEN_TABLES = ("orders", "lineitem", "customer", "nation", "region")

VIEWS = {
    "nodes": """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 20 = 19 THEN 'osf.node' ELSE 'osf.registration' END AS type,
  o_orderdate AS created,
  CASE WHEN o_orderkey % 17 = 5 THEN o_orderdate + INTERVAL 400 DAY END AS deleted,
  CASE WHEN o_orderkey % 13 = 3 THEN NULL ELSE o_orderdate END AS registered_date,
  o_orderkey % 11 <> 7 AS is_public,
  CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'accepted' END AS moderation_state,
  CASE WHEN o_orderkey % 7 = 0 THEN 2 WHEN o_orderkey % 7 IN (1,2) THEN NULL ELSE 1 END AS spam_status,
  CASE WHEN o_orderkey % 9 = 4 THEN NULL ELSE o_custkey % 5 END AS provider_id,
  o_custkey AS creator_id,
  CASE WHEN o_orderkey % 15 = 2 THEN NULL
    ELSE concat('{"schema": "5', substr(md5(o_orderpriority),1,23), '"}') END AS registered_meta
FROM orders""",
    "templates": """
SELECT concat('5', substr(md5(p),1,23)) AS _id, p AS name
FROM (SELECT DISTINCT o_orderpriority AS p FROM orders
      WHERE o_orderpriority <> '4-NOT SPECIFIED') t""",
    "guids": """
SELECT o_orderkey + 1000000 AS id,
  CASE WHEN o_orderkey % 20 = 19 THEN 31 ELSE 30 END AS content_type_id,
  o_orderkey AS object_id
FROM orders""",
    "metadata_records": """
SELECT o_orderkey + 1000000 AS guid_id, 'Text' AS resource_type_general,
  CASE o_orderkey % 4 WHEN 0 THEN '[]'
  WHEN 1 THEN concat('[{"funder_name": "FUNDER_', CAST(o_custkey % 25 AS STRING),
    '", "funder_identifier": "f', CAST(o_custkey % 25 AS STRING), '"}]')
  WHEN 2 THEN concat('[{"funder_name": "FUNDER_', CAST(o_custkey % 25 AS STRING),
    '", "funder_identifier": "x"},{"funder_name": "FUNDER_', CAST((o_custkey+1) % 25 AS STRING),
    '", "funder_identifier": "y"}]')
  ELSE '[{"funder_name": null, "funder_identifier": ""}]' END AS funding_info
FROM orders""",
    "institutions": "SELECT n_nationkey AS id, n_name AS name FROM nation",
    "affiliations": """
SELECT o_orderkey AS abstractnode_id, c_nationkey AS institution_id
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 <> 0
UNION ALL
SELECT o_orderkey, (c_nationkey + 1) % 25
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 10 = 1""",
    "providers": "SELECT r_regionkey AS id, r_name AS name FROM region",
    "subjects": """
SELECT r_regionkey AS id, r_name AS text, CAST(NULL AS INT) AS parent_id, 0 AS provider_id
FROM region
UNION ALL SELECT 100 + n_nationkey, n_name, n_regionkey, 0 FROM nation""",
    "node_subjects": """
SELECT l_orderkey AS abstractnode_id,
  CASE WHEN l_linenumber = 1 THEN l_suppkey % 5 ELSE 100 + l_suppkey % 25 END AS subject_id
FROM lineitem WHERE l_linenumber <= 3""",
    "logs": """
SELECT l_orderkey AS node_id,
  CASE WHEN l_linenumber = 7 THEN 'node_updated' ELSE 'resource_identifier_added' END AS action,
  CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate + INTERVAL 13 HOUR ELSE l_shipdate END AS created,
  concat('{"artifact_id": "5', substr(md5(concat(CAST(l_orderkey AS STRING), '-',
    CAST(l_linenumber AS STRING))),1,23), '"}') AS params
FROM lineitem""",
    "artifacts": """
SELECT concat('5', substr(md5(concat(CAST(l_orderkey AS STRING), '-',
    CAST(l_linenumber AS STRING))),1,23)) AS _id,
  CASE l_linenumber WHEN 1 THEN 1 WHEN 3 THEN 11 WHEN 5 THEN 21 WHEN 6 THEN 41 ELSE 31 END AS artifact_type,
  min(l_shipdate) AS created,
  CASE WHEN max(l_returnflag) = 'R' THEN min(l_shipdate) + INTERVAL 300 DAY END AS deleted,
  min(l_linestatus) = 'F' AS finalized
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "users": "SELECT c_custkey AS id FROM customer",
}


def fixture_dump(spark: SparkSession, sf_dir: str) -> Dump:
    """The dump the given tables of one scale stand for."""

    def load(name: str) -> DataFrame:
        sql = VIEWS[name]
        # Registered anew each time: another scale may have been opened in between.
        for table in GIVEN_TABLES:
            if re.search(rf"\b{table}\b", sql):
                given(table).createOrReplaceTempView(table)
        return check_columns(spark.sql(sql), name)

    @cache
    def given(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")

    return Dump(load)
