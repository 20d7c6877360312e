"""The archive's collections, derived from the test tables.

The view texts run unchanged on Spark and, with the braces removed, on DuckDB.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INSTANT = "2001-06-15 12:30:00"

VIEWS = {
    "retention_policies": """
SELECT 'pol-' || n_nationkey AS policyId, n_name AS name,
  CASE n_nationkey % 3 WHEN 0 THEN 400 WHEN 1 THEN 30 ELSE 3 END AS retentionPeriod,
  CASE n_nationkey % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'MONTH' ELSE 'year' END AS unitOfPeriod,
  CASE n_regionkey WHEN 0 THEN 'supervision' WHEN 1 THEN NULL ELSE 'archive' END AS sourceType
FROM {nation}""",
    "part_policies": """
SELECT 'pol-' || p_partkey AS policyId, p_name AS name, p_size AS retentionPeriod,
  CASE p_partkey % 3 WHEN 0 THEN 'Day' WHEN 1 THEN 'MONTH' ELSE 'year' END AS unitOfPeriod,
  CASE WHEN p_type = 'ECONOMY' THEN 'supervision' WHEN p_partkey % 7 = 0 THEN NULL ELSE 'archive' END AS sourceType
FROM {part}""",
    "retention_policy_map": """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS STRING)) AS _id,
  'gc-' || l_orderkey AS gcId, 'pol-' || (l_suppkey % 28) AS policyId, 'cl-' || (l_partkey % 6) AS clusterId,
  l_returnflag AS channel, l_linestatus AS network, l_linenumber AS seq, l_shipdate AS startDate
FROM {lineitem}""",
    "cluster": "SELECT 'cl-' || r_regionkey AS _id FROM {region}",
    "tenancy": """
SELECT 't' || r_regionkey AS _id, CASE WHEN r_regionkey < 3 THEN 'active' ELSE 'closed' END AS status,
  CASE WHEN r_regionkey = 2 THEN NULL ELSE 'uuid-' || r_regionkey END AS tenantuuid
FROM {region}""",
    "customer_tenancy": """
SELECT 't' || c_custkey AS _id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'closed' ELSE 'active' END AS status,
  CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE 'uuid-' || c_custkey END AS tenantuuid
FROM {customer}""",
    "case_items": """
SELECT event_id AS _id, 'gc-' || (user_id * 100 + event_id % 150) AS gcid,
  CASE event_type WHEN 'error' THEN true WHEN 'view' THEN NULL ELSE false END AS holdFlag
FROM {events}""",
    "archive_metrics": """
SELECT 'am-' || o_orderkey AS _id, 'gc-' || o_orderkey AS gcId, 'snap-' || o_custkey AS snapshot_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Archived' WHEN '2-HIGH' THEN 'Duplicate' WHEN '3-MEDIUM' THEN 'Processing'
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Failed' END AS processing_state,
  'f-' || (o_orderkey % 4) AS src_file
FROM {orders}""",
    "hold_request_history": """
SELECT 'hr-' || (user_id % 15) AS holdRequestId, 'snap-' || event_id AS snapshotId,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN NULL WHEN 'click' THEN 'PENDING' ELSE 'SUCCESS' END AS status
FROM {events}""",
    "snapshot_list": "SELECT event_id AS position, 'snap-' || user_id AS snapshot_id FROM {events}",
    "map_before": """
SELECT 'gc-' || l_orderkey AS gcId, 'pol-' || (l_suppkey % 28) AS policyId FROM {lineitem} WHERE l_linenumber <= 3""",
    "map_after": """
SELECT 'gc-' || l_orderkey AS gcId, 'pol-' || (l_suppkey % 28) AS policyId FROM {lineitem} WHERE l_linenumber <> 1""",
    "keyed_map": """
SELECT l_orderkey AS shard_key, 'gc-' || l_orderkey AS gcId, 'pol-' || (l_suppkey % 28) AS policyId,
  'cl-' || (l_partkey % 6) AS clusterId, l_linenumber AS seq, l_shipdate AS startDate
FROM {lineitem}""",
    "chunks": """
SELECT 'sh-' || n_regionkey AS shard, n_nationkey AS chunk_id, n_nationkey * 600 AS min_key,
  CASE WHEN n_nationkey = 24 THEN 1000000000 ELSE (n_nationkey + 1) * 600 END AS max_key
FROM {nation}""",
    "customer_chunks": """
SELECT 'sh-' || c_nationkey AS shard, c_custkey AS chunk_id, c_custkey * 8 AS min_key, c_custkey * 8 + 8 AS max_key
FROM {customer}""",
    "text_chunks": """
SELECT 'sh-' || c_nationkey AS shard, c_custkey AS chunk_id, CASE WHEN c_custkey = 1 THEN NULL ELSE 'gc-' || c_custkey END AS min_key,
  CASE WHEN c_custkey = 2 THEN NULL ELSE 'gc-' || c_custkey || CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '5' ELSE '~' END END AS max_key
FROM {customer}""",
    "time_chunks": """
SELECT 'sh-' || n_regionkey AS shard, n_nationkey AS chunk_id, make_date(1991 + n_nationkey % 8, 1 + n_nationkey % 12, 9) AS min_key,
  make_date(1992 + n_nationkey % 8, 1 + n_nationkey % 11, 9) AS max_key
FROM {nation}""",
    "compound_chunks": """
SELECT 'sh-' || n_regionkey AS shard, n_nationkey AS chunk_id, 'cl-' || (n_nationkey % 6) AS low_cluster, 1 + n_nationkey % 4 AS low_seq,
  'cl-' || (n_nationkey % 6 + n_nationkey % 3) AS high_cluster, 2 + n_nationkey % 5 AS high_seq
FROM {nation}""",
    "event_rows": """
SELECT event_id AS id, 'ev-' || user_id || '-' || CAST(floor(event_id / 100.0) AS BIGINT) AS doc_id,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'DISPOSITION' ELSE 'INGEST' END AS origin,
  CASE WHEN user_id % 3 = 0 THEN 't1' ELSE 't2' END AS tenantid, 'gc-' || event_id AS gcId, ts
FROM {events}""",
    "listed_ids": "SELECT 'gc-' || o_orderkey AS gcId FROM {orders} WHERE o_orderstatus = 'F'",
    "dropped_first": """
SELECT 'gc-' || l_orderkey AS gcid, l_returnflag AS channel, l_linestatus AS network FROM {lineitem}""",
    "dropped_later": """
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'gc-' || o_orderkey END AS gcid,
  o_orderpriority AS channel, o_orderstatus AS network FROM {orders}""",
}


def duckdb_view(name: str) -> str:
    return VIEWS[name].replace("{", "").replace("}", "").replace("AS STRING", "AS VARCHAR")


def epoch_millis(instant: Column) -> Column:
    """Epoch milliseconds of a UTC ``timestamp_ntz``."""
    day = F.unix_date(instant.cast("date")).cast("long")
    seconds = F.hour(instant) * 3600 + F.minute(instant) * 60
    millis = F.floor(F.extract(F.lit("SECOND"), instant) * 1000).cast("long")
    return day * 86_400_000 + seconds.cast("long") * 1000 + millis


class Archive:
    """The collections over the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        text = VIEWS[name]
        table = text[text.index("{") + 1 : text.index("}")]
        return self.spark.sql(text, **{table: self.table(table)})

    @cached_property
    def held_items(self) -> DataFrame:
        """Case items with their message id nested, as the archive stores it."""
        return self.case_items.select("_id", F.struct("gcid").alias("documentKey"), "holdFlag")

    @cached_property
    def event_log(self) -> DataFrame:
        """``_id, events``: up to 100 events per document, as a JSON array in text."""
        event = F.struct(
            "id", "origin", "tenantid", "gcId", epoch_millis(F.col("ts")).alias("_tm"), F.lit("1").alias("ver")
        )
        return self.event_rows.groupBy(F.col("doc_id").alias("_id")).agg(
            F.to_json(F.collect_list(event)).alias("events")
        )

    @cached_property
    def varied_log(self) -> DataFrame:
        """As ``event_log``, with fields that only some events have."""
        event = F.struct(
            "id", "origin", "tenantid", "gcId", epoch_millis(F.col("ts")).alias("_tm"), F.lit("1").alias("ver"),
            F.when(F.col("id") % 5 == 0, F.concat(F.lit("n "), "id")).alias("a note"),
            F.when(F.col("id") % 7 == 0, F.struct(F.col("id").alias("code"))).alias("Detail"),
        )
        return self.event_rows.groupBy(F.col("doc_id").alias("_id")).agg(
            F.to_json(F.collect_list(event)).alias("events")
        )

    @cached_property
    def listed_objects(self) -> DataFrame:
        """``value``: per event an object with braces and quotes in a string, each 40th of them broken."""
        text = F.format_string(
            '{"StartDate": "%d", "id": "x%d", "note": "a } \\" { [ %d", "in": {"n": [%d]}},',
            epoch_millis(F.col("ts")), F.col("event_id"), F.col("event_id"), F.col("event_id"),
        )
        broken = F.replace(text, F.lit('"id": '), F.lit('"id" '))
        return self.table("events").select(F.when(F.col("event_id") % 40 == 0, broken).otherwise(text).alias("value"))

    @cached_property
    def docs_by_oid(self) -> DataFrame:
        """``_id``: 24 hexadecimal digits that begin with the order's second."""
        seconds = (epoch_millis(F.col("o_orderdate")) / 1000).cast("long")
        prefix = F.lower(F.lpad(F.hex(seconds), 8, "0"))
        return self.table("orders").select(F.concat(prefix, F.repeat(F.lit("0"), 16)).alias("_id"))

    @cached_property
    def shell_dumps(self) -> DataFrame:
        """``doc, value``: per order a text with two policy objects in shell notation."""

        def obj(name: str, period: Column) -> Column:
            return F.format_string(
                '{\n  "name" : "%s",\n  "retentionPeriod" : NumberInt(%d),\n  "unitOfPeriod" : "%s",\n'
                '  "createdDate" : ISODate("%s"),\n  "enabled" : true\n}',
                F.concat(F.lit(name), "o_orderkey"), period, F.col("o_orderstatus"),
                F.concat(F.translate(F.col("o_orderdate").cast("string"), " ", "T"), F.lit("Z")),
            )

        text = F.concat(
            F.lit("/* 1 */\n"), obj("a-", F.col("o_custkey")), F.lit(",\n/* 2 */\n"), obj("b-", F.col("o_custkey") + 1), F.lit("\n")
        )
        return self.table("orders").select(F.col("o_orderkey").alias("doc"), text.alias("value"))

    @cached_property
    def wrapped_arrays(self) -> DataFrame:
        """``doc, value``: per event an array of two objects, wrongly wrapped in braces."""
        item = '{"StartDate": "%d", "id": "%s"}'
        millis = epoch_millis(F.col("ts"))
        text = F.format_string(
            "{[" + item + ", " + item + "]}\n",
            millis, F.concat(F.lit("x"), "event_id"), millis - F.lit(1_000_000_000), F.concat(F.lit("y"), "event_id"),
        )
        return self.table("events").select(F.col("event_id").alias("doc"), text.alias("value"))

    @cached_property
    def id_objects(self) -> DataFrame:
        """``doc, value``: per order a comma-separated list of single-quoted objects."""
        text = F.format_string(
            " {'gcid': 'gc-%d'},{'x': 1},{'gcid': 'am-%d'},\n", F.col("o_orderkey"), F.col("o_orderkey")
        )
        return self.table("orders").select(F.col("o_orderkey").alias("doc"), text.alias("value"))
