"""For each query the SQL that gives the same rows on DuckDB over the same tables."""

from __future__ import annotations

from keeprule.plans.views import INSTANT, duckdb_view

ORACLE: dict[str, str] = {}


def oracle(name: str, views: str, body: str, **steps: str) -> None:
    """Register ``body``, with the named views and further steps before it."""
    parts = {v: duckdb_view(v) for v in views.split()} | steps
    prefix = ",\n".join(f"{step} AS ({sql.strip()})" for step, sql in parts.items())
    ORACLE[name] = f"WITH {prefix}\n{body.strip()}" if parts else body.strip()


def threshold(instant: str, midnight: bool) -> str:
    start = f"TIMESTAMP '{instant}'"
    calendar = f"date_trunc('day', {start})" if midnight else start
    return f"""CASE lower(unitOfPeriod) WHEN 'day' THEN {start} - to_days(retentionPeriod)
  WHEN 'month' THEN {calendar} - to_months(retentionPeriod) ELSE {calendar} - to_years(retentionPeriod) END"""


def thresholds(midnight: bool, policies: str = "retention_policies") -> str:
    return (
        f"SELECT policyId, name, sourceType, CAST({threshold(INSTANT, midnight)} AS TIMESTAMP) AS threshold "
        f"FROM {policies}"
    )


EXACT, MIDNIGHT = thresholds(False), thresholds(True)
UNIVERSE = "SELECT gcId FROM retention_policy_map UNION SELECT gcId FROM archive_metrics"
RET = "coalesce(sourceType, '') <> 'supervision'"
SUP = "sourceType = 'supervision'"


def active(policies: str) -> str:
    return f"""SELECT DISTINCT m.gcId FROM retention_policy_map m JOIN thresholds t ON m.policyId = t.policyId
  WHERE m.startDate >= t.threshold AND {policies}"""


HOLDS = """SELECT gcid AS gcId, CASE WHEN max(CASE WHEN holdFlag THEN 1 ELSE 0 END) = 1 THEN 'Y' ELSE 'N' END AS case_hold
  FROM case_items WHERE gcid IS NOT NULL GROUP BY gcid"""
FLAGS = """SELECT coalesce(u.gcId, h.gcId) AS gcId,
  CASE WHEN u.gcId IS NULL THEN NULL WHEN r.gcId IS NULL THEN 'Y' ELSE 'N' END AS ret_policies_expired,
  CASE WHEN u.gcId IS NULL THEN NULL WHEN s.gcId IS NULL THEN 'Y' ELSE 'N' END AS sup_policies_expired,
  h.case_hold
FROM universe u LEFT JOIN ret_active r ON u.gcId = r.gcId LEFT JOIN sup_active s ON u.gcId = s.gcId
  FULL JOIN holds h ON u.gcId = h.gcId"""
FLAG_VIEWS = "retention_policies retention_policy_map archive_metrics case_items"
FLAG_STEPS = dict(
    thresholds=EXACT, universe=UNIVERSE, ret_active=active(RET), sup_active=active(SUP), holds=HOLDS, flags=FLAGS
)

for name, midnight in (("policy_thresholds", False), ("policy_thresholds_midnight", True)):
    oracle(name, "part_policies", f"""
SELECT policyId, CAST(threshold AS VARCHAR) AS threshold FROM ({thresholds(midnight, "part_policies")})""")
oracle("parsed_instants", "", """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 1 THEN o_orderdate - INTERVAL 2 HOUR ELSE o_orderdate END AS VARCHAR) AS instant
FROM orders""")

oracle("unique_gcids", "retention_policy_map", "SELECT DISTINCT gcId FROM retention_policy_map")
oracle("ret_flags", FLAG_VIEWS, "SELECT gcId, ret_policies_expired FROM flags WHERE ret_policies_expired IS NOT NULL", **FLAG_STEPS)
oracle("sup_flags", FLAG_VIEWS, "SELECT gcId, sup_policies_expired FROM flags WHERE sup_policies_expired IS NOT NULL", **FLAG_STEPS)
oracle("case_holds", "case_items", HOLDS)
oracle("flag_table", FLAG_VIEWS, "SELECT * FROM flags", **FLAG_STEPS)
oracle("flag_totals", FLAG_VIEWS, """
SELECT count(ret_policies_expired) AS evaluated,
  count(*) FILTER (ret_policies_expired = 'Y') AS ret_expired, count(*) FILTER (ret_policies_expired = 'N') AS ret_active,
  count(*) FILTER (sup_policies_expired = 'Y') AS sup_expired, count(*) FILTER (sup_policies_expired = 'N') AS sup_active,
  count(*) FILTER (case_hold = 'Y') AS held,
  (SELECT count(*) FROM retention_policy_map WHERE startDate IS NULL AND gcId IS NOT NULL) AS null_starts
FROM flags""", **FLAG_STEPS)
oracle("flag_upsert", FLAG_VIEWS, """
SELECT coalesce(u.gcId, h.gcId) AS gcId,
  CASE WHEN u.gcId IS NULL THEN NULL WHEN r.gcId IS NULL THEN 'Y' ELSE 'N' END AS ret_policies_expired, h.case_hold
FROM (SELECT DISTINCT gcId FROM retention_policy_map) u LEFT JOIN ret_active r ON u.gcId = r.gcId
  FULL JOIN holds h ON u.gcId = h.gcId""", **FLAG_STEPS)

COUNTS = """SELECT m.clusterId, m.policyId, count(*) AS expired_count
  FROM retention_policy_map m JOIN thresholds t ON m.policyId = t.policyId AND m.startDate < t.threshold
  WHERE m.clusterId IN (SELECT _id FROM cluster) GROUP BY ALL"""
COUNT_VIEWS = "retention_policies retention_policy_map cluster tenancy"
oracle("active_tenants", "customer_tenancy", "SELECT * FROM customer_tenancy WHERE status = 'active' AND tenantuuid IS NOT NULL")
for tenant, name in (("t1", "expired_by_cluster_policy"), ("t2", "expired_closed_tenant")):
    oracle(name, COUNT_VIEWS, f"""
SELECT c.clusterId, c.policyId, c.expired_count, coalesce(p.name, '') AS name
FROM counts c LEFT JOIN retention_policies p ON c.policyId = p.policyId
WHERE EXISTS (SELECT 1 FROM tenancy WHERE _id = '{tenant}' AND status = 'active' AND tenantuuid IS NOT NULL)""",
        thresholds=MIDNIGHT, counts=COUNTS)
oracle("expired_to_the_minute", COUNT_VIEWS, "SELECT * FROM counts", thresholds=EXACT, counts=COUNTS)
oracle("expired_dense", COUNT_VIEWS, """
SELECT k._id AS clusterId, p.policyId, coalesce(c.expired_count, 0) AS expired_count
FROM cluster k CROSS JOIN retention_policies p LEFT JOIN counts c ON c.clusterId = k._id AND c.policyId = p.policyId""",
    thresholds=MIDNIGHT, counts=COUNTS)
oracle("expired_one_pair", COUNT_VIEWS, """
SELECT count(*) AS expired_count FROM retention_policy_map m JOIN thresholds t ON m.policyId = t.policyId
WHERE m.clusterId = 'cl-1' AND m.policyId = 'pol-7' AND m.startDate < t.threshold""", thresholds=MIDNIGHT)

DIFF_VIEWS = "map_before map_after retention_policies"
DIFF_STEPS = dict(
    counts="""SELECT gcId, policyId, count(*) FILTER (side = 'b') AS n_before, count(*) FILTER (side = 'a') AS n_after
  FROM (SELECT *, 'b' AS side FROM map_before UNION ALL SELECT *, 'a' AS side FROM map_after) GROUP BY gcId, policyId""",
    totals="""SELECT gcId, CAST(sum(CASE WHEN n_before = 0 THEN n_after ELSE 0 END) AS BIGINT) AS n_net_new
  FROM counts GROUP BY gcId HAVING sum(n_before) > 0 AND sum(CASE WHEN n_before = 0 THEN n_after ELSE 0 END) > 0""",
)
oracle("assignment_counts", DIFF_VIEWS, "SELECT * FROM counts", **DIFF_STEPS)
oracle("assignment_changes", DIFF_VIEWS, """
SELECT c.gcId, CAST(sum(c.n_before) AS BIGINT) AS n_before, CAST(sum(c.n_after) AS BIGINT) AS n_after, any_value(t.n_net_new) AS n_net_new
FROM counts c JOIN totals t ON c.gcId = t.gcId GROUP BY c.gcId""", **DIFF_STEPS)
DIFF_ROWS = """SELECT c.*, CASE WHEN c.n_before = 0 THEN c.n_after ELSE CAST(0 AS BIGINT) END AS n_new, t.n_net_new"""


oracle("assignment_diff", DIFF_VIEWS, f"{DIFF_ROWS} FROM counts c JOIN totals t ON c.gcId = t.gcId", **DIFF_STEPS)
oracle("assignment_diff_named", DIFF_VIEWS, f"""{DIFF_ROWS}, coalesce(p.name, c.policyId) AS name
FROM counts c JOIN totals t ON c.gcId = t.gcId LEFT JOIN retention_policies p ON c.policyId = p.policyId""", **DIFF_STEPS)
oracle("sorted_assignments", "retention_policy_map", """
SELECT gcId, policyId, channel, clusterId, network FROM retention_policy_map
ORDER BY gcId, policyId, channel, clusterId, network""")

MAP_EXPORT = """gcId, policyId, clusterId, coalesce(channel, '') AS channel, coalesce(network, '') AS network,
  coalesce(CAST(startDate AS VARCHAR), '') AS startDate"""
POLICY_EXPORT = """policyId, name, coalesce(sourceType, '') AS sourceType, '' AS category,
  CAST(retentionPeriod AS VARCHAR) AS retentionPeriod, unitOfPeriod"""
oracle("full_scan", "archive_metrics", "SELECT * FROM archive_metrics")
oracle("field_export", "archive_metrics", """
SELECT gcId, coalesce(processing_state, '') AS processing_state, '' AS channel FROM archive_metrics""")
oracle("hit_export", "archive_metrics", """
SELECT gcId, coalesce(processing_state, '') AS processing_state, '' AS other FROM archive_metrics WHERE src_file = 'f-1'""")
oracle("open_states", "archive_metrics", """
SELECT _id FROM archive_metrics WHERE processing_state IS NULL OR processing_state NOT IN
  ('Archived', 'Duplicate', 'Disposed', 'Obsolete', 'Unrecoverable', 'Rejected')""")
oracle("archived_ids", "archive_metrics", "SELECT gcId FROM archive_metrics WHERE processing_state = 'Archived'")
oracle("pending_snapshots", "hold_request_history", """
SELECT snapshotId FROM hold_request_history WHERE holdRequestId = 'hr-3' AND status IS DISTINCT FROM 'SUCCESS'""")
oracle("listed_channels", "retention_policy_map", """
SELECT _id, policyId FROM retention_policy_map WHERE policyId IN ('pol-1', 'pol-5', 'pol-26')""")
oracle("policy_report", "part_policies", f"SELECT {POLICY_EXPORT} FROM part_policies")
oracle("renamed_headers", "case_items", "SELECT _id, gcid AS gcId, holdFlag FROM case_items")
oracle("index_scan", "archive_metrics", """
SELECT _id, src_file AS index FROM archive_metrics WHERE src_file IN ('f-1', 'f-2')""")
oracle("ids_export", "retention_policy_map listed_ids", f"""
SELECT {MAP_EXPORT} FROM retention_policy_map WHERE gcId IN (SELECT gcId FROM listed_ids)""")
oracle("export_totals", "retention_policy_map listed_ids", """
SELECT (SELECT count(*) FROM listed_ids) AS ids_given, count(DISTINCT gcId) AS ids_found, count(*) AS rows_written
FROM retention_policy_map WHERE gcId IN (SELECT gcId FROM listed_ids)""")
oracle("snapshot_lookup", "snapshot_list archive_metrics", """
SELECT l.position, l.snapshot_id, m.gcId FROM snapshot_list l
JOIN (SELECT snapshot_id, min(gcId) AS gcId FROM archive_metrics GROUP BY snapshot_id) m ON l.snapshot_id = m.snapshot_id""")
oracle("page_after", "retention_policy_map", """
SELECT _id, gcId FROM retention_policy_map WHERE _id > '2000-' ORDER BY _id LIMIT 500""")
PLACED = """SELECT src_file, _id, row_number() OVER (PARTITION BY src_file ORDER BY substr(md5(_id), 1, 3), _id) - 1 AS place
  FROM archive_metrics"""
oracle("id_batches", "archive_metrics", """
SELECT src_file, CAST(floor(place / 1000.0) AS BIGINT) + 1 AS batch, count(*) AS n_ids, string_agg(_id, ',' ORDER BY place) AS ids
FROM placed GROUP BY src_file, CAST(floor(place / 1000.0) AS BIGINT) + 1""", placed=PLACED)
oracle("id_documents", "archive_metrics", """
SELECT src_file, CAST(floor(place / 2500.0) AS BIGINT) + 1 AS batch, count(*) AS n_ids,
  '{"archiveMetricIds":["' || string_agg(_id, '","' ORDER BY place) || '"]}' AS document
FROM placed GROUP BY src_file, CAST(floor(place / 2500.0) AS BIGINT) + 1""", placed=PLACED)
oracle("file_id_batches", "archive_metrics", "SELECT _id, true AS full FROM archive_metrics")
oracle("file_documents", "archive_metrics", "SELECT _id, true AS whole, true AS in_order FROM archive_metrics")
oracle("sorted_ids", "retention_policy_map", "SELECT DISTINCT gcId AS gcid FROM retention_policy_map ORDER BY 1")
oracle("dedup_rows", "retention_policy_map", "SELECT DISTINCT gcId, channel, network FROM retention_policy_map")
oracle("union_slices", "map_before map_after", "SELECT * FROM map_before UNION ALL SELECT * FROM map_after")

oracle("event_failures", "event_rows", """
SELECT doc_id AS _id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _tm, gcId, CAST(id AS VARCHAR) AS id, origin
FROM event_rows WHERE origin = 'DISPOSITION' AND tenantid = 't1'""")
oracle("event_columns", "event_rows", """
SELECT doc_id AS _id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _tm, CASE WHEN id % 7 = 0 THEN '{"code":' || id || '}' ELSE '' END AS "Detail",
  CASE WHEN id % 5 = 0 THEN 'n ' || id ELSE '' END AS "a note", gcId, CAST(id AS VARCHAR) AS id, origin
FROM event_rows WHERE origin = 'DISPOSITION' AND tenantid = 't1'""")
oracle("unreadable_events", "event_rows", "SELECT DISTINCT 'bad-' || doc_id AS _id FROM event_rows")


def dump_fields(doc: str) -> str:
    def side(name: str, period: str) -> str:
        return f"""SELECT {doc}CAST({period} AS VARCHAR) AS retentionPeriod, o_orderstatus AS unitOfPeriod, '' AS expiryAction,
  '' AS storeType, '' AS sourceType, '{name}-' || o_orderkey AS name, '' AS category,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS createdDate, '' AS scope, '' AS lastUpdated, 'true' AS enabled FROM orders"""

    return side("a", "o_custkey") + "\nUNION ALL\n" + side("b", "o_custkey + 1")


oracle("shell_dump_rows", "", dump_fields("o_orderkey AS doc, "))
oracle("shell_dump_files", "", dump_fields(""))
oracle("repair_array", "", """
SELECT event_id AS doc, strftime(ts, '%Y-%m-%d %H:%M:%S') AS StartDate, 'x' || event_id AS id FROM events
UNION ALL
SELECT event_id, strftime(ts - INTERVAL 1000000 SECOND, '%Y-%m-%d %H:%M:%S'), 'y' || event_id FROM events""")
oracle("gcid_list", "", "SELECT o_orderkey AS doc, 'gc-' || o_orderkey || ',am-' || o_orderkey AS gcids FROM orders")
oracle("gcid_rows", "", """
SELECT o_orderkey AS doc, 'gc-' || o_orderkey AS gcid FROM orders
UNION ALL SELECT o_orderkey, 'am-' || o_orderkey FROM orders""")
oracle("array_file_rows", "", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS StartDate, 'x' || event_id AS id, 'a } " { [ ' || event_id AS note,
  '{"n":[' || event_id || ']}' AS "in"
FROM events WHERE event_id % 40 <> 0""")
oracle("array_file_rejects", "", """
SELECT count(*) AS n_objects, count(*) FILTER (event_id % 40 = 0) AS n_unreadable FROM events""")
oracle("gcid_file_rows", "", """
SELECT 'gc-' || o_orderkey AS gcid FROM orders UNION ALL SELECT 'am-' || o_orderkey FROM orders""")
oracle("array_records", "archive_metrics", "SELECT _id, gcId, processing_state, src_file FROM archive_metrics")
MONTHS = "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS doc_count FROM orders"
oracle("growth_by_month", "", f"{MONTHS} GROUP BY 1 ORDER BY 1")
oracle("growth_in_range", "", f"""
{MONTHS} WHERE o_orderdate >= TIMESTAMP '1994-03-01' AND o_orderdate <= TIMESTAMP '1997-06-01' GROUP BY 1 ORDER BY 1""")

IN_CHUNK = "m.shard_key >= c.min_key AND m.shard_key < c.max_key"


def chunk_steps(chunks: str, shown: str = "c.min_key, c.max_key", inside: str = IN_CHUNK) -> dict[str, str]:
    return dict(
        inventory=f"""SELECT c.shard, c.chunk_id, {shown}, count(m.shard_key) AS n_rows,
  CAST(coalesce(sum(CASE WHEN m.shard_key IS NULL THEN 0 ELSE 8 + length(gcId) + length(policyId) + length(clusterId) + 4
    + CASE WHEN startDate IS NULL THEN 0 ELSE 8 END END), 0) AS BIGINT) AS n_bytes
  FROM {chunks} c LEFT JOIN keyed_map m ON {inside} GROUP BY ALL"""
    )


SIZE = "printf('%.2f MB', n_bytes / 1048576.0)"
for name, chunks in (("chunk_inventory", "chunks"), ("fine_chunk_inventory", "customer_chunks")):
    oracle(name, f"{chunks} keyed_map", f"SELECT *, {SIZE} AS size_text FROM inventory", **chunk_steps(chunks))
oracle("text_chunk_inventory", "text_chunks keyed_map", f"SELECT *, {SIZE} AS size_text FROM inventory", **chunk_steps(
    "text_chunks", inside="(c.min_key IS NULL OR m.gcId >= c.min_key) AND (c.max_key IS NULL OR m.gcId < c.max_key)"))
oracle("time_chunk_inventory", "time_chunks keyed_map", f"SELECT *, {SIZE} AS size_text FROM inventory", **chunk_steps(
    "time_chunks", "CAST(c.min_key AS VARCHAR) AS min_key, CAST(c.max_key AS VARCHAR) AS max_key",
    "m.startDate >= c.min_key AND m.startDate < c.max_key"))
oracle("compound_chunk_inventory", "compound_chunks keyed_map", f"SELECT *, {SIZE} AS size_text FROM inventory", **chunk_steps(
    "compound_chunks",
    "c.low_cluster || '/' || c.low_seq AS min_key, c.high_cluster || '/' || c.high_seq AS max_key",
    """(m.clusterId > c.low_cluster OR m.clusterId = c.low_cluster AND m.seq >= c.low_seq)
    AND (m.clusterId < c.high_cluster OR m.clusterId = c.high_cluster AND m.seq < c.high_seq)"""))
oracle("chunk_totals", "chunks keyed_map", f"""
SELECT shard, n_chunks, n_rows, n_bytes, {SIZE} AS size_text FROM (
  SELECT coalesce(shard, '(all)') AS shard, count(*) AS n_chunks, CAST(sum(n_rows) AS BIGINT) AS n_rows,
    CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM inventory GROUP BY ROLLUP (shard))""", **chunk_steps("chunks"))
oracle("purge_dry_run", "keyed_map", """
SELECT count(*) FILTER (shard_key >= 600 AND shard_key < 2400) AS n_removed,
  count(*) FILTER (NOT (shard_key >= 600 AND shard_key < 2400)) AS n_kept FROM keyed_map""")
oracle("purge_kept", "keyed_map", "SELECT shard_key, seq, gcId FROM keyed_map WHERE shard_key < 600 OR shard_key >= 2400")
oracle("purged_copy", "keyed_map", "SELECT shard_key, seq, gcId FROM keyed_map WHERE shard_key < 600 OR shard_key >= 2400")
oracle("purge_by_predicate", "archive_metrics", """
SELECT _id FROM archive_metrics WHERE NOT coalesce(processing_state IN ('Archived', 'Duplicate'), false)""")

oracle("csv_sorted_columns", "part_policies", f"""
SELECT {POLICY_EXPORT}, 'category,name,policyId,retentionPeriod,sourceType,unitOfPeriod' AS header FROM part_policies""")
oracle("csv_given_columns", "retention_policy_map", f"""
SELECT {MAP_EXPORT}, 'gcId,policyId,clusterId,channel,network,startDate' AS header FROM retention_policy_map""")
oracle("csv_capped_files", "retention_policy_map", "SELECT count(*) AS n_rows, true AS within_cap FROM retention_policy_map")
oracle("csv_by_index", "archive_metrics", "SELECT _id, gcId, src_file AS index FROM archive_metrics")
oracle("resumed_index_export", "archive_metrics", "SELECT _id, src_file AS index FROM archive_metrics")
oracle("resumed_index_runs", "archive_metrics", """
SELECT src_file AS index, CASE WHEN src_file < 'f-2' THEN '0' ELSE '1' END AS run, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_noted
FROM archive_metrics GROUP BY src_file""")
oracle("json_records", "archive_metrics", "SELECT * FROM archive_metrics")
oracle("id_text_file", "listed_ids", "SELECT gcId FROM listed_ids")
oracle("document_files", "archive_metrics", "SELECT src_file, _id FROM archive_metrics")

oracle("insert_absent_ids", "map_before archive_metrics", "SELECT gcId FROM map_before UNION SELECT gcId FROM archive_metrics")
oracle("ingested_table", "dropped_first dropped_later", """
SELECT * FROM first UNION ALL SELECT * FROM later WHERE gcId NOT IN (SELECT gcId FROM first)""",
    first="""SELECT gcid AS gcId, channel, network FROM dropped_first
  QUALIFY row_number() OVER (PARTITION BY gcid ORDER BY channel, network) = 1""",
    later="""SELECT gcid AS gcId, channel, network FROM dropped_later WHERE gcid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY gcid ORDER BY channel, network) = 1""")
oracle("ingest_rejects", "dropped_later", "SELECT '' AS gcId, channel, network FROM dropped_later WHERE gcid IS NULL")
oracle("incremental_flags", FLAG_VIEWS + " map_before", """
SELECT gcId, ret_policies_expired, sup_policies_expired FROM flags
WHERE gcId IN (SELECT gcId FROM map_before UNION SELECT gcId FROM archive_metrics)""", **FLAG_STEPS)
oracle("incremental_totals", FLAG_VIEWS + " map_before", """
SELECT verdict, count(*) AS evaluated, count(*) FILTER (flag = 'Y') AS expired, count(*) FILTER (flag = 'N') AS active
FROM (SELECT 'ret_policies_expired' AS verdict, ret_policies_expired AS flag, gcId FROM flags
  UNION ALL SELECT 'sup_policies_expired', sup_policies_expired, gcId FROM flags)
WHERE gcId IN (SELECT gcId FROM map_before UNION SELECT gcId FROM archive_metrics)
GROUP BY verdict""", **FLAG_STEPS)
oracle("remaining_files", "archive_metrics", "SELECT DISTINCT src_file FROM archive_metrics WHERE src_file >= 'f-2'")
