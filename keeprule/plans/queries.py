"""The queries by name. Each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keeprule.functions.instants import parse_instant
from keeprule.functions.text import or_empty
from keeprule.operators import (
    counts,
    diff,
    dumps,
    events,
    exports,
    filters,
    flags,
    growth,
    ids,
    lookups,
    policies,
    purge,
    upserts,
)
from keeprule.plans.views import INSTANT, Archive
from keeprule.session import new_folder
from keeprule.sources import objects, readers, writers
from keeprule.streaming.evaluate import Evaluation, evaluate_new_ids
from keeprule.streaming.keyed import BucketedRows
from keeprule.streaming.ingest import DropFolder, ingest_if_absent

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAP_FIELDS = ["gcId", "policyId", "clusterId", "channel", "network", "startDate"]
POLICY_FIELDS = ["policyId", "name", "sourceType", "category", "retentionPeriod", "unitOfPeriod"]


def query(build: Callable[[Archive], DataFrame]) -> Query:
    """Register a query under the name of its function."""

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Archive(spark, folder))

    QUERIES[build.__name__] = run
    return run


def listed(column: str) -> F.Column:
    return F.array_join(column, ",").alias(column)


# --- thresholds -----------------------------------------------------------------


@query
def policy_thresholds(a: Archive) -> DataFrame:
    table = policies.policy_thresholds(a.part_policies, INSTANT)
    return table.select("policyId", F.col("threshold").cast("string").alias("threshold"))


@query
def policy_thresholds_midnight(a: Archive) -> DataFrame:
    table = policies.policy_thresholds(a.part_policies, INSTANT, midnight=True)
    return table.select("policyId", F.col("threshold").cast("string").alias("threshold"))


@query
def parsed_instants(a: Archive) -> DataFrame:
    local = F.translate(F.col("o_orderdate").cast("string"), " ", "T")
    zone = F.when(F.col("o_orderkey") % 3 == 0, "Z").when(F.col("o_orderkey") % 3 == 1, "+02:00").otherwise("")
    return a.table("orders").select(
        "o_orderkey", parse_instant(F.concat(local, zone)).cast("string").alias("instant")
    )


# --- verdicts per message -------------------------------------------------------


@query
def unique_gcids(a: Archive) -> DataFrame:
    return flags.unique_ids(a.retention_policy_map)


@query
def ret_flags(a: Archive) -> DataFrame:
    return flags.retention_flags(a.retention_policy_map, a.retention_policies, INSTANT, a.archive_metrics)


@query
def sup_flags(a: Archive) -> DataFrame:
    return flags.supervision_flags(a.retention_policy_map, a.retention_policies, INSTANT, a.archive_metrics)


@query
def case_holds(a: Archive) -> DataFrame:
    return flags.case_holds(a.held_items)


@query
def flag_table(a: Archive) -> DataFrame:
    return flags.flag_table(
        a.retention_policy_map, a.retention_policies, a.held_items, INSTANT, a.archive_metrics
    )


@query
def flag_totals(a: Archive) -> DataFrame:
    return flags.flag_totals(
        a.retention_policy_map, a.retention_policies, a.held_items, INSTANT, a.archive_metrics
    )


@query
def flag_upsert(a: Archive) -> DataFrame:
    """Case holds set on the retention flags, message by message."""
    verdicts = flags.retention_flags(a.retention_policy_map, a.retention_policies, INSTANT)
    return upserts.set_flag(verdicts, flags.case_holds(a.held_items), "gcId", "case_hold")


# --- expired counts -------------------------------------------------------------


@query
def active_tenants(a: Archive) -> DataFrame:
    return counts.active_tenants(a.customer_tenancy)


@query
def expired_by_cluster_policy(a: Archive) -> DataFrame:
    rows = counts.if_tenant_active(a.retention_policy_map, a.tenancy, "t1")
    return counts.expiry_report(rows, a.retention_policies, a.cluster, INSTANT)


@query
def expired_closed_tenant(a: Archive) -> DataFrame:
    rows = counts.if_tenant_active(a.retention_policy_map, a.tenancy, "t2")
    return counts.expiry_report(rows, a.retention_policies, a.cluster, INSTANT)


@query
def expired_to_the_minute(a: Archive) -> DataFrame:
    return counts.expired_counts(
        a.retention_policy_map, a.retention_policies, a.cluster, INSTANT, midnight=False
    )


@query
def expired_dense(a: Archive) -> DataFrame:
    return counts.expired_counts_dense(a.retention_policy_map, a.retention_policies, a.cluster, INSTANT)


@query
def expired_one_pair(a: Archive) -> DataFrame:
    return counts.expired_count_of(a.retention_policy_map, a.retention_policies, "cl-1", "pol-7", INSTANT)


# --- assignments before and after -----------------------------------------------


@query
def assignment_counts(a: Archive) -> DataFrame:
    return diff.assignment_counts(a.map_before, a.map_after)


@query
def assignment_changes(a: Archive) -> DataFrame:
    return diff.assignment_changes(a.map_before, a.map_after)


@query
def assignment_diff(a: Archive) -> DataFrame:
    return diff.assignment_diff(a.map_before, a.map_after)


@query
def assignment_diff_named(a: Archive) -> DataFrame:
    return diff.assignment_diff_named(a.map_before, a.map_after, a.retention_policies)


@query
def sorted_assignments(a: Archive) -> DataFrame:
    rows = a.retention_policy_map.select("gcId", "policyId", "channel", "clusterId", "network")
    return filters.sort_rows(rows, "gcId", "policyId", "channel", "clusterId", "network")


# --- exports --------------------------------------------------------------------


@query
def full_scan(a: Archive) -> DataFrame:
    return a.archive_metrics


@query
def field_export(a: Archive) -> DataFrame:
    return filters.project(a.archive_metrics, ["gcId", "processing_state", "channel"])


@query
def hit_export(a: Archive) -> DataFrame:
    """Search hits written as JSON, of which one table's stored documents are exported."""
    path = new_folder(a.spark, "hits")
    hits = a.archive_metrics.select(
        F.col("src_file").alias("_index"), F.struct("_id", "gcId", "processing_state").alias("_source")
    )
    writers.write_json(hits, path)
    found = filters.tables_like(readers.read_records(a.spark, path), "f-1", "_index")
    return filters.project(filters.unwrap_source(found), ["gcId", "processing_state", "other"])


@query
def open_states(a: Archive) -> DataFrame:
    return filters.open_records(a.archive_metrics).select("_id")


@query
def archived_ids(a: Archive) -> DataFrame:
    return a.archive_metrics.where(F.col("processing_state") == "Archived").select("gcId")


@query
def pending_snapshots(a: Archive) -> DataFrame:
    history = a.hold_request_history
    return history.where((F.col("holdRequestId") == "hr-3") & filters.is_not("status", "SUCCESS")).select("snapshotId")


@query
def listed_channels(a: Archive) -> DataFrame:
    wanted = F.col("policyId").isin("pol-1", "pol-5", "pol-26")
    return a.retention_policy_map.where(wanted).select("_id", "policyId")


@query
def policy_report(a: Archive) -> DataFrame:
    return filters.project(a.part_policies, POLICY_FIELDS)


@query
def renamed_headers(a: Archive) -> DataFrame:
    return filters.rename_headers(a.case_items, {"gcid": "gcId"})


@query
def index_scan(a: Archive) -> DataFrame:
    rows = a.archive_metrics.withColumnRenamed("src_file", "index")
    return filters.tables_like(rows, "f*[12]").select("_id", "index")


@query
def ids_export(a: Archive) -> DataFrame:
    return exports.export_by_ids(a.retention_policy_map, a.listed_ids, "gcId", MAP_FIELDS)


@query
def export_totals(a: Archive) -> DataFrame:
    return exports.export_totals(a.retention_policy_map, a.listed_ids, "gcId")


@query
def snapshot_lookup(a: Archive) -> DataFrame:
    return lookups.first_match(a.snapshot_list, a.archive_metrics, "snapshot_id", "gcId")


@query
def page_after(a: Archive) -> DataFrame:
    return filters.page_after(a.retention_policy_map, "_id", "2000-", 500).select("_id", "gcId")


@query
def id_batches(a: Archive) -> DataFrame:
    batches = ids.id_batches(a.archive_metrics, "src_file", "_id")
    return batches.select("src_file", "batch", "n_ids", listed("ids"))


@query
def file_id_batches(a: Archive) -> DataFrame:
    """Ids packed file by file; a batch is full unless it is the last of its file."""
    path = new_folder(a.spark, "id-files")
    writers.write_csv(a.archive_metrics.select("_id"), path, max_rows_per_file=4_321)
    batches = ids.id_batches_in_order(readers.read_numbered_csv(a.spark, path, ("_id",)), "path", "_id")
    last = F.max("batch").over(Window.partitionBy("path"))
    full = (F.col("n_ids") == ids.BATCH_SIZE) | (F.col("batch") == last)
    return batches.withColumn("full", full).select(F.explode("ids").alias("_id"), "full")


@query
def file_documents(a: Archive) -> DataFrame:
    """One document per file, written in fragments and read again; files hold their ids in ascending order."""
    path, written = new_folder(a.spark, "id-files"), new_folder(a.spark, "file-documents")
    writers.write_csv(a.archive_metrics.select("_id").orderBy("_id"), path)
    batches = ids.id_batches_in_order(readers.read_numbered_csv(a.spark, path, ("_id",)), "path", "_id", 700, "file")
    writers.write_fragments(ids.document_fragments(batches.drop("path"), "file"), written, "file")
    part = F.struct(F.col("_metadata.file_name").alias("name"), F.monotonically_increasing_id().alias("line"))
    fragments = a.spark.read.text(written).select("file", part.alias("part"), "value")
    before, last = Window.partitionBy("file").orderBy("part"), Window.partitionBy("file")
    opened = F.col("value").startswith('{"archiveMetricIds":[') == (F.row_number().over(before) == 1)
    closed = F.col("value").endswith("]}") == (F.col("part") == F.max("part").over(last))
    checked = fragments.withColumn("whole", opened & closed)
    ids_of = checked.select(F.regexp_extract_all("value", F.lit('"(am-[^"]*)"'), F.lit(1)).alias("ids"), "whole")
    # Once for a fragment: beside the explode it would be worked out for each of the fragment's ids.
    ordered = ids_of.withColumn("in_order", F.array_sort("ids") == F.col("ids"))
    return ordered.select(F.explode("ids").alias("_id"), "whole", "in_order")


@query
def id_documents(a: Archive) -> DataFrame:
    documents = ids.id_documents(a.archive_metrics, "src_file", "_id", 2_500)
    return ids.as_json_documents(documents)


@query
def sorted_ids(a: Archive) -> DataFrame:
    padded = F.concat(F.lit(" "), "gcId", F.lit("\t")).alias("gcid")
    return ids.sorted_ids(a.retention_policy_map.select(padded), "gcid")


@query
def dedup_rows(a: Archive) -> DataFrame:
    return a.retention_policy_map.select("gcId", "channel", "network").dropDuplicates()


@query
def union_slices(a: Archive) -> DataFrame:
    return a.map_before.unionByName(a.map_after)


# --- events, dumps and growth ---------------------------------------------------


@query
def event_failures(a: Archive) -> DataFrame:
    return events.event_rows(a.event_log, "DISPOSITION", "t1", ["gcId", "id", "origin"])


@query
def event_columns(a: Archive) -> DataFrame:
    """Events with a column for every field that any of them has."""
    return events.event_table(a.varied_log, "DISPOSITION", "t1")


@query
def unreadable_events(a: Archive) -> DataFrame:
    """Every log document followed by a broken copy of itself, counted as readable or not."""
    log = a.event_log
    broken = log.select(F.concat(F.lit("bad-"), "_id").alias("_id"), F.concat("events", F.lit(" x]")).alias("events"))
    return events.unreadable_events(log.unionByName(broken)).select("_id")


@query
def shell_dump_rows(a: Archive) -> DataFrame:
    return dumps.shell_dump_rows(a.shell_dumps)


@query
def shell_dump_files(a: Archive) -> DataFrame:
    """The same rows, from text files that are read in pieces."""
    path = new_folder(a.spark, "dumps")
    writers.write_lines(a.shell_dumps, path, "value")
    return dumps.object_rows(readers.read_shell_objects(a.spark, path)).drop("file")


@query
def repair_array(a: Archive) -> DataFrame:
    return dumps.array_rows(a.wrapped_arrays, ["StartDate", "id"])


def _listed_objects(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "objects")
    writers.write_lines(a.listed_objects, path, "value")
    return objects.parsed_objects(objects.read_objects(a.spark, path), ["StartDate", "id", "note", "in"])


@query
def array_file_rows(a: Archive) -> DataFrame:
    """Objects out of text files, with braces and quotes inside strings, broken ones between them."""
    return dumps.item_rows(_listed_objects(a), ["StartDate", "id", "note", "in"]).drop("file")


@query
def array_file_rejects(a: Archive) -> DataFrame:
    return _listed_objects(a).agg(F.count("*").alias("n_objects"), F.count("unreadable").alias("n_unreadable"))


@query
def gcid_file_rows(a: Archive) -> DataFrame:
    """Ids out of single-quoted lists in text files."""
    path = new_folder(a.spark, "id-lists")
    writers.write_lines(a.id_objects, path, "value")
    parsed = objects.parsed_objects(objects.read_objects(a.spark, path, quote="'"), ["gcid"])
    return dumps.item_ids(parsed).drop("file")


@query
def array_records(a: Archive) -> DataFrame:
    """Records of JSON arrays, their columns found in the data."""
    path = new_folder(a.spark, "arrays")
    record = F.to_json(F.struct("_id", "gcId", "processing_state", "src_file"))
    writers.write_lines(a.archive_metrics.select(F.concat(record, F.lit(",")).alias("value")), path, "value")
    return objects.read_array(a.spark, path).select("_id", "gcId", "processing_state", "src_file")


@query
def gcid_list(a: Archive) -> DataFrame:
    return dumps.id_list(a.id_objects).select("doc", listed("gcids"))


@query
def gcid_rows(a: Archive) -> DataFrame:
    return dumps.id_rows(a.id_objects)


@query
def growth_by_month(a: Archive) -> DataFrame:
    return growth.growth_by_month(a.docs_by_oid, "1990-01-01", "2030-01-01")


@query
def growth_in_range(a: Archive) -> DataFrame:
    return growth.growth_by_month(a.docs_by_oid, "1994-03-01", "1997-06-01")


# --- purge planning -------------------------------------------------------------


@query
def chunk_inventory(a: Archive) -> DataFrame:
    return purge.chunk_inventory(a.keyed_map, a.chunks, "shard_key")


@query
def fine_chunk_inventory(a: Archive) -> DataFrame:
    return purge.chunk_inventory(a.keyed_map, a.customer_chunks, "shard_key")


@query
def text_chunk_inventory(a: Archive) -> DataFrame:
    """Chunks of text keys, which overlap; one has no lower and one no upper bound."""
    return purge.chunk_inventory(a.keyed_map, a.text_chunks, "gcId")


@query
def time_chunk_inventory(a: Archive) -> DataFrame:
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("min_key", "max_key")}
    found = purge.chunk_inventory(a.keyed_map, a.time_chunks.withColumns(bounds), "startDate")
    return found.withColumns({c: F.col(c).cast("date").cast("string") for c in bounds})


@query
def compound_chunk_inventory(a: Archive) -> DataFrame:
    """Chunks of a key of two columns."""
    bounds = {f"{end}_key": F.struct(F.col(f"{side}_cluster").alias("clusterId"), F.col(f"{side}_seq").cast("int").alias("seq")) for end, side in (("min", "low"), ("max", "high"))}
    found = purge.chunk_inventory(a.keyed_map.withColumn("seq", F.col("seq").cast("int")), a.compound_chunks.withColumns(bounds), ["clusterId", "seq"])
    return found.withColumns({c: F.concat_ws("/", f"{c}.clusterId", F.col(f"{c}.seq").cast("string")) for c in bounds})


@query
def chunk_totals(a: Archive) -> DataFrame:
    return purge.chunk_totals(purge.chunk_inventory(a.keyed_map, a.chunks, "shard_key"))


@query
def purge_dry_run(a: Archive) -> DataFrame:
    return purge.purge_dry_run(a.keyed_map, filters.in_range("shard_key", 600, 2400))


@query
def purge_kept(a: Archive) -> DataFrame:
    return purge.purge_kept(a.keyed_map, filters.in_range("shard_key", 600, 2400)).select("shard_key", "seq", "gcId")


@query
def purged_copy(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "kept")
    purge.write_kept(a.keyed_map, filters.in_range("shard_key", 600, 2400), path)
    return a.spark.read.parquet(path).select("shard_key", "seq", "gcId")


@query
def purge_by_predicate(a: Archive) -> DataFrame:
    """Nothing is known of a missing state, so such records are kept."""
    return purge.purge_kept(a.archive_metrics, F.col("processing_state").isin("Archived", "Duplicate")).select("_id")


# --- files written and read back ------------------------------------------------


@query
def csv_sorted_columns(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "policies")
    writers.write_csv(filters.project(a.part_policies, POLICY_FIELDS), path)
    rows = readers.read_csv(a.spark, path, required=("policyId",))
    return rows.withColumn("header", F.lit(",".join(rows.columns)))


@query
def csv_given_columns(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "map")
    writers.write_csv(filters.project(a.retention_policy_map, MAP_FIELDS), path, MAP_FIELDS)
    rows = readers.read_csv(a.spark, path)
    return rows.withColumn("header", F.lit(",".join(rows.columns)))


@query
def csv_capped_files(a: Archive) -> DataFrame:
    """Rows and longest file of an export that is cut in files of 5,000 rows."""
    path = new_folder(a.spark, "capped")
    writers.write_csv(a.retention_policy_map.select("_id"), path, max_rows_per_file=writers.EXPORT_FILE_ROWS)
    per_file = readers.read_csv(a.spark, path, with_file="file").groupBy("file").agg(F.count("*").alias("n"))
    return per_file.agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= writers.EXPORT_FILE_ROWS).alias("within_cap")
    )


@query
def csv_by_index(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "index")
    rows = a.archive_metrics.withColumnRenamed("src_file", "index")
    shaped = filters.project(rows, ["_id", "gcId", "index"])
    writers.write_csv_by_index(shaped, path, ["_id", "gcId"], rows_per_file=2_000)
    return filters.tables_like(readers.read_csv(a.spark, path), "f-*")


def _resumed(a: Archive) -> tuple[str, str]:
    """An export whose first run only had two of the indices, and whose last run had nothing to do."""
    path, finished = new_folder(a.spark, "resumed"), new_folder(a.spark, "finished")
    rows = a.archive_metrics.select("_id", F.col("src_file").alias("index"), F.lit(1).alias("run"))
    for run, part in enumerate((rows.where(F.col("index") < "f-2"), rows, rows)):
        writers.export_remaining_indices(part.withColumn("run", F.lit(run)), path, finished, ["_id", "run"])
    return path, finished


@query
def resumed_index_export(a: Archive) -> DataFrame:
    return readers.read_csv(a.spark, _resumed(a)[0]).drop("run")


@query
def resumed_index_runs(a: Archive) -> DataFrame:
    """Which run wrote each index, and how often it is noted as finished."""
    path, finished = _resumed(a)
    noted = a.spark.read.parquet(finished).groupBy("index").agg(F.count("*").alias("n_noted"))
    written = readers.read_csv(a.spark, path).groupBy("index", "run").agg(F.count("*").alias("n_rows"))
    return written.join(noted, "index", "full")


@query
def json_records(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "json")
    writers.write_json(a.archive_metrics, path)
    return readers.read_records(a.spark, path)


@query
def id_text_file(a: Archive) -> DataFrame:
    path = new_folder(a.spark, "ids")
    padded = a.listed_ids.select(F.concat(F.lit("  "), "gcId", F.lit(" ")).alias("gcId"))
    writers.write_lines(padded.unionByName(padded.select(F.lit(" ").alias("gcId"))), path, "gcId")
    return readers.read_ids(a.spark, path, "gcId")


@query
def document_files(a: Archive) -> DataFrame:
    """Id batches as JSON documents in text files, unpacked again."""
    path = new_folder(a.spark, "documents")
    batches = ids.id_batches(a.archive_metrics, "src_file", "_id")
    writers.write_documents(ids.as_json_documents(batches), path, "src_file")
    document = F.from_json("value", "archiveMetricIds array<string>")
    return a.spark.read.text(path).select("src_file", F.explode(document["archiveMetricIds"]).alias("_id"))


# --- incremental work -----------------------------------------------------------


@query
def insert_absent_ids(a: Archive) -> DataFrame:
    target = flags.unique_ids(a.map_before)
    return upserts.insert_absent(target, a.archive_metrics.select("gcId"), "gcId")


def _drop_folder(spark: SparkSession) -> DropFolder:
    base = new_folder(spark, "drop")
    return DropFolder(
        folder=f"{base}/in",
        headers=["gcid", "channel", "network"],
        table=f"{base}/table",
        rejects=f"{base}/rejects",
        checkpoint=f"{base}/checkpoint",
    )


def _ingested(a: Archive) -> DropFolder:
    """Two waves of dropped files, each taken in by a run of its own."""
    drop = _drop_folder(a.spark)
    for wave in (a.dropped_first, a.dropped_later):
        writers.write_csv(wave, drop.folder, drop.headers, mode="append")
        ingest_if_absent(a.spark, drop)
    return drop


@query
def ingested_table(a: Archive) -> DataFrame:
    return _ingested(a).rows(a.spark)


@query
def ingest_rejects(a: Archive) -> DataFrame:
    drop = _ingested(a)
    return a.spark.read.schema(drop.schema).parquet(drop.rejects).select(
        or_empty(F.col("gcId")).alias("gcId"), "channel", "network"
    )


def _evaluated(a: Archive, bucketed: bool = False) -> Evaluation:
    """Ids arriving in two waves, each evaluated by a run of its own."""
    base = new_folder(a.spark, "evaluate")
    assignments = a.retention_policy_map
    if bucketed:
        stored = BucketedRows(f"{base}/assignments", assignments.schema, "gcId", buckets=16)
        stored.write(assignments)
        assignments = stored
    job = Evaluation(f"{base}/ids", f"{base}/flags", f"{base}/progress", f"{base}/checkpoint")
    first = flags.unique_ids(a.map_before)
    for wave in (first, a.archive_metrics.select("gcId")):  # with ids that were there before
        wave.write.mode("append").parquet(job.ids)
        evaluate_new_ids(a.spark, job, assignments, a.retention_policies, INSTANT)
    return job


@query
def incremental_flags(a: Archive) -> DataFrame:
    return _evaluated(a).flag_rows(a.spark)


@query
def incremental_totals(a: Archive) -> DataFrame:
    """Assignments stored in buckets by message, of which a wave reads those of its ids."""
    return _evaluated(a, bucketed=True).totals(a.spark)


@query
def remaining_files(a: Archive) -> DataFrame:
    finished = a.archive_metrics.where(F.col("src_file") < "f-2").select("src_file")
    return exports.remaining_units(a.archive_metrics, finished, "src_file")
