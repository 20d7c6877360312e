"""The jobs as commands: ``spark-submit keeprule/jobs.py JOB --option value ...``.

Tables are named by format and path, as ``parquet:/data/map`` or ``csv:/data/map``;
the formats are parquet (the default), csv, json (a record per line), array (JSON arrays) and text.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keeprule.operators import counts, diff, dumps, events, exports, filters, flags, growth, ids, lookups, purge
from keeprule.session import build_session
from keeprule.sources import objects, readers, writers
from keeprule.streaming.evaluate import Evaluation, evaluate_new_ids
from keeprule.streaming.ingest import DropFolder, ingest_if_absent, ingest_until_idle

FORMATS = ("parquet", "csv", "json", "array", "text")
JOBS: dict[str, tuple[Callable, list[str], list[str]]] = {}


def job(required: str, optional: str = ""):
    """Register a job with the names of its options; its function gets them as attributes."""

    def register(run: Callable) -> Callable:
        JOBS[run.__name__.replace("_", "-")] = (run, required.split(), optional.split())
        return run

    return register


def split_format(name: str) -> tuple[str, str]:
    kind, colon, path = name.partition(":")
    return (kind, path) if colon and kind in FORMATS else ("parquet", name)


def load(spark: SparkSession, name: str) -> DataFrame:
    kind, path = split_format(name)
    if kind == "csv":
        return readers.read_csv(spark, path, keep_null=True)
    if kind == "json":
        return readers.read_records(spark, path)
    if kind == "array":
        return objects.read_array(spark, path)
    if kind == "text":
        return readers.read_texts(spark, path)
    return readers.read_table(spark, path)


def save(rows: DataFrame, name: str, columns: list[str] | None = None, max_rows: str | None = None) -> None:
    """Write in the named format. CSV holds arrays as JSON text; text holds the only column."""
    kind, path = split_format(name)
    if kind == "csv":
        nested = {c for c, t in rows.dtypes if t.startswith(("array", "struct", "map"))}
        flat = rows.select(*[F.to_json(c).alias(c) if c in nested else F.col(f"`{c}`") for c in rows.columns])
        writers.write_csv(flat, path, columns, int(max_rows) if max_rows else None)
    elif kind in ("json", "array"):
        writers.write_json(rows, path)
    elif kind == "text":
        writers.write_lines(rows, path, rows.columns[0])
    else:
        rows.write.parquet(path)


def names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",")]


@job("assignments policies cases instant out", "ids totals")
def flag_table(spark, o):
    """With ``totals`` also the number of messages per verdict and of assignments without a start."""
    more = [load(spark, o.ids)] if o.ids else []
    tables = load(spark, o.assignments), load(spark, o.policies), load(spark, o.cases)
    save(flags.flag_table(*tables, o.instant, *more), o.out)
    if o.totals:
        save(flags.flag_totals(*tables, o.instant, *more), o.totals)


@job("assignments policies clusters instant out", "tenancy tenant dense exact_time")
def expiry_counts(spark, o):
    rows, policies, clusters = (load(spark, t) for t in (o.assignments, o.policies, o.clusters))
    if o.tenant:
        rows = counts.if_tenant_active(rows, load(spark, o.tenancy), o.tenant)
    count = counts.expired_counts_dense if o.dense else counts.expired_counts
    result = count(rows, policies, clusters, o.instant, midnight=not o.exact_time)
    save(counts.with_policy_names(result, policies), o.out)


@job("before after out", "policies")
def assignment_diff(spark, o):
    before, after = load(spark, o.before), load(spark, o.after)
    if o.policies:
        report = diff.assignment_diff_named(before, after, load(spark, o.policies))
    else:
        report = diff.assignment_diff(before, after)
    shown = ["gcId", "policyId", *(["name"] if o.policies else []), "n_before", "n_after", "n_new", "n_net_new"]
    save(report, o.out, shown)


@job("rows fields out", "ids key where max_rows")
def export(spark, o):
    rows, fields = load(spark, o.rows), names(o.fields)
    if o.where:
        rows = rows.where(o.where)
    if o.ids:
        wanted = readers.read_ids(spark, o.ids, o.key)
        result, written = exports.observed_export(rows, wanted, o.key, fields)
        save(result, o.out, fields, o.max_rows)
        print({"ids_given": wanted.count(), "rows_written": exports.rows_written(written)})
    else:
        save(filters.project(rows, fields), o.out, fields, o.max_rows)


@job("rows pattern fields finished out", "files_per_index rows_per_file")
def export_indices(spark, o):
    rows = filters.tables_like(load(spark, o.rows), o.pattern)
    fields = names(o.fields)
    shaped = filters.project(rows, [*fields, "index"])
    sizes = {name: int(value) for name in ("files_per_index", "rows_per_file") if (value := getattr(o, name))}
    writers.export_remaining_indices(shaped, o.out, o.finished, fields, **sizes)


@job("ids rows key value out")
def lookup(spark, o):
    wanted = readers.read_ordered_ids(spark, o.ids, o.key)
    found = lookups.first_match(wanted, load(spark, o.rows), o.key, o.value)
    save(found.orderBy("position").select(o.value), o.out)


@job("csv out", "size")
def id_batches(spark, o):
    rows = readers.read_numbered_csv(spark, o.csv, required=("_id",))
    batches = ids.id_batches_in_order(rows, "path", "_id", int(o.size or ids.BATCH_SIZE), "file")
    writers.write_documents(ids.as_json_documents(batches), o.out, "file")


@job("csv out", "size")
def id_documents(spark, o):
    """One JSON document per file with all its ids in order, as files that are read one behind the other."""
    rows = readers.read_numbered_csv(spark, o.csv, required=("_id",))
    batches = ids.id_batches_in_order(rows, "path", "_id", int(o.size or ids.BATCH_SIZE), "file")
    fragments = ids.document_fragments(batches.drop("path"), "file")
    writers.write_fragments(fragments, o.out, "file")


@job("csv column out")
def sorted_ids(spark, o):
    save(ids.sorted_ids(readers.read_csv(spark, o.csv), o.column), o.out)


@job("rows out")
def dedup_rows(spark, o):
    rows = load(spark, o.rows)
    save(rows.dropDuplicates(), o.out, rows.columns)


@job("log origin tenant out", "fields")
def event_rows(spark, o):
    """Without ``fields`` there is a column for every field found in the log."""
    log = load(spark, o.log)
    result = events.event_rows(log, o.origin, o.tenant, names(o.fields) if o.fields else events.found_fields(log))
    save(result, o.out, result.columns)
    print({"unreadable": events.unreadable_events(log).count()})


@job("text out", "fields")
def shell_dump(spark, o):
    fields = names(o.fields) if o.fields else list(dumps.POLICY_FIELDS)
    objects = readers.read_shell_objects(spark, o.text)
    save(dumps.object_rows(objects, fields).select(*fields), o.out, fields)
    print({"unreadable": dumps.unreadable_objects(objects, fields).count()})


def save_objects(spark, rows: DataFrame, out: str, columns: list[str], unreadable: Observation) -> None:
    """Save, and tell how many objects were no JSON, counted in the same pass."""
    save(rows.select(*columns), out, columns)
    print({"unreadable": unreadable.get["n"]})


@job("text fields out", "time_field")
def array_rows(spark, o):
    """Objects of JSON arrays in files of any size."""
    fields, unreadable = names(o.fields), Observation("unreadable objects")
    found = objects.parsed_objects(objects.read_objects(spark, o.text), fields)
    counted = found.observe(unreadable, F.count("unreadable").alias("n"))
    save_objects(spark, dumps.item_rows(counted, fields, o.time_field or "StartDate"), o.out, fields, unreadable)


@job("text out")
def id_list(spark, o):
    """One array of ids per file, of files that fit a task."""
    save(dumps.id_list(readers.read_texts(spark, o.text)).select("gcids"), o.out)


@job("text out")
def id_rows(spark, o):
    """One id per row, of lists in files of any size."""
    unreadable = Observation("unreadable objects")
    found = objects.parsed_objects(objects.read_objects(spark, o.text, quote="'"), ["gcid"])
    counted = found.observe(unreadable, F.count("unreadable").alias("n"))
    save_objects(spark, dumps.item_ids(counted), o.out, ["gcid"], unreadable)


@job("rows start end out")
def month_growth(spark, o):
    save(growth.growth_by_month(load(spark, o.rows), o.start, o.end), o.out)


@job("rows chunks key out totals")
def chunk_inventory(spark, o):
    save(purge.chunk_inventory(load(spark, o.rows), load(spark, o.chunks), o.key), o.out)
    save(purge.chunk_totals(load(spark, o.out)), o.totals)


@job("rows where", "out")
def purge_plan(spark, o):
    """Without ``out`` a dry run; with it the rows to keep are written there."""
    rows, predicate = load(spark, o.rows), F.expr(o.where)
    if o.out:
        purge.write_kept(rows, predicate, o.out)
    else:
        print(purge.purge_dry_run(rows, predicate).first().asDict())


@job("folder headers table rejects checkpoint", "key archive delete max_files poll_seconds idle_seconds")
def ingest(spark, o):
    """One run over the new files; with ``idle_seconds`` further ones until none comes."""
    drop = DropFolder(
        o.folder,
        names(o.headers),
        o.table,
        o.rejects,
        o.checkpoint,
        key=o.key or "gcId",
        archive=o.archive,
        delete=bool(o.delete),
        max_files_per_batch=int(o.max_files) if o.max_files else None,
    )
    if o.idle_seconds:
        ingest_until_idle(spark, drop, float(o.poll_seconds or 10), float(o.idle_seconds))
    else:
        ingest_if_absent(spark, drop)


@job("ids assignments policies instant flags progress checkpoint")
def evaluate(spark, o):
    arriving = Evaluation(o.ids, o.flags, o.progress, o.checkpoint)
    evaluate_new_ids(spark, arriving, load(spark, o.assignments), load(spark, o.policies), o.instant)
    arriving.totals(spark).show(truncate=False)


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (run, required, optional) in JOBS.items():
        command = commands.add_parser(name, help=run.__doc__)
        for option in (*required, *optional):
            command.add_argument("--" + option.replace("_", "-"), required=option in required)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parse(arguments)
    JOBS[options.job][0](spark or build_session(f"keeprule {options.job}"), options)


if __name__ == "__main__":
    main()
