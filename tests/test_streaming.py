"""Incremental jobs: repeated runs, restarts, replays after a failure."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keeprule.operators.exports import remaining_units
from keeprule.operators.flags import both_flags
from keeprule.streaming import tables
from keeprule.streaming.evaluate import Evaluation, evaluate_new_ids
from keeprule.streaming.ingest import DropFolder, ingest_if_absent, ingest_until_idle


def drop_folder(folder, **settings):
    Path(f"{folder}/in").mkdir(exist_ok=True)
    return DropFolder(
        folder=f"{folder}/in",
        headers=["gcid", "v"],
        table=f"{folder}/table",
        rejects=f"{folder}/rejects",
        checkpoint=f"{folder}/checkpoint",
        **settings,
    )


def put(drop, name, *rows):
    Path(f"{drop.folder}/{name}").write_text("gcid,v\n" + "".join(f"{k},{v}\n" for k, v in rows))


def stored(spark, drop):
    return sorted(tuple(r) for r in drop.rows(spark).collect())


def test_first_record_stays(spark, folder):
    drop = drop_folder(folder)
    assert stored(spark, drop) == []
    put(drop, "a.csv", ("g1", "b"), ("g1", "a"), ("g2", "c"), ("", "lost"), ("  ", "blank"))
    put(drop, "b.csv", ("g2", "b"), ("g3", "x"))
    put(drop, "c.txt", ("no", "no"))
    ingest_if_absent(spark, drop)
    assert stored(spark, drop) == [("g1", "a"), ("g2", "b"), ("g3", "x")]
    rejects = spark.read.schema("gcId string, v string").parquet(drop.rejects)
    assert sorted(r["v"] for r in rejects.collect()) == ["blank", "lost"]
    ingest_if_absent(spark, drop)
    put(drop, "d.csv", ("g1", "0"), ("g4", "y"))
    ingest_if_absent(spark, drop)
    assert stored(spark, drop) == [("g1", "a"), ("g2", "b"), ("g3", "x"), ("g4", "y")]


def test_polling_ends_when_no_file_comes(spark, folder, monkeypatch):
    drop = drop_folder(folder)
    put(drop, "a.csv", ("g1", "a"))
    naps = []

    def nap(seconds):
        naps.append(seconds)
        if len(naps) == 1:
            put(drop, "b.csv", ("g2", "b"))

    monkeypatch.setattr("keeprule.streaming.ingest.sleep", nap)
    ingest_until_idle(spark, drop, poll_seconds=3, idle_seconds=0)
    assert naps == [3, 3] and stored(spark, drop) == [("g1", "a"), ("g2", "b")]


def test_file_by_file_gives_one_record_per_key(spark, folder):
    drop = drop_folder(folder, max_files_per_batch=1)
    for i in range(4):
        put(drop, f"{i}.csv", ("same", str(i)), (f"k{i}", "v"))
    ingest_if_absent(spark, drop)
    assert [k for k, _ in stored(spark, drop)] == ["k0", "k1", "k2", "k3", "same"]


def test_a_new_checkpoint_does_not_overwrite_the_table(spark, folder):
    drop = drop_folder(folder)
    put(drop, "a.csv", ("g1", "a"))
    ingest_if_absent(spark, drop)
    again = DropFolder(**{**drop.__dict__, "checkpoint": f"{folder}/other", "names": {"gcid": "gcId"}})
    put(drop, "b.csv", ("g1", "0"), ("g2", "b"))
    ingest_if_absent(spark, again)
    assert stored(spark, drop) == [("g1", "a"), ("g2", "b")]


def test_a_batch_that_failed_midway_is_replayed(spark, folder, monkeypatch):
    drop = drop_folder(folder)
    put(drop, "a.csv", ("g1", "a"), ("g2", "b"))
    real, calls = tables.write_batch, []

    def fail_after_the_table(rows, table, writer, batch_id):
        real(rows, table, writer, batch_id)
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr("keeprule.streaming.ingest.write_batch", fail_after_the_table)
    with pytest.raises(Exception, match="lost"):
        ingest_if_absent(spark, drop)
    assert stored(spark, drop) == [("g1", "a"), ("g2", "b")]
    ingest_if_absent(spark, drop)
    assert stored(spark, drop) == [("g1", "a"), ("g2", "b")]


def test_taken_files_are_moved(spark, folder):
    drop = drop_folder(folder, archive=f"{folder}/done")
    for name in ("a", "b"):
        put(drop, f"{name}.csv", (name, "v"))
        ingest_if_absent(spark, drop)
    ingest_if_absent(spark, drop)
    assert not Path(f"{drop.folder}/a.csv").exists()
    assert [k for k, _ in stored(spark, drop)] == ["a", "b"]


def test_batches_get_the_id_of_their_query(spark, folder):
    seen = []
    spark.range(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id long").parquet(f"{folder}/in")
    query = tables.run_available(stream, f"{folder}/cp", lambda batch, writer, n: seen.append((writer, n, batch.count())))
    assert seen == [(query.id, 0, 3)]


@pytest.mark.parametrize("small", [True, False])
def test_new_ids_are_evaluated_once(spark, folder, small, request):
    if not small:
        request.getfixturevalue("nothing_is_small")
    rows = spark.sql(
        """SELECT concat('g', id % 50) AS gcId, concat('p', id % 3) AS policyId,
          TIMESTAMP_NTZ '2001-06-01 00:00:00' - make_dt_interval(CAST(id % 20 AS INT)) AS startDate FROM range(300)"""
    )
    rules = spark.sql(
        """SELECT * FROM VALUES ('p0', 5, 'day', NULL), ('p1', 10, 'day', 'supervision'), ('p2', 1, 'day', 'archive')
        AS t(policyId, retentionPeriod, unitOfPeriod, sourceType)"""
    )
    job = Evaluation(f"{folder}/ids", f"{folder}/flags", f"{folder}/progress", f"{folder}/cp")

    def arrive(low, high):
        spark.range(low, high).select(F.concat(F.lit("g"), "id").alias("gcId")).write.mode("append").parquet(job.ids)
        evaluate_new_ids(spark, job, rows, rules, "2001-06-01")

    arrive(0, 30)
    first = job.flag_rows(spark).count()
    evaluate_new_ids(spark, job, rows, rules, "2001-06-01")
    assert first == job.flag_rows(spark).count() == 30
    arrive(20, 60)  # ten of them again
    ids = spark.range(60).select(F.concat(F.lit("g"), "id").alias("gcId"))
    expected = {tuple(r) for r in both_flags(rows, rules, "2001-06-01", ids).collect()}
    assert {tuple(r) for r in job.flag_rows(spark).collect()} == expected
    totals = {r["verdict"]: (r["evaluated"], r["expired"] + r["active"]) for r in job.totals(spark).collect()}
    assert totals == {"ret_policies_expired": (60, 60), "sup_policies_expired": (60, 60)}


def test_remaining_units(spark):
    units = spark.sql("SELECT * FROM VALUES ('a'), ('a'), ('b'), ('c') AS t(u)")
    done = spark.sql("SELECT 'b' AS u")
    assert sorted(r["u"] for r in remaining_units(units, done, "u").collect()) == ["a", "c"]
