"""Tables by key buckets: folds, restarts, and how much a batch reads."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.operators.upserts import absent_records
from keeprule.streaming import keyed
from keeprule.streaming.keyed import BucketedRows, KeyedTable
from keeprule.streaming.tables import write_batch

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def records(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def take(spark, table, pairs, writer, batch_id):
    """One batch as a streaming job handles it."""
    batch = records(spark, pairs)
    table.fold_before(spark, writer, batch_id)
    stored = table.rows_before(spark, batch, writer, batch_id)
    read = len(stored.inputFiles())
    write_batch(absent_records(batch, stored, "k", small=False).coalesce(1), table.path, writer, batch_id)
    return read


def content(spark, table):
    return dict(tuple(r) for r in table.rows(spark).collect())


def test_a_batch_reads_no_more_files_as_batches_go_by(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=4, fold_after=3, most_runs=2)
    expected, read = {}, []
    for n in range(18):
        pairs = [(f"k{n * 3 + i}", n) for i in range(5)]  # two of five keys come again
        read.append(take(spark, table, pairs, "w", n))
        expected = dict(pairs) | expected
        assert content(spark, table) == expected
    assert max(read[9:]) <= 4 * (2 + 1) + 3 and max(read[9:]) <= max(read[:9]) + 2
    assert table.rows(spark).count() == len(expected)


def test_a_batch_reads_the_runs_of_its_buckets_only(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=8, fold_after=1)
    take(spark, table, [(f"k{i}", i) for i in range(200)], "w", 0)
    take(spark, table, [("k1", 9)], "w", 1)  # folds the first batch
    batch = records(spark, [("k7", 0)])
    bucket = table.buckets_of(batch)
    assert len(bucket) == 1
    table.fold_before(spark, "w", 2)
    files = [r[0] for r in table.rows_before(spark, batch, "w", 2).select(F.input_file_name()).distinct().collect()]
    assert files and all(f"/bucket={bucket[0]}/" in f for f in files)


def test_a_fold_that_fails_before_its_manifest_changes_nothing(spark, folder, monkeypatch):
    table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=4, fold_after=2, most_runs=1)
    for n in range(4):
        take(spark, table, [(f"k{n}", n), ("same", n)], "w", n)
    before = content(spark, table)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            take(spark, table, [("k9", 9)], "w", 4)
    assert content(spark, table) == before
    take(spark, table, [("k9", 9)], "w", 4)
    take(spark, table, [("k9", 10)], "w", 4)  # replayed after a failure further on
    assert content(spark, table) == before | {"k9": 10}


def test_a_manifest_cut_off_leaves_the_one_before(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=2, fold_after=1)
    for n in range(4):
        take(spark, table, [(f"k{n}", n)], "w", n)
    state = table.state(spark)
    keyed.delete_folders(spark, [table._slot(state.seq + 1)])  # as an overwrite does before it writes
    assert table.state(spark) == state and len(content(spark, table)) == 4


def test_a_new_writer_folds_what_others_left(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=2, fold_after=8)
    for n, writer in enumerate("abcdef"):
        take(spark, table, [(writer, n), ("same", n)], writer, 0)
    assert content(spark, table) == {"same": 0} | {w: n for n, w in enumerate("abcdef")}
    assert set(table.state(spark).folded) == set("abcde")
    table.fold_before(spark, "g", 0)
    assert not table._recent(spark, table.state(spark)).count() and content(spark, table)["f"] == 5


def test_files_that_were_folded_are_removed_by_the_next_fold(spark, folder):
    table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=1, fold_after=1, most_runs=1)
    for n in range(5):
        take(spark, table, [(f"k{n}", n)], "w", n)
    left = spark.read.schema("k string, v long, writer string, batch_id long").parquet(table.path)
    assert {r[0] for r in left.select("batch_id").distinct().collect()} == {3, 4}
    assert len(content(spark, table)) == 5


def test_bucketed_rows_are_pruned(spark, folder):
    rows = spark.range(500).select(F.concat(F.lit("g"), F.col("id") % 50).alias("gcId"), "id")
    stored = BucketedRows(f"{folder}/b", rows.schema, "gcId", buckets=8, files_per_bucket=2)
    stored.write(rows)
    assert sorted(r["id"] for r in stored.rows(spark).collect()) == list(range(500))
    some = stored.rows(spark, [3, 5])
    assert {r[0] for r in some.select(keyed.bucket_of("gcId", 8)).distinct().collect()} <= {3, 5}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert stored.rows(spark, []).count() == 0


@pytest.mark.parametrize("stored_as", ["rows", "run"])
def test_a_large_bucket_is_written_by_several_tasks(spark, folder, stored_as):
    """One key has all rows, and rows that are equal; no task takes the whole bucket, whatever its size."""
    rows = spark.range(0, 200_000, 1, 8).select(F.lit("k").alias("k"), F.pmod(F.xxhash64(F.col("id") % 150_000), F.lit(1 << 60)).alias("v"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "300k")
    try:
        if stored_as == "rows":
            table = BucketedRows(f"{folder}/b", rows.schema, "k", buckets=4)
            table.write(rows)
            files = table.rows(spark).inputFiles()
        else:
            table = KeyedTable(f"{folder}/t", SCHEMA, "k", buckets=4, fold_after=1)
            write_batch(rows, table.path, "w", 0)
            assert table.fold_before(spark, "w", 1)
            files = table._in_runs(spark, table.state(spark), list(range(4))).inputFiles()
    finally:
        spark.conf.set(name, before)
    assert len(files) >= 3 and len({f.split("/bucket=")[1][0] for f in files}) == 1
    assert table.rows(spark).groupBy("k", "v").count().groupBy("count").count().orderBy("count").collect() == [(1, 100_000), (2, 50_000)]
