"""Reading and writing files."""

import gzip
import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keeprule.operators import dumps, ids
from keeprule.sources import readers, writers

AWKWARD = [("a,b", 'say "hi"'), ("", " padded "), ("back\\slash", "it's"), ("é", "\\")]


def csv_rows(folder):
    rows = []
    for file in sorted(Path(folder).rglob("*.csv")):
        with open(file, newline="", encoding="utf-8") as handle:
            rows += [tuple(r.values()) for r in csv.DictReader(handle)]
    return rows


def test_csv_values_survive(spark, folder):
    rows = spark.createDataFrame(AWKWARD + [(None, "x")], "b string, a string")
    writers.write_csv(rows, f"{folder}/out")
    assert sorted(csv_rows(f"{folder}/out")) == sorted([(a, b or "") for b, a in AWKWARD] + [("x", "")])
    back = readers.read_csv(spark, f"{folder}/out")
    assert back.columns == ["a", "b"]
    assert sorted(tuple(r) for r in back.collect()) == sorted([(a, b or "") for b, a in AWKWARD] + [("x", "")])


def test_csv_with_line_breaks(spark, folder):
    rows = spark.createDataFrame([("1", "two\nlines"), ("2", "one")], "k string, v string")
    writers.write_csv(rows, f"{folder}/out", ["v", "k"])
    back = readers.read_csv(spark, f"{folder}/out", multiline=True)
    assert sorted(tuple(r) for r in back.collect()) == [("one", "2"), ("two\nlines", "1")]


def test_required_column(spark, folder):
    Path(f"{folder}/a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="_id"):
        readers.read_csv(spark, folder, required=("_id",))


def test_many_files_are_one_table(spark, folder):
    Path(f"{folder}/a.csv").write_text("gcid\n g1\ng2\n")
    Path(f"{folder}/b.csv").write_text("gcid\ng2\n")
    Path(f"{folder}/c.txt").write_text("gcid\nno\n")
    rows = readers.read_csv(spark, folder, with_file="file")
    assert sorted(tuple(r) for r in rows.collect()) == [(" g1", "a"), ("g2", "a"), ("g2", "b")]


def test_files_with_other_headers_are_refused(spark, folder):
    Path(f"{folder}/a.csv").write_text("x,y\n1,2\n")
    Path(f"{folder}/b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, folder).collect()


def test_files_are_cut_at_the_row_limit(spark, folder):
    writers.write_csv(spark.range(1000).coalesce(1), f"{folder}/out", max_rows_per_file=300)
    sizes = sorted(len(csv_rows_of(f)) for f in Path(f"{folder}/out").glob("*.csv"))
    assert sizes == [100, 300, 300, 300]


def csv_rows_of(file):
    with open(file, newline="") as handle:
        return list(csv.DictReader(handle))


def test_a_folder_per_index(spark, folder):
    rows = spark.sql("SELECT concat('i', id % 3) AS index, id AS v FROM range(90)")
    writers.write_csv_by_index(rows, f"{folder}/out", ["v"], files_per_index=2)
    for i in range(3):
        files = list(Path(f"{folder}/out/index=i{i}").glob("*.csv"))
        assert 1 <= len(files) <= 2
        assert sorted(int(r["v"]) for f in files for r in csv_rows_of(f)) == list(range(i, 90, 3))


def test_ids_are_stripped_and_keep_their_order(spark, folder):
    Path(f"{folder}/ids.txt").write_text(" a \n\n\tb\nc\r\n  \na\n")
    assert sorted(r["id"] for r in readers.read_ids(spark, folder).collect()) == ["a", "a", "b", "c"]
    ordered = readers.read_ordered_ids(spark, folder).orderBy("position")
    assert [r["id"] for r in ordered.collect()] == ["a", "b", "c", "a"]


def test_json_fields_are_united(spark, folder):
    Path(f"{folder}/a.json").write_text('{"b": 1}\n{"a": "x", "c": {"d": 2}}\n')
    rows = readers.read_records(spark, folder)
    assert rows.columns == ["a", "b", "c"] and rows.count() == 2
    Path(f"{folder}/array").mkdir()
    Path(f"{folder}/array/a.json").write_text('[{"b": 1},\n {"b": 2}]')
    assert readers.read_records(spark, f"{folder}/array", one_array=True).count() == 2


DUMPS = {
    "ends with an object.txt": 'x {"name": "a1"}, {"name": "a2", "n": NumberInt(3)}',
    "ends with text.txt": '{"name": "b1"}\n{} { {"name": "b2"} tail é',
    "cut off.txt": '{"name": "c1"}\n{"name": "c2"',
    "no object.txt": "nothing here",
    "only the end.txt": 'a } b } {"name": "e1"}\n',
    "empty.txt": "",
}


@pytest.mark.parametrize("split_bytes", [None, "7"])
def test_objects_are_the_same_in_pieces_and_in_whole_texts(spark, folder, split_bytes):
    for name, text in DUMPS.items():
        Path(f"{folder}/{name}").write_text(text)
    try:
        if split_bytes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        pieces = sorted(tuple(r) for r in readers.read_shell_objects(spark, folder).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = dumps.shell_objects(readers.read_texts(spark, folder))
    packed = f"{folder}/packed"
    for name, text in DUMPS.items():
        Path(packed).mkdir(exist_ok=True)
        Path(f"{packed}/{name}.gz").write_bytes(gzip.compress(text.encode()))
    assert sorted((r["file"].removesuffix(".gz"), r["object"]) for r in readers.read_shell_objects(spark, packed).collect()) == pieces
    assert pieces == sorted(tuple(r) for r in whole.collect())
    assert len(pieces) == 6


@pytest.mark.parametrize("split_bytes", [None, "64"])
def test_ids_are_packed_in_the_order_of_their_file(spark, folder, split_bytes):
    listed = {"one": [f"i{i * 7919 % 1000}" for i in range(500)], "two": ["same"] * 130, "three": ["x"]}
    for name, values in listed.items():
        Path(f"{folder}/{name}.csv").write_text("_id,more\n" + "".join(f" {v} ,{'m' * (len(v) * 3)}\n" for v in values))
    Path(f"{folder}/empty.csv").write_text("_id,more\n")
    try:
        if split_bytes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        batches = ids.id_batches_in_order(readers.read_numbered_csv(spark, folder, ("_id",)), "file", "_id", 50)
        found = batches.orderBy("file", "batch").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, values in listed.items():
        own = [b["ids"] for b in found if b["file"] == name]
        assert [v for b in own for v in b] == values
        assert [len(b) for b in own[:-1]] == [50] * (len(own) - 1)
    assert {b["file"] for b in found} == set(listed)


def test_documents_in_a_folder_per_group(spark, folder):
    documents = spark.sql("SELECT concat('f', id % 2) AS f, concat('{\"n\":', id, '}') AS document FROM range(4)")
    writers.write_documents(documents, f"{folder}/out", "f")
    lines = [t for f in Path(f"{folder}/out/f=f1").glob("*.txt") for t in f.read_text().split()]
    assert sorted(lines) == ['{"n":1}', '{"n":3}']


def test_one_document_per_file_in_fragments(spark, folder):
    put = {"a": [f"i{n:03}" for n in range(57, 0, -1)], "b": ["only"], "c": ['q"u', "é", "q\"u"]}
    for name, ids_ in put.items():
        quoted = ['"' + i.replace('"', '""') + '"' for i in ids_]
        Path(f"{folder}/in").mkdir(exist_ok=True)
        Path(f"{folder}/in/{name}.csv").write_text("_id\n" + "\n".join(quoted) + "\n")
    rows = readers.read_numbered_csv(spark, f"{folder}/in", ("_id",))
    batches = ids.id_batches_in_order(rows, "path", "_id", 10, "file").drop("path")
    writers.write_fragments(ids.document_fragments(batches, "file"), f"{folder}/out", "file")
    for name, expected in put.items():
        files = sorted(Path(f"{folder}/out/file={name}").glob("part-*"))
        document = json.loads("".join(f.read_text() for f in files))
        assert document == {"archiveMetricIds": expected}


@pytest.mark.parametrize("repeats", [1, 2_500])
def test_batches_of_a_large_group(spark, repeats):
    """One group has most rows, one id of it is repeated very often; every batch is full but the last."""
    rows = spark.range(6_000).select(
        F.when(F.col("id") % 10 > 0, "big").when(F.col("id") % 20 > 0, "small").alias("g"),
        F.when(F.col("id") < repeats, "same").otherwise(F.concat(F.lit("i"), "id")).alias("i"),
    )
    found = ids.id_batches(rows, "g", "i", 250).collect()
    for group, n in (("big", 5_400), ("small", 300), (None, 300)):
        mine = sorted((r for r in found if r["g"] == group), key=lambda r: r["batch"])
        assert [r["batch"] for r in mine] == list(range(1, -(-n // 250) + 1))
        assert [r["n_ids"] for r in mine[:-1]] == [250] * (len(mine) - 1) and sum(r["n_ids"] for r in mine) == n
    packed = sorted(i for r in found for i in r["ids"])
    assert packed == sorted(r["i"] for r in rows.collect())
    assert ids.id_batches(rows.limit(0), "g", "i").count() == 0


def test_files_follow_the_size_of_an_index(spark, folder):
    """A large index, a small one, and 1,000 equal rows that do not end in one file."""
    spark.sql("SELECT 'big' AS index, id AS v FROM range(3000) UNION ALL SELECT 'small', 7 FROM range(10) UNION ALL SELECT 'same', 1 FROM range(1000)").repartition(
        6
    ).write.parquet(f"{folder}/in")
    rows = spark.read.parquet(f"{folder}/in")
    writers.write_csv_by_index(rows, f"{folder}/out", ["v"], rows_per_file=250)
    sizes = {i: [len(csv_rows_of(f)) for f in Path(f"{folder}/out/index={i}").glob("*.csv")] for i in ("big", "small", "same")}
    assert sum(sizes["big"]) == 3000 and sum(sizes["same"]) == 1000 and sizes["small"] == [10]
    assert len(sizes["same"]) >= 4 and len(sizes["big"]) >= 12 and max(sizes["same"] + sizes["big"]) <= 250
    assert sorted(int(r["v"]) for f in Path(f"{folder}/out/index=big").glob("*.csv") for r in csv_rows_of(f)) == list(range(3000))


def test_an_index_that_appears_during_an_export_waits_for_the_next(spark, folder, monkeypatch):
    marker = Path(f"{folder}/late")

    @F.udf("boolean")
    def there(index):
        return index != "new" or marker.exists()

    rows = spark.sql("SELECT element_at(array('a', 'b', 'new'), 1 + CAST(id % 3 AS INT)) AS index, id AS v FROM range(30)").where(there("index"))
    write = writers.write_csv_by_index

    def late(*args, **settings):
        marker.write_text("")
        write(*args, **settings)

    monkeypatch.setattr(writers, "write_csv_by_index", late)

    def exported():
        noted = sorted(r["index"] for r in spark.read.parquet(f"{folder}/finished").collect())
        return noted, sorted(p.name for p in Path(f"{folder}/out").glob("index=*"))

    writers.export_remaining_indices(rows, f"{folder}/out", f"{folder}/finished", ["v"])
    assert exported() == (["a", "b"], ["index=a", "index=b"])
    writers.export_remaining_indices(rows, f"{folder}/out", f"{folder}/finished", ["v"])
    assert exported() == (["a", "b", "new"], ["index=a", "index=b", "index=new"])
