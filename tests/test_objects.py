"""Objects out of large text files: cut across splits, broken ones, and columns found in the data."""

import json
import random
from pathlib import Path

import pytest

from keeprule.operators import dumps, events
from keeprule.sources import objects

PARTS = ["a", "{", "}", '"', "\\", "[", "]", ",", " ", "\n", "{[", "]}", "é", "'"]


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def records(n):
    rng = random.Random(n)

    def text():
        return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))

    made = []
    for i in range(n):
        record = {"id": f"x{i}", "s": text()}
        if i % 3 == 0:
            record["n"] = {"t": text(), "u": {"v": [text(), {"w": text()}]}}
        if i % 50 == 7:
            record["long"] = "{" * 2_000  # an object over several splits
        made.append(record)
    return made


@pytest.mark.parametrize("wrapped", ["[%s]", "{[%s]}\n", " %s", "{ [%s\n] }"])
def test_one_file_of_many_splits(spark, folder, small_splits, wrapped):
    made = records(200)
    Path(f"{folder}/in").mkdir()
    text = ", ".join(json.dumps(r, ensure_ascii=bool(i % 2)) for i, r in enumerate(made))
    Path(f"{folder}/in/a.json").write_text(wrapped % text)
    assert objects._pieces(spark, f"{folder}/in").select("block").distinct().count() > 10
    found = objects.parsed_objects(objects.read_objects(spark, f"{folder}/in"), ["id", "s", "n", "long"]).collect()
    assert all(r["unreadable"] is None for r in found)
    got = {r["item"]["id"]: (r["item"]["s"], json.loads(r["item"]["n"] or "null"), r["item"]["long"]) for r in found}
    assert got == {r["id"]: (r["s"], r.get("n"), r.get("long")) for r in made} and len(found) == len(made)


def test_a_split_is_worked_on_in_short_runs(spark, folder):
    """One split of many pieces: no window has to hold them all, and no piece carries the names of its file."""
    Path(f"{folder}/in").mkdir()
    for name in "ab":
        items = [{"id": f"{name}{i}", "s": '} \\" { [' * (i % 3), "n": {"long": "{" * (9_000 * (i == 1_000))}} for i in range(3_000)]
        Path(f"{folder}/in/{name}.json").write_text(json.dumps(items))
    pieces, files = objects._stored_pieces(spark, f"{folder}/in", '"')
    assert not {"path", "file"} & set(pieces.columns) and sorted(r["file"] for r in files.collect()) == ["a.json", "b.json"]
    assert pieces.select("of", "block").distinct().count() == 2
    assert 3 < pieces.groupBy(*objects.RUN).count().selectExpr("max(count)").first()[0] <= 1 << objects.RUN_BITS
    found = objects.parsed_objects(objects.read_objects(spark, f"{folder}/in"), ["id", "s", "n"]).collect()
    assert all(r["unreadable"] is None for r in found)
    got = sorted((r["file"], r["item"]["id"], r["item"]["s"], len(r["item"]["n"])) for r in found)
    longs = {i: len('{"long":""}') + 9_000 * (i == 1_000) for i in range(3_000)}
    assert got == sorted((f"{n}.json", f"{n}{i}", '} \\" { [' * (i % 3), longs[i]) for n in "ab" for i in range(3_000))


def test_several_files_and_odd_ones(spark, folder):
    Path(f"{folder}/in").mkdir()
    for name, text in {"a": '[{"id": "1"}]', "b": "", "c": "[]", "d": "no objects", "e": '{"id": "2"}', "f": '[{"id": "3"}, {"id": "4'}.items():
        Path(f"{folder}/in/{name}").write_text(text)
    found = objects.parsed_objects(objects.read_objects(spark, f"{folder}/in"), ["id"]).collect()
    assert sorted((r["file"], r["item"]["id"]) for r in found if r["unreadable"] is None) == [("a", "1"), ("e", "2"), ("f", "3")]
    assert [r["file"] for r in found if r["unreadable"] is not None] == ["f"]


def test_a_broken_object_leaves_its_neighbours(spark, folder, small_splits):
    Path(f"{folder}/in").mkdir()
    items = [f"{{'gcid': 'g{i}'}}" if i % 10 else f"{{'gcid' 'g{i}'}}" for i in range(300)] + ["{'x': 1}", "{'gcid': null}"]
    Path(f"{folder}/in/a.txt").write_text(",\n".join(items) + ",\n")
    parsed = objects.parsed_objects(objects.read_objects(spark, f"{folder}/in", quote="'"), ["gcid"])
    assert parsed.where("unreadable IS NOT NULL").count() == 30
    assert {r["gcid"] for r in dumps.item_ids(parsed).collect()} == {f"g{i}" for i in range(300) if i % 10}


def test_records_of_an_array_have_the_union_of_fields(spark, folder):
    Path(f"{folder}/in").mkdir()
    Path(f"{folder}/in/a.json").write_text('[{"a": 1,\n "b": "x]}"},\r\n {"c": [{"d": 2}]}]')
    rows = objects.read_array(spark, f"{folder}/in").collect()
    assert [r["a"] for r in rows if r["a"] is not None] == [1] and {r["b"] for r in rows} == {"x]}", None}
    assert [r["c"][0]["d"] for r in rows if r["c"]] == [2]


def test_columns_are_found_in_the_events(spark):
    log = spark.createDataFrame(
        [
            ("d1", '[{"origin": "D", "tenantid": "t", "b c": 1, "z`q": null}, {"origin": "E", "only there": true}]'),
            ("d2", '[{"origin": "D", "tenantid": "t", "a.b": {"x": 1}, "GCID": "1", "gcid": "2", "_tm": 0, "ver": 3}]'),
            ("d3", "not json"), ("d4", None),
        ],
        "_id string, events string",
    )
    assert events.found_fields(log) == ["GCID", "a.b", "b c", "gcid", "only there", "origin", "z`q"]
    table = events.event_table(log, "D", "t")
    assert table.columns == ["_id", "_tm", "GCID", "a.b", "b c", "gcid", "only there", "origin", "z`q"]
    assert [tuple(r)[2:6] for r in table.orderBy("_id").collect()] == [("", "", "1", ""), ("1", '{"x":1}', "", "2")]
    assert events.found_fields(log.where("_id = 'd3'")) == []
