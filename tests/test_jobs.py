"""The jobs as commands, over small files."""

import json
from pathlib import Path

import pytest

from keeprule.jobs import main, parse


@pytest.fixture
def run(spark):
    return lambda *arguments: main(list(arguments), spark)


def lines(folder, pattern="*"):
    return [line for f in sorted(Path(folder).rglob(f"part-{pattern}")) for line in f.read_text().splitlines()]


def put(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text)
    return path


def save(spark, sql, path):
    spark.sql(sql).write.parquet(path)
    return path


def test_options_are_checked():
    with pytest.raises(SystemExit):
        parse(["flag-table", "--out", "x"])


def test_flags_and_counts(spark, run, folder):
    rows = save(
        spark,
        """SELECT 'g1' AS gcId, 'p' AS policyId, 'c' AS clusterId, TIMESTAMP_NTZ '2001-01-01 00:00:00' AS startDate
        UNION ALL SELECT 'g2', 'p', 'd', TIMESTAMP_NTZ '2001-06-14 00:00:00'""",
        f"{folder}/map",
    )
    rules = save(spark, "SELECT 'p' AS policyId, 'n' AS name, 30 AS retentionPeriod, 'day' AS unitOfPeriod, NULL AS sourceType", f"{folder}/rules")
    cases = save(spark, "SELECT named_struct('gcid', 'g2') AS documentKey, true AS holdFlag", f"{folder}/cases")
    clusters = save(spark, "SELECT * FROM VALUES ('c'), ('d') AS t(_id)", f"{folder}/clusters")
    tenancy = save(spark, "SELECT 't1' AS _id, 'active' AS status, 'u' AS tenantuuid", f"{folder}/tenancy")
    common = ["--assignments", rows, "--policies", rules, "--instant", "2001-06-15T00:00:00Z"]
    run("flag-table", *common, "--cases", cases, "--out", f"{folder}/flags")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{folder}/flags").collect()) == [
        ("g1", "Y", "Y", None), ("g2", "N", "Y", "Y"),
    ]
    run("flag-table", *common, "--cases", cases, "--out", f"{folder}/flags-again", "--totals", f"{folder}/flag-totals")
    assert spark.read.parquet(f"{folder}/flag-totals").count() > 0
    gate = ["--clusters", clusters, "--tenancy", tenancy, "--tenant", "t1"]
    run("expiry-counts", *common, *gate, "--out", f"csv:{folder}/sparse")
    assert lines(f"{folder}/sparse", "*.csv")[-1] == "c,1,n,p"
    run("expiry-counts", *common, *gate, "--dense", "yes", "--out", f"json:{folder}/dense")
    dense = [json.loads(line) for line in lines(f"{folder}/dense", "*.json")]
    assert sorted((d["clusterId"], d["expired_count"]) for d in dense) == [("c", 1), ("d", 0)]


def test_diff_of_csv_files(run, folder):
    put(f"{folder}/before/a.csv", "gcId,policyId\ng,p1\n")
    put(f"{folder}/after/a.csv", "gcId,policyId\ng,p2\ng,p1\n")
    put(f"{folder}/rules/a.csv", "policyId,name\np2,two\n")
    run(
        "assignment-diff", "--before", f"csv:{folder}/before", "--after", f"csv:{folder}/after",
        "--policies", f"csv:{folder}/rules", "--out", f"csv:{folder}/out",
    )
    assert lines(f"{folder}/out", "*.csv") == [
        "gcId,policyId,name,n_before,n_after,n_new,n_net_new", "g,p1,p1,1,1,0,1", "g,p2,two,0,1,1,1",
    ]


def test_exports(run, folder, capsys):
    put(f"{folder}/rows/a.csv", "gcId,v\na,1\nb,2\nc,3\n")
    put(f"{folder}/ids.txt", "b\n\n c \nx\n")
    run("export", "--rows", f"csv:{folder}/rows", "--fields", "v,gcId,more", "--ids", f"{folder}/ids.txt", "--key", "gcId", "--out", f"csv:{folder}/out")
    assert sorted(set(lines(f"{folder}/out", "*.csv"))) == ["2,b,", "3,c,", "v,gcId,more"]
    assert "'ids_given': 3" in capsys.readouterr().out
    run("export", "--rows", f"csv:{folder}/rows", "--fields", "gcId", "--where", "v > 1", "--out", f"text:{folder}/text")
    assert sorted(lines(f"{folder}/text", "*.txt")) == ["b", "c"]
    run("lookup", "--ids", f"{folder}/ids.txt", "--rows", f"csv:{folder}/rows", "--key", "gcId", "--value", "v", "--out", f"text:{folder}/found")
    assert lines(f"{folder}/found", "*.txt") == ["2", "3"]


def test_interrupted_index_export_is_taken_up(spark, run, folder):
    save(spark, "SELECT concat('i', id % 3) AS index, id AS v FROM range(30)", f"{folder}/rows")
    put(f"{folder}/out/index=i1/part-left-over.csv", "v\n999\n")
    save(spark, "SELECT 'i2' AS index", f"{folder}/finished")
    options = ["export-indices", "--rows", f"{folder}/rows", "--pattern", "i*", "--fields", "v", "--finished", f"{folder}/finished", "--out", f"{folder}/out"]
    for _ in range(2):
        run(*options)
        assert not Path(f"{folder}/out/index=i2").exists()
        assert sorted(v for v in lines(f"{folder}/out/index=i1") if v != "v") == sorted(str(v) for v in range(1, 30, 3))
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/finished").collect()) == ["i0", "i1", "i2"]


def test_id_files(run, folder):
    put(f"{folder}/csv/one.csv", "_id\n a\nb\nc\n")
    put(f"{folder}/csv/two.csv", "_id\nb\n")
    run("id-batches", "--csv", f"{folder}/csv", "--size", "2", "--out", f"{folder}/batches")
    documents = {d: [json.loads(t)["archiveMetricIds"] for t in lines(f"{folder}/batches/file={d}")] for d in ("one", "two")}
    assert sorted(documents["one"]) == [["a", "b"], ["c"]] and documents["two"] == [["b"]]
    run("sorted-ids", "--csv", f"{folder}/csv", "--column", "_id", "--out", f"text:{folder}/sorted")
    assert lines(f"{folder}/sorted", "*.txt") == ["a", "b", "c"]
    run("dedup-rows", "--rows", f"csv:{folder}/csv", "--out", f"csv:{folder}/distinct")
    assert sorted(set(lines(f"{folder}/distinct", "*.csv"))) == [" a", "_id", "b", "c"]


def test_text_repair(run, folder, capsys):
    put(f"{folder}/dump/a.txt", '{"name": "x", "retentionPeriod": NumberInt(5)} {"name": "y"}')
    run("shell-dump", "--text", f"{folder}/dump", "--fields", "name,retentionPeriod", "--out", f"csv:{folder}/rows")
    assert sorted(set(lines(f"{folder}/rows", "*.csv"))) == ["name,retentionPeriod", "x,5", "y,"]
    put(f"{folder}/arrays/a.json", '{[{"StartDate": "0", "id": "1"}]}')
    run("array-rows", "--text", f"{folder}/arrays", "--fields", "StartDate,id", "--out", f"csv:{folder}/array")
    assert lines(f"{folder}/array", "*.csv")[-1] == "1970-01-01 00:00:00,1"
    put(f"{folder}/list/a.txt", "{'gcid': 'a'},\n{'gcid': 'b'},\n")
    run("id-list", "--text", f"{folder}/list", "--out", f"json:{folder}/ids")
    assert lines(f"{folder}/ids", "*.json") == ['{"gcids":["a","b"]}']
    run("id-rows", "--text", f"{folder}/list", "--out", f"csv:{folder}/id-rows")
    assert sorted(set(lines(f"{folder}/id-rows", "*.csv"))) == ["a", "b", "gcid"]
    put(f"{folder}/records/a.json", '[{"a": 2, "b": "x"},\n{"a": 1}]')
    run("dedup-rows", "--rows", f"array:{folder}/records", "--out", f"csv:{folder}/records-out")
    assert set(lines(f"{folder}/records-out", "*.csv")) == {"a,b", "2,x", "1,"}
    put(f"{folder}/log/a.json", '{"_id": "d", "events": "[{\\"origin\\": \\"D\\", \\"tenantid\\": \\"t\\"}]"}\n{"_id": "e", "events": "no"}\n')
    run("event-rows", "--log", f"json:{folder}/log", "--origin", "D", "--tenant", "t", "--fields", "origin", "--out", f"csv:{folder}/events")
    assert lines(f"{folder}/events", "*.csv")[-1] == "d,1970-01-01 00:00:00,D"
    run("event-rows", "--log", f"json:{folder}/log", "--origin", "D", "--tenant", "t", "--out", f"csv:{folder}/all-events")
    assert lines(f"{folder}/all-events", "*.csv") == ["_id,_tm,origin", "d,1970-01-01 00:00:00,D"]
    assert "{'unreadable': 1}" in capsys.readouterr().out


def test_growth_chunks_and_purge(spark, run, folder, capsys):
    save(spark, "SELECT concat('3b2a0a0', id, repeat('0', 16)) AS _id, id AS k FROM range(5)", f"{folder}/rows")
    save(spark, "SELECT 's' AS shard, id AS chunk_id, id * 3 AS min_key, id * 3 + 3 AS max_key FROM range(3)", f"{folder}/chunks")
    run("month-growth", "--rows", f"{folder}/rows", "--start", "2001-01-01", "--end", "2002-01-01", "--out", f"csv:{folder}/months")
    assert lines(f"{folder}/months", "*.csv")[-1] == "5,2001-06"
    run("chunk-inventory", "--rows", f"{folder}/rows", "--chunks", f"{folder}/chunks", "--key", "k", "--out", f"{folder}/inventory", "--totals", f"{folder}/totals")
    assert sorted((r["chunk_id"], r["n_rows"]) for r in spark.read.parquet(f"{folder}/inventory").collect()) == [(0, 3), (1, 2), (2, 0)]
    assert {r["shard"]: r["n_rows"] for r in spark.read.parquet(f"{folder}/totals").collect()} == {"s": 5, "(all)": 5}
    run("purge-plan", "--rows", f"{folder}/rows", "--where", "k < 2")
    assert "{'n_removed': 2, 'n_kept': 3}" in capsys.readouterr().out
    run("purge-plan", "--rows", f"{folder}/rows", "--where", "k < 2", "--out", f"{folder}/kept")
    assert spark.read.parquet(f"{folder}/kept").count() == 3
    with pytest.raises(Exception, match="exists"):
        run("purge-plan", "--rows", f"{folder}/rows", "--where", "k < 2", "--out", f"{folder}/kept")


def test_incremental_jobs(spark, run, folder, capsys):
    put(f"{folder}/in/a.csv", "gcid\ng1\ng2\n")
    run(
        "ingest", "--folder", f"{folder}/in", "--headers", "gcid", "--table", f"{folder}/table",
        "--rejects", f"{folder}/rejects", "--checkpoint", f"{folder}/cp1",
    )
    rows = save(spark, "SELECT 'g1' AS gcId, 'p' AS policyId, TIMESTAMP_NTZ '2001-06-14 00:00:00' AS startDate", f"{folder}/map")
    rules = save(spark, "SELECT 'p' AS policyId, 30 AS retentionPeriod, 'day' AS unitOfPeriod, NULL AS sourceType", f"{folder}/rules")
    run(
        "evaluate", "--ids", f"{folder}/table", "--assignments", rows, "--policies", rules, "--instant", "2001-06-15",
        "--flags", f"{folder}/flags", "--progress", f"{folder}/progress", "--checkpoint", f"{folder}/cp2",
    )
    flags = spark.read.parquet(f"{folder}/flags").select("gcId", "ret_policies_expired").collect()
    assert sorted(tuple(r) for r in flags) == [("g1", "N"), ("g2", "Y")]
