"""Small hand-made rows for the rules that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from keeprule.functions.instants import epoch_millis_text, object_id_floor, object_id_month, parse_instant
from keeprule.functions.text import json_objects, megabytes, strip
from keeprule.operators import counts, diff, dumps, events, filters, flags, growth, ids, lookups, policies, purge, ranges, upserts

POLICY = "policyId string, retentionPeriod int, unitOfPeriod string, sourceType string, name string"
INSTANT = "2001-06-15 12:30:00"


def policy_rows(spark, *rows):
    return spark.createDataFrame(list(rows), POLICY)


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "instant, count, unit, midnight, expected",
    [
        ("2001-03-31 08:15:00", 1, "month", False, "2001-02-28 08:15:00"),
        ("2001-03-31 08:15:00", 1, "MONTH", True, "2001-02-28 00:00:00"),
        ("2000-02-29 10:00:00", 1, "Year", False, "1999-02-28 10:00:00"),
        ("2000-02-29 10:00:00", 4, "year", False, "1996-02-29 10:00:00"),
        ("2001-05-10 10:00:00", 3, "month", True, "2001-02-10 00:00:00"),
        ("2001-02-10 10:00:00", 3, "month", True, "2000-11-10 00:00:00"),
        ("2001-02-10 10:00:00", 30, "month", False, "1998-08-10 10:00:00"),
        ("2001-02-10 10:00:00", 400, "DAY", True, "2000-01-07 10:00:00"),
        ("2001-02-10T10:00:00+02:00", 0, "day", False, "2001-02-10 08:00:00"),
        ("2001-02-10T10:00:00Z", 0, "day", False, "2001-02-10 10:00:00"),
    ],
)
def test_threshold(spark, instant, count, unit, midnight, expected):
    table = policies.policy_thresholds(policy_rows(spark, ("p", count, unit, None, "n")), instant, midnight)
    assert str(table.first()["threshold"]) == expected


@pytest.mark.parametrize("period, unit", [(3, "week"), (3, None), (None, "day")])
def test_unusable_policy_is_refused_before_the_job(spark, period, unit):
    with pytest.raises(ValueError):
        policies.checked_thresholds(policy_rows(spark, ("ok", 1, "day", None, "n"), ("p", period, unit, None, "n")), INSTANT)


def test_thresholds_do_not_depend_on_the_session_zone(spark):
    rows = spark.sql("SELECT 'g' AS gcId, 'p' AS policyId, TIMESTAMP '2001-06-14 12:30:00Z' AS startDate")
    policy = policy_rows(spark, ("p", 1, "day", None, "n"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert flags.retention_flags(rows, policy, INSTANT).first()["ret_policies_expired"] == "N"
        later = flags.retention_flags(rows, policy, "2001-06-15 12:30:01")
        assert later.first()["ret_policies_expired"] == "Y"
        assert one(spark, parse_instant(F.lit("2001-06-15T12:30:00"))).isoformat() == "2001-06-15T12:30:00"
        assert one(spark, epoch_millis_text(F.lit("1506717413999"))) == "2017-09-29 20:36:53"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def assignments(spark):
    return spark.sql(
        """SELECT * FROM VALUES
        ('boundary', 'p', TIMESTAMP_NTZ '2001-05-16 12:30:00'),
        ('before', 'p', TIMESTAMP_NTZ '2001-05-16 12:29:59'),
        ('mixed', 'p', TIMESTAMP_NTZ '1999-01-01 00:00:00'),
        ('mixed', 's', TIMESTAMP_NTZ '2001-06-15 00:00:00'),
        ('unknown', 'x', TIMESTAMP_NTZ '2001-06-15 00:00:00'),
        ('nostart', 'p', NULL),
        (NULL, 'p', TIMESTAMP_NTZ '2001-06-15 00:00:00') AS t(gcId, policyId, startDate)"""
    )


def test_flag_table(spark):
    rules = policy_rows(spark, ("p", 30, "Day", None, "n"), ("s", 30, "day", "supervision", "n"))
    cases = spark.sql(
        """SELECT named_struct('gcid', g) AS documentKey, h AS holdFlag FROM VALUES
        ('before', CAST(NULL AS BOOLEAN)), ('before', false), ('mixed', false), ('mixed', true),
        ('caseonly', true), (NULL, true) AS t(g, h)"""
    )
    more = spark.sql("SELECT * FROM VALUES ('nopolicy'), ('before') AS t(gcId)")
    table = flags.flag_table(assignments(spark), rules, cases, INSTANT, more)
    assert {tuple(r) for r in table.collect()} == {
        ("boundary", "N", "Y", None),
        ("before", "Y", "Y", "N"),
        ("mixed", "Y", "N", "Y"),
        ("unknown", "Y", "Y", None),
        ("nostart", "Y", "Y", None),
        ("nopolicy", "Y", "Y", None),
        ("caseonly", None, None, "Y"),
    }
    totals = flags.flag_totals(assignments(spark), rules, cases, INSTANT, more).first().asDict()
    assert totals == dict(
        evaluated=6, ret_expired=5, ret_active=1, sup_expired=5, sup_active=1, held=2, null_starts=1
    )


def test_repeated_policy_counts_with_its_longest_retention(spark):
    rules = policy_rows(spark, ("p", 1, "day", None, "n"), ("p", 30, "day", None, "n"))
    rows = assignments(spark).where("gcId = 'boundary'")
    assert flags.retention_flags(rows, rules, INSTANT).first()["ret_policies_expired"] == "N"
    clustered = rows.withColumn("clusterId", F.lit("c"))
    clusters = spark.sql("SELECT 'c' AS _id")
    assert counts.expired_counts(clustered, rules, clusters, INSTANT).count() == 0
    later = counts.expired_counts(clustered, rules, clusters, "2001-06-16")
    assert [tuple(r) for r in later.collect()] == [("c", "p", 1)]


def test_no_policies_at_all(spark):
    none = policy_rows(spark).limit(0)
    assert {r[1] for r in flags.retention_flags(assignments(spark), none, INSTANT).collect()} == {"Y"}
    clustered = assignments(spark).withColumn("clusterId", F.lit("c"))
    assert counts.expired_counts(clustered, none, spark.sql("SELECT 'c' AS _id"), INSTANT).count() == 0
    assert counts.expired_count_of(clustered, none, "c", "p", INSTANT).first()[0] == 0


def test_every_pair_of_many_clusters(spark):
    clusters = spark.range(10).select(F.concat(F.lit("c"), "id").alias("_id"))
    rules = spark.range(4).select(F.concat(F.lit("p"), "id").alias("policyId"))
    pairs = [tuple(r) for r in counts.all_pairs(clusters, rules).collect()]
    assert len(pairs) == 40 and set(pairs) == {(f"c{c}", f"p{p}") for c in range(10) for p in range(4)}


def test_negations_keep_missing_values(spark):
    rows = spark.sql("SELECT * FROM VALUES ('SUCCESS'), ('Archived'), ('x'), (NULL) AS t(s)")
    assert {r[0] for r in rows.where(filters.is_not("s", "SUCCESS")).collect()} == {"Archived", "x", None}
    assert {r[0] for r in rows.where(filters.is_none_of("s", ["Archived", "SUCCESS"])).collect()} == {"x", None}


def diff_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "gcId string, policyId string")


def test_diff_keeps_repeats_and_follows_the_before_side(spark):
    before = diff_rows(spark, ("a", "p1"), ("b", "p1"), ("b", "p2"), (None, "p1"))
    after = diff_rows(spark, ("a", "p2"), ("a", "p1"), ("a", "p2"), ("b", "p1"), ("c", "p1"), (None, "p3"))
    report = diff.assignment_diff(before, after).orderBy("policyId").collect()
    assert [tuple(r) for r in report] == [("a", "p1", 1, 1, 0, 2), ("a", "p2", 0, 2, 2, 2)]
    assert [tuple(r) for r in diff.assignment_changes(before, after).collect()] == [("a", 1, 3, 2)]


def test_diff_with_names(spark):
    before = diff_rows(spark, ("a", "p1"))
    after = diff_rows(spark, ("a", "p3"), ("a", "p2"), ("a", "p4"))
    names = spark.createDataFrame([("p2", "zebra"), ("p3", "ant"), ("p3", "bee")], "policyId string, name string")
    report = diff.assignment_diff_named(before, after, names).orderBy("policyId").collect()
    assert [(r["name"], r["n_new"]) for r in report] == [("p1", 0), ("zebra", 1), ("ant", 1), ("p4", 1)]


def test_ranges_refuse_keys_that_are_not_whole(spark):
    rows = spark.sql("SELECT 5.2 AS k")
    chunks = spark.sql("SELECT 1L AS id, 5L AS lo, 6L AS hi")
    with pytest.raises(TypeError, match="whole numbers"):
        ranges.counts_in_ranges(rows, "k", chunks, ["id"], "lo", "hi")


def test_export_projection_and_headers(spark):
    rows = spark.sql("SELECT 1 AS gcid, CAST(NULL AS STRING) AS GCID2")
    assert filters.rename_headers(rows, {"gcid": "gcId", "gcid2": "no"}).columns == ["gcId", "GCID2"]
    assert tuple(filters.project(rows, ["GCID2", "other", "gcid"]).first()) == ("", "", "1")


def test_wildcard_is_anchored_at_the_start_only(spark):
    rows = spark.sql("SELECT * FROM VALUES ('prod-1'), ('prod-22x'), ('xprod-1') AS t(index)")
    assert {r[0] for r in filters.tables_like(rows, "prod-*2").collect()} == {"prod-22x"}
    assert {r[0] for r in filters.tables_like(rows, "prod").collect()} == {"prod-1", "prod-22x"}


def test_pages_walk_the_whole_table(spark):
    rows = spark.range(25).select(F.format_string("k%03d", "id").alias("_id"))
    last, seen = None, []
    while page := filters.page_after(rows, "_id", last, 10).collect():
        last = page[-1]["_id"]
        seen += [r["_id"] for r in page]
    assert seen == [f"k{i:03d}" for i in range(25)]


def test_first_match_takes_the_smallest_that_is_not_null(spark):
    wanted = spark.sql("SELECT * FROM VALUES (1, 's1'), (2, 's2'), (3, 's1'), (4, 's3'), (5, NULL) AS t(position, k)")
    rows = spark.sql("SELECT * FROM VALUES ('s1', NULL), ('s1', 'b'), ('s1', 'a'), ('s2', NULL), (NULL, 'z') AS t(k, v)")
    found = lookups.first_match(wanted, rows, "k", "v")
    assert sorted((r["position"], r["v"]) for r in found.collect()) == [(1, "a"), (3, "a")]


def test_id_batches_hold_every_id_once_and_are_full(spark):
    rows = spark.sql(
        """SELECT IF(id < 2345, 'big', IF(id < 2350, 'small', NULL)) AS f, concat(' i', id % 2000, ' ') AS i
        FROM range(2360)"""
    )
    batches = ids.id_batches(rows, "f", "i", size=100).collect()
    sizes = {}
    for b in batches:
        sizes.setdefault(b["f"], {})[b["batch"]] = len(b["ids"])
        assert b["n_ids"] == len(b["ids"])
    assert sizes["big"] == {**{k: 100 for k in range(1, 24)}, 24: 45}
    assert sizes["small"] == {1: 5} and sizes[None] == {1: 10}
    got = sorted((b["f"] or "", i) for b in batches for i in b["ids"])
    assert got == sorted((r["f"] or "", r["i"].strip()) for r in rows.collect())


def test_hot_id_is_spread_over_batches(spark):
    rows = spark.sql("SELECT 'f' AS f, IF(id < 700, 'hot', concat('i', id)) AS i FROM range(1000)")
    batches = ids.id_batches(rows, "f", "i", size=64).collect()
    assert sorted(b["n_ids"] for b in batches) == [40] + [64] * 15
    assert sum(b["ids"].count("hot") for b in batches) == 700


def log(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_id long, events string")


def test_event_rows(spark):
    rows = log(
        spark,
        '[{"origin":"D","tenantid":"t","_tm":1506717413999,"ver":1,"x":{"y":[1,2]}},{"origin":"E","tenantid":"t","only":"e"}]',
        "not json",
        None,
        '[{"origin":"D","tenantid":"t","x":null},{"origin":"D","tenantid":"u"}]',
        "[]",
    )
    assert {r["name"] for r in events.event_fields(rows).collect()} == {"_tm", "origin", "x", "only"}
    whole = events.event_rows(rows, "D", "t").where("_id = 0").first()
    assert whole["event"] == {"origin": "D", "x": '{"y":[1,2]}'}
    result = events.event_rows(rows, "D", "t", ["only", "origin", "x"])
    assert result.columns == ["_id", "_tm", "only", "origin", "x"]
    assert {tuple(r) for r in result.collect()} == {
        ("0", "2017-09-29 20:36:53", "", "D", '{"y":[1,2]}'),
        ("3", "1970-01-01 00:00:00", "", "D", ""),
    }
    assert [r["_id"] for r in events.unreadable_events(rows).collect()] == [1]


def test_event_fields_that_differ_in_case(spark):
    rows = log(spark, '[{"origin":"D","tenantid":"t","id":"1","Id":"2"}]')
    assert [tuple(r) for r in events.event_rows(rows, "D", "t", ["Id", "id", "origin"]).collect()] == [
        ("0", "1970-01-01 00:00:00", "2", "1", "D")
    ]


@pytest.mark.parametrize("text", ["not json", '[{"a":1},{bad', "[1,2]", '{"a":1}', '[{"a":1}] x', '[{"a":1}] x]', '[{"a":1}],[]', '[{"a":1}]] x]', '[{"a":1}]} ]'])
def test_broken_json_is_null(spark, text):
    assert one(spark, json_objects(F.lit(text))) is None
    assert one(spark, json_objects(F.lit(text), ["a"])) is None


def test_shell_dump(spark):
    text = (
        'noise {"retentionPeriod": NumberInt(5), "createdDate": ISODate("2020-01-01T00:00:00Z"), "name": "a"}, {} \n'
        '{\n"name": "b",\n "enabled": true}{"name": "cut'
    )
    rows = dumps.shell_dump_rows(spark.createDataFrame([(text,)], "value string")).collect()
    assert [(r["retentionPeriod"], r["createdDate"], r["name"], r["scope"], r["enabled"]) for r in rows] == [
        ("5", "2020-01-01T00:00:00Z", "a", "", ""),
        ("", "", "b", "", "true"),
    ]


def test_unreadable_objects_are_told_apart(spark):
    text = '{"name": "a", "n": [1, {"x": 2}, 3]} {"name": nonsense} {"name": "b", "scope": {"deep": 1}'
    objects = dumps.shell_objects(spark.createDataFrame([(text,)], "value string"))
    assert objects.count() == 3
    assert [r["object"] for r in dumps.unreadable_objects(objects).collect()] == [
        '{"name": "a", "n": [1, {"x": 2}', '{"name": nonsense}', '{"name": "b", "scope": {"deep": 1}'
    ]
    assert dumps.object_rows(objects).count() == 0


def test_unreadable_times_and_arrays(spark):
    rows = log(spark, '[{"origin":"D","tenantid":"t","_tm":"soon"},{"origin":"D","tenantid":"t","_tm":1506717413999.5}]')
    assert [r["_tm"] for r in events.event_rows(rows, "D", "t").collect()] == ["", "2017-09-29 20:36:53"]
    assert one(spark, epoch_millis_text(F.lit(-1))) == "1969-12-31 23:59:59"
    assert one(spark, epoch_millis_text(F.lit("999999999999999"))) == "+33658-09-27 01:46:39"
    texts = spark.createDataFrame([("{[{}]}",), ("[1]",), ("x",), (None,)], "value string")
    assert [r["value"] for r in dumps.unreadable_arrays(texts).collect()] == ["[1]", "x"]


def test_array_repair(spark):
    texts = spark.createDataFrame([(' {[{"StartDate": "1506717413999", "id": "1"}]} \n',)], "value string")
    assert [tuple(r) for r in dumps.array_rows(texts, ["StartDate", "id"]).collect()] == [("2017-09-29 20:36:53", "1")]


def test_object_list(spark):
    texts = spark.createDataFrame([("{'gcid': 'a'},{'x': 1},{'gcid': 'b'},\n",), ("broken",), ("",)], "value string")
    assert [r["gcids"] for r in dumps.id_list(texts).collect()] == [["a", "b"], None, []]
    assert [r["gcid"] for r in dumps.id_rows(texts).collect()] == ["a", "b"]


def test_object_ids(spark):
    month = one(spark, object_id_month(F.lit("3b2a0a00" + "f" * 16)))
    assert month == "2001-06"
    rows = spark.sql("SELECT * FROM VALUES ('2001-06-01'), ('2001-06-30'), ('2001-07-01') AS t(d)").select(
        F.concat(F.lower(F.hex(F.unix_timestamp("d", "yyyy-MM-dd"))), F.repeat(F.lit("0"), 16)).alias("_id")
    )
    late = spark.sql(f"SELECT '{object_id_floor('2001-07-01')[:-1]}1' AS _id")
    counted = growth.growth_by_month(rows.union(late), "2001-06-01", "2001-07-01")
    assert [tuple(r) for r in counted.collect()] == [("2001-06", 2), ("2001-07", 1)]


def test_strip_and_size_text(spark):
    assert one(spark, strip(F.lit(" \t a b \r\n"))) == "a b"
    sizes = [0, 1, 131072, 393216, 5242, 5243, 123456789012]
    rows = spark.createDataFrame([(s,) for s in sizes], "n long").select(megabytes(F.col("n")))
    assert [r[0] for r in rows.collect()] == [f"{s / 1048576:.2f} MB" for s in sizes]


def test_purge_keeps_what_is_unknown(spark):
    rows = spark.sql("SELECT * FROM VALUES (1), (5), (NULL) AS t(k)")
    predicate = filters.in_range("k", 1, 5)
    assert {r[0] for r in purge.purge_kept(rows, predicate).collect()} == {5, None}
    assert tuple(purge.purge_dry_run(rows, predicate).first()) == (1, 2)


def test_insert_and_set(spark):
    target = spark.sql("SELECT * FROM VALUES ('a', 'old') AS t(k, v)")
    records = spark.sql("SELECT * FROM VALUES ('a', 'new'), ('b', 'y'), ('b', 'x'), (NULL, 'z') AS t(k, v)")
    assert sorted(tuple(r) for r in upserts.insert_absent(target, records, "k").collect()) == [("a", "old"), ("b", "x")]
    flagged = upserts.set_flag(target, records, "k", "v")
    assert sorted(tuple(r) for r in flagged.collect()) == [("a", "new"), ("b", "y")]
    added = upserts.set_flag(target, spark.sql("SELECT 'c' AS k, 'Y' AS hold"), "k", "hold")
    assert sorted(tuple(r) for r in added.select("k", "v", "hold").collect()) == [("a", "old", None), ("c", None, "Y")]


def test_sort_is_total_over_equal_rows(spark):
    rows = spark.sql("SELECT IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS k, 'v' AS v FROM range(3000)")
    result = [r["k"] for r in filters.sort_rows(rows, "k", "v").collect()]
    assert result == sorted(r["k"] for r in rows.collect())


def test_text_starts_are_compared_as_instants(spark):
    """Zones count, blanks and unreadable starts never keep a message alive."""
    starts = [
        ("late", "2001-06-14T11:00:00-05:00"),
        ("early", "2001-06-14T13:00:00+02:00"),
        ("utc", "2001-06-14T12:30:00Z"),
        ("naive", "2001-06-14 12:29:59"),
        ("blank", " "),
        ("none", None),
        ("odd", "soon"),
    ]
    rows = spark.createDataFrame([(g, "p", s) for g, s in starts], "gcId string, policyId string, startDate string")
    policies = spark.createDataFrame([("p", 1, "day", None)], "policyId string, retentionPeriod int, unitOfPeriod string, sourceType string")
    found = flags.retention_flags(rows, policies, "2001-06-15T12:30:00Z").collect()
    verdicts = {r["gcId"]: r["ret_policies_expired"] for r in found}
    assert {g for g, v in verdicts.items() if v == "N"} == {"late", "utc"}
    assert set(verdicts) == {g for g, _ in starts}


def test_case_items_of_flat_files(spark):
    items = spark.createDataFrame([("a", "true"), ("a", None), ("b", "false"), ("c", None)], "gcid string, holdFlag string")
    assert {tuple(r) for r in flags.case_holds(items).collect()} == {("a", "Y"), ("b", "N"), ("c", "N")}


@pytest.mark.parametrize(
    "written, read",
    [
        ("NumberInt(5)", "5"), ("NumberInt(-5)", "-5"), ("NumberInt( '7' )", "7"), ('NumberLong("12345678901")', "12345678901"),
        ("NumberLong(+3)", "3"), ('NumberDecimal("1.25")', "1.25"), ("NumberDecimal('-2.5e3')", "-2500.0"),
        ('ISODate("2001-06-15T12:30:00Z")', "2001-06-15T12:30:00Z"), ("ISODate('2001-06-15')", "2001-06-15"),
        ("ObjectId('abc')", "abc"), ("NumberInt(x)", None), ("NumberInt('5)", None), ("ISODate()", None), ('"NumberIntervals"', "NumberIntervals"),
    ],
)
def test_values_of_the_shell_notation(spark, written, read):
    texts = spark.createDataFrame([(f'x {{"name": {written}, "scope": "s"}} {{}} y',)], "value string")
    rows = dumps.shell_dump_rows(texts, fields=["name", "scope"]).collect()
    if read is None:
        assert rows == [] and dumps.unreadable_objects(dumps.shell_objects(texts), ["name", "scope"]).count() == 1
    else:
        assert [tuple(r) for r in rows] == [(read, "s")]
