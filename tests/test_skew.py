"""One key holds a third of all rows; lookups are too large to broadcast; results stay whole."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keeprule.operators import counts, diff, flags, lookups, ranges, upserts


def facts_and_lookup(spark):
    facts = spark.sql(
        """SELECT id, CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 97) END AS k
        FROM range(6000)"""
    )
    lookup = spark.sql(
        "SELECT concat('k', id) AS k, id AS v FROM range(50) UNION ALL SELECT 'hot', 1000 UNION ALL SELECT NULL, 5"
    )
    return facts, lookup


@pytest.mark.usefixtures("nothing_is_small")
def test_large_lookup_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, lookup = facts_and_lookup(spark)
        joined = lookups.lookup_join(facts, lookup, "k", "left")
        assert joined.count() == 6000
        assert joined.where("k = 'hot'").agg(F.min("v"), F.count("*")).first()[:] == (1000, 2000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.usefixtures("nothing_is_small")
def test_results_do_not_depend_on_the_size_of_the_policy_table(spark, monkeypatch):
    rules = spark.sql(
        """SELECT concat('p', id) AS policyId, concat('n', id) AS name, CAST(id + 1 AS INT) AS retentionPeriod,
          'day' AS unitOfPeriod, IF(id % 4 = 0, 'supervision', NULL) AS sourceType FROM range(40)"""
    )
    rows = spark.sql(
        """SELECT IF(id % 3 = 0, 'hot', concat('g', id % 700)) AS gcId, IF(id % 3 = 1, 'p7', concat('p', id % 45)) AS policyId,
          concat('c', id % 3) AS clusterId, TIMESTAMP_NTZ '2001-06-01 00:00:00' - make_dt_interval(CAST(id % 60 AS INT)) AS startDate
        FROM range(5000)"""
    )
    clusters = spark.sql("SELECT * FROM VALUES ('c0'), ('c1') AS t(_id)")

    def results():
        return (
            Counter(tuple(r) for r in flags.both_flags(rows, rules, "2001-06-01").collect()),
            Counter(tuple(r) for r in counts.expiry_report(rows, rules, clusters, "2001-06-01").collect()),
        )

    large = results()
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 1_000)
    assert results() == large
    assert large[0].total() == rows.select("gcId").distinct().count()


@pytest.mark.usefixtures("nothing_is_small")
def test_first_match_with_a_long_list(spark):
    wanted = spark.sql("SELECT id AS position, IF(id % 3 = 0, 'hot', concat('k', id % 40)) AS k FROM range(3000)")
    rows = spark.sql("SELECT concat('k', id % 30) AS k, concat('v', id) AS v FROM range(500) UNION ALL SELECT 'hot', 'h'")
    best = {}
    for r in rows.collect():
        best[r["k"]] = min(best.get(r["k"], r["v"]), r["v"])
    found = lookups.first_match(wanted, rows, "k", "v")
    assert Counter((r["position"], r["v"]) for r in found.collect()) == Counter(
        (r["position"], best[r["k"]]) for r in wanted.collect() if r["k"] in best
    )


def test_absent_records_with_a_large_batch(spark):
    target = spark.sql("SELECT concat('k', id) AS k, 'old' AS v FROM range(0, 100, 2)")
    records = spark.sql("SELECT IF(id % 3 = 0, 'hot', concat('k', id % 120)) AS k, concat('v', id) AS v FROM range(900)")
    small = upserts.absent_records(records, target, "k", small=True)
    large = upserts.absent_records(records, target, "k", small=False)
    expected = {}
    for r in records.collect():
        if r["k"] == "hot" or int(r["k"][1:]) >= 100 or int(r["k"][1:]) % 2:
            expected[r["k"]] = min(expected.get(r["k"], r["v"]), r["v"])
    assert {tuple(r) for r in small.collect()} == {tuple(r) for r in large.collect()} == set(expected.items())


def test_diff_of_a_hot_message(spark):
    before = spark.sql("SELECT IF(id % 3 = 0, 'hot', concat('g', id)) AS gcId, concat('p', id % 5) AS policyId FROM range(3000)")
    after = spark.sql("SELECT IF(id % 3 = 0, 'hot', concat('g', id)) AS gcId, concat('p', id % 7) AS policyId FROM range(3000)")
    hot = diff.assignment_diff(before, after).where("gcId = 'hot'").collect()
    assert len(hot) == 7
    assert sum(r["n_before"] for r in hot) == sum(r["n_after"] for r in hot) == 1000
    assert {r["n_net_new"] for r in hot} == {sum(r["n_after"] for r in hot if r["policyId"] in ("p5", "p6"))}


LIMIT = 2**63 - 1


def brute_force(keys, spans):
    return Counter({name: n for name, low, high in spans if (n := sum(low <= k < high for k in keys))})


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("kind", ["adjacent", "overlapping", "extreme"])
def test_rows_in_ranges(spark, small, kind):
    random.seed(7)
    keys = [random.randint(-500, 500) for _ in range(800)] + [42] * 400 + [-LIMIT - 1, LIMIT, LIMIT - 1, 0]
    if kind == "adjacent":
        cuts = sorted(random.sample(range(-600, 600), 40))
        spans = [(i, low, high) for i, (low, high) in enumerate(zip(cuts, cuts[1:]))]
    elif kind == "overlapping":
        spans = [(i, low, low + random.choice([0, -3, 1, 2, 3, 17, 64, 65, 900])) for i, low in enumerate(random.sample(range(-600, 600), 60))]
    else:
        spans = [(0, -LIMIT - 1, -100), (1, -100, 42), (2, 42, 43), (3, 43, LIMIT), (4, -LIMIT - 1, LIMIT), (5, LIMIT - 1, LIMIT)]
    rows = spark.createDataFrame([(k, 2) for k in keys] + [(None, 2)], "k long, w long").repartition(4)
    table = spark.createDataFrame(spans, "id long, lo long, hi long")
    counted = ranges.counts_in_ranges(rows, "k", table, ["id"], "lo", "hi", ["w"], small=small).collect()
    assert Counter({r["id"]: r["n_rows"] for r in counted}) == brute_force(keys, spans)
    assert all(r["w"] == 2 * r["n_rows"] for r in counted)
