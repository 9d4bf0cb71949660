"""Shapes of physical plans that must hold at any scale."""

from plans_text import plan_of
from riskloom.catalog import base
from riskloom.operators import clean, detection, history, marts
from riskloom.plans import dashboard


def test_deduplication_prunes_before_its_only_shuffle(spark, small):
    rows = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = plan_of(clean.keep_first(rows, "l_orderkey", ["l_linenumber"]))
    assert plan.count("Exchange ") == 1
    assert plan.index("Final") < plan.index("Exchange ") < plan.index("Partial")


def test_scoring_does_not_shuffle(spark, small):
    scored = detection.gold_table(detection.score_batch(base.silver(spark, small)))
    assert "Exchange" not in plan_of(scored)
    assert "Exchange" not in plan_of(detection.stream_silver(base.silver(spark, small).withColumnRenamed("epoch", "e")))


def test_reports_read_only_their_columns(spark, small):
    plan = plan_of(dashboard.protected_value(base.gold(spark, small)))
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert schema.count(":") == 4 and "amount" in schema and "EqualTo(status,DECLINED)" in plan
    one_level = plan_of(dashboard.top_frauds(base.gold(spark, small)))
    assert "PartitionFilters: [isnotnull(risk_level" in one_level and "TakeOrderedAndProject" in one_level


def test_aggregates_combine_before_the_shuffle(spark, small):
    for df in (marts.by_group(base.gold(spark, small), "type"), dashboard.by_hour(base.gold(spark, small))):
        assert "partial_count" in plan_of(df)


def test_history_features_use_no_python_and_no_cross_join(spark, small):
    rows = base.geo_feed(spark, small)
    for df in (history.movement(rows), history.last_day(rows), detection.geo_detection(rows)):
        plan = plan_of(df)
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_large_dimensions_are_not_broadcast(spark, small):
    from riskloom.operators import enrich
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.with_devices(base.silver(spark, small), base.devices(spark, small))
        assert "Broadcast" not in plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_full_rows_meet_their_history_in_one_shuffle(spark, small):
    rows = base.geo_feed(spark, small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(history.movement(rows))
        # The full rows and the narrow result, both by their place; the narrow rows by cut, for the window and for the
        # last row of each cut. The cuts themselves were dealt out when they were written.
        assert plan.count("Exchange hashpartitioning") == 4
        assert plan.count("Exchange SinglePartition") == 1  # one row per cut
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_customer_measures_do_not_copy_rows(spark, small):
    assert "Expand" not in plan_of(marts.customer_measures(base.gold(spark, small)))


def test_all_history_features_come_from_one_cut_table_and_one_join(spark, small, monkeypatch):
    from riskloom.operators import ordered
    written, in_cuts = [], ordered.in_cuts
    monkeypatch.setattr(ordered, "in_cuts", lambda *a, **b: written.append(a[1]) or in_cuts(*a, **b))
    rows = base.geo_feed(spark, small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(history.histories(rows))
        assert written == ["_place"]
        assert plan.count("SortMergeJoin") == 1 and "Python" not in plan and "Cartesian" not in plan
        # the rows and the narrow result by their place; the cut table by cut for the window and for its states
        assert plan.count("Exchange hashpartitioning") <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
