"""The large-data branches (no broadcast, re-partitioning) give the same
answers as the small-data ones."""

import turnstile.operators.encode as E
import turnstile.operators.impute as I
import turnstile.session as SESSION
from turnstile.session import fit_partitions


def test_group_mode_without_broadcast(spark, monkeypatch):
    rows = [(i, f"D{i % 7}" if i % 11 else None, None if i % 4 == 0 else f"P{(i * 3) % 5}")
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, d string, p string")
    small = sorted(map(tuple, I.fill_group_mode(df, "d", "p", empty_group="null").collect()))
    monkeypatch.setattr(I, "maybe_broadcast", lambda side: SESSION.maybe_broadcast(side, 0))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        joined = I.fill_group_mode(df, "d", "p", empty_group="null")
        got = sorted(map(tuple, joined.collect()))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert got == small


def test_dictionary_join_without_broadcast(spark, monkeypatch):
    rows = [(i, f"v{(i * 13) % 400:03d}") for i in range(1200)]
    df = spark.createDataFrame(rows, "id int, v string")
    small, _ = E.label_encode(df)
    monkeypatch.setattr(E, "INLINE_COLUMN_MAX", 0)
    monkeypatch.setattr(E, "BROADCAST_MAX_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big, _ = E.label_encode(df)
        plan_rows = sorted(map(tuple, big.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan_rows == sorted(map(tuple, small.collect()))


def test_fit_partitions(spark):
    par = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, 1, 1)
    assert fit_partitions(one, 1000, 10).rdd.getNumPartitions() == min(par, 100)
    assert fit_partitions(one, 1000, 10, per_core=2).rdd.getNumPartitions() == min(2 * par, 100)
    many = spark.range(0, 1000, 1, 50)                   # never merged
    assert fit_partitions(many, 1000, 500).rdd.getNumPartitions() == 50


def test_broadcast_is_bounded_by_bytes(spark):
    few = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "i int, t string")
    size = SESSION.measured_bytes(few)
    assert 100_000 <= size <= 110_000
    plan = SESSION.maybe_broadcast(few, size)._jdf.queryExecution().toString()
    assert "hint" in plan.lower() or "ResolvedHint" in plan
    assert "ResolvedHint" not in SESSION.maybe_broadcast(few, size - 1)._jdf.queryExecution().toString()
