import datetime as dt
import random

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.operators.joins import enrich, interval_join, interval_micros
from tideline.operators.latest import latest_per_key, latest_semi

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def test_latest_ties_broken_by_tie_break(spark):
    df = spark.createDataFrame([(1, T0, 10), (1, T0, 11), (1, T0 - dt.timedelta(hours=1), 12),
                                (2, T0, 5), (None, T0, 7), (None, T0, 8)],
                               "k INT, ts TIMESTAMP_NTZ, id INT")
    got = rows(latest_per_key(df, ["k"], "ts", ["id"]))
    assert got == [(None, T0, 8), (1, T0, 11), (2, T0, 5)]


def test_latest_semi_keeps_ties_and_drops_null_keys(spark):
    df = spark.createDataFrame([(1, T0, 10), (1, T0, 11), (1, T0 - dt.timedelta(hours=1), 12),
                                (None, T0, 7)], "k INT, ts TIMESTAMP_NTZ, id INT")
    assert rows(latest_semi(df, ["k"], "ts"), "id") == [(10,), (11,)]


def test_latest_plan_limits_rows_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_per_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_interval_ends_inclusive(spark):
    us = dt.timedelta(microseconds=1)
    h = dt.timedelta(hours=1)
    left = spark.createDataFrame([(1, "a", T0), (2, "a", T0 + h), (3, "a", T0 + h + us), (4, "b", T0)],
                                 "oid INT, owner STRING, ots TIMESTAMP_NTZ")
    right = spark.createDataFrame([(9, "a", T0)], "mid INT, owner STRING, mts TIMESTAMP_NTZ")
    for spread in ("left", "right"):
        got = rows(interval_join(left, right, ["owner"], "ots", "mts", "1 hour", spread=spread),
                   "oid", "mid")
        assert got == [(1, 9), (2, 9)]


def _brute(left, right, width_us):
    out = []
    for oid, lo, lt in left:
        for mid, ro, rt in right:
            if lo == ro and rt <= lt <= rt + dt.timedelta(microseconds=width_us):
                out.append((oid, mid))
    return sorted(out)


@settings(max_examples=15, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.sampled_from(["1 hour", "90 minutes", "1 day"]),
       st.sampled_from(["left", "right"]))
def test_interval_join_matches_brute_force(spark, seed, within, spread):
    rnd = random.Random(seed)
    span = 3 * 86_400_000_000

    def mk(n):
        return [(i, rnd.choice("abc"), T0 + dt.timedelta(microseconds=rnd.randrange(span)))
                for i in range(n)]
    left, right = mk(40), mk(40)
    # exact boundary partners
    right.append((1000, left[0][1], left[0][2] - dt.timedelta(microseconds=interval_micros(within))))
    right.append((1001, left[1][1], left[1][2]))
    ldf = spark.createDataFrame(left, "oid INT, owner STRING, ots TIMESTAMP_NTZ")
    rdf = spark.createDataFrame(right, "mid INT, owner STRING, mts TIMESTAMP_NTZ")
    got = rows(interval_join(ldf, rdf, ["owner"], "ots", "mts", within, spread=spread), "oid", "mid")
    assert got == _brute(left, right, interval_micros(within))


def test_enrich_inner_narrow_and_wide(spark):
    dim = spark.createDataFrame([(4, "XBox"), (5, "PS5"), (0, "Saga"), (2, "Nintendo")],
                                "order_id INT, product_name STRING")
    df = spark.createDataFrame([(1, 4), (2, 3), (3, 0)], "eid INT, order_id INT")
    assert rows(enrich(df, dim, "order_id", cols=["order_id", "product_name"], small=True)) == \
        [(0, "Saga"), (4, "XBox")]
    wide = enrich(df, dim, "order_id", small=True)
    assert set(wide.columns) == {"order_id", "eid", "product_name"}
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_interval_join_shuffles_on_key_and_time_bucket(spark):
    """At scale (no broadcast) a hot owner is spread over its time buckets:
    the shuffle key is (owner, bucket), not the owner alone."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = [(i, "hot" if i % 3 == 0 else f"u{i}", T0 + dt.timedelta(minutes=37 * i))
               for i in range(300)]
        left = spark.createDataFrame(hot, "oid INT, owner STRING, ots TIMESTAMP_NTZ")
        right = spark.createDataFrame(hot, "mid INT, owner STRING, mts TIMESTAMP_NTZ")
        j = interval_join(left, right, ["owner"], "ots", "mts", "1 hour")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
        assert exchanges and all("_ib" in ln and "owner" in ln for ln in exchanges)
        assert rows(j.filter("owner = 'hot'"), "oid", "mid") == \
            _brute([r for r in hot if r[1] == "hot"], [r for r in hot if r[1] == "hot"],
                   interval_micros("1 hour"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_semi_is_one_scan_and_one_exchange(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.range(100).selectExpr("id % 7 AS k", "id AS ts").write.parquet(path)
    p = _plan(latest_semi(spark.read.parquet(path), ["k"], "ts"))
    assert p.count("FileScan") == 1 and p.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in p
