import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert as up
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.projection import with_audit_columns

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
PLANS = ["outer", "split", "broadcast"]


def target_of(spark, data, schema="k int, v string"):
    return with_audit_columns(spark.createDataFrame(data, schema), T1)


def actions(df):
    return {r["action"]: r["rows"] for r in up.action_counts(df).collect()}


@pytest.mark.parametrize("plan", PLANS)
def test_insert_update_keep(spark, as_rows, plan):
    target = target_of(spark, [(1, "a"), (2, "b"), (3, None)])
    batch = spark.createDataFrame([(2, "b"), (3, "c"), (4, "d")], "k int, v string")
    got = up.upsert_with_actions(target, batch, ["k"], T2, True, plan)
    by_key = {r["k"]: (r["v"], str(r["edw_inserted_timestamp"]), r["edw_updated_timestamp"] and str(r["edw_updated_timestamp"]), r["_action"]) for r in got.collect()}
    assert by_key == {
        1: ("a", T1, None, "keep"),
        2: ("b", T1, None, "keep"),
        3: ("c", T1, T2, "update"),
        4: ("d", T2, None, "insert"),
    }
    assert got.drop("_action").columns == target.columns


@pytest.mark.parametrize("plan", PLANS)
def test_null_keys_never_match(spark, plan):
    target = target_of(spark, [(None, "a"), (1, "b")])
    batch = spark.createDataFrame([(None, "z"), (1, "b")], "k int, v string")
    got = up.upsert_with_actions(target, batch, ["k"], T2, True, plan)
    assert got.count() == 3
    assert actions(got) == {"insert": 1}


@pytest.mark.parametrize("plan", PLANS)
def test_empty_sides(spark, plan):
    nothing = spark.createDataFrame([], "k int, v string")
    some = spark.createDataFrame([(1, "a")], "k int, v string")
    assert actions(up.upsert_with_actions(with_audit_columns(nothing, T1), some, ["k"], T2, True, plan)) == {"insert": 1}
    got = up.upsert_with_actions(target_of(spark, [(1, "a")]), nothing, ["k"], T2, True, plan)
    assert actions(got) == {} and got.count() == 1


@pytest.mark.parametrize("plan", PLANS)
def test_second_upsert_of_a_batch_changes_nothing(spark, as_rows, plan):
    target = target_of(spark, [(1, "a"), (2, "b")])
    batch = spark.createDataFrame([(2, "x"), (3, None)], "k int, v string")
    once = up.upsert(target, batch, ["k"], T2, True, plan)
    twice = up.upsert_with_actions(once, batch, ["k"], T3, True, plan)
    assert actions(twice) == {}
    assert as_rows(twice.drop("_action")) == as_rows(once)


@pytest.mark.parametrize("plan", PLANS)
def test_value_moving_between_null_columns_is_a_change(spark, plan):
    target = target_of(spark, [(1, 5, None)], "k int, a int, b int")
    batch = spark.createDataFrame([(1, None, 5)], "k int, a int, b int")
    assert actions(up.upsert_with_actions(target, batch, ["k"], T2, True, plan)) == {"update": 1}


@pytest.mark.parametrize("plan", ["split", "broadcast"])
def test_repeated_target_keys_are_all_updated(spark, plan):
    target = target_of(spark, [(1, "a"), (1, "b"), (2, "c")])
    batch = spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string")
    got = up.upsert_with_actions(target, batch, ["k"], T2, plan=plan)
    assert actions(got) == {"update": 2, "insert": 1}


@pytest.mark.parametrize("plan", PLANS)
def test_composite_and_odd_names(spark, plan):
    names = ["key one", "key.two", "a 'b' `c`"]
    target = with_audit_columns(spark.createDataFrame([(1, 23, "x"), (12, 3, "y")], "a int, b int, c string").toDF(*names), T1)
    batch = spark.createDataFrame([(12, 3, "z"), (1, 2, "w")], "a int, b int, c string").toDF(*names)
    got = up.upsert_with_actions(target, batch, names[:2], T2, True, plan)
    assert actions(got) == {"update": 1, "insert": 1}
    assert got.count() == 3


@pytest.mark.parametrize("seed", range(3))
def test_all_plans_agree_with_a_plain_dictionary(spark, as_rows, seed):
    rnd = random.Random(seed)
    def value():
        return rnd.choice([None, "a", "b"])
    old = {(k % 7, k): (value(), value()) for k in rnd.sample(range(60), 30)}
    raw = [(k % 7, k, value(), value(), rnd.randrange(5)) for k in rnd.choices(range(60), k=50)]
    schema = "a int, b int, x string, y string"
    target = target_of(spark, [(*k, *v) for k, v in old.items()], schema)
    feed = spark.createDataFrame(raw, schema + ", at int")
    batch = latest_per_key(feed.withColumn("ins", F.timestamp_seconds("at").cast("timestamp_ntz")), ["a", "b"], "ins", tiebreak=["x", "y"])
    batch = batch.select("a", "b", "x", "y")
    expected = {k: (*v, T1, None) for k, v in old.items()}
    last = lambda s: (s is None, s or "")
    for a, b in {r[:2] for r in raw}:
        best = min((r for r in raw if r[:2] == (a, b)), key=lambda r: (-r[4], last(r[2]), last(r[3])))
        if (a, b) not in old:
            expected[a, b] = (*best[2:4], T2, None)
        elif old[a, b] != best[2:4]:
            expected[a, b] = (*best[2:4], T1, T2)
    for plan in PLANS:
        got = {
            (r["a"], r["b"]): (r["x"], r["y"], str(r["edw_inserted_timestamp"]), r["edw_updated_timestamp"] and str(r["edw_updated_timestamp"]))
            for r in up.upsert(target, batch, ["a", "b"], T2, True, plan).collect()
        }
        assert got == expected


def test_columns_the_batch_lacks_are_kept(spark):
    target = target_of(spark, [(1, "a", "own")], "k int, v string, extra string")
    batch = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    got = {r["k"]: r["extra"] for r in up.upsert(target, batch, ["k"], T2).collect()}
    assert got == {1: "own", 2: None}


def test_unknown_columns_and_plans_are_refused(spark):
    target = target_of(spark, [(1, "a")])
    batch = spark.createDataFrame([(1, "b", 1)], "k int, v string, n int")
    with pytest.raises(ValueError, match="missing in target"):
        up.upsert(target, batch, ["k"], T2)
    with pytest.raises(ValueError, match="plan must be"):
        up.upsert(target, batch.drop("n"), ["k"], T2, plan="merge")


def test_changed_rows(spark, as_rows):
    target = target_of(spark, [(1, "a"), (2, None), (3, "c")])
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    assert as_rows(up.changed_rows(target, batch, ["k"])) == [(2, "b"), (3, None)]


@pytest.mark.parametrize("plan", PLANS)
def test_documents(spark, plan):
    def docs(*texts):
        return spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("doc"))

    target = with_audit_columns(
        docs('{"_id":"1","a":1,"b":2}', '{"_id":"2","a":1}').withColumn("doc_key", F.variant_get("doc", "$._id", "string")), T1
    )
    batch = docs('{"b":2,"a":1,"_id":"1"}', '{"_id":"2","a":5}', '{"_id":"3"}')
    merged = up.upsert_documents(target, batch, "doc", "_id", T2, plan=plan, target_unique=True)
    got = {r["doc_key"]: (r["j"], str(r["edw_inserted_timestamp"]), r["edw_updated_timestamp"] is not None) for r in merged.withColumn("j", F.to_json("doc")).collect()}
    assert got == {
        "1": ('{"_id":"1","a":1,"b":2}', T1, False),
        "2": ('{"_id":"2","a":5}', T1, True),
        "3": ('{"_id":"3"}', T2, False),
    }


def test_a_batch_over_the_limit_is_not_broadcast(spark, monkeypatch):
    target = target_of(spark, [(1, "a")])
    batch = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    plans = []
    for limit in (up.BROADCAST_BYTES, 10):
        monkeypatch.setattr(up, "BROADCAST_BYTES", limit)
        merged = up.upsert(target, batch, ["k"], T2, True, "broadcast")
        plans.append("strategy=broadcast" in merged._jdf.queryExecution().optimizedPlan().toString())
        assert sorted((r.k, r.v) for r in merged.collect()) == [(1, "b"), (2, "c")]
    assert plans == [True, False]


def test_merge_into_a_catalog_resolves_its_columns(spark, tmp_path):
    """No catalog with row-level operations is at hand: the plan is built, and refused for that reason alone."""
    batch = spark.createDataFrame([(1, "b", 3)], "`k 1` int, v string, extra int")
    target_of(spark, [(1, "a")], "`k 1` int, v string").write.option("path", str(tmp_path / "t")).saveAsTable("t_merge")
    try:
        with pytest.raises(Exception, match="MERGE"):
            up.merge_into_catalog(batch, "t_merge", ("k 1",), T2)
    finally:
        spark.sql("DROP TABLE t_merge")
