import random

import pytest
from pyspark.sql import functions as F

from loadwright.operators import keys as K
from loadwright.operators import modes as M

SCHEMA = "a STRING, b STRING, v INT"


def _k(t):
    return tuple((x is None, "" if x is None else str(x)) for x in t)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_k)


def srt(items):
    return sorted(items, key=_k)


def test_anti_single_key_null_kept(spark):
    t = spark.createDataFrame([("1", "x", 1), ("2", "x", 2), (None, "x", 3)], SCHEMA)
    s = spark.createDataFrame([("2", "y", 9), (None, "y", 8)], SCHEMA)
    kept = K.anti_by_key(t, s, ["a"])
    assert rows(kept) == srt([("1", "x", 1), (None, "x", 3)])
    assert rows(K.matched_by_key(t, s, "a")) == [("2", "x", 2)]


def test_composite_keys_compare_tuples_not_concatenations(spark):
    t = spark.createDataFrame([("a", "bc", 1), ("ab", "c", 2)], SCHEMA)
    s = spark.createDataFrame([("ab", "c", 5)], SCHEMA)
    assert rows(K.anti_by_key(t, s, ["a", "b"])) == [("a", "bc", 1)]
    out = M.load_update(t, s, "a, b")
    assert rows(out) == srt([("a", "bc", 1), ("ab", "c", 5)])


def test_broadcast_only_behind_measured_bytes(spark):
    t = spark.createDataFrame([("1", "x", 1)], SCHEMA)
    s = spark.createDataFrame([("1", "y", 2)], SCHEMA)
    hinted = lambda n: "broadcast" in K.anti_by_key(t, s, ["a"], n)._jdf.queryExecution().analyzed().toString().lower()
    wide = spark.createDataFrame([("k" * 5000, "y", 2)], SCHEMA)
    assert K.assert_unique(wide, ["a"]).key_bytes >= 5000
    assert hinted(1) and not hinted(None) and not hinted(K.BROADCAST_KEYSET_BYTES + 1)


def test_key_profile_counts_null_tuple_once(spark):
    df = spark.createDataFrame([(None, None, 1), (None, None, 2), (None, None, 3), ("1", "1", 4)], SCHEMA)
    p = K.key_profile(df, ["a", "b"]).first()
    assert (p.n_rows, p.n_keys, p.n_dup_keys, p.n_dup_rows) == (4, 2, 1, 3)
    res = K.assert_unique(df, ["a", "b"], raise_on_fail=False)
    assert not res.passed
    with pytest.raises(K.DuplicateKeys):
        K.assert_unique(df, ["a", "b"])
    assert K.assert_unique(df.where("a is not null"), ["a", "b"]).passed


def test_pk_violations(spark):
    df = spark.createDataFrame([("1", "1", 1), ("1", "1", 2), ("2", None, 3), ("3", "3", 4)], SCHEMA)
    got = {(r.a, r.b): r.n for r in K.pk_violations(df, ["a", "b"]).collect()}
    assert got == {("1", "1"): 2, ("2", None): 1}


def test_modes(spark):
    t = spark.createDataFrame([("1", "x", 1), ("2", "x", 2)], SCHEMA)
    s = spark.createDataFrame([("2", "y", 20), ("3", "y", 30)], SCHEMA)
    assert rows(M.load_full(t, s)) == rows(s)
    assert rows(M.load_full(t, s.limit(0))) == []
    assert rows(M.load_insert(t, s)) == srt(rows(t) + rows(s))
    once = M.load_update(t, s, ["a"])
    assert rows(once) == srt([("1", "x", 1), ("2", "y", 20), ("3", "y", 30)])
    assert rows(M.load_update(once, s, ["a"])) == rows(once)          # idempotent
    assert M.effective_mode("UPDT", None) == "INST"
    with pytest.raises(ValueError):
        M.effective_mode("PURG", ["a"])


def test_stage_columns_are_conformed_by_name(spark):
    t = spark.createDataFrame([("1", "x", 1)], SCHEMA)
    s = spark.createDataFrame([(5, "y", "2")], "v BIGINT, b STRING, a STRING")
    out = M.load_update(t, s, ["a"])
    assert out.columns == ["a", "b", "v"] and rows(out) == srt([("1", "x", 1), ("2", "y", 5)])


def test_merge_equals_fold(spark):
    rnd = random.Random(7)

    def frame(n, lo, hi, tag, nulls=False):
        data = []
        keys = rnd.sample(range(lo, hi), n)
        for k in keys:
            key = None if nulls and rnd.random() < 0.1 else str(k)
            data.append((key, tag, rnd.randint(0, 99)))
        return spark.createDataFrame(data, SCHEMA)

    target = frame(60, 0, 100, "t", nulls=True).unionByName(frame(10, 0, 100, "t2"))   # dup keys in target
    for plan_modes in (["UPDT", "UPDT", "UPDT"], ["FULL", "UPDT", "UPDT"]):
        deliveries = [(m, frame(30, 0, 150, f"d{i}", nulls=True)) for i, m in enumerate(plan_modes)]
        fold = M.apply_deliveries(target, deliveries, keys=["a"], checkpoint_every=2)
        bulk = M.merge_deliveries(target, deliveries, keys=["a"])
        assert rows(fold) == rows(bulk)
    ins = [("UPDT", frame(5, 0, 10, "i"))]
    assert rows(M.merge_deliveries(target, ins, keys=None)) == rows(M.apply_deliveries(target, ins, None))


def test_bulk_merge_never_shuffles_the_target_when_the_delivered_keys_are_small(spark):
    target = spark.range(0, 5000).selectExpr("CAST(id AS STRING) AS a", "'t' AS b", "CAST(id AS INT) AS v")
    d1 = spark.createDataFrame([("1", "x", 10), ("2", "x", 20), (None, "x", 0)], SCHEMA)
    d2 = spark.createDataFrame([("2", "y", 21), ("7", "y", 70)], SCHEMA)
    deliveries = [("UPDT", d1), ("UPDT", d2)]
    merged = M.merge_deliveries(target, deliveries, keys=["a"], key_bytes=400)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert rows(merged) == rows(M.apply_deliveries(target, deliveries, ["a"]))
    got = {r.a: (r.b, r.v) for r in merged.where("a IN ('1', '2', '7', '3')").collect()}
    assert got == {"1": ("x", 10), "2": ("y", 21), "7": ("y", 70), "3": ("t", 3)}


def test_uniqueness_gate_counts_null_key_rows_in_the_same_aggregate(spark):
    df = spark.createDataFrame([("x", "1", 1), (None, "1", 2), (None, "1", 3), ("y", None, 4)], SCHEMA)
    result = K.assert_unique(df, ["a", "b"], raise_on_fail=False)
    assert (result.n_rows, result.n_keys, result.n_null_rows) == (4, 3, 3)
    assert not result.passed                       # (NULL, '1') occurs twice
    assert "n_null_rows" not in K.key_profile(df, ["a", "b"]).columns
