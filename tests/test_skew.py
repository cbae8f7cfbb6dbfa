"""A hot key holding a third of the rows, plus many NULL keys."""

from pyspark.sql import functions as F

from loadwright.operators import keys as K
from loadwright.operators.counts import run_status

N = 30_000


def _skewed(spark):
    # a third of the rows share key 7, a sixth have a NULL key, the rest are spread out
    return (spark.range(N)
            .select(F.when(F.col("id") % 3 == 0, F.lit(7))
                    .when(F.col("id") % 6 == 1, F.lit(None))
                    .otherwise(F.col("id")).cast("long").alias("k"),
                    F.col("id").alias("v")))


def test_anti_join_splits_the_hot_partition(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        target = _skewed(spark).repartition(8)
        stage = spark.range(0, N, 5).select(F.col("id").alias("k"))     # keys ending 0/5 (not 7)
        kept = K.anti_by_key(target, stage, ["k"])
        n = len(kept.collect())                   # runs this DataFrame's own adaptive plan
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    rows = _skewed(spark).collect()
    staged = set(range(0, N, 5))
    expected = sum(1 for r in rows if r.k is None or r.k not in staged)
    assert n == expected
    assert "skew=true" in plan or "SortMergeJoin(skew=true)" in plan


def test_profile_and_status_with_hot_key(spark):
    df = _skewed(spark)
    p = K.key_profile(df, ["k"]).first()
    rows = df.collect()
    keys = [r.k for r in rows]
    assert p.n_rows == N and p.n_keys == len(set(keys))
    assert p.n_dup_rows == sum(keys.count(k) for k in {7, None})
    plan = K.key_profile(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan                 # map-side combine before the shuffle
    log = df.select(F.coalesce("k", F.lit(-1)).alias("S_ID"), F.lit("p").alias("S_PROCESS"),
                    F.lit("v").alias("S_PROCESS_VALUE"), (F.col("v") % 2).cast("int").alias("S_STATUS"),
                    F.timestamp_seconds(F.col("v")).cast("timestamp_ntz").alias("TS"), F.col("v").alias("SEQ"))
    hot = run_status(log).where("S_ID = 7").first()
    assert hot.S_STATUS == (max(r.v for r in rows if r.k == 7) % 2)
