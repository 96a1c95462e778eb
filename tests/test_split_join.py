"""The join that keeps the rows of hot keys in place."""

import statistics

import pytest
from pyspark.sql import functions as F

from riskframe.operators.joins import attach_by_key, split_join
from riskframe.operators.windows import diff_from_group_mean


def rows_of(spark, n=30_000):
    """A third of the rows have one key, a tenth has none, the others 3,000 keys."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot")).when(i % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i * 7919) % 3000))
    return spark.range(n, numPartitions=8).select("id", key.alias("k"), (i % 5).alias("j"), (i % 101).cast("double").alias("v"))


def check(got, want):
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_equals_a_plain_join(spark, how, keys):
    rows = rows_of(spark, 3_000)
    groups = rows.where("j < 3 and coalesce(k, '') != 'k1'").groupBy(*keys).agg(F.sum("v").alias("s"))
    named = groups.select(*[F.col(k).alias(f"g_{k}") for k in keys], "s")
    cond = [rows[k].eqNullSafe(F.col(f"g_{k}")) for k in keys]
    want = rows.join(named, cond, how).select(*rows.columns, "s")
    for heavy in (None, 0, 50, 10_000_000):
        check(split_join(rows, groups, keys, how, heavy_rows=heavy), want)


def test_heavy_groups_stay_within_the_bound(spark):
    rows = rows_of(spark, 3_000)
    groups = rows.groupBy("k").agg(F.sum("v").alias("s"))
    got = split_join(rows, groups, ["k"], heavy_rows=0, max_broadcast_rows=3)      # raised until three groups or fewer are heavy
    check(got, split_join(rows, groups, ["k"], heavy_rows=10_000_000))
    assert split_join(rows.limit(0), groups, ["k"], "left").count() == 0
    assert split_join(rows, groups.limit(0), ["k"], "left").count() == 3_000
    with pytest.raises(ValueError):
        split_join(rows, groups, ["k"], "outer")


def test_no_task_above_twice_the_median(spark, tmp_dir):
    rows_of(spark).write.parquet(f"{tmp_dir}/rows")
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    groups = rows.groupBy("k").agg(F.avg("v").alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        named = groups.select(F.col("k").alias("g"), "m")
        plain = sizes(rows.join(named, rows["k"].eqNullSafe(F.col("g"))))
        split = sizes(split_join(rows, groups, ["k"]))
        assert max(plain) > 2 * statistics.median(plain)
        assert max(split) <= 2 * statistics.median(split) and sum(split) == sum(plain) == 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_group_means_beyond_the_broadcast_bound(spark):
    rows = rows_of(spark, 3_000)
    want = diff_from_group_mean(rows, "k", "v")
    check(diff_from_group_mean(rows, "k", "v", max_broadcast_rows=1), want)
    means = rows.groupBy("k").agg(F.avg("v").alias("m"))
    check(attach_by_key(rows, means, ["k"], max_broadcast_rows=1), attach_by_key(rows, means, ["k"]))
