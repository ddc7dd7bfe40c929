"""Joins in pieces: equal to plain joins, and no task with most of a frequent key."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators.cleaning import add_customer_key
from tillroll.operators.skew import frequent_values, heavy_keys, spread_join

PARTS = 32


@pytest.fixture
def plain(spark):
    """No help from adaptive execution or automatic broadcasts."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": str(PARTS),
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_lines(spark, n=9000):
    """A third of the lines has one key, a ninth none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 9 != 1, F.concat(F.lit("k"), F.col("id") % 700))
    return spark.range(n).select(
        F.col("id").alias("line"), key.alias("k"), F.when(F.col("id") % 2 == 0, 1).alias("m")
    )


def keyed(spark):
    return spark.range(650).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("number"),
    )


def largest_task(joined):
    return joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_a_plain_join(plain, how):
    lines, names = hot_lines(plain), keyed(plain)
    got, want = spread_join(lines, names, ["k"], ["line"], how), lines.join(names, "k", how)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_repeated_keys_on_both_sides_and_equal_nulls(plain):
    lines = hot_lines(plain, 900)
    twice = keyed(plain).withColumn("m", F.lit(1)).unionByName(
        plain.createDataFrame([("hot", 7, None), (None, 8, 1), (None, 9, None)], "k string, number bigint, m int")
    )
    got = spread_join(lines, twice.unionByName(twice), ["k", "m"], ["line"], "left", null_safe=True)
    theirs = twice.unionByName(twice).withColumnsRenamed({"k": "rk", "m": "rm"})
    same = F.col("k").eqNullSafe(F.col("rk")) & F.col("m").eqNullSafe(F.col("rm"))
    want = lines.join(theirs, same, "left").select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_third_of_the_lines_does_not_meet_in_one_task(plain):
    lines, names = hot_lines(plain), keyed(plain)
    assert largest_task(lines.join(names, "k", "left")) > 3000
    assert largest_task(spread_join(lines, names, ["k"], ["line"], "left")) < 6 * 9000 / PARTS


def test_only_frequent_keys_are_cut(plain):
    lines = hot_lines(plain).filter("k is not null")
    found = heavy_keys(lines, F.col("k"), PARTS).collect()
    hot = plain.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    n = lines.count()
    assert [(r["_hash"], r["_pieces"]) for r in found] == [(hot, -(-3000 * PARTS // n))]


def test_empty_sides_and_refused_joins(plain):
    lines, names = hot_lines(plain, 90), keyed(plain)
    assert spread_join(lines.limit(0), names.limit(0), ["k"], ["line"]).isEmpty()
    assert spread_join(lines, names.limit(0), ["k"], ["line"], "left").count() == 90
    with pytest.raises(ValueError, match="two types"):
        spread_join(lines, names.withColumn("k", F.lit(1)), ["k"], ["line"])
    with pytest.raises(ValueError, match="cannot spread"):
        spread_join(lines, names, ["k"], ["line"], "right")


def test_customer_keys_of_a_frequent_name(plain):
    lines = hot_lines(plain).select(
        F.col("line").alias("order_line_id"), F.col("k").alias("customer_name")
    )
    got = add_customer_key(lines, spread=True)
    want = add_customer_key(lines).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("one_in", [2, 3, 10, 1000])
def test_frequent_values_are_exact(spark, one_in):
    rows = hot_lines(spark)
    known = rows.filter("k is not null")
    n = known.count()
    want = {r["k"]: r["count"] for r in known.groupBy("k").count().collect() if r["count"] * one_in > n}
    assert {r["k"]: r["rows"] for r in frequent_values(rows, "k", one_in).collect()} == want
    assert frequent_values(rows.limit(0), "k", one_in).isEmpty()
