"""Distributed ranks against plain windows, and the shape of their plans."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import cleaning, ranking
from tillroll.operators.ranking import accumulated, numbered, numbered_by_lead, tiled, tiled_by_value
from tillroll.sources.mapped import raw_export
from tillroll.sources.scratch import written


def _values(kind: str, n: int):
    rng = random.Random(n)
    if kind == "unique":
        return rng.sample(range(10 * n), n) if n else []
    if kind == "tied":
        return [rng.randrange(3) for _ in range(n)]
    if kind == "constant":
        return [7] * n
    return [rng.choice([None, rng.randrange(50)]) for _ in range(n)]


def _frame(spark, kind, n):
    rows = [
        (f"id{i:05d}", None if v is None else Decimal(v)) for i, v in enumerate(_values(kind, n))
    ]
    return spark.createDataFrame(rows, "id string, v decimal(12,2)").repartition(5)


def _order():
    return [F.desc_nulls_last("v"), F.asc_nulls_last("id")]


@pytest.mark.parametrize("kind", ["unique", "tied", "constant", "nulls"])
@pytest.mark.parametrize("n", [0, 3, 10, 11, 97, 1000])
def test_tiles_and_numbers_equal_plain_windows(spark, kind, n):
    df = _frame(spark, kind, n)
    plain = Window.orderBy(*_order())
    want = df.select("id", F.row_number().over(plain), F.ntile(10).over(plain)).collect()
    tiles = {r["id"]: r["t"] for r in tiled(df, "t", 10, _order()).collect()}
    numbers = {r["id"]: r["k"] for r in numbered(df, "k", _order()).collect()}
    assert {(i, k, t) for i, k, t in want} == {(i, numbers[i], tiles[i]) for i in numbers}
    assert len(numbers) == len(tiles) == n


@pytest.mark.parametrize("kind", ["unique", "tied", "constant", "nulls"])
def test_running_sum_equals_plain_window(spark, kind):
    df = _frame(spark, kind, 500)
    plain = Window.orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0)
    want = {
        r["id"]: r["c"] or Decimal(0)
        for r in df.select("id", F.sum("v").over(plain).alias("c")).collect()
    }
    got = accumulated(df, "v", "c", "total", _order()).collect()
    assert {r["id"]: r["c"] for r in got} == want
    assert {r["total"] for r in got} == {max(want.values())}


def test_value_shared_by_a_third_of_the_rows_is_spread_over_tasks(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(60_000).select("id", hot.alias("v")).repartition(6)
    # So small an input would be merged into one task again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = numbered(df, "k", [F.asc("v"), F.asc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (1, 60_000, 60_000)
    [path] = {p.rsplit("/", 1)[0] for p in out.inputFiles()}
    rows = spark.read.parquet(path)
    sizes = [r["count"] for r in rows.groupBy(F.shiftright("_slot", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 60_000 / 4


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "ranked",
    [
        lambda d: numbered(d, "k", _order()),
        lambda d: tiled(d, "k", 10, _order()),
        lambda d: accumulated(d, "v", "k", "t", _order()),
    ],
)
def test_single_task_step_sees_segment_counts_only(spark, ranked):
    plan = _plan(ranked(_frame(spark, "unique", 50))).splitlines()
    at = [i for i, line in enumerate(plan) if "Exchange SinglePartition" in line]
    assert len(at) == 1
    assert "HashAggregate(keys=[_segment" in plan[at[0] + 1]
    assert "Python" not in "".join(plan)


@pytest.mark.parametrize("kind", ["unique", "tied", "constant", "nulls"])
@pytest.mark.parametrize("n", [0, 3, 11, 1000])
def test_tiles_by_value_equal_plain_windows(spark, kind, n):
    df = _frame(spark, kind, n)
    want = df.select("id", F.ntile(10).over(Window.orderBy(*_order()))).collect()
    got = tiled_by_value(df, "t", 10, "v", ["id"])
    assert got.columns == ["id", "v", "t"]
    assert {r["id"]: r["t"] for r in got.collect()} == {r[0]: r[1] for r in want}


def test_tiles_by_value_sort_only_rows_near_edges(spark, monkeypatch):
    sizes = []
    real = ranking._segmented

    def counted(df, order, label):
        sizes.append(df.count())
        return real(df, order, label)

    monkeypatch.setattr(ranking, "_segmented", counted)
    df = _frame(spark, "unique", 4000)
    assert tiled_by_value(df, "t", 10, "v", ["id"]).groupBy("t").count().filter("count <> 400").isEmpty()
    assert len(sizes) == 1 and 0 < sizes[0] < 4000 * 0.12


@pytest.mark.parametrize("days", [1, 60, 5_000])
def test_numbers_by_day_equal_plain_window_and_sample_only_for_busy_days(spark, days, monkeypatch):
    kept = []
    monkeypatch.setattr(ranking, "written", lambda df, label: kept.append(df) or written(df, label))
    day = F.when(F.col("id") % 50 != 49, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 37 % days).cast("int")))
    df = spark.range(5_000).select(day.alias("d"), (F.col("id") * 7 % 5_000).alias("k")).repartition(6)
    if days > 1:
        df = df.filter("d is not null or k < 20")
    order = [F.asc_nulls_last("d"), F.asc_nulls_last("k")]
    got = numbered_by_lead(df, "n", "d", order).collect()
    want = df.select("d", "k", F.row_number().over(Window.orderBy(*order)).alias("n")).collect()
    assert sorted(got, key=lambda r: r["n"]) == sorted(want, key=lambda r: r["n"])
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert ("rangepartitioning" in plan) == (days == 1)


def test_lines_of_many_days_are_numbered_without_sampling_whole_rows(spark, folder, monkeypatch):
    kept = []
    monkeypatch.setattr(ranking, "written", lambda df, label: kept.append(df) or written(df, label))
    lines = cleaning.clean(raw_export(spark, folder))
    assert lines.count() == lines.agg(F.max("order_line_id")).first()[0]
    assert "rangepartitioning" not in kept[0]._jdf.queryExecution().executedPlan().toString()
