"""Exact global ranks, tiles and running sums without a single-task window.

``row_number() over (order by ...)`` without a partition sends every row to one
task. Here rows are range-partitioned and sorted instead, each row's place is
frozen in a written table, and the only global state is one line of counts per
segment. The number of segments is at most ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import in_rounds, written

# Public layout of monotonically_increasing_id: segment number above, row in segment below.
_ROW_BITS = 33

_SEGMENT = "_segment"
_PLACE = "_place"
_BEFORE = "_rows_before"
_ROWS = "_rows_total"


def _segmented(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` with its segment and its place inside the segment (from 0), written once.

    ``order`` must tell any two distinguishable rows apart. That makes places
    reproducible when a task is retried, and it lets the range boundaries cut
    through a leading value shared by any share of the rows.
    """
    slot = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot)
    return (
        written(placed, label)
        .withColumn(_SEGMENT, F.shiftright("_slot", _ROW_BITS))
        .withColumn(_PLACE, F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_slot")
    )


def _segment_offsets(segmented: DataFrame, sums: Mapping[str, str]) -> DataFrame:
    """Per segment: rows and sums in all earlier segments, and totals over all segments.

    ``sums`` maps each summed column to the name of its grand total.
    """
    per_segment = segmented.groupBy(_SEGMENT).agg(
        F.count("*").alias("_n"), *(F.sum(c).alias(f"_sum_{c}") for c in sums)
    )
    everything = Window.partitionBy()
    earlier = Window.orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return per_segment.select(
        _SEGMENT,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE),
        F.sum("_n").over(everything).alias(_ROWS),
        *(
            F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
            for c in sums
        ),
        *(F.sum(f"_sum_{c}").over(everything).alias(total) for c, total in sums.items()),
    )


def _with_counts(segmented: DataFrame) -> DataFrame:
    # At most one offset row per shuffle partition, hence safe to broadcast.
    return segmented.join(F.broadcast(_segment_offsets(segmented, {})), _SEGMENT)


def _rank() -> Column:
    return F.col(_BEFORE) + F.col(_PLACE)


def _quotient(dividend: Column, divisor: Column) -> Column:
    """Whole-number division; the dividend is made divisible first, so the double is exact."""
    divisor = F.nullif(divisor, F.lit(0).cast("bigint"))
    return ((dividend - dividend % divisor) / divisor).cast("bigint")


def numbered(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Dense row number 1..N over all rows in ``order``. Writes one intermediate table."""
    rows = _with_counts(_segmented(df, order, "numbered"))
    return rows.select(*df.columns, (_rank() + 1).alias(name))


def numbered_by_lead(
    df: DataFrame,
    name: str,
    lead: str,
    order: Sequence[Column],
    kept: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``numbered`` for an ``order`` that begins with the column ``lead``, rising and NULL last.

    All rows with one value of ``lead`` go to the same task by its hash and are sorted there, so no
    boundaries are sampled, which takes a further pass over whole rows. Rows per value are counted
    first: if one value has more than a quarter of a partition's share, rows are spread by range
    instead. A large table is sorted in two rounds, each with its share of the values; only the rows that
    ``kept`` leaves are numbered, a filter that is made for a round's own share alone. One row per value is ranked in one task and broadcast, so ``lead`` should be a date or the like.
    """
    rows, largest = kept(df).groupBy(lead).agg(F.count("*").alias("_n")).agg(F.sum("_n"), F.max("_n")).first()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if largest is None or 4 * largest * partitions > rows:
        return numbered(kept(df), name, order)
    slot = F.monotonically_increasing_id()
    parts = [
        kept(df.filter(share))
        .repartition(F.col(lead))
        .sortWithinPartitions(*order)
        .withColumn("_slot", slot)
        for share in in_rounds(df, F.col(lead))
    ]
    placed = reduce(DataFrame.unionByName, [written(part, "numbered") for part in parts])
    earlier = Window.orderBy(F.col("_lead").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.col(lead).alias("_lead"))
        .agg(F.count("*").alias("_n"), F.min("_slot").alias("_first"))
        .select("_lead", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    same = F.col(lead).eqNullSafe(F.col("_lead"))
    number = F.col(_BEFORE) + F.col("_slot") - F.col("_first") + 1
    return placed.join(F.broadcast(offsets), same).select(
        *(f"`{c}`" for c in df.columns), number.alias(name)
    )


def _tile(rank: Column, n: Column, tiles: int) -> Column:
    """Tile of the row at ``rank`` (from 0) of ``n`` rows: the first ``n % tiles`` tiles have one more."""
    small, larger = _quotient(n, F.lit(tiles)), n % tiles
    in_larger = larger * (small + 1)
    tile = F.when(rank < in_larger, _quotient(rank, small + 1)).otherwise(
        larger + _quotient(rank - in_larger, small)
    )
    return (tile + 1).cast("int")


def tiled(df: DataFrame, name: str, tiles: int, order: Sequence[Column]) -> DataFrame:
    """Same tile per row as ``ntile(tiles) over (order by ...)``. Writes one intermediate table.

    Sorts all rows; ``tiled_by_value`` sorts few of them.
    """
    rows = _with_counts(_segmented(df, order, "tiled"))
    return rows.select(*df.columns, _tile(_rank(), F.col(_ROWS), tiles).alias(name))


def tiled_by_value(
    df: DataFrame, name: str, tiles: int, value: str, ties: Sequence[str], per_tile: int = 16
) -> DataFrame:
    """Tiles of rows by falling ``value`` and rising ``ties``, NULL last, without sorting all rows.

    A quantile sketch cuts the values into about ``per_tile`` buckets per tile. Rows per
    bucket tell between which ranks it lies: most buckets are inside one tile. Only the rows
    of a bucket that holds the edge between two tiles are sorted, over all partitions and by all
    columns, so that a value which many rows share is no hot spot. The tiles are those of
    ``ntile``, however good the sketch. ``ties`` must tell rows with equal values apart.
    """
    rows = written(df, "tile-rows")
    wanted = tiles * per_tile
    shares = [i / wanted for i in range(1, wanted)]
    sketched = rows.agg(F.approx_percentile(value, shares, 100 * wanted).alias("bounds")).first()
    bounds = sorted({b for b in sketched["bounds"] or []})
    # A higher value lies above more bounds; buckets are numbered from the highest value on.
    above = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(value))) if bounds else F.lit(0)
    bucket = F.when(F.col(value).isNull(), len(bounds) + 1).otherwise(F.lit(len(bounds)) - above)
    placed = rows.withColumn("_bucket", bucket)

    everything, earlier = Window.partitionBy(), Window.orderBy("_bucket")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    first, last = F.col("_first"), F.col("_first") + F.col("_n") - 1
    total = F.col("_total")
    buckets = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(everything))
        .withColumn("_low", _tile(first, total, tiles))
        .withColumn("_edge", F.col("_low") != _tile(last, total, tiles))
    )
    sorted_before = F.coalesce(F.sum(F.when(F.col("_edge"), F.col("_n"))).over(before), F.lit(0))
    # One row per bucket, at most tiles * per_tile + 1 of them, hence safe to fetch and to broadcast.
    buckets = buckets.withColumn("_sorted", sorted_before)
    buckets = rows.sparkSession.createDataFrame(buckets.collect(), buckets.schema)
    known = placed.join(F.broadcast(buckets), "_bucket")
    inside = known.filter(~F.col("_edge")).select(*df.columns, F.col("_low").alias(name))
    order = [F.col("_bucket"), F.desc_nulls_last(value), *(F.asc_nulls_last(c) for c in ties)]
    edges = _with_counts(_segmented(known.filter("_edge"), order, "tile-edges"))
    rank = _rank() - F.col("_sorted") + F.col("_first")
    return inside.unionByName(edges.select(*df.columns, _tile(rank, total, tiles).alias(name)))


def accumulated(
    df: DataFrame, measure: str, running: str, total: str, order: Sequence[Column]
) -> DataFrame:
    """Running sum of ``measure`` in ``order`` and its grand total, on every row.

    Writes one intermediate table. The running sum restarts in each segment,
    which is an even share of the rows, and is lifted by the sums before it.
    """
    in_segment = (
        Window.partitionBy(_SEGMENT)
        .orderBy(_PLACE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    segmented = _segmented(df, order, "accumulated")
    rows = segmented.withColumn("_local", F.sum(measure).over(in_segment))
    offsets = _segment_offsets(segmented, {measure: total})
    # At most one offset row per shuffle partition, hence safe to broadcast.
    joined = rows.join(F.broadcast(offsets), _SEGMENT)
    return joined.select(
        *df.columns,
        (F.coalesce("_local", F.lit(0)) + F.col(f"_before_{measure}")).alias(running),
        F.col(total),
    )
