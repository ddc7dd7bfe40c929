"""Write order for tables that are filtered by several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_Z = "#z"  # no column of the model is called that


def _bounds(df: DataFrame, column: str, buckets: int) -> list:
    """At most ``buckets`` - 1 values that cut the column into even parts, of any type with an order.

    Spark's own range partitioner samples the one column; a frequent value makes one bound.
    """
    parts = df.select(F.col(column).alias("v")).filter("v is not null").repartitionByRange(buckets, "v")
    lows = parts.groupBy(F.spark_partition_id()).agg(F.min("v").alias("low")).collect()
    return sorted({r["low"] for r in lows})[1:]


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Number that mixes the leading bits of each column's rank, so that neighbours are near in all.

    Ranks are counted against at most 2^``bits`` bounds per column; NULL has rank zero.
    """
    mixed = F.lit(0).cast("bigint")
    for i, column in enumerate(columns):
        bounds = _bounds(df, column, 1 << bits)
        # Spread over all bits, however few bounds there are.
        step = (1 << bits) // (len(bounds) + 1)
        rank = F.lit(0)
        for bound in bounds:
            rank = rank + F.coalesce(F.col(column) >= F.lit(bound), F.lit(False)).cast("int")
        rank = rank * step
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("bigint")
            mixed = mixed + F.shiftleft(bit, b * len(columns) + i)
    return mixed


def clustered(df: DataFrame, columns: Sequence[str], key: str, bits: int = 6) -> DataFrame:
    """``df`` in a write order in which a filter on any of ``columns`` finds few files.

    Rows are range-partitioned by the interleaved ranks of the columns, hence the least and
    greatest value that a Parquet file notes are close for each of them. ``key`` cuts
    rows that agree in all columns, so that they are no hot partition.
    """
    ranked = df.withColumn(_Z, interleaved(df, columns, bits))
    order = [F.col(f"`{_Z}`"), F.col(key)]
    return ranked.repartitionByRange(*order).sortWithinPartitions(*order).drop(_Z)
