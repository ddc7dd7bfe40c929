"""Joins that stay even when a few keys hold much of the rows, with or without adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written

# Counters of the sketch per partition of a shuffle, and Spark's largest number of counters.
COUNTERS = 16
MOST_COUNTERS = 1_000_000


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _counters(wanted: int) -> int:
    return min(max(10_000, wanted), MOST_COUNTERS)


def heavy_keys(rows: DataFrame, key: Column, partitions: int) -> DataFrame:
    """(_hash, _pieces): hashes of keys on more than two even partitions' worth of rows.

    A counter sketch over the hashes, merged map-side, finds them in one pass over the
    columns of the key. It may also name lighter ones, at most one per
    partition, which does no harm: ``_pieces``, their share of the partitions rounded up,
    only says how finely a key is cut. Keys that share a hash are cut alike.
    """
    found = F.expr(f"approx_top_k(_hash, {partitions}, {_counters(COUNTERS * partitions)})")
    sketch = rows.select(F.xxhash64(key).alias("_hash")).agg(
        found.alias("_found"), F.count("*").alias("_rows")
    )
    pieces = F.ceil(F.col("count") * partitions / F.col("_rows"))
    return (
        sketch.select("_rows", F.inline("_found"))
        .filter(F.col("count") * partitions > 2 * F.col("_rows"))
        .select(F.col("item").alias("_hash"), F.least(pieces, F.lit(partitions)).alias("_pieces"))
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` on ``keys``, where a frequent key of ``left`` fills many tasks.

    Rows of a frequent key are cut into pieces by a hash of ``spread_by``, and the rows of
    that key in ``right`` are repeated once per piece, so ``right`` grows by at most two
    rows per shuffle partition if its keys are unique. Rows of ``left`` that cannot
    match, as a key is NULL, are cut into as many pieces as there are partitions. The pieces depend on
    stored values alone, so a task that is run again sends its rows to the same places.

    ``how`` is inner, left, left_semi or left_anti; ``null_safe`` takes NULL as equal to NULL. The
    result has the columns of ``left``, then, but for the last two, those of ``right`` without
    the keys. Keys must have the same types on both sides, as equal numbers of other types
    hash apart. ``spread_by`` should tell rows apart: equal values stay together. Keys are
    counted in ``counted``, or else in ``left``, which is then read twice and should be a stored
    table. Which keys are cut changes the work, never the result. Two empty sides give no rows.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a join of kind {how!r}")
    for key in keys:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise ValueError(f"key {key!r} has two types")
    partitions = _partitions(left.sparkSession)

    def whole(names: Sequence[str]) -> Column:
        return F.struct(*(F.col(f"`{name}`") for name in names))

    empty = reduce(Column.__or__, (F.col(f"`{key}`").isNull() for key in keys))
    counted = left if counted is None else counted
    matching = counted if null_safe else counted.filter(~empty)
    # Written once: both sides must be cut by the same list.
    heavy = F.broadcast(written(heavy_keys(matching, whole(keys), partitions), "heavy-keys"))
    pieces = F.coalesce("_pieces", F.lit(1).cast("bigint"))

    def with_pieces(side: DataFrame) -> DataFrame:
        return side.withColumn("_hash", F.xxhash64(whole(keys))).join(heavy, "_hash", "left")

    number = pieces if null_safe else F.when(empty, F.lit(partitions)).otherwise(pieces)
    piece = F.pmod(F.xxhash64(whole(spread_by)), number)
    cut = with_pieces(left).select(*(F.col(f"`{c}`") for c in left.columns), piece.alias("_piece"))

    theirs = {key: f"_right_{i}" for i, key in enumerate(keys)}
    every_piece = F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1))
    copies = with_pieces(right).select(
        *(F.col(f"`{c}`").alias(theirs.get(c, c)) for c in right.columns),
        every_piece.alias("_right_piece"),
    )
    equal = (
        F.col(f"`{key}`").eqNullSafe(F.col(theirs[key]))
        if null_safe
        else F.col(f"`{key}`") == F.col(theirs[key])
        for key in keys
    )
    same = reduce(Column.__and__, equal, F.col("_piece") == F.col("_right_piece"))
    return cut.join(copies, same, how).drop("_piece", "_right_piece", *theirs.values())


def frequent_values(rows: DataFrame, column: str, one_in: int) -> DataFrame:
    """(column, rows): values on more than one in ``one_in`` rows that have one, exactly counted.

    The sketch names candidates, at most twice ``one_in``, among which is each such value; only
    these are counted in a second pass. ``one_in`` may be 30,000 at most, so that the
    sketch's error stays far below what it looks for.
    """
    if not 1 <= one_in <= 30_000:
        raise ValueError("one_in must be between 1 and 30,000")
    known = rows.select(F.col(f"`{column}`").alias("_value")).filter("_value is not null")
    found = F.expr(f"approx_top_k(_hash, {2 * one_in}, {_counters(2 * COUNTERS * one_in)})")
    hashed = known.withColumn("_hash", F.xxhash64("_value"))
    sketch = hashed.agg(found.alias("_found"), F.count("*").alias("_all"))
    candidates = sketch.select("_all", F.inline("_found")).select("_all", F.col("item").alias("_hash"))
    counted = hashed.join(F.broadcast(candidates), "_hash").groupBy("_value", "_all")
    return (
        counted.agg(F.count("*").alias("rows"))
        .filter(F.col("rows") * one_in > F.col("_all"))
        .select(F.col("_value").alias(column), "rows")
    )
