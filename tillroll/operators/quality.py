"""Integrity checks: what a database would reject at insert, reported instead."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CLEAN_LINE, FACT_ORDER_LINES, PRIMARY_KEYS, TABLES, TEXT_WIDTHS, Star
from .cleaning import typed


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def primary_key_check(star: Star) -> DataFrame:
    """Per table: key values that occur more than once, rows with such keys, rows without key."""

    def check(name: str, table: DataFrame) -> DataFrame:
        key = F.col(PRIMARY_KEYS[name])
        repeated = key.isNotNull() & (F.col("_n") > 1)
        return (
            table.groupBy(key)
            .agg(F.count("*").alias("_n"))
            .agg(
                F.count_if(repeated).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("repeated_rows"),
                F.coalesce(F.sum(F.when(key.isNull(), F.col("_n"))), F.lit(0)).alias("null_rows"),
            )
            .select(F.lit(name).alias("table_name"), "*")
        )

    return _stacked([check(name, table) for name, table in star.tables().items()])


def foreign_key_check(star: Star) -> DataFrame:
    """Per foreign key of the fact: unknown values, lines with them, lines without a value.

    One pass over the fact gives the lines per (key, value), so a hot value meets the
    dimensions as one row.
    """
    keys = [key for key, _ in star.dimensions()]

    def entries(value):
        return F.array(*(F.struct(F.lit(k).alias("foreign_key"), value(k).alias("value")) for k in keys))

    used = (
        star.lines.select(F.inline(entries(lambda k: F.col(k).cast("string"))))
        .groupBy("foreign_key", "value")
        .agg(F.count("*").alias("_lines"))
    )
    # A row without lines per key, so that an empty fact is reported too.
    none = star.lines.sparkSession.range(1).select(
        F.inline(entries(lambda _: F.lit(None).cast("string")))
    )
    used = used.unionByName(none.withColumn("_lines", F.lit(0).cast("bigint")))
    known = _stacked(
        [
            table.select(F.lit(k).alias("foreign_key"), F.col(k).cast("string").alias("value"))
            for k, table in star.dimensions()
        ]
    ).distinct()
    found = used.join(known.withColumn("_known", F.lit(True)), ["foreign_key", "value"], "left")
    orphan = F.col("value").isNotNull() & F.col("_known").isNull()
    missing = F.col("value").isNull()
    return found.groupBy("foreign_key").agg(
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("_lines"))), F.lit(0)).alias("orphan_lines"),
        F.coalesce(F.sum(F.when(missing, F.col("_lines"))), F.lit(0)).alias("null_lines"),
    )


def _one_row_per_count(counts: DataFrame, label: str, value: str) -> DataFrame:
    """Turn one row of named counts into (label, value) rows."""
    entries = F.array(
        *(F.struct(F.lit(c).alias(label), F.col(f"`{c}`").alias(value)) for c in counts.columns)
    )
    return counts.select(F.inline(entries))


def not_null_check(star: Star) -> DataFrame:
    """Per mandatory column of the fact: rows where it is NULL, in one pass."""
    required = [f.name for f in FACT_ORDER_LINES if not f.nullable]
    counts = star.lines.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required))
    return _one_row_per_count(counts, "column_name", "null_rows")


def width_check(star: Star) -> DataFrame:
    """Per text column: rows longer than declared, one pass per table."""

    def check(name: str, table: DataFrame) -> DataFrame:
        widths = TEXT_WIDTHS[name]
        counts = table.agg(
            *(F.count_if(F.length(c) > width).alias(f"{name}.{c}") for c, width in widths.items())
        )
        return _one_row_per_count(counts, "column_name", "too_long_rows")

    return _stacked([check(name, table) for name, table in star.tables().items()])


def range_check(parsed_lines: DataFrame) -> DataFrame:
    """Per number column of parsed, not yet typed lines: values outside the declared type."""
    present = {f.name: f.dataType for f in CLEAN_LINE if f.name in parsed_lines.columns}
    numbers = {c: t for c, t in present.items() if t.typeName() in ("decimal", "integer")}
    counts = parsed_lines.agg(
        *(
            F.count_if(F.col(c).isNotNull() & typed(F.col(c), t).isNull()).alias(c)
            for c, t in numbers.items()
        )
    )
    return _one_row_per_count(counts, "column_name", "out_of_range_rows")


def typed_check(tables: dict[str, DataFrame]) -> None:
    """Raise unless every table carries exactly the declared column names and types."""
    for name, schema in TABLES.items():
        found = [(f.name, f.dataType) for f in tables[name].schema]
        declared = [(f.name, f.dataType) for f in schema]
        if found != declared:
            raise ValueError(f"{name} has {found}, declared is {declared}")
