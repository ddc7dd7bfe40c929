"""The monthly summary kept as sums that batches can be added to."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import mean
from ..operators.append import extended
from ..schemas import TOTAL, Star
from .views import order_lines, order_month

KEYS = ["order_month", "region", "category"]
# The sketch of 2^14 registers counts orders with a standard error of about 0.7 %.
SKETCH_BITS = 14


def partial_summary(star: Star) -> DataFrame:
    """Per month, region and category what two batches can add up: sums, counts, a sketch of orders."""
    lines = order_lines(
        star, "order_id", "order_date", "region", "category",
        "sales", "quantity", "discount", "profit",
    )
    return lines.groupBy(order_month(), "region", "category").agg(
        F.hll_sketch_agg("order_id", SKETCH_BITS).alias("orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum("sales").cast(TOTAL).alias("total_sales"),
        F.sum("profit").cast(TOTAL).alias("total_profit"),
        F.sum("discount").cast("decimal(22,4)").alias("discounts"),
        F.count("discount").alias("discounted"),
    )


def added_summary(stored: Star, addition: Star) -> DataFrame:
    """Partial summary of what ``continued`` gave: only its lines are read, with all dimensions."""
    return partial_summary(replace(extended(stored, addition), lines=addition.lines, complete=False))


def merged(*partials: DataFrame) -> DataFrame:
    """One partial summary for several. One row per key and partial is grouped, no line is read."""
    return (
        reduce(DataFrame.unionByName, partials)
        .groupBy(*KEYS)
        .agg(
            F.hll_union_agg("orders").alias("orders"),
            F.sum("units_sold").alias("units_sold"),
            F.sum("total_sales").cast(TOTAL).alias("total_sales"),
            F.sum("total_profit").cast(TOTAL).alias("total_profit"),
            F.sum("discounts").cast("decimal(22,4)").alias("discounts"),
            F.sum("discounted").alias("discounted"),
        )
    )


def shown(partial: DataFrame) -> DataFrame:
    """The monthly summary of a partial one. All columns are exact but ``approx_orders``.

    Distinct orders can't be added up: an order may have lines in several batches. Use
    ``views.monthly_summary`` where their exact number matters.
    """
    return partial.select(
        *KEYS,
        F.hll_sketch_estimate("orders").alias("approx_orders"),
        "units_sold",
        "total_sales",
        "total_profit",
        mean(F.col("discounts"), F.col("discounted"), 4).alias("avg_discount"),
    )
