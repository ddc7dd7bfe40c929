"""One small base from which all dashboard visuals and slicers answer."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import dashboard_band
from ..functions.ratios import fraction
from ..schemas import TOTAL
from ..sources.scratch import written
from .analysis import with_spend_decile

# What one cell holds still; days, so that any choice of dates can be answered.
CELL = ["order_date", "region", "category", "discount_band", "spend_decile"]
# Columns of the dashboard base that cells are made of.
NEEDED = ["customer_id", "order_date", "region", "category", "discount", "sales", "profit"]


def cells(base: DataFrame) -> DataFrame:
    """Lines of the dashboard base folded to one row per ``CELL``: sales, profit, order_lines.

    Sums of cells are sums of lines, so the dashboard's filters and series take cells for lines:
    sales per month and region, and margins per band. Their number depends on days and
    attribute values, not on lines. ``spend_decile`` is the customer's tenth by sales over
    all of ``base``, whatever is chosen later, NULL without customer; NULLs are values of their own.

    Lines are read once and folded per customer before the deciles are joined, so a busy
    customer arrives there as few rows. Writes that table and the cells.
    """
    sums = [F.sum(c).cast(TOTAL).alias(c) for c in ("sales", "profit")]
    keys = [c for c in CELL if c != "spend_decile"]
    banded = base.withColumn("discount_band", dashboard_band(F.col("discount")))
    fine = banded.groupBy("customer_id", *keys).agg(*sums, F.count("*").alias("order_lines"))
    fine = written(fine, "customer-cells")
    totals = (
        fine.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("sales").cast(TOTAL).alias("lifetime_sales"))
    )
    deciles = with_spend_decile(totals).select("customer_id", "spend_decile")
    placed = fine.join(deciles, "customer_id", "left").groupBy(*CELL)
    return written(placed.agg(*sums, F.sum("order_lines").alias("order_lines")), "cells")


def of_deciles(chosen: DataFrame, deciles: Collection[int]) -> DataFrame:
    """Cells of customers in the chosen tenths, 1 highest."""
    return chosen.filter(F.col("spend_decile").isin(list(deciles)))


def visuals(chosen: DataFrame) -> DataFrame:
    """All series over chosen cells in one pass: visual, label, order_lines, sales, profit, margin_pct.

    ``visual`` is month (``yyyy-MM``), region, category, discount_band, spend_decile, or total, whose
    label is NULL. Groups with a NULL key are left out, a group without any value sums to 0, the
    margin is NULL where sales are 0. Without cells there are no rows.
    """
    keys = ["month", "region", "category", "discount_band", "spend_decile"]
    rows = chosen.withColumns(
        {
            "month": F.date_format("order_date", "yyyy-MM"),
            "spend_decile": F.col("spend_decile").cast("string"),
        }
    )
    nothing = F.lit(0).cast(TOTAL)
    visual = F.lit("total")
    for key in keys:
        visual = F.when(F.grouping(key) == 0, key).otherwise(visual)
    grouped = rows.groupingSets([*([key] for key in keys), []], *keys).agg(
        visual.alias("visual"),
        F.sum("order_lines").alias("order_lines"),
        *(F.coalesce(F.sum(c).cast(TOTAL), nothing).alias(c) for c in ("sales", "profit")),
    )
    margin = fraction(F.col("profit"), F.col("sales")) * 100
    label = F.coalesce(*keys)
    shown = (label.isNotNull()) | (F.col("visual") == "total")
    return grouped.filter(shown).select(
        "visual", label.alias("label"), "order_lines", "sales", "profit", margin.alias("margin_pct")
    )
