"""Filters, key figures and chart series of the dashboard.

The series take the filtered lines, so that one selection drives all of them; those
that show sums take the cells of ``cube`` just as well.
Groups with a NULL key are left out and a group without any value sums to 0.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import BANDS, dashboard_band
from ..functions.ratios import fraction
from ..operators.ranking import accumulated
from ..schemas import TOTAL, Star


def _nothing() -> Column:
    return F.lit(0).cast(TOTAL)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column).cast(TOTAL), _nothing())


def _chosen(column: str, values: Collection[str] | None) -> Column:
    return F.col(column).isNotNull() if values is None else F.col(column).isin(list(values))


def filtered_lines(
    base: DataFrame,
    regions: Collection[str] | None = None,
    categories: Collection[str] | None = None,
    dates: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Lines of the chosen regions, categories and order dates (both ends included).

    Without a choice every known value counts; lines without the value never do.
    """
    lines = base.filter(_chosen("region", regions) & _chosen("category", categories))
    if dates is None:
        return lines.filter(F.col("order_date").isNotNull())
    first, last = dates
    return lines.filter(F.col("order_date").between(F.lit(first), F.lit(last)))


def filter_options(star: Star) -> DataFrame:
    """Values that occur on lines, per filter (``region``, ``category``).

    One pass shrinks the lines to distinct (filter, key) pairs before the dimensions
    are joined.
    """
    filters = [("region", "location_id", star.locations), ("category", "product_id", star.products)]

    def pair(name: str, key: str) -> list[Column]:
        return [F.lit(name).alias("filter_name"), F.col(key).cast("string").alias("_key")]

    pairs = F.array(*(F.struct(*pair(name, key)) for name, key, _ in filters))
    used = star.lines.select(F.inline(pairs)).distinct()
    regions, categories = (
        table.select(*pair(name, key), F.col(name).alias("value")) for name, key, table in filters
    )
    return (
        used.join(regions.unionByName(categories), ["filter_name", "_key"])
        .filter(F.col("value").isNotNull())
        .select("filter_name", "value")
        .distinct()
        .orderBy("filter_name", "value")
    )


def kpis(lines: DataFrame) -> DataFrame:
    """Total sales, total profit, margin (0 without sales) and order count."""
    orders = F.count_distinct("order_id") if "order_id" in lines.columns else F.count("*")
    totals = lines.agg(
        _total("sales").alias("total_sales"),
        _total("profit").alias("total_profit"),
        orders.alias("orders"),
    )
    margin = fraction(F.col("total_profit"), F.col("total_sales"))
    return totals.withColumn("profit_margin", F.coalesce(margin, F.lit(0.0)))


def monthly_sales_dense(lines: DataFrame) -> DataFrame:
    """Sales per calendar month, months without sales as 0.

    Each month also fills the gap up to the next one, so lines are read once. The
    window runs over one row per month.
    """
    monthly = (
        lines.filter(F.col("order_date").isNotNull())
        .groupBy(F.trunc("order_date", "month").alias("month"))
        .agg(_total("sales").alias("sales"))
    )
    following = F.lead("month").over(Window.orderBy("month"))
    until = F.coalesce(F.add_months(following, -1), F.col("month"))
    months = F.sequence("month", "_until", F.expr("interval 1 month"))
    own_month = F.col("_gap") == 0
    return (
        monthly.withColumn("_until", until)
        .select("sales", F.posexplode(months).alias("_gap", "month"))
        .select("month", F.when(own_month, F.col("sales")).otherwise(_nothing()).alias("sales"))
        .orderBy("month")
    )


def _sales_by(lines: DataFrame, key: str) -> DataFrame:
    return lines.filter(F.col(key).isNotNull()).groupBy(key).agg(_total("sales").alias("sales"))


def sales_by_region(lines: DataFrame) -> DataFrame:
    """Sales per region, largest first."""
    return _sales_by(lines, "region").orderBy(F.desc("sales"), "region")


def top_products_by_name(lines: DataFrame, n: int = 10) -> DataFrame:
    """The n best-selling product names, smallest of them first."""
    best = _sales_by(lines, "product_name").orderBy(F.desc("sales"), "product_name").limit(n)
    return best.orderBy("sales", F.desc("product_name"))


def discount_margin(lines: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Sales, profit and margin in percent per dashboard discount band.

    Bands without sales have no margin and are left out, unless ``keep_empty``
    asks for all five.
    """
    folded = "discount_band" in lines.columns
    band = F.col("discount_band") if folded else dashboard_band(F.col("discount"))
    sums = (
        lines.groupBy(band.alias("discount_band"))
        .agg(_total("sales").alias("sales"), _total("profit").alias("profit"))
        .filter(F.col("discount_band").isNotNull())
    )
    if keep_empty:
        labels = F.explode(F.array(*map(F.lit, BANDS))).alias("discount_band")
        sums = (
            lines.sparkSession.range(1)
            .select(labels)
            .join(sums, "discount_band", "left")
            .select(
                "discount_band",
                F.coalesce("sales", _nothing()).alias("sales"),
                F.coalesce("profit", _nothing()).alias("profit"),
            )
        )
    margin = fraction(F.col("profit"), F.col("sales"))
    shown = sums.withColumn("margin_pct", margin * 100)
    if not keep_empty:
        shown = shown.filter(F.col("margin_pct").isNotNull())
    position = F.array_position(F.array(*map(F.lit, BANDS)), F.col("discount_band"))
    return shown.withColumn("band_order", position.cast("int")).orderBy("band_order")


def customer_concentration(lines: DataFrame) -> DataFrame:
    """Cumulative share of sales over customers, best customer first.

    The id breaks ties. If all sales add up to 0 the sales themselves are given.
    """
    totals = _sales_by(lines, "customer_id")
    order = [F.desc_nulls_last("sales"), F.asc_nulls_last("customer_id")]
    running = accumulated(totals, "sales", "cumulative_sales", "_total", order)
    share = fraction(F.col("cumulative_sales"), F.col("_total"))
    return running.select(
        "customer_id",
        "sales",
        F.coalesce(share, F.col("sales").cast("double")).alias("cumulative_share"),
    )
