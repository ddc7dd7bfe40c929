"""Calendar and matrix measures of the reporting model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ratios import fraction
from ..schemas import TOTAL, Star
from .analysis import product_totals
from .views import order_lines, order_month


def sliced(
    star: Star,
    regions: Collection[str] | None = None,
    categories: Collection[str] | None = None,
    dates: tuple[dt.date, dt.date] | None = None,
) -> Star:
    """Star narrowed to the chosen regions, categories and order dates (ends included).

    Applies to every report. A slicer without a choice filters nothing.
    """
    lines = star.lines
    if dates is not None:
        lines = lines.filter(F.col("order_date").between(F.lit(dates[0]), F.lit(dates[1])))
    for key, dimension, column, chosen in (
        ("location_id", star.locations, "region", regions),
        ("product_id", star.products, "category", categories),
    ):
        if chosen is not None:
            kept = dimension.filter(F.col(column).isin(list(chosen))).select(key)
            lines = lines.join(kept, key, "left_semi")
    return replace(star, lines=lines)


def totals(star: Star) -> DataFrame:
    """Total sales, total profit and their ratio (blank without sales)."""
    sums = order_lines(star, "sales", "profit").agg(
        F.sum("sales").alias("total_sales"), F.sum("profit").alias("total_profit")
    )
    ratio = fraction(F.col("total_profit"), F.col("total_sales"))
    return sums.withColumn("profit_margin", ratio)


def sales_ytd(star: Star) -> DataFrame:
    """Sales per order date and their running total since the start of the year."""
    daily = (
        order_lines(star, "order_date", "sales")
        .groupBy("order_date")
        .agg(F.sum("sales").alias("total_sales"))
    )
    year_to_date = (
        Window.partitionBy(F.year("order_date"))
        .orderBy("order_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn(
        "sales_ytd", F.sum("total_sales").over(year_to_date).cast(TOTAL)
    ).orderBy("order_date")


def calendar(star: Star) -> DataFrame:
    """Every day of every year touched by an order or ship date."""
    span = order_lines(star, "order_date", "ship_date").agg(
        F.year(F.least(F.min("order_date"), F.min("ship_date"))).alias("_first"),
        F.year(F.greatest(F.max("order_date"), F.max("ship_date"))).alias("_last"),
    )
    days = F.sequence(
        F.make_date("_first", F.lit(1), F.lit(1)), F.make_date("_last", F.lit(12), F.lit(31))
    )
    return span.select(F.explode(days).alias("calendar_date"))


def sales_ytd_calendar(star: Star) -> DataFrame:
    """Every day of the calendar with its sales and those since the start of its year.

    A day without sales repeats the running total; before a year's first sale both are NULL.
    """
    days = calendar(star).join(
        sales_ytd(star).select("order_date", "total_sales"),
        F.col("calendar_date") == F.col("order_date"),
        "left",
    )
    so_far = (
        Window.partitionBy(F.year("calendar_date"))
        .orderBy("calendar_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = F.sum("total_sales").over(so_far).cast(TOTAL).alias("sales_ytd")
    return days.select("calendar_date", "total_sales", running).orderBy("calendar_date")


def mom_calendar(star: Star) -> DataFrame:
    """Sales per calendar month against the calendar month before.

    A month without sales shows up, as a fall of 100 %, only right after a month
    with sales and within the calendar; a month after a gap has no growth.
    Lines are read once; the windows run over one row per month.
    """
    monthly = (
        order_lines(star, "order_date", "ship_date", "sales")
        .groupBy(F.trunc("order_date", "month").alias("_month"))
        .agg(
            F.sum("sales").alias("_sales"),
            F.greatest(F.max("order_date"), F.max("ship_date")).alias("_latest"),
        )
    )
    following = F.add_months("_month", 1)
    in_order = Window.orderBy("_month")
    last_year = F.year(F.max("_latest").over(Window.partitionBy()))
    gap_follows = ~F.lead("_month").over(in_order).eqNullSafe(following)
    in_calendar = F.year(following) <= last_year
    adjacent = F.lag("_month").over(in_order) == F.add_months("_month", -1)
    rows = monthly.select(
        F.filter(
            F.array(
                F.struct(
                    F.col("_month").alias("month"),
                    F.col("_sales").alias("total_sales"),
                    F.when(adjacent, F.lag("_sales").over(in_order)).alias("prev_month_sales"),
                    F.lit(True).alias("shown"),
                ),
                F.struct(
                    following.alias("month"),
                    F.lit(None).cast(TOTAL).alias("total_sales"),
                    F.col("_sales").alias("prev_month_sales"),
                    (gap_follows & in_calendar).alias("shown"),
                ),
            ),
            lambda row: row["shown"],
        ).alias("_rows")
    ).select(F.inline("_rows"))
    before = F.col("prev_month_sales")
    now = F.coalesce("total_sales", F.lit(0).cast(TOTAL))
    return rows.select(
        F.date_format("month", "yyyy-MM").alias("order_month"),
        "total_sales",
        "prev_month_sales",
        fraction(now - before, before).alias("mom_growth"),
    ).orderBy("order_month")


def running_sales_global(star: Star) -> DataFrame:
    """Sales per month and their running total; the window runs over one row per month."""
    monthly = (
        order_lines(star, "order_date", "sales")
        .groupBy(order_month())
        .agg(F.sum("sales").alias("monthly_sales"))
    )
    so_far = Window.orderBy("order_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return monthly.withColumn(
        "running_sales", F.sum("monthly_sales").over(so_far).cast(TOTAL)
    ).orderBy("order_month")


def top_products_in_category(
    star: Star, n: int = 10, categories: Sequence[str] | None = None
) -> DataFrame:
    """The n best-selling products of each (chosen) category."""
    best = Window.partitionBy("category").orderBy(F.desc_nulls_last("total_sales"), "product_id")
    products = product_totals(star)
    if categories is not None:
        products = products.filter(F.col("category").isin(list(categories)))
    return (
        products.withColumn("position", F.row_number().over(best))
        .filter(F.col("position") <= n)
        .select("category", "position", "product_id", "product_name", "total_sales")
        .orderBy("category", "position")
    )


def sales_by_state(star: Star) -> DataFrame:
    """Sales per state."""
    return (
        order_lines(star, "state", "sales")
        .groupBy("state")
        .agg(F.sum("sales").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "state")
    )


# Regions that become columns of the matrix without being named by the caller.
MOST_REGIONS = 100


def _all_regions(star: Star) -> list[str]:
    """Regions of the location dimension, if they are few enough to be columns."""
    found = star.locations.filter("region is not null").select("region").distinct()
    names = sorted(r["region"] for r in found.limit(MOST_REGIONS + 1).collect())
    if len(names) > MOST_REGIONS:
        raise ValueError(f"over {MOST_REGIONS} regions: name those to show")
    return names


def region_subcategory_matrix(star: Star, regions: Sequence[str] | None = None) -> DataFrame:
    """Profit per sub-category, one column per chosen region and ``other_regions`` for the rest.

    Without a choice every region has a column, up to 100 of them, and only lines
    without a region are left for the last one. Names must differ in more than case.
    """
    chosen = list(_all_regions(star) if regions is None else regions)
    names = [r.lower() for r in chosen]
    if len({*names, "sub_category", "other_regions"}) < len(names) + 2:
        raise ValueError(f"{chosen} can't name the columns of one table")
    region = F.col("region")
    sums = [F.sum(F.when(region == r, F.col("profit"))).alias(r) for r in chosen]
    rest = region.isNull() | ~region.isin(chosen)
    return (
        order_lines(star, "sub_category", "region", "profit")
        .groupBy("sub_category")
        .agg(*sums, F.sum(F.when(rest, F.col("profit"))).alias("other_regions"))
        .orderBy("sub_category")
    )
