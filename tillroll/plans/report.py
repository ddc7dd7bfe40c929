"""The sections of the printed report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import HIGH_BANDS, LOW_BANDS, report_band
from ..functions.ratios import percent
from ..schemas import TOTAL, Star
from .analysis import customer_sales, with_spend_decile
from .views import order_lines


def _row_count(table: DataFrame):
    return table.agg(F.count("*")).scalar()


def scale_counts(star: Star) -> DataFrame:
    """Order lines, orders, customers, products and locations, in one row."""
    return star.lines.agg(
        F.count("*").alias("order_lines"), F.count_distinct("order_id").alias("orders")
    ).select(
        "order_lines",
        "orders",
        _row_count(star.customers).alias("customers"),
        _row_count(star.products).alias("products"),
        _row_count(star.locations).alias("locations"),
    )


def date_span(star: Star) -> DataFrame:
    """First and last order date."""
    return star.lines.agg(
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")
    )


def discount_bands(star: Star) -> DataFrame:
    """Lines, money and margin per discount band."""
    return (
        order_lines(star, "discount", "sales", "profit")
        .filter(F.col("discount").isNotNull())
        .groupBy(report_band(F.col("discount")).alias("discount_band"))
        .agg(
            F.count("*").alias("order_lines"),
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            percent(F.sum("profit"), F.sum("sales")).alias("margin_pct"),
        )
        .orderBy("discount_band")
    )


def margin_gap(star: Star) -> DataFrame:
    """Unweighted mean margin of low and of high discount bands, and their gap in points."""

    def mean_margin(bands: list[str]):
        return F.avg(F.when(F.col("discount_band").isin(bands), F.col("margin_pct")))

    return (
        discount_bands(star)
        .agg(mean_margin(LOW_BANDS).alias("low"), mean_margin(HIGH_BANDS).alias("high"))
        .withColumn("difference", F.col("low") - F.col("high"))
    )


def top_regions(star: Star) -> DataFrame:
    """Money and margin per region, best-selling first."""
    return (
        order_lines(star, "region", "sales", "profit")
        .groupBy("region")
        .agg(
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            percent(F.sum("profit"), F.sum("sales")).alias("margin_pct"),
        )
        .orderBy(F.desc("total_sales"), "region")
    )


def top_losses(star: Star, n: int = 10) -> DataFrame:
    """The n region and sub-category pairs that lose most."""
    return (
        order_lines(star, "region", "sub_category", "sales", "profit")
        .groupBy("region", "sub_category")
        .agg(F.sum("sales").alias("total_sales"), F.sum("profit").alias("total_profit"))
        .filter(F.col("total_profit") < 0)
        .orderBy("total_profit", "region", "sub_category")
        .limit(n)
    )


def top_decile_share(star: Star) -> DataFrame:
    """Share of sales that the top tenth of customers brings."""
    spent = F.col("lifetime_sales")
    top = F.when(F.col("spend_decile") == 1, spent).otherwise(F.lit(0).cast(TOTAL))
    share = percent(F.sum(top).cast(TOTAL), F.sum(spent).cast(TOTAL))
    return with_spend_decile(customer_sales(star)).agg(share.alias("top_decile_share_pct"))
