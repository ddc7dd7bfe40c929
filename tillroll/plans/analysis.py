"""The six analysis questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import report_band
from ..functions.ratios import mean, percent
from ..operators.ranking import tiled_by_value
from ..schemas import TOTAL, Star
from .views import order_lines, order_month


def regional_running_sales(star: Star) -> DataFrame:
    """Monthly sales and profit per region with the running total of sales."""
    monthly = (
        order_lines(star, "region", "order_date", "sales", "profit")
        .groupBy("region", order_month())
        .agg(F.sum("sales").alias("monthly_sales"), F.sum("profit").alias("monthly_profit"))
    )
    so_far = (
        Window.partitionBy("region")
        .orderBy(F.asc_nulls_last("order_month"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.select(
        "region",
        "order_month",
        "monthly_sales",
        F.sum("monthly_sales").over(so_far).cast(TOTAL).alias("running_sales"),
        "monthly_profit",
    ).orderBy("region", "order_month")


def product_totals(star: Star) -> DataFrame:
    """Sales, profit and units per product with the product's attributes.

    Lines are summed by product before the dimension is joined, so the join sees
    one row per product however many lines a product has.
    """
    lines = order_lines(star, "product_id", "sales", "profit", "quantity", later="product_id")
    return (
        lines.groupBy("product_id")
        .agg(
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            F.sum("quantity").alias("units_sold"),
        )
        .join(star.products, "product_id")
    )


def top_products_by_category(star: Star, ranks: int = 5) -> DataFrame:
    """Products on the first revenue ranks of their category; ties share a rank."""
    best = Window.partitionBy("category").orderBy(F.desc_nulls_last("total_sales"))
    return (
        product_totals(star)
        .withColumn("revenue_rank", F.dense_rank().over(best))
        .filter(F.col("revenue_rank") <= ranks)
        .select(
            "category", "revenue_rank", "product_name", "total_sales", "total_profit", "units_sold"
        )
        .orderBy("category", "revenue_rank", "product_name")
    )


def mom_growth(star: Star) -> DataFrame:
    """Sales per category and month against the previous month that has sales."""
    previous = Window.partitionBy("category").orderBy(F.asc_nulls_last("order_month"))
    before = F.col("prev_month_sales")
    return (
        order_lines(star, "category", "order_date", "sales")
        .groupBy("category", order_month())
        .agg(F.sum("sales").alias("monthly_sales"))
        .withColumn("prev_month_sales", F.lag("monthly_sales").over(previous))
        .withColumn("mom_growth_pct", percent(F.col("monthly_sales") - before, before))
        .orderBy("category", "order_month")
    )


def discount_margin(star: Star) -> DataFrame:
    """Lines, orders, money and margin per discount band."""
    return (
        order_lines(star, "order_id", "discount", "sales", "profit")
        .filter(F.col("discount").isNotNull())
        .groupBy(report_band(F.col("discount")).alias("discount_band"))
        .agg(
            F.count("*").alias("order_lines"),
            F.count_distinct("order_id").alias("orders"),
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            percent(F.sum("profit"), F.sum("sales")).alias("profit_margin_pct"),
        )
        .orderBy("discount_band")
    )


def customer_sales(star: Star) -> DataFrame:
    """Lifetime sales per customer of lines that join to all dimensions."""
    return (
        order_lines(star, "customer_id", "sales")
        .groupBy("customer_id")
        .agg(F.sum("sales").alias("lifetime_sales"))
    )


def with_spend_decile(totals: DataFrame) -> DataFrame:
    """Tenth of the customers by lifetime sales, 1 highest; the id breaks ties."""
    return tiled_by_value(totals, "spend_decile", 10, "lifetime_sales", ["customer_id"])


def customer_deciles(star: Star) -> DataFrame:
    """Customers, sales, average value and share of sales per spend decile."""
    everyone = Window.partitionBy()
    sales = F.sum("lifetime_sales").cast(TOTAL)
    return (
        with_spend_decile(customer_sales(star))
        .groupBy("spend_decile")
        .agg(
            F.count("*").alias("customers"),
            sales.alias("decile_sales"),
            mean(sales, F.count("lifetime_sales"), 2).alias("avg_customer_value"),
        )
        .withColumn(
            "pct_of_total_sales",
            # Ten rows, so one task for the grand total is enough.
            percent(F.col("decile_sales"), F.sum("decile_sales").over(everyone).cast(TOTAL)),
        )
        .orderBy("spend_decile")
    )


def loss_making_subcategories(star: Star) -> DataFrame:
    """Region and sub-category pairs that lose money, largest loss first."""
    return (
        order_lines(star, "region", "sub_category", "sales", "profit", "discount")
        .groupBy("region", "sub_category")
        .agg(
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            percent(F.sum("profit"), F.sum("sales")).alias("margin_pct"),
            mean(F.sum("discount"), F.count("discount"), 3).alias("avg_discount"),
        )
        .filter(F.col("total_profit") < 0)
        .orderBy("total_profit", "region", "sub_category")
    )
