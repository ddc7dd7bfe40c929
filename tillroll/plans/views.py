"""The two reusable views and the left-joined dashboard base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import fraction, mean
from ..operators.skew import spread_join
from ..schemas import Star
from ..sources.scratch import written

# Columns of the enriched view, in order.
ENRICHED_COLUMNS = [
    "order_line_id", "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "customer_name", "segment",
    "product_id", "product_name", "category", "sub_category",
    "region", "state", "city",
    "sales", "quantity", "discount", "profit",
]


# Keys of the dimensions that grow with the lines, so that both are shuffled; the few places are not.
_SHUFFLED = ("customer_id", "product_id")


def _between_joins(
    key: str, lines: DataFrame, dimension: DataFrame, joined: bool
) -> tuple[DataFrame, DataFrame]:
    """Both sides of the next join, stored if that frees the disk of a shuffle behind them."""
    if key not in _SHUFFLED:
        return lines, dimension
    return (
        written(lines, "joined-lines") if joined else lines,
        written(dimension, "joined-dimension"),
    )


def order_month() -> Column:
    """Month of the order date as ``yyyy-MM``."""
    return F.date_format("order_date", "yyyy-MM").alias("order_month")


def order_lines(
    star: Star, *columns: str, later: str | None = None, spread: bool = False, stored: bool = False
) -> DataFrame:
    """Inner star join, narrowed to ``columns``.

    A line counts only if customer, product and location exist. A dimension that
    shows no column is reduced to that existence test, and skipped when the star
    is complete. ``later`` names a key whose dimension the caller joins itself
    after aggregating. With ``spread`` lines of a busy key are joined in pieces, which
    costs a pass over each joined key; the star should be a stored one then. With ``stored``
    customers, products and the lines between their joins are written once, which costs tables and
    saves the disk of the shuffles behind them.
    """
    lines = star.lines
    joined = False
    for key, dimension in star.dimensions():
        shown = [c for c in dimension.columns if c in columns and c != key]
        if shown and stored:
            lines, dimension = _between_joins(key, lines, dimension, joined)
            joined = True
        if shown and spread:
            attributes = dimension.select(key, *shown)
            lines = spread_join(lines, attributes, [key], ["order_line_id"], counted=star.lines)
        elif shown:
            lines = lines.join(dimension.select(key, *shown), key)
        elif key != later and not star.complete:
            lines = lines.join(dimension.select(key), key, "left_semi")
    return lines.select(*columns)


def enriched(star: Star, spread: bool = False, stored: bool = False) -> DataFrame:
    """Every order line with the attributes of its dimensions; for the options see ``order_lines``."""
    return order_lines(star, *ENRICHED_COLUMNS, spread=spread, stored=stored)


def monthly_summary(star: Star) -> DataFrame:
    """Orders, units, money and average discount per month, region and category."""
    lines = order_lines(
        star, "order_id", "order_date", "region", "category",
        "sales", "quantity", "discount", "profit",
    )
    return lines.groupBy(order_month(), "region", "category").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum("sales").alias("total_sales"),
        F.sum("profit").alias("total_profit"),
        mean(F.sum("discount"), F.count("discount"), 4).alias("avg_discount"),
    )


def dashboard_base(star: Star, *columns: str, stored: bool = False) -> DataFrame:
    """All lines, left-joined to the dimensions, with the margin of each line.

    Unlike the enriched view this keeps lines that miss a dimension, and lines
    without a key find the dimension row without a key, if there is one. Given
    ``columns``, only those are kept, and dimensions without any of them are not
    joined: a left join on a primary key neither drops nor repeats lines. For ``stored`` see
    ``order_lines``.
    """
    shown = {
        "product_id": [c for c in star.products.columns if c != "product_id"],
        "location_id": [c for c in star.locations.columns if c != "location_id"],
        "customer_id": ["customer_name"],
    }
    lines = star.lines
    joined = False
    kept = columns or [*lines.columns, "margin", *(c for names in shown.values() for c in names)]
    for key, dimension in star.dimensions():
        wanted = [c for c in shown[key] if c in kept]
        if wanted and stored:
            lines, dimension = _between_joins(key, lines, dimension, joined)
            joined = True
        if wanted:
            attributes = dimension.select(F.col(key).alias("_key"), *wanted)
            lines = lines.join(attributes, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    # Made after the joins, so that it does not travel.
    margin = fraction(F.col("profit"), F.col("sales")).alias("margin")
    return lines.select(*(margin if c == "margin" else F.col(c) for c in kept))


def register_views(star: Star) -> None:
    """Temp views for SQL users: the four tables and the two reusable views."""
    for name, table in star.tables().items():
        table.createOrReplaceTempView(name)
    enriched(star).createOrReplaceTempView("vw_order_lines_enriched")
    monthly_summary(star).createOrReplaceTempView("vw_monthly_sales_summary")
