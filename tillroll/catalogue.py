"""All named queries over a folder of order-processing tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.parse import parsed_date
from .operators import append, cleaning, quality, skew, star
from .plans import analysis, cube, dashboard, measures, report, summary, views
from .schemas import DATE_FORMATS, LOCATION_COLUMNS, Star
from .sources import tables
from .sources.mapped import mapped_star, raw_export
from .sources.scratch import checkpoint_folder, written

Query = Callable[[SparkSession, str], DataFrame]


def _over_star(plan: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: plan(mapped_star(spark, folder))


def _over_dashboard(plan: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """Plan over the unfiltered selection, joining only what the plan and the filters need."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        base = views.dashboard_base(
            mapped_star(spark, folder), *dict.fromkeys([*columns, "region", "category", "order_date"])
        )
        return plan(dashboard.filtered_lines(base))

    return run


def _over_export(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(raw_export(spark, folder))


def _cleaned_star(raw: DataFrame) -> Star:
    return star.build_star(cleaning.clean(raw))


def _numbers(raw: DataFrame) -> DataFrame:
    return raw.transform(cleaning.standard_names).transform(cleaning.parse_numbers)


def _null_tokens(raw: DataFrame) -> DataFrame:
    text = raw.transform(cleaning.standard_names).transform(cleaning.null_tokens)
    return text.select("order_id", "segment", "city", "postal_code", "product_id")


def _trim(raw: DataFrame) -> DataFrame:
    trimmed = raw.transform(cleaning.standard_names).transform(cleaning.trim_text)
    return trimmed.select("customer_name", "segment", "product_id")


def _parse_dates(raw: DataFrame) -> DataFrame:
    dated = raw.transform(cleaning.standard_names).transform(cleaning.parse_dates)
    return dated.select("order_id", "order_date", "ship_date", "product_id")


def _parse_numbers(raw: DataFrame) -> DataFrame:
    return _numbers(raw).select(
        "order_id", "product_id", "quantity", "discount", "list_price", "cost_price"
    )


def _scaled(raw: DataFrame) -> DataFrame:
    """Numbers with scaled discounts; written once, as the scale is the maximum of a column."""
    return cleaning.normalise_discount(written(_parse_numbers(raw), "parsed-numbers"))


def _discount_scale(raw: DataFrame) -> DataFrame:
    return _scaled(raw).select("order_id", "product_id", "quantity", "discount")


def _derived(raw: DataFrame) -> DataFrame:
    return _scaled(raw).transform(cleaning.derive_sales).transform(cleaning.derive_profit)


def _derive_sales(raw: DataFrame) -> DataFrame:
    return _derived(raw).select("order_id", "product_id", "quantity", "discount", "sales")


def _derive_profit(raw: DataFrame) -> DataFrame:
    return _derived(raw).select("order_id", "product_id", "quantity", "sales", "profit")


_LINE = ["order_id", "order_date", "product_id", "sales", "quantity", "discount", "profit"]


def _drop_duplicates(raw: DataFrame) -> DataFrame:
    return cleaning.parsed(raw).transform(cleaning.drop_duplicates).select(*_LINE)


def _drop_incomplete(raw: DataFrame) -> DataFrame:
    lines = cleaning.parsed(raw).transform(cleaning.drop_duplicates)
    return lines.transform(cleaning.drop_incomplete).select(*_LINE)


def _customer_key(raw: DataFrame) -> DataFrame:
    lines = cleaning.clean(raw.drop("Customer ID"))
    return lines.select("order_line_id", "customer_name", "customer_id")


def _customer_key_spread(raw: DataFrame) -> DataFrame:
    """Customer keys where frequent names are joined in pieces."""
    lines = cleaning.finished(cleaning.distinct_lines(raw.drop("Customer ID")), spread=True)
    return lines.select("order_line_id", "customer_name", "customer_id")


def _enriched_spread(raw: DataFrame) -> DataFrame:
    """The enriched view where busy places, customers and products are joined in pieces."""
    return views.enriched(star.build_star(cleaning.clean(raw), spread=True), spread=True, stored=True)


def _order_line_id(raw: DataFrame) -> DataFrame:
    return cleaning.clean(raw).select("order_line_id", *_LINE)


def _range_check(raw: DataFrame) -> DataFrame:
    return quality.range_check(_derived(raw))


def _with_location_text(raw: DataFrame) -> DataFrame:
    """Fact lines with the text of their location, to see that missing parts matched."""
    built = _cleaned_star(raw)
    return built.lines.join(built.locations, "location_id").select(
        "order_line_id", "location_id", *LOCATION_COLUMNS
    )


def _with_defects(built: Star) -> Star:
    """The star with orphans, repeated and missing keys, gaps and long texts in fixed places."""
    line = F.col("order_line_id")
    customer, product = F.col("customer_id").cast("bigint"), F.col("product_id").cast("bigint")
    long_name = F.when(customer % 5 == 0, F.rpad("customer_name", 130, "*"))
    long_mode = F.when(line % 19 == 0, F.rpad("ship_mode", 45, "*"))
    lines = built.lines.withColumns(
        {
            "order_id": F.when(line % 31 != 0, F.col("order_id")),
            "ship_mode": F.coalesce(long_mode, "ship_mode"),
            "location_id": F.when(line % 50 != 0, F.col("location_id")),
            "sales": F.when(line % 29 != 0, F.col("sales")),
            "order_line_id": F.when(line % 211 != 0, F.when(line % 97 == 0, line - 1).otherwise(line)),
        }
    )
    return Star(
        customers=built.customers.filter(customer % 7 != 0).withColumn(
            "customer_name", F.coalesce(long_name, "customer_name")
        ),
        products=built.products.unionByName(built.products.filter(product % 13 == 0)),
        locations=built.locations,
        lines=lines,
    )


def _over_defects(check: Callable[[Star], DataFrame]) -> Query:
    return _over_export(lambda raw: check(_with_defects(_cleaned_star(raw))))


def _planted_ranges(raw: DataFrame) -> DataFrame:
    large = F.when(F.col("product_id").cast("bigint") % 41 == 0, F.col("quantity") * 1e9)
    lines = _scaled(raw).withColumn("quantity", F.coalesce(large, "quantity"))
    lines = lines.transform(cleaning.derive_sales).transform(cleaning.derive_profit)
    return quality.range_check(lines)


def _two_batches(raw: DataFrame) -> tuple[Star, Star]:
    """The export cleaned in two batches by order date.

    The filter is pushed below the joins of the export. There the text of the cell would be made anew
    for each of its many uses in the parser; as an element of an array it is made once.
    """
    def before(cell: Column) -> Column:
        return parsed_date(cell, DATE_FORMATS) < F.lit(dt.date(1995, 6, 1))

    early = F.exists(F.array("Order Date"), before)
    first = star.build_star(cleaning.clean(raw.filter(early), scale="percent"))
    late = raw.filter(~F.coalesce(early, F.lit(False)))
    return first, star.build_star(cleaning.clean(late, scale="percent"))


def _appended(raw: DataFrame, made_customers: bool = False) -> Star:
    """The second batch appended to the first."""
    first, batch = _two_batches(raw)
    return append.extended(first, append.continued(first, batch, made_customers))


def _located(whole: Star) -> DataFrame:
    return whole.lines.join(whole.locations, "location_id").select(
        "order_line_id", "order_id", "customer_id", "product_id", "sales", *LOCATION_COLUMNS
    )


def _appended_fact(raw: DataFrame) -> DataFrame:
    return _located(_appended(raw))


def _appended_twice(raw: DataFrame) -> DataFrame:
    """Both batches stored, the second one twice under its name."""
    spark = raw.sparkSession
    folder = f"{checkpoint_folder(spark).rstrip('/')}/star-{uuid.uuid4().hex}"
    first, batch = _two_batches(raw)
    tables.write_star(first, folder)
    for _ in range(2):
        tables.write_star(batch, folder, mode="append", batch="second")
    return _located(tables.read_star(spark, folder))


def _appended_order_customers(raw: DataFrame) -> DataFrame:
    """Customers made from orders, as the export names none."""
    whole = _appended(raw.drop("Customer ID", "Customer Name"), made_customers=True)
    return whole.lines.select("order_id", "customer_id").distinct()


def _merged_summary(raw: DataFrame) -> DataFrame:
    """The monthly summary as the sum of what each of two batches holds; exact columns."""
    first, batch = _two_batches(raw)
    addition = append.continued(first, batch)
    parts = [summary.partial_summary(first), summary.added_summary(first, addition)]
    whole = summary.merged(*(written(part, "partial-summary") for part in parts))
    return summary.shown(whole).drop("approx_orders")


def _rejects(raw: DataFrame) -> DataFrame:
    """Rows that cleaning leaves out, by reason."""
    left_out = cleaning.rejected(cleaning.distinct_lines(raw))
    return left_out.groupBy("reason", "detail").agg(F.sum("rows").alias("rows"))


# A reader's choice on the report page.
EXAMPLE_SLICERS = {
    "regions": ["ASIA", "EUROPE"],
    "categories": ["ECONOMY", "STANDARD"],
    "dates": (dt.date(1996, 1, 1), dt.date(1998, 12, 31)),
}


def _cube_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cube.cells(views.dashboard_base(mapped_star(spark, folder), *cube.NEEDED))


def _cube_visuals(spark: SparkSession, folder: str) -> DataFrame:
    """All visuals of a reader's choice, among the better half of the customers."""
    chosen = dashboard.filtered_lines(_cube_cells(spark, folder), **EXAMPLE_SLICERS)
    return cube.visuals(cube.of_deciles(chosen, range(1, 6)))


QUERIES: dict[str, Query] = {
    # cleaning
    "clean_null_tokens": _over_export(_null_tokens),
    "clean_trim": _over_export(_trim),
    "clean_parse_dates": _over_export(_parse_dates),
    "clean_parse_numbers": _over_export(_parse_numbers),
    "clean_discount_scale": _over_export(_discount_scale),
    "clean_derive_sales": _over_export(_derive_sales),
    "clean_derive_profit": _over_export(_derive_profit),
    "clean_drop_duplicates": _over_export(_drop_duplicates),
    "clean_drop_incomplete": _over_export(_drop_incomplete),
    "clean_customer_key": _over_export(_customer_key),
    "clean_customer_key_spread": _over_export(_customer_key_spread),
    "clean_order_line_id": _over_export(_order_line_id),
    "clean_audit": _over_export(cleaning.cleaning_audit),
    "clean_rejects": _over_export(_rejects),
    # star
    "dim_customer": _over_export(lambda raw: star.customer_dimension(cleaning.clean(raw))),
    "dim_product": _over_export(lambda raw: star.product_dimension(cleaning.clean(raw))),
    "dim_location": _over_export(lambda raw: star.location_dimension(cleaning.clean(raw))),
    "fact_order_lines": _over_export(lambda raw: _cleaned_star(raw).lines),
    "fact_location_match": _over_export(_with_location_text),
    "check_primary_keys": _over_export(lambda raw: quality.primary_key_check(_cleaned_star(raw))),
    "check_foreign_keys": _over_export(lambda raw: quality.foreign_key_check(_cleaned_star(raw))),
    "check_not_null": _over_export(lambda raw: quality.not_null_check(_cleaned_star(raw))),
    "check_widths": _over_export(lambda raw: quality.width_check(_cleaned_star(raw))),
    "check_ranges": _over_export(_range_check),
    "check_primary_keys_planted": _over_defects(quality.primary_key_check),
    "check_foreign_keys_planted": _over_defects(quality.foreign_key_check),
    "check_not_null_planted": _over_defects(quality.not_null_check),
    "check_widths_planted": _over_defects(quality.width_check),
    "check_ranges_planted": _over_export(_planted_ranges),
    # append
    "appended_fact": _over_export(_appended_fact),
    "appended_twice": _over_export(_appended_twice),
    "appended_order_customers": _over_export(_appended_order_customers),
    "appended_customers": _over_export(lambda raw: _appended(raw).customers),
    "appended_products": _over_export(lambda raw: _appended(raw).products),
    "appended_locations": _over_export(
        lambda raw: _appended(raw).locations.select(*LOCATION_COLUMNS)
    ),
    "appended_top_regions": _over_export(lambda raw: report.top_regions(_appended(raw))),
    # views
    "order_lines_enriched": _over_export(
        lambda raw: views.enriched(_cleaned_star(raw), stored=True)
    ),
    "order_lines_enriched_spread": _over_export(_enriched_spread),
    "monthly_sales_summary": _over_star(views.monthly_summary),
    "monthly_summary_merged": _over_export(_merged_summary),
    # analysis
    "regional_running_sales": _over_star(analysis.regional_running_sales),
    "top_products_by_category": _over_star(analysis.top_products_by_category),
    "mom_growth": _over_star(analysis.mom_growth),
    "discount_margin": _over_star(analysis.discount_margin),
    "customer_deciles": _over_star(analysis.customer_deciles),
    "loss_making_subcategories": _over_star(analysis.loss_making_subcategories),
    # report
    "scale_counts": _over_star(report.scale_counts),
    "date_span": _over_star(report.date_span),
    "discount_bands": _over_star(report.discount_bands),
    "margin_gap": _over_star(report.margin_gap),
    "busy_locations": _over_star(
        lambda built: skew.frequent_values(built.lines, "location_id", 25)
    ),
    "top_regions": _over_star(report.top_regions),
    "top_losses": _over_star(report.top_losses),
    "top_decile_share": _over_star(report.top_decile_share),
    # dashboard
    "dashboard_base": _over_export(
        lambda raw: views.dashboard_base(_cleaned_star(raw), stored=True)
    ),
    "filter_options": _over_star(dashboard.filter_options),
    "filtered_lines": _over_dashboard(lambda lines: lines, "order_id", "product_id", "sales"),
    "dashboard_kpis": _over_dashboard(dashboard.kpis, "order_id", "sales", "profit"),
    "monthly_sales_dense": _over_dashboard(dashboard.monthly_sales_dense, "sales"),
    "sales_by_region": _over_dashboard(dashboard.sales_by_region, "sales"),
    "top_products_by_name": _over_dashboard(
        dashboard.top_products_by_name, "product_name", "sales"
    ),
    "discount_margin_dashboard": _over_dashboard(
        dashboard.discount_margin, "discount", "sales", "profit"
    ),
    "customer_concentration": _over_dashboard(
        dashboard.customer_concentration, "customer_id", "sales"
    ),
    "cube_cells": _cube_cells,
    "cube_visuals": _cube_visuals,
    # measures
    "measure_totals": _over_star(measures.totals),
    "measure_totals_sliced": _over_star(
        lambda built: measures.totals(measures.sliced(built, **EXAMPLE_SLICERS))
    ),
    "sales_ytd": _over_star(measures.sales_ytd),
    "sales_ytd_calendar": _over_star(measures.sales_ytd_calendar),
    "calendar": _over_star(measures.calendar),
    "mom_calendar": _over_star(measures.mom_calendar),
    "running_sales_global": _over_star(measures.running_sales_global),
    "top_products_in_category": _over_star(measures.top_products_in_category),
    "sales_by_state": _over_star(measures.sales_by_state),
    "region_subcategory_matrix": _over_star(
        lambda built: measures.region_subcategory_matrix(built)
    ),
    "region_subcategory_matrix_chosen": _over_star(
        lambda built: measures.region_subcategory_matrix(built, ["ASIA"])
    ),
}
