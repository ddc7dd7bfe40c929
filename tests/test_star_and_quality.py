"""Star build, integrity checks, and the two kinds of star join."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import quality
from tillroll.operators.cleaning import clean
from tillroll.operators.star import build_star
from tillroll.plans import analysis, dashboard, report, views
from tillroll.schemas import DIM_CUSTOMER, DIM_LOCATION, DIM_PRODUCT, FACT_ORDER_LINES, Star
from tillroll.sources.mapped import raw_export

DAY = dt.date(2024, 1, 1)


def line(number, customer="c1", product="p1", location=1, sales="10", day=DAY, **more):
    values = {
        "order_line_id": number, "order_id": f"o{number}", "order_date": day, "ship_date": None,
        "ship_mode": None, "customer_id": customer, "product_id": product,
        "location_id": location, "sales": Decimal(sales), "quantity": 1,
        "discount": Decimal("0.1"), "profit": Decimal("1"), **more,
    }
    return tuple(values[c] for c in FACT_ORDER_LINES.names)


def small_star(spark, lines, customers=None, products=None, locations=None, complete=False):
    customers = customers or [("c1", "Ann", "Home")]
    products = products or [("p1", "Pen", "Office", "Pens"), ("p2", "Cup", "Kitchen", "Cups")]
    locations = locations or [(1, "X", "North", "S", None, None)]

    def loose(schema):
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)

    return Star(
        customers=spark.createDataFrame(customers, loose(DIM_CUSTOMER)),
        products=spark.createDataFrame(products, loose(DIM_PRODUCT)),
        locations=spark.createDataFrame(locations, loose(DIM_LOCATION)),
        lines=spark.createDataFrame(lines, loose(FACT_ORDER_LINES)),
        complete=complete,
    )


@pytest.fixture(scope="module")
def built(spark, folder):
    return build_star(clean(raw_export(spark, folder)))


def test_every_line_finds_its_location(built):
    assert built.lines.filter("location_id is null").isEmpty()
    without_city = built.locations.filter("city is null or postal_code is null")
    assert not built.lines.join(without_city, "location_id").isEmpty()


def test_dimension_keys_are_unique_and_dense(built):
    ids = sorted(r[0] for r in built.locations.select("location_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    assert quality.primary_key_check(built).filter("repeated_keys + null_rows > 0").isEmpty()
    quality.typed_check(built.tables())


def test_build_and_reports_need_no_python_workers(built):
    for df in [built.lines, built.customers, built.locations, views.enriched(built)]:
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_reports_of_the_built_star(built):
    lines, sales = built.lines.agg(F.count("*"), F.sum("sales")).first()
    deciles = analysis.customer_deciles(built).collect()
    assert sum(r["decile_sales"] for r in deciles) == sales
    assert max(r["customers"] for r in deciles) - min(r["customers"] for r in deciles) <= 1
    bands = analysis.discount_margin(built).agg(F.sum("order_lines")).first()[0]
    assert bands == built.lines.filter("discount is not null").count() < lines
    assert report.scale_counts(built).first()["order_lines"] == lines
    shares = dashboard.customer_concentration(views.dashboard_base(built))
    assert shares.agg(F.max("cumulative_share")).first()[0] == 1.0


def test_two_lines_in_a_place_without_city_share_a_location(spark):
    header = ["Order ID", "Order Date", "Product ID", "Sales", "Quantity", "State", "City"]
    rows = [
        ["o1", "1/1/2024", "p", "1", "1", "Ohio", None],
        ["o2", "1/1/2024", "p", "1", "1", "Ohio", "N/A"],
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))
    star = build_star(clean(raw))
    assert [tuple(r) for r in star.locations.collect()] == [(1, None, None, "Ohio", None, None)]
    assert [r["location_id"] for r in star.lines.collect()] == [1, 1]


def test_first_line_decides_the_attributes(spark):
    header = ["Order ID", "Order Date", "Product ID", "Sales", "Quantity", "Product Name"]
    rows = [
        ["o1", "2/1/2024", "p", "1", "1", "later"],
        ["o2", "1/1/2024", "p", "1", "1", "earlier"],
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))
    assert build_star(clean(raw)).products.first()["product_name"] == "earlier"


def test_checks_report_what_a_database_would_reject(spark):
    star = small_star(
        spark,
        [line(1), line(1), line(2, product="p9"), line(3, customer=None), line(None, sales="5")],
        customers=[("c1", "x" * 121, "Home")],
    )
    keys = {r[0]: tuple(r)[1:] for r in quality.primary_key_check(star).collect()}
    assert keys["fact_order_lines"] == (1, 2, 1)
    assert keys["dim_product"] == (0, 0, 0)
    references = {r[0]: tuple(r)[1:] for r in quality.foreign_key_check(star).collect()}
    assert references == {
        "customer_id": (0, 0, 1),
        "product_id": (1, 1, 0),
        "location_id": (0, 0, 0),
    }
    nulls = {r[0]: r[1] for r in quality.not_null_check(star).collect()}
    assert nulls["order_line_id"] == 1 and nulls["sales"] == 0
    widths = {r[0]: r[1] for r in quality.width_check(star).collect()}
    assert widths["dim_customer.customer_name"] == 1 and sum(widths.values()) == 1


def test_wrong_types_raise(spark):
    star = small_star(spark, [line(1)])
    tables = {**star.tables(), "dim_customer": star.customers.withColumn("segment", F.lit(1))}
    with pytest.raises(ValueError, match="dim_customer"):
        quality.typed_check(tables)


def test_inner_view_drops_and_dashboard_keeps_a_line_without_product(spark):
    star = small_star(spark, [line(1), line(2, product="p9")])
    assert [r["order_line_id"] for r in views.enriched(star).collect()] == [1]
    kept = views.dashboard_base(star).orderBy("order_line_id").collect()
    assert [(r["order_line_id"], r["product_name"]) for r in kept] == [(1, "Pen"), (2, None)]
    assert dashboard.filtered_lines(views.dashboard_base(star)).count() == 1


def test_lines_without_customer_find_the_customer_without_key(spark):
    star = small_star(spark, [line(1, customer=None)], customers=[(None, "Guest", None)])
    assert views.enriched(star).isEmpty()
    assert views.dashboard_base(star).first()["customer_name"] == "Guest"


def test_reports_on_one_dimension_still_require_the_others(spark):
    lines = [line(1), line(2, product="p9"), line(3, customer="c9"), line(4, location=None)]
    star = small_star(spark, lines)
    [region] = report.top_regions(star).collect()
    assert region["total_sales"] == 10
    [product] = analysis.top_products_by_category(star).collect()
    assert product["units_sold"] == 1


def test_a_complete_star_skips_joins_that_show_nothing(spark):
    def joins(star):
        plan = analysis.discount_margin(star)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join ")

    assert joins(small_star(spark, [line(1)])) == 3
    assert joins(small_star(spark, [line(1)], complete=True)) == 0


def test_ties_share_a_rank(spark):
    products = [(f"p{i}", f"n{i}", "Office", "x") for i in range(8)]
    lines = [line(i, product=f"p{i}", sales=str(100 - 10 * (i // 2))) for i in range(8)]
    star = small_star(spark, lines, products=products)
    ranks = [r["revenue_rank"] for r in analysis.top_products_by_category(star, 3).collect()]
    assert ranks == [1, 1, 2, 2, 3, 3]


def test_rank_filter_runs_before_the_shuffle(spark):
    plan = analysis.top_products_by_category(small_star(spark, [line(1)]))
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_is_split_in_the_join(spark):
    """A third of the lines on one customer, both sides too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        number = F.col("id")
        hot = F.when(number % 3 == 0, "c0").otherwise(F.concat(F.lit("c"), number % 500))
        lines = small_star(spark, [line(1)]).lines
        many = spark.range(0, 60_000, 1, 6).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) if f.name not in (
                "order_line_id", "customer_id", "order_id") else {
                "order_line_id": number,
                "customer_id": hot,
                "order_id": F.sha2(number.cast("string"), 256),
            }[f.name].alias(f.name) for f in lines.schema)
        )
        customers = spark.range(500).select(
            F.concat(F.lit("c"), "id").alias("customer_id"),
            F.lit("n").alias("customer_name"),
            F.lit("s").alias("segment"),
        )
        star = small_star(spark, [line(1)])
        base = views.dashboard_base(
            Star(customers, star.products, star.locations, many), "order_id", "customer_name"
        )
        rows = base.collect()
        assert len(rows) == 60_000
        assert "skew=true" in base._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
