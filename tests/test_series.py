"""Bands, filters, series and calendar measures on small inputs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.test_star_and_quality import line, small_star
from tillroll.functions.bands import dashboard_band, report_band
from tillroll.functions.ratios import mean, percent
from tillroll.plans import analysis, dashboard, measures, report, views

D = Decimal


def _bands(spark, band, values):
    rows = [(i, None if v is None else D(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, d decimal(5,4)")
    return [r["b"] for r in df.select("n", band(F.col("d")).alias("b")).orderBy("n").collect()]


def test_report_bands(spark):
    values = ["-0.005", "0", "0.10", "0.1001", "0.30", "0.31", "1.5"]
    want = ["1-10%", "0%", "1-10%", "11-20%", "21-30%", "30%+", "30%+"]
    assert _bands(spark, report_band, values) == want


def test_dashboard_bands(spark):
    values = [None, "-0.02", "-0.01", "-0.005", "0", "0.10", "0.31", "1", "1.5"]
    want = ["0%", None, None, "0%", "0%", "1-10%", "30%+", "30%+", None]
    assert _bands(spark, dashboard_band, values) == want


def test_rounding_is_half_away_from_zero_on_exact_values(spark):
    df = spark.createDataFrame(
        [(D("1.45"), D("1000")), (D("-1.45"), D("1000")), (D("1"), D("0"))],
        "p decimal(22,2), w decimal(22,2)",
    )
    got = [r[0] for r in df.select(percent(F.col("p"), F.col("w"))).collect()]
    assert got == [0.15, -0.15, None]
    cut = df.select(mean(F.col("p"), F.lit(1000).cast("bigint"), 3)).first()[0]
    assert cut == 0.001


def _month(month, day=1, year=2024):
    return dt.date(year, month, day)


def test_growth_against_the_previous_month_with_sales(spark):
    star = small_star(
        spark,
        [
            line(1, day=_month(1), sales="100"),
            line(2, day=_month(3), sales="150"),
            line(3, day=_month(4), sales="0"),
            line(4, day=_month(5), sales="7"),
        ],
    )
    got = [(r["order_month"], r["mom_growth_pct"]) for r in analysis.mom_growth(star).collect()]
    assert got == [("2024-01", None), ("2024-03", 50.0), ("2024-04", -100.0), ("2024-05", None)]


def test_growth_against_the_calendar_month_before(spark):
    star = small_star(
        spark,
        [
            line(1, day=_month(1), sales="100"),
            line(2, day=_month(3), sales="150"),
            line(3, day=_month(4), sales="0"),
            line(4, day=_month(5), sales="7"),
        ],
    )
    got = [(r["order_month"], r["mom_growth"]) for r in measures.mom_calendar(star).collect()]
    assert got == [
        ("2024-01", None),
        ("2024-02", -1.0),
        ("2024-03", None),
        ("2024-04", -1.0),
        ("2024-05", None),
        ("2024-06", -1.0),
    ]


def test_calendar_growth_ends_with_the_calendar(spark):
    star = small_star(spark, [line(1, day=_month(12), sales="100")])
    assert [r["order_month"] for r in measures.mom_calendar(star).collect()] == ["2024-12"]


def test_calendar_covers_whole_years_of_both_dates(spark):
    star = small_star(spark, [line(1, day=_month(6), ship_date=_month(1, year=2025))])
    days = measures.calendar(star).agg(F.min("calendar_date"), F.max("calendar_date"), F.count("*"))
    assert days.first() == (dt.date(2024, 1, 1), dt.date(2025, 12, 31), 731)


def test_year_to_date_restarts(spark):
    star = small_star(
        spark, [line(1, day=_month(1)), line(2, day=_month(2)), line(3, day=_month(1, year=2025))]
    )
    assert [r["sales_ytd"] for r in measures.sales_ytd(star).collect()] == [10, 20, 10]


def test_months_without_sales_are_zero(spark):
    base = views.dashboard_base(
        small_star(spark, [line(1, day=_month(1, 31)), line(2, day=_month(3, 31))])
    )
    got = [(r["month"], r["sales"]) for r in dashboard.monthly_sales_dense(base).collect()]
    assert got == [(_month(1), 10), (_month(2), 0), (_month(3), 10)]


def test_filters(spark):
    star = small_star(
        spark,
        [line(1, day=_month(1)), line(2, day=_month(2)), line(3, product="p2", day=_month(3))],
    )
    base = views.dashboard_base(star)

    def ids(**choice):
        return sorted(r[0] for r in dashboard.filtered_lines(base, **choice).select(
            "order_line_id").collect())

    assert ids() == [1, 2, 3]
    assert ids(categories=["Kitchen"]) == [3]
    assert ids(regions=["South"]) == []
    assert ids(dates=(_month(1), _month(2))) == [1, 2]
    options = {tuple(r) for r in dashboard.filter_options(star).collect()}
    assert options == {("region", "North"), ("category", "Office"), ("category", "Kitchen")}


def test_slicers_apply_to_any_report(spark):
    lines = [line(1, day=_month(1)), line(2, product="p2", day=_month(2)), line(3, location=None)]
    star = small_star(spark, lines)
    for choice, want in (
        ({}, 20),
        ({"regions": ["North"]}, 20),
        ({"regions": ["South"]}, None),
        ({"categories": ["Kitchen"]}, 10),
        ({"dates": (_month(2), _month(2))}, 10),
    ):
        assert measures.totals(measures.sliced(star, **choice)).first()["total_sales"] == want


def test_figures_of_nothing(spark):
    empty = dashboard.filtered_lines(
        views.dashboard_base(small_star(spark, [line(1)])), regions=["nowhere"]
    )
    assert dashboard.kpis(empty).first().asDict() == {
        "total_sales": 0,
        "total_profit": 0,
        "orders": 0,
        "profit_margin": 0.0,
    }
    assert dashboard.monthly_sales_dense(empty).isEmpty()
    assert dashboard.customer_concentration(empty).isEmpty()
    bands = dashboard.discount_margin(empty, keep_empty=True).collect()
    assert [(r["discount_band"], r["sales"], r["margin_pct"]) for r in bands] == [
        (b, 0, None) for b in ("0%", "1-10%", "11-20%", "21-30%", "30%+")
    ]
    assert dashboard.discount_margin(empty).isEmpty()


def test_orders_without_order_id_count_lines(spark):
    base = views.dashboard_base(small_star(spark, [line(1), line(2)])).drop("order_id")
    assert dashboard.kpis(base).first()["orders"] == 2


def test_line_margin_of_zero_sales_is_unknown(spark):
    base = views.dashboard_base(small_star(spark, [line(1, sales="0"), line(2, sales="4")]))
    assert [r["margin"] for r in base.orderBy("order_line_id").collect()] == [None, 0.25]


def test_concentration_without_sales_shows_the_sales(spark):
    base = views.dashboard_base(
        small_star(
            spark,
            [line(1, customer="c1", sales="5"), line(2, customer="c2", sales="-5")],
            customers=[("c1", "a", "s"), ("c2", "b", "s")],
        )
    )
    got = {r["customer_id"]: r["cumulative_share"] for r in
           dashboard.customer_concentration(base).collect()}
    assert got == {"c1": 5.0, "c2": -5.0}


def test_top_products_count_by_name_and_break_ties_by_name(spark):
    products = [(f"p{i}", "same" if i < 2 else f"n{i}", "Office", "x") for i in range(5)]
    lines = [line(i, product=f"p{i}") for i in range(5)]
    base = views.dashboard_base(small_star(spark, lines, products=products))
    got = [(r["product_name"], r["sales"]) for r in
           dashboard.top_products_by_name(base, 3).collect()]
    assert got == [("n3", 10), ("n2", 10), ("same", 20)]


def test_margin_gap_without_high_discounts(spark):
    gap = report.margin_gap(small_star(spark, [line(1)])).first()
    assert (gap["low"], gap["high"], gap["difference"]) == (10.0, None, None)


def test_chosen_categories_and_matrix(spark):
    star = small_star(spark, [line(1), line(2, product="p2", profit=D("-3"))])
    top = measures.top_products_in_category(star, categories=["Kitchen"]).collect()
    assert [(r["category"], r["product_id"]) for r in top] == [("Kitchen", "p2")]
    matrix = {r[0]: (r["North"], r["South"]) for r in
              measures.region_subcategory_matrix(star, ["North", "South"]).collect()}
    assert matrix == {"Pens": (1, None), "Cups": (-3, None)}


def test_year_to_date_on_days_without_sales(spark):
    star = small_star(spark, [line(1, day=dt.date(2023, 3, 1)), line(2, day=dt.date(2024, 2, 1))])
    rows = {r["calendar_date"]: r["sales_ytd"] for r in measures.sales_ytd_calendar(star).collect()}
    assert len(rows) == 365 + 366
    assert [rows[dt.date(2023, *d)] for d in ((2, 28), (3, 1), (12, 31))] == [None, 10, 10]
    assert [rows[dt.date(2024, *d)] for d in ((1, 31), (2, 1), (2, 2))] == [None, 10, 10]
