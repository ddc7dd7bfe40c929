"""Dashboard series from cells against the same series from lines."""

import datetime as dt
from decimal import Decimal as D

import pytest

from tests.test_star_and_quality import line, small_star
from tillroll.plans import cube, dashboard, views
from tillroll.sources.mapped import mapped_star

CHOICES = [
    {},
    {"regions": ["ASIA", "EUROPE"]},
    {"categories": ["STANDARD"], "dates": (dt.date(1995, 3, 5), dt.date(1996, 7, 20))},
    {"regions": ["NOWHERE"]},
]


@pytest.fixture(scope="module")
def base(spark, folder):
    return views.dashboard_base(mapped_star(spark, folder), *cube.NEEDED)


@pytest.fixture(scope="module")
def folded(base):
    return cube.cells(base)


@pytest.mark.parametrize("choice", CHOICES)
def test_series_from_cells_equal_those_from_lines(base, folded, choice):
    lines = dashboard.filtered_lines(base, **choice)
    chosen = dashboard.filtered_lines(folded, **choice)
    for series in (dashboard.monthly_sales_dense, dashboard.sales_by_region, dashboard.discount_margin):
        want = series(lines)
        assert series(chosen).dtypes == want.dtypes
        assert series(chosen).collect() == want.collect()
    seen = {(r["visual"], r["label"]): r for r in cube.visuals(chosen).collect()}
    regions = {r["region"]: r["sales"] for r in dashboard.sales_by_region(lines).collect()}
    assert {key[1]: r["sales"] for key, r in seen.items() if key[0] == "region"} == regions
    bands = {r["discount_band"]: r["margin_pct"] for r in dashboard.discount_margin(lines).collect()}
    assert {k[1]: r["margin_pct"] for k, r in seen.items() if k[0] == "discount_band" and r["sales"]} == bands
    if seen:
        kpis = dashboard.kpis(lines).first()
        total = seen["total", None]
        assert (total["sales"], total["profit"]) == (kpis["total_sales"], kpis["total_profit"])
        assert total["order_lines"] == lines.count()
    else:
        assert lines.isEmpty()


def test_nulls_odd_discounts_and_empty_lines(spark):
    lines = [
        line(1, discount=None), line(2, discount=D("2"), customer=None), line(3, sales="0", day=None),
        line(4, product=None), line(5, sales="30"),
    ]
    base = views.dashboard_base(small_star(spark, lines), *cube.NEEDED)
    folded = cube.cells(base)
    rows = {(r["visual"], r["label"]): (r["order_lines"], r["sales"]) for r in cube.visuals(folded).collect()}
    assert rows["total", None] == (5, D(70 - 10))
    assert rows["discount_band", "0%"] == (1, D(10))
    assert rows["discount_band", "1-10%"] == (3, D(40))
    assert ("spend_decile", "1") in rows and rows["spend_decile", "1"] == (4, D(50))
    assert rows["month", "2024-01"] == (4, D(60))
    assert cube.of_deciles(folded, [2]).isEmpty()
    assert cube.visuals(cube.cells(base.limit(0))).isEmpty()


def test_visuals_take_one_pass_over_cells(folded):
    plan = cube.visuals(folded)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
