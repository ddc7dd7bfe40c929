"""The maintained monthly summary against the one over all lines."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

from tests.test_star_and_quality import line, small_star
from tillroll.operators.append import continued, extended
from tillroll.plans import summary, views


def test_two_appends_equal_the_whole(spark):
    def batch(start, n):
        rows = [
            line(i, product=f"p{1 + i % 2}", location=1 + i % 2, sales=str(i % 9), quantity=i % 4,
                 day=dt.date(2024, 1 + i % 3, 1), order_id=f"o{i // 3}",
                 discount=None if i % 5 == 0 else Decimal(i % 4) / 10)
            for i in range(start, start + n)
        ]
        return small_star(spark, rows)

    whole = batch(1, 20_000)
    partial = summary.partial_summary(whole)
    for start, n in ((15_000, 6000), (30_000, 1)):
        addition = continued(whole, batch(start, n))
        partial = summary.merged(partial, summary.added_summary(whole, addition))
        whole = extended(whole, addition)
    exact = ["units_sold", "total_sales", "total_profit", "avg_discount"]
    want = {tuple(r[c] for c in summary.KEYS): r for r in views.monthly_summary(whole).collect()}
    got = {tuple(r[c] for c in summary.KEYS): r for r in summary.shown(partial).collect()}
    assert want.keys() == got.keys() and len(got) >= 3
    for key, row in got.items():
        assert [row[c] for c in exact] == [want[key][c] for c in exact]
        orders = want[key]["orders"]
        assert abs(row["approx_orders"] - orders) <= max(1, 0.04 * orders)


def test_summary_of_an_empty_star(spark):
    star = small_star(spark, [line(1)])
    empty = replace(star, lines=star.lines.limit(0))
    part = summary.partial_summary(empty)
    assert summary.shown(summary.merged(part, part)).count() == 0
