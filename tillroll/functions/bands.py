"""The two discount banding rules. They differ on purpose: see each docstring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels, lowest discount first.
BANDS = ["0%", "1-10%", "11-20%", "21-30%", "30%+"]
# Upper edges (inclusive) of all bands but the last.
EDGES = ["0", "0.10", "0.20", "0.30"]
# Bands compared by the margin gap.
LOW_BANDS = ["0%", "1-10%"]
HIGH_BANDS = ["21-30%", "30%+"]


def _edge(text: str) -> Column:
    return F.lit(text).cast("decimal(5,4)")


def report_band(discount: Column) -> Column:
    """Band of the SQL reports.

    Only exactly zero is ``0%`` (a negative discount falls into ``1-10%``), the
    last band is open-ended, and NULL has to be filtered out before.
    """
    zero, *edges = EDGES
    band = F.when(discount == _edge(zero), BANDS[0])
    for label, edge in zip(BANDS[1:], edges):
        band = band.when(discount <= _edge(edge), label)
    return band.otherwise(BANDS[-1])


def dashboard_band(discount: Column) -> Column:
    """Band of the dashboard: right-closed bins on (-0.01, 1], NULL counted as no discount.

    Discounts outside the bins get no band.
    """
    filled = F.coalesce(discount, _edge("0"))
    band = F.when(filled <= _edge("-0.01"), F.lit(None))
    for label, edge in zip(BANDS, [*EDGES, "1"]):
        band = band.when(filled <= _edge(edge), label)
    return band
