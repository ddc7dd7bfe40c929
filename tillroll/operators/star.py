"""From cleaned order lines to three dimensions and a fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    DIM_CUSTOMER,
    DIM_LOCATION,
    DIM_PRODUCT,
    FACT_ORDER_LINES,
    LOCATION_COLUMNS,
    Star,
)
from .ranking import numbered
from .skew import spread_join


def _first_seen(lines: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key with the attributes of its earliest line.

    Two steps: distinct attribute sets are collapsed by a hash aggregate over
    plain columns, which also flattens hot keys inside each input task; only the
    few survivors per key go through the costlier pick of a whole struct.
    """
    versions = lines.groupBy(key, *attributes).agg(F.min("order_line_id").alias("_first"))
    picked = F.min_by(F.struct(*attributes), "_first").alias("_row")
    return versions.groupBy(key).agg(picked).select(key, "_row.*")


def customer_dimension(lines: DataFrame) -> DataFrame:
    """One row per customer; the first line decides name and segment."""
    key, *attributes = DIM_CUSTOMER.names
    return _first_seen(lines, key, attributes)


def product_dimension(lines: DataFrame) -> DataFrame:
    """One row per product; the first line decides name and categories."""
    key, *attributes = DIM_PRODUCT.names
    return _first_seen(lines, key, attributes)


def location_dimension(lines: DataFrame) -> DataFrame:
    """Distinct locations, NULL equal to NULL, numbered in sort order. Writes one table."""
    places = lines.select(*LOCATION_COLUMNS).distinct()
    order = [F.col(c).asc_nulls_last() for c in LOCATION_COLUMNS]
    return numbered(places, "location_id", order).select(*DIM_LOCATION.names)


def order_line_fact(lines: DataFrame, locations: DataFrame, spread: bool = False) -> DataFrame:
    """Lines with the id of their location; a missing city matches a missing city.

    With ``spread`` lines of a busy place are joined in pieces.
    """
    if spread:
        found = spread_join(
            lines, locations, LOCATION_COLUMNS, ["order_line_id"], "left", null_safe=True
        )
        return found.select(*FACT_ORDER_LINES.names)
    same_place = reduce(
        Column.__and__, (lines[c].eqNullSafe(locations[c]) for c in LOCATION_COLUMNS)
    )
    joined = lines.join(locations, same_place, "left")
    return joined.select(*FACT_ORDER_LINES.names)


def build_star(lines: DataFrame, spread: bool = False) -> Star:
    """Dimensions and fact of cleaned lines.

    Every line finds its location by construction. Customer and product keys may
    be NULL in the input, so the star does not claim to be complete. For ``spread`` see
    ``order_line_fact``.
    """
    locations = location_dimension(lines)
    return Star(
        customers=customer_dimension(lines),
        products=product_dimension(lines),
        locations=locations,
        lines=order_line_fact(lines, locations, spread),
    )
