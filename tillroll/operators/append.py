"""A further batch for a star that is already stored: keys go on where it ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DIM_LOCATION, FACT_ORDER_LINES, LOCATION_COLUMNS, Star
from ..sources.scratch import written
from .ranking import numbered


def _highest(table: DataFrame, key: str) -> int:
    return table.agg(F.max(key)).first()[0] or 0


def _unknown(table: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    known = stored.select(F.col(key).alias("_known"))
    return table.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")


def _made_number() -> Column:
    """Number in an id that ``add_customer_key`` made, NULL in any other."""
    made = F.regexp_extract("customer_id", r"^C([0-9]{6,})$", 1)
    return F.when(made != "", made.cast("bigint"))


def _made_from(star: Star) -> DataFrame:
    """(source, label, customer_id, number): the name, or else the order, that each made id stands for.

    An order has one made id, so its lines are folded before customers are joined.
    """
    made = star.customers.withColumn("number", _made_number()).filter("number is not null")
    names = made.filter("customer_name is not null").select(
        F.lit("name").alias("source"), F.col("customer_name").alias("label"), "customer_id", "number"
    )
    nameless = made.filter("customer_name is null").select(F.col("customer_id").alias("_id"), "number")
    orders = star.lines.select("order_id", "customer_id").distinct()
    return names.unionByName(
        orders.join(nameless, F.col("customer_id") == F.col("_id")).select(
            F.lit("order").alias("source"), F.col("order_id").alias("label"), "customer_id", "number"
        )
    )


def _renamed_customers(stored: Star, batch: Star) -> DataFrame:
    """(old, new) customer ids of a batch whose ids were made from names or orders.

    A known name or order keeps its stored id; new ones follow the highest number in use,
    in the order of the batch. Ids of another form, ``C-00001`` among them, stay.
    """
    known = (
        _made_from(stored)
        .groupBy(F.col("source").alias("_source"), F.col("label").alias("_label"))
        .agg(F.min_by("customer_id", "number").alias("_id"))
    )
    highest = stored.customers.agg(F.max(_made_number())).first()[0]
    start = -1 if highest is None else highest
    same = (F.col("source") == F.col("_source")) & (F.col("label") == F.col("_label"))
    found = _made_from(batch).join(known, same, "left")
    found = written(found.select("customer_id", "number", "_id"), "made-customers")
    kept = found.filter("_id is not null").select(
        F.col("customer_id").alias("old"), F.col("_id").alias("new")
    )
    fresh = found.filter("_id is null").select("customer_id", "number")
    fresh = numbered(fresh, "_n", [F.col("number").asc()]).select(
        F.col("customer_id").alias("old"),
        F.format_string("C%06d", F.col("_n") + F.lit(start)).alias("new"),
    )
    return written(kept.unionByName(fresh), "renamed-customers")


def continued(stored: Star, batch: Star, made_customers: bool = False) -> Star:
    """Rows that ``batch`` adds to ``stored``, under keys that go on from its own.

    Known customers and products are left out, the first batch decides their attributes.
    Locations are matched with NULL equal to NULL; new ones and all lines are numbered
    after the highest stored id. With ``made_customers`` the batch's customer ids came
    from ``add_customer_key``: they start anew in each batch and are matched by the name, or
    else the order, that they were made from.
    Stored rows are never rewritten.
    """
    customers, lines = batch.customers, batch.lines
    if made_customers:
        renamed = _renamed_customers(stored, batch)
        new = F.coalesce("new", "customer_id").alias("customer_id")
        same = F.col("customer_id").eqNullSafe(F.col("old"))

        def rekeyed(table: DataFrame) -> DataFrame:
            others = [c for c in table.columns if c != "customer_id"]
            joined = table.join(renamed, same, "left").select(new, *others)
            return joined.select(*table.columns)

        customers, lines = rekeyed(customers), rekeyed(lines)

    known = stored.locations.select(
        F.col("location_id").alias("_stored"), *(F.col(c).alias(f"_{c}") for c in LOCATION_COLUMNS)
    )
    same_place = F.lit(True)
    for c in LOCATION_COLUMNS:
        same_place = same_place & F.col(c).eqNullSafe(F.col(f"_{c}"))
    matched = written(
        batch.locations.join(known, same_place, "left").select(*batch.locations.columns, "_stored"),
        "matched-locations",
    )
    highest = _highest(stored.locations, "location_id")
    fresh = numbered(matched.filter("_stored is null"), "_n", [F.col("location_id").asc()])
    fresh = written(fresh.withColumn("_new", F.col("_n") + F.lit(highest)), "new-locations")
    ids = matched.filter("_stored is not null").select("location_id", F.col("_stored").alias("_new"))
    ids = ids.unionByName(fresh.select("location_id", "_new")).withColumnRenamed("location_id", "_old")
    last = _highest(stored.lines, "order_line_id")
    lines = (
        lines.join(ids, F.col("location_id") == F.col("_old"), "left")
        .withColumn("location_id", F.col("_new"))
        .withColumn("order_line_id", F.col("order_line_id") + F.lit(last))
        .select(*FACT_ORDER_LINES.names)
    )
    return Star(
        customers=_unknown(customers, stored.customers, "customer_id"),
        products=_unknown(batch.products, stored.products, "product_id"),
        locations=fresh.withColumn("location_id", F.col("_new")).select(*DIM_LOCATION.names),
        lines=lines,
        complete=False,
    )


def extended(stored: Star, addition: Star) -> Star:
    """Both together, as they read once ``addition`` is appended in storage."""
    return Star(
        customers=stored.customers.unionByName(addition.customers),
        products=stored.products.unionByName(addition.products),
        locations=stored.locations.unionByName(addition.locations),
        lines=stored.lines.unionByName(addition.lines),
    )
