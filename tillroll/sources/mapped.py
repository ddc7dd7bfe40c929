"""Order-processing tables mapped onto the retail model.

``mapped_star`` gives a clean star; ``raw_export`` gives the same lines as a wide
all-text export with defects in fixed places, as input for the cleaning steps.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..schemas import DIM_LOCATION, FRACTION, MONEY, Star


# Only the columns in use, declared so that no file has to be opened to plan a query.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
    "l_discount double, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _units(column: str, scale: int) -> Column:
    """Whole units of 10^-scale in a double that holds an exact decimal.

    Casting a double to a decimal goes through its text; whole numbers do not.
    """
    return F.rint(F.col(column) * 10**scale).cast("bigint")


def _decimal(units: Column, scale: int, target: DecimalType) -> Column:
    step = F.lit(Decimal(1).scaleb(-scale))
    return (units.cast("decimal(18,0)") * step).cast(target)


def _money(column: str) -> Column:
    return _decimal(_units(column, 2), 2, MONEY)


def _discount_units() -> Column:
    # 0.00 .. 0.10 stretched to 0.00 .. 0.40, so that every discount band occurs.
    return _units("l_discount", 4) * 4


def _locations(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation")
    region = _table(spark, folder, "region")
    key = F.col("n_nationkey")
    place = F.concat(F.lit("City_"), key.cast("string"))
    code = F.format_string("%05d", key * 137)
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        key.cast("bigint").alias("location_id"),
        F.col("r_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.when(key % 3 != 0, place).alias("city"),
        F.when(key % 4 != 0, code).alias("postal_code"),
    )


def mapped_star(spark: SparkSession, folder: str) -> Star:
    """Star over the tables in ``folder``, without line numbers.

    Lines are built by joins to the sources of all three dimensions, nations and
    regions included, so none of them can miss one.
    """
    lineitem = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    customer = _table(spark, folder, "customer")
    part = _table(spark, folder, "part")
    locations = _locations(spark, folder)

    placed = customer.select("c_custkey", "c_nationkey").join(
        locations, F.col("c_nationkey") == F.col("location_id"), "left_semi"
    )

    cost = (_money("p_retailprice") * F.lit("1.75").cast("decimal(3,2)")).cast(MONEY)
    sold = _units("l_extendedprice", 2) * (10_000 - _discount_units())
    paid = (F.col("cost") * F.col("l_quantity").cast("int")).cast(MONEY)
    lines = (
        # Lines and orders both grow with the data: neither is a side to broadcast.
        lineitem.join(orders.hint("merge"), lineitem.l_orderkey == orders.o_orderkey)
        .join(placed, F.col("c_custkey") == orders.o_custkey)
        .join(part.select("p_partkey", cost.alias("cost")), F.col("p_partkey") == F.col("l_partkey"))
        .withColumn("discount", _decimal(_discount_units(), 4, FRACTION))
        .withColumn("sales", _decimal(sold, 6, MONEY))
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            F.col("o_orderpriority").alias("ship_mode"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("c_nationkey").cast("bigint").alias("location_id"),
            "sales",
            F.col("l_quantity").cast("int").alias("quantity"),
            "discount",
            (F.col("sales") - paid).cast(MONEY).alias("profit"),
        )
    )
    return Star(
        customers=customer.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
        ),
        products=part.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
        ),
        locations=locations.select(*DIM_LOCATION.names),
        lines=lines,
        complete=True,
    )


def raw_export(spark: SparkSession, folder: str) -> DataFrame:
    """Wide all-text export of every line, with defects.

    Unknown order ids, unreadable dates and quantities, padded and upper-cased
    names, unknown segments, missing discounts, and repeated rows.
    """
    lineitem = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    customer = _table(spark, folder, "customer")
    part = _table(spark, folder, "part")

    us_date, iso_date = "M/d/yyyy", "yyyy-MM-dd"
    order, product = F.col("l_orderkey"), F.col("l_partkey")
    name = F.when(order % 7 == 0, F.upper("c_name")).otherwise(F.col("c_name"))
    # Dates are costly to write out, so that is done once for each order, not on every line. What is
    # cheap to make waits until all joins are done, as it would travel beside what it is made from.
    key = F.col("o_orderkey")
    dated = (
        F.when(key % 101 == 0, "not a date")
        .when(key % 5 == 0, F.date_format("o_orderdate", iso_date))
        .otherwise(F.date_format("o_orderdate", us_date))
    )
    locations = _locations(spark, folder)
    placed = (
        orders.join(customer, customer.c_custkey == orders.o_custkey)
        .select(
            "o_orderkey", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "o_orderpriority",
            dated.alias("_ordered"),
        )
    )
    products = part.select("p_partkey", "p_type", "p_brand", "p_name", "p_retailprice")
    cost = (_money("p_retailprice") * F.lit("0.80").cast("decimal(3,2)")).cast(MONEY)
    percent = _decimal(_discount_units(), 2, DecimalType(5, 2)).cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    copies = F.when(order % 50 == 0, 2).otherwise(1)
    return (
        # Lines and orders both grow with the data: neither is a side to broadcast. Lines meet
        # products while they are narrow, the wider orders after them, and the few places last.
        lineitem.join(products, F.col("p_partkey") == product)
        .join(placed.hint("merge"), order == F.col("o_orderkey"))
        .join(locations, F.col("location_id") == F.col("c_nationkey"))
        .select(
            F.when(order % 97 == 0, "N/A").otherwise(order.cast("string")).alias("Order ID"),
            F.col("_ordered").alias("Order Date"),
            F.date_format("l_shipdate", us_date).alias("Ship Date"),
            F.col("o_orderpriority").alias("Ship Mode"),
            F.col("c_custkey").cast("string").alias("Customer ID"),
            F.concat(F.lit(" \t"), name, F.lit("  ")).alias("Customer Name"),
            F.when(F.col("c_custkey") % 11 == 0, "unknown")
            .otherwise(F.col("c_mktsegment"))
            .alias("Segment"),
            F.col("country").alias("Country"),
            F.col("city").alias("City"),
            F.col("state").alias("State"),
            F.col("postal_code").alias("Postal Code"),
            F.col("region").alias("Region"),
            product.cast("string").alias("Product ID"),
            F.col("p_type").alias("Category"),
            F.col("p_brand").alias("Sub-Category"),
            F.col("p_name").alias("Product Name"),
            _money("p_retailprice").cast("string").alias("List Price"),
            cost.cast("string").alias("cost price"),
            F.when(order % 103 == 0, "x").otherwise(quantity).alias("Quantity"),
            F.when(product % 13 != 0, percent).alias("Discount Percent"),
            F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
        )
        .drop("_copy")
    )
