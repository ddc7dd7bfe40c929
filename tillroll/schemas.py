"""Fixed names, types and value lists of the retail model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(12, 2)
# Sum of money over any number of lines; sums of such sums stay within it too.
TOTAL = DecimalType(22, 2)
FRACTION = DecimalType(5, 4)

# Header spellings whose canonical column has another name.
COLUMN_ALIASES = {
    "subcategory": "sub_category",
    "sale_price": "sales",
    "discount_percent": "discount",
}

# Cells that mean "missing".
MISSING_TOKENS = ["Not Available", "not available", "unknown", "Unknown", "N/A", "NA", ""]

# Cells that pandas' CSV reader treats as missing by default.
READER_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Columns without which a line is worthless.
REQUIRED_COLUMNS = ["order_id", "order_date", "product_id", "sales", "quantity"]

DATE_COLUMNS = ["order_date", "ship_date"]
NUMBER_COLUMNS = ["sales", "quantity", "discount", "profit", "cost_price", "list_price"]
LOCATION_COLUMNS = ["country", "region", "state", "city", "postal_code"]

# Month/day first, then ISO. Tried in order on every cell.
DATE_FORMATS = ["M/d/yyyy", "yyyy-MM-dd"]


def _text(name: str, nullable: bool = True) -> StructField:
    return StructField(name, StringType(), nullable)


DIM_CUSTOMER = StructType([_text("customer_id", False), _text("customer_name"), _text("segment")])

DIM_PRODUCT = StructType(
    [_text("product_id", False), _text("product_name"), _text("category"), _text("sub_category")]
)

DIM_LOCATION = StructType(
    [StructField("location_id", LongType(), False), *(_text(c) for c in LOCATION_COLUMNS)]
)

FACT_ORDER_LINES = StructType(
    [
        StructField("order_line_id", LongType(), False),
        _text("order_id", False),
        StructField("order_date", DateType(), False),
        StructField("ship_date", DateType()),
        _text("ship_mode"),
        _text("customer_id"),
        _text("product_id"),
        StructField("location_id", LongType()),
        StructField("sales", MONEY, False),
        StructField("quantity", IntegerType(), False),
        StructField("discount", FRACTION),
        StructField("profit", MONEY),
    ]
)

TABLES = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_location": DIM_LOCATION,
    "fact_order_lines": FACT_ORDER_LINES,
}

PRIMARY_KEYS = {
    "dim_customer": "customer_id",
    "dim_product": "product_id",
    "dim_location": "location_id",
    "fact_order_lines": "order_line_id",
}

# Declared text widths per table.
TEXT_WIDTHS = {
    "dim_customer": {"customer_id": 32, "customer_name": 120, "segment": 40},
    "dim_product": {"product_id": 32, "product_name": 255, "category": 60, "sub_category": 60},
    "dim_location": {"country": 60, "region": 40, "state": 60, "city": 80, "postal_code": 20},
    "fact_order_lines": {"order_id": 40, "ship_mode": 40},
}

# A cleaned order line before the split, in the order that also breaks ties between lines.
CLEAN_LINE = StructType(
    [
        StructField("order_date", DateType()),
        _text("order_id"),
        _text("product_id"),
        StructField("ship_date", DateType()),
        StructField("sales", MONEY),
        StructField("quantity", IntegerType()),
        StructField("discount", FRACTION),
        StructField("profit", MONEY),
        *(
            _text(c)
            for c in (
                "ship_mode",
                "customer_id",
                "customer_name",
                "segment",
                *LOCATION_COLUMNS,
                "product_name",
                "category",
                "sub_category",
            )
        ),
    ]
)


@dataclass(frozen=True)
class Star:
    """The four tables of the model.

    ``complete`` states that every line is known to find its customer, product
    and location (see ``quality.foreign_key_check``). Reports then join only the
    dimensions whose columns they show.
    """

    customers: DataFrame
    products: DataFrame
    locations: DataFrame
    lines: DataFrame
    complete: bool = False

    def tables(self) -> dict[str, DataFrame]:
        """Tables by name, dimensions before the fact that points at them."""
        return {
            "dim_customer": self.customers,
            "dim_product": self.products,
            "dim_location": self.locations,
            "fact_order_lines": self.lines,
        }

    def dimensions(self) -> list[tuple[str, DataFrame]]:
        """(key, table) of the three dimensions."""
        return [
            ("customer_id", self.customers),
            ("product_id", self.products),
            ("location_id", self.locations),
        ]
