"""The processed star: reading, full refresh, append, and SQL over it."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.append import continued
from ..operators.clustering import clustered
from ..operators.quality import typed_check
from ..schemas import PRIMARY_KEYS, TABLES, Star
from .scratch import delete, shuffles_removed, written

# Derived from the order date; folders of this name let date filters skip whole years.
YEAR = "order_year"


# What reports filter by, as far as the fact has it: dates, and places, whose ids follow
# country and region.
FACT_FILTERS = ["order_date", "location_id", "product_id"]


def _laid_out(name: str, table: DataFrame, layout: str = "year") -> DataFrame:
    """Rows clustered for the filters that reports use, so that file statistics can skip.

    Dimensions are sorted by key. The fact goes by order date, in folders by year; the range
    boundaries fall on (date, line), hence one busy day is spread over several
    files instead of one task. With ``layout="filters"`` it is clustered by date, place and product
    alike, without folders; it should be a written table then, as its columns are sampled.
    """
    if layout not in ("year", "filters"):
        raise ValueError(f"unknown layout {layout!r}")
    if name != "fact_order_lines":
        return table.orderBy(F.asc_nulls_last(PRIMARY_KEYS[name]))
    if layout == "filters":
        return clustered(table, FACT_FILTERS, PRIMARY_KEYS[name])
    return (
        table.withColumn(YEAR, F.year("order_date"))
        .repartitionByRange("order_date", "order_line_id")
        .sortWithinPartitions(YEAR, "order_date")
    )


def _batch_path(folder: str, batch: str) -> str:
    """Folder of a batch. Names that readers skip, or that leave the folder, are refused."""
    if not re.fullmatch("[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"batch id {batch!r} is not made of letters, digits, dots, dashes, lines")
    return f"{folder}/_batches/{batch}"


def _store(star: Star, folder: str, fmt: str, mode: str, layout: str) -> None:
    """Tables of a star, each in its own folder, dimensions before the fact."""
    typed_check(star.tables())
    for name, table in star.tables().items():
        if name == "fact_order_lines" and layout == "filters":
            table = written(table, "fact")
        writer = _laid_out(name, table, layout).write
        if name == "fact_order_lines" and layout == "year":
            writer = writer.partitionBy(YEAR)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        with shuffles_removed(table.sparkSession):
            writer.mode(mode).format(fmt).save(f"{folder}/{name}")


def committed_batches(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, table_name, rows) of every batch that was appended to its end."""
    schema = "batch string, table_name string, rows bigint"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/_batches/*/committed")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _batch_ids(spark: SparkSession, folder: str) -> list[str]:
    # One name per load, as many as there are batch folders.
    return sorted(r["batch"] for r in committed_batches(spark, folder).select("batch").distinct().collect())


def write_star(
    star: Star,
    folder: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    made_customers: bool = False,
    batch: str | None = None,
    layout: str = "year",
) -> dict[str, int]:
    """Write one folder per table and return the rows that each then holds.

    ``overwrite`` is the full refresh, which ends all batches; ``append`` adds rows whose keys go on
    from the stored ones and whose known dimension rows are left out (see ``continued``,
    also for ``made_customers``). ``fmt`` is ``parquet`` or ``csv``. ``layout="filters"`` clusters
    the fact by all columns that reports filter by, instead of folders by year; one folder
    has one layout, so it is for a full refresh or a named batch.

    A named ``batch`` can be repeated. Its tables are staged in a folder of their own, and
    a marker is written when all of them are complete; only marked batches are read. A
    batch that failed half-way is invisible and written anew, under the same keys, by the
    next try; one that is marked is left as it is, and its rows are not looked at. One
    writer at a time: two would number their lines alike.

    Rows are counted in what was stored (for Parquet from file footers): counts taken
    while writing would include retried tasks and the sampling of the date ranges.
    """
    spark = star.lines.sparkSession
    if batch is not None and mode != "append":
        raise ValueError("only an append is a batch")
    if layout != "year" and mode == "append" and batch is None:
        raise ValueError("one folder has one layout: name the batch")
    if mode == "overwrite":
        delete(spark, f"{folder}/_batches")
    place = folder if batch is None else _batch_path(folder, batch)
    if batch is None or batch not in _batch_ids(spark, folder):
        if mode == "append":
            star = continued(read_star(spark, folder, fmt), star, made_customers)
        _store(star, place, fmt, mode if batch is None else "overwrite", layout)
        if batch is not None:
            counts = {name: t.count() for name, t in _tables(spark, [place], fmt).items()}
            rows = [(batch, name, n) for name, n in counts.items()]
            marker = spark.createDataFrame(rows, "batch string, table_name string, rows bigint")
            marker.coalesce(1).write.mode("overwrite").parquet(f"{place}/committed")
    return {name: table.count() for name, table in read_star(spark, folder, fmt).tables().items()}


def _tables(spark: SparkSession, folders: list[str], fmt: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        reader = spark.read.schema(TABLES[name])
        if fmt == "csv":
            reader = reader.options(header=True, multiLine=True, quote='"', escape='"')
        parts = [reader.format(fmt).load(f"{folder}/{name}") for folder in folders]
        return reduce(DataFrame.unionByName, (part.select(*TABLES[name].names) for part in parts))

    return {name: table(name) for name in TABLES}


def read_star(spark: SparkSession, folder: str, fmt: str = "parquet", complete: bool = False) -> Star:
    """Star written by ``write_star``, its complete batches included, with declared types."""
    batches = [_batch_path(folder, batch) for batch in _batch_ids(spark, folder)]
    found = _tables(spark, [folder, *batches], fmt)
    return Star(
        customers=found["dim_customer"],
        products=found["dim_product"],
        locations=found["dim_location"],
        lines=found["fact_order_lines"],
        complete=complete,
    )


# The largest dimension: its join is the one worth storing ready.
BUCKET_KEY = "customer_id"
BUCKETED = ("dim_customer", "fact_order_lines")


def _bucket_count(spark: SparkSession, table: str) -> int | None:
    """Buckets of a stored table, None if it has none or does not exist."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"describe extended {table}").filter("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else None


def read_tables(spark: SparkSession, database: str, complete: bool = False) -> Star:
    """Star written by ``save_tables``."""
    return Star(*(spark.table(f"{database}.{name}") for name in TABLES), complete=complete)


def save_tables(
    star: Star,
    database: str,
    mode: str = "append",
    made_customers: bool = False,
    batch: str | None = None,
    buckets: int | None = None,
) -> None:
    """Write the star to catalog tables, dimensions first; ``append`` goes on from stored keys.

    With ``buckets`` the fact and the customers are stored in that many buckets by customer, so that
    joins and groups by customer need no exchange. A busy customer is written by several
    tasks, but a bucketed join reads it in one: with such customers leave ``buckets`` out, and
    adaptive execution can split the join. An append keeps the stored number; another one is an error.

    A named ``batch`` can be repeated: ``loaded_batches`` notes the last line before it and, at the end,
    that it is done. Dimensions leave known rows out, so only the fact matters: if lines
    beyond the noted one are there, the one write of the fact was complete. One writer at a time.
    """
    spark = star.lines.sparkSession
    fact, notes = f"{database}.fact_order_lines", f"{database}.loaded_batches"
    note = "batch string, last_line bigint, done boolean"

    def noted(last_line: int, done: bool) -> None:
        row = spark.createDataFrame([(batch, last_line, done)], note)
        row.coalesce(1).write.mode("append").saveAsTable(notes)

    if batch is not None and mode != "append":
        raise ValueError("only an append is a batch")
    if mode == "overwrite" and spark.catalog.tableExists(notes):
        spark.createDataFrame([], note).write.mode("overwrite").saveAsTable(notes)
    exists = spark.catalog.tableExists(fact)
    if mode == "append" and exists:
        stored_buckets = _bucket_count(spark, fact)
        if buckets not in (None, stored_buckets):
            raise ValueError(f"{fact} is stored in {stored_buckets or 'no'} buckets, not in {buckets}")
        buckets = stored_buckets
    last = (spark.table(fact).agg(F.max("order_line_id")).first()[0] or 0) if exists else 0
    if batch is not None:
        known = spark.catalog.tableExists(notes)
        earlier = spark.table(notes).filter(F.col("batch") == batch).collect() if known else []
        if any(r["done"] for r in earlier):
            return
        if earlier and last > min(r["last_line"] for r in earlier):
            noted(last, True)
            return
        if not earlier:
            noted(last, False)
    if mode == "append" and exists:
        star = continued(read_tables(spark, database), star, made_customers)
    typed_check(star.tables())
    for name, table in star.tables().items():
        if buckets and name in BUCKETED:
            writer = table.hint("rebalance", F.col(BUCKET_KEY)).write
            writer = writer.bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY)
        else:
            writer = _laid_out(name, table).drop(YEAR).write
        writer.mode(mode).saveAsTable(f"{database}.{name}")
    if batch is not None:
        noted(last, True)


def append_jdbc(star: Star, url: str, properties: Mapping[str, str]) -> None:
    """Append the star to existing database tables, 5,000 rows per insert, dimensions first."""
    for name, table in star.tables().items():
        options = {"batchsize": "5000", **properties}
        table.write.mode("append").jdbc(url, name, properties=options)


def line_count(star: Star) -> int:
    """Order lines in the star."""
    return star.lines.count()


def query(spark: SparkSession, text: str) -> DataFrame:
    """SQL over the registered tables and views."""
    return spark.sql(text)
