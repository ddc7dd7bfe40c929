"""Cleaning of a raw wide export, one order line per row, every column text.

The steps are separate functions so that each can be used on its own; ``clean``
chains them. Their order matters: blanks and tokens go before parsing, the
discount scale before derived sales, duplicates before incomplete rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegerType, StringType

from ..functions.parse import parsed_date, parsed_number
from ..functions.text import canonical_name, tidied, without_tokens
from ..schemas import (
    CLEAN_LINE,
    COLUMN_ALIASES,
    DATE_COLUMNS,
    DATE_FORMATS,
    MISSING_TOKENS,
    NUMBER_COLUMNS,
    READER_NA_TOKENS,
    REQUIRED_COLUMNS,
)
from ..sources.scratch import delete, in_rounds, noted, passing, written
from .ranking import numbered, numbered_by_lead
from .skew import heavy_keys, spread_join

ALL_TOKENS = sorted({*MISSING_TOKENS, *READER_NA_TOKENS})

# Marks a row with too many or too few fields; set by the CSV reader, counted by the audit.
MALFORMED = "_malformed"
# Names the file that a row comes from; set by the CSV reader on request, shown by the rejects.
ORIGIN = "_origin"


def standard_names(df: DataFrame, aliases: Mapping[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Canonical column names. Unknown columns are kept under their tidied name."""
    names = [c if c in (MALFORMED, ORIGIN) else canonical_name(c, dict(aliases)) for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"several raw columns map onto {clashes}: {df.columns}")
    return df.toDF(*names)


def _on_text(df: DataFrame, change) -> DataFrame:
    """Apply ``change`` to every text column in one projection."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(
        *(change(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns)
    )


def trim_text(df: DataFrame) -> DataFrame:
    """Strip white space of any kind from all text columns; blanks become NULL."""
    return _on_text(df, lambda cell: tidied(cell, [""]))


def null_tokens(df: DataFrame, tokens: Iterable[str] = ALL_TOKENS) -> DataFrame:
    """NULL for every text cell that is a missing-value token."""
    listed = list(tokens)
    return _on_text(df, lambda cell: without_tokens(cell, listed))


def parse_dates(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Order and ship date as dates, NULL where no format fits."""
    present = [c for c in DATE_COLUMNS if c in df.columns]
    return df.withColumns({c: parsed_date(F.col(c), formats) for c in present})


def parse_numbers(df: DataFrame) -> DataFrame:
    """Measure and price columns as doubles, NULL where the text is no number."""
    present = [c for c in NUMBER_COLUMNS if c in df.columns]
    return df.withColumns({c: parsed_number(F.col(c)) for c in present})


def normalise_discount(df: DataFrame, scale: str = "auto") -> DataFrame:
    """Discounts as fractions of one.

    ``auto`` divides by 100 when the largest discount of the whole input exceeds
    one; the maximum is a scalar subquery over the one column, so ``df`` should be
    cheap to read twice (a written table), and nothing reaches the driver. A batch
    that is appended to older data should name its scale (``fraction`` or
    ``percent``), as its own maximum may mislead.
    """
    if scale not in ("auto", "fraction", "percent"):
        raise ValueError(f"unknown discount scale {scale!r}")
    if "discount" not in df.columns or scale == "fraction":
        return df
    unit = F.lit(100.0)
    if scale == "auto":
        largest = df.agg(F.max("discount")).scalar()
        unit = F.when(largest > 1, unit).otherwise(F.lit(1.0))
    return df.withColumn("discount", F.col("discount") / unit)


def derive_sales(df: DataFrame) -> DataFrame:
    """Sales from list price, discount and quantity, if the export has no sales column."""
    if "sales" in df.columns or not {"list_price", "quantity"} <= set(df.columns):
        return df
    discount = F.coalesce("discount", F.lit(0.0)) if "discount" in df.columns else F.lit(0.0)
    return df.withColumn("sales", F.col("list_price") * (1 - discount) * F.col("quantity"))


def derive_profit(df: DataFrame) -> DataFrame:
    """Profit from sales, cost price and quantity, if the export has no profit column."""
    if "profit" in df.columns or not {"cost_price", "quantity"} <= set(df.columns):
        return df
    if "sales" not in df.columns:
        raise ValueError("profit needs a sales column, or list_price and quantity to derive it")
    return df.withColumn("profit", F.col("sales") - F.col("cost_price") * F.col("quantity"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row for each set of rows that agree in every column, NULL equal to NULL."""
    return df.drop(MALFORMED, ORIGIN).dropDuplicates()


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Raise unless all required columns are there."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {sorted(df.columns)}")
    return df


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with NULL in a required column."""
    return df.na.drop("any", subset=list(required))


def typed(value: Column, target: DataType) -> Column:
    """Value in its declared type, NULL where it does not fit; fractions round half away.

    Both roundings go through the text of a double. Where it is far from the middle between
    two results, whole units of the last place give the same at half the cost.
    """
    if isinstance(target, IntegerType):
        whole = F.when(F.rint(value) == value, value).otherwise(F.round(value))
        return whole.try_cast(target)
    if not isinstance(target, DecimalType):
        return value.try_cast(target)
    scaled = value.try_cast("double") * float(10**target.scale)
    units = F.rint(scaled)
    largest = min(10 ** min(target.precision, 15) - 1, 2**33)
    clear = (F.abs(scaled - units) < 0.49) & (F.abs(scaled) < float(largest))
    step = F.lit(Decimal(1).scaleb(-target.scale))
    near = (units.cast("bigint").cast("decimal(11,0)") * step).try_cast(target)
    return F.when(clear, near).otherwise(value.try_cast(target))


def apply_types(df: DataFrame) -> DataFrame:
    """Declared type for every canonical column, absent ones added as typed NULLs.

    Decimals round half up to their scale; a value too large for its column
    becomes NULL and then shows in the integrity checks. Further columns of the
    export follow in name order; the prices that measures were derived from go.
    """
    known = [
        typed(F.col(f.name) if f.name in df.columns else F.lit(None), f.dataType).alias(f.name)
        for f in CLEAN_LINE
    ]
    done = {*CLEAN_LINE.names, "cost_price", "list_price"}
    return df.select(*known, *(F.col(f"`{c}`") for c in sorted(set(df.columns) - done)))


def number_lines(
    df: DataFrame, kept: Callable[[DataFrame], DataFrame] = lambda lines: lines
) -> DataFrame:
    """``order_line_id`` 1..N by order date, order, product and all further columns.

    Spark has no file order; this total order makes ids reproducible. Writes one
    intermediate table, from which everything downstream reads. Only lines that the filter
    ``kept`` leaves are numbered.
    """
    order = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns]
    if df.columns[0] == "order_date":
        return numbered_by_lead(df, "order_line_id", "order_date", order, kept)
    return numbered(kept(df), "order_line_id", order)


def add_customer_key(df: DataFrame, spread: bool = False) -> DataFrame:
    """``customer_id`` made from the customer name, or else the order id.

    Needs ``order_line_id``: names are numbered from C000000 by the line on which
    they first appear; lines without a name share ``C-00001``. With ``spread`` lines of a
    frequent name find their key in pieces.
    """
    source = "customer_name" if "customer_name" in df.columns else "order_id"
    first = (
        df.filter(F.col(source).isNotNull())
        .groupBy(F.col(source).alias("_name"))
        .agg(F.min("order_line_id").alias("_first"))
    )
    keys = numbered(first, "_number", [F.col("_first").asc()]).select(
        "_name", F.format_string("C%06d", F.col("_number") - 1).alias("_key")
    )
    others = [c for c in df.columns if c != "customer_id"]
    # Every name has a key; lines without one stay out of the join, where they would be a hot key.
    if spread:
        known = df.filter(F.col(source).isNotNull())
        named = spread_join(known, keys.withColumnRenamed("_name", source), [source], ["order_line_id"])
    else:
        named = df.join(keys, F.col(source) == F.col("_name"))
    named = named.select(*others, F.col("_key").alias("customer_id"))
    unnamed = df.filter(F.col(source).isNull())
    return named.unionByName(unnamed.select(*others, F.lit("C-00001").alias("customer_id")))


def _cell_rules(
    columns: Iterable[str], tokens: Sequence[str], formats: Sequence[str], strict_order: bool
) -> dict[str, Callable[[Column], Column]]:
    """How to read each column.

    Dates and numbers are read from the raw cell, as the default tokens are
    neither; only tokens that the caller adds are taken out before.
    """
    added = sorted({*tokens} - {*ALL_TOKENS})
    nothing = sorted({*tokens, ""})

    def raw(cell: Column) -> Column:
        return without_tokens(cell, added) if added else cell

    def text(cell: Column) -> Column:
        if strict_order:
            return tidied(without_tokens(cell, tokens), [""])
        return tidied(cell, nothing)

    def rule(column: str) -> Callable[[Column], Column]:
        if column in DATE_COLUMNS:
            return lambda cell: parsed_date(raw(cell), formats)
        if column in NUMBER_COLUMNS:
            return lambda cell: parsed_number(raw(cell))
        return text

    return {c: rule(c) for c in columns if c not in (MALFORMED, ORIGIN)}


def read_cells(
    df: DataFrame,
    tokens: Iterable[str] = ALL_TOKENS,
    formats: Sequence[str] = DATE_FORMATS,
    strict_order: bool = False,
) -> DataFrame:
    """All cells parsed, stripped and freed of tokens in one projection.

    With ``strict_order`` tokens are looked for before trimming, so that a padded
    token stays text. Columns that a caller does not use are not parsed.
    """
    return _with_rules(df, _cell_rules(df.columns, list(tokens), formats, strict_order))


def _with_rules(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    cells = ((c, F.col(f"`{c}`")) for c in df.columns)
    return df.select(*((rules[c](v) if c in rules else v).alias(c) for c, v in cells))


def _measured(lines: DataFrame, scale: str) -> DataFrame:
    """Discount scale and derived measures; raises if a required column is missing."""
    lines = normalise_discount(lines, scale).transform(derive_sales).transform(derive_profit)
    return require_columns(lines)


def parsed(
    raw: DataFrame,
    aliases: Mapping[str, str] = COLUMN_ALIASES,
    scale: str = "auto",
    **cell_options,
) -> DataFrame:
    """All row-wise steps: names, cells, discount scale, derived measures.

    With ``scale="auto"`` the parsed cells are written once, so that the largest
    discount is taken from one stored column and the export is read once.
    """
    lines = read_cells(standard_names(raw, aliases), **cell_options)
    checked = _measured(lines, scale)
    if scale == "auto" and "discount" in lines.columns:
        return _measured(written(lines, "parsed-cells"), scale)
    return checked


# No header can become such a name.
_COPIES, _MALFORMED_COPIES, _FILE, _NEAR = "#copies", "#malformed", "#file", "#near"


def distinct_lines(
    raw: DataFrame,
    aliases: Mapping[str, str] = COLUMN_ALIASES,
    tokens: Iterable[str] = ALL_TOKENS,
    formats: Sequence[str] = DATE_FORMATS,
    strict_order: bool = False,
) -> DataFrame:
    """Parsed rows, copies folded and counted, written once: the only step that reads ``raw``.

    ``finished`` and ``audited`` go on from it. Copies are folded before the discount
    is scaled and measures are derived, which treat equal rows alike.

    The export is stored as it comes, which ends the work behind it, and deleted afterwards. Its
    lines are dealt by their order, as lines of one order lie together and are packed well then. If
    an order fills more than two tasks, lines are dealt by all columns instead, and collapse within
    each input task first: a row repeated any number of times costs one shuffled row per task.
    """
    named_raw = standard_names(raw, aliases)
    rules = _cell_rules(named_raw.columns, list(tokens), formats, strict_order)
    _measured(_with_rules(named_raw, rules), "fraction")
    order = F.coalesce(rules["order_id"](F.col("order_id")), rules["product_id"](F.col("product_id")))
    with passing(named_raw.withColumn(_NEAR, F.hash(order)), "raw-lines") as stored:
        parts = [written(part, "distinct-lines") for part in _folded(stored, rules)]
    return reduce(DataFrame.unionByName, parts)


def _folded(stored: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> list[DataFrame]:
    """Distinct parsed rows of a stored export, with counts of their copies; in shares of the orders."""
    columns = [c for c in stored.columns if c not in (MALFORMED, ORIGIN, _NEAR)]
    malformed = F.col(MALFORMED) if MALFORMED in stored.columns else F.lit(False)
    counts = [F.count("*").alias(_COPIES), F.count_if(malformed).alias(_MALFORMED_COPIES)]
    # The least of some texts is found by sorting whole rows, so only where there are any.
    named = ORIGIN in stored.columns
    if named:
        counts.append(F.min(ORIGIN).alias(_FILE))
    near = F.col(f"`{_NEAR}`")
    partitions = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_order = heavy_keys(stored, near, partitions).isEmpty()
    # Half of the cells are read on either side, so that the code of both stays small enough.
    first = {c for c in rules if c in (*DATE_COLUMNS, *NUMBER_COLUMNS, "order_id", "product_id")}

    def folded(share: Column) -> DataFrame:
        rows = stored.filter(share)
        if by_order:
            dealt = _with_rules(rows, {c: r for c, r in rules.items() if c in first}).repartition(near)
            lines = _with_rules(dealt, {c: r for c, r in rules.items() if c not in first})
            found = lines.groupBy(near, *(f"`{c}`" for c in columns)).agg(*counts).drop(_NEAR)
        else:
            found = _with_rules(rows, rules).groupBy(*(f"`{c}`" for c in columns)).agg(*counts)
        return found if named else found.withColumn(_FILE, F.lit(None).cast("string"))

    return [folded(share) for share in in_rounds(stored, near)]


def _declared(distinct: DataFrame, scale: str) -> DataFrame:
    """Distinct rows scaled, with derived measures and declared types."""
    return _measured(distinct, scale).transform(apply_types)


def finished(distinct: DataFrame, scale: str = "auto", spread: bool = False) -> DataFrame:
    """Cleaned, typed, numbered order lines from ``distinct_lines``.

    A line whose required value is missing, or too large for its column, is left out.
    The numbered lines are written once; dimensions and fact read them back. For ``spread``
    see ``add_customer_key``.
    """
    keyed = "customer_id" in distinct.columns
    named = "customer_name" in distinct.columns
    lines = _declared(distinct, scale).drop(_COPIES, _MALFORMED_COPIES, _FILE)
    lines = number_lines(lines, drop_incomplete)
    if keyed:
        return lines
    if named:
        return add_customer_key(lines, spread)
    return add_customer_key(lines.drop("customer_name"), spread).withColumn(
        "customer_name", F.lit(None).cast("string")
    )


def audited(distinct: DataFrame, scale: str = "auto") -> DataFrame:
    """One row over ``distinct_lines``: rows in, malformed, exact duplicates, incomplete, out.

    Incomplete are distinct rows that ``finished`` leaves out: a required value is
    missing or does not fit its column.
    """
    lines = _declared(distinct, scale)
    gap = reduce(Column.__or__, (F.col(c).isNull() for c in REQUIRED_COLUMNS))
    rows_in, rows = F.coalesce(F.sum(_COPIES), F.lit(0)), F.count("*")
    return lines.agg(
        rows_in.alias("rows_in"),
        F.coalesce(F.sum(_MALFORMED_COPIES), F.lit(0)).alias("malformed_rows"),
        (rows_in - rows).alias("exact_duplicates"),
        F.count_if(gap).alias("incomplete_rows"),
        (rows - F.count_if(gap)).alias("rows_out"),
    )


def rejected(distinct: DataFrame, scale: str = "auto") -> DataFrame:
    """What ``finished`` leaves out of ``distinct_lines``, with its reason and the file it came from.

    reason, detail, rows, file, then the row as it was read. ``duplicate`` counts the further copies
    of a row; ``incomplete`` names in ``detail`` the required columns without a value, with ``(range)``
    behind those whose value does not fit. Rows by reason add up to the counts of ``audited``. A row
    that several files hold names the first of them; without origins ``file`` is NULL.
    """
    measured = _measured(distinct, scale)
    kinds = {f.name: f.dataType for f in CLEAN_LINE}
    parts = []
    for c in REQUIRED_COLUMNS:
        fits = typed(F.col(c), kinds[c]).isNotNull()
        parts.append(F.when(F.col(c).isNull(), c).when(~fits, f"{c} (range)"))
    gaps = F.array_compact(F.array(*parts))

    def entry(reason: str, detail: Column, rows: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), detail.alias("detail"), rows.alias("rows"))

    copies = F.when(
        F.col(_COPIES) > 1, entry("duplicate", F.lit(None).cast("string"), F.col(_COPIES) - 1)
    )
    incomplete = F.when(
        F.size(gaps) > 0, entry("incomplete", F.array_join(gaps, ","), F.lit(1).cast("bigint"))
    )
    left_out = F.explode(F.array_compact(F.array(copies, incomplete))).alias("_why")
    shown = [c for c in distinct.columns if c not in (_COPIES, _MALFORMED_COPIES, _FILE)]
    return measured.select(left_out, F.col(f"`{_FILE}`").alias("file"), *(f"`{c}`" for c in shown)).select(
        "_why.*", "file", *(f"`{c}`" for c in shown)
    )


def clean(raw: DataFrame, scale: str = "auto", **options) -> DataFrame:
    """``finished`` lines of a raw export. The distinct lines are deleted once the numbered ones are written."""
    with noted() as folders:
        distinct = distinct_lines(raw, **options)
    try:
        return finished(distinct, scale)
    finally:
        for folder in folders:
            delete(raw.sparkSession, folder)


def cleaning_audit(raw: DataFrame, scale: str = "auto", **options) -> DataFrame:
    """``audited`` counts of a raw export. Share ``distinct_lines`` to clean it as well."""
    return audited(distinct_lines(raw, **options), scale)
