"""One small input per cleaning rule."""

import datetime as dt
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll import catalogue
from tillroll.operators import cleaning as c
from tillroll.operators.quality import range_check
from tillroll.schemas import CLEAN_LINE
from tillroll.sources import mapped, raw_csv
from tillroll.sources.scratch import written

HEADER = ["Order ID", "Order Date", "Product ID", "Sales", "Quantity"]
LINE = ["o1", "1/2/2024", "p1", "10", "1"]


def export(spark, rows, header=HEADER):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def test_header_forms(spark):
    df = spark.createDataFrame(
        [("a", "b", "c", "d", "e")],
        [" Sub-Category ", "Order  ID", "Product-Name!", "Sale Price", "Extra (x)"],
    )
    assert c.standard_names(df).columns == [
        "sub_category", "order_id", "product_name", "sales", "extra_x",
    ]


def test_alias_of_the_caller(spark):
    df = export(spark, [("o",)], ["Bestellnummer"])
    assert c.standard_names(df, {"bestellnummer": "order_id"}).columns == ["order_id"]


def test_two_headers_for_one_column_raise(spark):
    with pytest.raises(ValueError, match="sales"):
        c.standard_names(export(spark, [("1", "2")], ["Sales", "Sale Price"]))


TOKEN_CELLS = [
    "Not Available", "not available", "unknown", "Unknown", "N/A", "NA", "", "NULL", "None",
    " N/A ", " ", "UNKNOWN",
]


def _segments(spark, **options):
    rows = [[*LINE, cell, str(i)] for i, cell in enumerate(TOKEN_CELLS)]
    df = c.parsed(export(spark, rows, [*HEADER, "Segment", "N"]), **options)
    return [r["segment"] for r in sorted(df.collect(), key=lambda r: int(r["n"]))]


def test_tokens_are_whole_trimmed_cells_and_case_sensitive(spark):
    assert _segments(spark) == [None] * 11 + ["UNKNOWN"]


def test_strict_order_keeps_padded_tokens(spark):
    assert _segments(spark, strict_order=True) == [None] * 9 + ["N/A", None, "UNKNOWN"]


def test_tokens_of_the_caller_reach_numbers_and_dates(spark):
    rows = [["o1", "1/1/1900", "p1", "-999", "1"], LINE]
    df = c.parsed(export(spark, rows), tokens=[*c.ALL_TOKENS, "-999", "1/1/1900"])
    assert sorted(column(df, "sales"), key=str) == [10.0, None]
    assert sorted(column(df, "order_date"), key=str) == [dt.date(2024, 1, 2), None]


def test_text_is_stripped_of_any_white_space(spark):
    df = export(spark, [("\t　 a b \r\n",), ("plain",), ("  ",)], ["City"])
    assert column(c.trim_text(df), "City") == ["a b", "plain", None]


NUMBERS = {
    "1e3": 1000.0, " 12 ": 12.0, ".5": 0.5, "5.": 5.0, "-3.25": -3.25, "+1": 1.0, "1E-400": 0.0,
    "1,234": None, "$1": None, "12d": None, "3F": None, "nan": None, "NaN": None, "inf": None,
    "-Infinity": None, "1e999": None, "0x1p3": None, "": None, "1 2": None, None: None,
}


def test_numbers(spark):
    rows = [[text, str(i)] for i, text in enumerate(NUMBERS)]
    parsed = c.parse_numbers(export(spark, rows, ["sales", "n"])).collect()
    assert {list(NUMBERS)[int(r["n"])]: r["sales"] for r in parsed} == NUMBERS


DATES = {
    "11/8/2016": dt.date(2016, 11, 8), " 1/02/2016 ": dt.date(2016, 1, 2),
    "2016-11-08": dt.date(2016, 11, 8), "13/9/2016": None, "2/30/2016": None, "11/8/16": None,
    "2016-13-01": None, "not a date": None, "": None, None: None, "1/2/2016x": None,
}


def test_dates(spark):
    rows = [[text, str(i)] for i, text in enumerate(DATES)]
    parsed = c.parse_dates(export(spark, rows, ["order_date", "n"])).collect()
    assert {list(DATES)[int(r["n"])]: r["order_date"] for r in parsed} == DATES


def test_day_first_format_of_the_caller(spark):
    df = export(spark, [("13/9/2016",)], ["order_date"])
    assert column(c.parse_dates(df, ["d/M/yyyy"]), "order_date") == [dt.date(2016, 9, 13)]


@pytest.mark.parametrize(
    ("values", "scale", "want"),
    [
        ([0.1, 0.3], "auto", [0.1, 0.3]),
        ([0.5, 1.0], "auto", [0.5, 1.0]),
        ([0.5, 30.0], "auto", [0.005, 0.3]),
        ([None, None], "auto", [None, None]),
        ([0.5, 1.0], "percent", [0.005, 0.01]),
        ([0.5, 30.0], "fraction", [0.5, 30.0]),
    ],
)
def test_discount_scale(spark, values, scale, want):
    df = spark.createDataFrame([(v,) for v in values], "discount double")
    assert column(c.normalise_discount(df, scale), "discount") == want


def test_unknown_discount_scale_raises(spark):
    with pytest.raises(ValueError, match="permille"):
        c.normalise_discount(spark.createDataFrame([(1.0,)], "discount double"), "permille")


def test_sales_and_profit_are_derived(spark):
    header = [*HEADER[:3], "Quantity", "List Price", "cost price", "Discount Percent"]
    rows = [
        [*LINE[:3], "2", "100", "80", "10"],
        [*LINE[:3], "3", "10", "8", None],
    ]
    got = c.parsed(export(spark, rows, header)).orderBy("quantity").collect()
    assert [(r["sales"], r["profit"]) for r in got] == [(180.0, 20.0), (30.0, 6.0)]


def test_present_sales_are_not_derived(spark):
    df = c.parsed(export(spark, [[*LINE, "99"]], [*HEADER, "List Price"]))
    assert column(df, "sales") == [10.0] and "profit" not in df.columns


def test_profit_without_sales_raises(spark):
    df = spark.createDataFrame([(1.0, 1.0)], ["cost_price", "quantity"])
    with pytest.raises(ValueError, match="sales"):
        c.derive_profit(df)


def test_missing_required_columns_raise(spark):
    with pytest.raises(ValueError, match="product_id.*found"):
        c.clean(export(spark, [["o", "1/1/2024"]], HEADER[:2]))


def test_duplicates_and_incomplete_rows_and_audit(spark):
    rows = [
        LINE,
        LINE,
        [*LINE[:3], "10.0", "1"],
        [*LINE[:3], "bad", "1"],
        [*LINE[:3], "worse", "1"],
        ["N/A", *LINE[1:]],
        ["o2", *LINE[1:]],
    ]
    raw = export(spark, rows)
    audit = c.cleaning_audit(raw).first().asDict()
    assert audit == {
        "rows_in": 7,
        "malformed_rows": 0,
        "exact_duplicates": 3,
        "incomplete_rows": 2,
        "rows_out": 2,
    }
    assert sorted(column(c.clean(raw), "order_id")) == ["o1", "o2"]


def test_cleaning_and_audit_share_one_reading(spark, folder):
    """Jobs that scan the export: one, whatever is derived from it afterwards."""
    from tillroll.sources.mapped import raw_export

    distinct = c.distinct_lines(raw_export(spark, folder))
    for df in (c.finished(distinct), c.audited(distinct)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan and "LogicalRDD" not in plan
    audit = c.audited(distinct).first()
    assert c.finished(distinct).count() == audit["rows_out"] < audit["rows_in"]


def test_unused_cells_are_not_parsed(spark):
    cells = c.read_cells(c.standard_names(export(spark, [LINE]))).select("order_id")
    assert "sales" not in cells._jdf.queryExecution().optimizedPlan().toString()


def test_row_id_defeats_duplicate_removal(spark):
    raw = export(spark, [[*LINE, "1"], [*LINE, "2"]], [*HEADER, "Row ID"])
    assert c.clean(raw).count() == 2


def test_audit_of_nothing(spark):
    assert list(c.cleaning_audit(export(spark, [])).first()) == [0, 0, 0, 0, 0]


def test_absent_columns_become_typed_nulls(spark):
    got = c.clean(export(spark, [LINE]))
    assert set(CLEAN_LINE.names) | {"order_line_id"} == set(got.columns)
    assert dict(got.dtypes)["ship_date"] == "date"
    assert dict(got.dtypes)["discount"] == "decimal(5,4)"
    row = got.first()
    assert row["ship_date"] is None and row["discount"] is None and row["city"] is None


def test_declared_types_round_half_up_and_lines_that_do_not_fit_are_left_out(spark):
    rows = [["o1", "1/2/2024", "p", "0.145", "2.5"], ["o2", "1/2/2024", "p", "99999999999", "1"]]
    raw = export(spark, rows)
    got = c.clean(raw).orderBy("order_id").collect()
    assert [(r["sales"], r["quantity"]) for r in got] == [(Decimal("0.15"), 3)]
    assert list(c.cleaning_audit(raw).first()) == [2, 0, 0, 1, 1]
    out_of_range = {r[0]: r[1] for r in range_check(c.parsed(raw)).collect()}
    assert out_of_range == {"sales": 1, "quantity": 0}


def test_postal_code_keeps_its_zero(spark):
    assert column(c.clean(export(spark, [[*LINE, "05408"]], [*HEADER, "Postal Code"])),
                  "postal_code") == ["05408"]


def test_line_numbers_follow_the_order_date(spark):
    rows = [["o1", "3/1/2024", "p", "1", "1"], ["o2", "1/1/2024", "p", "1", "1"]]
    got = c.clean(export(spark, rows)).orderBy("order_line_id").collect()
    assert [(r["order_line_id"], r["order_id"]) for r in got] == [(1, "o2"), (2, "o1")]


def test_customer_key_from_names(spark):
    names = ["b", None, "a", "b"]
    rows = [[f"o{i}", f"1/{i + 1}/2024", "p", "1", "1", n] for i, n in enumerate(names)]
    got = c.clean(export(spark, rows, [*HEADER, "Customer Name"])).orderBy("order_id")
    assert column(got, "customer_id") == ["C000000", "C-00001", "C000001", "C000000"]


def test_customer_key_from_orders(spark):
    rows = [["o9", *LINE[1:]], ["o9", "1/3/2024", *LINE[2:]], ["o1", "1/4/2024", *LINE[2:]]]
    got = c.clean(export(spark, rows)).orderBy("order_date")
    assert column(got, "customer_id") == ["C000000", "C000000", "C000001"]
    assert column(got, "customer_name") == [None] * 3


def test_cleaning_is_idempotent(spark, folder):
    from tillroll.sources.mapped import raw_export

    once = c.clean(raw_export(spark, folder)).drop("order_line_id")
    text = once.select(*(once[n].cast("string") for n in once.columns))
    twice = c.clean(text, scale="fraction").drop("order_line_id")
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_dates_of_formats_that_share_a_prefix(spark):
    rows = [("1/2/2024 10:30", 1), ("1/2/2024", 2), ("1/2/24", 3)]
    df = export(spark, rows, ["order_date", "n"])
    day = dt.date(2024, 1, 2)
    parsed = c.parse_dates(df, ["M/d/yyyy", "M/d/yyyy HH:mm"]).orderBy("n").collect()
    assert [r["order_date"] for r in parsed[:2]] == [day, day]
    parsed = c.parse_dates(df, ["M/d/yy", "M/d/yyyy"]).orderBy("n").collect()
    assert [r["order_date"] for r in parsed] == [None, day, day]


def test_number_with_suffix_and_white_space(spark):
    rows = [("12d\t", 1), ("12f\n", 2), ("12\t", 3)]
    parsed = c.parse_numbers(export(spark, rows, ["sales", "n"])).orderBy("n").collect()
    assert [r["sales"] for r in parsed] == [None, None, 12.0]


def test_rejects_name_their_reason_and_file(spark, tmp_path):
    head = "Order ID,Order Date,Product ID,Sales,Quantity,City\n"
    (tmp_path / "a.csv").write_text(head + "o1,1/1/2024,p,1,1,x\no1,1/1/2024,p,1,1,x\nN/A,never,p,1,1,y\n")
    (tmp_path / "b.csv").write_text(head + "o2,1/1/2024,p,99999999999,1,x\no3,1/1/2024,p,1,3e9,z,surplus\n,,,,,\n")
    for multiline in (False, True):
        raw = raw_csv.read_raw(spark, str(tmp_path), multiline, origin=True)
        distinct = c.distinct_lines(raw)
        rows = c.rejected(distinct).collect()
        got = sorted((r["reason"], r["detail"] or "", r["rows"], r["file"][-5:]) for r in rows)
        assert got == [
            ("duplicate", "", 1, "a.csv"),
            ("incomplete", "order_id,order_date", 1, "a.csv"),
            ("incomplete", "order_id,order_date,product_id,sales,quantity", 1, "b.csv"),
            ("incomplete", "quantity (range)", 1, "b.csv"),
            ("incomplete", "sales (range)", 1, "b.csv"),
        ]
        counts = c.audited(distinct).first()
        assert (counts["exact_duplicates"], counts["incomplete_rows"], counts["rows_out"]) == (1, 4, 1)
        lines = c.finished(distinct)
        assert lines.count() == 1 and not {"_origin", "#file", "_malformed"} & set(lines.columns)


def test_rejects_without_origins_and_of_an_empty_export(spark):
    schema = "`Order ID` string, `Order Date` string, `Product ID` string, Sales string, Quantity string"
    raw = spark.createDataFrame([("o", None, "p", "1", "1")], schema)
    row = c.rejected(c.distinct_lines(raw)).first()
    assert (row["reason"], row["detail"], row["file"], row["order_id"]) == ("incomplete", "order_date", None, "o")
    assert c.rejected(c.distinct_lines(raw.limit(0))).count() == 0


def test_cells_are_read_by_compiled_code_and_copies_folded_without_a_sort(spark, folder, monkeypatch, capsys):
    folded = []
    monkeypatch.setattr(c, "written", lambda df, label: folded.append(df) or df)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        c.distinct_lines(mapped.raw_export(spark, folder))
        folded[0].explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    shown = capsys.readouterr().out
    # The JVM compiles methods of up to 8,000 bytes; larger ones are interpreted.
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", shown))) <= 8000
    assert "HashAggregate" in shown and "SortAggregate" not in shown


def test_dates_of_formats_with_optional_and_quoted_parts(spark):
    df = export(spark, [("2024", "1"), ("2024-05-06", "2")], ["order_date", "n"])
    parsed = c.parse_dates(df, ["yyyy[-MM-dd]"]).orderBy("n").collect()
    assert [r["order_date"] for r in parsed] == [dt.date(2024, 1, 1), dt.date(2024, 5, 6)]
    parsed = c.parse_dates(df, ["yyyy-MM-dd", "yyyy"]).orderBy("n").collect()
    assert [r["order_date"] for r in parsed] == [dt.date(2024, 1, 1), dt.date(2024, 5, 6)]


def test_white_space_of_any_kind_is_stripped_at_either_end(spark):
    cells = ["\u00a0x", "x\u2009", "\u3000\u00e9\u0085", "\u00e9", "\x1fx\x0b", " N/A ", "\u2003unknown\t", "a longer text "]
    lines = c.read_cells(export(spark, [[v, str(i)] for i, v in enumerate(cells)], ["city", "n"]))
    got = [r["city"] for r in lines.orderBy("n").collect()]
    assert got == ["x", "x", "\u00e9", "\u00e9", "x", None, None, "a longer text"]


@pytest.mark.parametrize("target", [CLEAN_LINE["sales"].dataType, CLEAN_LINE["discount"].dataType, CLEAN_LINE["quantity"].dataType])
def test_types_by_whole_units_equal_a_rounding_cast(spark, target):
    odd = [0.125, 1.005, -1.005, 2.675, 0.285, 0.00005, 9.99995, 99999.5, 2.5, -0.5, -0.004, 8589934591.995, 9999999999.99,
           9999999999.995, 2147483647.4, 2147483647.5, 1e300, float("inf"), float("nan"), None]
    values = [(v,) for v in odd] + [(i * 0.005 + j * 0.01 * (1 - 0.04 * j),) for i in range(-300, 2_000) for j in range(3)]
    df = spark.createDataFrame(values, "v double")
    cast = F.round("v") if target.typeName() == "integer" else F.col("v")
    found = df.select("v", c.typed(F.col("v"), target).alias("got"), cast.try_cast(target).alias("want"))
    assert found.filter("not (got <=> want)").collect() == []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in plan.lower()


def test_ends_are_looked_at_by_the_last_byte(spark):
    # Letters whose last byte equals that of a wide space, ends of every kind, and a lone blank.
    cells = ["x\u00a0", "\u00e0", "\u0160", "a\u2028", "a\x7f", "a~", "a!", "\x85", "\u3000", " ", "a\U0001f600 "]
    lines = c.read_cells(export(spark, [[v, str(i)] for i, v in enumerate(cells)], ["city", "n"])).orderBy("n")
    got = {r["n"]: r["city"] for r in lines.collect()}
    assert [got[str(i)] for i in range(len(cells))] == [v.strip() or None for v in cells]


def test_batches_by_order_date_make_the_text_of_the_date_once_and_lose_no_row(spark, folder, monkeypatch):
    batches = []
    monkeypatch.setattr(catalogue.cleaning, "clean", lambda raw, scale: batches.append(raw) or raw)
    monkeypatch.setattr(catalogue.star, "build_star", lambda lines: lines)
    raw = mapped.raw_export(spark, folder)
    catalogue._two_batches(raw)
    for batch in batches:
        plan = batch._jdf.queryExecution().optimizedPlan().toString()
        pushed = [line.count("date_format") for line in plan.splitlines() if "Filter" in line]
        # One for each of the two formats that dates are written in.
        assert max(pushed) == 2
    texts = [None, "not a date", "5/31/1995", "6/1/1995", " 1995-05-31 ", "1995-06-01"]
    batches.clear()
    catalogue._two_batches(export(spark, [[text] for text in texts], ["Order Date"]))
    early, late = ({r[0] for r in batch.collect()} for batch in batches)
    assert early == {"5/31/1995", " 1995-05-31 "}
    assert late == {None, "not a date", "6/1/1995", "1995-06-01"}


@pytest.mark.parametrize("busy", [False, True])
def test_copies_are_folded_by_order_and_a_busy_order_by_all_columns(spark, monkeypatch, busy):
    plans = []
    monkeypatch.setattr(c, "written", lambda df, label: plans.append(df) or written(df, label))
    rows = []
    for i in range(600):
        order = "walk-in" if busy and i % 2 else [f" o{i % 150} ", "N/A", None][0 if i % 10 else 1 + i % 20 // 10]
        rows += [(order, "1/2/2024", f"p{i % 40}", "1", str(i % 3), [None, " x"][i % 2])] * (1 + i % 3)
    columns = ["Order ID", "Order Date", "Product ID", "Sales", "Quantity", "City"]
    raw = export(spark, rows, columns).repartition(4)
    found = c.distinct_lines(raw).select("order_id", "product_id", "quantity", "city", "`#copies`").collect()
    tidy = Counter((None if r[0] in ("N/A", None) else r[0].strip(), r[2], float(r[4]), r[5] and "x") for r in rows)
    assert Counter({tuple(r)[:4]: r[4] for r in found}) == tidy and len(found) == len(tidy)
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert ("hashpartitioning(#near" in plan) != busy
