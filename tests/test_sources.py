"""CSV forms, round trips, append, layout and SQL over the views."""

import datetime as dt
import random
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_star_and_quality import line, small_star
from tillroll.operators.cleaning import MALFORMED, clean, cleaning_audit
from tillroll.operators.star import build_star
from tillroll.plans import analysis, views
from tillroll.sources import raw_csv, scratch, tables
from tillroll.sources.mapped import raw_export
from tillroll.sources.scratch import checkpoint_folder, discarded, written


def _file(folder, text, name="raw.csv"):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_quotes_line_breaks_and_bad_bytes(spark, tmp_path):
    path = _file(tmp_path, b'a,b\n"He said ""hi"", ok","two\nlines"\ncaf\xe9,x\n')
    rows = [tuple(r)[:2] for r in raw_csv.read_raw(spark, path, multiline=True).collect()]
    assert rows == [('He said "hi", ok', "two\nlines"), ("caf�", "x")]


def test_wide_and_short_rows_are_kept_and_marked(spark, tmp_path):
    path = _file(tmp_path, "a,b\n1,2\n1,2,3\n1\n")
    rows = [tuple(r) for r in raw_csv.read_raw(spark, path, multiline=True).collect()]
    assert rows == [("1", "2", False), ("1", "2", True), ("1", None, True)]


def test_malformed_rows_are_audited_and_cleaned(spark, tmp_path):
    text = "Order ID,Order Date,Product ID,Sales,Quantity\n"
    text += "o1,1/1/2024,p,1,1\no1,1/1/2024,p,1,1,surplus\no2,1/1/2024,p\n"
    raw = raw_csv.read_raw(spark, _file(tmp_path, text), multiline=True)
    assert list(cleaning_audit(raw).first()) == [3, 2, 1, 1, 1]
    lines = clean(raw)
    assert lines.count() == 1 and MALFORMED not in lines.columns


def test_repeated_header_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="Sales"):
        raw_csv.read_raw(spark, _file(tmp_path, "Sales,Sales\n1,2\n"), multiline=True)


def test_several_files_and_a_different_header(spark, tmp_path):
    _file(tmp_path, "a,b\n1,2\n", "one.csv")
    _file(tmp_path, "a,b\n3,4\n", "two.csv")
    assert raw_csv.read_raw(spark, str(tmp_path), multiline=True).count() == 2
    _file(tmp_path, "b,a\n4,3\n", "zzz.csv")
    with pytest.raises(Exception, match="header"):
        raw_csv.read_raw(spark, str(tmp_path), multiline=True).collect()


def test_find_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw_csv.find_input(spark, str(tmp_path))
    for name in ("b.csv", "a.csv", "0.txt"):
        _file(tmp_path, f"x\n{name}\n", name)
    path = raw_csv.find_input(spark, str(tmp_path))
    rows = raw_csv.read_raw(spark, path, multiline=False).collect()
    assert sorted(r["x"] for r in rows) == ["a.csv", "b.csv"]
    explicit = str(tmp_path / "b.csv")
    assert raw_csv.find_input(spark, str(tmp_path), explicit) == explicit


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_raw_file_to_reports_from_stored_tables(spark, folder, tmp_path, fmt):
    raw = raw_export(spark, folder)
    raw.write.csv(str(tmp_path / "raw"), header=True, escape='"')
    star = build_star(clean(raw_csv.read_raw(spark, str(tmp_path / "raw"), multiline=True)))
    rows = tables.write_star(star, str(tmp_path / "star"), fmt)
    stored = tables.read_star(spark, str(tmp_path / "star"), fmt)
    assert rows == {name: t.count() for name, t in stored.tables().items()}
    for name, table in build_star(clean(raw)).tables().items():
        back = stored.tables()[name].select(*table.columns)
        assert back.exceptAll(table).isEmpty() and table.exceptAll(back).isEmpty(), name
    want = analysis.discount_margin(star).collect()
    assert analysis.discount_margin(stored).collect() == want
    views.register_views(stored)
    sums = "select sum(order_lines) from (select count(*) order_lines from {} group by region)"
    total = tables.query(spark, sums.format("vw_order_lines_enriched")).first()[0]
    assert total == tables.line_count(stored)
    months = tables.query(spark, "select sum(total_sales) from vw_monthly_sales_summary")
    assert months.first()[0] == star.lines.agg(F.sum("sales")).first()[0]


def test_refresh_replaces_and_append_adds(spark, tmp_path):
    star = small_star(spark, [line(1), line(2)])
    path = str(tmp_path / "star")
    tables.write_star(star, path)
    tables.write_star(star, path)
    assert tables.line_count(tables.read_star(spark, path)) == 2
    tables.write_star(small_star(spark, [line(3)]), path, mode="append")
    assert tables.line_count(tables.read_star(spark, path)) == 3


def test_append_continues_keys_and_merges_dimensions(spark, tmp_path):
    def batch(rows):
        names = ["Order ID", "Order Date", "Product ID", "Sales", "Quantity", "Region", "Customer Name"]
        raw = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
        return build_star(clean(raw))

    first = batch([("1", "1/2/2024", "p1", "100", "1", "West", "Ann"), ("2", "1/3/2024", "p2", "50", "1", "East", "Bob")])
    second = batch([("3", "2/2/2024", "p1", "5", "1", "West", "Bob"), ("4", "2/3/2024", "p3", "10", "1", "South", "Cy")])
    path = str(tmp_path / "star")
    tables.write_star(first, path)
    tables.write_star(second, path, mode="append", made_customers=True)
    star = tables.read_star(spark, path)
    joined = star.lines.join(star.locations, "location_id").join(star.customers, "customer_id")
    sums = {r["region"]: int(r["s"]) for r in joined.groupBy("region").agg(F.sum("sales").alias("s")).collect()}
    assert sums == {"West": 105, "East": 50, "South": 10}
    names = {r["customer_name"]: int(r["s"]) for r in joined.groupBy("customer_name").agg(F.sum("sales").alias("s")).collect()}
    assert names == {"Ann": 100, "Bob": 55, "Cy": 10}
    assert sorted(r["order_line_id"] for r in star.lines.collect()) == [1, 2, 3, 4]
    assert [t.count() for t in star.tables().values()] == [3, 3, 3, 4]


def test_catalog_tables(spark):
    spark.sql("create database if not exists shop")
    star = small_star(spark, [line(1)])
    tables.save_tables(star, "shop", "overwrite")
    tables.save_tables(small_star(spark, [line(2)]), "shop", "append")
    assert spark.table("shop.fact_order_lines").count() == 2


def test_bucketed_tables_join_customers_without_exchange(spark):
    """Also after an append; sums by customer as over the plain tables."""

    def joined(database):
        star = tables.read_tables(spark, database)
        return star.lines.join(star.customers, "customer_id").groupBy("customer_id").agg(F.sum("sales").alias("s"))

    for database, buckets in (("plain", None), ("parted", 4)):
        spark.sql(f"create database if not exists {database}")
        people = [(f"C{k}", f"name {k}", "Home") for k in (0, 1, 2, 9)]
        first = small_star(spark, [line(k, f"C{k % 3}") for k in range(1, 8)], people[:3])
        tables.save_tables(first, database, "overwrite", buckets=buckets)
        more = small_star(spark, [line(9, "C9"), line(10, "C1")], people)
        tables.save_tables(more, database)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {d: joined(d)._jdf.queryExecution().executedPlan().toString() for d in ("plain", "parted")}
        assert "Exchange" in plans["plain"] and "Exchange" not in plans["parted"]
        rows = [sorted(tuple(r) for r in joined(d).collect()) for d in plans]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows[0] == rows[1] and [key for key, _ in rows[0]] == ["C0", "C1", "C2", "C9"]
    with pytest.raises(ValueError, match="4 buckets"):
        tables.save_tables(first, "parted", buckets=8)


def test_date_filter_skips_years(spark, tmp_path):
    star = small_star(spark, [line(1), line(2, day=dt.date(2023, 5, 1))])
    tables.write_star(star, str(tmp_path / "star"))
    folders = {p.name for p in (tmp_path / "star" / "fact_order_lines").iterdir() if p.is_dir()}
    assert {"order_year=2023", "order_year=2024"} <= folders


def test_scan_reads_only_what_a_report_needs(spark, tmp_path):
    tables.write_star(small_star(spark, [line(1)]), str(tmp_path / "star"))
    stored = tables.read_star(spark, str(tmp_path / "star"), complete=True)
    plan = analysis.discount_margin(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(discount)]" in plan
    assert plan.count("Scan parquet") == 1 and "ship_mode" not in plan


def test_checkpoint_folder_is_the_session_setting(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_tables_can_be_discarded(spark):
    shared = Path(checkpoint_folder(spark))
    shared.mkdir(parents=True, exist_ok=True)
    before = set(shared.iterdir())
    with discarded(spark):
        assert written(spark.range(3), "three").count() == 3
        assert set(shared.iterdir()) > before
    assert set(shared.iterdir()) == before


def _shuffle_files(spark):
    blocks = spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}


def test_a_stored_table_leaves_no_shuffle_files_and_no_setting_behind(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(setting), _shuffle_files(spark)
    table = written(spark.range(10_000).repartition(5, "id").groupBy("id").count(), "counts")
    assert spark.conf.get(setting) == before
    # Spark removes them in the background.
    deadline = time.time() + 20
    while time.time() < deadline and _shuffle_files(spark) - files:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - files
    assert table.count() == 10_000


def test_cleaning_leaves_only_the_numbered_lines_on_disk(spark, folder):
    shared = Path(checkpoint_folder(spark))
    before = set(shared.iterdir()) if shared.exists() else set()
    lines = clean(raw_export(spark, folder))
    assert [path.name.split("-")[0] for path in set(shared.iterdir()) - before] == ["numbered"]
    assert lines.count() == lines.select("order_line_id").distinct().count() > 0


def test_large_tables_are_shuffled_in_rounds_with_the_same_result(spark, folder, monkeypatch):
    plain = clean(raw_export(spark, folder))
    monkeypatch.setattr(scratch, "ROUND_BYTES", 0)
    with scratch.noted() as folders:
        rounds = clean(raw_export(spark, folder))
    names = [Path(path).name.split("-")[0] for path in folders]
    assert names == ["numbered"] * 2
    assert rounds.exceptAll(plain).isEmpty() and rounds.count() == plain.count()
    table = written(spark.sql("select * from values (1), (2), (3), (null), (null) as t(k)"), "keys")
    shares = scratch.in_rounds(table, F.col("k"))
    assert sum(table.filter(share).count() for share in shares) == 5
    assert sorted(table.filter(share).filter("k is null").count() for share in shares) == [0, 2]


@pytest.mark.parametrize("plan", [views.enriched, views.dashboard_base, lambda star, **o: views.enriched(star, spread=True, **o)])
def test_views_stored_between_joins_hold_the_same_lines(spark, plan):
    star = small_star(spark, [line(i, customer_id=["c1", "nobody", None][i % 3]) for i in range(9)])
    with scratch.noted() as folders:
        stored = plan(star, stored=True)
    labels = [Path(path).name.rsplit("-", 1)[0] for path in folders]
    assert [label for label in labels if label != "heavy-keys"] == ["joined-dimension", "joined-lines", "joined-dimension"]
    plain = plan(star)
    assert stored.columns == plain.columns
    assert stored.exceptAll(plain).isEmpty() and stored.count() == plain.count() > 0


def test_what_is_cheap_to_make_does_not_travel_through_the_joins(spark, folder):
    for frame, names in [
        (raw_export(spark, folder), ["List Price", "cost price", "Product ID", "Customer ID", "Order ID", "City"]),
        (views.dashboard_base(small_star(spark, [line(1)])), ["margin"]),
    ]:
        plan = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        first = min(i for i, text in enumerate(plan) if "Join" in text)
        for name in names:
            assert [i for i, text in enumerate(plan) if f" AS {name}#" in text and i < first]
            assert not [i for i, text in enumerate(plan) if f" AS {name}#" in text and i > first]


def _nameless(spark, rows):
    names = ["Order ID", "Order Date", "Product ID", "Sales", "Quantity", "Region"]
    raw = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    return build_star(clean(raw))


def test_append_keeps_customers_made_from_orders_apart(spark, tmp_path):
    path = str(tmp_path / "star")
    first = [("1", "1/2/2024", "p1", "100", "1", "West"), ("2", "1/3/2024", "p2", "50", "1", "East")]
    second = [("2", "2/1/2024", "p3", "7", "1", "East"), ("3", "2/2/2024", "p1", "5", "1", "West"),
              ("4", "2/3/2024", "p3", "10", "1", "South")]
    tables.write_star(_nameless(spark, first), path)
    tables.write_star(_nameless(spark, second), path, mode="append", made_customers=True)
    star = tables.read_star(spark, path)
    owners = {(r["order_id"], r["customer_id"]) for r in star.lines.collect()}
    assert owners == {("1", "C000000"), ("2", "C000001"), ("3", "C000002"), ("4", "C000003")}
    assert sorted(r["customer_id"] for r in star.customers.collect()) == sorted(c for _, c in owners)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_batch_can_be_repeated_and_resumed(spark, tmp_path, monkeypatch, fmt):
    path = str(tmp_path / "star")
    first = [("1", "1/2/2024", "p1", "100", "1", "West"), ("2", "1/3/2024", "p2", "50", "1", "East")]
    second = [("3", "2/2/2024", "p1", "5", "1", "West"), ("4", "2/3/2024", "p3", "10", "1", "South")]
    tables.write_star(_nameless(spark, first), path, fmt)
    batch = _nameless(spark, second)

    def append():
        return tables.write_star(batch, path, fmt, "append", made_customers=True, batch="feb.1")

    real = tables._laid_out

    def failing(name, table, layout):
        if name == "fact_order_lines":
            raise RuntimeError("lost")
        return real(name, table, layout)

    monkeypatch.setattr(tables, "_laid_out", failing)
    with pytest.raises(RuntimeError):
        append()
    monkeypatch.undo()
    assert [t.count() for t in tables.read_star(spark, path, fmt).tables().values()] == [2, 2, 2, 2]
    want = {"dim_customer": 4, "dim_product": 3, "dim_location": 3, "fact_order_lines": 4}
    for _ in range(3):
        assert append() == want
    star = tables.read_star(spark, path, fmt)
    assert sorted(r["order_line_id"] for r in star.lines.collect()) == [1, 2, 3, 4]
    assert {r["rows"] for r in tables.committed_batches(spark, path).collect()} == {1, 2}
    tables.write_star(_nameless(spark, first), path, fmt)
    assert tables.line_count(tables.read_star(spark, path, fmt)) == 2
    for bad in ("", "../x", "_x", "a/b"):
        with pytest.raises(ValueError):
            tables.write_star(batch, path, fmt, "append", batch=bad)


def test_a_batch_of_catalog_tables_can_be_repeated_and_resumed(spark, monkeypatch):
    spark.sql("create database if not exists repeats")
    tables.save_tables(small_star(spark, [line(1)]), "repeats", "overwrite")
    batch = small_star(spark, [line(2)])
    for _ in range(2):
        tables.save_tables(batch, "repeats", "append", batch="b1")
    assert spark.table("repeats.fact_order_lines").count() == 2
    # The fact is written, but the end is not noted; then nothing is written at all.
    for failing, rows in (("fact_order_lines", 2), (None, 3)):
        real = tables._laid_out

        def lost(name, table):
            if name == failing:
                raise RuntimeError("lost")
            return real(name, table)

        monkeypatch.setattr(tables, "_laid_out", lost)
        try:
            tables.save_tables(batch, "repeats", "append", batch="b2")
        except RuntimeError:
            pass
        monkeypatch.undo()
        assert spark.table("repeats.fact_order_lines").count() == rows
    notes = spark.table("repeats.loaded_batches").filter("not done or batch <> 'b2'")
    notes.write.mode("overwrite").saveAsTable("repeats.kept_notes")
    spark.table("repeats.kept_notes").write.mode("overwrite").saveAsTable("repeats.loaded_batches")
    tables.save_tables(batch, "repeats", "append", batch="b2")
    assert spark.table("repeats.fact_order_lines").count() == 3


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "700")
    yield
    spark.conf.set(name, before)


AWKWARD = [
    'a,"x\ny",c', "p,q,r", '"he said ""hi""",2,"3\n\n4"', '5" disc,6,7', 'k,"l"m,n', ",,", 'z,"",""""',
    '"a,b\nc,""d""\n",e,"f"', 'u,v"w"x,"y\n"', "long," + "w" * 300 + ',"' + "x,\n" * 200 + '"', "short",
    "ä,ö\"ü,ß", '1,2,3,4', '"\r\n",b,c\r', '"q"\r', "",
]


@pytest.mark.parametrize("seed", range(2))
def test_multi_line_files_are_split_and_read_alike(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for name in ("one", "two"):
        rows = [rng.choice(AWKWARD) for _ in range(60)]
        ending = "" if seed % 2 else "\n"
        (tmp_path / f"{name}.csv").write_bytes(("A,B,C\n" + "\n".join(rows) + ending).encode())
    names = ["A", "B", "C"]
    whole = spark.read.options(multiLine=True, quote='"', escape='"', header=True, lineSep="\n").csv(
        str(tmp_path), schema="A string, B string, C string"
    )
    got = raw_csv.read_raw(spark, str(tmp_path), multiline=True)
    assert got.rdd.getNumPartitions() > 8
    want = [tuple(v.rstrip("\r") if v and v == r[-1] else v for v in r) for r in whole.collect()]
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(repr, want))


def test_a_quote_that_is_never_closed(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text("A,B\n1,2\n3,\"" + "open\n" * 300)
    rows = raw_csv.read_raw(spark, str(tmp_path), multiline=True).collect()
    assert len(rows) == 2 and max(len(r["B"]) for r in rows) >= 1499


@pytest.mark.parametrize("line, out, inside", [
    ("a,b", False, True), ('a,"b', True, False), ('"a"",b', True, False), ('a"b', False, False),
    ('5" x,"y"', False, False), ('""', False, True), ('"', True, False), ('x","y', True, True), ("", False, True),
])
def test_state_of_quotes_after_a_line(line, out, inside):
    assert raw_csv.open_after(line, False) is out
    assert raw_csv.open_after(line, True) is inside


def test_a_filter_on_each_clustered_column_reads_few_files(spark, tmp_path):
    rng = random.Random(6)
    rows = [
        line(i, product=f"p{rng.randrange(200):03d}", location=rng.choice([1] * 20 + list(range(40))),
             day=dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(300)))
        for i in range(6000)
    ]
    star = small_star(spark, rows)
    path = str(tmp_path / "star")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_star(star, path, layout="filters")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = tables.read_star(spark, path).lines
    assert stored.exceptAll(star.lines).isEmpty() and stored.count() == 6000
    files = [pq.read_metadata(f) for f in Path(path, "fact_order_lines").glob("*.parquet")]
    assert len(files) > 20

    def share(column, value):
        """Of all files those whose noted range holds the value."""
        found = 0
        for meta in files:
            groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
            stats = [g.column(i).statistics for g in groups for i in range(g.num_columns)
                     if g.column(i).path_in_schema == column]
            found += any(s.min <= value <= s.max for s in stats)
        return found / len(files)

    assert share("order_date", dt.date(2024, 3, 3)) < 0.6
    assert share("location_id", 30) < 0.6
    assert share("product_id", "p070") < 0.6
    with pytest.raises(ValueError):
        tables.write_star(star, path, mode="append", layout="filters")
    with pytest.raises(ValueError):
        tables.write_star(star, path, layout="other")
