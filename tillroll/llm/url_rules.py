"""URL rules by a sort-merge range join over reversed-host keys.

A rule (host, path) fits the host and its subdomains when the path starts with the
rule's. A URL becomes one key per ancestor of its host, ``com.example\\0/en/1``; a rule
becomes the interval of keys that start with its own. Such intervals nest or are
disjoint, so a sweep over all keys in order only has to know the stack of rules that
are open, and its top is the longest match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import LOWER, PARTITION_BITS, ROW, UPPER, quoted, table, with_row_ids

_STACK = "array<struct<host:string,path:string,verdict:string>>"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_AFTER_ALL = bytearray(b"\xff")  # in no UTF-8 text, so it sorts behind every continuation of a key

# The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_of(url: Column) -> Column:
    """Lower-cased host, empty when there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _key(labels: Column, path: Column) -> Column:
    """Bytes to sort by: the labels of a host, last one first, and a path."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("\0"), path).cast("binary")


def _stacks(rules: DataFrame) -> DataFrame:
    """Each distinct rule with the rules that are open inside its interval, outermost first."""
    rules = (
        rules.filter("host is not null")
        .groupBy("host", F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("verdict").alias("verdict"))
    )
    starts = rules.select(
        "host", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n")
    ).withColumn("outer_path", F.expr("substring(path, 1, n)"))
    outer = rules.select(
        F.col("host").alias("o_host"), F.col("path").alias("o_path"), F.col("verdict")
    )
    nested = starts.join(
        outer, (F.col("host") == F.col("o_host")) & (F.col("outer_path") == F.col("o_path"))
    )
    entry = F.struct("n", F.struct("host", F.col("o_path").alias("path"), "verdict").alias("rule"))
    return nested.groupBy("host", "path").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["rule"])
        .cast(_STACK)
        .alias("stack")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict. The longest fitting rule wins.

    ``rules`` has host, path, verdict. Equal length: the longer host wins; a rule given
    twice counts with the verdict that sorts last (block before allow). NULL URLs and
    URLs without ``://`` have an empty host and path. They fit no rule, and pages without
    a rule get ``default``. A rule without a host never fits; its NULL path counts as
    empty. Repeated pages give repeated rows, other columns are ignored, an empty table
    of pages gives none, and without rules every page gets the default.

    Pages and rules are range-partitioned together on (key, kind, row), so neither a
    hot host nor a URL that fills a third of the table ends up in one task. Only the
    last open stack of each range partition is passed on to the next.
    """
    deepest, longest = rules.agg(
        F.max(F.size(F.split("host", r"\."))), F.max(F.length("path"))
    ).first()
    rows = with_row_ids(
        pages.select(
            quoted(page_id).alias("page_id"),
            host_of(quoted(url)).alias("host"),
            path_of(quoted(url)).alias("path"),
        ),
        "url-rows",
    )
    # Ancestors with more labels than any rule, and characters behind the longest rule's, can't matter.
    labels = F.split("host", r"\.")
    levels = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest or 1)))
    ancestors = F.transform(levels, lambda n: F.slice(labels, F.size(labels) - n + 1, n))
    points = (
        rows.filter("host <> ''")
        .select(ROW, F.explode(ancestors).alias("labels"), F.substring("path", 1, longest or 0).alias("p"))
        .select(
            _key(F.col("labels"), F.col("p")).alias("key"),
            F.lit(1).alias("kind"),
            F.col(ROW),
            F.lit(None).cast(_STACK).alias("stack"),
        )
    )
    stacks = _stacks(rules).withColumn("key", _key(F.split("host", r"\."), F.col("path")))
    none = F.lit(None).cast("bigint").alias(ROW)
    opens = stacks.select("key", F.lit(0).alias("kind"), none, "stack")
    closes = stacks.select(
        F.concat("key", F.lit(_AFTER_ALL)).alias("key"),
        F.lit(2).alias("kind"),
        none,
        F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"),
    )
    order = ["key", "kind", ROW]
    swept = written(
        points.unionByName(opens)
        .unionByName(closes)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(ROW, "stack", F.monotonically_increasing_id().alias("slot")),
        "url-sweep",
    ).withColumn("segment", F.shiftright("slot", PARTITION_BITS))

    # One row per range partition, hence safe to broadcast.
    left_open = swept.groupBy("segment").agg(
        F.max_by("stack", F.when(F.col("stack").isNotNull(), F.col("slot"))).alias("stack")
    )
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = left_open.select(
        "segment", F.last("stack", ignorenulls=True).over(earlier).alias("carried")
    )
    so_far = (
        Window.partitionBy("segment")
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    active = F.coalesce(F.last("stack", ignorenulls=True).over(so_far), F.col("carried"))
    top = F.try_element_at("active", F.lit(-1))
    size = F.struct(F.length("top.host") + F.length("top.path"), F.length("top.host"))
    found = (
        swept.join(F.broadcast(carried), "segment")
        .withColumn("active", active)
        .filter(F.col(ROW).isNotNull())
        .select(ROW, top.alias("top"))
        .filter("top is not null")
        .groupBy(ROW)
        .agg(F.max_by("top", size).alias("top"))
    )
    return rows.join(found, ROW, "left").select(
        "page_id",
        "host",
        "path",
        F.concat("top.host", "top.path").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rows = F.array(*(F.struct(*(F.lit(x) for x in rule)) for rule in RULES))
    rules = spark.range(1).select(F.inline(rows).alias("host", "path", "verdict"))
    return judge(table(spark, folder, "pages"), rules)


ORACLE = """
with parts as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
    from pages
), rules(r_host, r_path, r_verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
        ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), numbered as (select row_number() over () as n, * from parts
), fits as (
    select n, r_host || r_path as rule, r_verdict,
        row_number() over (partition by n order by length(r_host || r_path) desc, length(r_host) desc) as k
    from numbered join rules
        on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
)
select page_id, host, path, rule, coalesce(r_verdict, 'allow') as verdict
from numbered left join (select * from fits where k = 1) f using (n)
"""
