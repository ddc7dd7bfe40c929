"""Fixity audit of WARC replicas by Merkle trees over offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import quoted, table

RANGE = 65_536  # bytes of a file below one lowest inner node
FANOUT = 16


def record(page_id: Column, url: Column, html: Column) -> Column:
    """Text of the WARC record that holds a page; NULLs are empty."""
    html, line = F.coalesce(html, F.lit("")), "\r\n"
    return F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: resource{line}WARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">{line}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{line}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(line * 2),
        html,
        F.lit(line * 2),
    )


def laid_out(records: DataFrame, pages_per_file: int = 500) -> DataFrame:
    """Adds file_id and start to rows with page_id, length and sha256.

    A file takes a range of ``pages_per_file`` ids, so files are small next to a
    partition, and its records follow each other by id and hash. Records without an id
    go to files of their own, numbered below zero by hash.
    """
    by_hash = -1 - F.pmod(F.xxhash64("sha256"), F.lit(1 << 20))
    file_id = F.coalesce(F.floor(F.col("page_id") / pages_per_file), by_hash).cast("bigint")
    ahead = (
        Window.partitionBy("file_id")
        .orderBy("page_id", "sha256")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("bigint")
    return records.withColumn("file_id", file_id).withColumn("start", start)


def _node(children: str) -> Column:
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct(children, "hash"))),
        lambda c: F.concat(c[children].cast("string"), F.lit(":"), c["hash"]),
    )
    return F.sha2(F.array_join(parts, ","), 256).alias("hash")


def merkle_tree(records: DataFrame, height: int) -> list[DataFrame]:
    """Levels (file_id, node, hash) from the records up to one root per file.

    A leaf is what starts at one offset; its hash covers offset, length and content. An
    inner node covers an offset range and hashes its children in order of offset, with
    their places. Ranges, not counts, form the tree, so a lost record changes one branch
    only. A node has at most 16 children, a lowest one the records in 64 KiB.
    """
    leaf = F.sha2(F.concat_ws(":", "start", "length", "sha256"), 256).alias("hash")
    leaves = records.select("file_id", F.col("start").alias("node"), leaf)
    # Replicas may hold several records at one offset; together they are one leaf.
    leaves = leaves.groupBy("file_id", "node").agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("hash")), ","), 256).alias("hash")
    )
    levels = [written(leaves, "merkle-0")]
    for level in range(1, height + 1):
        width = RANGE if level == 1 else FANOUT
        nodes = levels[-1].groupBy("file_id", F.expr(f"node div {width}").alias("parent"))
        nodes = nodes.agg(_node("node")).withColumnRenamed("parent", "node")
        levels.append(written(nodes, f"merkle-{level}"))
    return levels


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file_id, node) of nodes whose hashes differ or that one side lacks."""
    a, b = left.alias("a"), right.alias("b")
    same = (F.col("a.file_id") == F.col("b.file_id")) & (F.col("a.node") == F.col("b.node"))
    return (
        a.join(b, same, "full")
        .filter(~F.col("a.hash").eqNullSafe(F.col("b.hash")))
        .select(
            F.coalesce("a.file_id", "b.file_id").alias("file_id"),
            F.coalesce("a.node", "b.node").alias("node"),
        )
    )


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Damaged records: file_id, start, page_id, kind, lengths and hashes on both sides.

    Both tables have file_id, start, length, page_id, sha256 of each record. Roots are
    compared first; below a differing node only its children are read, down to the
    records. ``kind`` is changed, missing (from the replica) or extra. Records of equal
    content at one offset count as one. Records without file or offset are ignored, NULL
    hashes count as empty; two empty tables agree, against an empty one everything is
    missing or extra. Other columns are ignored.
    """
    need = ["file_id", "start", "length", "page_id"]
    sides = [
        written(
            side.filter("file_id is not null and start is not null").select(
                *(quoted(c) for c in need), F.coalesce("sha256", F.lit("")).alias("sha256")
            ),
            "warc-records",
        )
        for side in (primary, replica)
    ]
    ends = [side.agg(F.max("start")).first()[0] or 0 for side in sides]
    height, reach = 1, RANGE
    while reach <= max(ends):
        height, reach = height + 1, reach * FANOUT
    trees = [merkle_tree(side, height) for side in sides]
    bad = _differing(trees[0][height], trees[1][height])
    for level in range(height - 1, -1, -1):
        width = RANGE if level == 0 else FANOUT
        bad = written(bad.withColumnRenamed("node", "parent"), "merkle-bad")
        children = [
            tree[level]
            .withColumn("parent", F.expr(f"node div {width}"))
            .join(bad, ["file_id", "parent"], "left_semi")
            .drop("parent")
            for tree in trees
        ]
        bad = _differing(*children)
    bad = written(bad.withColumnRenamed("node", "start"), "merkle-bad")
    left, right = (
        side.join(bad, ["file_id", "start"], "left_semi").distinct().alias(name)
        for side, name in zip(sides, ("l", "r"))
    )
    same = (
        (F.col("l.file_id") == F.col("r.file_id"))
        & (F.col("l.start") == F.col("r.start"))
        & F.col("l.page_id").eqNullSafe(F.col("r.page_id"))
    )
    both = left.join(right, same, "full").filter(
        ~(
            F.col("l.sha256").eqNullSafe(F.col("r.sha256"))
            & F.col("l.length").eqNullSafe(F.col("r.length"))
        )
    )
    kind = (
        F.when(F.col("r.start").isNull(), "missing")
        .when(F.col("l.start").isNull(), "extra")
        .otherwise("changed")
    )
    return both.select(
        F.coalesce("l.file_id", "r.file_id").alias("file_id"),
        F.coalesce("l.start", "r.start").alias("start"),
        F.coalesce("l.page_id", "r.page_id").alias("page_id"),
        kind.alias("kind"),
        F.col("l.length").alias("length"),
        F.col("r.length").alias("found_length"),
        F.col("l.sha256").alias("sha256"),
        F.col("r.sha256").alias("found_sha256"),
    )


def _hashed(pages: DataFrame, html: Column, prefix: str = "") -> list[Column]:
    text = record(F.col("page_id"), F.col("url"), html)
    return [
        F.octet_length(text).cast("bigint").alias(f"{prefix}length"),
        F.sha2(text.cast("binary"), 256).alias(f"{prefix}sha256"),
    ]


def op8_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Audits a replica in which single pages are altered, cut short or lost, by id."""
    pages = table(spark, folder, "pages")
    html, key = F.coalesce("html", F.lit("")), F.col("page_id")
    damaged = F.when(key % 97 == 5, F.concat(F.lit("#"), F.substr(html, F.lit(2)))).when(
        key % 389 == 11, F.substr(html, F.lit(1), F.floor(F.length(html) / 2).cast("int"))
    )
    damaged = F.coalesce(damaged, html)
    hashed = pages.select("page_id", *_hashed(pages, html), *_hashed(pages, damaged, "d_"))
    stored = written(laid_out(hashed), "warc-stored")
    place = ["file_id", "start", "page_id"]
    primary = stored.select(*place, "length", "sha256")
    lost = F.coalesce(key % 389 == 7, F.lit(False))
    replica = stored.filter(~lost).select(
        *place, F.col("d_length").alias("length"), F.col("d_sha256").alias("sha256")
    )
    return audit(primary, replica)


ORACLE = r"""
with texts as (
    select page_id, coalesce(url, '') as url, coalesce(html, '') as html,
        case when page_id % 97 = 5 then '#' || substr(coalesce(html, ''), 2)
            when page_id % 389 = 11 then left(coalesce(html, ''), length(coalesce(html, '')) // 2)
            else coalesce(html, '') end as damaged
    from pages
), records as (
    select page_id,
        'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
        || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
        || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' as head,
        chr(13) || chr(10) || chr(13) || chr(10) as gap, html, damaged
    from texts
), hashed as (
    select page_id,
        octet_length(encode(head || octet_length(encode(html)) || gap || html || gap)) as length,
        sha256(head || octet_length(encode(html)) || gap || html || gap) as sha256,
        octet_length(encode(head || octet_length(encode(damaged)) || gap || damaged || gap)) as d_length,
        sha256(head || octet_length(encode(damaged)) || gap || damaged || gap) as d_sha256
    from records
), stored as (
    select *, page_id // 500 as file_id,
        coalesce(sum(length) over (partition by page_id // 500 order by page_id, sha256
            rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from hashed
)
select file_id, start, page_id,
    case when page_id % 389 = 7 then 'missing' else 'changed' end as kind,
    length::bigint as length, sha256,
    case when page_id % 389 <> 7 then d_length end::bigint as found_length,
    case when page_id % 389 <> 7 then d_sha256 end as found_sha256
from stored
where page_id % 389 = 7 or sha256 <> d_sha256
"""
