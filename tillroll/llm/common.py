"""Helpers that several operators share: row identity, spread-out ranks, stage filters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

ROW = "_row"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public layout of monotonically_increasing_id: partition number above, row in partition below.
PARTITION_BITS = 33


def quoted(name: str) -> Column:
    """Column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame) -> Column:
    """The whole row as one struct column, safe from clashes with names used inside an operator."""
    return F.struct(*(quoted(c) for c in df.columns))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns: equal for repeated rows, and with the id a key for a row.

    The hash function skips NULLs, so whether a value is NULL is hashed as well.
    """
    return F.xxhash64(*(part for c in df.columns for part in (quoted(c), quoted(c).isNull())))


def with_row_ids(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder with a unique ``_row``, which no retry can change."""
    return written(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Join condition on equal names in which NULL equals NULL."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def ranked(df: DataFrame, group: Sequence[str], rows: int, seed: int, name: str = "rank") -> DataFrame:
    """Random rank 0..n-1 of each row in its group, however large one group is.

    ``df`` carries a frozen ``_row``. Rows get a uniform hash of it; its leading part
    names a bin, so (group, bin) pieces stay small and even. A row's rank is the
    number of rows in earlier bins of its group plus its place in the bin. ``rows`` is
    the size of the table; there are at most 100,000 bins, which bounds the counts
    that one group contributes to the running sum.
    """
    bins = max(1, min(100_000, -(-rows // 2_000)))
    keyed = df.withColumn("_key", F.xxhash64(F.lit(seed), F.col(ROW))).withColumn(
        "_bin", F.pmod(F.shiftright("_key", 20), F.lit(bins)).cast("int")
    )
    place = Window.partitionBy(*group, "_bin").orderBy("_key", ROW)
    placed = keyed.withColumn("_place", F.row_number().over(place) - 1)
    earlier = (
        Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = keyed.groupBy(*group, "_bin").agg(F.count("*").alias("_n"))
    before = counts.select(
        *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)),
        F.col("_bin").alias("_b"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = F.col("_bin") == F.col("_b")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(before, same).select(
        *df.columns, (F.col("_before") + F.col("_place")).alias(name)
    )


def row_keys(docs: DataFrame) -> list[Column]:
    """Key columns ``k_id`` and ``k_hash`` that name a row up to exact repetition."""
    return [F.col("doc_id").alias("k_id"), row_hash(docs).alias("k_hash")]


def keep_rows(docs: DataFrame, keys: DataFrame, once: bool = False) -> DataFrame:
    """Rows of ``docs`` whose (k_id, k_hash) occurs in ``keys``, all columns as they were.

    ``once`` keeps one of several equal rows. Both steps use the same partitioning.
    """
    rows = docs.select(packed(docs).alias("doc"), *row_keys(docs))
    keys = keys.select(F.col("k_id").alias("r_id"), F.col("k_hash").alias("r_hash"))
    same = F.col("k_id").eqNullSafe(F.col("r_id")) & (F.col("k_hash") == F.col("r_hash"))
    kept = rows.join(keys, same, "left_semi")
    if once:
        kept = kept.dropDuplicates(["k_id", "k_hash"])
    return kept.select("doc.*")


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], leaf: int | None = None
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches re-cut so that no group of equal ``keys`` is torn.

    Gives tables of complete groups with the first row of each group and the end. Only a
    group that a batch leaves open is held back. With ``leaf``, groups are cut into
    pieces of that many rows, and at most one piece is held back however long a group is.
    """
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        cuts = _group_starts(rows, keys, leaf)
        last = int(cuts[-2]) if len(cuts) > 1 else 0
        if last:
            yield rows.slice(0, last), cuts[:-1]
        rest = rows.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, _group_starts(rest, keys, leaf)


def _group_starts(rows: pa.Table, keys: Sequence[str], leaf: int | None) -> np.ndarray:
    if not rows.num_rows:
        return np.array([0])
    columns = [rows.column(k).to_numpy() for k in keys]
    new = np.zeros(rows.num_rows - 1, bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [rows.num_rows]])
    if leaf:
        pieces = [np.arange(a, b, leaf) for a, b in zip(cuts[:-1], cuts[1:])]
        cuts = np.concatenate([*pieces, cuts[-1:]])
    return cuts


def spanning_links(near: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (member, root) that connect what a symmetric matrix of links connects.

    All links of a group of copies would be quadratic; these are fewer than its members.
    """
    links = []
    todo = near.any(axis=1)
    while todo.any():
        root = int(todo.argmax())
        todo[root] = False
        wave = near[root] & todo
        while wave.any():
            todo &= ~wave
            links += [(int(x), root) for x in np.flatnonzero(wave)]
            wave = near[wave].any(axis=0) & todo
    return links
