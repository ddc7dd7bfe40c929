"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import PARTITION_BITS, ROW, packed, quoted, ranked, table, with_row_ids

_BLOCKS = 4096  # at most so many rows in the matrix
_SEED = 29


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` of ``good + bad``. Numpy's sampler ends at 10^9, tables do not."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    low, high = max(0, drawn - bad), min(drawn, good)
    share = good / (good + bad)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    spread = int(40 * (drawn * share * (1 - share)) ** 0.5) + 40
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=np.float64)
    # Inversion over log ratios p(k+1)/p(k), added up from the first k.
    ratio = np.log(good - k[:-1]) + np.log(drawn - k[:-1])
    ratio -= np.log(k[1:]) + np.log(bad - drawn + k[1:])
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(weights, rng.random() * weights[-1])])


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Rows that each block sends to each shard: a uniform draw with these exact margins."""
    rng = np.random.default_rng(seed)
    left = list(shard_sizes)
    matrix = np.zeros((len(block_sizes), len(shard_sizes)), dtype=np.int64)
    for b, size in enumerate(block_sizes):
        todo, others = size, sum(left)
        for s, room in enumerate(left):
            others -= room
            sent = hypergeometric(rng, room, others, todo)
            matrix[b, s] = sent
            todo -= sent
            left[s] -= sent
    return matrix


def even_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = _SEED) -> DataFrame:
    """Every row of ``docs`` as ``doc`` with shard (0..shards-1) and slot (gapless from 0 in it).

    All assignments with shard sizes at most one apart are equally likely, up to the
    generator. Blocks of input partitions draw the exact number of rows that they send
    to each shard; each block permutes its rows by random keys and deals them out by
    those counts; in the shards random keys decide the slots. Only ids and counts are
    exchanged for this, and the rows themselves move once, at the end.

    Repeated rows and NULLs in any column are rows like others, an empty table gives an
    empty result, extra columns travel inside ``doc``. The matrix has at most 4,096 x
    ``shards`` numbers. Input partitions are taken modulo that; ranks in a shard are
    built in small bins, so neither step has one task per shard. Ids are frozen in a
    written table, thus a lost executor changes nothing.
    """
    rows = with_row_ids(docs.select(packed(docs).alias("doc")), "shard-rows")
    ids = rows.select(
        ROW, F.pmod(F.shiftright(ROW, PARTITION_BITS), F.lit(_BLOCKS)).cast("int").alias("block")
    )
    counts = sorted((r["block"], r["count"]) for r in ids.groupBy("block").count().collect())
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], even_sizes(total, shards), seed)
    # One row per block, at most 4,096 of them: bounds of the shards in its permuted rows.
    bounds = docs.sparkSession.createDataFrame(
        [(b, [int(x) for x in np.cumsum(m)]) for (b, _), m in zip(counts, matrix)],
        "b_block int, ends array<bigint>",
    )
    dealt = (
        ranked(ids, ["block"], total, seed)
        .join(F.broadcast(bounds), F.col("block") == F.col("b_block"))
        .select(ROW, F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"))
    )
    slots = ranked(written(dealt, "shard-of-row"), ["shard"], total, seed + 1, "slot")
    return rows.join(slots, ROW).select("doc", "shard", "slot")


def sharded(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Pipeline stage: documents with their shard and slot, which replace input columns of those names in any case."""
    placed = shuffle_into_shards(docs, shards)
    taken = {"shard", "slot"}
    names = [c for c in docs.columns if c.lower() not in taken]
    return placed.select(*(F.col("doc").getField(c).alias(c) for c in names), "shard", "slot")


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(quoted("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    return shuffle_into_shards(docs, 24).select(
        "doc.*",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
