"""Hard negatives: the best rows of other labels inside score windows of each anchor's positives."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import ROW, table, with_row_ids

# Bytes of anchor vectors that are broadcast at a time.
BLOCK_BYTES = 8 << 20
_ANCHORS_AT_ONCE, _ROWS_AT_ONCE = 256, 4096
_NOTHING = np.iinfo(np.int64).min
_MOST = np.iinfo(np.int64).max


def _largest_component(dimensions: int) -> int:
    """Components up to this size keep a hundredfold score within 64 bits."""
    return math.isqrt(_MOST // (100 * max(1, dimensions)))


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, dim, vec) of rows that take part; vec holds floor(scale*x) as 32-bit numbers."""

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, dims, vectors = [], [], []
            column = batch.column("embedding")
            for i in range(batch.num_rows):
                values = column[i].values
                if values is None or values.null_count:
                    continue
                x = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
                whole = np.floor(scale * x)
                # Not-a-number and infinity fail this too.
                if np.all(np.abs(whole) <= min(2**31 - 1, _largest_component(len(x)))):
                    kept.append(i)
                    dims.append(len(x))
                    vectors.append(whole.astype("<i4").tobytes())
            rest = batch.select(["vec_id", "label"]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
                names=["vec_id", "label", "dim", "vec"],
            )

    asked = rows.filter("vec_id is not null and label is not null and embedding is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return asked.mapInArrow(scaled, "vec_id bigint, label bigint, dim int, vec binary")


class _Best:
    """The best few (score, id) per anchor and slot that a task has seen: a combiner."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k = k
        self.scores = np.full((anchors, slots, k), _NOTHING)
        self.ids = np.zeros((anchors, slots, k), np.int64)

    def add(self, part: slice, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: anchors by rows, ``_NOTHING`` where a row doesn't count; ``ids`` ascend."""
        k = min(self.k, scores.shape[1])
        line = np.arange(len(scores))
        found, owners = [], []
        for _ in range(k):
            at = scores.argmax(axis=1)  # the first of equals: the smallest id
            found.append(scores[line, at])
            owners.append(ids[at])
            scores[line, at] = _NOTHING
        both = np.concatenate([self.scores[part, slot], np.stack(found, 1)], 1)
        names = np.concatenate([self.ids[part, slot], np.stack(owners, 1)], 1)
        # ~score ascends as score falls, and has no overflow.
        order = np.lexsort((names, ~both), axis=1)[:, : self.k]
        self.scores[part, slot] = np.take_along_axis(both, order, 1)
        self.ids[part, slot] = np.take_along_axis(names, order, 1)

    def batch(self, rows: np.ndarray) -> pa.RecordBatch:
        anchor, slot, place = np.nonzero(self.scores != _NOTHING)
        arrays = [rows[anchor], slot.astype(np.int32), self.scores[anchor, slot, place]]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, arrays), pa.array(self.ids[anchor, slot, place])],
            names=["anchor", "slot", "score", "other_id"],
        )


_BEST_DDL = "anchor bigint, slot int, score bigint, other_id bigint"


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), "<i4").reshape(len(vectors), dim)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while these hold all whole numbers in question."""
    widest = int(np.abs(a, dtype=np.int64).max(initial=0)) * int(np.abs(b, dtype=np.int64).max(initial=0))
    if widest * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _met(rows: DataFrame, block: pa.Table, slots: int, k: int, uppers: np.ndarray | None, lowers):
    """Best k rows per anchor of ``block`` and slot, as each task sees them.

    Without ``uppers`` there is one slot, of other rows with the anchor's label. With them,
    rows of other labels fall into the slot between one upper limit and the next.
    """
    known = rows.sparkSession.sparkContext.broadcast(
        {
            dim: tuple(
                part.column(c).to_numpy() for c in ("place", ROW, "label")
            ) + (_matrix(part.column("vec").combine_chunks(), dim),)
            for dim in pc.unique(block.column("dim")).to_pylist()
            for part in [block.filter(pc.equal(block.column("dim"), dim))]
        }
    )
    limits = rows.sparkSession.sparkContext.broadcast((uppers, lowers))
    owners = block.column(ROW).to_numpy()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(owners), slots, k)
        upper, lower = limits.value
        for batch in batches:
            batch = batch.sort_by("vec_id")
            for dim, (place, anchor_row, anchor_label, vectors) in known.value.items():
                same_dim = batch.filter(pc.equal(batch.column("dim"), dim))
                for at in range(0, same_dim.num_rows, _ROWS_AT_ONCE):
                    part = same_dim.slice(at, _ROWS_AT_ONCE)
                    ids, own, label = (part.column(c).to_numpy() for c in ("vec_id", ROW, "label"))
                    others = _matrix(part.column("vec"), dim)
                    for a in range(0, len(place), _ANCHORS_AT_ONCE):
                        z = min(a + _ANCHORS_AT_ONCE, len(place))
                        # Anchors of one length lie next to each other in the block.
                        mine = slice(place[a], place[z - 1] + 1)
                        scores = _scores(vectors[a:z], others)
                        alike = anchor_label[a:z, None] == label[None, :]
                        if upper is None:
                            alike &= anchor_row[a:z, None] != own[None, :]
                            best.add(mine, 0, np.where(alike, scores, _NOTHING), ids)
                            continue
                        wanted = ~alike & (scores >= lower[mine, None])
                        for slot in range(slots):
                            fits = wanted & (scores <= upper[mine, slot, None])
                            if slot + 1 < slots:
                                fits &= scores > upper[mine, slot + 1, None]
                            if fits.any():
                                best.add(mine, slot, np.where(fits, scores, _NOTHING), ids)
        yield best.batch(owners)

    return rows.mapInArrow(scan, _BEST_DDL)


def _limits(block: pa.Table, positives: pa.Table, slots: int, low: int, high: int):
    """Falling upper limits per anchor and slot, and its lowest lower limit; empty windows have none."""
    n = block.num_rows
    scores = np.full((n, slots), -1, np.int64)
    at = dict(zip(block.column(ROW).to_pylist(), range(n)))
    line = np.array([at[a] for a in positives.column("anchor").to_pylist()], np.int64)
    scores[line, positives.column("place").to_numpy() - 1] = positives.column("score").to_numpy()
    real = scores >= 0  # below zero a window's lower limit lies above its upper one
    uppers = np.where(real, scores * high // 100, _NOTHING)
    lowers = np.where(real, -(-scores * low // 100), _MOST).min(axis=1)
    return uppers, lowers


def _empty(like: DataFrame, ddl: str) -> DataFrame:
    return like.sparkSession.createDataFrame([], ddl)


def hard_negatives(
    rows: DataFrame,
    anchor_every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is its inner product with the anchor, components being floor(``scale`` *
    x). Anchors are rows whose id is divisible by ``anchor_every``; an anchor's positives
    are the ``positives`` best other rows of its label. For each the best ``negatives`` rows of
    other labels are given that score ``low`` to ``high`` percent of the positive. Higher scores
    come first, ties by smaller vec_id.

    The upper limits of an anchor's positives cut the scores below them into disjoint slots. Each task
    keeps the best few rows per anchor and slot; what tasks kept is merged from the slot
    of a positive downwards, which answers all its overlapping windows from one scan. Anchors
    meet all rows in blocks of at most ``block_bytes`` of vectors, broadcast one block after the other.

    Rows take no part if id, label or vector is NULL, or a component is NULL, not finite or so
    large that scores could leave 64 bits. Vectors of different lengths don't meet. Rows that
    share an id, or are equal, are rows of their own. An anchor without positives, or a
    positive without negatives, gives no rows; so does an empty table. A positive below zero
    has an empty window. Other columns are not read.
    """
    prepared = with_row_ids(whole_vectors(rows, scale), "hard-negative-rows")
    anchors = prepared.filter(F.col("vec_id") % anchor_every == 0)
    size = anchors.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    fitting = max(1, block_bytes // (4 * max(1, size["dim"] or 0)))
    blocks = -(-size["n"] // fitting)
    mine = F.pmod(F.xxhash64(ROW), F.lit(max(1, blocks)))

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "other_id")
    tops, seen = [], []
    for b in range(blocks):
        block = anchors.filter(mine == b).select(ROW, "label", "dim", "vec").toArrow()
        block = block.sort_by([("dim", "ascending"), (ROW, "ascending")])
        block = block.append_column("place", pa.array(np.arange(block.num_rows)))
        if not block.num_rows:
            continue
        near = _met(prepared, block, 1, positives, None, None)
        top = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
        tops.append(written(top.drop("slot"), "hard-positives"))
        uppers, lowers = _limits(block, tops[-1].toArrow(), positives, low, high)
        seen.append(written(_met(prepared, block, positives, negatives, uppers, lowers), "hard-slots"))
    if not tops:
        tops = [_empty(prepared, "anchor bigint, score bigint, other_id bigint, place int")]
        seen = [_empty(prepared, _BEST_DDL)]

    windows = reduce(DataFrame.unionByName, tops).select(
        F.col("anchor").alias("_anchor"),
        F.col("place").alias("_place"),
        F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    # Rows of a slot lie in the windows of its positive and of all before.
    found = reduce(DataFrame.unionByName, seen).join(
        windows, (F.col("anchor") == F.col("_anchor")) & (F.col("_place") <= F.col("slot") + 1)
    )
    hundredfold = F.col("score") * 100
    found = found.filter(hundredfold.between(F.col("positive_score") * low, F.col("positive_score") * high))
    order = Window.partitionBy("anchor", "_place").orderBy(F.desc("score"), "other_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    names = anchors.select(F.col(ROW).alias("_row_of"), F.col("vec_id").alias("anchor_id"))
    return ranked.join(names, F.col("anchor") == F.col("_row_of")).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", noisy.alias("label"), "embedding"))


ORACLE = """
with usable as (
    select row_number() over () as n, vec_id,
        case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * x::double) for x in embedding] as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select a.n, a.vec_id as anchor_id, b.n as other, b.vec_id, a.label = b.label as alike,
        list_inner_product(a.v, b.v)::bigint as score
    from usable a join usable b on a.vec_id % 50 = 0 and a.n <> b.n and len(a.v) = len(b.v)
), positives as (
    select n, anchor_id, vec_id as positive_id, other, score as positive_score from scored where alike
    qualify row_number() over (partition by n order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id, (row_number() over spot)::int as rank,
    s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.n = p.n and not s.alike
    and 100 * s.score between 50 * p.positive_score and 95 * p.positive_score
window spot as (partition by p.n, p.other order by s.score desc, s.vec_id)
qualify row_number() over spot <= 3
"""
