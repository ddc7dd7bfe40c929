"""Mixing sources to target weights by a Pfair schedule.

Block j of a source of weight w is released at slot floor(j/w) and due by ceil((j+1)/w);
a schedule that keeps all these windows is less than one block from every target in every slot.
Time is cut into periods that are planned on the executors, each by itself, so the state at
their ends must follow from the weights alone. At slot T a source has had floor(w*T) blocks, or one
more. Those with one more must be enough with near deadlines for the period that begins (blocks due
by b need b slots), and few enough with late releases for the one that ends. Both demands concern
nested sets, so it is best to go through the deadlines and, whenever they ask for one more
source, take the one released first. Windows of weights that add up to one can be
kept (the schedule without periods keeps them), hence such a choice exists, and within the
period the earliest deadline first meets all windows. Every source has a block due in
every period, so none that is ahead at one end falls back at the next.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import ROW, packed, quoted, ranked, table, with_row_ids

PERIOD = 16_384
LONGEST = 1 << 20  # a period; units below one block in that many slots are raised to it
MAX_UNITS = 4096  # scheduled side by side; more sources share units
_SCALE = 1 << 40  # weights are whole numbers of about this sum
_SEED = 17
_PLAN = "unit int, number bigint, slot bigint, release bigint, deadline bigint"


def whole_weights(targets: Sequence[float]) -> list[int]:
    """Targets as whole numbers, none below a ``LONGEST``-th of the sum."""
    total = fsum(targets)
    return [max(_SCALE // LONGEST, round(t / total * _SCALE)) for t in targets]


def _window(i: np.ndarray, left: np.ndarray, weight: np.ndarray, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Release and deadline, from the start of a period, of block i after the floor of the target."""
    return (i * whole - left) // weight, -((left - (i + 1) * whole) // weight)


def state(weights: Sequence[int], start: int, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole part and numerator of the rest of each target at ``start``, and who is one block ahead."""
    weight, whole = np.array(weights, np.int64), sum(weights)
    parts = [divmod(w * start, whole) for w in weights]
    floor, left = (np.array(x, np.int64) for x in zip(*parts, strict=True))
    ahead = np.zeros(len(weight), np.int64)
    spare = start - int(floor.sum())
    if not spare:
        return floor, left, ahead
    due = (left + weight * period) // whole  # blocks due within a period
    source = np.repeat(np.arange(len(weight)), due)
    block = np.arange(len(source)) - np.repeat(np.cumsum(due) - due, due)
    _, deadline = _window(block, left[source], weight[source], whole)
    work = np.cumsum(np.bincount(deadline, minlength=period + 1))[1:period]
    needed = np.maximum.accumulate(np.maximum(work - np.arange(1, period), 0))
    rises = np.flatnonzero(np.diff(needed, prepend=0))
    demands = [(int(b) + 1, int(needed[b])) for b in rises]
    begun = np.flatnonzero(left)
    release, deadline = _window(np.zeros_like(begun), left[begun], weight[begun], whole)
    coming = sorted(zip(deadline.tolist(), release.tolist(), begun.tolist(), strict=True))
    pool: list[tuple[int, int]] = []  # release, source
    seen = taken = 0
    for limit, count in [*demands, (coming[-1][0], spare)]:
        while seen < len(coming) and coming[seen][0] <= limit:
            heapq.heappush(pool, coming[seen][1:])
            seen += 1
        while taken < count:
            ahead[heapq.heappop(pool)[1]] = 1
            taken += 1
    return floor, left, ahead


def period_plan(weights: Sequence[int], number: int, period: int) -> np.ndarray:
    """Rows (source, number of its block, slot, release, deadline) of one period, by slot."""
    weight, whole, start = np.array(weights, np.int64), sum(weights), number * period
    floor, left, ahead = state(weights, start, period)
    end, _, then = state(weights, start + period, period)
    share = end + then - floor - ahead
    source = np.repeat(np.arange(len(weight)), share)
    first = np.cumsum(share) - share
    block = np.arange(len(source)) - np.repeat(first, share) + ahead[source]
    release, deadline = _window(block, left[source], weight[source], whole)
    opens, closes = np.maximum(release, 0).tolist(), np.minimum(deadline, period).tolist()
    last = (first + share).tolist()
    owner = source.tolist()
    waiting = [(opens[k], k) for k in first[share > 0].tolist()]  # release, row
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []  # deadline, row
    order = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, k = heapq.heappop(waiting)
            heapq.heappush(ready, (closes[k], k))
        _, k = heapq.heappop(ready)
        order.append(k)
        if k + 1 < last[owner[k]]:
            heapq.heappush(waiting, (opens[k + 1], k + 1))
    rows = np.stack([source, floor[source] + block, np.zeros_like(source), release + start, deadline + start])
    rows = rows[:, order]
    rows[2] = start + np.arange(period)
    return rows.T


def turns(weights: Sequence[float], slots: int) -> list[tuple[int, int]]:
    """(source, number of its block) in each of ``slots`` slots, less than one block from the target."""
    total = sum(weights)
    waiting = [(0, k) for k in range(len(weights))]  # release, source
    ready: list[tuple[float, int]] = []  # deadline, source
    done, out = [0] * len(weights), []
    for slot in range(slots):
        while waiting and (waiting[0][0] <= slot or not ready):
            _, k = heapq.heappop(waiting)
            heapq.heappush(ready, ((done[k] + 1) * total / weights[k], k))
        _, k = heapq.heappop(ready)
        out.append((k, done[k]))
        done[k] += 1
        heapq.heappush(waiting, (int(done[k] * total / weights[k]), k))
    return out


def _plan(spark: SparkSession, weights: Sequence[int], period: int, periods: int) -> DataFrame:
    """Slot, release and deadline of every block of every unit, period by period."""

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                unit, *rest = period_plan(weights, number, period).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (unit.astype(np.int32), *rest)],
                    names=["unit", "number", "slot", "release", "deadline"],
                )

    numbers = spark.range(0, periods, 1, max(1, min(periods, 1000)))
    return written(numbers.mapInArrow(planned, _PLAN), "mix-plan")


def _shared_plan(small: DataFrame, totals: DataFrame, plan: DataFrame) -> DataFrame:
    """(s_source, n_blocks, s_total, number, slot, release, deadline) of sources that share units."""

    def dealt(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("target", "descending"), ("source", "ascending")])
        given = turns(rows.column("target").to_pylist(), rows.column("total")[0].as_py())
        k, number = np.array(given, np.int64).reshape(-1, 2).T
        taken = np.bincount(k, minlength=rows.num_rows)
        return pa.table(
            {
                "s_source": rows.column("source").take(pa.array(k)),
                "n_blocks": rows.column("blocks").take(pa.array(k)),
                "s_total": pa.array(taken[k]),
                "number": pa.array(number),
                "d_unit": rows.column("unit").take(pa.array(k)),
                "turn": pa.array(np.arange(len(k))),
            }
        )

    kinds = "s_source string, n_blocks bigint, s_total bigint, number bigint, d_unit int, turn bigint"
    dealt_out = small.join(totals, "unit").groupBy("unit").applyInArrow(dealt, kinds)
    own = plan.withColumnRenamed("number", "p_number")
    same = (F.col("d_unit") == F.col("unit")) & (F.col("turn") == F.col("p_number"))
    return written(
        dealt_out.join(own, same).select(
            "s_source", "n_blocks", "s_total", "number", "slot", "release", "deadline"
        ),
        "mix-shared",
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    tempering: float = 0.9,
    block_rows: int = 16,
    source: str = "source",
    max_units: int = MAX_UNITS,
) -> DataFrame:
    """Every row of ``docs`` as ``doc`` with source, epoch, block, place, slot, release, deadline.

    Rows of a source are put in random order and cut into blocks of ``block_rows``;
    ``slot`` is the place of the block in the mixture, ``place`` the row's place in its
    block. ``weights`` names a positive target for every source (a missing one is an
    error); without it a source of n rows gets n ** ``tempering``. The mixture ends
    with the slot in which the last source has been read once, so no row is dropped;
    sources that the targets favour start over and count their passes in ``epoch``.
    Until then every source is less than one block from its share in every slot, and every
    block lies between its release and its deadline.

    The ``max_units`` largest sources, if they get at least one slot in 2^20, are scheduled that
    way. Others share units by hash, whose slots are dealt out once more on the executors; such a
    source is less than two blocks from its share, and release and deadline are its unit's. A unit
    that asks for less than one slot in 2^20 gets that.

    NULL is a source like any other. Repeated rows are separate rows. An empty table
    gives an empty result. Any columns may be present: the row travels as one struct.
    At most one and a half times ``max_units`` weights go through the driver;
    ranks within a source, however hot, are built in small bins.
    """
    spark = docs.sparkSession
    rows = with_row_ids(docs.select(packed(docs).alias("doc"), quoted(source).cast("string").alias("source")), "mix-rows")
    counts = rows.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("target", F.pow("n", F.lit(float(tempering))))
    else:
        given = [(name, float(w)) for name, w in weights.items()]
        given = spark.createDataFrame(given, "w_source string, target double")
        counts = counts.join(given, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
    counts = written(
        counts.withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("bigint")), "mix-counts"
    )
    usable = "target is not null and target > 0 and target < double('infinity')"
    missing = counts.filter(f"not ({usable})").select("source").limit(5).collect()
    if missing:
        raise ValueError(f"no positive weight for sources {[r['source'] for r in missing]}")
    size = counts.agg(F.count("*"), F.sum("n"), F.sum("target"), F.min("target")).first()
    fits = size[0] <= max_units and (size[3] or 0) * LONGEST >= (size[2] or 0)
    large = counts.filter(F.col("target") >= (size[2] or 0) / LONGEST)
    limit = max_units if size[0] <= max_units else max_units // 2
    head = large.orderBy(F.desc("target"), "source").limit(limit).collect()
    units = [(r["target"], r["blocks"]) for r in head]
    small = None
    if not fits:
        largest = spark.createDataFrame([(r["source"],) for r in head], "l_source string")
        # About one unit for a thousandth of the mixture, as far as there are units.
        apart = max(0.0, 1 - fsum(target for target, _ in units) / size[2])
        shared = max(1, min(max_units // 2, round(apart * 1024)))
        share = F.pmod(F.xxhash64("source"), F.lit(shared)).cast("int")
        small = written(
            counts.join(F.broadcast(largest), F.col("source").eqNullSafe(F.col("l_source")), "left_anti")
            .select("source", "target", "blocks", share.alias("part")),
            "mix-small",
        )
        # A unit needs as many slots as let its slowest source be read once.
        slowest = (F.ceil(F.sum("target") * F.max(F.col("blocks") / F.col("target"))) + 1).cast("bigint")
        parts = small.groupBy("part").agg(F.sum("target").alias("target"), slowest.alias("blocks"))
        parts = parts.orderBy("part").collect()
        numbers = [(r["part"], len(units) + i) for i, r in enumerate(parts)]
        units += [(r["target"], r["blocks"]) for r in parts]
        numbers = spark.createDataFrame(numbers, "part int, unit int")
        small = small.join(F.broadcast(numbers), "part").drop("part")
    parts = whole_weights([target for target, _ in units])
    whole = sum(parts)
    slots = max((blocks * whole // w + 2 for w, (_, blocks) in zip(parts, units, strict=True)), default=0)
    longest = max(PERIOD, -(-whole // min(parts))) if parts else 1
    period = max(1, min(longest, slots))
    periods = -(-slots // period)
    plan = _plan(spark, parts, period, periods)
    floor, _, ahead = state(parts, periods * period, period) if parts else np.zeros((3, 0), np.int64)
    totals = (floor + ahead).tolist()
    owners = spark.createDataFrame(
        [(r["source"], k, r["blocks"], totals[k]) for k, r in enumerate(head)],
        "p_source string, p_unit int, n_blocks bigint, total bigint",
    )
    # One row per unit with a source of its own: at most max_units.
    owners = F.broadcast(owners)
    last = plan.join(owners, (F.col("unit") == F.col("p_unit")) & (F.col("number") == F.col("n_blocks") - 1))
    end = last.agg(F.max("slot")).first()[0]
    ranks = ranked(rows.select(ROW, "source"), ["source"], size[1] or 0, _SEED)
    own = F.col("source").eqNullSafe(F.col("p_source"))
    columns = [ROW, "epoch", "block", "place", "slot", "release", "deadline"]

    def numbered(df: DataFrame) -> DataFrame:
        """Rows with the number of their block in every pass that may begin."""
        passes = F.ceil(F.col("total") / F.col("n_blocks")).cast("int")
        return (
            df.withColumn("block", F.expr(f"rank div {block_rows}"))
            .withColumn("place", (F.col("rank") % block_rows).cast("int"))
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), passes - 1)))
            .withColumn("wanted", F.col("epoch") * F.col("n_blocks") + F.col("block"))
        )

    same = (F.col("p_unit") == F.col("unit")) & (F.col("wanted") == F.col("number"))
    scheduled = numbered(ranks.join(owners, own)).join(plan, same).select(*columns)
    if small is not None:
        sizes = [(k, n) for k, n in enumerate(totals)]
        shared = _shared_plan(small, F.broadcast(spark.createDataFrame(sizes, "unit int, total bigint")), plan)
        end = max(end, shared.filter("number = n_blocks - 1").agg(F.max("slot")).first()[0])
        # These sources are none of the largest, so a join by source has no hot key.
        known = shared.groupBy("s_source").agg(
            F.max("n_blocks").alias("n_blocks"), F.max("s_total").alias("total")
        )
        rest = ranks.join(owners, own, "left_anti")
        rest = numbered(rest.join(known, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source", "number"))
        same = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("wanted") == F.col("number"))
        scheduled = scheduled.unionByName(rest.join(shared.drop("n_blocks"), same).select(*columns))
    scheduled = scheduled.filter(F.col("slot") <= (-1 if end is None else end))
    return rows.join(scheduled, ROW).select(
        "doc", "source", "epoch", "block", "place", "slot", "release", "deadline"
    )


def mixed(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents in their mixed shares, favoured sources repeated."""
    return mix(docs).select("doc.*")


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mix(docs).select(
        "doc.doc_id", "source", "epoch", "block", "place", "slot", "release", "deadline"
    )
