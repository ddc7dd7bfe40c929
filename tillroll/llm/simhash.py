"""SimHash near-duplicates by tiled exact comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import keep_rows, row_keys, spanning_links, table, whole_groups
from .components import components

SHINGLE = 4
RADIUS = 4
TILE = 1024  # most fingerprints on one side of a comparison
_SEED = 42
_AT_ONCE = 1 << 16  # shingles whose bits are counted in one step


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a UTF-8 text: bit set if set in over half of the shingle hashes."""
    words = text.lower().split() if text else []  # on bytes both are ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    hashes = np.fromiter((digest(line[a:b], _SEED) for a, b in spans), np.uint64, n)
    for i in range(0, n, _AT_ONCE):
        octets = hashes[i : i + _AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, carried: list[Column], shingle: int) -> DataFrame:
    """Carried columns and ``fp``, the fingerprint's bits as a signed long."""
    rows = docs.select(*carried, F.col("text").cast("binary").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            prints = [fingerprint(t.as_py(), shingle) for t in texts]
            fp = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fp)], names=[*batch.schema.names[:-1], "fp"]
            )

    return rows.mapInArrow(hashed, f"{kept}, fp bigint")


def _blocks(radius: int) -> Column:
    """(number, value) of ``radius + 1`` disjoint groups of bits of ``fp``.

    Prints at most ``radius`` bits apart agree in at least one group, so only equal
    groups have to be compared, and no link is lost.
    """
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.expr(f"shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L").alias("value"),
            )
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        )
    )


def _tiled(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """Distinct fingerprints as rows (task, side, fp) of the tile pairs to compare.

    Groups of at most ``tile`` prints are one tile compared with itself. Larger ones
    are cut into tiles of equal population count and at most about ``tile`` rows, and
    a tile meets only tiles whose counts differ by no more than ``radius``.
    """
    rows = written(
        prints.withColumn("g", F.explode(_blocks(radius))).select(
            "g.block", "g.value", "fp", F.bit_count("fp").cast("int").alias("ones")
        ),
        "simhash-blocks",
    )
    group = ["block", "value"]
    sizes = written(rows.groupBy(*group).agg(F.count("*").alias("n")), "simhash-sizes")
    small = sizes.filter(F.col("n").between(2, tile)).drop("n")
    large = sizes.filter(F.col("n") > tile).drop("n")
    simple = rows.join(small, group, "left_semi").select(
        *group, F.lit(-1).alias("p"), F.lit(0).alias("s"), F.lit(-1).alias("q"), F.lit(0).alias("t"),
        F.lit(0).alias("side"), "fp",
    )
    crowded = rows.join(large, group, "left_semi")
    parts = crowded.groupBy(*group, "ones").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    near = F.sequence(F.col("ones") - radius, F.col("ones") + radius)
    # To each population count of a group, the tiles of all counts within the radius.
    met = parts.withColumn("mine", F.explode(near)).select(
        *group, F.col("mine").alias("ones"), F.struct("ones", "parts").alias("other")
    )
    met = met.groupBy(*group, "ones").agg(
        F.collect_list("other").alias("others"),
        F.max(F.when(F.col("other.ones") == F.col("ones"), F.col("other.parts"))).alias("own"),
    )
    met = written(met.filter("own is not null"), "simhash-met")
    other = F.col("o.ones")
    mine, theirs = F.struct("ones", "part"), F.struct(other.alias("ones"), F.col("u").alias("part"))
    pairs = (
        crowded.join(met, [*group, "ones"])
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("own")).cast("int"))
        .withColumn("o", F.explode("others"))
        .withColumn("u", F.explode(F.sequence(F.lit(0), F.col("o.parts") - 1)))
        .withColumns({"low": F.least(mine, theirs), "high": F.greatest(mine, theirs)})
        .select(
            *group,
            F.col("low.ones").alias("p"),
            F.col("low.part").alias("s"),
            F.col("high.ones").alias("q"),
            F.col("high.part").alias("t"),
            (mine != F.col("low")).cast("int").alias("side"),
            "fp",
        )
    )
    return simple.unionByName(pairs)


def _near_pairs(prints: np.ndarray, sides: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that span the near groups of one tile pair, by exact distances of one tile to the other."""
    n = len(prints)
    if sides.any():
        one, other = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        near = np.zeros((n, n), bool)
        block = np.bitwise_count(prints[one][:, None] ^ prints[other][None, :]) <= radius
        near[np.ix_(one, other)] = block
        near[np.ix_(other, one)] = block.T
    else:
        near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
        np.fill_diagonal(near, False)
    return spanning_links(near)


def _compared(tasks: DataFrame, radius: int) -> DataFrame:
    """Spanning links (a, b) of all tile pairs."""
    keys = ["block", "value", "p", "s", "q", "t"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, keys):
            prints = rows.column("fp").to_numpy().view(np.uint64)
            sides = rows.column("side").to_numpy()
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    links = _near_pairs(prints[a:b], sides[a:b], radius)
                    found += [(a + x, a + y) for x, y in links]
            ends = np.array(found, np.int64).reshape(-1, 2)
            prints = prints.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[ends[:, i]]) for i in (0, 1)], names=["a", "b"]
            )

    return (
        tasks.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, "a bigint, b bigint")
    )


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """One row per document: doc_id, k_hash, fp, component_id, keeper (struct).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document of
    fewer words than a shingle is one shingle. Documents link when their 64-bit
    fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    doc_id that links reach, and ``keeper`` names one row of the group: the one with that
    id, among rows sharing it the one with the least hash.

    Equal fingerprints are folded first. The distinct ones are compared exactly, in
    numpy tiles by exclusive-or and bit counts, but only where they can be near: inside
    groups that share one of ``radius + 1`` bit blocks, and there only tiles whose
    population counts are within the radius. A tile pair gives links that span its
    near groups, never all pairs.

    A text without words, NULL included, has fingerprint zero and links like any other.
    A NULL doc_id never names a group that has other ids. Repeated rows are members of
    one group; an empty table gives no rows. Other columns are ignored.
    """
    rows = written(with_fingerprints(docs, row_keys(docs), shingle), "fingerprints")
    # NULL ids sort last, and a row's hash decides between rows of one id.
    name = F.struct(F.col("k_id").isNull().alias("late"), "k_id", "k_hash")
    classes = written(rows.groupBy("fp").agg(F.min(name).alias("name")), "fingerprint-classes")
    links = _compared(_tiled(classes.select("fp"), radius, tile), radius)
    linked = components(links)
    member = classes.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "name", F.coalesce("component", "fp").alias("component")
    )
    member = written(member, "fingerprint-members")
    best = member.groupBy("component").agg(F.min("name").alias("keeper"))
    named = written(member.join(best, "component").select("fp", "keeper"), "fingerprint-groups")
    return rows.join(named, "fp").select(
        F.col("k_id").alias("doc_id"),
        "k_hash",
        "fp",
        F.col("keeper.k_id").alias("component_id"),
        "keeper",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one document of every near-duplicate group."""
    groups = near_groups(docs)
    kept = groups.filter(
        F.col("doc_id").eqNullSafe(F.col("keeper.k_id")) & (F.col("k_hash") == F.col("keeper.k_hash"))
    )
    return keep_rows(docs, kept.select(F.col("doc_id").alias("k_id"), "k_hash"), once=True)


def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
