"""Embedding near-duplicates over a neighbour graph refined by NN-descent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import quoted, spanning_links, table, whole_groups
from .components import components

THRESHOLD = 0.95
NEIGHBOURS = 8
TABLES = 6  # random orders that start the graph, and again per repair
LEAF = 64
ROUNDS = 20
AUDITED = 2048
LINKED = 256  # audited vectors with links that an audit needs, unless it has grown to
MOST_AUDITED = 32_768
EXACT_BLOCK = 2048
RECALL = 0.97
TILE = 256
_SLACK = 1e-5  # single precision decides what is looked at, double what is a link
_PAIR = "node bigint, other bigint, sim float, link boolean"


def unit(embedding: list | None) -> list[float] | None:
    """Vector of length one in double precision, or None if that has no meaning."""
    if not embedding or any(x is None for x in embedding):
        return None
    x = np.array(embedding, np.float64)
    largest = np.abs(x).max()
    if not np.isfinite(x).all() or largest == 0:
        return None
    x = x / largest  # so that squares neither overflow nor vanish
    return (x / np.sqrt(x @ x)).tolist()


def with_units(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, u): the unit vector of each row, NULL where there is none."""
    rows = vectors.select(quoted(vec_id).alias("vec_id"), quoted(embedding).alias("u"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = [unit(x) for x in batch.column("u").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(u, pa.list_(pa.float64()))], names=["vec_id", "u"]
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(scaled, f"vec_id {kind}, u array<double>")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of packed single-precision vectors of one length."""
    packed = vectors.to_pylist()
    return np.frombuffer(b"".join(packed), np.float32).reshape(len(packed), -1)


def _pairs(node, other, sim, link) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.asarray(node, np.int64)),
            pa.array(np.asarray(other, np.int64)),
            pa.array(np.asarray(sim, np.float32)),
            pa.array(np.asarray(link, bool)),
        ],
        names=["node", "other", "sim", "link"],
    )


def _best(nodes: np.ndarray, vectors: np.ndarray, bounds, fresh, k: int, threshold: float):
    """Arrays (node, other, sim, link) from comparing a small set with itself.

    Per member its ``k`` best partners above its bound, of pairs with a fresh member,
    and links that span what is near, so that full lists lose no connection.
    """
    sims = vectors @ vectors.T
    sims[nodes[:, None] == nodes[None, :]] = -2
    allowed = sims > bounds[:, None]
    if fresh is not None:
        allowed &= fresh[:, None] | fresh[None, :]
    order = np.argpartition(-sims, min(k, len(nodes) - 1), axis=1)[:, :k]
    rows = np.repeat(np.arange(len(nodes)), order.shape[1])
    columns = order.ravel()
    good = allowed[rows, columns]
    rows, columns = rows[good], columns[good]
    found = [(nodes[rows], nodes[columns], sims[rows, columns], np.zeros(len(rows), bool))]
    spanned = spanning_links(sims >= threshold - _SLACK)
    if spanned:
        a, b = np.array(spanned).T
        found.append((nodes[a], nodes[b], sims[a, b], np.ones(len(a), bool)))
    return [np.concatenate(parts) for parts in zip(*found)]


def _started(points: DataFrame, k: int, threshold: float, seed: int) -> DataFrame:
    """Pairs from ``TABLES`` random orders, in which each leaf of neighbours is compared.

    A vector's place is the sign pattern of its products with random directions. Places
    are split by range, ties by node, so a crowd of near copies fills many leaves.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 1 << np.arange(23, -1, -1, dtype=np.int64)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("v")).to_numpy() // 4
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                planes = np.random.default_rng([seed, int(size)]).standard_normal((size, TABLES * 24))
                signs = (_matrix(part.column("v")) @ planes > 0).reshape(part.num_rows, TABLES, 24)
                keys = signs @ bits
                for t in range(TABLES):
                    own = [
                        pa.array(np.full(part.num_rows, t, np.int32)),
                        pa.array(np.full(part.num_rows, size, np.int32)),
                        pa.array(keys[:, t]),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [*own, part.column("node"), part.column("v")],
                        names=["t", "dim", "key", "node", "v"],
                    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["t", "dim"], leaf=LEAF):
            nodes = rows.column("node").to_numpy()
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    vectors = _matrix(rows.column("v").slice(a, b - a))
                    found.append(_best(nodes[a:b], vectors, np.full(b - a, -2.0), None, k, threshold))
            if found:
                yield _pairs(*(np.concatenate(parts) for parts in zip(*found)))

    order = ["t", "dim", "key", "node"]
    return (
        points.select("node", "v")
        .mapInArrow(placed, "t int, dim int, key bigint, node bigint, v binary")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(compared, _PAIR)
    )


def _lists(pairs: DataFrame, old: DataFrame | None, k: int) -> DataFrame:
    """The ``k`` nearest known partners of each node, in both directions; fresh if not in ``old``."""
    known = pairs.select("node", "other", "sim", F.lit(True).alias("fresh"))
    known = known.unionByName(
        known.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim", "fresh")
    )
    if old is not None:
        known = known.unionByName(old.select("node", "other", "sim", F.lit(False).alias("fresh")))
    best = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    return (
        known.groupBy("node", "other")
        .agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
    )


def _descended(points: DataFrame, lists: DataFrame, k: int, threshold: float, seed: int) -> DataFrame:
    """Pairs from comparing, around each node, its neighbours and those it is a neighbour of.

    Groups larger than a leaf are cut at random into tasks of about that size, another
    way for each ``seed``. Pairs of two old members of a smaller group were compared before.
    """
    around = (
        lists.select(F.col("node").alias("hub"), F.col("other").alias("member"), "fresh")
        .unionByName(lists.select(F.col("other").alias("hub"), F.col("node").alias("member"), "fresh"))
        .groupBy("hub", "member")
        .agg(F.max("fresh").alias("fresh"))
    )
    around = written(around, "nn-around")
    hubs = (
        around.groupBy(F.col("hub").alias("h"))
        .agg(F.max("fresh").alias("any"), F.ceil(F.count("*") / LEAF).cast("int").alias("parts"))
        .filter("any")
        .drop("any")
    )
    hubs = written(hubs, "nn-hubs")
    full = lists.groupBy("node").agg(
        F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("bound")
    )
    ready = written(points.select("node", "v", "dim").join(full, "node", "left"), "nn-points")
    part = F.pmod(F.xxhash64(F.lit(seed), "member"), F.col("parts")).cast("int").alias("part")
    keys = ["hub", "part", "dim"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, keys):
            nodes = rows.column("member").to_numpy()
            bounds = rows.column("bound").to_numpy()
            fresh = rows.column("fresh").to_numpy()
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1 and fresh[a:b].any():
                    vectors = _matrix(rows.column("v").slice(a, b - a))
                    found.append(_best(nodes[a:b], vectors, bounds[a:b], fresh[a:b], k, threshold))
            if found:
                yield _pairs(*(np.concatenate(parts) for parts in zip(*found)))

    return (
        around.join(hubs, F.col("hub") == F.col("h"))
        .select("hub", part, "member", (F.col("fresh") | (F.col("parts") > 1)).alias("fresh"))
        .join(ready, F.col("member") == F.col("node"))
        .select(*keys, "member", "fresh", F.coalesce("bound", F.lit(-2.0).cast("float")).alias("bound"), "v")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compared, _PAIR)
    )


def _verified(points: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Distinct undirected links (a, b) whose cosine in double precision reaches the threshold."""
    near = (
        pairs.filter(F.col("sim") >= threshold - _SLACK)
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )
    left = points.select(F.col("node").alias("a"), F.col("u").alias("ua"))
    right = points.select(F.col("node").alias("b"), F.col("u").alias("ub"))
    return (
        near.join(left, "a")
        .join(right, "b")
        .filter(F.size("ua") == F.size("ub"))
        .filter(_dot("ua", "ub") >= threshold)
        .select("a", "b")
    )


def _crowd_counts(crowd: DataFrame, threshold: float) -> DataFrame:
    """(node, links): exact links of each node within its component, by pairs of tiles.

    ``crowd`` has component, node, n, u. What comes back are counts per tile, not pairs.
    """
    sizes = crowd.groupBy(F.col("component").alias("c")).agg(
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles")
    )
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    rows = (
        crowd.join(written(sizes, "nn-tiles"), F.col("component") == F.col("c"))
        .withColumn("mine", tile)
        .withColumn("theirs", met)
        .select(
            "component",
            F.least("mine", "theirs").alias("p"),
            F.greatest("mine", "theirs").alias("q"),
            (F.col("mine") > F.col("theirs")).cast("int").alias("side"),
            "node",
            "n",
            "u",
        )
    )
    keys = ["component", "p", "q"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, keys):
            nodes, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
            side, p, q = (rows.column(c).to_numpy() for c in ("side", "p", "q"))
            vectors = rows.column("u").combine_chunks()
            links = np.zeros(len(nodes), np.int64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                # Vectors of one component are of one length, those of a batch need not be.
                values = vectors.slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)
                near = values @ values.T >= threshold
                if p[a] != q[a]:
                    near &= side[a:b, None] != side[None, a:b]
                near &= nodes[a:b, None] != nodes[None, a:b]
                links[a:b] = near @ n[a:b]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links)], names=["node", "links"])

    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(counted, "node bigint, links bigint")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )


def _resolved(points: DataFrame, lists: DataFrame, pairs: DataFrame, k: int, threshold: float):
    """(node, component, links) of every class: listed links, or exact ones where a list is full."""
    known = lists.select("node", "other", "sim").unionByName(
        pairs.filter("link").select("node", "other", "sim")
    )
    links = written(_verified(points, known, threshold), "nn-links")
    comps = components(links)
    grouped = written(
        points.join(comps.withColumnRenamed("node", "m"), F.col("node") == F.col("m"), "left").select(
            "node", "n", "u", F.coalesce("component", "node").alias("component")
        ),
        "nn-grouped",
    )
    full = lists.filter((F.col("place") == k) & (F.col("sim") >= threshold - _SLACK))
    crowded = (
        grouped.join(full.select(F.col("node").alias("m")), F.col("node") == F.col("m"), "left_semi")
        .select(F.col("component").alias("c"))
        .distinct()
    )
    crowded = written(crowded, "nn-crowded")
    crowd = grouped.join(crowded, F.col("component") == F.col("c"), "left_semi")
    exact = written(_crowd_counts(crowd, threshold), "nn-exact")
    copies = points.select(F.col("node").alias("b"), "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    listed = both.join(copies, "b").groupBy(F.col("a").alias("l")).agg(F.sum("n").alias("listed"))
    return written(
        grouped.drop("u")
        .join(written(listed, "nn-listed"), F.col("node") == F.col("l"), "left")
        .join(exact.withColumnRenamed("node", "e"), F.col("node") == F.col("e"), "left")
        .select(
            "node",
            "component",
            (F.coalesce("links", "listed", F.lit(0)) + F.col("n") - 1).alias("links"),
        ),
        "nn-resolved",
    )


def _sampled_recall(
    points: DataFrame, group: DataFrame, resolved: DataFrame, threshold: float, sample: int
) -> tuple[float, int, int]:
    """(share, linked, asked): mean share of true links that were found, over sampled vectors
    of ``group`` that have any; how many these were; how many vectors were compared with all others.
    """
    chosen = group.orderBy(F.xxhash64(F.lit(3), "node"), "node").limit(sample)
    asked = [(r["node"], np.array(r["u"]), r["n"]) for r in chosen.select("node", "u", "n").collect()]
    queries = points.sparkSession.sparkContext.broadcast(asked)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true: dict[int, int] = {}
        by_size: dict[int, list] = {}
        for node, u, _ in queries.value:
            by_size.setdefault(len(u), []).append((node, u))
        for batch in batches:
            sizes = batch.column("u").value_lengths().to_numpy()
            for size, group in by_size.items():
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                if not part.num_rows:
                    continue
                values = part.column("u").flatten().to_numpy().reshape(part.num_rows, size)
                nodes, n = part.column("node").to_numpy(), part.column("n").to_numpy()
                for some in (group[i : i + 1024] for i in range(0, len(group), 1024)):
                    ids = np.array([node for node, _ in some])
                    near = np.stack([u for _, u in some]) @ values.T >= threshold
                    near &= ids[:, None] != nodes[None, :]
                    for node, count in zip(ids.tolist(), (near @ n).tolist()):
                        true[node] = true.get(node, 0) + count
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(true), pa.int64()), pa.array(list(true.values()), pa.int64())],
            names=["q", "real"],
        )

    true = (
        points.select("node", "n", "u")
        .mapInArrow(compare, "q bigint, real bigint")
        .groupBy("q")
        .agg(F.sum("real").alias("real"))
        .filter("real > 0")
    )
    own = points.select(F.col("node").alias("p"), F.col("n").alias("copies"))
    found = true.join(resolved, F.col("q") == F.col("node")).join(own, F.col("q") == F.col("p"))
    share = (F.col("links") - F.col("copies") + 1) / F.col("real")
    mean, linked = found.agg(F.avg(share), F.count("*")).first()
    return (1.0 if mean is None else mean), linked, len(asked)


def _audit(points: DataFrame, resolved: DataFrame, threshold: float, sample: int, k: int = NEIGHBOURS) -> float:
    """Mean recall of sampled vectors, of the worse of two groups.

    Vectors with fewer than ``k`` found links are audited apart from those in crowds,
    which are easy. Each sample grows until enough of its vectors have links.
    """
    counted = points.join(
        resolved.select(F.col("node").alias("r"), "links"), F.col("node") == F.col("r")
    ).withColumn("crowded", F.col("links") - F.col("n") + 1 >= k)
    worst = 1.0
    for group in (counted.filter("not crowded"), counted.filter("crowded")):
        size = sample
        while True:
            mean, linked, asked = _sampled_recall(points, group, resolved, threshold, size)
            if linked >= LINKED or asked < size or size >= MOST_AUDITED:
                break
            size *= 4
        worst = min(worst, mean)
    return worst


def _compared_all(points: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs from comparing every vector with every other, a block of vectors per scan.

    Per member of a piece its ``k`` best links there, and links that span what is near.
    """
    spark = points.sparkSession
    blocks = -(-points.count() // EXACT_BLOCK)
    cut = written(
        points.select("node", "v", "dim", F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("b")), "nn-blocks"
    )
    pairs = None
    for b in range(blocks):
        by_size: dict[int, list] = {}
        for r in cut.filter(F.col("b") == b).toLocalIterator():
            by_size.setdefault(r["dim"], []).append((r["node"], bytes(r["v"])))
        asked = spark.sparkContext.broadcast(by_size)

        def compared(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            own = {
                size: (np.array([n for n, _ in rows]), np.frombuffer(b"".join(v for _, v in rows), np.float32).reshape(-1, size))
                for size, rows in asked.value.items()
            }
            for batch in batches:
                sizes = batch.column("dim").to_numpy()
                for size, (theirs, others) in own.items():
                    at = np.flatnonzero(sizes == size)
                    for i in range(0, len(at), EXACT_BLOCK):
                        part = batch.take(pa.array(at[i : i + EXACT_BLOCK]))
                        nodes, vectors = part.column("node").to_numpy(), _matrix(part.column("v"))
                        near = vectors @ others.T >= threshold - _SLACK
                        near &= nodes[:, None] != theirs[None, :]
                        a, b = near.any(axis=1), near.any(axis=0)
                        a |= np.isin(nodes, theirs[b])
                        b &= ~np.isin(theirs, nodes)
                        if a.any():
                            both = np.concatenate([nodes[a], theirs[b]]), np.concatenate([vectors[a], others[b]])
                            n = len(both[0])
                            found = _best(*both, np.full(n, threshold - 2 * _SLACK), None, k, threshold)
                            yield _pairs(*found)

        new = written(cut.mapInArrow(compared, _PAIR), "nn-exhaustive")
        pairs = new if pairs is None else pairs.unionByName(new)
        asked.unpersist()
    return pairs


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    k: int = NEIGHBOURS,
    rounds: int = ROUNDS,
    audited: int = AUDITED,
    recall: float = RECALL,
    repairs: int = 3,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, audited_recall.

    Vectors of the same direction are folded into classes. A graph of the ``k`` nearest
    known partners starts from random orders and is refined by comparing neighbours of
    neighbours until no list changes or ``rounds`` are over. Every pair that is near
    in any comparison also joins its component, whether or not a list has room.
    Links are confirmed in double precision. A list full of links is saturated: then it
    is enlarged to its whole component, whose links are counted exactly, tile by tile.
    The result is audited against brute force for ``audited`` sampled vectors with fewer
    than ``k`` links found and as many of the others; while either group is below
    ``recall`` further random orders are added, at most ``repairs`` times. If that is
    not enough every vector is compared with every other, in quadratic time.

    NULL and zero vectors and those with NULL or non-finite components link with
    nothing, as do vectors of different lengths. A NULL vec_id counts as a vector but
    never names a component that has other ids. Repeated rows are linked vectors. An
    empty table gives no rows; other columns are ignored.
    """
    rows = with_units(vectors, vec_id, embedding)
    rows = rows.withColumns({"h": F.xxhash64("u"), "h2": F.xxhash64(F.lit(7), "u")})
    rows = written(rows, "nn-rows")
    sound = rows.filter("u is not null")
    folded = sound.groupBy("h", "h2").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.any_value("u").alias("u")
    )
    classes = written(folded.withColumn("node", F.monotonically_increasing_id()), "nn-classes")
    points = written(
        classes.select("node", "n", "u").mapInArrow(
            _with_singles, "node bigint, n bigint, u array<double>, v binary, dim int"
        ),
        "nn-points",
    )
    lists, pairs, found, cuts = None, None, 0.0, 0
    for attempt in range(repairs + 1):
        new = written(_started(points, k, threshold, 101 + attempt), "nn-started")
        pairs = new if pairs is None else pairs.unionByName(new)
        lists = written(_lists(new, lists, k), "nn-lists")
        for _ in range(rounds):
            if lists.filter("fresh").isEmpty():
                break
            cuts += 1
            new = written(_descended(points, lists, k, threshold, cuts), "nn-descended")
            pairs = pairs.unionByName(new.filter("link"))
            lists = written(_lists(new, lists, k), "nn-lists")
        resolved = _resolved(points, lists, pairs, k, threshold)
        found = _audit(points, resolved, threshold, audited, k)
        if found >= recall:
            break
    else:
        pairs = _compared_all(points, k, threshold)
        lists = written(_lists(pairs, None, k), "nn-lists")
        resolved = _resolved(points, lists, pairs, k, threshold)
        found = _audit(points, resolved, threshold, audited, k)
    named = classes.join(resolved, "node").select("h", "h2", "least", "component", "links")
    named = written(named, "nn-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(
        named.join(least, "component").select(
            F.col("h").alias("c_h"), F.col("h2").alias("c_h2"), "component_id", "links"
        ),
        "nn-named",
    )
    linked = sound.select("vec_id", "h", "h2").join(
        named, (F.col("h") == F.col("c_h")) & (F.col("h2") == F.col("c_h2"))
    )
    alone = rows.filter("u is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "links", "component_id")
        .unionByName(alone)
        .select(
            "vec_id",
            F.col("links").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
            F.lit(round(found, 4)).alias("audited_recall"),
        )
    )


def _with_singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each vector packed in single precision, and its length."""
    for batch in batches:
        u = batch.column("u").to_pylist()
        packed = [np.asarray(x, np.float32).tobytes() for x in u]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(packed, pa.binary()), pa.array([len(x) for x in u], pa.int32())],
            names=["node", "n", "u", "v", "dim"],
        )


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))
