"""Document quality: classifier evidence shrunk through host and path by empirical Bayes."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written
from .common import keep_rows, quoted, row_keys, table

TRAINING_ROWS = 200_000  # bound on the labelled rows that the classifier is fitted to
_SURE = 1e-6

# Shares of words that look odd, per kind of oddity.
_ODDITIES = {
    "capitals": r"\p{Lu}{3,}",
    "symbols": r"[^\p{L}\p{N}\s.,;:'\"()-]+",
    "doubled": r"([^\p{L}\p{N}\s])\1+",
    "bars": r"\s[|/\\_=~]+\s",
    "echoes": r"(?<!\S)(\S+)\s+\1(?!\S)",
    "digits": r"[0-9]+",
    "lines": r"\n",
}
FEATURES = [*_ODDITIES, "distinct", "word_length", "words"]


def features(text: Column) -> dict[str, Column]:
    """Numbers that describe the shape of a whole text, whatever its language."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_count(text, F.lit(r"\S+"))
    some = F.greatest(words, F.lit(1))
    shares = {
        name: F.log1p(F.lit(100.0) * F.regexp_count(text, F.lit(pattern)) / some)
        for name, pattern in _ODDITIES.items()
    }
    distinct = F.size(F.array_distinct(F.split(text, r"\s+"))) / some
    return shares | {
        "distinct": distinct.cast("double"),
        "word_length": F.log1p(F.length(text) / some),
        "words": F.log1p(words.cast("double")),
    }


def _fitted(examples: DataFrame, most: int) -> tuple[list[float], float, float] | None:
    """Weights, intercept and share of good documents; None unless both classes occur.

    Above ``most`` examples, those with the smallest hashes of their ids are taken.
    """
    n = examples.count()
    if n > most:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * most / n)
        examples = examples.filter(share)
    seen = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}
    if len(seen) < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(examples)
    model = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4, maxIter=60).fit(ready)
    weights = [float(w) for w in model.coefficients]
    return weights, float(model.intercept), seen[1.0] / sum(seen.values())


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_SURE)), F.lit(1 - _SURE))
    return F.log(p / (1 - p))


def _strength(between: float, groups: int, parents: int, within: float, free: float) -> float:
    """Rows of evidence that a parent's rate is worth: within over between variance.

    One-way analysis of variance for groups of unequal size; without any difference
    between the groups a parent outweighs them.
    """
    variance = (between - (groups - parents) * within) / free if free > 0 else 0.0
    return min(1e9, within / variance) if variance > 0 else 1e9


def site_rates(rows: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Counts and evidence by (host, path) with those of the host, and the global prior.

    ``rows`` has host, path, evidence. Sums are built per (host, path) first, so a host
    with a third of the rows arrives as a few partial sums per task.
    """
    paths = written(
        rows.groupBy("host", "path").agg(
            F.count("*").alias("n"),
            F.sum("evidence").alias("s"),
            F.sum(F.col("evidence") * F.col("evidence")).alias("q"),
        ),
        "site-paths",
    )
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.count("*").alias("host_paths")
    )
    hosts = written(hosts.withColumnRenamed("host", "h"), "site-hosts")
    sites = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "sites")
    n, s, q, groups = paths.agg(F.sum("n"), F.sum("s"), F.sum("q"), F.count("*")).first()
    if not n:
        return sites, {"rate": 0.5, "host": 1e9, "path": 1e9}
    mean = s / n
    apart = F.col("host_s") / F.col("host_n") - mean
    n_hosts, host_between, host_squares = hosts.agg(
        F.count("*"), F.sum(F.col("host_n") * apart * apart), F.sum(F.pow("host_n", F.lit(2)))
    ).first()
    apart = F.col("s") / F.col("n") - F.col("host_s") / F.col("host_n")
    path_between, path_squares = sites.agg(
        F.sum(F.col("n") * apart * apart), F.sum(F.pow("n", F.lit(2)) / F.col("host_n"))
    ).first()
    within = max(1e-9, (q - n * mean * mean - host_between - path_between) / max(1, n - groups))
    return sites, {
        "rate": mean,
        "host": _strength(host_between, n_hosts, 1, within, n - host_squares / n),
        "path": _strength(path_between, groups, n_hosts, within, n - path_squares),
    }


def score(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    threshold: float = 0.5,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per document: k_id, k_hash, host, path, evidence, host_rate, path_rate, posterior, keep.

    ``evidence`` is the probability of good quality from a logistic regression on shape
    features of the whole text, fitted to at most ``training_rows`` labelled rows. The
    rate of a host is its mean evidence drawn to the global mean, that of a path its mean
    drawn to its host's rate, each by as many rows' worth as the spread between sites
    supports; a document's own evidence is left out of both. ``posterior`` combines the
    evidence, relative to the share of good training rows, with the path's rate as prior
    odds, and ``keep`` is posterior >= ``threshold``.

    NULL and empty texts are texts without words. NULL hosts and paths are sites of
    their own. Repeated rows count as often as they occur. Labels that are NULL or
    contradict themselves by id are left out; without labels of both kinds nothing is
    rejected (evidence and posterior 1). An empty table gives no rows. Other columns are
    ignored.
    """
    shape = features(quoted("text"))
    rows = written(
        docs.select(
            *row_keys(docs), quoted(host).alias("host"), quoted(path).alias("path"), *(c.alias(n) for n, c in shape.items())
        ),
        "quality-features",
    )
    known = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("label"), F.max("quality").alias("high"))
        .filter("label = high")
        .drop("high")
    )
    examples = written(
        rows.join(known, F.col("k_id") == F.col("doc_id")).select("doc_id", "label", *FEATURES),
        "quality-examples",
    )
    fit = _fitted(examples, training_rows)
    if fit is None:
        one = F.lit(1.0)
        return rows.select(
            "k_id", "k_hash", "host", "path", one.alias("evidence"), one.alias("host_rate"),
            one.alias("path_rate"), one.alias("posterior"), F.lit(True).alias("keep"),
        )
    weights, intercept, base = fit
    linear = F.lit(intercept)
    for name, weight in zip(FEATURES, weights):
        linear = linear + F.lit(weight) * F.col(name)
    rows = rows.select("k_id", "k_hash", "host", "path", (1 / (1 + F.exp(-linear))).alias("evidence"))
    sites, prior = site_rates(rows)
    sites = sites.withColumnsRenamed({"host": "s_host", "path": "s_path"})
    same = F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path"))
    own = F.col("evidence")
    host_rate = (F.col("host_s") - own + prior["host"] * prior["rate"]) / (
        F.col("host_n") - 1 + prior["host"]
    )
    path_rate = (F.col("s") - own + prior["path"] * F.col("host_rate")) / (
        F.col("n") - 1 + prior["path"]
    )
    odds = _logit(own) - _logit(F.lit(base)) + _logit(F.col("path_rate"))
    return (
        rows.join(sites, same)
        .withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .select(
            "k_id", "k_hash", "host", "path", "evidence", "host_rate", "path_rate", "posterior",
            (F.col("posterior") >= threshold).alias("keep"),
        )
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: documents that are not rejected."""
    return keep_rows(docs, score(docs, labels).filter("keep").select("k_id", "k_hash"))


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.withColumnRenamed("k_id", "doc_id").drop("k_hash")
