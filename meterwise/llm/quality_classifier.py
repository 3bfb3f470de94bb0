"""Quality classification by hierarchical empirical Bayes.

A logistic regression on counts of the whole text gives each document's own
evidence, as a log likelihood ratio of good against bad. Its site is worth
knowing too: the share of good documents of its host, and of its path (host and
first path segment), estimated from all documents by grouped aggregation. Both
levels are beta priors whose strength is estimated from the data (method of
moments): a sparse path is drawn towards its host, a sparse host towards the
global share; a host of one path has one level only. A document's posterior joins its evidence with its path's prior,
from which its own contribution is taken out.

Only the regression is fitted on a bounded sample (``per_class`` labelled rows of
each class, by hash); the site statistics cover all documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm import wordhash as W
from meterwise.llm.store import Scratch

ADDED = ["host", "path", "evidence", "site_prior", "quality", "kept"]
FEATURES = ["letters", "digits", "symbols", "capitals", "shouts", "stops", "breaks",
            "word_length", "log_words", "new_words", "new_pairs", "bars"]


def _byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256)
    table[list(chars)] = 1.0
    return table


TABLES = np.stack([
    _byte_table(bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)])), _byte_table(b"0123456789"),
    _byte_table(b"#*$%&<>@^~_=+\\{}[]"), _byte_table(bytes(range(65, 91))), _byte_table(b"!"),
    _byte_table(b".?:;"), _byte_table(b"\n"), _byte_table(b"|"), _byte_table(bytes([*range(0, 0x80), *range(0xC0, 256)]))])


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each whole text (null counts as empty)."""
    out = np.zeros((len(texts), len(FEATURES)))
    hasher = W.Hasher(lower=True)
    for a, b, data, offsets in W.slices(texts):
        size = np.diff(offsets)
        rows = np.flatnonzero(size)
        if not len(rows):
            continue
        counts = np.stack([np.add.reduceat(t[data], offsets[:-1][rows]) for t in TABLES])
        chars = np.maximum(counts[-1], 1)
        _, _, words, first = hasher.words(data, offsets)
        n = np.diff(first)
        pairs = words[:-1] * W.U(3) + words[1:] if len(words) > 1 else words[:0]
        fresh = np.ones((2, len(rows)))
        for i, r in enumerate(rows):
            if n[r] > 1:
                fresh[0, i] = len(np.unique(words[first[r]:first[r + 1]])) / n[r]
                fresh[1, i] = len(np.unique(pairs[first[r]:first[r + 1] - 1])) / (n[r] - 1)
        k = np.maximum(n[rows], 1)
        out[a + rows] = np.stack([
            counts[0] / chars, counts[1] / chars, counts[2] / k, counts[3] / np.maximum(counts[0], 1), counts[4] / k, counts[5] / k,
            counts[6] / k, chars / k, np.log1p(n[rows]), fresh[0], fresh[1], counts[7] / k]).T
    return out


class Evidence:
    """A fitted regression: means, scales, weights; scores are log likelihood ratios."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.hstack([z, z[:, :] ** 2 / 8, np.ones((len(z), 1))])
        w = np.zeros(z.shape[1])
        penalty = ridge * len(z) * np.eye(z.shape[1]) / 10
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)), z.T @ (y - p) - penalty @ w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        share = y.mean()
        self.weights, self.base = w, math.log(share) - math.log1p(-share)

    def parts(self) -> tuple:
        """Plain arrays, for a broadcast: an instance would need the package on the executors."""
        return self.mean, self.scale, self.weights, self.base


def evidence_scores(parts: tuple, x: np.ndarray) -> np.ndarray:
    mean, scale, weights, base = parts
    z = np.clip((x - mean) / scale, -8, 8)
    z = np.hstack([z, z ** 2 / 8, np.ones((len(z), 1))])
    return np.clip(z @ weights - base, -30, 30)


def _sample_features(batches):
    for batch in batches:
        x = text_features(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["good", "x"])


def fit_evidence(docs: DataFrame, labels: DataFrame, text: Column, id_col: str, per_class: int) -> tuple[Evidence | None, float]:
    """The regression and the labelled share of good documents (one vote for each document)."""
    votes = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    n = {r.good: r["count"] for r in votes.groupBy("good").count().collect()}
    share = (n.get(True, 0) + 1) / (sum(n.values()) + 2)
    if len(n) < 2:
        return None, share
    u = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    limit = F.when(F.col("good"), per_class / n[True]).otherwise(per_class / n[False])
    # About 2 * per_class rows of an id and a flag: bounded by the parameter, so broadcast.
    sample = F.broadcast(votes.filter(u < limit).select(F.col("doc_id").alias("_label_id"), "good"))
    # An id on several rows gives one text, so the driver gets as many rows as ids.
    rows = (docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("text")).join(sample, F.col("_id") == F.col("_label_id"))
            .groupBy("_label_id", "good").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .select("good", "text").mapInArrow(_sample_features, "good boolean, x array<double>").collect())
    y = np.array([float(r.good) for r in rows])
    if not len(y) or y.min() == y.max():
        return None, share
    return Evidence(np.array([r.x for r in rows]), y), share


def _strength(total: float, groups: float, spread: float, mean: float) -> float:
    """How many documents a level's prior is worth, by the method of moments."""
    unit = max(mean * (1 - mean), 1e-9)
    rho = (spread / unit - groups) / max(total - groups, 1.0)
    rho = min(max(rho, 1e-4), 0.5)
    return 1 / rho - 1


def site_of(url: Column) -> tuple[Column, Column]:
    """Host and path level of a URL or source name; a null one is the empty host."""
    plain = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    plain = F.regexp_replace(plain, r"[?#].*$", "")
    return F.lower(F.substring_index(plain, "/", 1)), F.lower(F.substring_index(plain, "/", 2))


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     site_col: str = "source", per_class: int = 4000, threshold: float = 1 / 3) -> DataFrame:
    """``docs`` with ``host, path, evidence, site_prior, quality`` and ``kept`` (quality >= threshold).

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1); the mean of a document's labels counts.

    * null or empty text: judged by the features of an empty text;
    * a null site is a site of its own (the empty host); a null id is never labelled;
    * repeated rows are documents of their own;
    * labels of one class only, or none: no evidence (0), the prior alone decides;
    * an empty table gives an empty result; every other column passes through, and
      one named like an added column is replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality-classifier")
    text = F.col(f"`{text_col}`").cast("string")
    model, share = fit_evidence(docs, labels, text, id_col, per_class)
    shared = spark.sparkContext.broadcast(model and model.parts())

    def evidence(texts: pa.Array) -> pa.Array:
        found = shared.value
        return pa.array(evidence_scores(found, text_features(texts)) if found else np.zeros(len(texts)))

    host, path = site_of(F.col(f"`{site_col}`"))
    kept = [c for c in docs.columns if c not in ADDED]
    judged = docs.select(*(F.col(f"`{c}`") for c in kept), host.alias("host"), path.alias("path"),
                         F.arrow_udf(evidence, "double")(text).alias("evidence"))
    base = math.log(share) - math.log1p(-share)
    own = 1 / (1 + F.exp(-(F.col("evidence") + base)))

    paths = scratch.stage(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(own).alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    one = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good"), F.count("*").alias("groups"),
                    F.sum(F.col("host_good") ** 2 / F.col("host_n")).alias("squares")).first()
    total = one["n"] or 0
    mean = (one["good"] + share) / (total + 1) if total else share
    spread = one["squares"] - one["good"] ** 2 / total if total else 0.0
    host_strength = _strength(total, one["groups"], spread, mean)
    sites = paths.join(hosts, "host")
    two = sites.agg(F.count("*").alias("groups"), F.countDistinct("host").alias("hosts"), F.sum(
        F.col("n") * (F.col("good") / F.col("n") - F.col("host_good") / F.col("host_n")) ** 2).alias("spread")).first()
    path_strength = _strength(total, (two["groups"] - two["hosts"]) or 0, two["spread"] or 0.0, mean)
    sites = Scratch(spark, "quality-classifier-sites").stage(sites, "sites", keep=True)
    scratch.clear()

    own = 1 / (1 + F.exp(-(F.col("row.evidence") + base)))
    known = (judged.select(F.struct("*").alias("row"), "host", "path")
             .join(sites.withColumnsRenamed({"n": "path_n", "good": "path_good"}), ["host", "path"]))
    host_prior = (F.col("host_good") - own + host_strength * mean) / (F.col("host_n") - 1 + host_strength)
    path_prior = (F.col("path_good") - own + path_strength * host_prior) / (F.col("path_n") - 1 + path_strength)
    # A host of one path: the path says what the host says, and its documents count once.
    prior = F.when(F.col("path_n") == F.col("host_n"), host_prior).otherwise(path_prior)
    prior = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
    known = known.select("row", "host", "path", prior.alias("site_prior"))
    quality = 1 / (1 + F.exp(-(F.col("row.evidence") + F.log(F.col("site_prior") / (1 - F.col("site_prior"))))))
    return (known.withColumn("quality", quality).withColumn("kept", F.col("quality") >= threshold)
            .select(*(F.col(f"row.`{c}`") for c in kept), "host", "path", F.col("row.evidence").alias("evidence"),
                    "site_prior", "quality", "kept"))
