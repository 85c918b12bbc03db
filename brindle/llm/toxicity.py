"""Toxicity: logistic regression fitted by FTRL-proximal on hashed word features.

Features are words, word pairs and pairs with one word between them, each present
or not. Every coordinate has a learning rate of its own, and the L1 term leaves
most weights at exactly zero, so that what is broadcast is a short sorted list.

The fit takes a bounded sample of labelled rows (``max_rows`` of each class, those
with the smallest hash), dealt over at most ``2 * max_rows / rows_per_shard`` shards
that each run FTRL over their rows; the weights are averaged. Sampling the classes at different rates only
moves the intercept, which is put back by the counts of all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.tables import bounded

HASH_BITS = 28


@dataclass(frozen=True)
class Settings:
    max_rows: int = 8_000
    rows_per_shard: int = 4_000
    epochs: int = 6
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1


@dataclass(frozen=True)
class Weights:
    """Sorted feature numbers, their weights, and the intercept."""

    features: np.ndarray
    values: np.ndarray
    intercept: float


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all rows, repeats included, and the row of each."""
    low = text.fold_latin(data)
    starts, ends, first = text.words(low, at, text.ALNUM)
    codes = text.hashes(low, starts, ends)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    made, rows = [codes], [row]
    for apart, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        if len(codes) > apart:
            same = row[apart:] == row[:-apart]
            pair = text.mix(codes[:-apart] * np.uint64(salt) + codes[apart:])
            made.append(pair[same])
            rows.append(row[:-apart][same])
    numbers = (np.concatenate(made) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)
    return numbers, np.concatenate(rows)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the features that occur in ``rows``; the last coordinate is the intercept."""
    if not rows:
        return np.zeros(0, np.uint32), np.zeros(0), 0.0
    seen, local = np.unique(np.concatenate(rows), return_inverse=True)
    cuts = np.cumsum([len(r) for r in rows])[:-1]
    local = np.split(local, cuts)
    z, n = np.zeros(len(seen) + 1), np.zeros(len(seen) + 1)

    def weights(i: np.ndarray | slice) -> np.ndarray:
        zi = z[i]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for k in order.permutation(len(rows)):
            i = np.append(local[k], len(seen))
            w = weights(i)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w.sum())))))
            g = p - labels[k]
            now = n[i]
            z[i] += g - (np.sqrt(now + g * g) - np.sqrt(now)) / s.alpha * w
            n[i] = now + g * g
    w = weights(slice(None))
    kept = np.flatnonzero(w[:-1])
    return seen[kept], w[kept], float(w[-1])


def fit(labelled: DataFrame, key: str = "doc_id", body: str = "text", label: str = "label",
        settings: Settings = Settings()) -> Weights:
    """Weights from rows of ``key``, ``body`` and 0/1 ``label``; rows with a null label don't count.

    With rows of one class only, the score is that class's share.
    """
    s = settings
    known = labelled.select(
        F.col(key).alias("_key"), F.col(body).alias("_text"), F.col(label).cast("int").alias("_label")
    ).where("_label in (0, 1)")
    totals = {r._label: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(totals) < 2:
        return Weights(np.zeros(0, np.uint32), np.zeros(0), 30.0 if 1 in totals else -30.0)
    ids = bounded(known.where("_label = 1").select("_key"), "_key", s.max_rows).unionByName(
        bounded(known.where("_label = 0").select("_key"), "_key", s.max_rows)
    )
    shards = max(1, sum(min(s.max_rows, n) for n in totals.values()) // s.rows_per_shard)
    # at most 2 * max_rows keys
    sample = known.join(F.broadcast(ids.distinct()), "_key", "left_semi")

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            label_of = batch.column("_label").to_numpy(zero_copy_only=False)
            for first, end, data, at in text.pieces(batch.column("_text")):
                numbers, row = features(data, at)
                both = np.unique((row.astype(np.uint64) << np.uint64(32)) | numbers)
                cuts = np.searchsorted(both >> np.uint64(32), np.arange(1, end - first))
                rows += np.split((both & np.uint64(0xFFFFFFFF)).astype(np.uint32), cuts)
                labels += list(label_of[first:end])
        found, w, b = ftrl(rows, np.array(labels, float), s)
        yield pa.RecordBatch.from_pydict(
            {"feature": np.append(found.astype(np.int64), -1), "weight": np.append(w, b)}
        )

    dealt = sample.repartition(shards, F.xxhash64(F.lit("shard"), "_key"))
    got = dealt.mapInArrow(train, "feature bigint, weight double").groupBy("feature").agg(
        (F.sum("weight") / shards).alias("weight")
    ).where("weight != 0").toPandas()
    intercept = float(got.loc[got.feature == -1, "weight"].sum())
    got = got[got.feature >= 0].sort_values("feature")
    # the classes were sampled at different rates
    rate = {c: min(1.0, s.max_rows / totals[c]) for c in (0, 1)}
    intercept += math.log(rate[0] / rate[1])
    return Weights(got.feature.to_numpy(np.uint32), got.weight.to_numpy(np.float64), intercept)


def score_piece(data: np.ndarray, at: np.ndarray, weights: Weights) -> np.ndarray:
    """Probability of label 1 for each text; each feature counts once."""
    margin = np.full(len(at) - 1, weights.intercept)
    if len(weights.features) and len(data):
        numbers, row = features(data, at)
        place = np.searchsorted(weights.features, numbers)
        place[place == len(weights.features)] = 0
        hit = weights.features[place] == numbers
        pairs = np.unique(row[hit].astype(np.int64) * len(weights.features) + place[hit])
        row, place = np.divmod(pairs, len(weights.features))
        margin += np.bincount(row, weights.values[place], len(margin))
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def score(documents: DataFrame, weights: Weights, key: str = "doc_id", body: str = "text") -> DataFrame:
    """``key`` and ``score`` of every row: no shuffle, whole texts; null and empty texts
    get the intercept's probability. Extra columns are not read."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            scores = [score_piece(data, at, w) for _, _, data, at in text.pieces(batch.column(1))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["key", "score"])

    out = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    return out.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
