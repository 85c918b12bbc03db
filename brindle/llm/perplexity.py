"""Quality by perplexity: an interpolated modified Kneser-Ney model over bytes.

Trusted text, all of it, is counted into runs of ``ORDER`` bytes. From there on the
model is made of tables keyed by run, dealt over the cluster: continuation counts by
grouping a table by its runs' ends, contexts by grouping by their beginnings, and the
probabilities of an order by joining its counts with its contexts and with the order
below. Contexts that begin before the text's start are zero bytes.

To score, the whole model is looked up, in passes over the texts: what is known of a
byte after two given bytes lies together, so the tables are cut by these two bytes into
shards of about ``Settings.entries`` runs (a single pair of bytes has less than 2^25), and
a pass scores the bytes that belong to one shard. A shard is a file that Spark hands to the
executors, where each worker puts it into hash tables; the driver knows its name only. More
trusted text makes more passes, not larger shards; a document's parts are added up by the
hashes of its text.

A document's perplexity is that of its whole text per byte. It is kept if it lies between
the ``lowest`` and the ``highest`` quantile of the trusted documents of its language and
length: text that says one word over and over is too probable or too improbable for its
length, though not for a short one. Lengths are taken by powers of two. One trusted
document in ``held`` (by a hash of its key) is not counted into the model, and the
highest quantile is that of these, so that it is what unseen good text looks like; the
lowest is that of all, as what is counted is more probable. Where fewer than ``least`` of
the held have a language and length, the quantiles of the language at all lengths hold,
and if these are few, or the language is null, those of all.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.tables import written

ORDER = 5
FLUSH = 3_000_000
_EMPTY = np.uint64(2**64 - 1)
# Lengths from 16 to 2,048 bytes and more have quantiles of their own.
SHORTEST, LONGEST = 4, 11


@dataclass(frozen=True)
class Settings:
    entries: int = 1 << 22
    lowest: float = 0.002
    highest: float = 0.995
    held: int = 5
    least: int = 40
    accuracy: int = 10_000


def padded(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ORDER - 1 zero bytes before each, and the new place of each byte."""
    pad = ORDER - 1
    place = np.arange(len(data)) + pad * np.repeat(np.arange(1, len(at)), np.diff(at))
    out = np.zeros(len(data) + pad * (len(at) - 1), np.uint64)
    out[place] = data
    return out, place


def byte_runs(out: np.ndarray, place: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The run of ``order`` bytes that ends at each byte, first byte highest."""
    run = np.zeros(len(place), np.uint64)
    for back in range(order - 1, -1, -1):
        run = (run << np.uint64(8)) | out[place - back]
    return run


def count_runs(trusted: DataFrame, body: str) -> DataFrame:
    """``run`` and ``n`` over all trusted texts, summed up within each task first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(runs.astype(np.int64)), pa.array(counts)], ["run", "n"])

        for batch in batches:
            for _, _, data, at in text.pieces(batch.column(0)):
                new, n = np.unique(byte_runs(*padded(data, at)), return_counts=True)
                both = np.concatenate([runs, new])
                order = np.argsort(both, kind="stable")
                both, n = both[order], np.concatenate([counts, n])[order]
                heads = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else order
                runs, counts = both[heads], np.add.reduceat(n, heads) if len(both) else n
                if len(runs) > FLUSH:
                    yield out()
                    runs, counts = runs[:0], counts[:0]
        yield out()

    rows = trusted.select(F.col(body).alias("body")).mapInArrow(run, "run bigint, n bigint")
    return rows.groupBy("run").agg(F.sum("n").alias("n"))


def _tail(length: int) -> Column:
    """The last ``length`` bytes of a run."""
    return F.col("run").bitwiseAND(F.lit((1 << 8 * length) - 1).cast("bigint"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """What runs seen once, twice and more often give up."""
    n1, n2, n3, n4 = (
        float(x) for x in counts.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    )
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    return tuple(
        min(max(k - (k + 1) * y * above / here if here else 0.5 * k, 0.05), k - 0.05)
        for k, here, above in ((1, n1, n2), (2, n2, n3), (3, n3, n4))
    )


def probabilities(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """For orders 1 to ORDER, (run, n, p) and (context, gamma), from the counts of runs.

    ``gamma`` is the share that a context leaves to the order below.
    """
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):
        ends = tables[0].groupBy(_tail(order).alias("run")).agg(F.count("*").alias("n"))
        tables.insert(0, written(ends, "byte-runs"))
    made, shares = [], []
    for order, table in enumerate(tables, 1):
        d1, d2, d3 = _discounts(table)
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        context = F.shiftright("run", 8).alias("context")
        contexts = written(
            table.groupBy(context)
            .agg(F.sum("n").alias("total"), F.sum(discount).alias("left"))
            .select("context", "total", (F.col("left") / F.col("total")).alias("gamma")),
            "byte-contexts",
        )
        own = table.select("run", "n", context, _tail(order - 1).alias("lower")).join(contexts, "context")
        if order == 1:
            own = own.withColumn("p_lower", F.lit(1 / 256))
        else:
            below = made[-1].select(F.col("run").alias("lower"), F.col("p").alias("p_lower"))
            own = own.join(below, "lower")
        p = (F.col("n") - discount) / F.col("total") + F.col("gamma") * F.col("p_lower")
        made.append(written(own.select("run", "n", p.alias("p")), "byte-model"))
        shares.append(contexts.select("context", "total", "gamma"))
    return made, shares


class Table:
    """Runs and a number for each, in a hash table with free places beside the taken ones."""

    def __init__(self, runs: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(runs)).bit_length())
        home = self._home(runs)
        order = np.argsort(home, kind="stable")
        place = np.arange(len(runs))
        place += np.maximum.accumulate(home[order] - place) if len(runs) else place
        self.runs = np.full((1 << self.bits) + len(runs) + 1, _EMPTY)
        self.values = np.zeros(len(self.runs), np.float32)
        self.runs[place], self.values[place] = runs[order], values[order]
        last = int(place[-1]) + 2 if len(runs) else 0
        size = max(1 << self.bits, last)
        self.runs, self.values = self.runs[:size].copy(), self.values[:size].copy()

    def _home(self, runs: np.ndarray) -> np.ndarray:
        return (text.mix(runs + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each run is there, and its number (0 if not)."""
        place = self._home(runs)
        there = self.runs[place]
        found = there == runs
        going = np.flatnonzero(~found & (there != _EMPTY))
        while len(going):
            place[going] += 1
            there = self.runs[place[going]]
            found[going] = there == runs[going]
            going = going[(there != runs[going]) & (there != _EMPTY)]
        return found, np.where(found, self.values[place], np.float32(0))


@functools.lru_cache(maxsize=1)
def _tables(file: str) -> tuple[list[Table], list[Table]]:
    """Log probabilities and log shares left over, by order, of one of Spark's files; a
    worker keeps those of its last shard."""
    rows = pq.ParquetFile(SparkFiles.get(file)).read()
    kinds, runs, values = (rows.column(c).to_numpy() for c in ("kind", "run", "v"))

    def of_kind(kind: int) -> Table:
        some = kinds == kind
        return Table(runs[some].astype(np.uint64), values[some])

    return [of_kind(k) for k in range(1, ORDER + 1)], [of_kind(-k) for k in range(1, ORDER + 1)]


@dataclass(frozen=True)
class Model:
    """What is known of the bytes that follow the pairs from ``first`` to before ``end``, in
    a file among Spark's files."""

    file: str
    first: int = 0
    end: int = 1 << 16

    @property
    def known(self) -> list[Table]:
        return _tables(self.file)[0]

    @property
    def left(self) -> list[Table]:
        return _tables(self.file)[1]


def fit(trusted: DataFrame, body: str = "text", settings: Settings = Settings()) -> Iterator[Model]:
    """The shards of the model of all trusted texts, one after another; without any text
    there is one, in which every byte is equally likely."""
    counts = written(count_runs(trusted, body), "byte-counts")
    made, shares = probabilities(counts)
    kinds = [t.select(F.lit(k).alias("kind"), "run", F.ln("p").alias("v")) for k, t in enumerate(made, 1)]
    kinds += [t.select(F.lit(-k).alias("kind"), F.col("context").alias("run"), F.ln("gamma").alias("v")) for k, t in enumerate(shares, 1)]
    # a run's last byte is what is judged, a context's last byte is the one before it
    before = F.when(F.col("kind") > 0, F.shiftright("run", 8)).otherwise(F.col("run")).bitwiseAND(F.lit(0xFFFF).cast("bigint"))
    of_pair = F.when(F.abs("kind") > 2, before).otherwise(-1)
    rows = written(reduce(DataFrame.unionByName, kinds).withColumn("pair", of_pair).repartitionByRange("pair"), "byte-model")
    sizes = rows.where("pair >= 0").groupBy("pair").agg(F.count("*").alias("n")).orderBy("pair").collect()  # 65,536 at most
    bounds, held = [0], 0
    for pair, n in sizes:
        if held and held + n > settings.entries:
            bounds.append(pair)
            held = 0
        held += n
    for first, end in zip(bounds, [*bounds[1:], 1 << 16]):
        own = rows.where((F.col("pair") < 0) | (F.col("pair") >= first) & (F.col("pair") < end)).drop("pair")
        place = written(own.coalesce(1), "byte-shard").inputFiles()[0]  # one task, one file
        trusted.sparkSession.sparkContext.addFile(place)
        yield Model(place.rsplit("/", 1)[1], first, end)


def log_likelihoods(data: np.ndarray, at: np.ndarray, model: Model) -> np.ndarray:
    """Natural log likelihood of each whole text, as far as the shard says."""
    out, place = padded(data, at)
    run = byte_runs(out, place)
    known, shares = model.known, model.left
    score = np.zeros(len(run), np.float64)
    pair = (run >> np.uint64(8)) & np.uint64(0xFFFF)
    left = np.flatnonzero((pair >= np.uint64(model.first)) & (pair < np.uint64(model.end)))
    run = run[left]
    for order in range(ORDER, 0, -1):
        own = run & np.uint64((1 << 8 * order) - 1)
        found, value = known[order - 1].look_up(own)
        score[left[found]] += value[found]
        left, run, own = left[~found], run[~found], own[~found]
        seen, value = shares[order - 1].look_up(own >> np.uint64(8))
        score[left] += value
        if not len(left):
            break
    score[left] += np.log(1 / 256)
    total = np.concatenate([[0], np.cumsum(score)])
    return total[at[1:]] - total[at[:-1]]


def _scored(documents: DataFrame, model: Model, key: str, body: str, carried: str) -> DataFrame:
    """``key``, ``carried``, ``t1``, ``t2``, ``n_bytes`` and ``part``, what the shard says of the text."""
    kinds = [documents.schema[c].dataType.simpleString() for c in (key, carried)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in text.pieces(batch.column(4)):
                own = [column[lo:hi] for column in batch.columns[:4]]
                part = pa.array(log_likelihoods(data, at, model))
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.diff(at)), part], ["key", "carried", "t1", "t2", "n_bytes", "part"]
                )

    rows = documents.select(F.col(key).alias("key"), F.col(carried).alias("carried"), F.col(body).alias("body"))
    rows = rows.select("key", "carried", F.xxhash64("body").alias("t1"), F.xxhash64(F.lit("other"), "body").alias("t2"), "body")
    schema = f"key {kinds[0]}, carried {kinds[1]}, t1 bigint, t2 bigint, n_bytes bigint, part double"
    return written(rows.mapInArrow(run, schema), "perplexity-parts")


def score(documents: DataFrame, models: Iterable[Model], key: str, body: str, carried: str) -> DataFrame:
    """``key``, ``carried``, ``n_bytes`` and ``log_perplexity`` (null for an empty text)."""
    passes = [_scored(documents, model, key, body, carried) for model in models]
    total, part = passes[0], F.col("part")
    for k, other in enumerate(passes[1:], 1):
        of_text = other.groupBy("t1", "t2").agg(F.max("part").alias(f"part_{k}"))
        total = total.join(of_text.hint("merge"), ["t1", "t2"])
        part = part + F.col(f"part_{k}")
    return total.select("key", "carried", "n_bytes", F.when(F.col("n_bytes") > 0, -part / F.col("n_bytes")).alias("log_perplexity"))


def classify(
    documents: DataFrame,
    trusted_keys: DataFrame,
    key: str = "doc_id",
    body: str = "text",
    language: str = "lang",
    settings: Settings = Settings(),
) -> DataFrame:
    """``key``, ``language``, ``n_bytes``, ``perplexity``, ``lowest``, ``highest`` and ``kept``.

    ``trusted_keys`` has the keys of trusted documents in its one column; nulls and
    repeats in it don't matter. A null or empty text has no perplexity and nothing
    speaks against it: it is kept, as all are if there is no trusted text.
    """
    # dealt by key at every size; Spark thins out the texts by a Bloom filter of the keys
    keys = trusted_keys.toDF("trusted").where("trusted is not null").distinct().hint("merge")
    trusted = documents.select(F.col(key).alias("key"), F.col(body).alias("body")).join(
        keys, F.col("key") == F.col("trusted"), "left_semi"
    )
    held = F.pmod(F.xxhash64(F.lit("held"), "key"), F.lit(settings.held)) == 0
    scored = score(documents, fit(trusted.where(~held), "body", settings), key, body, language)
    sized = scored.withColumn("size", F.greatest(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.floor(F.log2("n_bytes")))))
    sized = written(sized, "perplexities")
    # quantiles from sketches that merge: a row for each language and length, language, and all
    known = sized.where("log_perplexity is not null").join(keys, F.col("key") == F.col("trusted"), "left_semi")
    cut = [
        F.percentile_approx("log_perplexity", settings.lowest, settings.accuracy),
        F.percentile_approx(F.when(held, F.col("log_perplexity")), settings.highest, settings.accuracy),
    ]
    found = (F.array(*cut).alias("cuts"), F.count_if(held).alias("n"))
    known = known.where("carried is not null").rollup("carried", "size").agg(*found, F.grouping_id().alias("level")).unionByName(
        known.agg(*found).select(
            F.lit(None).cast("string").alias("carried"), F.lit(None).cast("bigint").alias("size"), "cuts", "n", F.lit(7).cast("bigint").alias("level")
        )
    )
    quantiles = written(known, "perplexity-quantiles").where((F.col("n") >= settings.least) | (F.col("level") == 7))
    of_size = quantiles.where("level = 0").select(F.col("carried").alias("lang_a"), F.col("size").alias("size_a"), F.col("cuts").alias("cuts_a"))
    of_lang = quantiles.where("level = 1").select(F.col("carried").alias("lang_b"), F.col("cuts").alias("cuts_b"))
    overall = quantiles.where("level = 7").select("cuts").first()[0] or [None, None]
    joined = sized.join(of_size, (F.col("carried") == F.col("lang_a")) & (F.col("size") == F.col("size_a")), "left")
    joined = joined.join(of_lang, F.col("carried") == F.col("lang_b"), "left")
    low, high = (F.coalesce(F.col("cuts_a")[k], F.col("cuts_b")[k], F.lit(overall[k]).cast("double")) for k in (0, 1))
    return joined.select(
        F.col("key").alias(key),
        F.col("carried").alias(language),
        "n_bytes",
        F.exp("log_perplexity").alias("perplexity"),
        F.exp(low).alias("lowest"),
        F.exp(high).alias("highest"),
        F.coalesce((F.col("log_perplexity") >= low) & (F.col("log_perplexity") <= high), F.lit(True)).alias("kept"),
    )
