"""Jaccard similarity join of documents' word shingles by parity sketches.

A document's set is its distinct five-word shingles (words: A-Z in lower case, runs of
anything but space and U+0009 to U+000D); of fewer words, the whole sequence. Two
documents link if ``100 * |A and B| >= 75 * |A or B|``. Then their symmetric difference
is at most ``(|A| + |B|) / 7``, and the larger has at most 4/3 the shingles of the other.

Sketch: every shingle flips one bit of a wide bit sketch, so the Hamming distance of
two sketches is at most the size of the symmetric difference. The sketch is cut into
blocks, and a block is held as the XOR of the 64-bit codes of its set bits. With at most
``d`` differences, any ``d + 1`` non-empty blocks of a document have one that is the same
in its partner, so a document emits its first ``d + 1`` and meets every partner in at
least one bucket. Sizes are cut into bands whose bounds grow by 4/3, so partners lie in
the same or in neighbouring bands: a document is put into the buckets of its own band
and of the next, each with as many blocks as that band's sizes ask for.

Common shingles would fill such buckets with unrelated documents. The most common ones
(a bounded, broadcast list) therefore have no place in the blocks: they come after all
blocks, each as a block of its own. The order is the same for all documents, so nothing
is lost, and only documents that consist of them for the most part ever emit one.

Copies collapse first: documents with the same set are one node. Buckets with few
nodes give their pairs, in larger ones each node is paired with a hub, and documents of
larger buckets that this leaves in different components are dealt anew by their rarest
shingles (``buckets``), so neither a group of thousands of near copies nor a passage in
thousands of documents costs all its pairs. A pair is dropped at once if a dense sketch of
parities says that its sets differ too much, and else verified on the full sets. Sets
and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.buckets import dense_sketch, linked, shared_buckets
from brindle.llm.tables import written

SIZE, PERCENT = 5, 75
SINGLE_BELOW = 64
COMMON = 16
MOST_COMMON = 250_000


def shingle_sets(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    low = text.fold(data)
    starts, ends, first = text.words(low, at)
    codes = text.hashes(low, starts, ends)
    all_shingles, begins = text.windows(codes, first, SIZE)
    cuts = np.searchsorted(begins, first)
    for r in range(len(at) - 1):
        n = first[r + 1] - first[r]
        if n >= SIZE:
            yield np.unique(all_shingles[cuts[r] : cuts[r + 1]])
        elif n:
            yield text.windows(codes[first[r] : first[r + 1]], np.array([0, n]), int(n))[0]
        else:
            yield np.zeros(0, np.uint64)


def identity(shingles: np.ndarray) -> int:
    """A signed 64-bit number for the set; 0 for the empty one."""
    if not len(shingles):
        return 0
    total = text.mix(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    return int(text.mix(np.array([total + np.uint64(len(shingles))]))[0].astype(np.int64)) or 1


def band_starts(most: int) -> list[int]:
    """Smallest sizes of the bands up to beyond ``most``."""
    starts = [1]
    while starts[-1] <= 2 * most + 2:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 4 // 3)))
    return starts


def n_blocks(largest: int) -> int | None:
    """Blocks of the sketch for sizes up to ``largest``; None: one for each shingle."""
    return None if largest < SINGLE_BELOW else int(0.45 * largest + 4 * largest**0.5)


def bucket_keys(shingles: np.ndarray, common: np.ndarray, starts: list[int]) -> np.ndarray:
    """Keys of the buckets that a set is put into."""
    n = len(shingles)
    band = int(np.searchsorted(starts, n, "right")) - 1
    if len(common):
        place = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        is_common = common[place] == shingles
        rare, often = shingles[~is_common], shingles[is_common]
    else:
        rare, often = shingles, shingles[:0]
    out = []
    for level in (band, band + 1):
        largest = starts[level + 1] - 1
        partner = min(n * 4 // 3, largest)
        if partner < starts[level]:
            continue
        need = (n + partner) // 7 + 1
        blocks = n_blocks(largest)
        if blocks is None or not len(rare):
            codes = rare[:need]
        else:
            block = text.mix(rare) % np.uint64(blocks)
            order = np.argsort(block, kind="stable")
            block = block[order]
            heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            parity = np.bitwise_xor.reduceat(text.mix(rare[order] + np.uint64(0x2545F4914F6CDD1D)), heads)
            codes = text.mix(parity + block[heads] * np.uint64(0x9E3779B97F4A7C15))[:need]
        if len(codes) < need:
            codes = np.concatenate([codes, text.mix(often[: need - len(codes)] ^ np.uint64(0xD1B54A32D192ED03))])
        if len(codes) < need:
            raise ValueError(f"{n} shingles fill only {len(codes)} of {need} blocks")
        out.append(text.mix(codes + np.uint64((level + 1) * 0x8CB92BA72F3D8DD7 % 2**64)))
    return np.concatenate(out)


def _sets(documents: DataFrame, key: str, body: str) -> DataFrame:
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in text.pieces(batch.column(1)):
                n, node, sketch = zip(*[(len(s), identity(s), dense_sketch(s)) for s in shingle_sets(data, at)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch.column(0)[lo:hi],
                        "n": pa.array(n, pa.int64()),
                        "node": pa.array(node, pa.int64()),
                        "sketch": pa.array(sketch, pa.list_(pa.int64())),
                    }
                )

    rows = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    return rows.mapInArrow(run, f"key {kind}, n bigint, node bigint, sketch array<bigint>")


def _common_shingles(documents: DataFrame, body: str) -> np.ndarray:
    """The most common shingles, counted over different sets within each task.

    Which shingles are on the list decides where documents meet, never whether.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        waiting: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate([*waiting, np.zeros(0, np.uint64)]), return_counts=True)
            twice = n > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(codes[twice].astype(np.int64)), pa.array(n[twice])], ["shingle", "n"]
            )

        for batch in batches:
            for _, _, data, at in text.pieces(batch.column(0)):
                for s in shingle_sets(data, at):
                    node = identity(s)
                    if node not in seen:
                        seen.add(node)
                        waiting.append(s)
                        held += len(s)
                if held > 8_000_000:
                    yield out()
                    waiting, held = [], 0
        yield out()

    counts = documents.select(F.col(body).alias("body")).mapInArrow(run, "shingle bigint, n bigint")
    most = (
        counts.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
        .orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle").toPandas()
    )
    return np.sort(most["shingle"].to_numpy(np.int64).astype(np.uint64))


def _buckets(documents: DataFrame, body: str, common: np.ndarray) -> DataFrame:
    """(bucket, node), once per task for each set."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        starts = band_starts(1 << 16)
        for batch in batches:
            for _, _, data, at in text.pieces(batch.column(0)):
                keys, nodes = [], []
                for s in shingle_sets(data, at):
                    node = identity(s)
                    if node in seen or not len(s):
                        continue
                    seen.add(node)
                    if 2 * len(s) >= starts[-1]:
                        starts = band_starts(2 * len(s))
                    keys.append(bucket_keys(s, shared.value, starts))
                    nodes.append(node)
                if keys:
                    each = [len(k) for k in keys]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(keys).astype(np.int64)),
                            pa.array(np.repeat(np.array(nodes, np.int64), each)),
                        ],
                        ["bucket", "node"],
                    )

    return documents.select(F.col(body).alias("body")).mapInArrow(run, "bucket bigint, node bigint")


def _similar(pairs: DataFrame) -> DataFrame:
    """The pairs whose sets have three quarters in common."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("content_a").to_pylist(), batch.column("content_b").to_pylist()
            passed = []
            for x, y in zip(left, right):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                passed.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _members(full: DataFrame) -> DataFrame:
    """(node, n, member) of full sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("content").to_pylist()):
                member = np.frombuffer(raw, np.int64)
                same = [np.full(len(member), x, np.int64) for x in (node, len(member))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, member)], ["node", "n", "member"])

    return full.select("node", "content").mapInArrow(run, "node bigint, n bigint, member bigint")


def _candidate_sets(documents: DataFrame, key: str, body: str, wanted: DataFrame) -> DataFrame:
    """(node, content) of the documents with the keys in ``wanted``, a null among them too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in text.pieces(batch.column(0)):
                found = [(identity(s), s.tobytes()) for s in shingle_sets(data, at)]
                node, raw = zip(*found)
                yield pa.RecordBatch.from_pydict({"node": pa.array(node, pa.int64()), "content": pa.array(raw, pa.binary())})

    rows = documents.select(F.col(key).alias("_key"), F.col(body).alias("_body"))
    chosen = rows.join(wanted.hint("merge"), F.col("_key") == F.col("_wanted"), "left_semi").select("_body")
    if not wanted.where("_wanted is null").isEmpty():  # beside the join, where they would meet in one task
        chosen = chosen.unionByName(rows.where("_key is null").select("_body"))
    return chosen.mapInArrow(run, "node bigint, content binary")


def near_duplicates(documents: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    One row for each row. A text without words, or null, has no shingle and is linked
    with nothing: its component is its own key. Rows with a null key link like others;
    a component of null keys only has a null id. Keys must be ordered and comparable;
    repeated keys make the rows that carry them one component only through their texts.
    """
    sets = written(_sets(documents, key, body), "shingle-sets")
    shared = shared_buckets(_buckets(documents, body, _common_shingles(documents, body)))

    def contents(nodes: DataFrame) -> DataFrame:
        """The full sets, from one document of each node."""
        wanted = sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("key").alias("_wanted"))
        found = _candidate_sets(documents, key, body, written(wanted.select("_wanted"), "wanted"))
        return found.join(nodes, "node", "left_semi").distinct()

    traits = sets.groupBy("node").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    roots = linked(shared, contents, _similar, _members, PERCENT, traits)

    rooted = sets.where("n > 0").join(roots, "node", "left").select("key", "n", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("key").alias("component_id"))
    with_words = rooted.join(smallest, "root").select("key", "n", "component_id")
    without = sets.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return with_words.unionByName(without).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id"
    )
