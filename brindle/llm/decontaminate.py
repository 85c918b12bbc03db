"""Benchmark decontamination: every passage of every document queries a BM25 index of
the benchmark items, and what scores high is verified by overlap.

Words are runs of letters and digits, A-Z and accented capitals in lower case. Items are
put into bands by length (64 words or less, then by powers of two). For a band, a passage
is two neighbouring stretches of ``step`` words, the band's longest length, so each run of
words as long as an item lies wholly in some passage, and one long item makes no other's
passages longer. An item's score is the BM25 weight of its words that are in the passage,
as a share of the weight of all its words.

Retrieval is block-max WAND over sparse arrays. Items lie in blocks; for each word and
block the index has the largest share of any item there. Of each item only the words of
least frequency that make up ``1 - threshold / 2`` of its weight are listed; as the rest is
too light to reach the threshold, a passage that shares none of them with a block never
meets it. Of the blocks that it does meet, it adds up the largest shares of listed words,
and skips a block if that and all that isn't listed stay below the threshold. In the
blocks that are left, all items are scored exactly and all above the threshold are kept.
Work is done in portions of ``PORTION`` entries, so memory doesn't grow with the index.

Verification: the item's answer is what follows its last question mark, or else its
last quarter; the question is what comes before. Both must have at least ``overlap`` of
their three-word runs in the passage.

The index is broadcast, so its size is checked: the benchmark is dealt over as many
indexes as keep each under ``WORDS_PER_INDEX`` words, and every passage queries all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text

WORDS_PER_INDEX = 500_000
BLOCK = 4
SHORTEST_STEP = 64
PORTION = 1 << 20
K1, B = 1.2, 0.75
SCHEMA = "item_id {item}, score double, question_overlap double, answer_overlap double"


def word_codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = text.fold_latin(data)
    starts, ends, first = text.words(low, at, text.ALNUM)
    return text.hashes(low, starts, ends), first


@dataclass(frozen=True)
class Band:
    """Items of similar length. ``vocabulary``: sorted word hashes. Word -> blocks where it is
    listed (``listed_cuts``, ``listed_blocks``) with its largest share (``listed_bounds``);
    ``unlisted``: of each block, the largest sum of shares that are not listed. Block -> all
    its (word, place in the block, share), cut by ``entry_cuts``. ``items``: their numbers."""

    step: int
    items: np.ndarray
    vocabulary: np.ndarray
    listed_cuts: np.ndarray
    listed_blocks: np.ndarray
    listed_bounds: np.ndarray
    unlisted: np.ndarray
    entry_cuts: np.ndarray
    entry_terms: np.ndarray
    entry_places: np.ndarray
    entry_shares: np.ndarray


@dataclass(frozen=True)
class Index:
    """``parts``: per item, its question's and its answer's words."""

    threshold: float
    bands: list[Band]
    parts: list[tuple[np.ndarray, np.ndarray]]


def build_index(bodies: Sequence[str | None], threshold: float = 0.6) -> Index:
    """The index of item texts; items without words are in no band and match nothing."""
    data, at = text.utf8(pa.array(bodies, pa.string()))
    codes, first = word_codes(data, at)
    vocabulary, term = np.unique(codes, return_inverse=True)
    n, sizes = len(bodies), np.diff(first)
    item = np.repeat(np.arange(n), sizes)
    pairs, tf = np.unique(item * max(1, len(vocabulary)) + term, return_counts=True)
    item, term = np.divmod(pairs, max(1, len(vocabulary)))
    df = np.bincount(term, minlength=len(vocabulary))
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    mean = max(1.0, sizes.mean()) if n else 1.0
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[item] / mean))
    share = weight / np.bincount(item, weight, n)[item]
    step = np.maximum(SHORTEST_STEP, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    bands = []
    for length in np.unique(step[sizes > 0]).tolist():
        mine = step[item] == length
        bands.append(_band(length, item[mine], term[mine], share[mine], vocabulary, df, threshold))
    parts = []
    for i, body in enumerate(bodies):
        own = codes[first[i] : first[i + 1]]
        tail = (body or "").rpartition("?")[2] if "?" in (body or "") else ""
        tail_data, tail_at = text.utf8(pa.array([tail]))
        n_answer = len(word_codes(tail_data, tail_at)[0]) or -(-len(own) // 4)
        parts.append((own[: len(own) - n_answer], own[len(own) - n_answer :]))
    return Index(threshold, bands, parts)


def _band(
    step: int, item: np.ndarray, term: np.ndarray, share: np.ndarray, words: np.ndarray, df: np.ndarray, threshold: float
) -> Band:
    used, term_ = np.unique(term, return_inverse=True)
    items, place = np.unique(item, return_inverse=True)
    block, n_blocks = place // BLOCK, -(-len(items) // BLOCK)
    # of each item the rarest words come first, and are listed until they weigh enough
    order = np.lexsort((term, df[term], item))
    before = np.cumsum(share[order]) - share[order]
    heads = np.searchsorted(item[order], items)
    before -= np.repeat(before[heads], np.diff(np.append(heads, len(order))))
    listed = np.zeros(len(item), bool)
    listed[order] = before < 1 - threshold / 2
    unlisted = np.zeros(n_blocks)
    np.maximum.at(unlisted, np.arange(len(items)) // BLOCK, np.bincount(place, np.where(listed, 0, share), len(items)))
    pairs, where = np.unique(term_[listed] * n_blocks + block[listed], return_inverse=True)
    bounds = np.zeros(len(pairs))
    np.maximum.at(bounds, where, share[listed])
    of_term, of_block = np.divmod(pairs, n_blocks)
    by_block = np.argsort(block, kind="stable")
    return Band(
        step,
        items,
        words[used],
        np.searchsorted(of_term, np.arange(len(used) + 1)),
        of_block,
        bounds,
        unlisted,
        np.searchsorted(block[by_block], np.arange(n_blocks + 1)),
        term_[by_block],
        (place % BLOCK)[by_block],
        share[by_block],
    )


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range, and element, for all elements of ranges."""
    size = hi - lo
    of = np.repeat(np.arange(len(lo)), size)
    return of, np.arange(len(of)) + np.repeat(lo - np.cumsum(size) + size, size)


def _portions(size: np.ndarray) -> Iterator[slice]:
    """Slices of neighbours with about ``PORTION`` entries, one at least."""
    total, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PORTION, "right")), lo + 1)
        yield slice(lo, hi)
        lo = hi


def runs(codes: np.ndarray, size: int = 3) -> np.ndarray:
    """Hashes of the ``size``-word runs; of fewer words, the whole."""
    if len(codes) == 0:
        return codes
    size = min(size, len(codes))
    return np.unique(text.windows(codes, np.array([0, len(codes)]), size)[0])


def overlap_of(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the part's runs that are in the passage; 1 for an empty part."""
    own = runs(part)
    if not len(own):
        return 1.0
    size = min(3, len(part))
    if len(passage) < size:
        return 0.0
    there = text.windows(passage, np.array([0, len(passage)]), size)[0]
    return float(np.isin(own, there).mean())


def _hits(band: Band, codes: np.ndarray, first: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int, float]]:
    """(row, first word of the passage, item, score) of all scores from the threshold on."""
    place = np.searchsorted(band.vocabulary, codes)
    place[place == len(band.vocabulary)] = 0
    where = np.flatnonzero(band.vocabulary[place] == codes)
    # stretches: numbered over all rows, none crosses a row's end
    per_row = -(-np.diff(first) // band.step)
    base = np.concatenate([[0], np.cumsum(per_row)])
    row = text.rows_of(where, first)
    stretch = base[row] + (where - first[row]) // band.step
    n_stretches, n_terms, n_blocks = int(base[-1]), len(band.vocabulary), len(band.unlisted)
    last = np.zeros(n_stretches + 1, bool)
    last[base[1:][per_row > 0] - 1] = True  # the last stretch of a row has no next one
    there = np.unique(stretch * n_terms + place[where])  # (stretch, word)
    # a word is in the passage that begins with its stretch, and in the one before
    early = there[(there // n_terms > 0) & ~last[there // n_terms - 1]] - n_terms
    held = np.unique(np.concatenate([there, early]))
    passage, term = np.divmod(held, n_terms)
    lo, hi = band.listed_cuts[term], band.listed_cuts[term + 1]
    heads = np.searchsorted(passage, np.arange(n_stretches + 1))  # whole passages go into a portion
    weight = np.concatenate([[0], np.cumsum(hi - lo)])
    for some in _portions(weight[heads[1:]] - weight[heads[:-1]]):
        a, b = heads[some.start], heads[some.stop]
        of, at = _spread(lo[a:b], hi[a:b])
        met, which = np.unique(passage[a:b][of] * n_blocks + band.listed_blocks[at], return_inverse=True)
        bound = np.bincount(which, band.listed_bounds[at], len(met)) + band.unlisted[met % n_blocks]
        pairs = met[bound >= threshold - 1e-9]
        block = pairs % n_blocks
        sizes = band.entry_cuts[block + 1] - band.entry_cuts[block]
        for part in _portions(sizes):
            own = pairs[part]
            k, entry = _spread(band.entry_cuts[own % n_blocks], band.entry_cuts[own % n_blocks + 1])
            asked = own[k] // n_blocks * n_terms + band.entry_terms[entry]
            found = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            share = np.where(held[found] == asked, band.entry_shares[entry], 0.0)
            scores = np.bincount(k * BLOCK + band.entry_places[entry], share, len(own) * BLOCK)
            for hit in np.flatnonzero(scores >= threshold).tolist():
                s, number = int(own[hit // BLOCK] // n_blocks), int(own[hit // BLOCK] % n_blocks) * BLOCK + hit % BLOCK
                r = int(np.searchsorted(base, s, "right")) - 1
                yield r, int(first[r]) + (s - int(base[r])) * band.step, int(band.items[number]), float(scores[hit])


def search_piece(data: np.ndarray, at: np.ndarray, index: Index, overlap: float) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(row, item) -> best score and the overlaps of the verified hits."""
    codes, first = word_codes(data, at)
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    if not len(codes):
        return found
    for band in index.bands:
        for r, word, item, score in _hits(band, codes, first, index.threshold):
            passage = codes[word : min(word + 2 * band.step, int(first[r + 1]))]
            question, answer = (overlap_of(p, passage) for p in index.parts[item])
            if question >= overlap and answer >= overlap:
                hit = (score, question, answer)
                found[r, item] = max(found.get((r, item), hit), hit)
    return found


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    body: str = "text",
    item: str = "item_id",
    item_body: str = "text",
    threshold: float = 0.6,
    overlap: float = 0.5,
) -> DataFrame:
    """One row per document and benchmark item found in it, with the score and overlaps
    of the best passage. Null and empty texts match nothing; no document is shuffled."""
    spark = documents.sparkSession
    items = benchmark.select(F.col(item).alias("item"), F.col(item_body).alias("body"))
    total = items.agg(F.sum(F.size(F.split("body", r"\s+"))).alias("n")).first().n or 0
    n_indexes = max(1, -(-total // WORDS_PER_INDEX))
    of_index = F.pmod(F.xxhash64("item", "body"), F.lit(n_indexes))
    kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((documents, key), (benchmark, item)))
    rows = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))

    def searched(number: int) -> DataFrame:
        mine = items.where(of_index == number).orderBy("item", "body").toPandas()
        ids = pa.Array.from_pandas(mine["item"])
        bodies = [b if isinstance(b, str) else None for b in mine["body"]]
        shared = spark.sparkContext.broadcast((build_index(bodies, threshold), ids))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            for batch in batches:
                for lo, hi, data, at in text.pieces(batch.column(1)):
                    found = search_piece(data, at, index, overlap)
                    if found:
                        score, question, answer = zip(*found.values())
                        yield pa.RecordBatch.from_pydict(
                            {
                                "key": batch.column(0)[lo:hi].take(pa.array([r for r, _ in found])),
                                "item_id": names.take(pa.array([i for _, i in found])),
                                "score": score,
                                "question_overlap": question,
                                "answer_overlap": answer,
                            }
                        )

        return rows.mapInArrow(run, f"key {kind}, {SCHEMA.format(item=item_kind)}")

    hits = reduce(DataFrame.unionByName, map(searched, range(n_indexes)))
    return hits.withColumnsRenamed({"key": key, "item_id": item})
