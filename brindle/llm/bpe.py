"""BPE encoding and decoding with the vocabulary of a public tokenizer file.

The corpus's most frequent words are compiled once, with their ids, into a minimal
acyclic transducer (``lexicon``), which every worker memory-maps; any other word is
merged exactly, rank by rank. Which words are compiled therefore changes the speed
and never the ids.

Follows the file's own steps: special tokens are cut out of the raw text, the rest is
NFC-normalised and lower-cased, split by the file's pattern, written in byte letters
and merged. A null or empty text has no ids. Files of another kind are refused.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.lexicon import Lexicon, build
from brindle.llm.tables import put_bytes, written

SUFFIX = "</w>"
CACHED_WORDS = 200_000
# Where the library's character tables differ from Python's, over all code
# points. It has these capitals beside those of ``str.lower`` (first, last, distance) ...
_CAPITALS = (
    (0x1C89, 0x1C89, 0x1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 0x1), (0xA7CE, 0xA7CE, 0x1),
    (0xA7D2, 0xA7D2, 0x1), (0xA7D4, 0xA7D4, 0x1), (0xA7DA, 0xA7DA, 0x1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
# ... and these code points (first, last) are no letters in it, but in ``regex``.
_NO_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CF, 0xA7CF), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2),
    (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LOWER = {c: c + distance for first, last, distance in _CAPITALS for c in range(first, last + 1)}


def _class(ranges: Iterable[tuple[int, int]]) -> str:
    return "[" + "".join(f"{chr(first)}-{chr(last)}" for first, last in ranges) + "]"


_ODD = regex.compile(_class([*_NO_LETTERS, *((first, last) for first, last, _ in _CAPITALS)]))
# Nothing below this code point is odd, and only two capitals have lower case above it.
LOW = 0x531
_HIGH = re.compile(_class([(0x23A, 0x23A), (0x23E, 0x23E), (LOW, 0x10FFFF)]))


def _low_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for texts of code points below ``LOW`` only, its classes spelled out;
    none if it has more than bracketed white space, letters and digits."""
    if re.search(r"[\\\[.]", re.sub(r"\[\^?(?:\\s|\\p\{[LN]\})+\]", "", pattern)):
        return None
    for name in (r"\s", r"\p{L}", r"\p{N}"):
        of_class = regex.compile(name).match
        points = "".join(chr(c) for c in range(LOW) if of_class(chr(c)))
        pattern = pattern.replace(name, re.escape(points))
    return re.compile(pattern)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What a tokenizer file says, small enough to broadcast (its size is fixed)."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    pattern: str
    special: dict[str, int]

    @staticmethod
    def load(path: str) -> Vocabulary:
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        model, before = file["model"], file["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in file["normalizer"]["normalizers"]]
        if (
            (model["type"], model["end_of_word_suffix"]) != ("BPE", SUFFIX)
            or steps != ["NFC", "Replace", "Lowercase"]
            or [p["type"] for p in before] != ["Split", "ByteLevel"]
        ):
            raise ValueError(f"not a lower-casing BPE with word ends: {path}")
        return Vocabulary(
            model["vocab"],
            {tuple(pair): rank for rank, pair in enumerate(model["merges"])},
            before[0]["pattern"]["Regex"],
            {t["content"]: t["id"] for t in file["added_tokens"]},
        )


def merge(vocabulary: Vocabulary, letters: list[str], word: str) -> tuple[int, ...]:
    """Ids of one pre-token: always the pair of lowest rank first, from the left."""
    parts = [letters[b] for b in word.encode()]
    parts[-1] += SUFFIX
    ranks, never = vocabulary.ranks, len(vocabulary.ranks)
    while len(parts) > 1:
        found = [ranks.get(pair, never) for pair in zip(parts, parts[1:])]
        best = min(found)
        if best == never:
            break
        merged, i = [], 0
        while i < len(parts):
            if i < len(found) and found[i] == best:
                merged.append(parts[i] + parts[i + 1])
                i += 2
            else:
                merged.append(parts[i])
                i += 1
        parts = merged
    return tuple(vocabulary.ids[p] for p in parts)


class Merger:
    """``merge`` for many words at once, on numbers instead of strings."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids, letters = vocabulary.ids, byte_letters()
        self._inner = np.array([ids[x] for x in letters], np.int64)
        self._last = np.array([ids[x + SUFFIX] for x in letters], np.int64)
        self._n = max(ids.values()) + 1
        pair = np.array([ids[a] * self._n + ids[b] for a, b in vocabulary.ranks], np.int64)
        self._never = len(pair)
        self._made = np.array([ids[a + b] for a, b in vocabulary.ranks], np.int64)
        order = np.argsort(pair)
        self._pairs, self._ranks = pair[order], order
        # a slot has the place of the one pair that hashes to it, -1 for none, -2 for several
        slot = self._slot(self._pairs)
        self._place = np.full(1 << 20, -1, np.int32)
        self._place[slot] = np.arange(len(slot))
        several = np.flatnonzero(np.bincount(slot) > 1)
        self._place[several] = -2

    @staticmethod
    def _slot(pair: np.ndarray) -> np.ndarray:
        return (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)

    def _rank(self, pair: np.ndarray) -> np.ndarray:
        out = np.full(len(pair), self._never)
        place = self._place[self._slot(pair)]
        maybe = np.flatnonzero(place != -1)
        at, asked = place[maybe].astype(np.int64), pair[maybe]
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self._pairs, asked[several]), self._never - 1)
        out[maybe] = np.where(self._pairs[at] == asked, self._ranks[at], self._never)
        return out

    def __call__(self, words: Sequence[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        name = np.arange(len(words))
        size = np.array([len(w) for w in words], np.int64)
        name, size = name[size > 0], size[size > 0]
        token = self._inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(size)
        token[ends - 1] = self._last[np.frombuffer(b"".join(words), np.uint8)[ends - 1]]
        while len(name):
            start = np.cumsum(size) - size
            rank = np.full(len(token), self._never)
            rank[:-1] = self._rank(token[:-1] * self._n + token[1:])
            rank[start + size - 1] = self._never  # no pair reaches into the next word
            best = np.minimum.reduceat(rank, start)
            done = best == self._never
            for k in np.flatnonzero(done).tolist():
                out[name[k]] = token[start[k] : start[k] + size[k]]
            word = np.repeat(np.arange(len(name)), size)
            at = np.flatnonzero((rank == best[word]) & (rank < self._never))
            # of overlapping equal pairs, every second one from the left
            head = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1])) if len(at) else at
            nth = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
            at = at[nth % 2 == 0]
            token[at] = self._made[rank[at]]
            left = ~done[word]
            left[at + 1] = False
            size = size - np.bincount(word[at], minlength=len(size))
            token, name, size = token[left], name[~done], size[~done]
        return out


class Encoder:
    """Encodes whole texts; ``lexicon`` is the path of a compiled one."""

    def __init__(self, vocabulary: Vocabulary, lexicon: str | None = None) -> None:
        self._lexicon = Lexicon(lexicon) if lexicon else None
        self._merge = Merger(vocabulary)
        self._said_of = [b""] * (max(vocabulary.ids.values()) + 1)
        for string, number in vocabulary.ids.items():
            self._said_of[number] = string.encode()
        self._special = {w: (np.array([i], "<u4").tobytes(), w.encode()) for w, i in vocabulary.special.items()}
        self._ids: dict[str, bytes] = {}
        self._said: dict[str, bytes] = {}
        self._find = regex.compile(vocabulary.pattern).findall
        letters = rf"[\p{{L}}--{_class(_NO_LETTERS)}]"
        self._find_odd = regex.compile("(?V1)" + vocabulary.pattern.replace(r"\p{L}", letters)).findall
        low = _low_pattern(vocabulary.pattern)
        self._find_low = low.findall if low else self._find
        self._cut = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")

    def _split(self, body: str) -> list[str]:
        if "<|" not in body:
            return self._words(body)
        out: list[str] = []
        for part in self._cut.split(body):
            out += [part] if part in self._special else self._words(part)
        return out

    def _words(self, body: str) -> list[str]:
        if not body.isascii():
            body = unicodedata.normalize("NFC", body).replace("Σ", "σ")
            if _HIGH.search(body):
                if _ODD.search(body):
                    return self._find_odd(body.translate(_LOWER).lower())
                return self._find(body.lower())
        return self._find_low(body.lower())

    def _learn(self, words: set[str]) -> None:
        """Take the ids of new words from the lexicon, and merge those it does not have."""
        if len(self._ids) + len(words) > CACHED_WORDS:
            self._ids.clear()
            self._said.clear()
        for word in words & self._special.keys():
            self._ids[word], self._said[word] = self._special[word]
        fresh = list(words - self._ids.keys())
        raw = [w.encode() for w in fresh]
        ids = self._lexicon.get_many(raw) if self._lexicon else [None] * len(raw)
        unseen = [k for k, i in enumerate(ids) if i is None]
        for k, merged in zip(unseen, self._merge([raw[k] for k in unseen])):
            ids[k] = merged
        said_of, raw = self._said_of, np.concatenate([*ids, np.zeros(0)]).astype("<u4")
        numbers, raw, at = raw.tolist(), raw.tobytes(), 0
        for word, n in zip(fresh, map(len, ids)):
            self._ids[word] = raw[4 * at : 4 * (at + n)]
            self._said[word] = said_of[numbers[at]] if n == 1 else b" ".join([said_of[i] for i in numbers[at : at + n]])
            at += n

    def __call__(self, bodies: Sequence[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids as little-endian 32-bit numbers and their decoding in UTF-8."""
        split = [self._split(b) for b in bodies]
        wanted = set().union(*split)
        if not wanted <= self._ids.keys():
            new = wanted - self._ids.keys()
            self._learn(wanted if len(self._ids) + len(new) > CACHED_WORDS else new)
        ids, said = self._ids.__getitem__, self._said.__getitem__
        return [(b"".join(map(ids, words)), b" ".join(map(said, words))) for words in split]


def word_counts(documents: DataFrame, body: str = "text") -> DataFrame:
    """How often each run of letters, in lower case, occurs in all texts.

    Counted per task first. A task leaves out what it has seen once, since that is no
    frequent word; every other count is complete within its task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, amount = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        names: list[bytes] = []

        def flush() -> pa.RecordBatch:
            total: dict[str, int] = {}
            for i in np.flatnonzero(amount > 1).tolist():
                name = names[i].decode("utf-8", "replace").lower()
                total[name] = total.get(name, 0) + int(amount[i])
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())}
            )

        for batch in batches:
            for _, _, data, at in text.pieces(batch.column(0)):
                low = text.fold_latin(data)
                starts, ends, _ = text.words(low, at, text.LETTERS)
                fit = ends - starts <= 64
                starts, ends = starts[fit], ends[fit]
                codes, where, n = np.unique(text.hashes(low, starts, ends), return_index=True, return_counts=True)
                raw = low.tobytes()
                place = np.searchsorted(known, codes)
                old = np.zeros(len(codes), bool)
                inside = place < len(known)
                old[inside] = known[place[inside]] == codes[inside]
                amount[place[old]] += n[old]
                new = np.flatnonzero(~old)
                if len(new):
                    order = np.argsort(np.concatenate([known, codes[new]]), kind="stable")
                    names = names + [raw[s:e] for s, e in zip(starts[where[new]].tolist(), ends[where[new]].tolist())]
                    names = [names[i] for i in order.tolist()]
                    known = np.concatenate([known, codes[new]])[order]
                    amount = np.concatenate([amount, n[new]])[order]
                if len(known) > 1_000_000:
                    yield flush()
                    known, amount, names = known[:0], amount[:0], []
        yield flush()

    seen = documents.select(F.col(body)).mapInArrow(run, "word string, n bigint")
    return seen.groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(documents: DataFrame, vocabulary: Vocabulary, body: str = "text", most: int = 50_000) -> bytes:
    """The transducer of the most frequent words of all texts, ``most`` at most.

    A histogram of the counts gives the least count that so many words reach, so only
    these words come to the driver.
    """
    counts = written(word_counts(documents, body).where(F.col("n") > 1), "word-counts")
    level = F.floor(F.log2("n") * 16)
    held = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for r in held:  # some sixteen rows for each doubling
        total += r["count"]
        if total > most:
            break
        least = r.level
    rows = counts.where(level >= least).collect() if least is not None else []
    letters, split = byte_letters(), regex.compile(vocabulary.pattern)
    whole = sorted({r.word for r in rows if split.fullmatch(r.word)}, key=str.encode)
    return build((w.encode(), merge(vocabulary, letters, w)) for w in whole)


def shipped(spark: SparkSession, lexicon: bytes) -> str:
    """Put the file where every executor gets it; its name among Spark's files."""
    name = f"lexicon-{hashlib.sha256(lexicon).hexdigest()[:24]}"
    place = put_bytes(spark, f"{name}-data", lexicon)
    spark.sparkContext.addFile(place)
    return place.rsplit("/", 1)[1]


def encode(documents: DataFrame, path: str, key: str = "doc_id", body: str = "text", lexicon: bytes | None = None) -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``decoded`` of every whole text. No shuffle beyond the word counts."""
    spark = documents.sparkSession
    vocabulary = Vocabulary.load(path)
    name = shipped(spark, compile_lexicon(documents, vocabulary, body) if lexicon is None else lexicon)
    shared = spark.sparkContext.broadcast(vocabulary)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, SparkFiles.get(name))
        for batch in batches:
            for lo, hi, _, _ in text.pieces(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                out = encoder([b or "" for b in part.column(1).to_pylist()])
                ids = np.frombuffer(b"".join(i for i, _ in out), "<u4").astype(np.int32)
                cuts = np.cumsum([0, *(len(i) // 4 for i, _ in out)])
                columns = [
                    part.column(0),
                    pa.array(np.diff(cuts)),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids)),
                    pa.array([d.decode() for _, d in out], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_tokens", "ids", "decoded"])

    rows = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    return rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids array<int>, decoded string").withColumnRenamed("key", key)


def ids_sha256(ids: Column) -> Column:
    """Lower-case hex sha256 of ids as little-endian unsigned 32-bit integers."""

    def digests(lists: pa.Array) -> pa.Array:
        at = lists.offsets.to_numpy()
        raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        return pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(at, at[1:])], pa.string())

    return F.arrow_udf(digests, "string")(ids)
