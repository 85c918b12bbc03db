"""Line-first cleaning: failing lines go, then documents that lose too much.

A line is a ``\\n``-split part of the text. Words are runs of anything but space and
U+0009 to U+000D. A line with a word fails if

* punctuation: it does not end, white space aside, in one of ``ENDINGS``, and holds no
  end of a sentence (``STOPS``) either;
* symbols: it has more than one of ``#*$%&|<>`` for every four words;
* navigation: it has two or more of ``SEPARATORS`` between words;
* shouting: it has five words or more and most of its letters A-Z are capitals;
* boilerplate: it holds one of ``PHRASES`` (A-Z taken as a-z).

A document is rejected if it fails the base rules (under 20 words, or more than 30 %
of its words in repeated 8-word windows) or if over half of its characters in words
are on failing lines. Null text counts as empty; an empty document fails the base
rules. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
ENDINGS = (".", "!", "?", ":", ";", '"', "'", ")", "…", "”", "’", "»")
STOPS = (". ", "! ", "? ")
SEPARATORS = (" | ", " > ", " » ", " • ", " · ")
PHRASES = (
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign in to",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "use of cookies",
)

_SYMBOL_BYTES = [s.encode() for s in SYMBOLS]
_ENDING_BYTES = tuple(e.encode() for e in ENDINGS)
_STOP_BYTES = [s.encode() for s in STOPS]
_SEPARATOR_BYTES = [s.encode() for s in SEPARATORS]
_PHRASE_BYTES = [p.encode() for p in PHRASES]
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_LETTERS = _CAPITALS + _CAPITALS.lower()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_BLANK = b" \t\n\v\f\r"

RULES = ("punctuation", "symbols", "navigation", "shouting", "boilerplate")
SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, "
    "n_lines_removed bigint, chars_removed bigint, clean_text string"
)


def failing_rule(line: bytes) -> str | None:
    """The first rule that a line with words fails."""
    body = line.strip(_BLANK)
    if not body.endswith(_ENDING_BYTES) and not any(stop in body for stop in _STOP_BYTES):
        return "punctuation"
    n_words = len(body.split())
    if 4 * sum(map(body.count, _SYMBOL_BYTES)) > n_words:
        return "symbols"
    if sum(map(body.count, _SEPARATOR_BYTES)) >= 2:
        return "navigation"
    if n_words >= 5:
        capitals = len(body) - len(body.translate(None, _CAPITALS))
        if 2 * capitals > len(body) - len(body.translate(None, _LETTERS)):
            return "shouting"
    low = body.lower()
    if any(phrase in low for phrase in _PHRASE_BYTES):
        return "boilerplate"
    return None


def code_points(raw: bytes) -> int:
    """Code points in words."""
    return len(b"".join(raw.split()).decode("utf-8", "replace"))


def repeated_words(codes: np.ndarray, first: np.ndarray, size: int = 8) -> np.ndarray:
    """Per row, the words that lie in a ``size``-word window found twice or more in it."""
    window, begins = text.windows(codes, first, size)
    row = text.rows_of(begins, first)
    key = window ^ text.mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(codes) + size + 1, np.int32)
    step[begins[twice]] += 1  # begins are distinct
    step[begins[twice] + size] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step[: len(codes)]) > 0)])
    return covered[first[1:]] - covered[first[:-1]]


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def clean_piece(data: np.ndarray, at: np.ndarray) -> dict[str, list | np.ndarray]:
    starts, ends, first = text.words(data, at)
    n_words = np.diff(first)
    repeat = repeated_words(text.hashes(data, starts, ends), first)
    word_chars = _sums(text.NOT_WHITE[data] & ((data & 0xC0) != 0x80), at)
    raw = data.tobytes()
    n_lines, n_dup, removed, lost, cleaned = [], [], [], [], []
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
        lines = raw[begin:end].split(b"\n")
        seen: set[bytes] = set()
        dup = gone = chars = 0
        left = []
        for line in lines:
            if not line or line.isspace():
                left.append(line)
                continue
            dup += line in seen
            seen.add(line)
            if failing_rule(line):
                gone += 1
                chars += code_points(line)
            else:
                left.append(line)
        n_lines.append(len(lines))
        n_dup.append(dup)
        removed.append(gone)
        lost.append(chars)
        cleaned.append(b"\n".join(left).decode("utf-8", "replace"))
    base_failed = (n_words < 20) | (100 * repeat > 30 * n_words)
    lost_chars = np.array(lost, np.int64)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": _sums(_SYMBOL[data], at),
        "n_dup_lines": n_dup,
        "n_repeat_words": repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & (2 * lost_chars <= word_chars),
        "n_lines": n_lines,
        "n_lines_removed": removed,
        "chars_removed": lost_chars,
        "clean_text": pa.array(cleaned, pa.string()),
    }


def clean(documents: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """Per document the counts, the verdict ``kept`` and ``clean_text``, what is left of the
    text without the failing lines. One pass without a shuffle; other columns are not read."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in text.pieces(batch.column(1)):
                found = clean_piece(data, at)
                yield pa.RecordBatch.from_pydict({"key": batch.column(0)[lo:hi], **found})

    rows = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)
