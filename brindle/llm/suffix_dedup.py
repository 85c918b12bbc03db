"""Removal of repeated byte strings: threshold-bounded interval expansion on a BWT.

A text is its UTF-8 bytes. Every byte that lies in a string of ``length`` bytes (a window)
that also starts anywhere else, in the same text or another, is removed; windows overlap,
don't cross texts, and are judged on the input.

**Dealing.** Equal windows have the same least ``gram``-byte hash, so a window is dealt by
that hash (its anchor). Neighbouring windows with one anchor form a segment. Anchors that
occur once in the whole corpus are dropped: their windows have no equal. Of the others
the bytes are fetched and dealt by anchor, each different content once with the number
of its places, so a passage of a billion copies arrives as a row or two for each task. An
anchor with more than ``most_places`` places, or more than ``string_bytes`` bytes at all of
them, is taken apart: its windows are counted by a 128-bit hash of their bytes and only
runs of windows that are not alone go on, so what surrounds a common passage stays behind.

**Deciding.** The contents of some anchors, a separator after each, make a string of up to
a megabyte, or of one anchor's contents if these are more, however long. Its
Burrows-Wheeler transform comes from sorting suffixes by their first
``length`` + 1 bytes (prefix doubling). All intervals of strings of 1, 2, 3, ... bytes are then
derived breadth first by backward extension: an interval of a string of n bytes has for
each byte before it an interval of n + 1 bytes; if what follows that interval has no
common prefix set, it is n long, and the interval goes on. So common prefixes are set by
increasing value, and the expansion stops at ``length``: where none is set, neighbours
share ``length`` bytes or more. A window is repeated if its group of such neighbours has
two places or more.

Texts are told apart by two 64-bit hashes; equal texts have one result. A null text is
empty. Texts shorter than ``length`` keep everything. Repeated rows are repeats like others.
Keys are only carried along. Very long texts are cut into overlapping chunks of windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.tables import prepare, written

LENGTH, GRAM = 400, 100
MOST_PLACES = 2_000
CHUNK = 1 << 20
STRING_BYTES = 1 << 20
SPANS = "array<struct<start: bigint, end: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor, times) of the segments of some texts; the
    anchor is found so many times in the segment, mostly once."""
    found = []
    for lo in range(0, max(len(data) - length + 1, 0), CHUNK):
        hi = min(lo + CHUNK + length - 1, len(data))
        cuts = at[(at > lo) & (at < hi)] - lo
        first, *rest = _anchored(data[lo:hi], cuts, length, gram)
        found.append((first + lo, *rest))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    first, windows, anchor, times = map(np.concatenate, zip(*found))
    row = np.searchsorted(at, first, "right") - 1
    return row, first - at[row], windows, anchor, times


def _sliding(values: np.ndarray, span: int, n: int, best: np.ufunc, rest: int) -> np.ndarray:
    """``best`` of each of the first ``n`` runs of ``span`` neighbours: from blocks, to the right and to the left."""
    padded = np.full(-(-max(len(values), n + span - 1) // span) * span, rest, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, span)
    right = best.accumulate(blocks, axis=1).ravel()
    left = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(left[:n], right[span - 1 : span - 1 + n])


def _anchored(data: np.ndarray, cuts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of one run of bytes that ``cuts`` divide into texts."""
    n, span = len(data) - length + 1, length - gram + 1
    starts = np.arange(len(data) - gram + 1)
    grams = text.hashes(data, starts, starts + gram)
    least = _sliding(grams, span, n, np.minimum, 2**64 - 1)
    whole = np.zeros(n + 1, np.int64)  # windows across a cut count up to it
    np.add.at(whole, np.clip(cuts - length + 1, 0, n), 1)
    np.add.at(whole, np.clip(cuts, 0, n), -1)
    inside = np.cumsum(whole)[:n] == 0
    head = inside.copy()
    head[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    head[cuts[cuts < n]] = inside[cuts[cuts < n]]
    first = np.flatnonzero(head)
    tail = inside.copy()
    tail[:-1] &= head[1:] | ~inside[1:]
    last = np.flatnonzero(tail)
    # the grams that are an anchor are the greatest least value of the windows they lie in
    around = np.concatenate([np.zeros(span - 1, np.uint64), np.where(inside, least, np.uint64(0))])
    anchors = np.flatnonzero(grams == _sliding(around, span, len(grams), np.maximum, 0))
    lo, hi = np.searchsorted(anchors, first), np.searchsorted(anchors, last + span)
    size = hi - lo
    of = np.repeat(np.arange(len(first)), size)
    own = anchors[np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)]
    times = np.bincount(of[grams[own] == least[first[of]]], minlength=len(first))
    return first, last + 1 - first, least[first].astype(np.int64), times


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the rotations of ``symbols``, in order of their first ``depth`` symbols."""
    n, n_symbols = len(symbols), int(symbols.max()) + 1
    bits, wide = max(n - 1, 1).bit_length(), max(n_symbols - 1, 1).bit_length()
    place, low = np.arange(n, dtype=np.uint64), np.uint64((1 << bits) - 1)
    key, known = np.zeros(n, np.uint64), 0
    while known < depth and (known + 1) * wide + bits <= 64:
        key = (key << np.uint64(wide)) | np.roll(symbols, -known).astype(np.uint64)
        known += 1
    key = np.sort((key << np.uint64(bits)) | place)
    order, key = (key & low).astype(np.int64), key >> np.uint64(bits)
    slots = np.arange(n)
    heads = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.uint64)
    open_ = slots
    while True:
        group = open_[np.flatnonzero(heads)]  # a group is named after its first slot
        rank[order[open_]] = np.repeat(group, np.diff(np.append(np.flatnonzero(heads), len(open_)))).astype(np.uint64)
        alone = heads & np.append(heads[1:], True)
        open_ = open_[~alone]
        if known >= depth or not len(open_):
            return order
        own = order[open_]
        first, second = rank[own], rank[(own + known) % n]
        if 3 * bits <= 64:  # both ranks and the place are one number
            key = (first << np.uint64(2 * bits)) | (second << np.uint64(bits)) | own.astype(np.uint64)
            key.sort()
            order[open_] = (key & low).astype(np.int64)
            key >>= np.uint64(bits)
            heads = np.concatenate([[True], key[1:] != key[:-1]])
        else:
            by = np.lexsort((second, first))
            order[open_], first, second = own[by], first[by], second[by]
            heads = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        known *= 2


def same_prefixes(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place in ``order`` a group number: neighbours share one if ``length`` symbols are equal."""
    n = len(symbols)
    before = symbols[order - 1].astype(np.int64)  # the transform
    by_symbol = np.argsort(before.astype(np.uint16), kind="stable")
    step = np.empty(n, np.int64)  # where the rotation that begins one symbol earlier is
    step[by_symbol] = np.arange(n)
    later, earlier = np.full(n, n), np.full(n, -1)
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    later[by_symbol[:-1][same]] = by_symbol[1:][same]
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    known = np.zeros(n + 1, bool)  # a common prefix is set, and shorter than ``length``
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):  # the common prefixes set in a round are as long as the rounds before it are many
        size = hi - lo
        heads = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(lo - heads, size)
        # the first and the last of each symbol in an interval bound the longer string's interval
        new_lo = np.sort(step[at[earlier[at] < np.repeat(lo, size)]])
        new_hi = np.sort(step[at[later[at] >= np.repeat(hi, size)]]) + 1
        fresh = ~known[new_hi]
        known[new_hi] = True
        lo, hi = new_lo[fresh], new_hi[fresh]
        if not len(lo):
            break
    return np.cumsum(known[:n]) - 1


def repeated(contents: list[bytes], places: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each of the different contents, whether each of its windows has two places or more."""
    sizes = np.array([len(c) for c in contents])
    data = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    used, symbols = np.unique(data, return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    symbols[ends - 1] = 0
    group_of = np.empty(len(data), np.int64)
    order = suffix_order(symbols, length + 1)
    group_of[order] = same_prefixes(symbols, order, length)
    windows = sizes - length + 1
    at = np.arange(windows.sum()) + np.repeat(starts - np.cumsum(windows) + windows, windows)
    group = group_of[at]
    total = np.bincount(group, np.repeat(np.asarray(places), windows))
    return np.split(total[group] > 1, np.cumsum(windows)[:-1])


def runs_of(marked: np.ndarray, length: int) -> list[dict[str, int]]:
    """The byte ranges that marked windows cover, merged where they touch."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + length - 1
    out: list[dict[str, int]] = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = b
        else:
            out.append({"start": a, "end": b})
    return out


def _texts(documents: DataFrame, body: str) -> DataFrame:
    bodies = documents.select(F.col(body).alias("body"))
    return bodies.select(F.xxhash64("body").alias("t1"), F.xxhash64(F.lit("other"), "body").alias("t2"), "body")


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of spans of bytes."""
    other = text.mix(data.astype(np.uint64) + np.uint64(0xA54FF53A5F1D36F1))
    return text.hashes(data, starts, ends).astype(np.int64), text.span_hashes(other, starts, ends).astype(np.int64)


def _places(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, t1, t2, start, windows, times), of each different text twice a task at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            ids = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            new = []
            for k, one in enumerate(ids):
                seen[one] = seen.get(one, 0) + 1
                if seen[one] <= 2:
                    new.append(k)
            some = batch.take(pa.array(new, pa.int64()))
            for lo, hi, data, at in text.pieces(some.column(2)):
                row, start, windows, anchor, times = segments(data, at, length, gram)
                own = some.slice(lo, hi - lo).select(["t1", "t2"]).take(pa.array(row))
                columns = [pa.array(anchor), *own.columns, pa.array(start), pa.array(windows), pa.array(times)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "t1", "t2", "start", "windows", "times"])

    long_enough = texts.where(F.octet_length("body") >= length)
    return long_enough.mapInArrow(run, "anchor bigint, t1 bigint, t2 bigint, start bigint, windows bigint, times bigint")


def _marked_texts(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """The texts with marks, ``copies`` and their marks as an array."""
    one = F.struct("start", "windows", "anchor")
    of_text = marks.groupBy("t1", "t2").agg(F.max("copies").alias("copies"), F.collect_list(one).alias("marks"))
    of_text = written(of_text, "marks")
    return texts.join(of_text.hint("merge"), ["t1", "t2"]).select("t1", "t2", "body", "copies", "marks")


def _pieces_of(batch: pa.RecordBatch, seen: set[tuple[int, int]]) -> Iterator[tuple[int, int, int, bytes, list[tuple[int, int, int]]]]:
    """(t1, t2, copies, bytes, marks) of the texts not seen before; marks are in order."""
    t1, t2, copies, marks = (batch.column(k) for k in (0, 1, 3, 4))
    for lo, hi, data, at in text.pieces(batch.column(2)):
        raw, bounds = data.tobytes(), at.tolist()
        for k in range(lo, hi):
            one = (t1[k].as_py(), t2[k].as_py())
            if one in seen:
                continue
            seen.add(one)
            own = sorted((m["start"], m["windows"], m["anchor"]) for m in marks[k].as_py())
            yield *one, copies[k].as_py(), raw[bounds[k - lo] : bounds[k - lo + 1]], own


def _windows(marked: DataFrame, length: int) -> DataFrame:
    """(w1, w2, anchor, t1, t2, copies, start) of the single windows of marked segments."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for t1, t2, copies, raw, marks in _pieces_of(batch, seen):
                data = np.frombuffer(raw, np.uint8)
                every = np.concatenate([np.arange(s, s + n) for s, n, _ in marks])
                anchor = np.repeat(np.array([a for _, _, a in marks], np.int64), [n for _, n, _ in marks])
                for lo in range(0, len(every), CHUNK):  # a long text may have as many windows as bytes
                    start = every[lo : lo + CHUNK]
                    own = start - start[0]
                    w1, w2 = _hashed(data[start[0] : start[-1] + length], own, own + length)
                    same = [np.full(len(start), x, np.int64) for x in (t1, t2, copies)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (w1, w2, anchor[lo : lo + CHUNK], *same, start)],
                        ["w1", "w2", "anchor", "t1", "t2", "copies", "start"],
                    )

    return marked.mapInArrow(run, "w1 bigint, w2 bigint, anchor bigint, t1 bigint, t2 bigint, copies bigint, start bigint")


def _contents(marked: DataFrame, length: int) -> DataFrame:
    """A row for each segment: its anchor, place, and content by hash. The bytes are given
    where a task first meets them; ``sent`` is false from a content's third place on."""
    schema = "anchor bigint, t1 bigint, t2 bigint, start bigint, copies bigint, c1 bigint, c2 bigint, sent boolean, content binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        times: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            rows = []
            for t1, t2, copies, raw, marks in _pieces_of(batch, seen):
                data = np.frombuffer(raw, np.uint8)
                start = np.array([m[0] for m in marks])
                end = start + np.array([m[1] for m in marks]) + length - 1
                for (s, n, anchor), c1, c2 in zip(marks, *(h.tolist() for h in _hashed(data, start, end))):
                    met = times[anchor, c1, c2] = times.get((anchor, c1, c2), 0) + 1
                    rows.append((anchor, t1, t2, s, copies, c1, c2, met <= 2, raw[s : s + n + length - 1] if met == 1 else None))
            if rows:
                kinds = [pa.int64()] * 7 + [pa.bool_(), pa.binary()]
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in schema.split(", ")])

    return marked.mapInArrow(run, schema)


def _decided(contents: DataFrame, length: int, string_bytes: int) -> DataFrame:
    """(anchor, c1, c2, spans) of the contents with repeated windows: byte ranges in them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list] = {}  # of the anchors before
        of_anchor: dict[tuple[int, int, int], list] = {}
        size, more, last = 0, 0, None

        def out() -> pa.RecordBatch:
            bodies = [v[0] for v in held.values()]
            found = repeated(bodies, [v[1] for v in held.values()], length)
            rows = [(*k, runs_of(marked, length)) for k, marked in zip(held, found) if marked.any()]
            columns = zip(*rows) if rows else ((), (), (), ())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, [pa.int64()] * 3 + [_SPANS])]
            return pa.RecordBatch.from_arrays(arrays, ["anchor", "c1", "c2", "spans"])

        for batch in batches:
            for anchor, c1, c2, copies, content in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if anchor != last:
                    if held and size + more > string_bytes:
                        yield out()
                        held, size = {}, 0
                    held, size = held | of_anchor if held else of_anchor, size + more
                    of_anchor, more, last = {}, 0, anchor
                one = of_anchor.setdefault((anchor, c1, c2), [None, 0])
                one[1] += copies
                if one[0] is None and content is not None:
                    one[0] = content
                    more += len(content)
        if held and size + more > string_bytes:
            yield out()
            held = {}
        held |= of_anchor
        if held:
            yield out()

    dealt = contents.where("sent").select("anchor", "c1", "c2", "copies", "content")
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, f"anchor bigint, c1 bigint, c2 bigint, spans {SPANS}")


def repeated_spans(
    documents: DataFrame, body: str = "text", length: int = LENGTH, gram: int = GRAM,
    most_places: int = MOST_PLACES, string_bytes: int = STRING_BYTES,
) -> DataFrame:
    """``t1``, ``t2`` (hashes of a text) and ``spans``, the byte ranges that repeats cover, of the
    texts that have any; ranges are in order and may touch or overlap."""
    prepare(documents.sparkSession)
    texts = _texts(documents, body)
    ids = ["anchor", "t1", "t2", "start", "windows"]
    found = _places(texts, length, gram).groupBy(*ids).agg(F.count("*").alias("copies"), F.max("times").alias("times"))
    places = written(found, "places")
    held = F.sum(F.col("windows") + (length - 1)).alias("bytes")
    anchors = places.groupBy("anchor").agg(F.sum(F.col("copies") * F.col("times")).alias("n"), F.count("*").alias("n_texts"), held).where("n > 1")
    common = (F.col("n_texts") > most_places) | (F.col("bytes") > string_bytes)
    marks = places.drop("times").join(anchors.select("anchor", common.alias("common")), "anchor")
    marks = written(marks.select(*ids, "copies", "common"), "marked-places")
    few, many = marks.where("not common").drop("common"), marks.where("common").drop("common")
    if not many.isEmpty():
        windows = written(_windows(_marked_texts(texts, many), length), "windows")
        twice = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1").select("w1", "w2")
        again = windows.join(twice, ["w1", "w2"], "left_semi")
        # windows that follow one another are one segment
        nth = F.row_number().over(Window.partitionBy("anchor", "t1", "t2").orderBy("start"))
        runs = again.withColumn("run", F.col("start") - nth).groupBy("anchor", "t1", "t2", "run")
        few = few.unionByName(
            runs.agg(F.min("start").alias("start"), F.count("*").alias("windows"), F.max("copies").alias("copies")).drop("run")
        )
    contents = written(_contents(_marked_texts(texts, few), length), "segments")
    decided = _decided(contents, length, string_bytes)
    spans = contents.select("anchor", "c1", "c2", "t1", "t2", F.col("start").alias("at")).join(decided, ["anchor", "c1", "c2"])
    shifted = F.transform("spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), (s["end"] + F.col("at")).alias("end")))
    of_text = spans.select("t1", "t2", shifted.alias("spans")).groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return of_text.select("t1", "t2", F.array_sort("spans").cast(SPANS).alias("spans"))


def without_repeats(documents: DataFrame, key: str = "doc_id", body: str = "text", **settings: int) -> DataFrame:
    """``key``, ``n_bytes``, ``removed`` (maximal ranges of bytes) and ``kept``, the bytes left,
    of each row. ``kept`` is binary: a range may end within a character."""
    gone = written(repeated_spans(documents, body, **settings), "repeated-spans")
    both = documents.select(F.col(key).alias("key"), F.col(body).alias("body"))
    both = both.withColumns({"t1": F.xxhash64("body"), "t2": F.xxhash64(F.lit("other"), "body")})
    joined = both.join(gone.hint("merge"), ["t1", "t2"], "left")
    # ranges that touch or overlap become one
    merged = F.aggregate(
        F.coalesce("spans", F.array().cast(SPANS)),
        F.array().cast(SPANS),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(out, F.array(s))),
    )

    def left_over(bodies: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for raw, spans in zip(bodies.cast(pa.binary()).to_pylist(), removed.to_pylist()):
            if raw is not None:
                edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(raw)]
                raw = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append(raw)
        return pa.array(out, pa.binary())

    cut = F.arrow_udf(left_over, "binary")
    rows = joined.select("key", "body", merged.alias("removed"))
    shorter = rows.withColumn("cut", cut(F.when(F.size("removed") > 0, F.col("body")), F.col("removed")))
    whole = F.coalesce(F.col("body"), F.lit("")).cast("binary")
    return shorter.select(
        F.col("key").alias(key),
        F.coalesce(F.octet_length("body"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "removed",
        F.coalesce("cut", whole).alias("kept"),
    )
