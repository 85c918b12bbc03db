import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import suffix_dedup, text
from tests.llm.helpers import awkward, frame


def plainly(bodies, length):
    """Removed byte positions of each text, from counts of all windows."""
    raw = [(b or "").encode() for b in bodies]
    count = Counter(r[k : k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = set()
        for k in range(len(r) - length + 1):
            if count[r[k : k + length]] > 1:
                gone.update(range(k, k + length))
        out.append(gone)
    return out


def corpus(seed, alphabet="abcdefgh é你\n", n=40):
    draw = random.Random(seed)
    passages = ["".join(draw.choices(alphabet, k=draw.randrange(10, 120))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [
            draw.choice(passages)[draw.randrange(5) :] if draw.random() < 0.6 else "".join(draw.choices(alphabet, k=draw.randrange(60)))
            for _ in range(draw.randrange(1, 5))
        ]
        out.append("".join(parts))
    return [*out, *out[:3], "ab" * 100, "x" * 150, "x" * 30, "x" * 29]


def rows_of(bodies, length):
    return [(len((b or "").encode()), sorted(g)) for b, g in zip(bodies, plainly(bodies, length))]


def positions(spans):
    return [p for s in spans for p in range(s["start"], s["end"])]


@pytest.mark.parametrize("length, gram", [(30, 10), (30, 30), (12, 1), (1, 1)])
def test_same_as_counting_all_windows(spark, monkeypatch, length, gram):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    bodies = awkward()[:-20] + [None, "", "é"] + corpus(length)
    docs = frame(spark, bodies).repartition(4)
    settings = {"length": length, "gram": gram, "string_bytes": 500}
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(docs, **settings).collect()}
    for i, (n_bytes, gone) in enumerate(rows_of(bodies, length)):
        raw = (bodies[i] or "").encode()
        assert (got[i].n_bytes, positions(got[i].removed)) == (n_bytes, gone)
        assert bytes(got[i].kept) == bytes(b for p, b in enumerate(raw) if p not in set(gone))
        ends = [(s["start"], s["end"]) for s in got[i].removed]
        assert all(b < c for (_, b), (c, _) in zip(ends, ends[1:]))  # maximal: none touch


def test_common_anchors_are_taken_apart(spark):
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdefgh", k=60))
    bodies = ["".join(draw.choices("abcdefgh", k=40)) + passage + "".join(draw.choices("abcdefgh", k=40)) for _ in range(60)]
    bodies += corpus(4)
    docs = frame(spark, bodies).repartition(3)
    got = {r.doc_id: positions(r.removed) for r in suffix_dedup.without_repeats(docs, length=30, gram=10, most_places=5).collect()}
    assert [got[i] for i in range(len(bodies))] == [sorted(g) for g in plainly(bodies, 30)]


def test_anchors_of_many_bytes_are_taken_apart(spark, monkeypatch):
    """One gram that is the least everywhere, in few texts, but long ones."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    bodies = ["x" * 300 + chr(97 + k) * 40 + "x" * 200 for k in range(8)] + corpus(5)
    docs = frame(spark, bodies).repartition(3)
    settings = {"length": 30, "gram": 10, "string_bytes": 400}
    got = {r.doc_id: positions(r.removed) for r in suffix_dedup.without_repeats(docs, **settings).collect()}
    assert [got[i] for i in range(len(bodies))] == [sorted(g) for g in plainly(bodies, 30)]


def test_strings_of_more_than_two_million_bytes():
    """What one anchor holds is decided, however long it is."""
    draw = np.random.default_rng(3)
    passage = draw.integers(97, 123, 500, np.uint8).tobytes()
    parts = [draw.integers(97, 123, 750_000, np.uint8).tobytes() for _ in range(3)]
    contents = [parts[0] + passage, passage + parts[1], parts[2]]
    got = suffix_dedup.repeated(contents, [1, 1, 1])
    assert sum(map(len, contents)) > 1 << 21
    assert [np.flatnonzero(g).tolist() for g in got] == [[*range(750_000, 750_101)], [*range(101)], []]


@pytest.mark.parametrize("seed", range(6))
def test_interval_expansion_gives_common_prefixes(seed):
    draw, length = random.Random(seed), 1 + 3 * seed
    contents = sorted({bytes(draw.choices(b"ab" if seed % 2 else b"abcdef\0\xff", k=draw.randrange(length, 60))) for _ in range(40)})
    places = [draw.randrange(1, 3) for _ in contents]
    count = Counter()
    for c, n in zip(contents, places):
        for k in range(len(c) - length + 1):
            count[c[k : k + length]] += n
    got = suffix_dedup.repeated(contents, places, length)
    assert [g.tolist() for g in got] == [[count[c[k : k + length]] > 1 for k in range(len(c) - length + 1)] for c in contents]


def test_order_and_groups_against_sorting():
    draw = np.random.default_rng(2)
    symbols = np.concatenate([draw.integers(1, 4, 300), np.tile([1, 2], 60), [0]])
    order = suffix_dedup.suffix_order(symbols, 21)
    turned = [tuple(np.roll(symbols, -k)[:20].tolist()) for k in range(len(symbols))]
    assert [turned[k] for k in order] == sorted(turned)
    group = suffix_dedup.same_prefixes(symbols, order, 20)
    assert [a == b for a, b in zip(group, group[1:])] == [turned[a] == turned[b] for a, b in zip(order, order[1:])]


def test_equal_windows_have_equal_anchors():
    bodies = corpus(7)
    data, at = text.utf8(pa.array(bodies))
    row, start, windows, anchor, times = suffix_dedup.segments(data, at, 30, 10)
    of, n = {}, 0
    for r, s, w, a, t in zip(*(x.tolist() for x in (row, start, windows, anchor, times))):
        raw = bodies[r].encode()
        own = [raw[k : k + 30] for k in range(s, s + w)]
        assert t > 1 or t == 1 and len(own) == len(set(own))
        for k in range(s, s + w):
            n += 1
            assert of.setdefault(raw[k : k + 30], a) == a and len(raw) >= k + 30
    assert n == sum(max(len(b.encode()) - 29, 0) for b in bodies)


def test_empty_table_nulls_and_repeated_keys(spark):
    assert suffix_dedup.without_repeats(frame(spark, [])).collect() == []
    body = "".join(random.Random(1).choices("abc ", k=500))
    got = suffix_dedup.without_repeats(frame(spark, [body, body, None, "", body[:399]], [None, 3, 3, None, 5])).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in got) == [(0, 0, 0), (0, 500, 0), (3, 0, 0), (3, 500, 0), (5, 399, 399)]


def test_query_on_small_table(spark):
    from brindle.llm.queries import QUERIES

    base = "/root/testdata/sf0.001"
    bodies = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    gone = dict(zip(bodies, plainly(list(bodies.values()), 400)))
    got = {r.doc_id: r for r in QUERIES["op11_suffix_dedup"](spark, base).collect()}
    assert set(got) == set(bodies)
    for i, body in bodies.items():
        raw = (body or "").encode()
        kept = bytes(b for p, b in enumerate(raw) if p not in gone[i])
        spans = sum(p - 1 not in gone[i] for p in gone[i])
        assert tuple(got[i]) == (i, len(raw), len(gone[i]), spans, hashlib.sha256(kept).hexdigest())
    assert sum(map(len, gone.values())) > 0
