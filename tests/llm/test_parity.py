import random
import re

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import parity, text
from tests.llm.helpers import awkward, components, frame


def shingles(body):


    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), body or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 75 * (len(a) + len(b) - both)


def corpus(seed, n_base=40, line=""):
    draw = random.Random(seed)
    out = []
    for _ in range(n_base):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([4, 6, 9, 30, 80, 200, 600]))]
        for _ in range(draw.choice([1, 1, 2, 5])):
            copy = list(words)
            for _ in range(draw.randrange(0, 1 + len(words) // 25)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
            out.append((line + "\n" if draw.random() < 0.5 else "") + " ".join(copy))
    return out


@pytest.mark.parametrize("common, line", [(64, ""), (3, "one line that many of the documents share word for word")])
def test_components_are_those_of_all_pairs(spark, monkeypatch, common, line):
    monkeypatch.setattr(parity, "COMMON", common)
    monkeypatch.setattr("brindle.llm.buckets.FEW", 3)
    texts = awkward() + corpus(2, line=line)
    sets = [shingles(t) for t in texts]
    want = components(range(len(texts)), lambda a, b: linked(sets[a], sets[b]))
    got = {r.doc_id: r for r in parity.near_duplicates(frame(spark, texts).repartition(3)).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert len(set(want.values())) < len(texts) - 20


@pytest.mark.parametrize("size", [1, 2, 7, 30, 64, 100, 255, 256, 400, 1000])
def test_every_link_shares_a_bucket(size):
    """Sets at the bound of similarity, and of different sizes, always meet."""
    draw = np.random.default_rng(size)
    for trial in range(30):
        pool = np.unique(draw.integers(0, 2**63, 2 * size + 20).astype(np.uint64))
        draw.shuffle(pool)
        a = np.sort(pool[:size])
        gone = draw.integers(0, size // 4 + 1)
        extra = draw.integers(0, size // 4 + 1)
        b = np.sort(np.concatenate([draw.permutation(a)[gone:], pool[size : size + extra]]))
        common = np.sort(draw.choice(a, draw.integers(0, size + 1), replace=False)) if trial % 2 else a[:0]
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 75 * (len(a) + len(b) - both):
            starts = parity.band_starts(5000)
            keys = [set(parity.bucket_keys(s, common, starts).tolist()) for s in (a, b)]
            assert keys[0] & keys[1]


def test_a_large_group_of_near_copies(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(150):
        copy = list(words)
        copy[draw.randrange(60)] = f"x{draw.randrange(10**9)}"
        texts.append(" ".join(copy))
    got = parity.near_duplicates(frame(spark, texts))
    assert {r.component_id for r in got.collect()} == {0}


def test_empty_table_null_and_repeated_keys(spark):
    assert parity.near_duplicates(frame(spark, [])).collect() == []
    body = "one two three four five six"
    got = parity.near_duplicates(frame(spark, [body, body, None, "", body], [None, 3, 4, 4, 9])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == [
        (0, 2, 3), (3, 2, 3), (4, 0, 4), (4, 0, 4), (9, 2, 3)
    ]


def test_identity_does_not_depend_on_order():
    column = pa.array(["a b c d e f g", "a b c d e f g", "b c d e f g a"])
    data, at = text.utf8(column)
    x, y, z = [parity.identity(s) for s in parity.shingle_sets(data, at)]
    assert x == y != z


def test_near_copies_without_a_key_link(spark):
    words = [f"w{k}" for k in range(100)]
    near = [" ".join([*words[: 100 - k], *(f"x{j}" for j in range(k))]) for k in (0, 9, 18)]
    assert linked(shingles(near[0]), shingles(near[1])) and linked(shingles(near[1]), shingles(near[2]))
    assert not linked(shingles(near[0]), shingles(near[2]))
    # the last two hang together with the first by rows without a key only
    got = parity.near_duplicates(frame(spark, near, [3, None, 5])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (None, 3), (5, 3)}
