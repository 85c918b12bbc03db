import hashlib
import random

import pytest

from brindle.llm import fill_middle
from brindle.llm.fill_middle import cut, pack, rebuilt, rearranged, streamed
from tests.llm.helpers import awkward, frame


def plainly(key, body):
    """(n, form, prefix, middle, output) by slicing the text."""
    body, digits = body or "", hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digits[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(body)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not body or any(m in body for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, body
    x, y, z = body[:a], body[a:b], body[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}"


def texts(seed):
    draw = random.Random(seed)
    marked = ["a<P>b", "<S>", "x<M>", "<", "<P", "P><S", "<<>>", "<P<S<M>"]
    return awkward() + marked + ["".join(draw.choices("ab<PSM>é你🙂\n", k=draw.randrange(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("units", [1, 2, 3, 7, 16384])
def test_every_cut_and_the_way_back(units):
    for key, body in enumerate(texts(units)):
        if body is None or len(body) > 5000 and units < 16384:
            continue
        n, form, prefix, middle, frames = rearranged(str(key), body, units)
        assert (n, form, prefix, middle, "".join(streamed(frames))) == plainly(key, body)
        assert all(u == len(x) and u <= max(units, 3) for (u, _), x in zip(frames, streamed(frames)))
        assert "".join(rebuilt(frames, form)) == body


def test_only_frames_that_are_cut_are_made_anew():
    frames = pack("".join(chr(97 + k % 26) for k in range(1000)), 10)
    part = cut(frames, 25, 91)
    assert [u for u, _ in part] == [5, *[10] * 6, 1]
    assert all(x is y for x, y in zip(part[1:-1], frames[3:9]))
    assert cut(frames, 30, 30) == [] == cut(frames, 1000, 1000)


def test_operator_and_digests(spark):
    bodies = texts(5)
    rows = frame(spark, bodies + ["no key", "two", "two"], [*range(len(bodies)), None, 7, 7]).repartition(3)
    filled = fill_middle.fill_in_middle(rows, units=64)
    got = fill_middle.digests(filled).collect()
    want = []
    for r in rows.collect():
        n, form, a, m, out = plainly("" if r.doc_id is None else r.doc_id, r.text)
        want.append((r.doc_id, n, form, a, m, *[hashlib.sha256(x.encode()).hexdigest() for x in (out, r.text or "")]))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fill_middle.digests(fill_middle.fill_in_middle(frame(spark, []))).collect() == []
