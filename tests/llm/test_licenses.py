import random

from brindle.llm import licenses
from tests.llm.helpers import awkward, frame


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_increasing_and_never_beats_the_longest_common_subsequence():
    draw = random.Random(2)
    for _ in range(300):
        a = [draw.randrange(12) for _ in range(draw.randrange(0, 20))]
        b = [draw.randrange(12) for _ in range(draw.randrange(0, 20))]
        got = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        assert len(got) <= longest(a, b)


def test_unique_words_align_as_the_longest_increasing_subsequence():
    draw = random.Random(3)
    for _ in range(100):
        a, b = list(range(15)), list(range(15))
        draw.shuffle(b)
        assert len(licenses.anchors(a, b)) == longest(a, b)


def test_scan(spark):
    mit = licenses.TEMPLATES["mit-notice"]
    changed = mit.replace("hereby granted", "granted hereby").replace("Software", "Program", 1)
    texts = [
        "Intro words. Released under the MIT License. More.",
        f"Before\n{mit.upper()}\nafter",
        f"x {changed} y",
        "released license mit under the is not",
        "Licensed under CC BY-NC 4.0.\nAll rights reserved.",
        *awkward(),
    ]
    got = licenses.scan(frame(spark, texts)).collect()
    found = {(r.doc_id, r.license): r for r in got}
    assert set(found) == {
        (0, "mit"), (1, "mit-notice"), (2, "mit-notice"), (4, "cc-by-nc-4.0"), (4, "all-rights-reserved")
    }
    assert found[0, "mit"].coverage == 1.0 and (found[0, "mit"].first_word, found[0, "mit"].last_word) == (2, 6)
    assert found[1, "mit-notice"].coverage == 1.0 and 0.9 < found[2, "mit-notice"].coverage < 1.0
    assert licenses.scan(frame(spark, [])).collect() == []
    assert licenses.scan(frame(spark, texts), {}).collect() == []
    assert [r.doc_id for r in licenses.scan(frame(spark, ["all rights reserved"] * 2, [7, 7])).collect()] == [7, 7]
    assert licenses.scan(frame(spark, ["all rights reserved"], [None])).first().doc_id is None
