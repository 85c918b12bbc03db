import random
import re

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import text
from tests.llm.helpers import awkward


@pytest.mark.parametrize("most", [1, 64, 1 << 21])
def test_words_and_windows_are_those_of_each_text(most):
    texts = awkward()
    found, shingles = [], []
    by_hash = {}
    for _, _, data, at in text.pieces(pa.array(texts), most):
        starts, ends, first = text.words(data, at)
        raw = data.tobytes()
        words = [raw[s:e].decode() for s, e in zip(starts, ends)]
        codes = text.hashes(data, starts, ends)
        for w, c in zip(words, codes.tolist()):
            assert by_hash.setdefault(c, w) == w
        assert len(set(words)) == len(set(codes.tolist()))
        window, begins = text.windows(codes, first, 3)
        row = text.rows_of(begins, first)
        for r in range(len(at) - 1):
            found.append(words[first[r] : first[r + 1]])
            shingles.append(window[row == r].tolist())
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert found == want
    runs = [[tuple(w[i : i + 3]) for i in range(len(w) - 2)] for w in want]
    assert [len(s) for s in shingles] == [len(r) for r in runs]
    of = dict(zip((h for s in shingles for h in s), (x for r in runs for x in r)))
    assert all(of[h] == x for s, r in zip(shingles, runs) for h, x in zip(s, r))


def test_equal_words_have_equal_hashes_wherever_they_are():
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["ab", "abc", "b", "é"]) for _ in range(50)) for _ in range(20)]
    seen = {}
    for most in (10, 1 << 21):
        for _, _, data, at in text.pieces(pa.array(texts), most):
            starts, ends, _ = text.words(data, at)
            for s, e, h in zip(starts, ends, text.hashes(data, starts, ends).tolist()):
                assert seen.setdefault(data[s:e].tobytes(), h) == h
    assert len(set(seen.values())) == 4


def test_slices_and_nulls_of_arrow_columns():
    column = pa.array(["no", None, "a b", "", "c"])[1:]
    data, at = text.utf8(column)
    assert data.tobytes() == b"a bc" and at.tolist() == [0, 0, 3, 3, 4]
    assert list(text.pieces(pa.array([], pa.string()))) == []


def test_lower_case_of_accents():
    raw = np.frombuffer("ÀÉ×Þß AZ az".encode(), np.uint8)
    assert text.fold_latin(raw).tobytes().decode() == "àé×þß az az"
