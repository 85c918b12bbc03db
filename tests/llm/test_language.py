import random

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import language, text
from tests.llm.helpers import awkward, frame


def test_gradient_is_that_of_the_loss():
    net = language.new_network(["a", "b", "c"], 5, 3)
    for part in ("tables", "loops", "heads"):
        setattr(net, part, [x.astype(np.float64) for x in getattr(net, part)])
    draw = np.random.default_rng(0)
    window = draw.integers(60, 70, (7, 4)).astype(np.uint8)
    label, weight = np.array([0, 1, 2, 1]), np.ones((7, 4))
    weight[5:, 0] = 0
    _, found = language.gradients(net, window, weight, label)
    for p, g in zip(net.parameters(), found):
        at = np.unravel_index(np.abs(g).argmax(), p.shape)
        old, step, losses = p[at], 1e-3, []
        for moved in (old + step, old - step):
            p[at] = moved
            losses.append(language.gradients(net, window, weight, label)[0])
        p[at] = old
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(g[at], rel=1e-2, abs=1e-4)


def test_pooling_covers_every_position_of_every_text():
    net = language.new_network(["a", "b"], 4, 1)
    texts = ["", "abc", "x" * 96, "y" * 97, "é" * 500]
    data, at = text.utf8(pa.array(texts))
    got = language.pooled(net, data, at, side_by_side=2)
    for r, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        total = np.zeros(2)
        for lo in range(0, len(raw), language.WINDOW):
            part = raw[lo : lo + language.WINDOW]
            window = np.zeros((language.WINDOW, 1), np.uint8)
            window[: len(part), 0] = part
            total += language.label_positions(net, window)[: len(part), 0].sum(axis=0)
        assert got[r] == pytest.approx(total / max(1, len(raw)), abs=1e-5)


def test_learns_and_marks_texts_without_letters(spark):
    draw = random.Random(2)
    of = {"aa": "kala mana tano pilu".split(), "bb": "stirk wrent glomp frosz".split()}
    texts, langs = [], []
    for i in range(240):
        lang = "aa" if i % 2 else "bb"
        texts.append(" ".join(draw.choice(of[lang]) for _ in range(draw.randrange(3, 60))))
        langs.append(lang)
    docs = frame(spark, texts + awkward() + ["12 34 !?"], langs=langs + [None] * (len(awkward()) + 1))
    net = language.fit(docs.where("doc_id < 160"), settings=language.Settings(steps=60, batch=64))
    got = {r.doc_id: r for r in language.predict(docs, net).collect()}
    right = [got[i].lang_pred == langs[i] for i in range(160, 240)]
    assert sum(right) >= 78
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 240 + len(awkward()) + 1
    und = [k for k, t in enumerate(awkward() + ["12 34 !?"]) if not t or not any(c.isalpha() for c in t)]
    assert [i - 240 for i, r in sorted(got.items()) if r.lang_pred == "und"] == und


def test_no_labels_and_an_empty_table(spark):
    net = language.fit(frame(spark, ["abc"], langs=[None]))
    assert [r.lang_pred for r in language.predict(frame(spark, ["abc", None]), net).collect()] == ["und", "und"]
    assert language.predict(frame(spark, []), net).collect() == []
