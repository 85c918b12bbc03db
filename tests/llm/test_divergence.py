import random
import re
from collections import Counter, defaultdict

import pytest

from brindle.llm import divergence
from tests.llm.helpers import awkward, frame


def plainly(rows, least, most):
    """The report worked out term by term for (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for body, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if c.isascii() else c for c in body or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= least) for lang, _ in groups}

    def shares(count, lang):
        total = sum(count[t] for t in kept[lang])
        return {t: 1 + divergence.SCALE * (count[t] + 2) // (total + 2 * len(kept[lang])) for t in kept[lang]}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for lang, source in groups:
        p = shares(counts[lang, source], lang)
        q = shares(sum((counts[g] for g in groups if g[0] == lang), Counter()), lang)
        pairs = []
        for other in groups:
            if other[0] == lang and other[1] != source:
                o = shares(counts[other], lang)
                pairs.append((-sum(f(p[t], o[t]) for t in p), other[1].encode()))
        terms = [(-f(p[t], q[t]), t.encode()) for t in p if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
            out |= {(lang, source, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)}
    return out


def documents(spark, rows):
    schema = "text string, lang string, source string, term string, n bigint, value string, other_source string"
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], schema)


def corpus(seed, n=120):
    draw = random.Random(seed)
    words = ["the", "The", "of", "é", "É", "naïve", "z", "zz", "Ω", "a1b", "x-y", *[f"w{chr(97 + k)}" for k in range(20)]]
    rows = []
    for _ in range(n):
        k = draw.randrange(1, 40)
        text = " ".join(draw.choice(words[: draw.randrange(2, len(words))]) for _ in range(k))
        rows.append((text, draw.choice(["en", "fr"]), draw.choice(["a", "b", "c", "ä", None])))
    return rows


@pytest.mark.parametrize("least, most", [(10, 10), (1, 3), (1, 1), (1000, 10)])
def test_same_as_term_by_term(spark, least, most):
    rows = corpus(least)
    got = divergence.audit(documents(spark, rows).repartition(5), least=least, most=most)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == plainly(rows, least, most)


def test_ties_nulls_long_texts_and_groups_without_terms(spark):
    rows = [(t, "en", s) for t in awkward() for s in ("a", "b", None)] + [(None, None, None), ("", "xx", "a"), ("1 2", "xx", "b")]
    rows += [("p q r s t u v w x y z aa bb cc", "de", "one"), ("", "de", "two")]  # all terms tie
    got = divergence.audit(documents(spark, rows), least=1, most=5)
    assert {tuple(r) for r in got.collect()} == plainly(rows, 1, 5)


def test_empty_table_and_small_buffers(spark, monkeypatch):
    assert divergence.audit(documents(spark, [])).collect() == []
    monkeypatch.setattr(divergence, "HELD", 40)
    rows = corpus(3)
    got = divergence.audit(documents(spark, rows).coalesce(1), least=2)
    assert {tuple(r) for r in got.collect()} == plainly(rows, 2, 10)


def test_shares_beyond_64_bits(spark):
    row = spark.sql("select 20000000000L as n, 30000000000L as total, 5L as v").select(divergence.share("n", "total", "v").alias("p"))
    assert row.first().p == 1 + divergence.SCALE * (20000000000 + 2) // (30000000000 + 10)


def test_extra_columns_that_clash(spark):
    rows = frame(spark, ["a b", "b c", "c d"])
    assert {tuple(r) for r in divergence.audit(rows, least=1).collect()} == plainly(
        [("a b", "en", None), ("b c", "en", None), ("c d", "en", None)], 1, 10
    )
