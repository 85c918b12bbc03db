"""Documents with everything that may be wrong with a table."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "key string, body string, node bigint, n int, line int, score double"
)


def frame(spark, texts, ids=None, langs=None):
    """Documents with clashing extra columns."""
    ids = range(len(texts)) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, l, None, None if t is None else len(t), "x", None, 7, 1, 2, 0.5) for i, t, l in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(seed=1):
    """Null, empty, blank, very long and repeated texts, and some prose."""
    draw = random.Random(seed)
    words = "the of and to in is that it was for on as with be by at from this have or".split()
    prose = [" ".join(draw.choice(words) for _ in range(draw.randrange(5, 60))) + "." for _ in range(12)]
    return [
        None, "", " \t\n ", "\n\n", "a", "é", "One two three four.", "One two three four.",
        "ÀÉ naïve façade x 你好。\nlast", "!!! ### $$$", "word " * 30_000, "x" * 200_000, *prose, prose[0],
    ]


def components(nodes, linked):
    """Smallest node reachable from each, by brute force."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
