import random

import pytest

from brindle.llm import components as components_module
from brindle.llm.components import components
from tests.llm.helpers import components as brute


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    draw = random.Random(5)
    links = {
        "random": [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(None, 3), (4, 4)],
        "path": [(i, i + 1) for i in range(40)][::-1],
        "star": [(100, i) for i in range(50)],
        "none": [],
    }[kind]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    pairs = {frozenset(p) for p in links if None not in p}
    nodes = sorted({n for p in pairs for n in p})
    want = brute(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert got == {n: r for n, r in want.items() if n != r}


def test_a_tree_is_flattened_by_its_own_links(spark, monkeypatch):
    """Rounds over trees only look up what a node hangs on: no node is counted more than once before."""
    places = []
    written = components_module.written
    monkeypatch.setattr(components_module, "written", lambda rows, purpose: places.append(set(rows.columns)) or written(rows, purpose))
    chain = spark.createDataFrame([(k, k + 1) for k in range(64)], "a bigint, b bigint")
    assert sorted(map(tuple, components_module.components(chain).collect())) == [(k, 0) for k in range(1, 65)]
    assert {"u", "v", "moved"} in places
    assert components_module.components(chain.where("a < 0")).count() == 0
