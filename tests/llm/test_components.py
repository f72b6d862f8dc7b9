"""Components against a plain union-find: stars, chains, random graphs, loops and repeated edges."""

import random

import pytest

from ampere.llm.components import components


def _plain(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {x: root(x) for x in up if root(x) != x}


def _graphs():
    rnd = random.Random(3)
    hub = 500
    return {
        "star with a middle centre": [(hub, x) for x in range(1000) if x != hub],
        "two stars and a bridge": [(0, x) for x in range(2, 300)] + [(1, x) for x in range(300, 600)] + [(299, 300)],
        "chain": [(x, x + 1) for x in range(200)],
        "random": [(rnd.randrange(900), rnd.randrange(900)) for _ in range(600)],
        "loops and repeats": [(5, 5), (7, 6), (6, 7), (7, 6), (-3, 7)],
        "none": [],
    }


@pytest.mark.parametrize("name", list(_graphs()))
def test_components_equal_union_find(spark, name):
    edges = _graphs()[name]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and dict(rows) == _plain(edges)
