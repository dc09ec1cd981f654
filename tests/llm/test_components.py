"""Connected components of random, star-shaped and chained graphs."""

from __future__ import annotations

import random

import pytest

from churnflow.llm.components import components


def expected(edges):
    root = {n: n for e in edges for n in e}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {n: top(n) for n in root}


def graphs():
    rng = random.Random(4)
    yield "chain", [(i, i + 1) for i in range(40)]
    yield "star", [(0, i) for i in range(1, 50)]
    yield "random", [(rng.randrange(90), rng.randrange(90)) for _ in range(70)]
    yield "repeats", [(3, 1), (1, 3), (3, 1), (2, 2)]


@pytest.mark.parametrize("name, edges", graphs())
def test_components(spark, name, edges):
    table = spark.createDataFrame([*edges, (None, 5), (7, None)], "a long, b long")
    found = components(table).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == expected([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
